import math

import pytest
from pyspark.sql import functions as F

from tallyward.functions import scalar as S
from tallyward.functions import stats as T
from tallyward.plans.mart import diagnosis_group, specialty_group, stage
from tallyward.sources.fixtures import encounters


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_normal_tail(spark):
    xs = [-8.0, -1.96, -0.3, 0.0, 0.5, 1.0, 2.5, 6.9, 7.3, 12.0]
    got = one(spark, *[T.normal_upper(F.lit(x)) for x in xs])
    for x, g in zip(xs, got):
        assert g == pytest.approx(0.5 * math.erfc(x / math.sqrt(2)), rel=1e-9)


def test_chi2_tail(spark):
    # closed forms: df 1 erfc, df 2 exp, df 4 exp(-h)(1+h); 3 and 5 by their sums
    x = 3.7
    h = x / 2
    tail1 = math.erfc(math.sqrt(h))
    want = {
        1: tail1,
        2: math.exp(-h),
        3: tail1 + math.exp(-h) * math.sqrt(h) / math.gamma(1.5),
        4: math.exp(-h) * (1 + h),
        5: tail1 + math.exp(-h) * (math.sqrt(h) / math.gamma(1.5) + h**1.5 / math.gamma(2.5)),
        6: math.exp(-h) * (1 + h + h * h / 2),
    }
    got = one(spark, *[T.chi2_upper(F.lit(x), F.lit(df)) for df in want])
    for g, w in zip(got, want.values()):
        assert g == pytest.approx(w, rel=1e-9)
    assert one(spark, T.chi2_upper(F.lit(0.0), F.lit(3)))[0] == 1.0


def test_kolmogorov_matches_published_row(spark):
    # first published drift batch: D = 0.0312, n = 48,706 and 3,479, p = 0.0036
    p = one(spark, T.kolmogorov_p(F.lit(0.0312), F.lit(48706), F.lit(3479)))[0]
    assert round(p, 4) == pytest.approx(0.0036, abs=1e-4)
    assert one(spark, T.kolmogorov_p(F.lit(0.0), F.lit(10), F.lit(10)))[0] == 1.0


def test_e_value_symmetric(spark):
    a, b, c = one(spark, T.e_value(F.lit(2.0)), T.e_value(F.lit(0.5)), T.e_value(F.lit(1.0)))
    assert a == pytest.approx(2 + math.sqrt(2)) == pytest.approx(b)
    assert c == 1.0


def test_diagnosis_groups(spark):
    want = {
        "250": "Diabetes", "250.83": "Diabetes", "459": "Circulatory", "459.5": "Other", "785": "Circulatory",
        "785.5": "Other", "V58": "Other", "E909": "Other", "459d": "Other", "1e2": "Other", "486": "Respiratory",
        "786": "Respiratory", "999": "Injury", "139.9": "Other", "140": "Neoplasms",
    }
    df = spark.createDataFrame([(k,) for k in want] + [(None,)], "c string")
    got = {r.c: (r.g, r.h) for r in df.select("c", diagnosis_group("c").alias("g"), diagnosis_group("c", "None").alias("h")).collect()}
    assert got.pop(None) == ("Other", "None")
    assert got == {k: (v, v) for k, v in want.items()}


def test_specialty_first_rule_wins(spark):
    rows = ["Surgery-Internal", "InternalMedicine", "Cardiology", "cardiology", "Emergency/Trauma", "Nephrology", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, medical_specialty string")
    got = [r[0] for r in df.orderBy("i").select(specialty_group()).collect()]
    assert got == ["Surgery", "Internal Medicine", "Cardiology", "Other", "Emergency", "Other", "Unknown"]


def test_null_semantics(spark):
    df = spark.createDataFrame([("No", "Up", 11, "x"), (None, None, 1, "x"), ("Down", "Steady", None, "x"), ("No", "No", 1, None)],
                               "a string, b string, code int, need string")
    got = [tuple(r) for r in df.select(
        S.count_in(["a", "b"], ["Up", "Down"]), S.count_not(["a", "b"], "No"), S.flag(F.col("a") == "No"), S.null_if("a", "No"),
    ).collect()]
    assert got == [(1, 1, 1, None), (0, 0, 0, None), (1, 2, 0, "Down"), (0, 0, 1, None)]
    assert df.where(S.exclude({"code": [11]}, ["need"])).count() == 1  # the listed code, the NULL code and the NULL value go


def test_ordinal_and_names(spark):
    df = spark.createDataFrame([("Up",), ("odd",), (None,)], "m string")
    assert [r[0] for r in df.select(S.ordinal("m", ["No", "Steady", "Down", "Up"], -1)).collect()] == [3, -1, -1]
    assert [r[0] for r in df.select(S.ordinal("m", ["Up"])).collect()] == [0, None, None]
    got = one(spark, S.tidy_name(F.lit("numeric__num_lab_procedures"), ["numeric__"]), S.safe_name(F.lit("age_[0-10)<x")))
    assert tuple(got) == ("Num Lab Procedures", "age_(0-10)ltx")


def test_staging_keeps_none_as_value(spark, data):
    staged = stage(encounters(spark, data))
    assert staged.where("a1cresult = 'None'").count() > 0
    assert staged.where("race = '?' OR gender = 'Unknown/Invalid' OR diag_1 = '?'").count() == 0


def test_missing_outcome_defaults(spark, data):
    raw = encounters(spark, data).limit(1).withColumn("readmitted", F.lit(None).cast("string"))
    row = stage(raw).select("readmitted_30day", "readmitted_any").first()
    assert tuple(row) == (0, 1)
