"""Catalog: ingest, staging, cohort, quality rules, ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.scalar import count_in, count_not, group_map, row_sum, value_map
from tallyward.operators.cohort import split_summary
from tallyward.operators.ordered import ecdf_grid, global_rank, ordered_batches
from tallyward.operators.quality import check_rules
from tallyward.plans import encounter_rules as R
from tallyward.plans.catalog_base import (
    MEDS,
    SQL_ACTIVE,
    SQL_AGE_MIDPOINT,
    SQL_CHANGED,
    SQL_SPECIALTY,
    Catalog,
    features,
    mart,
    raw,
    rounded,
    sql_case_in,
    sql_diagnosis,
    sql_list,
    staged,
    with_steps,
)
from tallyward.plans.mart import (
    MART_RULES,
    STAGING_RULES,
    assign_split,
    cohort,
    deduplicate,
    diagnosis_group,
    specialty_group,
)
from tallyward.session import scratch_path
from tallyward.sources.fixtures import table
from tallyward.sources.readers import RAW_SCHEMA, describe_load, normalize_columns, parse_requests, read_csv, to_requests

catalog = Catalog()
query = catalog.query


@query("stage_clean", with_steps("staged", "SELECT * FROM staged"))
def _(spark, d):
    return staged(spark, d)


@query(
    "normalize_columns",
    "SELECT c_custkey AS cust_key, c_name AS customer_name, c_mktsegment AS market_segment, "
    "c_nationkey AS nation_key, c_acctbal AS acct_bal FROM customer",
)
def _(spark, d):
    messy = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Cust-Key"),
        F.col("c_name").alias(" Customer Name"),
        F.col("c_mktsegment").alias("Market Segment "),
        F.col("c_nationkey").alias("NATION-KEY"),
        F.col("c_acctbal").alias("Acct_Bal"),
    )
    return normalize_columns(messy)


CSV_COLUMNS = ["encounter_id", "race", "weight", "diag_1", "max_glu_serum", "number_inpatient"]
CSV_SCHEMA = T.StructType(
    [
        T.StructField("encounter_id", T.LongType()),
        T.StructField("race", T.StringType()),
        T.StructField("weight", T.StringType()),
        T.StructField("diag_1", T.StringType()),
        T.StructField("max_glu_serum", T.StringType()),
        T.StructField("number_inpatient", T.IntegerType()),
    ]
)


@query(
    "csv_null_token",
    with_steps(
        "enc",
        "SELECT encounter_id, NULLIF(race, '?') AS race, NULLIF(weight, '?') AS weight, "
        "NULLIF(diag_1, '?') AS diag_1, max_glu_serum, number_inpatient FROM enc",
    ),
)
def _(spark, d):
    path = scratch_path(spark, "csv")
    raw(spark, d).select(*CSV_COLUMNS).write.option("header", True).csv(path)
    return read_csv(spark, path, CSV_SCHEMA, null_value="?")


@query("load_summary", with_steps("enc", f"SELECT COUNT(*) AS n_rows, {len(RAW_SCHEMA)} AS n_columns FROM enc"))
def _(spark, d):
    return describe_load(raw(spark, d).drop("prob"))


INSTANCE = T.StructType(
    [
        T.StructField("encounter_id", T.LongType()),
        T.StructField("age", T.StringType()),
        T.StructField("number_inpatient", T.IntegerType()),
        T.StructField("not_sent", T.StringType()),
    ]
)


@query(
    "request_rows",
    with_steps(
        "enc",
        "SELECT encounter_id // 16 AS request, encounter_id, age, number_inpatient, "
        "CAST(NULL AS VARCHAR) AS not_sent FROM enc",
    ),
)
def _(spark, d):
    # sixteen encounters per payload, so a request stays small at any scale
    payloads = to_requests(
        raw(spark, d), ["encounter_id", "age", "number_inpatient", "insulin"], F.expr("encounter_id div 16")
    )
    return parse_requests(payloads, "payload", INSTANCE, keep=["request"])


@query("dedup_latest", with_steps("deduped", "SELECT * FROM deduped"))
def _(spark, d):
    return deduplicate(staged(spark, d))


@query("exclusions", with_steps("filtered", "SELECT * FROM filtered"))
def _(spark, d):
    return cohort(staged(spark, d))


@query(
    "band_map",
    with_steps(
        "staged",
        f"SELECT encounter_id, age, {SQL_AGE_MIDPOINT} AS age_midpoint, "
        f"{sql_case_in('age', R.AGE_GROUPS)} AS age_group, "
        f"{sql_case_in('admission_type_id', R.ADMISSION_GROUPS)} AS admission_type_group, "
        "COALESCE(race, 'Caucasian') AS race FROM staged",
    ),
)
def _(spark, d):
    return staged(spark, d).select(
        "encounter_id",
        "age",
        value_map("age", R.AGE_MIDPOINTS).alias("age_midpoint"),
        group_map("age", R.AGE_GROUPS).alias("age_group"),
        group_map("admission_type_id", R.ADMISSION_GROUPS).alias("admission_type_group"),
        F.coalesce("race", F.lit(R.RACE_DEFAULT)).alias("race"),
    )


@query("specialty_group", with_steps("staged", f"SELECT encounter_id, {SQL_SPECIALTY} AS specialty_group FROM staged"))
def _(spark, d):
    return staged(spark, d).select("encounter_id", specialty_group().alias("specialty_group"))


@query(
    "icd9_group",
    with_steps(
        "staged",
        f"SELECT encounter_id, diag_1, {sql_diagnosis('diag_1')} AS diag_1_group, "
        f"{sql_diagnosis('diag_2', 'None')} AS diag_2_group, "
        f"{sql_diagnosis('diag_3', 'None')} AS diag_3_group FROM staged",
    ),
)
def _(spark, d):
    return staged(spark, d).select(
        "encounter_id",
        "diag_1",
        diagnosis_group("diag_1").alias("diag_1_group"),
        diagnosis_group("diag_2", "None").alias("diag_2_group"),
        diagnosis_group("diag_3", "None").alias("diag_3_group"),
    )


@query(
    "rowwise_counts",
    with_steps(
        "staged",
        f"SELECT encounter_id, number_outpatient + number_emergency + number_inpatient AS total_prior_encounters, "
        f"{SQL_CHANGED} AS num_med_changes, {SQL_ACTIVE} AS num_meds_active FROM staged",
    ),
)
def _(spark, d):
    return staged(spark, d).select(
        "encounter_id",
        row_sum(["number_outpatient", "number_emergency", "number_inpatient"]).alias("total_prior_encounters"),
        count_in(MEDS, ["Up", "Down"]).alias("num_med_changes"),
        count_not(MEDS, "No").alias("num_meds_active"),
    )


@query("feature_mart", with_steps("mart", "SELECT * EXCLUDE (pr) FROM mart"))
def _(spark, d):
    return mart(spark, d)


@query("temporal_split", with_steps("mart", "SELECT encounter_id, split_group FROM mart"))
def _(spark, d):
    return assign_split(features(spark, d)).select("encounter_id", "split_group")


@query(
    "split_summary",
    with_steps(
        "mart",
        "SELECT split_group, COUNT(*) AS n, CAST(SUM(readmitted_30day) AS BIGINT) AS n_positive, "
        "ROUND(AVG(readmitted_30day), 6) AS positive_rate FROM mart GROUP BY split_group",
    ),
)
def _(spark, d):
    return rounded(split_summary(mart(spark, d, R.LABEL), R.SPLIT, R.LABEL, R.SPLIT_ORDER), "positive_rate")


def _sql_rules(rules, src):
    parts = []
    for r in rules:
        kind = type(r).__name__
        if kind == "NotNull":
            parts.append(f"SELECT 'not_null' AS rule, '{r.column}' AS \"column\", COUNT(*) FILTER (WHERE {r.column} IS NULL) AS failures FROM {src}")
        elif kind == "Accepted":
            parts.append(f"SELECT 'accepted_values', '{r.column}', COUNT(*) FILTER (WHERE {r.column} NOT IN ({sql_list(r.values)})) FROM {src}")
        else:
            parts.append(f"SELECT 'unique', '{r.column}', COUNT(*) FROM (SELECT {r.column} FROM {src} WHERE {r.column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)")
    union = " UNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({union})"


@query("dq_report", with_steps("staged", _sql_rules(STAGING_RULES, "staged")))
def _(spark, d):
    return check_rules(staged(spark, d), STAGING_RULES)


@query("dq_report_mart", with_steps("mart", _sql_rules(MART_RULES, "mart")))
def _(spark, d):
    return check_rules(mart(spark, d), MART_RULES)


@query(
    "two_level_rank",
    "SELECT o_orderstatus, o_totalprice, n, rk AS rank, rk + (n - 1) / 2.0 AS avg_rank FROM ("
    "SELECT o_orderstatus, o_totalprice, COUNT(*) AS n, CAST(COALESCE(SUM(COUNT(*)) OVER (PARTITION BY o_orderstatus "
    "ORDER BY o_totalprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) + 1 AS rk "
    "FROM orders GROUP BY o_orderstatus, o_totalprice)",
)
def _(spark, d):
    return global_rank(table(spark, d, "orders"), "o_totalprice", ["o_orderstatus"])


@query(
    "ordered_batches",
    "SELECT o_orderkey, CAST(LEAST(r // (n // 7), 6) AS INTEGER) AS batch FROM ("
    "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS r, COUNT(*) OVER () AS n FROM orders)",
)
def _(spark, d):
    return ordered_batches(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 7)


@query(
    "ecdf_grid",
    "SELECT o_orderstatus, ROUND(x, 6) AS x, ROUND(AVG(CASE WHEN v <= x THEN 1.0 ELSE 0.0 END), 6) AS cdf "
    "FROM (SELECT o_orderstatus, ((o_orderkey * 7919) % 300) / 1000.0 AS v FROM orders), "
    "(SELECT i * (0.5 / 499) AS x FROM range(500) t(i)) GROUP BY o_orderstatus, x",
)
def _(spark, d):
    scored = table(spark, d, "orders").select(
        "o_orderstatus", (((F.col("o_orderkey") * 7919) % 300) / 1000.0).alias("v")
    )
    return rounded(ecdf_grid(scored, "v", 0.0, 0.5, 500, ["o_orderstatus"]), "x", "cdf")
