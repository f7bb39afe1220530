import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators.quality import Accepted, NotNull, Unique, check_rules
from tallyward.session import cut_lineage, materialize, shared_root
from tallyward.sources import readers, sinks


def test_raw_schema_is_complete():
    assert len(readers.RAW_SCHEMA) == 50


def test_csv_null_token_keeps_none(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write("id,race,lab\n1,?,None\n2,Asian,Norm\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("race", T.StringType()), T.StructField("lab", T.StringType())])
    rows = [tuple(r) for r in readers.read_csv(spark, path, schema).orderBy("id").collect()]
    assert rows == [(1, None, "None"), (2, "Asian", "Norm")]


def test_column_names(spark):
    df = spark.range(1).select(F.lit(1).alias(" A-b C"), F.lit(2).alias("D "))
    assert readers.normalize_columns(df).columns == ["a_b_c", "d"]
    with pytest.raises(ValueError, match="collide"):
        readers.normalize_columns(df.select(F.lit(1).alias("A b"), F.lit(1).alias("a-b")))


def test_cached_read_writes_once(spark, tmp_path):
    calls = []

    def source():
        calls.append(1)
        return spark.range(5)

    path = str(tmp_path / "cache")
    assert readers.read_cached(spark, path, source).count() == 5
    assert readers.read_cached(spark, path, source).count() == 5
    assert len(calls) == 1


def test_registry_and_table_reads(spark, data, tmp_path):
    reg = readers.SourceRegistry().declare("orders_raw", "parquet", path=f"{data}/orders.parquet")
    n = reg.load(spark, "orders_raw", view=True).count()
    assert spark.table("orders_raw").count() == n
    with pytest.raises(KeyError):
        reg.load(spark, "nope")
    spark.range(2).select(F.col("id").alias("ID_X")).createOrReplaceTempView("upper_names")
    assert readers.read_table(spark, "upper_names").columns == ["id_x"]


def test_splits_prune_partitions(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") < 70, "train").otherwise("holdout").alias("split_group"))
    path = str(tmp_path / "splits")
    sinks.write_splits(df, path, "split_group")
    part = readers.read_split(spark, path, "train")
    assert part.count() == 70
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split_group" in plan


def test_reports_round_trip(spark, tmp_path):
    rows = [("train", 10, 0.1, 0.7), ("validation", 5, 0.1, 0.6), ("holdout", 4, 0.1, 0.5)]
    metrics = spark.createDataFrame(rows, "split string, n long, tau double, auc_roc double").coalesce(1)
    sinks.write_metrics(metrics, str(tmp_path / "m"))
    back = readers.read_metrics(spark, str(tmp_path / "m")).select(*metrics.columns).collect()
    assert sorted(map(tuple, back)) == sorted(rows)
    (tmp_path / "list.json").write_text('[{"split": "a", "n": 1}, {"split": "b", "n": 2}]')
    assert readers.read_metrics(spark, str(tmp_path / "list.json"), document=True).count() == 2
    ranked = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "feature string, mean_abs double")
    sinks.write_ranked(ranked, str(tmp_path / "r"), "mean_abs")
    assert {r.feature: r.mean_abs for r in readers.read_importance(spark, str(tmp_path / "r")).collect()} == {"a": 0.1, "b": 0.9}
    names = spark.createDataFrame([(1, "y"), (0, "x")], "position int, feature string")
    sinks.write_manifest(names, str(tmp_path / "t"))
    assert [r.feature for r in readers.read_manifest(spark, str(tmp_path / "t")).collect()] == ["x", "y"]
    maps = spark.range(1).select(F.create_map(F.lit("f"), F.lit(0.5)).alias("psi_by_feature"))
    sinks.write_metrics(maps, str(tmp_path / "d"))
    back = spark.read.schema("psi_by_feature map<string,double>").json(str(tmp_path / "d")).first()[0]
    assert back == {"f": 0.5}


def test_batches_as_json_directories(spark, tmp_path):
    df = spark.range(6).select("id", (F.floor(F.col("id") / 3) + 1).cast("int").alias("batch"))
    path = tmp_path / "b"
    sinks.write_batches(df, str(path))
    assert sorted(p.name for p in path.iterdir() if p.is_dir()) == ["batch=batch_01", "batch=batch_02"]


def test_publish_view_and_table(spark, tmp_path):
    assert sinks.publish(spark.range(3), "stg_x", "staging", "view").count() == 3
    with pytest.raises(ValueError):
        sinks.publish(spark.range(3), "x", "marts", "other")


def test_requests_fill_missing_keys(spark):
    df = spark.createDataFrame([('{"instances":[{"a":1,"extra":9},{"b":"x"}]}',)], "payload string")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert [tuple(r) for r in readers.parse_requests(df, "payload", schema).collect()] == [(1, None), (None, "x")]


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "z"), (2, "a")], "k int, v string")
    got = {(r.rule, r.column): (r.failures, r.status) for r in check_rules(df, [NotNull("k"), Unique("k"), Accepted("v", ("a",))]).collect()}
    assert got == {("not_null", "k"): (1, "fail"), ("unique", "k"): (1, "fail"), ("accepted_values", "v"): (1, "fail")}
    assert check_rules(df, [Unique("k")]).first()["failures"] == 1


def test_lineage_is_cut_in_the_shared_folder(spark):
    root = shared_root(spark)
    assert spark.sparkContext.getCheckpointDir() is not None and root
    df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert materialize(df, "t").count() == 10
