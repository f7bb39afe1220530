"""Catalog: sources and sinks. What is written is read back and checked against its source."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators.features import fit_features
from tallyward.operators.models import positive_probability
from tallyward.operators.ordered import ordered_batches
from tallyward.operators.profile import mean_abs_ranked
from tallyward.plans import catalog_evaluate, catalog_models, catalog_profile
from tallyward.plans import encounter_rules as R
from tallyward.plans import risk_model as K
from tallyward.plans.catalog_base import Catalog, mart, rounded, staged, with_steps
from tallyward.plans.catalog_drift import SQL_BATCHED
from tallyward.plans.mart import cohort, derive_features
from tallyward.session import scratch_path
from tallyward.sources import readers, sinks
from tallyward.sources.fixtures import table

catalog = Catalog()
query = catalog.query


@query("table_round_trip", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, d):
    upper = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").toDF("O_ORDERKEY", "O_CUSTKEY", "O_TOTALPRICE")
    sinks.write_table(upper, "tallyward_orders", path=scratch_path(spark, "table"))
    return readers.read_table(spark, "tallyward_orders")


@query(
    "published_layers",
    with_steps("features", "SELECT encounter_id, race, age_group, diag_1_group, num_meds_active FROM features"),
)
def _(spark, d):
    view = sinks.publish(staged(spark, d), "tallyward_stg_encounters", "staging", "view")
    columns = ["encounter_id", "race", "age_group", "diag_1_group", "num_meds_active"]
    built = derive_features(cohort(view)).select(*columns)
    return sinks.publish(built, "tallyward_features", "marts", "table", path=scratch_path(spark, "marts"))


@query(
    "declared_sources",
    "SELECT c_mktsegment, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
)
def _(spark, d):
    declared = readers.SourceRegistry()
    for name in ("orders", "customer"):
        declared.declare(name, "parquet", path=f"{d.rstrip('/')}/{name}.parquet")
    joined = declared.load(spark, "orders").join(declared.load(spark, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("cached_scan", "SELECT * FROM supplier")
def _(spark, d):
    path = scratch_path(spark, "cache")
    readers.read_cached(spark, path, lambda: table(spark, d, "supplier"))

    def unexpected():
        raise AssertionError("the cache was not used")

    return readers.read_cached(spark, path, unexpected)


@query(
    "split_files",
    with_steps("mart", "SELECT encounter_id, readmitted_30day, prob, split_group FROM mart WHERE split_group = 'train'"),
)
def _(spark, d):
    path = scratch_path(spark, "splits")
    sinks.write_splits(mart(spark, d, R.LABEL, "prob"), path, R.SPLIT)
    return readers.read_split(spark, path, "train").select(R.KEY, R.LABEL, "prob", R.SPLIT)


@query(
    "metrics_file",
    f"SELECT split_group AS split, * EXCLUDE (split_group) FROM ({catalog_evaluate.catalog.oracles['metric_rows']})",
)
def _(spark, d):
    path = scratch_path(spark, "metrics")
    rows = catalog_evaluate.catalog.queries["metric_rows"](spark, d)
    sinks.write_metrics(rows.withColumnRenamed(R.SPLIT, "split"), path)
    return readers.read_metrics(spark, path)


@query("importance_file", f"SELECT feature, mean_abs FROM ({catalog_profile.catalog.oracles['mean_abs_ranked']})")
def _(spark, d):
    path = scratch_path(spark, "importance")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ranked = rounded(mean_abs_ranked(table(spark, d, "lineitem"), columns), "mean_abs")
    sinks.write_ranked(ranked.select("feature", "mean_abs"), path, "mean_abs")
    return readers.read_importance(spark, path)


@query("manifest_file", f"SELECT feature FROM ({catalog_models.catalog.oracles['feature_manifest']})")
def _(spark, d):
    path = scratch_path(spark, "manifest")
    sinks.write_manifest(catalog_models.catalog.queries["feature_manifest"](spark, d), path)
    return readers.read_manifest(spark, path)


@query(
    "batch_files",
    with_steps("mart", "SELECT encounter_id, prob, printf('batch_%02d', batch) AS batch FROM bt", bt=SQL_BATCHED),
)
def _(spark, d):
    path = scratch_path(spark, "batches")
    holdout = mart(spark, d, "prob").where("split_group = 'holdout'").select(R.KEY, "prob")
    dealt = ordered_batches(holdout, R.KEY, 4).withColumn("batch", F.col("batch") + 1)
    sinks.write_batches(dealt, path)
    return spark.read.schema("encounter_id long, prob double, batch string").json(path)


@query(
    "model_versions",
    with_steps("mart", "SELECT split_group, COUNT(*) AS n, COUNT(*) AS n_equal FROM mart GROUP BY 1"),
)
def _(spark, d):
    # a saved version scores every row as the model in memory does
    m = mart(spark, d, R.LABEL, *catalog_models.SCALED)
    train = m.where("split_group = 'train'")
    plan = fit_features(train, catalog_models.SCALED, [], [])
    encoder = plan.model(m)
    encoded = encoder.transform(m)
    fitted = K.fit_logistic(encoded.where("split_group = 'train'"))
    root = scratch_path(spark, "versions")
    sinks.save_model(catalog_models.PipelineModel(stages=[fitted]), root, "v1")
    first = positive_probability(fitted, encoded, "first")
    both = positive_probability(sinks.load_model(root, "v1"), first, "second")
    return both.groupBy(R.SPLIT).agg(F.count("*").alias("n"), F.count_if(F.col("first") == F.col("second")).alias("n_equal"))
