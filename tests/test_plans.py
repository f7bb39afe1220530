"""Physical plans stay the ones meant: no hidden single-task stage, pruned scans."""

import re

from pyspark.sql import functions as F

from tallyward.operators import evaluate as E
from tallyward.operators import ordered as O
from tallyward.operators.profile import near_zero_variance
from tallyward.plans.mart import deduplicate, stage
from tallyward.sources.fixtures import encounters, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def main_part(text):
    """Plan without its scalar subqueries, which hold one row each."""
    out, skip = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and indent > skip:
            continue
        skip = indent if "Subquery subquery" in line and line.strip(" :+-").startswith("Subquery") else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


def test_running_totals_never_use_one_task_for_rows(spark, data):
    df = O.running_totals(table(spark, data, "orders"), "o_totalprice", {"n": F.count("*")}, ["o_orderstatus"])
    assert "SinglePartition" not in main_part(plan(df))


def test_deduplication_prunes_before_the_shuffle(spark, data):
    text = plan(deduplicate(stage(encounters(spark, data))))
    assert re.search(r"WindowGroupLimit.*Partial", text)
    assert text.count("Exchange hashpartitioning") == 1


def test_split_moves_no_rows(spark, data):
    df = O.fraction_split(table(spark, data, "orders"), "o_orderkey", [("train", 0.7)], "holdout")
    assert "Exchange" not in plan(df)


def test_scan_reads_only_needed_columns(spark, data):
    text = plan(stage(encounters(spark, data)).select("readmitted_30day"))
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>|ReadSchema: struct<o_orderkey:bigint>", text)


def test_dominance_shuffles_no_rows(spark, data):
    text = plan(near_zero_variance(table(spark, data, "part"), ["p_brand", "p_type"]))
    assert "Expand" not in text and "hashpartitioning" not in text


def test_threshold_metrics_need_no_ordering(spark, data):
    df = encounters(spark, data).select("prob", (F.col("readmitted") == "<30").cast("int").alias("y"), "race")
    text = plan(E.threshold_metrics(df, "prob", "y", 0.1, ["race"]))
    assert "Sort" not in text and "Window" not in text


def test_encounter_view_carries_every_medication(spark, data):
    from tallyward.plans import encounter_rules as R
    from tallyward.plans.risk_model import build_matrix
    from tallyward.plans.catalog_base import mart

    assert set(R.RAW_MEDICATIONS) <= set(encounters(spark, data).columns)
    names = build_matrix(mart(spark, data)).plan.names()
    assert {f"med_ord__{m}" for m in R.MODELLED_MEDICATIONS} <= set(names)


def test_batch_files_are_not_one_per_task(spark, data, tmp_path):
    from tallyward.sources import sinks

    df = table(spark, data, "orders").select("o_orderkey", F.lit(1).alias("batch")).repartition(16)
    sinks.write_batches(df, str(tmp_path / "b"))
    assert len(list((tmp_path / "b" / "batch=batch_01").glob("*.json"))) < 16
