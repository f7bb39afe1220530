"""Writes. Every sink is a distributed Spark write; nothing passes the driver."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, name: str, fmt: str = "parquet", **options: str) -> None:
    """Replace a catalog table."""
    df.write.mode("overwrite").format(fmt).options(**options).saveAsTable(name)


def publish(
    df: DataFrame, name: str, layer: str, materialized: str, database: str | None = None, **options: str
) -> DataFrame:
    """Staging models become views, mart models tables named by layer.

    With ``database`` the table lives in ``<database>_<layer>``; ``options``
    are the table's.
    """
    spark = df.sparkSession
    if materialized == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if materialized != "table":
        raise ValueError(f"unknown materialization: {materialized}")
    if database:
        schema = f"{database}_{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        name = f"{schema}.{name}"
    write_table(df, name, **options)
    return spark.table(name)


def write_splits(df: DataFrame, path: str, split: str) -> None:
    """One directory per split; readers of one split skip the others.

    ``rebalance`` lets AQE size the files and split a split that holds most
    of the rows, instead of one file per task and split.
    """
    df.hint("rebalance", F.col(split)).write.mode("overwrite").partitionBy(split).parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Report rows as JSON lines, map columns kept as objects."""
    df.write.mode("overwrite").json(path)


def write_ranked(df: DataFrame, path: str, by: str) -> None:
    """Ranked report as CSV with a header, largest value first."""
    df.orderBy(F.desc(by)).write.mode("overwrite").option("header", True).csv(path)


def write_manifest(names: DataFrame, path: str) -> None:
    """Feature names, one per line, in their order."""
    names.orderBy("position").select("feature").coalesce(1).write.mode("overwrite").text(path)


def write_batches(df: DataFrame, path: str, batch: str = "batch") -> None:
    """JSON lines per ordered batch, directories named ``batch_01`` and so on, files sized by AQE."""
    named = df.withColumn("__b", F.format_string("batch_%02d", F.col(batch)))
    named = named.drop(batch).withColumnRenamed("__b", batch).hint("rebalance", F.col(batch))
    named.write.mode("overwrite").partitionBy(batch).json(path)


def save_model(model: PipelineModel, root: str, version: str) -> str:
    """Fitted transformer and model under a version directory; returns its path."""
    path = f"{root.rstrip('/')}/{version}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{version}")
