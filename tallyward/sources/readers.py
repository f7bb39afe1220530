"""Scans. Schemas are declared, never inferred: inference reads the data twice."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.plans import encounter_rules as R

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in R.ID_COLUMNS]
    + [T.StructField(c, T.StringType()) for c in ("race", "gender", "age", "weight")]
    + [T.StructField(c, T.IntegerType()) for c in R.COUNT_COLUMNS[:4]]
    + [T.StructField(c, T.StringType()) for c in ("payer_code", "medical_specialty")]
    + [T.StructField(c, T.IntegerType()) for c in R.COUNT_COLUMNS[4:10]]
    + [T.StructField(c, T.StringType()) for c in ("diag_1", "diag_2", "diag_3")]
    + [T.StructField("number_diagnoses", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in R.LAB_COLUMNS + R.RAW_MEDICATIONS + ["change", "diabetesmed", "readmitted"]]
)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, null_value: str = "?", bad_rows: str = "FAILFAST"
) -> DataFrame:
    """CSV with header and a null token."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", null_value)
        .option("mode", bad_rows)
        .csv(path)
    )


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trimmed lower-case names with ``_`` for blanks and dashes, in one projection."""
    names = [re.sub(r"[ \-]", "_", c.strip().lower()) for c in df.columns]
    if len(set(names)) != len(names):
        clash = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"column names collide after normalising: {clash}")
    return df.toDF(*names)


def describe_load(df: DataFrame) -> DataFrame:
    """One row: how many rows and columns arrived."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def read_table(
    spark: SparkSession, name: str, fmt: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Catalog table, or a connector's table (``jdbc`` and the like), names lower-cased."""
    if fmt is None:
        df = spark.table(name)
    else:
        df = spark.read.format(fmt).options(**(options or {})).option("dbtable", name).load()
    return df.toDF(*[c.lower() for c in df.columns])


@dataclass
class SourceRegistry:
    """Declared sources: a logical name to a format and its location or options."""

    entries: dict[str, tuple[str, dict[str, str]]] = field(default_factory=dict)

    def declare(self, name: str, fmt: str, **options: str) -> SourceRegistry:
        self.entries[name] = (fmt, options)
        return self

    def load(self, spark: SparkSession, name: str, view: bool = False) -> DataFrame:
        if name not in self.entries:
            raise KeyError(f"undeclared source: {name}")
        fmt, options = self.entries[name]
        df = spark.table(options["table"]) if fmt == "table" else spark.read.format(fmt).options(**options).load()
        if view:
            df.createOrReplaceTempView(name)
        return df


def read_cached(spark: SparkSession, path: str, source: Callable[[], DataFrame]) -> DataFrame:
    """Parquet at ``path`` if it is there, else the source, written there first."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
    df = source()
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, split_col: str = R.SPLIT) -> DataFrame:
    """One split of a table partitioned by it: only that directory is read."""
    return spark.read.parquet(path).where(F.col(split_col) == split)


METRICS_SCHEMA = (
    "split string, n long, tau double, auc_roc double, auc_pr double, brier double, flagged_n long, "
    "flagged_rate double, flagged_pos_rate double, precision_tau double, recall_tau double, f1_tau double"
)


def read_metrics(spark: SparkSession, path: str, schema: str = METRICS_SCHEMA, document: bool = False) -> DataFrame:
    """Metric rows from JSON: one row per line, or with ``document`` one list per file."""
    return spark.read.schema(schema).option("multiLine", document).json(path)


def read_importance(spark: SparkSession, path: str, value: str = "mean_abs") -> DataFrame:
    return spark.read.schema(f"feature string, {value} double").option("header", True).csv(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Feature names, one per line."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.trim("value").alias("feature"))


def parse_requests(df: DataFrame, payload: str, instance: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """``{"instances": [{...}]}`` payloads to one row per instance.

    Missing keys become NULL, unlisted keys are ignored.
    """
    schema = T.StructType([T.StructField("instances", T.ArrayType(instance))])
    parsed = df.withColumn("__p", F.from_json(payload, schema))
    return parsed.select(*(keep or []), F.inline("__p.instances"))


def to_requests(df: DataFrame, cols: list[str], batch: Column) -> DataFrame:
    """Rows packed into request payloads, one per value of ``batch``.

    The caller picks a batch expression with a bounded number of rows each.
    """
    items = F.collect_list(F.struct(*cols)).alias("instances")
    return df.groupBy(batch.alias("request")).agg(F.to_json(F.struct(items)).alias("payload"))


def read_if_complete(spark: SparkSession, path: str, schema: str) -> list[Row]:
    """Rows of a small Parquet folder whose writer has finished; none if it is absent or half written."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        return []
    return spark.read.schema(schema).parquet(path).collect()
