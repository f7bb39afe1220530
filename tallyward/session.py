"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on. Cluster sizing (executors, memory, shuffle
# partitions) is left to spark-submit; AQE coalesces and splits from there.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "tallyward", master: str | None = None, **conf: str) -> SparkSession:
    """Session with :data:`DEFAULT_CONF`; keyword settings win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of its own; on a cluster a machine-local folder
    would lose data together with the machine.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tallyward-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


_cleaned: set[str] = set()


def scratch_folder(spark: SparkSession) -> str:
    """The application's own folder for scratch tables; it goes when the driver ends."""
    folder = f"{shared_root(spark).rstrip('/')}/scratch/{spark.sparkContext.applicationId}"
    if folder not in _cleaned:
        _cleaned.add(folder)
        # held from now on: the context may be stopped before the driver's process ends
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        atexit.register(_remove, path, spark._jsc.hadoopConfiguration())
    return folder


def _remove(path, conf) -> None:
    try:
        path.getFileSystem(conf).delete(path, True)
    except (Py4JError, OSError):  # the JVM is gone already: the folder stays, under the application's name
        pass


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables of the application now.

    Frames that read them are void from then on. Results are lazy, so nothing
    is removed before its application ends unless the caller says so here,
    after the last result has been written.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the application's scratch folder, never reused."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (survives executor loss) and drop its plan."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later jobs then scan only the columns they need, which a row-format
    checkpoint cannot offer.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_parts(df: DataFrame, label: str, column: str, values: Sequence[str]) -> DataFrame:
    """``df`` written once as Parquet, a folder per value of ``column``, and read back; no other value may occur.

    Each value is a scan of its own: one write of all would sort every task's
    rows by the column first, and so hold them all.
    """
    path = scratch_path(df.sparkSession, label)
    for value in values:
        df.where(F.col(column) == value).drop(column).write.mode("errorifexists").parquet(f"{path}/{column}={value}")
    return df.sparkSession.read.schema(df.schema).parquet(path)
