"""Structured Streaming jobs: request scoring and windowed drift counts."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallyward.operators.drift import PsiReference, cell_counts, drift_report
from tallyward.operators.tagged import score_counts
from tallyward.session import materialize
from tallyward.sources.readers import parse_requests
from tallyward.streaming import store
from tallyward.streaming.store import latest  # noqa: F401  part of this module's interface


def read_requests(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of text lines, one request payload each."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).withColumnRenamed("value", "payload")


def score_requests(
    requests: DataFrame, instance: T.StructType, model: PipelineModel, tau: float, keep: Sequence[str] = ()
) -> DataFrame:
    """Payload rows to one prediction per instance; stateless, works on streams and tables."""
    rows = parse_requests(requests, "payload", instance)
    scored = model.transform(rows)
    p = vector_to_array("probability")[1]
    return scored.select(*keep, F.round(p, 6).alias("probability"), (p >= F.lit(tau)).alias("flagged"))


def run_available(
    stream: DataFrame, checkpoint: str, sink: str, mode: str = "append", fmt: str = "parquet"
) -> StreamingQuery:
    """Process everything that has arrived into a file sink, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .format(fmt)
        .option("checkpointLocation", checkpoint)
        .option("path", sink)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_updates(
    stream: DataFrame, checkpoint: str, sink: str, keys: Sequence[str] = (), values: Sequence[str] = (), compact_every: int = 0
) -> StreamingQuery:
    """Update mode into per-batch directories; :func:`latest` reads the state back.

    With ``compact_every`` the directories are merged into a base after so many batches.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        store.write_batch(df, sink, batch_id)
        if compact_every and store.open_batches(df.sparkSession, sink) >= compact_every:
            store.compact(df.sparkSession, sink, keys, values)

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def windowed(stream: DataFrame, ts: str, width: str, lateness: str, out: str = "window_start") -> DataFrame:
    """Event-time window start on every row, rows later than the watermark left to the state to drop.

    Zone-less timestamps are read as UTC: a watermark needs a zoned type.
    """
    zoned = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    return zoned.withColumn("__w", F.window(ts, width)).withColumn(out, F.col("__w.start"))


def window_totals(stream: DataFrame, ts: str, width: str, lateness: str, group: str, value: str) -> DataFrame:
    """Rows and value sum per event-time window and group."""
    w = windowed(stream, ts, width, lateness)
    return w.groupBy("__w", group).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(
        F.col("__w.start").alias("window_start"), group, "n", "total"
    )


def window_cell_counts(
    stream: DataFrame, ts: str, width: str, lateness: str, reference: Sequence[PsiReference]
) -> DataFrame:
    """Counts per (window, feature, bin) of the fitted reference.

    The state a drift monitor keeps is this small table, not the rows. PSI
    follows from it at any time with ``psi_from_counts``.
    """
    w = windowed(stream, ts, width, lateness)
    return cell_counts(reference, w, "__w").select(F.col("__w.start").alias("window_start"), "feature", "cell", "c")


def run_drift_reports(
    stream: DataFrame,
    reference: DataFrame,
    psi_reference: Sequence[PsiReference],
    key: str,
    score: str,
    label: str,
    tau: float,
    checkpoint: str,
    sink: str,
) -> StreamingQuery:
    """A drift report per arriving batch of scored rows against a stored reference.

    The bins are fitted beforehand, and the reference's scores are counted once
    before the stream starts. Each report is one row in a directory named by
    its batch, so a replay after a failure replaces it. For reports by event
    time see ``windows.run_window_counts``.
    """
    features = [ref.feature for ref in psi_reference]
    scores = materialize(score_counts(reference, score), "score-reference")

    def report(df: DataFrame, batch_id: int) -> None:
        out = drift_report(None, df, key, score, label, features, 1, tau, psi_reference, scores)
        store.write_batch(out.drop("batch"), sink, batch_id)

    query = (
        stream.writeStream.foreachBatch(report)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


class LateRows(StreamingQueryListener):
    """Rows that state operators dropped for being late, added up over every batch of a run.

    Register it before the query starts. The progress a query keeps itself
    covers its last batches only.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._sums: dict[str, int] = defaultdict(int)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._sums[str(progress.runId)] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def total(self, query: StreamingQuery, timeout: float = 60.0) -> int:
        """Sum of a finished run; its end is the last event that the listener sees."""
        run = str(query.runId)
        if not self._ended[run].wait(timeout):
            raise TimeoutError(f"run {run} has not ended")
        return self._sums[run]
