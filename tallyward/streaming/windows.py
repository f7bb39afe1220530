"""Drift reports by event-time window from keyed state.

The state of a window is what a report needs and nothing else: counts per
distinct score (rows, positives, negatives) and per feature and bin of the
fitted reference. It is keyed by window and shard, rows being dealt to shards
by their score, so a busy window is spread over tasks. A batch emits the
totals that it changed; when the watermark passes a window's end its state is
dropped, and rows that come later are left out and counted (``LateRows``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyward.operators.drift import PsiReference, cell_columns, fit_psi_reference, psi_from_counts, report_periods
from tallyward.operators.tagged import score_counts
from tallyward.session import materialize
from tallyward.streaming.jobs import run_updates, windowed
from tallyward.streaming.store import latest

SHARDS = 8
KEYS = ("window_start", "shard", "kind", "item")
VALUES = ("n", "pos", "neg")
_OUT = "window_start timestamp, shard int, kind int, item double, n long, pos long, neg long"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class DriftReference:
    """What reports compare with: fitted bins and the stored score counts."""

    bins: Sequence[PsiReference]
    scores: DataFrame


def fit_reference(reference: DataFrame, score: str, features: Sequence[str]) -> DriftReference:
    """Bins and score counts of the reference, which is not read again."""
    return DriftReference(fit_psi_reference(reference, features), materialize(score_counts(reference, score), "score-reference"))


class WindowCounts(StatefulProcessor):
    """Running totals of one (window, shard): kind 0 counts scores, kind i the bins of feature i."""

    def __init__(self, features: int, width_ms: int):
        self.features = features
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getMapState("totals", "kind int, item double", "n long, pos long, neg long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        window, shard = key
        if not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(int(window.timestamp() * 1000) + self.width_ms)
        seen: dict[tuple[int, float], list[int]] = {}
        for frame in rows:
            pos, neg = (frame["y"] == 1).astype("int64"), (frame["y"] == 0).astype("int64")
            for kind, column in enumerate(["score", *(f"cell{i}" for i in range(1, self.features + 1))]):
                given = frame[column].notna()
                parts = pd.DataFrame({"item": frame[column][given], "n": 1, "pos": pos[given], "neg": neg[given]})
                for item, n, p, q in parts.groupby("item").sum().itertuples():
                    sums = seen.setdefault((kind, float(item)), [0, 0, 0])
                    sums[0] += int(n)
                    sums[1] += int(p)
                    sums[2] += int(q)
        out = []
        for at, sums in seen.items():
            if self.totals.containsKey(at):
                sums = [a + b for a, b in zip(sums, self.totals.getValue(at))]
            self.totals.updateValue(at, tuple(sums))
            out.append((window, shard, *at, *sums))
        yield pd.DataFrame(out, columns=[*KEYS, *VALUES])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.totals.clear()
        yield pd.DataFrame([], columns=[*KEYS, *VALUES])

    def close(self) -> None:
        pass


def window_counts(
    stream: DataFrame, ts: str, width: str, lateness: str, score: str, label: str, reference: DriftReference
) -> DataFrame:
    """Changed totals (window_start, shard, kind, item, n, pos, neg) of every batch."""
    rows = windowed(stream, ts, width, lateness)
    cells = cell_columns({ref.feature: ref.edges for ref in reference.bins})
    slim = rows.select(
        # the window carries the event time: a row is late when its window has ended, as in a windowed aggregate
        "__w",
        "window_start",
        F.pmod(F.xxhash64(score), F.lit(SHARDS)).cast("int").alias("shard"),
        F.col(score).cast("double").alias("score"),
        F.col(label).cast("double").alias("y"),
        *[c.cast("double").alias(f"cell{i}") for i, c in enumerate(cells.values(), 1)],
    )
    width_ms = rows.sparkSession.sql(f"SELECT unix_millis(timestamp_micros(0) + INTERVAL {width})").first()[0]
    return slim.groupBy("window_start", "shard").transformWithStateInPandas(
        WindowCounts(len(reference.bins), width_ms), _OUT, "Update", "EventTime"
    )


def run_window_counts(counts: DataFrame, checkpoint: str, sink: str, compact_every: int = 0) -> StreamingQuery:
    """Process everything that has arrived into the store at ``sink``. Keyed map state needs the RocksDB state store."""
    conf = counts.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)
    try:
        return run_updates(counts, checkpoint, sink, KEYS, VALUES, compact_every)
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)


def window_reports(spark: SparkSession, sink: str, reference: DriftReference, tau: float) -> DataFrame:
    """One report row per window from the stored totals."""
    totals = materialize(latest(spark, sink, KEYS, VALUES), "window-totals")
    totals = totals.groupBy("window_start", "kind", "item").agg(*[F.sum(v).alias(v) for v in VALUES])
    # a row per window
    windows = [r[0] for r in totals.select("window_start").distinct().orderBy("window_start").collect()]
    scores = totals.where("kind = 0").select("window_start", F.col("item").alias("score"), *VALUES)
    names = F.array(*[F.lit(ref.feature) for ref in reference.bins])
    cells = totals.where("kind > 0").select(
        "window_start", F.get(names, F.col("kind") - 1).alias("feature"), F.col("item").cast("int").alias("cell"), F.col("n").alias("c")
    )
    shifts = psi_from_counts(reference.bins, cells, "window_start")
    return report_periods(reference.scores, scores, shifts, "window_start", windows, tau)
