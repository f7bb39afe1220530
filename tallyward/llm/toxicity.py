"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, pairs of neighbours and pairs with one or
two words between them, hashed into ``2**BITS`` cells. Each coordinate has its
own rate, and the L1 penalty leaves most weights at zero. A bounded sample of
the documents with a label is learned in one run: runs over parts of it, each
with the whole penalty, lose the rare cells when their weights are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import lean, maybe_broadcast, mix, slices, text_batches, words

BITS = 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
EPOCHS = 3
#: Documents with a label that are learned from at most (those of least hash), and the shards they are dealt to.
TRAIN_ROWS = 20_000
SHARDS = 1
HELD_OUT = 5
_SKIPS = (1, 2, 3)


def features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every word, neighbour pair and skip pair, with repeats."""
    h, first = words(data, starts)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    shift = np.uint64(64 - BITS)
    cells, rows = [(mix(h + np.uint64(1)) >> shift).astype(np.int64)], [row]
    for gap in _SKIPS:
        pair = mix(h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:] + np.uint64(gap)) >> shift
        inside = row[:-gap] == row[gap:]
        cells.append(pair[inside].astype(np.int64))
        rows.append(row[:-gap][inside])
    return np.concatenate(rows), np.concatenate(cells)


def _present(row: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, cell), sorted."""
    key = np.unique((row << BITS) | cell)
    return key >> BITS, key & ((1 << BITS) - 1)


def _learner(alpha: float, beta: float, l1: float, l2: float, epochs: int):
    """FTRL-proximal over the rows of each shard; one row of weights per shard."""
    size = (1 << BITS) + 1  # the last cell is the intercept, which L1 spares

    def fitted(examples) -> pa.RecordBatch:
        z, n = np.zeros(size), np.zeros(size)
        penalty = np.full(size, l1)
        penalty[-1] = 0.0

        def weights(at):
            beyond = np.sign(z[at]) * np.maximum(np.abs(z[at]) - penalty[at], 0.0)
            return -beyond / ((beta + np.sqrt(n[at])) / alpha + l2)

        for _ in range(epochs):
            for at, y in examples:
                w = weights(at)
                g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - y
                grown = n[at] + g * g
                z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
                n[at] = grown
        w = weights(np.arange(size))
        at = np.flatnonzero(w)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([len(examples)], pa.int64()),
                pa.array([at.tolist()], pa.list_(pa.int64())),
                pa.array([w[at].tolist()], pa.list_(pa.float64())),
            ],
            ["rows", "cells", "weights"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, examples = None, []
        for batch in batches:
            labels, shards = batch.column("toxic").to_numpy(), batch.column("shard").to_numpy()
            for lo, hi, data, starts in slices(batch.column("text")):
                row, cell = _present(*features(data, starts))
                edge = np.searchsorted(row, np.arange(hi - lo + 1))
                for k in range(hi - lo):
                    if shards[lo + k] != shard:
                        if examples:
                            yield fitted(examples)
                        shard, examples = shards[lo + k], []
                    at = np.append(cell[edge[k] : edge[k + 1]], 1 << BITS)
                    examples.append((at.astype(np.int32), float(labels[lo + k])))
        if examples:
            yield fitted(examples)

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    alpha: float = ALPHA,
    beta: float = BETA,
    l1: float = L1,
    l2: float = L2,
    epochs: int = EPOCHS,
    shards: int = SHARDS,
    rows: int = TRAIN_ROWS,
) -> np.ndarray:
    """Weights per cell and the intercept in the last place, averaged over the shards.

    Rows without a label or id are not learned from. Without rows all weights are 0.
    """
    lab = labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("toxic"))
    lab = lab.where("l_id IS NOT NULL AND toxic IS NOT NULL").where(fold("l_id") != 0)
    drawn = lab.groupBy("l_id").agg(F.max("toxic").alias("toxic")).withColumn("draw", F.xxhash64("l_id"))
    # drawn among the labels that have a document, by ids alone
    here = drawn.join(docs.select(F.col(f"`{id_col}`").alias("id")), F.col("l_id") == F.col("id"), "left_semi")
    picked = maybe_broadcast(here.orderBy("draw").limit(rows), rows)
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    found = slim.join(picked, F.col("id") == F.col("l_id")).withColumn("shard", F.pmod(F.hash("draw"), F.lit(shards)))
    # other order than the deal, so that a shard is not learned in the order of its ids
    dealt = found.select("shard", "toxic", "text", "draw").repartition("shard").sortWithinPartitions("shard", "draw")
    learned = dealt.mapInArrow(lean(_learner(alpha, beta, l1, l2, epochs)), "rows long, cells array<long>, weights array<double>").collect()
    out, seen = np.zeros((1 << BITS) + 1), max(1, sum(r["rows"] for r in learned))
    for r in sorted(learned, key=lambda r: (r["rows"], len(r["cells"]), r["weights"][:1])):
        out[np.array(r["cells"], np.int64)] += np.array(r["weights"]) * (r["rows"] / seen)
    return out.astype(np.float32)


def fold(id_col: str):
    """crc32 of the id as text, modulo HELD_OUT; 0 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every document.

    Only nonzero weights travel to the tasks; their number is bounded by the
    hash space. Null and empty texts get the score of the intercept.
    """
    text_batches(docs.sparkSession)
    at = np.flatnonzero(weights).astype(np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((at, weights[at]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((1 << BITS) + 1, np.float32)
        dense[shared.value[0]] = shared.value[1]
        for batch in batches:
            for lo, hi, data, starts in slices(batch.column("text")):
                row, cell = features(data, starts)
                hit = dense[cell] != 0
                row, cell = _present(row[hit], cell[hit])
                z = np.bincount(row, weights=dense[cell], minlength=hi - lo) + float(dense[-1])
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return slim.mapInArrow(lean(run), "doc_id long, score double, predicted int")


def op6_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; a null doc_id is not held out; an empty table gives an empty result."""
    scored = score(docs, train(docs, labels))
    held = F.coalesce(fold("doc_id") == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")
