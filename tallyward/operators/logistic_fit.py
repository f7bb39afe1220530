"""Fits many elastic-net logistic models of the same rows in shared passes, by the steps of Spark's own estimator.

A search over penalties and folds fits the same rows again and again. Here a
pass over stored blocks evaluates the present point of every model that is not
done: the blocks are read once, and the models' margins and slopes are two
products of matrices. As in Spark's estimator the features are centred and
scaled by their weighted deviation for the steps only, so that the penalty is
that of the features as they are; without an L1 share the steps are those of
``network_fit``, with one they stay in an orthant. The driver holds a vector
per model.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.network_fit import (
    BLOCK,
    DRIVER_GRADIENTS,
    MANY_ROWS,
    MEMORY,
    STEADY,
    TASK_ROWS,
    Search,
    StepFailed,
    direction,
    minimise_all,
    search_least,
)

#: Trials of a step's length that are allowed beyond the first.
TRIALS = 20
STEPS = 200
TOLERANCE = 1e-6


@dataclass(frozen=True)
class Penalised:
    """Settings of one model: the fold that it does not see, inverse penalty per unit weight, L1 share."""

    fold: int
    c: float
    l1_ratio: float


@dataclass(frozen=True)
class Scale:
    """Of one fold's other rows: class weights, their sum, and each feature's mean and inverse deviation (0: constant)."""

    weights: np.ndarray
    total: float
    mean: np.ndarray
    inverse: np.ndarray


def _penalised(x: np.ndarray, gradient: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """The gradient with the L1 term; at zero the side that leads downhill, or none."""
    at_zero = np.where(gradient - l1 > 0, gradient - l1, np.where(gradient + l1 < 0, gradient + l1, 0.0))
    return np.where(l1 == 0, gradient, np.where(x == 0, at_zero, gradient + np.sign(x) * l1))


def search_sparse(x: np.ndarray, l1: np.ndarray, steps: int, tolerance: float) -> Search:
    """Least point with an L1 penalty: quasi-Newton steps that do not leave the orthant they start in."""
    value, gradient = yield x
    whole, slopes = value + l1 @ np.abs(x), _penalised(x, gradient, l1)
    first, values, history, failed = whole, [np.inf], [], False
    done = 0
    while done < steps:
        steady = len(values) >= 2 and abs(whole - max(values)) <= tolerance * abs(first)
        if steady or np.linalg.norm(slopes) <= max(tolerance * abs(whole), 1e-8):
            break
        try:
            way = direction(slopes, history)
            way = np.where(way * slopes < 0, way, 0.0)
            orthant = np.where(x != 0, np.sign(x), -np.sign(slopes))
            downhill, t, shrink = slopes @ way, *((1.0, 0.5) if done else (0.5 / np.linalg.norm(gradient), 0.1))
            tried = value  # Spark's search takes the first length by its slope, and the smooth part's value before it
            for trial in range(TRIALS + 1):
                after = x + t * way
                after = np.where(np.sign(after) == np.sign(orthant), after, 0.0)
                found = yield after
                new_whole, new_slopes = found[0] + l1 @ np.abs(after), _penalised(after, found[1], l1)
                tried, along = (new_whole if trial else tried), new_slopes @ way
                if tried > whole + t * downhill * 1e-4 or (along >= 0.9 * downhill and along > -0.9 * downhill):
                    factor = shrink
                elif along < 0.9 * downhill:
                    factor = 2.1
                else:
                    break
                t *= factor
                if trial == TRIALS or not 1e-10 <= t <= 1e10:
                    raise StepFailed
        except StepFailed:
            if failed:
                break
            failed, history = True, []
            continue
        history = [(after - x, found[1] - gradient), *history][:MEMORY]
        x, (value, gradient), whole, slopes, failed, done = after, found, new_whole, new_slopes, False, done + 1
        values = [*values, whole][-STEADY:]
    return x


def _stored(df: DataFrame, label: str, features: str, fold: str, n: int):
    """Persisted blocks (features, labels, folds), dealt evenly to all cores."""
    slim = df.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"), F.col(fold).cast("int").alias("f"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y, f = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("y", "f"))
            for lo in range(0, len(y), BLOCK):
                part = [v[lo : lo + BLOCK].tobytes() for v in (x, y, f)]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in part], ["x", "y", "f"])

    def arrays(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        y = np.frombuffer(row["y"], np.int64)
        return np.frombuffer(row["x"]).reshape(len(y), -1), y, np.frombuffer(row["f"], np.int64)

    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = cores * max(1, -(-n // (cores * TASK_ROWS)))
    return slim.mapInArrow(run, "x binary, y binary, f binary").repartition(parts).rdd.map(arrays).persist(StorageLevel.MEMORY_AND_DISK)


def _summed(blocks, task) -> tuple:
    """What ``task`` gives for the blocks of each partition, added up."""
    each = lambda a, b: tuple(x + y for x, y in zip(a, b))
    found = blocks.mapPartitions(lambda rows: [task(rows)])
    return found.treeReduce(each) if found.getNumPartitions() > DRIVER_GRADIENTS else reduce(each, found.collect())


def _scales(blocks, counts: np.ndarray, width: int) -> list[Scale]:
    """Weights and scales of the rows outside each fold; ``counts`` has rows by fold and label."""
    k = len(counts)
    others = counts.sum(axis=0) - counts
    weights = others.sum(axis=1, keepdims=True) / (2 * others)
    totals = (others * weights).sum(axis=1)
    squares = (others * weights**2).sum(axis=1)

    def weighted(f: np.ndarray, y: np.ndarray) -> np.ndarray:
        w = weights[:, y].copy()
        w[f, np.arange(len(f))] = 0
        return w

    def sums(rows) -> tuple:
        found = np.zeros((k, width))
        for x, y, f in rows:
            found += weighted(f, y) @ x
        return (found,)

    means = _summed(blocks, sums)[0] / totals[:, None]

    def spreads(rows) -> tuple:
        found = np.zeros((k, width))
        for x, y, f in rows:
            for i, w in enumerate(weighted(f, y)):
                found[i] += w @ (x - means[i]) ** 2
        return (found,)

    deviations = np.sqrt(_summed(blocks, spreads)[0] / (totals - squares / totals)[:, None])
    inverse = np.divide(1, deviations, out=np.zeros_like(deviations), where=deviations > 0)
    return [Scale(*parts) for parts in zip(weights, totals, means, inverse)]


def _evaluated(x: np.ndarray, y: np.ndarray, w: np.ndarray, b: np.ndarray, offset: np.ndarray, room: list[np.ndarray]) -> tuple:
    """Weighted loss, slopes by feature and by offset of every model (a column each) on a block."""
    n = len(x)
    z, e, p = (r[: n * w.shape[1]].reshape(w.shape) for r in room)
    np.matmul(x, b, out=z)
    z += offset
    np.abs(z, out=e)
    np.negative(e, out=e)
    np.exp(e, out=e)
    # log(1 + exp(z)) - yz
    np.log1p(e, out=p)
    p += np.maximum(z, 0)
    p -= y[:, None] * z
    p *= w
    loss = p.sum(axis=0)
    # chance of class 1 less the label
    np.add(1, e, out=p)
    np.copyto(e, 1, where=z >= 0)
    e /= p
    e -= y[:, None]
    e *= w
    return loss, x.T @ e, e.sum(axis=0)


def fit_logistics(df: DataFrame, label: str, features: str, fold: str, k: int, models: Sequence[Penalised], many: int = MANY_ROWS) -> np.ndarray | None:
    """A row of coefficients and intercept per model, each of the rows outside its fold, classes weighted alike.

    None is left to the caller's own estimator: fewer than ``many`` rows, rows
    without label, features or fold, other labels than 0 and 1, or a fold whose
    other rows are of one class.
    """
    found = df.groupBy(fold, label).agg(F.count("*").alias("n"), F.count(features).alias("m")).collect()
    n = sum(r["n"] for r in found)
    odd = any(r[fold] not in range(k) or r[label] not in (0, 1) or r["m"] < r["n"] for r in found)
    if odd or n < many:
        return None
    counts = np.zeros((k, 2))
    for r in found:
        counts[int(r[fold]), int(r[label])] = r["n"]
    if not (counts.sum(axis=0) - counts).all():
        return None
    width = df.select(F.size(vector_to_array(features)).alias("n")).first()["n"]
    sc = df.sparkSession.sparkContext
    blocks = _stored(df, label, features, fold, n)
    try:
        scales = _scales(blocks, counts, width)
        penalties = [1.0 / (m.c * scales[m.fold].total) for m in models]

        def evaluate(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
            live = list(points)
            own = [scales[models[i].fold] for i in live]
            b = np.stack([points[i][:-1] * s.inverse for i, s in zip(live, own)], axis=1)
            offset = np.array([points[i][-1] - points[i][:-1] @ (s.mean * s.inverse) for i, s in zip(live, own)])
            # weight of a row by its fold and label in every model
            table = np.stack([np.repeat(s.weights[None], k, axis=0) for s in own], axis=2)
            for at, i in enumerate(live):
                table[models[i].fold, :, at] = 0
            sent = sc.broadcast((np.ascontiguousarray(b), offset, table))

            def task(rows) -> tuple:
                b, offset, table = sent.value
                room = [np.empty(BLOCK * len(offset)) for _ in range(3)]
                sums = (np.zeros(len(offset)), np.zeros(b.shape), np.zeros(len(offset)))
                for x, y, f in rows:
                    for total, part in zip(sums, _evaluated(x, y, table[f, y], b, offset, room)):
                        total += part
                return sums

            loss, slopes, level = _summed(blocks, task)
            sent.destroy()
            out = {}
            for at, (i, s) in enumerate(zip(live, own)):
                point, ridge = points[i][:-1] * s.inverse, penalties[i] * (1 - models[i].l1_ratio)
                by_feature = slopes[:, at] * s.inverse - s.mean * s.inverse * level[at]
                value = loss[at] / s.total + 0.5 * ridge * float(point @ point)
                out[i] = (value, np.append(by_feature / s.total + ridge * point * s.inverse, level[at] / s.total))
            return out

        searches = []
        for m, penalty in zip(models, penalties):
            s, start = scales[m.fold], np.zeros(width + 1)
            others = counts.sum(axis=0) - counts[m.fold]
            start[-1] = np.log(others[1] * s.weights[1] / (others[0] * s.weights[0]))
            if m.l1_ratio:
                searches.append(search_sparse(start, np.append(penalty * m.l1_ratio * s.inverse, 0.0), STEPS, TOLERANCE))
            else:
                searches.append(search_least(start, STEPS, TOLERANCE))
        least = minimise_all(evaluate, searches)
    finally:
        blocks.unpersist()
    out = []
    for m, point in zip(models, least):
        s = scales[m.fold]
        out.append(np.append(point[:-1] * s.inverse, point[-1] - point[:-1] @ (s.mean * s.inverse)))
    return np.array(out)


def held_out_scores(df: DataFrame, label: str, features: str, fold: str, k: int, settings: Sequence[tuple[float, float]], many: int = MANY_ROWS) -> DataFrame | None:
    """Rows (trial, fold, label, prob): every row scored under each setting (c, L1 share) by the model that did not see its fold.

    All models are fitted in shared passes; None where ``fit_logistics`` leaves them to the caller.
    """
    models = [Penalised(i, c, share) for c, share in settings for i in range(k)]
    fitted = fit_logistics(df, label, features, fold, k, models, many)
    if fitted is None:
        return None
    by_fold = fitted.reshape(len(settings), k, -1).transpose(1, 2, 0)  # fold x feature x trial

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            f = batch.column("fold").to_numpy(zero_copy_only=False)
            p = np.empty((len(x), len(settings)))
            for i in range(k):
                own = np.flatnonzero(f == i)
                z = np.repeat(by_fold[i, -1][None], len(own), axis=0)
                for j, b in enumerate(by_fold[i, :-1]):  # feature by feature: equal rows get equal scores
                    z += x[own, j, None] * b
                p[own] = 1 / (1 + np.exp(-z))
            limits = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(settings))
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("y"), pa.ListArray.from_arrays(limits, pa.array(p.reshape(-1)))], ["fold", "y", "p"])

    slim = df.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("int").alias("y"), vector_to_array(features).alias("x"))
    scored = slim.mapInArrow(run, "fold int, y int, p array<double>")
    return scored.select("fold", F.col("y").alias(label), F.posexplode("p").alias("trial", "prob")).select("trial", "fold", label, "prob")
