"""Fits Spark's perceptron with array passes: the same start, loss and steps, weights instead of repeated rows.

Every evaluation of loss and gradient is one pass over stored blocks of rows,
dealt evenly to all cores; a task holds one block and the gradient, which is as
large as the model, and the driver adds one gradient per task. Networks of
several row sets, such as folds, go side by side: a pass evaluates the present
point of each that is not done. Spark's own estimator draws the initial weights
and holds the result, so that what is returned is its model.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.operators.network_paths import layers_of

#: Rows of one array pass.
BLOCK = 1024
#: Rows that a task stores about, where there are that many for every core.
TASK_ROWS = 1 << 16
#: Steps that the direction is built from.
MEMORY = 10
#: Values of the loss that have to lie close together at the end.
STEADY = 20
#: Most trials of a step's length: outwards, then inwards.
TRIALS = 10
#: Gradients that are added on the driver; more are added by tasks first.
DRIVER_GRADIENTS = 64
#: Rows from which array passes are faster than Spark's own fit.
MANY_ROWS = 1 << 14

Evaluate = Callable[[np.ndarray], tuple[float, np.ndarray]]
Evaluated = tuple[float, np.ndarray]
#: Yields points, is sent their loss and gradient, returns the last one.
Search = Generator[np.ndarray, Evaluated, np.ndarray]


class StepFailed(Exception):
    """No step along a direction lowers the loss enough."""


def copy_weights(copies: np.ndarray, stack: int) -> tuple[np.ndarray, int]:
    """Weight of every row of a partition and its number of stacks.

    The loss is the mean over stacks of ``stack`` rows, the last of a partition
    may be shorter, of each stack's mean. A row that stands for several copies
    weighs as much as they do together.
    """
    total = int(copies.sum())
    stacks = -(-total // stack)
    whole = total // stack * stack
    begin = np.cumsum(copies) - copies
    inside = np.clip(whole - begin, 0, copies)
    return inside / stack + (copies - inside) / max(total - whole, 1), stacks


class Passed:
    """Weighted cross entropy of rows and its derivative by the weights, added up block by block.

    Blocks of all networks of a task are worked on in the same ``space``:
    memory that is new to the process costs more than the arithmetic.
    """

    def __init__(self, flat: np.ndarray, sizes: Sequence[int], space: list[np.ndarray]):
        self.layers, self.space = layers_of(flat, sizes), space
        self.loss, self.gradient = 0.0, np.zeros(len(flat))
        self._slopes = layers_of(self.gradient, sizes)

    @staticmethod
    def space_for(sizes: Sequence[int], rows: int = BLOCK) -> list[np.ndarray]:
        """Room for the rows, the layers' values, what comes back through them and a layer's slopes."""
        largest = max(a * b for a, b in zip(sizes, sizes[1:]))
        return [*(np.empty(rows * n) for n in (*sizes, *sizes)), np.empty(largest)]

    def _room(self, i: int, *shape: int) -> np.ndarray:
        return self.space[i][: math.prod(shape)].reshape(shape)

    def add(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
        used = np.flatnonzero(w)
        n, last = len(used), len(self.layers)
        if not n:
            return
        if n < len(w):
            x, y, w = np.take(x, used, axis=0, out=self._room(0, n, x.shape[1]), mode="clip"), y[used], w[used]
        a = [x]
        for k, (weights, offset) in enumerate(self.layers, 1):
            z = np.matmul(a[-1], weights, out=self._room(k, n, len(offset)))
            z += offset
            if k < last:
                np.negative(z, out=z)
                np.exp(z, out=z)
                z += 1
                np.reciprocal(z, out=z)
            a.append(z)
        p = a.pop()
        p -= p.max(axis=1, keepdims=True)
        every = np.arange(n)
        own = p[every, y]
        np.exp(p, out=p)
        total = p.sum(axis=1, keepdims=True)
        self.loss += float((w * (np.log(total[:, 0]) - own)).sum())
        p /= total
        p[every, y] -= 1
        back = np.multiply(p, w[:, None], out=p)
        for k in range(last - 1, -1, -1):
            weights, (slopes, offsets) = self.layers[k][0], self._slopes[k]
            offsets += back.sum(axis=0)
            slopes += np.matmul(a[k].T, back, out=self._room(-1, *weights.shape))
            if k:
                back = np.matmul(back, weights.T, out=self._room(last + 1 + k, n, len(weights)))
                back *= a[k]
                np.subtract(1, a[k], out=a[k])
                back *= a[k]


def stored_blocks(df: DataFrame, label: str, features: str, copies: Column | Sequence[Column], stack: int, n: int, classes: int = 2):
    """Persisted blocks (features, labels, a row of weights per network) of the ``n`` rows, and each network's number of stacks."""
    copies = [copies] if isinstance(copies, Column) else copies
    count = len(copies)
    whole = F.col(label).cast("int")
    slim = df.select(
        vector_to_array(features).alias("x"), F.when(whole == F.col(label), whole).alias("y"), F.array(*[c.cast("long") for c in copies]).alias("n")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = lambda b, c: b.column(c).flatten().to_numpy(zero_copy_only=False)
        parts = []
        for b in batches:
            if not b.num_rows:
                continue
            if b.column("x").null_count or b.column("y").null_count:
                raise ValueError("a row has NULL features, or a label that is NULL or no class")
            x, y = flat(b, "x"), b.column("y").to_numpy(zero_copy_only=False)
            if not np.isfinite(x).all() or y.min() < 0 or y.max() >= classes:
                raise ValueError("a row has NaN or infinite features, or a label that is no class")
            parts.append((x, y, flat(b, "n").reshape(-1, count)))
        if not parts:
            return
        # labels and weights of the partition are whole, its features go out block by block
        found = [copy_weights(column, stack) for column in np.concatenate([n for _, _, n in parts]).T]
        weights, stacks = np.array([w for w, _ in found]), [v for _, v in found]
        at = 0
        for x, y, _ in parts:
            x = x.reshape(len(y), -1)
            for lo in range(0, len(y), BLOCK):
                part = slice(lo, lo + BLOCK)
                rows = [x[part].tobytes(), y[part].astype(np.int64).tobytes(), weights[:, at + lo : at + lo + len(y[part])].tobytes()]
                yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.binary()) for v in rows), pa.array([stacks], pa.list_(pa.int64()))], ["x", "y", "w", "stacks"])
                stacks = [0] * count
            at += len(y)

    def arrays(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        y = np.frombuffer(row["y"], np.int64)
        return np.frombuffer(row["x"]).reshape(len(y), -1), y, np.frombuffer(row["w"]).reshape(count, -1), np.array(row["stacks"])

    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = cores * max(1, -(-n // (cores * TASK_ROWS)))
    spread = slim.mapInArrow(run, "x binary, y binary, w binary, stacks array<long>").repartition(parts)
    blocks = spread.rdd.map(arrays).persist(StorageLevel.MEMORY_AND_DISK)
    return blocks, blocks.map(lambda b: b[3]).fold(np.zeros(count, np.int64), lambda a, b: a + b)


def direction(gradient: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Downhill direction from the last steps and what they did to the gradient, latest first."""
    out = gradient.copy()
    scale, shares = 1.0, []
    if history:
        step, change = history[0]
        along = step @ change
        if not along >= 0:
            raise StepFailed
        scale = along / (change @ change)
    for step, change in history:
        share = (step @ out) / (step @ change)
        if share != share:
            raise StepFailed
        shares.append(share)
        out -= share * change
    out *= scale
    for (step, change), share in zip(history[::-1], shares[::-1]):
        out += (share - (change @ out) / (step @ change)) * step
    return -out


def _between(a: tuple, b: tuple) -> float:
    """Least point of the cubic through two (length, value, slope), away from both ends."""
    (lo, f_lo, d_lo), (hi, f_hi, d_hi) = sorted((a, b))
    d1 = d_lo + d_hi - 3 * (f_lo - f_hi) / (lo - hi)
    with np.errstate(invalid="ignore", divide="ignore"):
        d2 = np.sqrt(np.float64(d1 * d1 - d_lo * d_hi))
        t = hi - (hi - lo) * (d_hi + d2 - d1) / (d_hi - d_lo + 2 * d2)
    return float(min(max(t, lo + 0.1 * (hi - lo)), lo + 0.9 * (hi - lo))) if t == t else float("nan")


def _length(at: Callable[[float], Generator[np.ndarray, Evaluated, tuple]], start: tuple, t: float) -> Generator[np.ndarray, Evaluated, float]:
    """Length of a step that meets the strong Wolfe conditions, ``t`` is tried first."""
    _, value, slope = start
    if slope > 0:
        raise StepFailed

    def inside(low: tuple, high: tuple) -> Generator[np.ndarray, Evaluated, float]:
        for _ in range(TRIALS):
            now = yield from at(_between(low, high))
            if now[1] > value + 1e-4 * now[0] * slope or now[1] >= low[1]:
                high = now
                continue
            if abs(now[2]) <= 0.9 * abs(slope):
                return now[0]
            if now[2] * (high[0] - low[0]) >= 0:
                high = low
            low = now
        raise StepFailed

    low = start
    for i in range(TRIALS):
        now = yield from at(t)
        if not np.isfinite(now[1]):
            t /= 2
            continue
        if now[1] > value + 1e-4 * t * slope or (now[1] >= low[1] and i):
            return (yield from inside(low, now))
        if abs(now[2]) <= 0.9 * abs(slope):
            return t
        if now[2] >= 0:
            return (yield from inside(now, low))
        low, t = now, t * 1.5
    raise StepFailed


def search_least(x: np.ndarray, steps: int, tolerance: float) -> Search:
    """Least point by limited-memory quasi-Newton steps, at most ``steps`` of them."""
    value, gradient = yield x
    first, values, history, failed = value, [np.inf], [], False
    done = 0
    while done < steps:
        steady = len(values) >= 2 and abs(value - max(values)) <= tolerance * abs(first)
        if steady or np.linalg.norm(gradient) <= max(tolerance * abs(value), 1e-8):
            break
        try:
            way = direction(gradient, history)
            tried: dict[float, tuple[float, np.ndarray]] = {}

            def at(t: float, x=x, way=way, tried=tried) -> Generator[np.ndarray, Evaluated, tuple[float, float, float]]:
                tried.clear()  # the length that is taken is the one tried last
                tried[t] = yield x + t * way
                return t, tried[t][0], float(tried[t][1] @ way)

            t = yield from _length(at, (0.0, value, float(gradient @ way)), 1.0 if done else 1 / np.linalg.norm(way))
            if t * np.linalg.norm(gradient) < 1e-10:
                raise StepFailed
        except StepFailed:
            if failed:
                break
            failed, history = True, []
            continue
        after, (value, slopes) = x + t * way, tried[t]
        history = [(after - x, slopes - gradient), *history][:MEMORY]
        x, gradient, failed, done = after, slopes, False, done + 1
        values = [*values, value][-STEADY:]
    return x


def minimise_all(evaluate: Callable[[dict[int, np.ndarray]], dict[int, Evaluated]], searches: Sequence[Search]) -> list[np.ndarray]:
    """Least point of several functions, whose present points are evaluated together until each is done."""
    points = {i: next(s) for i, s in enumerate(searches)}
    least: list = [None] * len(searches)
    while points:
        for i, found in evaluate(points).items():
            try:
                points[i] = searches[i].send(found)
            except StopIteration as end:
                least[i] = end.value
                del points[i]
    return least


def minimise(evaluate: Evaluate, x: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Least point of one function."""
    return minimise_all(lambda points: {0: evaluate(points[0])}, [search_least(x, steps, tolerance)])[0]


def fit_network(
    estimator: MultilayerPerceptronClassifier, df: DataFrame, copies: Column | None = None, many: int = MANY_ROWS
) -> MultilayerPerceptronClassificationModel:
    """The estimator's model of the rows, each standing for ``copies`` equal ones (default: one)."""
    return fit_networks(estimator, df, [F.lit(1) if copies is None else copies], many)[0]


def fit_networks(
    estimator: MultilayerPerceptronClassifier, df: DataFrame, copies: Sequence[Column], many: int = MANY_ROWS
) -> list[MultilayerPerceptronClassificationModel]:
    """A model per column of ``copies``: how many equal rows a row stands for in it, none with 0.

    All are fitted in the same passes. A model of fewer than ``many`` rows takes
    them repeated and the estimator. Both ways take the same steps; over
    hundreds of them the order of sums shows, as it does between two partitionings.
    """
    sizes_of = df.agg(*[F.count_if(c > 0) for c in copies]).first()
    few = [i for i, n in enumerate(sizes_of) if n < many]
    models: list = [None] * len(copies)
    if few:
        repeated = lambda c: df.where(c > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), c))).drop("__copy")
        with ThreadPoolExecutor(len(few)) as pool:
            task = inheritable_thread_target(df.sparkSession)(lambda i: estimator.fit(repeated(copies[i])))
            for i, model in zip(few, pool.map(task, few)):
                models[i] = model
    rest = [i for i in range(len(copies)) if i not in few]
    if rest:
        for i, model in zip(rest, _fit_together(estimator, df, [copies[i] for i in rest], max(sizes_of))):
            models[i] = model
    return models


def _fit_together(
    estimator: MultilayerPerceptronClassifier, df: DataFrame, copies: Sequence[Column], n: int
) -> list[MultilayerPerceptronClassificationModel]:
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    steps, sizes = estimator.getMaxIter(), list(estimator.getLayers())
    # the start does not depend on rows: one is enough to draw it, and blocks are checked as they are stored
    slim = df.select(label, features)
    one = df.sparkSession.createDataFrame(slim.limit(1).collect(), slim.schema).coalesce(1)
    begin = estimator.copy({estimator.maxIter: 0}).fit(one)
    blocks, stacks = stored_blocks(df, label, features, copies, estimator.getBlockSize(), n, sizes[-1])
    if not stacks.all():
        blocks.unpersist()
        return [begin] * len(copies)
    sc = df.sparkSession.sparkContext

    def evaluate(points: dict[int, np.ndarray]) -> dict[int, Evaluated]:
        sent = sc.broadcast(points)

        def part(rows):
            space = Passed.space_for(sizes)
            sums = {i: Passed(flat, sizes, space) for i, flat in sent.value.items()}
            for x, y, w, _ in rows:  # to the end: a worker whose rows are not all read is not used again
                for i, passed in sums.items():
                    passed.add(x, y, w[i])
            yield {i: (passed.loss, passed.gradient) for i, passed in sums.items()}

        add = lambda a, b: (a[0] + b[0], a[1] + b[1])
        each = lambda a, b: {i: add(a[i], b[i]) for i in a}
        sums = blocks.mapPartitions(part)
        if sums.getNumPartitions() * len(points) > DRIVER_GRADIENTS:
            found = sums.treeReduce(each)
        else:
            found = reduce(each, sums.collect())  # added in the order of the partitions: reruns agree
        sent.destroy()
        return {i: (loss / stacks[i], gradient / stacks[i]) for i, (loss, gradient) in found.items()}

    try:
        least = minimise_all(evaluate, [search_least(begin.weights.toArray(), steps, estimator.getTol()) for _ in copies])
    finally:
        blocks.unpersist()
    hold = lambda flat: estimator.copy({estimator.maxIter: 0, estimator.initialWeights: Vectors.dense(flat)}).fit(one)
    with ThreadPoolExecutor(len(least)) as pool:
        return list(pool.map(inheritable_thread_target(df.sparkSession)(hold), least))
