"""What each feature adds to a network's probability: gradients summed along the line from a baseline to the row.

The gradient of the probability, averaged over the line and multiplied by the
way each feature goes, adds up to the difference of the two probabilities. The
average is a Gauss-Legendre sum. The same holds of every stretch of the line,
so a stretch that misses its own difference by more than a tolerance is halved:
a step of a steep network is closed in on, however narrow it is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POINTS = 16
HALVINGS = 40
_PLACES, _SHARES = np.polynomial.legendre.leggauss(POINTS)
_PLACES, _SHARES = (_PLACES + 1) / 2, _SHARES / 2
# interpolated rows times widest layer held at once
CELLS = 4_000_000


def layers_of(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(inputs x outputs, offsets) per layer, views of the weights."""
    found, at = [], 0
    for n_in, n_out in zip(sizes, sizes[1:]):
        stop = at + n_in * n_out
        # stored column by column, outputs first; the offsets follow
        found.append((flat[at:stop].reshape(n_in, n_out), flat[stop : stop + n_out]))
        at = stop + n_out
    if at != len(flat):
        raise ValueError("the weights do not fit the layers")
    return found


class Layers:
    """Weights of a fitted perceptron: sigmoid layers, then a softmax; as large as the model."""

    def __init__(self, model: MultilayerPerceptronClassificationModel):
        sizes = [int(n) for n in model.getLayers()]
        self.widest = max(sizes)
        self.layers = layers_of(model.weights.toArray(), sizes)

    def _activations(self, x: np.ndarray) -> list[np.ndarray]:
        found = [x]
        for k, (weights, offset) in enumerate(self.layers):
            z = found[-1] @ weights + offset
            if k < len(self.layers) - 1:
                found.append(0.5 * (1 + np.tanh(0.5 * z)))
            else:
                e = np.exp(z - z.max(axis=1, keepdims=True))
                found.append(e / e.sum(axis=1, keepdims=True))
        return found

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 per row."""
        return self._activations(x)[-1][:, 1]

    def gradient(self, x: np.ndarray) -> np.ndarray:
        """Derivative of the probability of class 1 by each input."""
        a = self._activations(x)
        p = a[-1]
        back = -p[:, 1:2] * p
        back[:, 1] += p[:, 1]
        for k in range(len(self.layers) - 1, -1, -1):
            back = back @ self.layers[k][0].T
            if k:
                back *= a[k] * (1 - a[k])
        return back

    def contributions(self, x: np.ndarray, baseline: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
        """rows x features, and what the sum of each row misses of the difference of probabilities."""
        way, width = x - baseline, x.shape[1]
        out, gap = np.zeros_like(way), np.zeros(len(x))
        step = max(1, CELLS // (self.widest * POINTS))
        # open stretches of the rows' lines, all of the same length
        rows, begin, length = np.arange(len(x)), np.zeros(len(x)), 1.0
        for halvings in range(HALVINGS + 1):
            again = []
            for at in range(0, len(rows), step):
                r, lo = rows[at : at + step], begin[at : at + step]
                line = baseline + (lo + length * _PLACES[:, None])[:, :, None] * way[r]
                slopes = self.gradient(line.reshape(-1, width)).reshape(POINTS, len(r), width)
                added = length * way[r] * np.tensordot(_SHARES, slopes, axes=1)
                ends = [self.probability(baseline + t[:, None] * way[r]) for t in (lo, lo + length)]
                missed = ends[1] - ends[0] - added.sum(axis=1)
                done = (np.abs(missed) <= tolerance) | (halvings == HALVINGS)
                np.add.at(out, r[done], added[done])
                np.add.at(gap, r[done], missed[done])
                again.append((r[~done], lo[~done]))
            length /= 2
            rows = np.concatenate([r for r, _ in again for _ in (0, 1)]) if again else rows
            begin = np.concatenate([lo + half for _, lo in again for half in (0.0, length)]) if again else begin
            if not len(rows):
                break
        return out, gap


def gradient_contributions(
    model: MultilayerPerceptronClassificationModel, df: DataFrame, features: str, keep: Sequence[str],
    baseline: Sequence[float] | None = None, tolerance: float = 1e-8,
) -> DataFrame:
    """The kept columns with ``contributions`` (an array in the order of the features), ``base`` and ``gap``.

    ``base`` is the probability at the baseline (zeros: the mean of scaled
    numbers, the first level of dummies). Base, contributions and gap add up to
    the row's probability; ``tolerance`` bounds what one stretch may miss before
    it is halved, at most HALVINGS times. Features must be complete.
    """
    net = Layers(model)
    width = net.layers[0][0].shape[0]
    start = np.zeros(width) if baseline is None else np.asarray(baseline, dtype=float)
    if start.shape != (width,):
        raise ValueError(f"the baseline needs {width} values")
    base = float(net.probability(start[None, :])[0])
    slim = df.select(*keep, vector_to_array(features).alias("__x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            added, gap = net.contributions(x, start, tolerance)
            limits = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
            columns = [*(batch.column(c) for c in keep), pa.ListArray.from_arrays(limits, pa.array(added.reshape(-1)))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.full(len(x), base)), pa.array(gap)], [*keep, "contributions", "base", "gap"]
            )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema.fields]
    return slim.mapInArrow(run, ", ".join([*kinds, "contributions array<double>", "base double", "gap double"]))


def gradient_attribution(model: MultilayerPerceptronClassificationModel, df: DataFrame, features: str, names: Sequence[str]) -> DataFrame:
    """(feature, mean_abs): mean size of each feature's contribution."""
    added = gradient_contributions(model, df, features, [])
    row = added.agg(
        F.array(*[
            F.struct(F.lit(n).alias("feature"), F.avg(F.abs(F.get("contributions", F.lit(i)))).alias("mean_abs")) for i, n in enumerate(names)
        ]).alias("r")
    )
    return row.select(F.inline("r"))
