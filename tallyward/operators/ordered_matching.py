"""Matching in score order: treated rows from the largest score down, each with the nearest control left.

The order makes it look sequential, but it is not: taking away a control that a
treated row did not choose changes nothing for it. So the score line is cut
into blocks of treated rows, all blocks are solved side by side as if they came
first, and a block's result stands if no block above it took what it took.

A block of T treated rows can use at most T controls beyond either end of its
range, so it looks at the controls inside the range, at T more on each side,
and at none outside the caliper; neither a dense line nor a hot score makes a
task larger. What a round cannot settle is solved again with the controls that
are left. The uppermost open block always stands, and blocks meet at their ends
only, so a few rounds do; gaps wider than the caliper part them altogether.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.matching import expand
from tallyward.operators.ordered import running_totals
from tallyward.session import materialize

#: Treated rows and levels of a block.
BLOCK = 200_000
#: Segments of a block are numbered below this, so that (block, number) orders them all.
NUMBERS = 1 << 40


def match_in_order(df: DataFrame, key: str, treatment: str, score: str, caliper_sd: float = 0.1) -> DataFrame:
    """Pairs ``(treated, control, distance)`` within ``caliper_sd`` score deviations, no row used twice.

    Of equally near controls the one of the lower score is taken; rows of equal
    score and arm go by their ids. Rows without key, arm or score take no part.
    """
    base = df.dropna(subset=[key, treatment, score]).select(
        F.col(key).alias("id"), F.col(treatment).cast("int").alias("arm"), F.col(score).cast("double").alias("score")
    )
    caliper = base.agg(F.stddev_samp("score").alias("sd")).first()["sd"]
    limit = float("inf") if caliper is None else caliper_sd * caliper
    levels = base.groupBy("score").agg(F.count_if(F.col("arm") == 1).alias("n1"), F.count_if(F.col("arm") == 0).alias("n0"))
    # unequal arms apart, a level is work for its block; a hot one is cut into chunks
    work = running_totals(levels, "score", {"n1": F.sum("n1"), "n0": F.sum("n0"), "work": F.sum(F.col("n1") + 1)}, descending=True)
    line = materialize(work.select("score", "n1", "n0", (F.col("cum_work") - F.col("work")).alias("begin")), "score-line")
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n1") - 1) / BLOCK))
    treated = line.where("n1 > 0").withColumn("chunk", F.explode(chunks)).select(
        F.floor((F.col("begin") + F.col("chunk") * BLOCK) / BLOCK).alias("block"),
        F.col("score"),
        (F.col("chunk") * BLOCK).alias("rank"),
        F.least(F.col("n1") - F.col("chunk") * BLOCK, F.lit(BLOCK)).alias("n"),
    )
    treated = materialize(treated, "treated-blocks")
    left = line.where("n0 > 0").select("score", F.col("n0").alias("n"))
    segments, rounds = None, 0
    while not treated.isEmpty():
        rounds += 1
        found, open_blocks = _round(treated, left, limit)
        segments = found if segments is None else materialize(segments.unionByName(found), "segments")
        if not open_blocks:
            break
        used = found.groupBy("score_c").agg(F.sum("m").alias("used"))
        left = left.join(used, F.col("score") == F.col("score_c"), "left").select("score", (F.col("n") - F.coalesce("used", F.lit(0))).alias("n"))
        left = materialize(left.where("n > 0"), "controls-left")
        # the open blocks, a number for each, are as many as BLOCK makes of the line at most
        treated = materialize(treated.where(F.col("block").isin(open_blocks)), "treated-open")
    if segments is None:
        empty = "score_t double, rank_t long, score_c double, rank_c long, m long"
        return expand(base, df.sparkSession.createDataFrame([], empty))
    # controls of a level are used up in the order of blocks and, inside one, of segments
    order = segments.withColumn("at", F.col("block") * NUMBERS + F.col("number"))
    offsets = running_totals(order, "at", {"m": F.sum("m")}, ["score_c"]).select(
        "score_c", "at", (F.col("cum_m") - F.col("m")).alias("rank_c")
    )
    placed = order.join(offsets, ["score_c", "at"]).select("score_t", "rank_t", "score_c", "rank_c", "m")
    return expand(base, placed)


def _round(treated: DataFrame, left: DataFrame, limit: float) -> tuple[DataFrame, list[int]]:
    """Segments of the blocks that stand after this round, and the blocks that are open still."""
    line = treated.groupBy("score").agg(F.sum("n").alias("n1")).select("score", "n1", F.lit(0).cast("long").alias("n0"))
    line = line.unionByName(left.select("score", F.lit(0).cast("long").alias("n1"), F.col("n").alias("n0")))
    cum = materialize(running_totals(line, "score", {"n1": F.sum("n1"), "n0": F.sum("n0")}), "control-positions")
    at = treated.join(cum.where("n1 > 0").select("score", (F.col("cum_n0") - F.col("n0")).alias("below"), F.col("cum_n0").alias("upto")), "score")
    # a row per open block
    blocks = (
        at.groupBy("block")
        .agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.sum("n").alias("t"), F.min("below").alias("below"), F.max("upto").alias("upto"))
        .orderBy("block")
        .toPandas()
    )
    number = blocks["block"].to_numpy()
    window = _Windows(blocks, limit)

    def meets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            first, last = window.of(frame["score"].to_numpy(), frame["cum_n0"].to_numpy(), frame["n0"].to_numpy())
            times = np.maximum(last - first, 0)
            row = np.repeat(np.arange(len(frame)), times)
            index = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
            part = frame.iloc[row]
            yield pd.DataFrame({"block": number[index], "arm": 0, "score": part["score"].to_numpy(), "rank": 0, "n": part["n0"].to_numpy()})

    controls = cum.where("n0 > 0").select("score", "cum_n0", "n0").mapInPandas(meets, "block long, arm int, score double, rank long, n long")
    both = treated.select("block", F.lit(1).alias("arm"), "score", "rank", "n").unionByName(controls)

    def solved(frame: pd.DataFrame) -> pd.DataFrame:
        return solve(frame, limit)

    kinds = "block long, number long, score_t double, rank_t long, score_c double, m long"
    found = materialize(both.groupBy("block").applyInPandas(solved, kinds), "block-pairs")
    # who takes more of a control level than the blocks above leave of it
    use = found.groupBy("score_c", "block").agg(F.sum("m").alias("m"))
    taken = running_totals(use, "block", {"m": F.sum("m")}, ["score_c"])
    over = taken.join(left.select(F.col("score").alias("score_c"), "n"), "score_c").where("cum_m > n")
    clashing = {r[0] for r in over.select("block").distinct().collect()}
    reach = {r["block"]: (r["a"], r["b"]) for r in found.groupBy("block").agg(F.min("score_c").alias("a"), F.max("score_c").alias("b")).collect()}
    open_blocks: list[int] = []
    floor, ceiling = np.inf, -np.inf  # controls that open blocks above may still take
    for k, b in enumerate(number.tolist()):
        low, high = reach.get(b, (np.inf, -np.inf))
        if b in clashing or (low <= ceiling and high >= floor):
            open_blocks.append(b)
            a, c = window.scores(k)
            floor, ceiling = min(floor, a), max(ceiling, c)
    stands = found.where(~F.col("block").isin(open_blocks)) if open_blocks else found
    return materialize(stands, "standing"), open_blocks


class _Windows:
    """Which blocks look at a control level: ranges of score and of position, both falling with the block's number."""

    def __init__(self, blocks: pd.DataFrame, limit: float):
        self.lo = blocks["lo"].to_numpy() - limit
        self.hi = blocks["hi"].to_numpy() + limit
        # chunks of one level share its place, so ends are made to fall along the blocks
        self.from_position = np.minimum.accumulate((blocks["below"] - blocks["t"]).to_numpy()) if len(blocks) else np.empty(0)
        self.to_position = np.maximum.accumulate((blocks["upto"] + blocks["t"]).to_numpy()[::-1])[::-1] if len(blocks) else np.empty(0)

    def of(self, score: np.ndarray, upto: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First block and last block + 1 for control levels; a level's rows lie at positions upto - n .. upto."""
        # blocks fall: those at or above the level's needs come first
        first = np.searchsorted(-self.lo, -score, "left")
        last = np.searchsorted(-self.hi, -score, "right")
        first = np.maximum(first, np.searchsorted(-self.from_position, -upto, "right"))
        last = np.minimum(last, np.searchsorted(-self.to_position, -(upto - n), "left"))
        return first, last

    def scores(self, k: int) -> tuple[float, float]:
        return float(self.lo[k]), float(self.hi[k])


def solve(frame: pd.DataFrame, limit: float) -> pd.DataFrame:
    """Segments of one block: treated levels from the top, each with the nearest controls left.

    Levels that are used up are skipped by path halving, so the whole takes
    about as many steps as there are levels and segments.
    """
    block = int(frame["block"].iloc[0])
    treated = frame[frame["arm"] == 1].sort_values(["score", "rank"], ascending=[False, True])
    controls = frame[frame["arm"] == 0].sort_values("score")
    score, left = controls["score"].tolist(), controls["n"].tolist()
    size = len(score)
    below, above = list(range(size + 1)), list(range(size + 1))  # below[i]: a level under i that may be left; shifted by one

    def down(i: int) -> int:
        """Highest level with rows at or below i, -1 for none."""
        i += 1
        while below[i] != i:
            below[i] = below[below[i]]
            i = below[i]
        return i - 1

    def up(i: int) -> int:
        """Lowest level with rows at or above i, the size for none."""
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    out = []
    places = np.searchsorted(controls["score"].to_numpy(), treated["score"].to_numpy(), "right")
    for place, t, rank, n in zip(places.tolist(), treated["score"].tolist(), treated["rank"].tolist(), treated["n"].tolist()):
        while n:
            i, j = down(place - 1), up(place)
            near, far = (t - score[i] if i >= 0 else np.inf), (score[j] - t if j < size else np.inf)
            c, distance = (i, near) if near <= far else (j, far)
            if distance > limit or distance == np.inf:
                break
            m = min(n, left[c])
            out.append((block, len(out), t, rank, score[c], m))
            rank, n = rank + m, n - m
            left[c] -= m
            if not left[c]:
                below[c + 1], above[c] = c, c + 1
    return pd.DataFrame(out, columns=["block", "number", "score_t", "rank_t", "score_c", "m"])
