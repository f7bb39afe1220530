"""One-to-one nearest-score matching without replacement, at any size.

The score is one-dimensional, so matching works on distinct scores with
counts: rows with the same score and arm are interchangeable up to their id
order. A score held by a third of all rows is then one row with a large count.

Pairs are taken in order of smallest distance (ties: lower score first). That
greedy result is unique and equals repeated rounds in which scores that choose
each other pair up, which is how it runs at every size. A score without an
opposite one inside the caliper leaves after its round: others only get fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.ordered import default_buckets, quantile_limits, running_totals, with_bucket
from tallyward.session import cut_lineage

CHUNK = 100_000  # pairs expanded per row


def match_pairs(df: DataFrame, key: str, treatment: str, score: str, caliper_sd: float = 0.1) -> DataFrame:
    """Pairs ``(treated, control, distance)`` within ``caliper_sd`` score deviations."""
    base = df.dropna(subset=[key, treatment, score]).select(
        F.col(key).alias("id"), F.col(treatment).cast("int").alias("arm"), F.col(score).cast("double").alias("score")
    )
    caliper = base.agg(F.stddev_samp("score").alias("sd")).first()["sd"]
    limit = float("inf") if caliper is None else caliper_sd * caliper

    levels = base.groupBy("score").agg(
        F.count_if(F.col("arm") == 1).alias("n1"), F.count_if(F.col("arm") == 0).alias("n0")
    )
    levels = cut_lineage(levels.withColumn("m", F.least("n1", "n0")))
    zero = F.lit(0).cast("long")
    segments = levels.where("m > 0").select(
        F.col("score").alias("score_t"), zero.alias("rank_t"), F.col("score").alias("score_c"), zero.alias("rank_c"), "m"
    )
    # after equal scores have paired, one arm at most is left at each score
    rest = levels.where("n1 <> n0").select(
        "score",
        F.when(F.col("n1") > F.col("n0"), 1).otherwise(0).alias("arm"),
        F.abs(F.col("n1") - F.col("n0")).alias("cnt"),
        F.col("m").alias("next"),
    )
    while True:
        step = cut_lineage(_mutual_nearest(rest, limit))
        found = step.where("m > 0 AND arm = 1")
        if found.isEmpty():
            return expand(base, segments)
        segments = segments.unionByName(
            found.select(
                F.col("score").alias("score_t"), F.col("next").alias("rank_t"),
                F.col("choice").alias("score_c"), F.col("choice_next").alias("rank_c"), "m",
            )
        )
        rest = step.where("cnt > m").select(
            "score", "arm", (F.col("cnt") - F.col("m")).alias("cnt"), (F.col("next") + F.col("m")).alias("next")
        )


def _mutual_nearest(rest: DataFrame, limit: float) -> DataFrame:
    """Scores with an opposite one inside the limit, their nearest and the rows ``m`` they pair with it.

    ``m`` is 0 where the nearest score has another one nearer to it.
    """
    buckets = default_buckets(rest)
    b = with_bucket(rest, "score", quantile_limits(rest, "score", buckets), buckets)
    up = Window.partitionBy("__bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("__bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)

    def of(arm: int) -> Column:
        return F.when(F.col("arm") == arm, F.col("score"))

    # nearest score of each arm outside the bucket: a row per bucket
    ends = b.groupBy("__bucket").agg(
        *[F.max(of(a)).alias(f"hi{a}") for a in (0, 1)], *[F.min(of(a)).alias(f"lo{a}") for a in (0, 1)]
    )
    before = Window.partitionBy(F.lit(1)).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(F.lit(1)).orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        "__bucket",
        *[F.max(f"hi{a}").over(before).alias(f"below{a}") for a in (0, 1)],
        *[F.min(f"lo{a}").over(after).alias(f"above{a}") for a in (0, 1)],
    )
    near = b.withColumns(
        {
            **{f"l{a}": F.last(of(a), ignorenulls=True).over(up) for a in (0, 1)},
            **{f"r{a}": F.last(of(a), ignorenulls=True).over(down) for a in (0, 1)},
        }
    ).join(carry, "__bucket")

    def opposite(inner: str, outer: str) -> Column:
        pick = [F.coalesce(f"{inner}{a}", f"{outer}{a}") for a in (0, 1)]
        return F.when(F.col("arm") == 1, pick[0]).otherwise(pick[1])

    s = F.col("score")
    left, right = opposite("l", "below"), opposite("r", "above")
    choice = F.when(right.isNull() | (s - left <= right - s), left).otherwise(right)
    chosen = near.select("score", "arm", "cnt", "next", choice.alias("choice")).where(
        F.abs(F.col("choice") - F.col("score")) <= F.lit(limit)
    )
    other = chosen.select(
        F.col("score").alias("o_score"), F.col("choice").alias("o_choice"), F.col("cnt").alias("o_cnt"),
        F.col("next").alias("choice_next"),
    )
    mutual = (F.col("choice") == F.col("o_score")) & (F.col("score") == F.col("o_choice"))
    return chosen.join(other, mutual, "left").select(
        "score", "arm", "cnt", "next", "choice", "choice_next",
        F.when(F.col("o_cnt").isNotNull(), F.least("cnt", "o_cnt")).otherwise(0).alias("m"),
    )


def expand(base: DataFrame, segments: DataFrame) -> DataFrame:
    """Ids for the matched (score, rank) positions.

    Ranks inside (score, arm) use the two-level order, so a hot score is
    spread over id buckets. Both joins are on unique keys.
    """
    ranked = running_totals(base, "id", {"one": F.count("*")}, ["score", "arm"]).select(
        "id", "score", "arm", (F.col("cum_one") - 1).alias("rank")
    )
    chunks = segments.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(CHUNK).cast("long"))))
    pairs = (
        chunks.repartition(F.col("score_t"), F.col("score_c"), F.col("at"))
        .withColumn("k", F.explode(F.sequence("at", F.least(F.col("at") + CHUNK, F.col("m")) - 1)))
        .select("score_t", (F.col("rank_t") + F.col("k")).alias("rank_t"), "score_c", (F.col("rank_c") + F.col("k")).alias("rank_c"))
    )
    t = ranked.where("arm = 1").select(F.col("id").alias("treated"), F.col("score").alias("score_t"), F.col("rank").alias("rank_t"))
    c = ranked.where("arm = 0").select(F.col("id").alias("control"), F.col("score").alias("score_c"), F.col("rank").alias("rank_c"))
    return (
        pairs.join(t, ["score_t", "rank_t"])
        .join(c, ["score_c", "rank_c"])
        .select("treated", "control", F.abs(F.col("score_t") - F.col("score_c")).alias("distance"))
    )


def matched_rows(df: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """Rows of the matched sample with their pair's treated id as ``pair``."""
    members = pairs.select(F.inline(F.array(
        F.struct(F.col("treated").alias(key), F.col("treated").alias("pair")),
        F.struct(F.col("control").alias(key), F.col("treated").alias("pair")),
    )))
    return df.join(members, key)


def match_counts(df: DataFrame, treatment: str, pairs: DataFrame) -> DataFrame:
    """Rows before and after matching per arm."""
    matched = pairs.agg(F.count("*")).scalar()
    return df.groupBy(treatment).agg(F.count("*").alias("n_before")).withColumn("n_after", matched)
