"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Slot ``t`` of the schedule is the point ``frac(t * golden ratio)``, mapped
through the cumulative target shares to a source. Slots are ranked per source.
Each source's documents, in hashed order, form a stream of words that is cut
into blocks of ``block`` words; the slot of rank ``r`` takes block ``r`` modulo
the number of blocks, so a source that is used up starts over. The last slot
of a source takes only the words that its target still lacks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import WORD, maybe_broadcast
from tallyward.session import materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK = 4096
ROWS_PER_BUCKET = 50_000
SOURCES_BOUND = 200_000
#: Cells of the grid on which points find their span, and slots that are ranked together.
CELLS = 4096
RANGE = 65_536
_GOLDEN = (math.sqrt(5) - 1) / 2


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, target) for one row per source.

    Targets are ``min(limit, level * weight)``, limit being MAX_EPOCHS times
    the source's size. The level at which they add up to the whole is found in
    closed form: in the order of limit / weight the sources below it are full.
    The windows run over one thin row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    ranked = sizes.withColumn("weight", F.element_at(weights, ((F.row_number().over(by_name) - 1) % len(WEIGHTS)) + 1))
    ranked = ranked.withColumn("limit", F.col("source_size") * float(MAX_EPOCHS))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = ranked.withColumns(
        {
            "total": F.sum("source_size").over(everything).cast("double"),
            "full": F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(rest),
        }
    ).withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    # the first source in this order whose own limit is not reached decides
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    level = F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), F.col("level").alias("level")))).over(everything)
    return levels.select(
        "source", "source_size", "weight", "limit", F.coalesce(level["level"], F.lit(float("inf"))).alias("level")
    ).select("source", "source_size", "weight", F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """(sid, rank): the slots of the mix, ranked per source in the order of the schedule.

    A source whose points are too few for its quota gets its missing slots at
    the end. Ranks are counted in ranges of the schedule first, as one source
    may hold most slots.
    """
    size, blocks = F.col("source_size"), F.ceil(F.col("source_size") / block)
    rounds = F.when(size > 0, F.floor(F.col("quota") / size)).otherwise(0)
    need = rounds * blocks + F.ceil((F.col("quota") - rounds * size) / block)
    spans = targets.withColumn("need", need.cast("long"))
    total = spans.agg(F.sum("need")).first()[0] or 0
    upto = F.sum("need").over(Window.orderBy("sid"))
    shares = spans.withColumn("upto", upto / F.lit(float(max(total, 1))))
    shares = shares.withColumn("from", F.coalesce(F.lag("upto").over(Window.orderBy("sid")), F.lit(0.0)))
    points = targets.sparkSession.range(total).select(
        F.col("id").alias("slot"), (F.col("id") * F.lit(_GOLDEN) % 1.0).alias("u")
    )
    # points and spans meet in the cells of a fixed grid
    cell_of = lambda c: F.least(F.floor(F.col(c) * CELLS), F.lit(CELLS - 1))
    cells = shares.where("need > 0").select(
        "sid", "from", "upto", F.explode(F.sequence(cell_of("from"), cell_of("upto"))).alias("cell")
    )
    hit = points.withColumn("cell", cell_of("u")).join(maybe_broadcast(cells, targets.count(), SOURCES_BOUND), "cell")
    hit = hit.where("u >= from AND u < upto").select("sid", "slot", F.floor(F.col("slot") / RANGE).alias("range"))
    within = Window.partitionBy("sid", "range").orderBy("slot")
    earlier = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = hit.groupBy("sid", "range").agg(F.count("*").alias("n"))
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    ranked = hit.withColumn("rank", F.row_number().over(within) - 1).join(offsets, ["sid", "range"])
    drawn = hit.groupBy("sid").agg(F.count("*").alias("drawn"))
    lacking = spans.join(drawn, "sid", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))).where("drawn < need")
    late = lacking.select("sid", F.explode(F.sequence("drawn", F.col("need") - 1)).alias("rank"))
    return ranked.select("sid", (F.col("rank") + F.col("offset")).alias("rank")).union(late)


def _stream_start(rows: DataFrame, n: int) -> DataFrame:
    """Adds ``start``: words before the row in its source's hashed order.

    A source is cut into ranges of the hash, so a hot one is many small
    windows; the totals of the ranges are added up in a second, thin step.
    """
    bits = max(0, math.ceil(math.log2(max(1, n / ROWS_PER_BUCKET))))
    part = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0)
    cut = rows.withColumn("part", part.cast("long"))
    inside = Window.partitionBy("sid", "part").orderBy("key", "tie", "row").rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    parts = cut.groupBy("sid", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("sid", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    return local.join(parts, ["sid", "part"]).select("row", "sid", "size", (F.col("start") + F.col("offset")).alias("start"))


def mix_sources(docs: DataFrame, block: int = BLOCK, seed: int = 42, carry: list[str] | None = None) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, the struct carry and row, a number that is stored.

    Defined results: a null text has no words and is never taken; documents
    without a source are a source of their own, the last; rows that repeat an
    id are separate documents side by side in the stream; an empty table gives
    an empty result. No document is taken more than MAX_EPOCHS times.
    """
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(0)
    slim = docs.select(
        "doc_id", "source", words.alias("size"), F.xxhash64("text").alias("tie"), carried.alias("carry"),
        F.monotonically_increasing_id().alias("row"),
    )
    stored = materialize(slim, "mix-sizes")
    sizes = stored.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = source_targets(sizes).withColumn("sid", F.row_number().over(by_name))
    targets = materialize(numbered.withColumn("quota", F.round("target").cast("long")), "mix-targets")
    count = targets.count()
    by_source = maybe_broadcast(targets.withColumnRenamed("source", "t_source"), count, SOURCES_BOUND)
    known = maybe_broadcast(targets.select("sid", "source_size", "quota"), count, SOURCES_BOUND)
    same_source = F.col("source").eqNullSafe(F.col("t_source"))

    thin = stored.where("size > 0").select(
        "row", "source", "size", "tie", F.xxhash64(F.lit(seed), "doc_id", "source").alias("key")
    )
    n = stored.count()
    placed = thin.join(by_source.select("t_source", "sid"), same_source).drop("source", "t_source")
    stream = materialize(_stream_start(placed, n), "mix-stream")

    blocks = F.ceil(F.col("source_size") / block).cast("long")
    slots = schedule(targets, block).join(known, "sid")
    slots = slots.withColumns({"epoch": F.floor(F.col("rank") / blocks), "b": F.col("rank") % blocks})
    length = F.least(F.lit(block), F.col("source_size") - F.col("b") * block)
    before = F.col("epoch") * F.col("source_size") + F.col("b") * block
    slots = slots.withColumn("upto", F.least(length, F.col("quota") - before)).where("upto > 0")
    # a block is taken whole in all its slots but perhaps the last one of its source
    uses = slots.groupBy("sid", "b").agg(
        F.count_if(F.col("upto") == length).alias("whole"),
        F.coalesce(F.max(F.when(F.col("upto") < length, F.col("upto"))), F.lit(0)).alias("part"),
    )
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = stream.withColumn("b", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("start") - F.col("b") * block, F.lit(0))
    hi = F.least(F.col("start") + F.col("size") - F.col("b") * block, F.lit(block))
    pieces = pieces.select("row", "sid", "b", lo.alias("lo"), hi.alias("hi"))
    partly = F.greatest(F.least("hi", "part") - F.col("lo"), F.lit(0))
    used = pieces.join(uses, ["sid", "b"]).withColumn("words", (F.col("hi") - F.col("lo")) * F.col("whole") + partly)
    taken = used.groupBy("row").agg(F.sum("words").alias("taken"))
    out = stored.join(by_source.select("t_source", "source_size", "target"), same_source).join(taken, "row", "left")
    return out.select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "carry", "row"
    )


def op7_mixing(docs: DataFrame) -> DataFrame:
    return mix_sources(docs.select("doc_id", "source", "text")).drop("carry", "row")
