"""Hard negatives: for anchors and their positives, high-scoring rows of another label inside a score window.

Candidates are augmented by the coordinate ``sqrt(M**2 - |x|**2)``, M being the
greatest norm, so all lie on one sphere and a large inner product is a small
distance. They are dealt to shards of bounded size around sampled pivots, and
each shard is a cover tree: a node has a centre among its points and a covering
radius, its children cover the node's points within ``1 / BASE`` of that radius,
and points that no other point joins at that level stay with the node.

A node's radius bounds the inner product of a query with all points below it.
A search takes nodes best bound first, leaves out those that lie outside every
window or cannot improve a full list, and scores the points of the others
exactly, in whole numbers. An anchor visits the shard of its best bound first;
what it finds there raises its windows before the others are visited.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import lean
from tallyward.session import materialize

POSITIVES = 5
NEGATIVES = 3
EVERY = 50
RELABEL = 7
LABELS = 10
#: Score window of a negative, in hundredths of the positive's score.
LOW, HIGH = 50, 95
SCALE = 256

#: Rows of a shard. Beyond SHARDS * SHARD_ROWS rows shards grow, so that their number, and with it what is sent to every task, is bounded.
SHARD_ROWS = 4096
SHARDS = 20_000
#: Labels are dealt to so many groups at most, each with shards of its own.
GROUPS = 1024
PIVOTS = 4096
BASE = 1.3
LEAF = 32
COVER_BLOCK = 256
#: Anchors that meet one copy of a shard.
ANCHORS = 4096
_LONG = (1 << 63) - 1


def _dense(rows: list, width: int, exact: bool) -> np.ndarray:
    """Vectors as rows of a matrix; missing trailing components are zero."""
    out = np.zeros((len(rows), width)) if exact else np.zeros((len(rows), width), object)
    for k, row in enumerate(rows):
        part = row[:width] if exact else [int(x) for x in row[:width]]
        out[k, : len(part)] = part
    return out


def _lifted(points: np.ndarray, top: float) -> np.ndarray:
    """The points with the coordinate that moves them onto the sphere of radius ``top``."""
    points = points.astype(float)
    return np.column_stack([points, np.sqrt(np.maximum(top * top - (points * points).sum(axis=1), 0.0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T), 0.0))


def _cover(lifted: np.ndarray, points: np.ndarray, radius: float) -> list[np.ndarray]:
    """Greedy cover: groups of points around centres (first of each group), each within ``radius`` of its centre."""
    groups = []
    while len(points):
        block = points[:COVER_BLOCK]
        near = _distances(lifted[block], lifted[block]) <= radius
        covered = np.zeros(len(block), bool)
        chosen = []
        for k in range(len(block)):
            if not covered[k]:
                chosen.append(k)
                covered |= near[k]
                covered[k] = True
        centres = block[chosen]
        far = _distances(lifted[points], lifted[centres])
        far[chosen, np.arange(len(chosen))] = 0.0
        nearest = far.argmin(axis=1)
        inside = far[np.arange(len(points)), nearest] <= radius
        for c in range(len(centres)):
            own = points[inside & (nearest == c)]
            groups.append(np.concatenate([centres[c : c + 1], own[own != centres[c]]]))
        points = points[~inside]
    return groups


def build_tree(lifted: np.ndarray) -> dict[str, np.ndarray]:
    """Cover tree over the lifted points.

    ``order`` lists the points so that each node's own ones are
    ``order[own[k]:own[k + 1]]``; ``centre`` and ``radius`` are by node, and
    ``children[first[k]:first[k + 1]]`` are a node's children.
    """
    order: list[np.ndarray] = []
    centre, radius, children = [], [], []
    waiting = [(np.arange(len(lifted)), -1)] if len(lifted) else []
    at = 0
    while at < len(waiting):  # nodes are numbered level by level
        points, above = waiting[at]
        if above >= 0:
            children[above].append(at)
        reach = _distances(lifted[points], lifted[points[:1]])[:, 0]
        reach[0] = 0.0
        r = float(reach.max())
        centre.append(int(points[0]))
        radius.append(r)
        children.append([])
        own = points
        if len(points) > LEAF and r > 0:
            parts = _cover(lifted, points, r / BASE)
            if len(parts) > 1:
                own = [p for p in parts if len(p) <= 2]
                waiting += [(p, at) for p in parts if len(p) > 2]
                own = np.concatenate(own) if own else np.empty(0, np.int64)
        order.append(own)
        waiting[at] = (None, above)
        at += 1
    sizes = np.array([len(x) for x in order], np.int64)
    counts = np.array([len(x) for x in children], np.int64)
    return {
        "order": np.concatenate(order) if order else np.empty(0, np.int64),
        "own": np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        "centre": np.array(centre, np.int64),
        "radius": np.array(radius, float),
        "children": np.array([c for x in children for c in x], np.int64),
        "first": np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
    }


def bounds(scores: np.ndarray, radius: np.ndarray, norm: float, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that a query of that norm can have with points within the radii of the centres.

    ``scores`` are its products with the centres. One bound is the query's norm
    times the radius, the other comes from the distance on the sphere, with the
    query stretched to its radius; the sharper one holds, a little widened
    against rounding.
    """
    slack = 1e-9 * norm * top + 1e-6
    low, high = scores - norm * radius, scores + norm * radius
    if norm > 0:
        d = np.sqrt(np.maximum(2 * top * top - 2 * scores * (top / norm), 0.0))
        near = np.maximum(d - radius, 0.0)
        far = np.minimum(d + radius, 2 * top)
        high = np.minimum(high, norm / top * (top * top - near * near / 2))
        low = np.maximum(low, norm / top * (top * top - far * far / 2))
    return low - slack, high + slack


def search(
    tree: dict, query: np.ndarray, norm: float, top: float, allowed: np.ndarray, low: list[int], high: list[int], most: int
) -> list[list[tuple]]:
    """Per window the first ``most`` (score, id, row) of the allowed points with low <= score <= high.

    Best first: scores descending, then ids, null ids last, then rows.
    """
    found: list[list[tuple]] = [[] for _ in low]  # (-score, id is null, id, row), sorted
    points, ids, rows = tree["points"], tree["ids"], tree["rows"]
    windows = range(len(low))

    def floor(w: int):
        return max(low[w], -found[w][-1][0]) if len(found[w]) == most else low[w]

    def wanted(lo: float, hi: float) -> bool:
        return any(lo <= high[w] and hi >= floor(w) for w in windows)

    def scores_of(at) -> np.ndarray:
        return points[at] @ query

    lo, hi = bounds(scores_of(tree["centre"][:1]).astype(float), tree["radius"][:1], norm, top)
    heap = [(-hi[0], lo[0], 0)]
    while heap:
        hi, lo, node = heapq.heappop(heap)
        if not wanted(lo, -hi):
            continue
        a, b = tree["own"][node], tree["own"][node + 1]
        own = tree["order"][a:b]
        own = own[allowed[own]]
        if len(own):
            s = scores_of(own)
            for w in windows:
                hit = np.flatnonzero((s >= floor(w)) & (s <= high[w]))
                if len(hit) > most:  # all that tie with the last one stay
                    least = np.sort(s[hit])[-most]
                    hit = hit[s[hit] >= least]
                if len(hit):
                    new = [(-int(s[k]), ids[own[k]] is None, ids[own[k]] or 0, rows[own[k]]) for k in hit]
                    found[w] = sorted(found[w] + heapq.nsmallest(most, new))[:most]
        under = tree["children"][tree["first"][node] : tree["first"][node + 1]]
        if len(under):
            los, his = bounds(scores_of(tree["centre"][under]).astype(float), tree["radius"][under], norm, top)
            for child, lo, hi in zip(under.tolist(), los.tolist(), his.tolist()):
                if wanted(lo, hi):
                    heapq.heappush(heap, (-hi, lo, child))
    return [[(-s, None if null else i, row) for s, null, i, row in x] for x in found]


def usable_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, id, label, v) of the rows that take part, components floored to whole numbers of 1 / SCALE."""
    v, label, vec_id = F.col(f"`{vector_col}`"), F.col(f"`{label_col}`").cast("long"), F.col(f"`{id_col}`").cast("long")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(v.isNotNull() & label.isNotNull() & finite)
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        vec_id.alias("id"),
        F.when(vec_id % RELABEL == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("v"),
    )


def _shards(rows: DataFrame, n: int, top: float, exact: bool) -> DataFrame:
    """(shard, group, centre, radius, tree): every row in one shard of bounded size, each a pickled cover tree."""
    size = max(SHARD_ROWS, math.ceil(n / SHARDS))
    grouped = rows.withColumn("group", F.pmod(F.xxhash64("label"), F.lit(GROUPS)).cast("int"))
    count = min(PIVOTS, math.ceil(n / size))
    # thinned first: each task would send as many rows as are wanted in all
    thin = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(max(1, n // (8 * max(count, 1))))) == 0
    drawn = grouped.where(thin).orderBy(F.xxhash64("row"), "row").limit(count).select("group", "v").collect()
    by_group: dict[int, list] = {}
    for r in drawn:
        by_group.setdefault(r["group"], []).append(r["v"])
    pivots = {}
    for g, vs in by_group.items():
        pivots[g] = _lifted(_dense(vs, max(map(len, vs)), True), top)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column("group").to_numpy()
            cell = np.zeros(batch.num_rows, np.int32)
            vs = batch.column("v").to_pylist()
            for g in np.unique(group):
                if (near := pivots.get(int(g))) is not None and len(near) > 1:
                    at = np.flatnonzero(group == g)
                    # leading components only, where vectors differ in length: a pivot just deals rows
                    own = _lifted(_dense([vs[k] for k in at], near.shape[1] - 1, True), top)
                    cell[at] = _distances(own, near).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    kinds = "row long, id long, label long, v array<double>, group int, cell int"
    celled = materialize(grouped.mapInArrow(lean(placed), kinds), "cells")
    # one row per pivot and group at most: PIVOTS + GROUPS
    parts = celled.groupBy("group", "cell").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    dealt = celled.join(F.broadcast(parts), ["group", "cell"]).withColumn("part", F.pmod(F.xxhash64("row"), "parts").cast("int"))
    key = ["group", "cell", "part"]
    sorted_rows = dealt.select(*key, "row", "id", "label", "v").repartition(*key).sortWithinPartitions(*key)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def emit() -> pa.RecordBatch:
            rows_, ids, labels, vs = zip(*held)
            points = _dense(list(vs), max(map(len, vs)), exact)
            lifted = _lifted(points, top)
            tree = build_tree(lifted)
            tree |= {"points": points, "ids": list(ids), "rows": list(rows_), "labels": np.array(labels, np.int64)}
            c = tree["centre"][0]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{now[0]}/{now[1]}/{now[2]}"]),
                    pa.array([now[0]], pa.int32()),
                    pa.array([[float(x) for x in points[c]]], pa.list_(pa.float64())),
                    pa.array([float(tree["radius"][0])]),
                    pa.array([pickle.dumps(tree, protocol=5)], pa.large_binary()).cast(pa.binary()),
                ],
                ["shard", "group", "centre", "radius", "tree"],
            )

        for batch in batches:
            for *shard, row, vec_id, label, v in zip(*(batch.column(c).to_pylist() for c in (*key, "row", "id", "label", "v"))):
                if shard != now:
                    if held:
                        yield emit()
                    held, now = [], shard
                held.append((row, vec_id, label, v))
        if held:
            yield emit()

    return sorted_rows.mapInArrow(lean(built), "shard string, group int, centre array<double>, radius double, tree binary")


class Index:
    """Stored shards of all usable rows, with what routing and searching need to know about them."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
        known = rows.agg(
            F.count("*"), F.max(size), F.max(F.array_max(F.transform("v", F.abs))), F.max(F.size("v"))
        ).first()
        self.n, square, largest, self.width = known[0], known[1] or 0.0, known[2] or 0.0, known[3] or 0
        self.top = math.sqrt(square)
        #: Whole numbers and their sums are exact in doubles up to 2**53; beyond it Python's integers are used.
        self.exact = largest * largest * max(self.width, 1) < 2.0**53
        self.shards = materialize(_shards(rows, self.n, self.top, self.exact), "shards")

    def nearest(self, queries: DataFrame, most: int, same_label: bool) -> DataFrame:
        """(anchor, w, score, id, row, place): the first ``most`` rows per query window.

        ``queries``: (anchor, label, v, lo, hi), arrays of window limits in ``lo``
        and ``hi``. Candidates have the query's label, its own row excluded, or
        another label.
        """
        first = self._visited(queries, most, same_label, seed=True)
        raised = first.where(F.col("place") == most).groupBy("anchor").agg(
            F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("found")
        )
        known = F.transform("lo", lambda x, w: F.greatest(x, F.try_element_at("found", w)))
        again = queries.join(raised, "anchor", "left").withColumn("lo", F.when(F.col("found").isNull(), F.col("lo")).otherwise(known)).drop("found")
        rest = self._visited(again, most, same_label, seed=False)
        return materialize(_first(first.drop("place").unionByName(rest.drop("place")), most), "found")

    def _visited(self, queries: DataFrame, most: int, same_label: bool, seed: bool) -> DataFrame:
        routed = materialize(self._routed(queries, same_label, seed), "routed")
        # one row per shard, and shards are bounded in number
        blocks = routed.groupBy("shard").agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("blocks"))
        blocks = materialize(blocks, "blocks")
        trees = self.shards.join(F.broadcast(blocks), "shard").select(
            "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "tree"
        )
        asked = routed.join(F.broadcast(blocks), "shard").withColumn("block", F.pmod(F.xxhash64("anchor"), "blocks").cast("int"))
        both = trees.unionByName(asked.drop("blocks"), allowMissingColumns=True)
        met = both.repartition("shard", "block").sortWithinPartitions("shard", "block", F.col("tree").isNull())
        top, width, exact = self.top, self.width, self.exact

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree: dict = {}
            for batch in batches:
                out = []
                columns = ("anchor", "label", "v", "lo", "hi")
                for k in range(batch.num_rows):
                    packed = batch.column("tree")[k]
                    if packed.is_valid:
                        tree = pickle.loads(packed.as_buffer())
                        continue
                    anchor, label, v, low, high = (batch.column(c)[k].as_py() for c in columns)
                    query = _dense([v], max(width, 1), exact)[0][: tree["points"].shape[1]]
                    if same_label:
                        allowed = tree["labels"] == label
                        allowed &= np.array(tree["rows"]) != anchor
                    else:
                        allowed = tree["labels"] != label
                    norm = math.sqrt(math.fsum(x * x for x in v))
                    for w, hits in enumerate(search(tree, query, norm, top, allowed, low, high, most)):
                        out += [(anchor, w, min(max(s, -_LONG), _LONG), i, row) for s, i, row in hits]
                if out:
                    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), types)], ["anchor", "w", "score", "id", "row"]
                    )

        hits = met.select("tree", "anchor", "label", "v", "lo", "hi").mapInArrow(
            lean(run), "anchor long, w int, score long, id long, row long"
        )
        return materialize(_first(hits, most), "hits")

    def _routed(self, queries: DataFrame, same_label: bool, seed: bool) -> DataFrame:
        """Queries once per shard that may hold rows of a window; the one of the best bound (seed) or all the others."""
        # at most SHARDS + PIVOTS + GROUPS thin rows
        roots = self.shards.select("shard", "group", "centre", "radius").orderBy("shard").collect()
        names = np.array([r["shard"] for r in roots])
        groups = np.array([r["group"] for r in roots], np.int64)
        radius = np.array([r["radius"] for r in roots], float)
        width, top = max(self.width, 1), self.top
        centres = _dense([r["centre"] for r in roots], width, True)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, shards = [], []
                vs = batch.column("v").to_pylist()
                scores = _dense(vs, width, True) @ centres.T if len(names) else np.zeros((len(vs), 0))
                lows, highs = batch.column("lo").to_pylist(), batch.column("hi").to_pylist()
                own = batch.column("group").to_numpy()
                for k, v in enumerate(vs):
                    lo, hi = bounds(scores[k], radius, math.sqrt(math.fsum(x * x for x in v)), top)
                    meets = np.zeros(len(names), bool)
                    best = np.full(len(names), -np.inf)
                    for a, b in zip(lows[k], highs[k]):
                        inside = (lo <= b) & (hi >= a)
                        meets |= inside
                        best = np.where(inside, np.maximum(best, np.minimum(hi, b)), best)
                    if same_label:
                        meets &= groups == own[k]
                    if not meets.any():
                        continue
                    # the seed does not depend on raised limits: it is the shard whose centre scores best
                    seeded = int(np.where(groups == own[k] if same_label else groups >= 0, scores[k], -np.inf).argmax())
                    chosen = [seeded] if seed else [s for s in np.flatnonzero(meets).tolist() if s != seeded]
                    rows += [k] * len(chosen)
                    shards += names[chosen].tolist()
                if rows:
                    taken = batch.take(pa.array(rows, pa.int64()))
                    columns = [pa.array(shards, pa.string()), *(taken.column(c) for c in ("anchor", "label", "v", "lo", "hi"))]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "anchor", "label", "v", "lo", "hi"])

        grouped = queries.withColumn("group", F.pmod(F.xxhash64("label"), F.lit(GROUPS)).cast("int"))
        kinds = "shard string, anchor long, label long, v array<double>, lo array<long>, hi array<long>"
        return grouped.select("anchor", "label", "v", "lo", "hi", "group").mapInArrow(lean(run), kinds)


def _first(hits: DataFrame, most: int) -> DataFrame:
    """The first ``most`` hits per anchor and window, numbered; the window keeps so many per task before its shuffle."""
    order = Window.partitionBy("anchor", "w").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Defined results: rows with a null label, a null vector or a component that
    is null or not finite take no part; missing trailing components count as
    zero; each row whose id is divisible by EVERY is an anchor of its own, also
    where ids repeat, and every other row of its label may be its positive;
    rows without an id are no anchors and come last among equal scores; a pair
    without negatives has no rows; sums beyond a long are held at its limits;
    an empty table gives an empty result; other columns are not read.
    """
    rows = materialize(usable_rows(vectors, id_col, vector_col, label_col), "vectors")
    index = Index(rows)
    anchors = rows.where(F.col("id") % EVERY == 0).select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "label", "v")
    anchors = materialize(anchors, "anchors")
    limit = lambda x: F.array(F.lit(x).cast("long"))
    open_queries = anchors.withColumns({"lo": limit(-_LONG), "hi": limit(_LONG)}).drop("anchor_id")
    positives = index.nearest(open_queries, POSITIVES, same_label=True).select(
        "anchor", (F.col("place") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # lo is the least whole number of at least LOW hundredths, hi the greatest of at most HIGH; below zero lo exceeds hi
    score = F.col("positive_score").cast("decimal(20,0)")
    limits = positives.select(
        "anchor",
        "w",
        F.when(F.col("positive_score") < 0, F.lit(1)).otherwise(F.ceil(score * LOW / 100)).cast("long").alias("lo"),
        F.when(F.col("positive_score") < 0, F.lit(0)).otherwise(F.floor(score * HIGH / 100)).cast("long").alias("hi"),
    )
    windows = limits.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("w", "lo", "hi"))).alias("x"))
    asked = anchors.join(windows, "anchor").select("anchor", "label", "v", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"))
    negatives = index.nearest(asked, NEGATIVES, same_label=False).select(
        "anchor", "w", F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = negatives.join(positives, ["anchor", "w"]).join(anchors.select("anchor", "anchor_id"), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_negatives(vectors: DataFrame) -> DataFrame:
    return hard_negatives(vectors)


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT * FROM (
  SELECT p.anchor_id, positive_id,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
         vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
       AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
) WHERE rank <= 3
"""
