"""Near-duplicate groups: MinHash bands, signature check, exact confirmation, components.

Equal shingle sets are one class before anything else, so copies cost nothing
further. Each class has ``BANDS * ROWS`` universal hash minima; classes that
share a band are candidates. Candidates are found in two passes that together
cover every pair of every band but form no pair needlessly:

1. In each band value every class is paired with the least class there (a
   star), checked by signature, confirmed on the full sets, and joined into
   components.
2. Band values whose members still lie in several components are compared in
   blocks, signature against signature, for members of different components
   only. What passes is confirmed on full sets and joined to the rest.

A pair of similarity 0.75 shares no band with probability 1e-6 and fails the
signature check with 1e-4; both fall steeply above it (0.78: 2e-8 and 1e-8).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import distinct_sorted, lean, maybe_broadcast, mix, shingles, slices, text_batches, words
from tallyward.llm.components import components
from tallyward.session import materialize

WIDTH = 5
THRESHOLD_PERCENT = 75
ROWS = 5
BANDS = 51
#: Minima of a signature, kept as two bits each; the first BANDS * ROWS make the bands.
MINIMA = 4 * BANDS * ROWS
#: Share of equal two-bit entries a pair must reach to be confirmed on full sets. At similarity s it is
#: s + (1 - s) / 4 on average with deviation 0.012 at the threshold; this is 3.7 deviations below it.
SIGNATURE_SHARE = 0.7675
BLOCK = 256
#: Sets with more rows than one in HOT_SETS of all (and HOT_ROWS at least) are hot, so there are fewer than HOT_SETS.
HOT_SETS = 10_000
HOT_ROWS = 1000

_rng = np.random.default_rng(20240229)
_MULTIPLY = (_rng.integers(1, 1 << 32, MINIMA, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, sorted distinct shingle hashes, row limits) of whole texts."""
    for lo, hi, data, starts in slices(column):
        h, first = words(data, starts)
        yield lo, hi, *distinct_sorted(*shingles(h, first, WIDTH))


def _minima(x: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """rows x hashes minima of (a * x + b) mod 2**32; rows without shingles keep the maximum."""
    n = len(limits) - 1
    out = np.full((n, MINIMA), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(limits))
    if len(full):
        x = (x >> np.uint64(32)).astype(np.uint32)
        at = limits[full]
        buffer = np.empty_like(x)
        for k in range(MINIMA):
            np.multiply(x, _MULTIPLY[k], out=buffer)
            np.add(buffer, _ADD[k], out=buffer)
            out[full, k] = np.minimum.reduceat(buffer, at)
    return out


def _packed(minima: np.ndarray) -> np.ndarray:
    """Two well-mixed bits of each minimum, four to a byte."""
    bits = ((minima * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint8)
    return bits[:, 0::4] | bits[:, 1::4] << 2 | bits[:, 2::4] << 4 | bits[:, 3::4] << 6


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of equal two-bit entries of packed rows."""
    differ = x ^ y
    return 1.0 - np.bitwise_count((differ | differ >> 1) & np.uint8(0x55)).sum(axis=-1) / MINIMA


def _binary(matrix: np.ndarray) -> pa.Array:
    """A row of bytes per matrix row."""
    n, width = matrix.shape
    offsets = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * width)
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(matrix))])


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, x, limits in shingle_sets(batch.column("text")):
            sums = [np.zeros(len(limits), np.uint64) for _ in range(2)]
            one, two = (np.concatenate([[np.uint64(0)], np.cumsum(mix(x ^ np.uint64(s)))]) for s in (0x5BD1E995, 0x1B873593))
            sums = [(c[limits[1:]] - c[limits[:-1]]) for c in (one, two)]
            minima = _minima(x, limits)
            bands = np.zeros((hi - lo, BANDS), np.uint64)
            for r in range(ROWS):
                bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + minima[:, r : BANDS * ROWS : ROWS] + np.uint64(1))
            bands = mix(bands + np.arange(BANDS, dtype=np.uint64))
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(hi - lo + 1, dtype=np.int32) * BANDS), _longs(bands.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(lo, hi - lo),
                    batch.column("tie").slice(lo, hi - lo),
                    pa.array(np.diff(limits)),
                    _longs(sums[0]),
                    _longs(sums[1]),
                    flat,
                    _binary(_packed(minima)),
                ],
                ["id", "tie", "n", "s1", "s2", "bands", "signature"],
            )


def _signature_rows(column: pa.Array) -> np.ndarray:
    data = np.frombuffer(column.buffers()[2], np.uint8)
    width = MINIMA // 4
    return data.reshape(-1, width)[column.offset : column.offset + len(column)] if len(column) else np.empty((0, width), np.uint8)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose signatures agree often enough."""
    for batch in batches:
        if batch.num_rows:
            same = _agreement(_signature_rows(batch.column("x")), _signature_rows(batch.column("y")))
            yield batch.select(["a", "b"]).filter(pa.array(same >= SIGNATURE_SHARE))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    for batch in batches:
        left = ((lo, x, c) for lo, _, x, c in shingle_sets(batch.column("x")))
        sets: list[np.ndarray] = []
        for _, x, c in left:
            sets += [x[i:j] for i, j in zip(c[:-1], c[1:])]
        keep = np.zeros(batch.num_rows, bool)
        cache: dict[int, np.ndarray] = {}
        right = batch.column("y")
        ids = batch.column("b").to_pylist()
        for k, key in enumerate(ids):
            if key not in cache:
                cache = {key: next(shingle_sets(right.slice(k, 1)))[2]}
            both = len(np.intersect1d(sets[k], cache[key], assume_unique=True))
            keep[k] = 100 * both >= THRESHOLD_PERCENT * (len(sets[k]) + len(cache[key]) - both)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similar pairs inside sorted (band, i, j) groups whose members lie in different components.

    A pair that shares several bands is looked at in the first of them only.
    """
    held: list[pa.RecordBatch] = []

    def pairs(table: pa.Table):
        cut = {c: table.column(c).to_numpy() for c in ("band", "i", "j", "own", "id", "component", "n", "k")}
        marks = np.ascontiguousarray(table.column("marks").combine_chunks().flatten().to_numpy()).reshape(-1, BANDS)
        signature = _signature_rows(table.column("signature").combine_chunks())
        edge = np.flatnonzero(
            (np.diff(cut["band"]) != 0) | (np.diff(cut["i"]) != 0) | (np.diff(cut["j"]) != 0)
        ) + 1
        found = []
        for lo, hi in zip([0, *edge], [*edge, len(cut["band"])]):
            own = cut["own"][lo:hi]
            i, j = cut["i"][lo], cut["j"][lo]
            left = lo + np.flatnonzero(own == i)
            right = left if i == j else lo + np.flatnonzero(own == j)
            for k in left:
                other = right[cut["component"][right] != cut["component"][k]]
                if i == j:
                    other = other[other > k]
                small, large = np.minimum(cut["n"][other], cut["n"][k]), np.maximum(cut["n"][other], cut["n"][k])
                other = other[100 * small >= THRESHOLD_PERCENT * large]
                at = cut["k"][lo]
                other = other[~(marks[other, :at] == marks[k, :at]).any(axis=1)]
                if len(other):
                    hit = other[_agreement(signature[other], signature[k]) >= SIGNATURE_SHARE]
                    found += [(cut["id"][k], cut["id"][h]) for h in hit]
        return found

    def emit(table):
        found = pairs(table)
        a = np.array([min(p) for p in found], np.int64)
        b = np.array([max(p) for p in found], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        last = [table.column(c)[-1].as_py() for c in ("band", "i", "j")]
        keys = [table.column(c).to_numpy() for c in ("band", "i", "j")]
        open_from = int(np.argmax((keys[0] == last[0]) & (keys[1] == last[1]) & (keys[2] == last[2])))
        if open_from:
            yield emit(table.slice(0, open_from))
        held = table.slice(open_from).combine_chunks().to_batches()
    if held:
        yield emit(pa.Table.from_batches(held))


def _checked(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs of classes that pass the signature and then the full sets, stored.

    Texts are fetched once, for the classes of pairs that passed the signature.
    """
    sig = classes.select("id", "signature")
    similar = materialize(
        pairs.join(sig.toDF("a", "x"), "a").join(sig.toDF("b", "y"), "b").mapInArrow(lean(_similar), "a long, b long"),
        "similar",
    )
    return _confirm(similar, classes, docs)


def _confirm(similar: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs whose classes' own texts reach the threshold; a text is found by its document and hash."""
    wanted = similar.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = materialize(wanted.join(classes.select("id", "doc", "tie"), "id"), "wanted")
    wanted = maybe_broadcast(wanted.withColumnRenamed("id", "class"), wanted.count())
    found = docs.join(wanted, (docs["id"] == wanted["doc"]) & (docs["tie"] == wanted["tie"])).select(F.col("class").alias("id"), "text")
    # repeated rows hold one text several times
    texts = materialize(found.dropDuplicates(["id"]), "texts")
    with_left = similar.join(texts.toDF("a", "x"), "a")
    both = with_left.join(texts.toDF("b", "y"), "b")
    return materialize(both.mapInArrow(lean(_confirmed), "a long, b long"), "links")


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("tie"), text.cast("binary").alias("text"))


def _groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, tie (hash of its text), n, class_id, component_id and group, the number of its component.

    A class is a shingle set. It is numbered by one of its rows and known by
    its two hashes; ids label classes and components but join nothing, so that
    texts which share an id keep their own links.
    """
    text_batches(docs.sparkSession)
    slim = _slim(docs, id_col, text_col)
    kinds = "id long, tie long, n long, s1 long, s2 long, bands array<long>, signature binary"
    base = materialize(slim.mapInArrow(lean(_sketches), kinds).withColumn("row", F.monotonically_increasing_id()), "minhash")
    usable = base.where("n > 0 AND id IS NOT NULL")
    firsts = usable.groupBy("s1", "s2").agg(F.min("row").alias("class"), F.min("id").alias("class_id"), F.count("*").alias("members"))
    firsts = materialize(firsts, "class-ids")
    classes = usable.join(firsts.select(F.col("class").alias("row")), "row", "left_semi")
    classes = materialize(classes.select(F.col("row").alias("id"), F.col("id").alias("doc"), "tie", "n", "bands", "signature"), "classes")

    banded = classes.select("id", F.posexplode("bands").alias("k", "band"))
    shared = banded.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = materialize(banded.join(shared, "band"), "bands")
    star = members.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = _checked(star, classes, slim)
    joined = components(links)

    in_parts = members.where("size > 2").join(joined.withColumnRenamed("node", "id"), "id", "left")
    in_parts = in_parts.withColumn("component", F.coalesce("component", "id"))
    split = in_parts.groupBy("band").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p != q")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rest = in_parts.join(split.select("band"), "band").withColumns(
        {"own": F.pmod(F.hash("id"), blocks), "other": F.explode(F.sequence(F.lit(0), blocks - 1))}
    )
    marks = F.transform("bands", lambda b: F.shiftright(b, 32).cast("int")).alias("marks")
    placed = rest.select(
        "band", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "component"
    ).join(classes.select("id", "n", "signature", marks), "id")
    parted = placed.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "id")
    across = materialize(parted.mapInArrow(lean(_across), "a long, b long"), "across")
    more = _confirm(across, classes, slim)
    if more.head(1):
        joined = components(links.union(more))

    # classes with a link get the least id of their component; the others are their own
    linked = joined.join(firsts.select(F.col("class").alias("node"), "class_id"), "node")
    least = linked.groupBy("component").agg(F.min("class_id").alias("component_id"))
    labels = linked.join(least, "component").select(F.col("node").alias("class"), "component", "component_id")
    known = firsts.join(labels, "class", "left").select(
        F.col("s1").alias("c1"), F.col("s2").alias("c2"), "members", "class_id",
        F.coalesce("component", "class").alias("group"), F.coalesce("component_id", "class_id").alias("component_id"),
    )
    known = materialize(known, "class-labels")
    # sets of very many rows, of which there can be only HOT_SETS, are broadcast; the others meet few rows each
    limit = F.greatest(F.lit(HOT_ROWS), firsts.agg(F.sum("members")).scalar() / HOT_SETS)
    rows = base.select("id", "tie", "n", "s1", "s2", "row")
    told = ["class_id", "component_id", "group"]
    by_set = lambda sets, of: sets.select(F.col("c1").alias(f"{of}1"), F.col("c2").alias(f"{of}2"), F.struct(*told).alias(of))
    hot = by_set(known.where(F.col("members") > limit), "hot")
    cold = by_set(known.where(F.col("members") <= limit), "cold")
    usual = (F.col("n") > 0) & F.col("id").isNotNull()
    marked = rows.join(F.broadcast(hot), usual & F.expr("s1 = hot1 AND s2 = hot2"), "left")
    # rows with a hot set, without a set or without an id meet nothing here, each at a place of its own
    key = F.when(usual & F.col("hot").isNull(), F.col("s1")).otherwise(F.xxhash64("row", F.lit(1)))
    joined_rows = marked.withColumn("k1", key).join(cold, F.expr("k1 = cold1 AND s2 = cold2"), "left")
    found = F.coalesce("hot", "cold")
    return joined_rows.select(
        "id", "tie", "n", F.coalesce(found["class_id"], "id").alias("class_id"),
        F.coalesce(found["component_id"], "id").alias("component_id"), found["group"].alias("group"),
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id, kept.

    Defined results: null, empty and blank texts have no shingles, link to
    nothing and are their own component; texts of under five words have one
    shingle of all their words; rows that repeat an id are documents of their
    own with one label, so two texts under one id each have their links; a null
    id stays null and is kept, and links to nothing; an empty table gives an
    empty result; other columns are not read. A long text's set is made in one
    task and then stored as a signature of fixed size.
    """
    return _groups(docs, id_col, text_col).select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        "class_id",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without the near duplicates of another: the least id of each group stays.

    Where several texts of a group have that id, the one of the least hash
    stays, and of rows that repeat id and text one. Rows without an id all
    stay. What is to go is named by id and hash of the text and broadcast if
    its counted number allows it, so that texts do not travel; otherwise the
    anti join shuffles.
    """
    found = materialize(_groups(docs, id_col, text_col), "groups")
    named = found.where("id IS NOT NULL")
    gone = named.where("id != component_id").select(F.col("id").alias("gone"), F.col("tie").alias("gone_tie"))
    repeated = not named.groupBy("id").agg(F.count("*").alias("c")).where("c > 1").isEmpty()
    if repeated:
        # texts of one group under its least id: all but the first
        heads = named.where("n > 0 AND id = component_id")
        first = heads.groupBy("group").agg(F.min("tie").alias("first"), F.max("tie").alias("last")).where("first < last")
        more = heads.join(first, "group").where("tie > first").select(F.col("id").alias("gone"), F.col("tie").alias("gone_tie"))
        gone = gone.unionByName(more)
    gone = materialize(gone.distinct(), "dropped")
    gone = maybe_broadcast(gone, gone.count())
    key = F.col(f"`{id_col}`")
    tied = docs.withColumn("__tie", F.xxhash64(F.col(f"`{text_col}`")))
    rest = tied.join(gone, (key == F.col("gone")) & (F.col("__tie") == F.col("gone_tie")), "left_anti")
    if repeated:
        rest = rest.where(key.isNotNull()).dropDuplicates([id_col, "__tie"]).unionByName(rest.where(key.isNull()))
    return rest.drop("__tie")


def op4_neardup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
