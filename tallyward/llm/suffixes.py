"""Removal of repeated byte strings: a content-chosen cover of sampled suffixes, sorted and named.

A string of ``length`` bytes that starts at a place is removed when an equal
string starts earlier. Suffixes are compared on their first ``length`` bytes:

1. *Sample.* A set of places with the property of a difference cover: two
   equal strings of ``length`` bytes always have sampled places at the same
   distance from their starts. The places depend on the text (``winnow``), not
   on the offset modulo a number, so 3 % of the bytes are sampled instead of
   the two thirds of a cover modulo 3.
2. *Sort and name.* Each sampled place has the tuple (its gram, all bytes that
   strings through it can have). Tuples are sorted in buckets cut at sampled
   splitters. Equal tuples share a name, and all but the first of a name are
   repeats with everything around them.
3. *Open names.* Only names whose gram also occurs under another name go on.
   One pass finds them; there is no recursion on the names, since a tuple
   holds all bytes that matter for strings of ``length``.
4. *Remaining suffixes.* Around an open name the strings of ``length`` bytes
   are grouped by 128-bit hashes: the first of a group stays, the others are
   repeats. It is no full suffix array.

Buckets are keyed by tuple, so a passage in a third of all documents is spread
by its surroundings, equal tuples are folded in each task before the shuffle,
and a group that is too large for one bucket leaves its firsts to a plain
minimum per string. Offsets and hashes travel as packed arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import lean, mix, powers, slices, text_batches
from tallyward.llm.winnow import GRAM, anchors, span_hashes
from tallyward.session import materialize

LENGTH = 100
SLICE = 1 << 19
#: Documents whose anchors are looked at to place the splitters (they only balance load).
SAMPLE_DOCS = 2000
ANCHORS_PER_BUCKET = 150_000
DOCS_PER_BUCKET = 500
CONTEXTS_PER_BUCKET = 5_000
#: Contexts of one gram that are compared at once; a larger group defers its firsts.
GROUP_LIMIT = 20_000

COVERED, OPEN, SPANS, TEXT = 1, 2, 3, 4
_EVENTS = "place int, kind int, blob binary"


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays[0])], np.int64).tobytes()
    return head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(blobs: list[bytes], kinds: list[str]) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for b in blobs:
        n, at = int(np.frombuffer(b, np.int64, 1)[0]), 8
        for part, kind in zip(parts, kinds):
            part.append(np.frombuffer(b, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) if p else np.empty(0, k) for p, k in zip(parts, kinds)]


def _place(d: np.ndarray, places: int) -> np.ndarray:
    return (mix(d.astype(np.int64).view(np.uint64)) % np.uint64(places)).astype(np.int64)


def _dealt(key: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """One packed blob per key value."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    edge = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
    columns = [c[order] for c in columns]
    for lo, hi in zip(edge[:-1], edge[1:]):
        if hi > lo:
            yield int(key[lo]), _pack(*[c[lo:hi] for c in columns])


def _rows(found: list[tuple]) -> pa.RecordBatch:
    place, kind, blob = zip(*found)
    return pa.RecordBatch.from_arrays(
        [pa.array(place, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())],
        ["place", "kind", "blob"],
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(place, kind, blobs) of rows sorted by place and kind."""
    now, held = None, []
    for batch in batches:
        for place, kind, blob in zip(*(batch.column(c).to_pylist() for c in ("place", "kind", "blob"))):
            if (place, kind) != now:
                if held:
                    yield *now, held
                now, held = (place, kind), []
            held.append(blob)
    if held:
        yield *now, held


# ---- 1. sample -------------------------------------------------------------------------------


def _pieces(data: np.ndarray, starts: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each anchor, offset, hash of gram) with the context hash as a fourth; rows of at least ``length`` bytes."""
    reach = length - GRAM
    sizes = np.diff(starts)
    long = np.flatnonzero(sizes >= length)
    if not len(long):
        return
    step = 4 * SLICE
    # rows are laid out with a gap of zeros; a very long row is worked on in overlapping parts
    jobs: list[list[tuple[int, int, int]]] = [[]]
    load = 0
    for r in long:
        for lo in range(0, int(sizes[r]), step):
            hi = min(lo + step, int(sizes[r]))
            if load + hi - lo > SLICE and jobs[-1]:
                jobs.append([])
                load = 0
            jobs[-1].append((int(r), lo, hi))
            load += hi - lo
    for job in jobs:
        rows, offsets, grams, contexts = [], [], [], []
        parts, bounds, at = [], [], 0
        for r, lo, hi in job:
            left, right = max(lo - 2 * length, 0), min(hi + 2 * length, int(sizes[r]))
            part = data[starts[r] + left : starts[r] + right]
            parts += [part, np.zeros(length, np.uint8)]
            bounds.append((at, at + len(part), r, lo, hi, left, int(sizes[r])))
            at += len(part) + length
        buf = np.concatenate([*parts, np.zeros(GRAM, np.uint8)])
        for b, e, r, lo, hi, left, size in bounds:
            p, h = anchors(buf[b : e + 8], e - b, length)
            own = p + left
            keep = (own >= lo) & (own < hi)
            p, h, own = p[keep] + b, h[keep], own[keep]
            rows.append(np.full(len(p), r))
            offsets.append(own)
            grams.append(h)
            contexts.append((p, np.maximum(p - reach, b), np.minimum(p + length, e)))
        p, begin, end = (np.concatenate(x) for x in zip(*contexts))
        c = mix(span_hashes(buf, begin, end, 7) + (p - begin).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        yield np.concatenate(rows), np.concatenate(offsets), np.concatenate(grams), c


def _anchor_blobs(length: int, split_a: np.ndarray, split_c: np.ndarray, places: int):
    buckets = len(split_a) + 1

    def bucket_of(a: np.ndarray, c: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(split_a, a, "left"), np.searchsorted(split_a, a, "right")
        out = lo.copy()
        for k in np.flatnonzero(hi > lo):
            out[k] = lo[k] + np.searchsorted(split_c[lo[k] : hi[k]], c[k], "right")
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("d").to_numpy(zero_copy_only=False)
            for lo, hi, data, starts in slices(batch.column("text"), SLICE):
                for row, o, a, c in _pieces(data, starts, length):
                    d = ids[lo:hi][row]
                    order = np.lexsort((o, d, c, a))
                    d, o, a, c = d[order], o[order], a[order], c[order]
                    again = np.zeros(len(d), bool)
                    again[1:] = (a[1:] == a[:-1]) & (c[1:] == c[:-1])
                    first = ~again
                    found = [(k, 0, b) for k, b in _dealt(bucket_of(a[first], c[first]), a[first], c[first], d[first], o[first])]
                    # repeats inside this slice need no comparison: dealt out by document, not by tuple
                    at = _place(d[again], places)
                    found += [(buckets + k % buckets, COVERED, b) for k, b in _dealt(at % buckets, d[again], o[again])]
                    if found:
                        yield _rows(found)

    return run


# ---- 2. sort and name, 3. recurse ------------------------------------------------------------


def _named(split_a: np.ndarray, places: int):
    shared = np.unique(split_a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, kind, blobs in _groups(batches):
            found: list[tuple] = []
            if kind == COVERED:
                d, o = _unpack(blobs, ["i8", "i8"])
            else:
                a, c, d, o = _unpack(blobs, ["u8", "u8", "i8", "i8"])
                order = np.lexsort((o, d, c, a))
                a, c, d, o = a[order], c[order], d[order], o[order]
                new_gram = np.ones(len(a), bool)
                new_gram[1:] = a[1:] != a[:-1]
                new_name = new_gram.copy()
                new_name[1:] |= c[1:] != c[:-1]
                group = np.cumsum(new_gram) - 1
                names = np.bincount(group, weights=new_name)
                # a gram that spans buckets has other names elsewhere
                spans = np.isin(a, shared)
                is_open = new_name & ((names[group] > 1) | spans)
                piece = np.where(spans, bucket, -1)[is_open]
                at = _place(d[is_open], places)
                found += [(k, OPEN, b) for k, b in _dealt(at, d[is_open], a[is_open], piece, o[is_open])]
                d, o = d[~new_name], o[~new_name]
            found += [(k, COVERED, b) for k, b in _dealt(_place(d, places), d, o)]
            if found:
                yield _rows(found)

    return run


# ---- 4. the remaining suffixes around open names ---------------------------------------------


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for their way through the shuffle."""
    for batch in batches:
        text = [t or b"" for t in batch.column("text").to_pylist()]
        packed = [pa.compress(t, "zstd", asbytes=True) if t else b"" for t in text]
        cut = {"d": batch.column("d"), "size": pa.array([len(t) for t in text], pa.int64()), "blob": pa.array(packed, pa.binary())}
        columns = [cut.get(n, batch.column(n)) if n in batch.schema.names else cut[n] for n in ("place", "kind", "blob", "d", "size")]
        names = ["place", "kind", "blob", "d", "size"]
        if "carry" in batch.schema.names:
            columns.append(batch.column("carry"))
            names.append("carry")
        yield pa.RecordBatch.from_arrays(columns, names)


def _by_document(batches: Iterator[pa.RecordBatch], kinds: dict[int, list[str]]):
    """(batch, row, text, arrays by kind) for each text row; events of a place come before its texts."""
    place, events, sorted_events = None, {}, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("place", "kind", "blob", "d", "size")]
        for k, (at, kind, blob, d, size) in enumerate(zip(*columns)):
            if at != place:
                place, events, sorted_events = at, {x: [] for x in kinds}, None
            if kind != TEXT:
                events[kind].append(blob)
                continue
            if sorted_events is None:
                sorted_events = {}
                for x, fields in kinds.items():
                    arrays = _unpack(events[x], fields)
                    order = np.argsort(arrays[0], kind="stable")
                    sorted_events[x] = [v[order] for v in arrays]
            text = pa.decompress(blob, size, "zstd", asbytes=True) if size else b""
            mine = {}
            for x, arrays in sorted_events.items():
                lo, hi = np.searchsorted(arrays[0], d, "left"), np.searchsorted(arrays[0], d, "right")
                mine[x] = [v[lo:hi] for v in arrays]
            yield batch, k, d, text, mine


def _contexts(length: int, buckets: int):
    reach = length - GRAM

    def flush(held):
        a, piece, d, o, begin, data = (x for x in zip(*held))
        sizes = np.concatenate([x[1] for x in data])
        a, piece, d, o, begin = (np.concatenate(x) for x in (a, piece, d, o, begin))
        blob = np.frombuffer(b"".join(x[0] for x in data), np.uint8)
        at = np.concatenate([[0], np.cumsum(sizes)])
        key = (mix(a ^ mix(piece.view(np.uint64))) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(key, kind="stable")
        edge = np.concatenate([[0], np.flatnonzero(np.diff(key[order])) + 1, [len(key)]])
        found = []
        for lo, hi in zip(edge[:-1], edge[1:]):
            rows = order[lo:hi]
            body = b"".join(blob[at[r] : at[r + 1]].tobytes() for r in rows)
            packed = pa.compress(body, "zstd", asbytes=True)
            found.append((int(key[rows[0]]), len(body), _pack(a[rows], piece[rows], d[rows], o[rows], begin[rows], sizes[rows]) + packed))
        return _rows(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, load = [], 0
        for _, _, _, text, mine in _by_document(batches, {OPEN: ["i8", "u8", "i8", "i8"]}):
            d, a, piece, o = mine[OPEN]
            if not len(d):
                continue
            begin, end = np.maximum(o - reach, 0), np.minimum(o + length, len(text))
            body = b"".join(text[i:j] for i, j in zip(begin.tolist(), end.tolist()))
            held.append((a, piece, d, o, begin, (body, end - begin)))
            load += len(body)
            if load > 4 * SLICE:
                yield flush(held)
                held, load = [], 0
        if held:
            yield flush(held)

    return run


_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def _compared(length: int, places: int):
    """Spans (place, SPANS, blob of d, start, end) and deferred firsts (-1, OPEN, blob of h1, h2, d, start)."""
    fields = ["u8", "i8", "i8", "i8", "i8", "i8"]

    def of(a, piece, d, o, begin, sizes, data, deferred):
        """Order the suffixes of contexts sorted by (gram, piece, d, o)."""
        count = sizes - length + 1
        at = np.concatenate([[0], np.cumsum(sizes)])
        which = np.repeat(np.arange(len(a)), count)
        first = np.concatenate([[0], np.cumsum(count)])
        shift = np.arange(first[-1]) - first[which]
        lo = at[which] + shift
        hashes = []
        group = mix(a + np.uint64(0x632BE59BD9B4E019)) ^ mix(piece.view(np.uint64) + np.uint64(3))
        for base in _BASES:
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), base), out=total[1:])
            inverse = powers(len(data), pow(base, -1, 1 << 64))
            hashes.append(mix((total[lo + length] - total[lo]) * inverse[lo]))
        offset = (o - begin)[which] - shift
        salt = mix(offset.astype(np.uint64) + np.uint64(11))
        key = mix(hashes[0] ^ salt) ^ (np.where(deferred, mix(a), group))[which]
        check = hashes[1]
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), bool)
        again[order[1:]] = (key[order][1:] == key[order][:-1]) & (check[order][1:] == check[order][:-1])
        start = begin[which] + shift
        later = np.flatnonzero(~again & deferred[which])
        # runs of repeated starts inside a context are one span
        flag = np.concatenate([[False], again, [False]])
        opens = flag[1:-1] & (~flag[:-2] | (shift == 0))
        nxt = np.concatenate([shift[1:] == 0, [True]])
        closes = flag[1:-1] & (~flag[2:] | nxt)
        spans = d[which[opens]], start[opens], start[closes] + length
        return spans, (key[later], check[later], d[which[later]], start[later])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush():
            heads, bodies = [], []
            for size, blob in held:
                n = int(np.frombuffer(blob, np.int64, 1)[0])
                cut = 8 + n * 8 * len(fields)
                heads.append(blob[:cut])
                bodies.append(pa.decompress(blob[cut:], size, "zstd", asbytes=True))
            columns = _unpack(heads, fields)
            data = np.frombuffer(b"".join(bodies), np.uint8)
            at = np.concatenate([[0], np.cumsum(columns[5])])
            order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
            a, piece = columns[0][order], columns[1][order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (piece[1:] != piece[:-1])
            edge = np.concatenate([np.flatnonzero(new), [len(a)]])
            size = np.diff(edge)
            deferred = np.repeat(size > GROUP_LIMIT, size) | (piece >= 0)
            # chunks of whole groups; a group over the limit is cut, as its firsts are deferred anyway
            cuts, load = [0], 0
            for lo, hi in zip(edge[:-1], edge[1:]):
                if load and load + hi - lo > GROUP_LIMIT:
                    cuts.append(int(lo))
                    load = 0
                for more in range(lo + GROUP_LIMIT, hi, GROUP_LIMIT):
                    cuts.append(int(more))
                load += hi - lo
            found = []
            for lo, hi in zip(cuts, [*cuts[1:], len(a)]):
                rows = order[lo:hi]
                body = np.concatenate([data[at[r] : at[r + 1]] for r in rows])
                spans, later = of(*[c[rows] for c in columns], body, deferred[lo:hi])
                found += [(k, SPANS, b) for k, b in _dealt(_place(spans[0], places), *spans)]
                if len(later[0]):
                    found.append((-1, OPEN, _pack(*later)))
            return found

        for batch in batches:
            for bucket, size, blob in zip(*(batch.column(c).to_pylist() for c in ("place", "kind", "blob"))):
                if bucket != now:
                    if held and (out := flush()):
                        yield _rows(out)
                    now, held = bucket, []
                held.append((size, blob))
        if held and (out := flush()):
            yield _rows(out)

    return run


def _deferred_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("blob").to_pylist():
            h1, h2, d, start = _unpack([blob], ["u8", "u8", "i8", "i8"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(d), pa.array(start)],
                ["h1", "h2", "d", "start"],
            )


def _span_blobs(length: int, places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, start = (batch.column(c).to_numpy() for c in ("d", "start"))
            if found := [(k, SPANS, b) for k, b in _dealt(_place(d, places), d, start, start + length)]:
                yield _rows(found)

    return run


# ---- the repeats taken out of the texts ------------------------------------------------------


def _merged(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:] - 1, [len(end) - 1]])
    return list(zip(begin[at].tolist(), end[last].tolist()))


def _removed(length: int, as_text: bool):
    """Runs and what stays of each text; as text, characters that a border cuts in two go as a whole."""
    reach = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {COVERED: ["i8", "i8"], SPANS: ["i8", "i8", "i8"]}
        source, rows, out, load = None, [], [], 0

        def flush():
            picked = pa.array(rows, pa.int64())
            columns = [pa.array(x) for x in zip(*out)]
            columns[4] = pa.array([x[4] for x in out], pa.string() if as_text else pa.binary())
            return pa.RecordBatch.from_arrays(
                [source.column("d").take(picked), *columns, *([source.column("carry").take(picked)] if "carry" in source.schema.names else [])],
                ["d", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"] + ["carry"] * ("carry" in source.schema.names),
            )

        for batch, k, _, text, mine in _by_document(batches, kinds):
            if batch is not source or load > 4 * SLICE:
                if rows:
                    yield flush()
                source, rows, out, load = batch, [], [], 0
            _, o = mine[COVERED]
            _, begin, end = mine[SPANS]
            n = len(text)
            runs = []
            if len(o) or len(begin):
                begin = np.concatenate([np.maximum(o - reach, 0), begin])
                end = np.concatenate([np.minimum(o + length, n), end])
                runs = _merged(begin, end)
            kept, at = [], 0
            for b, e in runs:
                kept.append(text[at:b])
                at = e
            kept = b"".join([*kept, text[at:]])
            rows.append(k)
            body = kept.decode("utf-8", "ignore") if as_text else kept
            out.append((n, n - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), body))
            load += n
        if rows:
            yield flush()

    return run


def _ordered(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """Columns d (unique, in document order), text (binary) and carry.

    ``d`` is the id where ids are unique and present. Otherwise rows are sorted
    by (id, text), null first, and numbered: partition number and place in it.
    """
    slim = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("d"),
        F.col(f"`{text_col}`").cast("binary").alias("text"),
        F.struct(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in carry if c != id_col]).alias("carry"),
    )
    ids = slim.groupBy("d").agg(F.count("*").alias("n")).where("n > 1 OR d IS NULL")
    if not ids.head(1):
        return slim
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = slim.repartitionByRange(parts, F.col("d").asc_nulls_first(), "text")
    placed = dealt.sortWithinPartitions(F.col("d").asc_nulls_first(), "text")
    return materialize(placed.withColumn("d", F.monotonically_increasing_id()), "ordered")


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    as_text: bool = False,
) -> DataFrame:
    """Per document: carry (struct), n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay, or a text).

    Defined results: null is empty; texts under ``length`` bytes stay whole;
    rows with equal ids are separate documents in the order of their texts,
    equal rows the second after the first; null ids come first; an empty table
    gives an empty result. ``length`` must be over the gram of 24 bytes.
    """
    spark = docs.sparkSession
    text_batches(spark)
    slim = _ordered(docs, id_col, text_col, carry or [])
    n = slim.count()
    places = max(8, -(-n // DOCS_PER_BUCKET))
    sampled = slim.sample(min(1.0, SAMPLE_DOCS / max(n, 1)), seed=11).select("d", "text")
    none = np.empty(0, np.uint64)

    def sampled_anchors(batches):
        for batch in batches:
            for _, _, data, starts in slices(batch.column("text"), SLICE):
                for _, _, a, c in _pieces(data, starts, length):
                    pick = np.argsort(mix(c), kind="stable")[: 50 * (len(starts))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a[pick].view(np.int64)), pa.array(c[pick].view(np.int64))], ["a", "c"]
                    )

    bytes_total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4, int(bytes_total * 0.03 / ANCHORS_PER_BUCKET))
    drawn = sampled.mapInArrow(lean(sampled_anchors), "a long, c long").toArrow()
    a, c = (drawn.column(k).to_numpy().view(np.uint64) for k in ("a", "c"))
    order = np.lexsort((c, a))
    at = order[np.linspace(0, len(order), buckets + 1).astype(int)[1:-1]] if len(order) > buckets else order[:0]
    split_a, split_c = (a[at], c[at]) if len(at) else (none, none)
    # a splitter stands for its gram only where it cuts a heavy one
    heavy, times = np.unique(split_a, return_counts=True)
    heavy = heavy[times > 1]
    lone = ~np.isin(split_a, heavy)
    split_c = np.where(lone, np.uint64(0), split_c)

    names = ["d", "text"]
    dealt = slim.select(*names).mapInArrow(lean(_anchor_blobs(length, split_a, split_c, places)), _EVENTS)
    events = materialize(
        dealt.repartition("place").sortWithinPartitions("place", "kind").mapInArrow(lean(_named(heavy, places)), _EVENTS),
        "suffix-names",
    )
    typed = slim.select(F.lit(TEXT).alias("kind"), "d", "text", "carry")
    carry_type = slim.schema["carry"].dataType.simpleString()

    def texts(with_carry: bool) -> DataFrame:
        def run(batches):
            for batch in batches:
                at = _place(batch.column("d").to_numpy(), places).astype(np.int32)
                yield from _texts(iter([batch.append_column("place", pa.array(at))]))

        cols = ["kind", "d", "text"] + ["carry"] * with_carry
        kind = f"{_EVENTS}, d long, size long" + (f", carry {carry_type}" if with_carry else "")
        return typed.select(*cols).mapInArrow(lean(run), kind)

    def with_texts(found: DataFrame, with_carry: bool) -> DataFrame:
        both = texts(with_carry).unionByName(found, allowMissingColumns=True)
        return both.repartition("place").sortWithinPartitions("place", "kind")

    opened = events.where(F.col("kind") == OPEN)
    contexts_n = max(4, int(bytes_total * 0.003 / CONTEXTS_PER_BUCKET))
    around = with_texts(opened, False).mapInArrow(lean(_contexts(length, contexts_n)), _EVENTS)
    compared = materialize(
        around.repartition("place").sortWithinPartitions("place").mapInArrow(lean(_compared(length, places)), _EVENTS),
        "suffix-spans",
    )
    spans = compared.where(F.col("kind") == SPANS)
    if compared.where(F.col("kind") == OPEN).head(1):
        firsts = materialize(
            compared.where(F.col("kind") == OPEN).mapInArrow(lean(_deferred_rows), "h1 long, h2 long, d long, start long"),
            "suffix-firsts",
        )
        least = firsts.groupBy("h1", "h2").agg(F.min(F.struct("d", "start")).alias("least"))
        again = firsts.join(least, ["h1", "h2"]).where(F.struct("d", "start") != F.col("least"))
        spans = spans.unionByName(again.select("d", "start").mapInArrow(lean(_span_blobs(length, places)), _EVENTS))
    final = with_texts(events.where(F.col("kind") == COVERED).unionByName(spans), True)
    out = final.mapInArrow(
        lean(_removed(length, as_text)),
        "d long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        f"kept {'string' if as_text else 'binary'}, carry {carry_type}",
    )
    return out.drop("d")


def op9_suffix(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs.select("doc_id", "text"))
    return out.select("carry.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
