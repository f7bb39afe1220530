"""Document fingerprints from modular prefix arrays of polynomial hashes.

For code points c the prefix array is ``P[i] = sum(c[j] * B**j, j < i)`` modulo
a prime, so the hash of any span is a difference of two entries, and spans at
different places are compared after multiplying with a power of ``B``. Two
primes below 2**31 are used side by side.

A fingerprint holds the length, the hash of the whole text, the prefix and
suffix hashes at up to ``GRID`` multiples of a step that is a power of two, and
the hashes of up to ``CHUNKS`` stretches between places chosen by their
content. Likenesses are of two fingerprints: the longest common prefix and
suffix on the grid are found by binary search, and what lies between is
compared stretch by stretch, wherever it stands. ``likeness`` compares two
whole texts by their prefix arrays instead, to the code point.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import lean
from tallyward.operators.ordered import default_buckets, quantile_limits, with_bucket
from tallyward.session import materialize

GRID = 32
#: Code points of an anchor, and how many spans there are to one anchor (a power of two).
ANCHOR = 24
THIN = 8
#: Stretches of a fingerprint, and the code points behind a place that decide whether one begins there.
CHUNKS = 64
EDGE = 16
#: A place of rank r begins a stretch at all levels up to r; 1 in 2**r places has it.
LEAST_RANK = 3
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (911_382_323, 972_663_749)
_tables: dict[int, np.ndarray] = {}


def _powers(k: int, n: int) -> np.ndarray:
    """BASES[k]**0 .. **(n-1) modulo PRIMES[k]; texts of usual size share one table."""
    have = _tables.get(k, np.ones(1, np.int64))
    while len(have) < n:
        step = pow(BASES[k], len(have), PRIMES[k])
        have = np.concatenate([have, have * step % PRIMES[k]])
    if len(have) <= 1 << 20:
        _tables[k] = have
    return have[:n]


def prefix_arrays(text: str) -> list[np.ndarray]:
    """Both prefix arrays, n + 1 entries each."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    out = []
    for k, prime in enumerate(PRIMES):
        total = np.zeros(len(points) + 1, np.int64)
        # 2**31 terms below 2**31 fit into 63 bits
        np.cumsum(points * _powers(k, len(points)) % prime, out=total[1:])
        out.append(total % prime)
    return out


def same_span(p: list[np.ndarray], i: int, q: list[np.ndarray], j: int, size: int) -> bool:
    """Whether the spans of ``size`` code points from i and from j are equal."""
    for k, prime in enumerate(PRIMES):
        a = int(p[k][i + size] - p[k][i]) % prime
        b = int(q[k][j + size] - q[k][j]) % prime
        if a * pow(BASES[k], j, prime) % prime != b * pow(BASES[k], i, prime) % prime:
            return False
    return True


def common_extension(p: list[np.ndarray], i: int, q: list[np.ndarray], j: int) -> int:
    """Longest length for which the spans from i and from j agree, by binary search."""
    lo, hi = 0, min(len(p[0]) - 1 - i, len(q[0]) - 1 - j)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if same_span(p, i, q, j, mid):
            lo = mid
        else:
            hi = mid - 1
    return lo


def joined(p: list[np.ndarray], n: int, q: list[np.ndarray], m: int) -> list[np.ndarray]:
    """Prefix arrays of the first n code points of one text and the first m of another."""
    return [
        np.concatenate([a[: n + 1], (a[n] + b[1 : m + 1] * pow(BASES[k], n, prime)) % prime])
        for k, (a, b, prime) in enumerate(zip(p, q, PRIMES))
    ]


def step_of(n: int) -> int:
    step = 1
    while step * GRID < n:
        step *= 2
    return step


def fingerprint(p: list[np.ndarray]) -> str:
    """``n:whole:prefixes:suffixes:level:stretches`` in hex; hashes are moved to the origin to be comparable."""
    n = len(p[0]) - 1
    step = step_of(n)
    at = np.arange(step, n + 1, step)
    whole = "".join(f"{int(a[n]):08x}" for a in p)
    prefixes = (p[0][at] ^ (p[1][at] << 1)) & 0xFFFFFFFF
    back = [
        (a[n] - a[n - at]) % prime * _inverse(k, n - at) % prime for k, (a, prime) in enumerate(zip(p, PRIMES))
    ]
    suffixes = (back[0] ^ (back[1] << 1)) & 0xFFFFFFFF
    level, parts = stretches(p)
    inner = ",".join(f"{size:x}.{h:x}.{rank:x}" for size, h, rank in parts)
    return f"{n}:{whole}:{prefixes.astype('>u4').tobytes().hex()}:{suffixes.astype('>u4').tobytes().hex()}:{level}:{inner}"


def stretches(p: list[np.ndarray]) -> tuple[int, list[tuple[int, int, int]]]:
    """(level, [(size, hash, rank of its first place)]): the text cut at the places of the least level that gives CHUNKS at most."""
    a, prime = p[0], PRIMES[0]
    n = len(a) - 1
    if not n:
        return LEAST_RANK, []
    places, ranks, level = np.empty(0, np.int64), np.empty(0, np.int64), LEAST_RANK
    if n > EDGE:
        m = n - EDGE
        # moved to one place, the hashes of equal spans are equal
        h = (a[EDGE + 1 :] - a[1 : m + 1]) % prime * _powers(0, m)[::-1] % prime
        h = h * int(pow(BASES[0], -m, prime)) % prime
        mixed = (h * 0x9E3779B1) & 0xFFFFFFFF
        near = np.flatnonzero(mixed < 1 << (32 - LEAST_RANK))
        ranks = 32 - np.frexp(mixed[near].astype(float))[1]
        while (ranks >= level).sum() >= CHUNKS:
            level += 1
        places, ranks = near[ranks >= level] + 1, ranks[ranks >= level]
    cut = np.concatenate([[0], places, [n]])
    hashes = (a[cut[1:]] - a[cut[:-1]]) % prime * _inverse(0, cut[:-1]) % prime
    return level, list(zip(np.diff(cut).tolist(), hashes.tolist(), [0, *ranks.tolist()]))


def _read(mark: str) -> tuple[int, list[str], list[str], int, list[tuple[int, int, int]]]:
    n, _, prefixes, suffixes, level, inner = mark.split(":")
    cut = lambda x: [x[i : i + 8] for i in range(0, len(x), 8)]
    parts = [tuple(int(x, 16) for x in s.split(".")) for s in inner.split(",")] if inner else []
    return int(n), cut(prefixes), cut(suffixes), int(level), parts


def _coarser(parts: list[tuple[int, int, int]], level: int) -> list[tuple[int, int]]:
    """The stretches of a higher level: hashes of neighbours add up, the later one moved behind the earlier."""
    prime = PRIMES[0]
    out: list[list[int]] = []
    for size, h, rank in parts:
        if out and rank < level:
            out[-1][1] = (out[-1][1] + h * pow(BASES[0], out[-1][0], prime)) % prime
            out[-1][0] += size
        else:
            out.append([size, h])
    return [(size, h) for size, h in out]


def _on_grid(x: list[str], y: list[str], n: int, m: int) -> int:
    """Longest common prefix (or suffix) on the coarser of two grids, by binary search."""
    step = max(step_of(n), step_of(m))
    every_x, every_y = step // step_of(n), step // step_of(m)
    lo, hi = 0, min(len(x) // every_x, len(y) // every_y)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if x[mid * every_x - 1] == y[mid * every_y - 1]:
            lo = mid
        else:
            hi = mid - 1
    return lo * step


def _within(parts: list[tuple[int, int]], lo: int, hi: int) -> Counter:
    out: Counter = Counter()
    at = 0
    for size, h in parts:
        if lo <= at and at + size <= hi:
            out[size, h] += 1
        at += size
    return out


def fingerprint_likeness(f: str, g: str) -> float:
    """Share of the longer text that two fingerprints show to be common, 0 to 1.

    Common stretches count wherever they stand; with them, outside the common
    prefix and suffix, or without these, whichever shows more.
    """
    if f == g:
        return 1.0
    n, before, behind, level, own = _read(f)
    m, other_before, other_behind, other_level, other = _read(g)
    if not (n and m):
        return 0.0
    x, y = (_coarser(parts, max(level, other_level)) for parts in (own, other))
    head = _on_grid(before, other_before, n, m)
    tail = min(_on_grid(behind, other_behind, n, m), min(n, m) - head)
    common = lambda a, b: sum(size * k for (size, _), k in (a & b).items())
    inner = common(_within(x, head, n - tail), _within(y, head, m - tail))
    return min(1.0, max(head + tail + inner, common(_within(x, 0, n), _within(y, 0, m))) / max(n, m))


def _inverse(k: int, at: np.ndarray) -> np.ndarray:
    base = pow(BASES[k], -1, PRIMES[k])
    return np.array([pow(base, int(x), PRIMES[k]) for x in at], np.int64)


def anchors(p: list[np.ndarray]) -> dict[tuple[int, int], int]:
    """Place of every anchor by (hash, which of the equal ones): spans of ANCHOR code points with a hash in 1 of THIN."""
    n = len(p[0]) - ANCHOR
    if n <= 0:
        return {}
    # moved to one place, the hashes of equal spans are equal
    spans = [
        (a[ANCHOR:] - a[:-ANCHOR]) % prime * _powers(k, n)[::-1] % prime for k, (a, prime) in enumerate(zip(p, PRIMES))
    ]
    spans = [h * int(pow(BASES[k], -(n - 1), PRIMES[k])) % PRIMES[k] for k, h in enumerate(spans)]
    at = np.flatnonzero((spans[0] ^ spans[1]) * 0x9E3779B1 >> 16 & (THIN - 1) == 0)
    times: dict[int, int] = {}
    out = {}
    for i, h in zip(at.tolist(), (spans[0][at] << 31 | spans[1][at]).tolist()):
        times[h] = times.get(h, 0) + 1
        out[h, times[h]] = i
    return out


def common_before(p: list[np.ndarray], i: int, q: list[np.ndarray], j: int, most: int) -> int:
    """Longest length up to ``most`` for which the spans that end at i and at j agree, by binary search."""
    lo, hi = 0, most
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if same_span(p, i - mid, q, j - mid, mid):
            lo = mid
        else:
            hi = mid - 1
    return lo


def _chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest part of the pairs, sorted by their first places, in which the second ones ascend too."""
    ends: list[int] = []
    last: list[int] = []
    back = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        back.append(last[at - 1] if at else -1)
        ends[at : at + 1], last[at : at + 1] = [j], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def likeness(p: list[np.ndarray], q: list[np.ndarray], of_p: dict, of_q: dict) -> float:
    """Share of the longer text that lies in common stretches which follow each other in both, 0 to 1.

    The stretches are the common prefix and suffix and the extensions of the
    anchors that both texts hold, in the longest chain that is in order in
    both. A stretch without an anchor between two edits does not count.
    """
    n, m = len(p[0]) - 1, len(q[0]) - 1
    if not max(n, m):
        return 1.0
    covered = i = j = common_extension(p, 0, q, 0)
    tail = common_before(p, n, q, m, min(n, m) - covered)
    stop_i, stop_j = n - tail, m - tail
    inner = ((a, of_q[key]) for key, a in of_p.items() if key in of_q)
    for a, b in _chain(sorted(x for x in inner if i <= x[0] < stop_i and j <= x[1] < stop_j)):
        if a < i or b < j:
            continue
        left = common_before(p, a, q, b, min(a - i, b - j))
        size = min(common_extension(p, a, q, b), stop_i - a, stop_j - b)
        covered += left + size
        i, j = a + size, b + size
    return (covered + tail) / max(n, m)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, order); the last row of a part is only looked ahead at."""
    out: list[tuple] = []
    before: tuple | None = None  # (part, doc_id, text, arrays, fingerprint)

    def batch_of(rows):
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for part, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text"))):
            p = prefix_arrays(text)
            now = (part, doc_id, text, p, fingerprint(p))
            if before is not None and before[0] == part:
                _, own_id, own, q, mark = before
                n = len(own)
                keep, take = n - n // 2, min(n // 2, len(text))
                edited = own[:keep] + text[:take]
                both = joined(q, keep, p, take)
                sha = hashlib.sha256(edited.encode("utf-8")).hexdigest()
                edited_mark = fingerprint(both)
                near = fingerprint_likeness(mark, edited_mark), fingerprint_likeness(mark, now[4])
                out.append((own_id, n, sha, mark, edited_mark, *near))
                if len(out) == 2000:
                    yield batch_of(out)
                    out = []
            before = now
    if out:
        yield batch_of(out)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, with likenesses.

    The edited form replaces the last half of the code points by the first
    ones of the next document in descending id order; the last document's next
    is the first. Texts travel once: to parts of the id order, cut at sampled
    quantiles; each part gets the first row of the following part as well.

    Defined results: a null text is empty; null ids come last; rows with equal
    ids follow each other in the order of their texts' hashes; a single
    document is its own next; an empty table gives an empty result.
    """
    slim = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    buckets = default_buckets(slim)
    low = with_bucket(slim, "doc_id", quantile_limits(slim, "doc_id", buckets), buckets, "low")
    # parts descend as the order does; rows without an id are the last part
    part = F.when(F.col("doc_id").isNull(), buckets).otherwise(buckets - 1 - F.col("low"))
    placed = low.select(part.cast("int").alias("part"), "doc_id", "text", F.lit(0).alias("ahead"), F.xxhash64("text").alias("tie"))
    order = F.struct(F.coalesce(-F.col("doc_id"), F.lit(0)), "tie")
    # one row per part
    first = materialize(placed.groupBy("part").agg(F.min_by(F.struct("doc_id", "text"), order).alias("row")), "first-rows")
    around = Window.partitionBy(F.lit(1))
    before = first.select("part", F.lag("part").over(around.orderBy("part")).alias("to"), F.max("part").over(around).alias("end"))
    ahead = first.join(before, "part").select(
        F.coalesce("to", "end").alias("part"), "row.doc_id", "row.text", F.lit(1).alias("ahead"), F.lit(0).cast("long").alias("tie")
    )
    # a part is a partition; hashing part numbers would leave some tasks with several
    both = placed.unionByName(ahead).repartitionById(buckets + 1, F.col("part"))
    ordered = both.sortWithinPartitions("part", "ahead", F.col("doc_id").desc_nulls_last(), "tie")
    return ordered.select("part", "doc_id", "text").mapInArrow(
        lean(_edited),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )


def op2_fingerprints(docs: DataFrame) -> DataFrame:
    return fingerprints(docs)
