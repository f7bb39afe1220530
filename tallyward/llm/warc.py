"""WARC archives with de-duplicated payloads, and the merged index of their captures.

Archives are written by Spark's text writer: a value is a record up to its
payload's end, the line separator is the record's closing blank lines. They
are read back as whole files of bounded size and parsed by Content-Length.
The captures of each archive, sorted by (url key, time, row), are its run and
stay one: a run is stored as one row of arrays, cut at the limits of the key
ranges into slices, and a range's task merges the slices of all archives by a
tree of losers, drawing one capture after the other from the arrays.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import maybe_broadcast
from tallyward.session import materialize, scratch_path

#: Payload bytes per archive, about; rows are dealt by hash, so a longer payload makes its archive longer.
ARCHIVE_BYTES = 8 << 20
END = "\r\n\r\n"
BASE_TIME = 946_684_800
_FIELDS = {
    "page_id": "long", "row": "long", "url_key": "string", "stamp": "string", "record_type": "string", "refers_to": "long",
    "payload_bytes": "long", "payload_digest": "string",
}
#: Captures, about, drawn to place the limits of the key ranges; they only balance load.
SAMPLE = 20_000


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then the rest of the url, lower-cased: org,example,)/path."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[^:/?#]*://([^/?#]*)", 1)
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[^:/?#]*://[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), rest)


def _records(pages: DataFrame, min_bytes: int) -> DataFrame:
    """One WARC record per row, as ``value``, with the row's place and size."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("html"),
        F.monotonically_increasing_id().alias("row"), F.sha1(payload.cast("binary")).alias("sha"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    # an id is needed to refer to: rows without one are responses
    first = base.where(F.col("page_id").isNotNull() & (F.col("size") >= min_bytes)).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count("*").alias("copies")
    ).where("copies > 1").select("sha", "first")
    first = materialize(first, "warc-first")
    # within the bound the payloads need not travel to meet their first copy
    typed = base.join(maybe_broadcast(first, first.count()), "sha", "left")
    revisit = F.col("page_id") != F.col("first")
    clean = F.regexp_replace("url", "[\\r\\n]", "")
    head = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    # UTC by arithmetic: a formatted timestamp would follow the session's zone
    second = F.lit(BASE_TIME) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1_000_000_000))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(second / 86400).cast("int")).cast("string")
    clock = F.concat_ws(":", *[F.lpad((F.floor(second / by) % of).cast("string"), 2, "0") for by, of in ((3600, 24), (60, 60), (1, 60))])
    stamp = F.concat(day, F.lit("T"), clock, F.lit("Z"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    value = F.concat(
        F.lit("WARC/1.0\r\n"),
        head("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        head("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(":"), F.col("row"), F.lit(">"))),
        head("WARC-Target-URI", clean),
        head("WARC-Date", stamp),
        head("X-URL-Key", F.regexp_replace(url_key(F.col("url")), "[\\r\\n]", "")),
        head("X-Payload-SHA1", F.col("sha")),
        head("X-Payload-Length", F.col("size")),
        F.when(revisit, head("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first"), F.lit(">")))).otherwise(""),
        head("Content-Length", F.octet_length(body)),
        F.lit("\r\n"),
        body,
    )
    return typed.select("row", F.when(revisit, 0).otherwise(F.col("size")).alias("size"), value.alias("value"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write one record per row of (page_id, url, html) as gzip WARC files below ``folder``."""
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    parts = max(1, -(-total // ARCHIVE_BYTES))
    dealt = _records(pages, min_bytes).repartition(parts, "row").select("value")
    dealt.write.option("lineSep", END).option("compression", "gzip").text(folder)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of each archive, sorted: a run. Digests are taken of the payload that is read."""
    import hashlib

    for batch in batches:
        for content in batch.column("content"):
            data = zlib.decompress(content.as_buffer(), 31)
            rows, at = [], 0
            while at < len(data):
                stop = data.index(b"\r\n\r\n", at)
                lines = data[at:stop].decode("utf-8").split("\r\n")
                head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
                length = int(head["Content-Length"])
                payload = memoryview(data)[stop + 4 : stop + 4 + length]
                at = stop + 4 + length + 4
                kind = head["WARC-Type"]
                page, row = head["WARC-Record-ID"][10:-1].split(":")
                sha = hashlib.sha1(payload).digest() if kind == "response" else bytes.fromhex(head["X-Payload-SHA1"])
                if sha.hex() != head["X-Payload-SHA1"]:
                    raise ValueError(f"archive record of page {page} is damaged")
                size = length if kind == "response" else int(head["X-Payload-Length"])
                refers = int(head["WARC-Refers-To"][10:-1]) if kind == "revisit" else None
                digest = base64.b32encode(sha).decode()
                rows.append((head["X-URL-Key"], head["WARC-Date"], int(page) if page else None, int(row), kind, refers, size, digest))
            rows.sort(key=lambda r: (r[0], r[1], r[3]))
            columns = list(zip(*rows)) or [()] * len(_FIELDS)
            key, stamp, page, row, kind, refers, size, digest = columns
            kinds = [pa.int64() if t == "long" else pa.string() for t in _FIELDS.values()]
            values = (page, row, key, stamp, kind, refers, size, digest)
            yield pa.RecordBatch.from_arrays([pa.array([list(v)], pa.list_(t)) for v, t in zip(values, kinds)], list(_FIELDS))


def read_archives(spark, folder: str) -> DataFrame:
    """One row per archive: its index as arrays, sorted by (url_key, stamp, row), which is its run."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    kinds = ", ".join(f"{c} array<{t}>" for c, t in _FIELDS.items())
    return files.select("content").mapInArrow(_parsed, kinds)


def merge_runs(runs: list[list]) -> Iterator:
    """All items of the sorted runs in order, by a tree of losers: one comparison per level and item."""
    k = len(runs)
    if not k:
        return
    at = [0] * k
    head: list = [run[0] if run else None for run in runs]

    def beats(i: int, j: int) -> bool:
        """Run i's head goes before run j's; used-up runs go last."""
        if head[i] is None or head[j] is None:
            return head[i] is not None
        return (head[i], i) < (head[j], j)

    # leaves are k .. 2k-1; inner node p holds the loser of its match, node 0 the winner
    losers = [0] * k
    winner = [0] * k + list(range(k))
    for p in range(k - 1, 0, -1):
        a, b = winner[2 * p], winner[2 * p + 1]
        winner[p], losers[p] = (a, b) if beats(a, b) else (b, a)
    top = winner[1] if k > 1 else 0
    while head[top] is not None:
        yield head[top]
        at[top] += 1
        head[top] = runs[top][at[top]] if at[top] < len(runs[top]) else None
        p = (top + k) // 2
        while p >= 1:
            if beats(losers[p], top):
                losers[p], top = top, losers[p]
            p //= 2


class _Slice:
    """A sorted piece of a run as Arrow arrays; captures become Python values one at a time."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.columns = [batch.column(c)[k].values for c in ("url_key", "stamp", "row")]

    def __len__(self) -> int:
        return len(self.columns[0])

    def __getitem__(self, i: int) -> tuple:
        return tuple(c[i].as_py() for c in self.columns)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the index: the archives' slices of it merged into one order."""
    slices = [_Slice(batch, k) for batch in batches for k in range(batch.num_rows)]
    held: list = []
    last, seq = None, 0

    def emit():
        key, row, n = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(row, pa.int64()), pa.array(n, pa.int64())], ["key", "m_row", "seq"])

    for key, _, row in merge_runs(slices):
        seq = seq + 1 if key == last else 1
        last = key
        held.append((key, row, seq))
        if len(held) == 10_000:
            yield emit()
            held = []
    if held:
        yield emit()


def capture_histories(runs: DataFrame) -> DataFrame:
    """Index rows of all runs with ``capture``: the place of the capture in the history of its url key.

    Ranges are cut by (url key, time, row), so one url with very many captures
    is spread over ranges; the counts of earlier ranges are added afterwards.
    """
    spark = runs.sparkSession
    index = runs.select(F.explode(F.arrays_zip(*_FIELDS)).alias("x")).select("x.*")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = runs.agg(F.sum(F.size("row"))).first()[0] or 0
    # about SAMPLE captures in all, whatever the number of archives
    thin = F.pmod(F.xxhash64("row"), F.lit(-(-n // SAMPLE) or 1)) == 0
    drawn = index.select("url_key", "stamp", "row").where(thin).collect()
    drawn = sorted((r["url_key"], r["stamp"], r["row"]) for r in drawn)
    limits = sorted({drawn[len(drawn) * i // parts] for i in range(1, parts)}) if drawn else []

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                columns = [batch.column(c)[k].values for c in ("url_key", "stamp", "row")]
                run = list(zip(*(c.to_pylist() for c in columns)))
                cuts = [0, *(bisect_left(run, x) for x in limits), len(run)]
                spans = [(r, a, b) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                if spans:
                    offsets = pa.array([spans[0][1], *(b for _, _, b in spans)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r for r, _, _ in spans], pa.int32()), *(pa.ListArray.from_arrays(offsets, c) for c in columns)],
                        ["range", "url_key", "stamp", "row"],
                    )

    kinds = "range int, url_key array<string>, stamp array<string>, row array<long>"
    dealt = runs.select("url_key", "stamp", "row").mapInArrow(sliced, kinds).repartitionById(len(limits) + 1, F.col("range"))
    merged = dealt.select("url_key", "stamp", "row").mapInArrow(_merged, "key string, m_row long, seq long").withColumn("range", F.spark_partition_id())
    merged = materialize(merged, "captures")
    ends = merged.groupBy("key", "range").agg(F.max("seq").alias("n"))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spread = ends.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).where("before > 0").drop("n")
    placed = merged.join(spread, ["key", "range"], "left").select(
        "m_row", (F.col("seq") + F.coalesce("before", F.lit(0))).alias("capture")
    )
    return index.join(placed, F.col("row") == F.col("m_row")).drop("m_row")


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as WARC archives, read them back, and return their merged capture index.

    Defined results: a null html is an empty payload; payloads under
    ``min_bytes`` are always responses, as are rows without a page_id; rows
    that repeat the smallest page_id of a payload are all responses; a null
    url has an empty key; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_archives(pages.select("page_id", "url", "html"), folder, min_bytes)
    return capture_histories(materialize(read_archives(spark, folder), "warc-runs"))


def op5_warc(pages: DataFrame) -> DataFrame:
    return archive_pages(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "stamp", "capture"
    )
