"""Line dedup: lines that an earlier document holds too are dropped, the others put together by position.

Lines are exploded to thin rows (document, position, 128-bit hash of the key).
A key is shared if its least and its greatest document differ, which partial
aggregation counts without gathering anybody's documents. Occurrences then
meet the shared keys: keys of very many lines, of which there can be only
HOT_KEYS, are broadcast, all others join on the hash, at most a bounded number
of rows to a key. Texts travel once, to the positions that they lose.

Defined results: a null or empty text is one empty line; rows that repeat an
id are one document; rows without an id are one document behind all others; an
empty table gives an empty result; other columns are not read. Long texts are
many rows before the join, and one row again after it.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.session import materialize

MIN_POINTS = 10
#: Keys with more lines than one in HOT_KEYS of all (and HOT_LINES at least) are hot, so there are fewer than HOT_KEYS.
HOT_KEYS = 10_000
HOT_LINES = 10_000
_BLANK = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tie, pos, h1, h2) of every line whose key has MIN_POINTS code points; tie is a hash of the text."""
    text = F.col(f"`{text_col}`")
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    keys = F.transform(_lines(lowered), lambda s: F.btrim(s, F.lit(_BLANK)))
    exploded = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("tie"), F.posexplode(keys).alias("pos", "key")
    ).where(F.length("key") >= MIN_POINTS)
    return exploded.select("id", "tie", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def dropped_lines(lines: DataFrame) -> DataFrame:
    """(id, tie, pos) of the lines whose key a smaller document holds too."""
    keys = lines.groupBy("h1", "h2").agg(
        F.min("id").alias("first"),
        F.max("id").alias("last"),
        F.count_if(F.col("id").isNull()).alias("nameless"),
        F.count("*").alias("n"),
    )
    shared = materialize(
        keys.where("first < last OR (first IS NOT NULL AND nameless > 0)").select("h1", "h2", "first", "n"), "shared-lines"
    )
    limit = max(HOT_LINES, lines.count() // HOT_KEYS)
    hot = shared.where(F.col("n") > limit).withColumnsRenamed({"h1": "g1", "h2": "g2"}).drop("n")
    marked = lines.join(F.broadcast(hot), F.expr("h1 = g1 AND h2 = g2"), "left")
    later = F.col("id").isNull() | (F.col("id") > F.col("first"))
    of_hot = marked.where(F.col("g1").isNotNull())
    rest = marked.where(F.col("g1").isNull()).drop("g1", "g2", "first")
    of_rest = rest.join(shared.where(F.col("n") <= limit).drop("n"), ["h1", "h2"])
    return of_hot.where(later).select("id", "tie", "pos").unionByName(of_rest.where(later).select("id", "tie", "pos"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: the struct ``doc`` of the carried columns, n_lines, n_dropped and the text ``kept``."""
    lines = materialize(line_rows(docs, id_col, text_col), "lines")
    gone = dropped_lines(lines).groupBy("id", "tie").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    carry = docs.columns if carry is None else carry
    texts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"),
        F.col(f"`{id_col}`").cast("long").alias("d_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("d_tie"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("whole"),
    )
    same = F.col("d_id").eqNullSafe(F.col("id")) & (F.col("d_tie") == F.col("tie"))
    split = texts.join(gone, same, "left").select(
        "doc", "whole", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"), _lines(F.col("whole")).alias("all")
    )
    # the stretches between the dropped positions, each cut out once
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("all")))
    between = F.transform(
        F.sequence(F.lit(1), F.size("gone") + 1),
        lambda k: F.slice(
            F.col("all"), F.get(F.col("edges"), k - 1) + 2, F.get(F.col("edges"), k) - F.get(F.col("edges"), k - 1) - 1
        ),
    )
    kept = F.when(F.size("gone") == 0, F.col("whole")).otherwise(F.array_join(F.flatten(between), "\n"))
    return split.withColumn("edges", edges).select(
        "doc", F.size("all").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), kept.alias("kept")
    )


def op13_lines(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs, carry=["doc_id"])
    return out.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS s,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), k AS (
  SELECT *, translate(trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT k.*, first IS NOT NULL AND doc_id <> first AS gone FROM k LEFT JOIN f USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(s, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
