"""Spelling variants: words one edit apart, found by pivotal grams, and the form that each is a variant of.

Bigrams are ordered by the number of words that hold them, rare ones first. A
word's gram prefix is its first three places in that order, with every further
place of the third one's gram. Two disjoint places of the prefix, the rarest
pair by dynamic programming, are the word's pivots. One edit touches at most
one of two disjoint bigrams. So of two words one edit apart, take the one
whose prefix ends earlier in the order: one of its pivots stands in the other
word too, in that word's prefix, at a place that differs by one at most.

The edit lies behind the first pivot or before the second one, as they are
disjoint. In the one case the other word starts alike up to the end of the
first pivot, which stands at the same place; in the other it ends alike from
the second one on, at the same place from the end. So each word is looked up
by the hash of its start up to the first pivot and of its end from the second,
among the starts and ends at the prefix places of the words that are as long,
or one shorter or longer. What meets is compared by a mask of its grams and
verified with a bounded edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import lean, text_batches
from tallyward.session import materialize

MIN_POINTS = 5
MIN_COUNT = 3
#: One in so many (document, run) pairs loses a code point, as the contract of the query has it.
TYPO = 97
#: A form has at least this many times the occurrences of its variant.
FORM_TIMES = 2
#: Distinct words that a task counts before it hands them on, and text bytes matched at once as a list.
HELD_WORDS = 400_000
LONG_TEXT = 1 << 22
_RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_POINTS},}}")
#: Places in a gram prefix: one edit touches two bigrams, so three places leave one.
PREFIX = 3


def _runs(text: str) -> Iterable[str]:
    """Runs of at least MIN_POINTS letters; shorter ones cannot become words."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
    return _RUN.findall(text) if len(text) <= LONG_TEXT else (m.group() for m in _RUN.finditer(text))


def with_typo(doc_id: int | None, run: str) -> str:
    """The run without one code point where the hash of document and run says so; no id, no typo."""
    if doc_id is not None:
        h = zlib.crc32(run.encode(), zlib.crc32(b"%d:" % doc_id))
        if h % TYPO == 0:
            at = h % len(run)
            return run[:at] + run[at + 1 :]
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
            start = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
            for run, n in Counter(_runs(text.as_py() or "")).items():
                if start is not None and zlib.crc32(run.encode(), start) % TYPO == 0:
                    run = with_typo(doc_id, run)
                if len(run) >= MIN_POINTS:
                    total[run] += n
            if len(total) > HELD_WORDS:
                yield emit()
                total.clear()
    if total:
        yield emit()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over all documents, counted per task first."""
    text_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return slim.mapInArrow(lean(_counted), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_order(words: DataFrame) -> dict[str, int]:
    """Number of words of every bigram. The alphabet has 90 letters, so there are at most 8,100."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = F.array_distinct(F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(2))))
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return {r["gram"]: r["n"] for r in counts.collect()}


def prefix_places(ranks: list[int]) -> list[int]:
    """Places whose gram is among the first PREFIX places in the order, ties with the last of them included."""
    if len(ranks) <= PREFIX:
        return list(range(len(ranks)))
    limit = sorted(ranks)[PREFIX - 1]
    return [i for i, r in enumerate(ranks) if r <= limit]


def pivots(places: list[int], cost: list[int]) -> tuple[int, int]:
    """Two disjoint places (at least two apart) of least total cost, by dynamic programming along the word."""
    best: tuple[float, int, int] = (float("inf"), -1, -1)
    one: list[tuple[int, int]] = []  # cheapest single place up to and with places[k]
    behind = 0  # places before this one are disjoint from the present one
    for p, c in zip(places, cost):
        while places[behind] <= p - 2:
            behind += 1
        if behind:
            before, q = one[behind - 1]
            best = min(best, (before + c, q, p))
        one.append(min((c, p), one[-1]) if one else (c, p))
    return best[1], best[2]


def _rolled(word: str) -> list[int]:
    """Hash of each prefix of the word, the empty one first."""
    h, out = 1, [1]
    for c in word:
        h = (h * 0x9E3779B97F4A7C15 + ord(c) * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF
        h ^= h >> 29
        out.append(h)
    return out


def _signatures(order: dict[str, int]):
    ranked = {g: k for k, (_, g) in enumerate(sorted((n, g) for g, n in order.items()))}
    count = [order[g] for g in ranked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            wid, key, behind, size, mask, pivot = zip(*out) if out else ((),) * 6
            out.clear()
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(wid, pa.int64()), signed(key), pa.array(behind, pa.bool_()), pa.array(size, pa.int32()), signed(mask), pa.array(pivot, pa.bool_())],
                ["id", "key", "behind", "size", "mask", "pivot"],
            )

        for batch in batches:
            for wid, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
                n = len(word)
                ranks = [ranked[word[i : i + 2]] for i in range(n - 1)]
                mask = 0
                for r in ranks:
                    mask |= 1 << (r & 63)
                upto, back = _rolled(word), _rolled(word[::-1])
                places = prefix_places(ranks)
                for g in places:
                    out.append((wid, upto[g + 2], False, n, mask, False))
                    out.append((wid, back[n - g], True, n, mask, False))
                    if len(out) > 100_000:
                        yield flush()
                p, q = pivots(places, [count[ranks[i]] for i in places])
                for size in (n - 1, n, n + 1):
                    out.append((wid, upto[p + 2], False, size, mask, True))
                    out.append((wid, back[n - q], True, size, mask, True))
            yield flush()

    return run


def near_words(words: DataFrame) -> DataFrame:
    """(a, b) for the frame (id, word, ...): all pairs of ids, a < b, whose words are one edit apart."""
    signed = words.select("id", "word").mapInArrow(
        lean(_signatures(gram_order(words))), "id long, key long, behind boolean, size int, mask long, pivot boolean"
    )
    signed = materialize(signed, "grams")
    key = ["key", "behind", "size"]
    looked = signed.where("pivot").select(*key, F.col("id").alias("x"), F.col("mask").alias("mx"))
    placed = signed.where("NOT pivot").select(*key, F.col("id").alias("y"), F.col("mask").alias("my"))
    # one edit takes two grams away at most and brings two
    found = looked.join(placed, key).where("x != y AND bit_count(mx ^ my) <= 4")
    pairs = found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    spelled = words.select("id", "word")
    both = pairs.join(spelled.toDF("a", "wa"), "a").join(spelled.toDF("b", "wb"), "b")
    return both.where(F.levenshtein("wa", "wb", 1) == 1).select("a", "b")


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for links (id, form) that never close a ring: each round doubles the steps."""
    now = materialize(forms.select("id", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        stepped = now.join(ahead, "root", "left")
        stepped = materialize(stepped.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = stepped.select("id", "root")
        if not stepped.where("moved").head(1):
            return now


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: word, n, form, root, n_near, form_n.

    A form is the near word of most occurrences, if it has FORM_TIMES as many
    as the word; equal counts go by code points. Forms have strictly more
    occurrences, so following them ends.

    Defined results: a null text has no words; without an id no typo is made;
    rows that repeat an id or a text all count; an empty table gives an empty
    result; other columns are not read. A run of letters of any length is one
    word: only its id travels with its grams.
    """
    counted = word_counts(docs, id_col, text_col).where(F.col("n") >= MIN_COUNT)
    words = materialize(counted.withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = materialize(near_words(words), "near-words")
    ways = pairs.union(pairs.select("b", "a")).toDF("id", "other")
    seen = ways.join(words.select(F.col("id").alias("other"), F.col("n").alias("other_n"), F.col("word").alias("other_word")), "other")
    most = F.struct((-F.col("other_n")).alias("order"), F.col("other_word").alias("word"), F.col("other").alias("id"))
    best = seen.groupBy("id").agg(F.count("*").alias("n_near"), F.min(most).alias("best"))
    joined = words.join(best, "id", "left")
    is_form = -F.col("best.order") >= FORM_TIMES * F.col("n")
    told = materialize(
        joined.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, -F.col("best.order")).alias("form_n"),
            F.when(is_form, F.col("best.id")).alias("form_id"),
        ),
        "word-forms",
    )
    last = roots(told.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    named = last.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    out = told.join(named, "id", "left")
    return out.select("word", "n", "form", F.coalesce("root_word", "word").alias("root"), "n_near", "form_n")


def op12_spelling(docs: DataFrame) -> DataFrame:
    return spelling_groups(docs)


OP12_SQL = r"""
WITH RECURSIVE r AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS raw FROM documents
), low AS (
  SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM r GROUP BY ALL HAVING length(run) >= 5
), bits AS (
  -- each byte, then seven empty steps: the checksum moves by one bit a step
  SELECT *, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [unicode(x), -1, -1, -1, -1, -1, -1, -1]
         ELSE [192 | (unicode(x) >> 6), -1, -1, -1, -1, -1, -1, -1,
               128 | (unicode(x) & 63), -1, -1, -1, -1, -1, -1, -1] END))::BIGINT[] AS b
  FROM low
), h AS (
  SELECT doc_id, run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda s, x:
    xor((CASE WHEN x >= 0 THEN xor(s, x) ELSE s END) >> 1,
        3988292384::BIGINT * ((CASE WHEN x >= 0 THEN xor(s, x) ELSE s END) & 1))), 4294967295::BIGINT) AS h
  FROM bits
), typo AS (
  SELECT CASE WHEN doc_id IS NOT NULL AND h % 97 = 0
              THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c
  FROM h
), w AS (
  SELECT word, sum(c)::BIGINT AS n FROM typo WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), del AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)
), pairs AS (
  SELECT a.word AS a, b.word AS b FROM del a JOIN del b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT d.word, w.word FROM del d JOIN w ON d.v = w.word
  UNION SELECT w.word, d.word FROM del d JOIN w ON d.v = w.word
), near AS (
  SELECT a AS word, count(*) AS n_near, max(x.n) AS best FROM pairs JOIN w x ON x.word = b GROUP BY a
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN best >= 2 * w.n THEN best END AS form_n,
         CASE WHEN best >= 2 * w.n
              THEN (SELECT min(b) FROM pairs JOIN w y ON y.word = b WHERE a = w.word AND y.n = best) END AS form
  FROM w LEFT JOIN near USING (word)
), up AS (
  SELECT word, word AS root FROM f
  UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.form, up.root, f.n_near, f.form_n
FROM f JOIN up USING (word) JOIN f g ON g.word = up.root WHERE g.form IS NULL
"""
