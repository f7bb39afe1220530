"""Quality rules with thresholds that adapt to each language and source.

Metrics are whole-text counts. Per (language, source) each metric keeps a
histogram with five significant bits per value (relative error at most 1/16):
a quantile sketch that merges by adding counts, so it does not depend on how
rows are dealt out, and its size is bounded by the octaves of the metric. The
quartiles read from it give Tukey fences, and the fences are joined back.

Defined results: a null text has no words; null languages and sources are
groups of their own; repeated rows are judged alike; an empty table gives an
empty result; columns of the input are kept under their names in ``carry``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import maybe_broadcast
from tallyward.session import materialize

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
#: Fences: this many quartile distances beyond the quartiles ...
SPREAD = 3
#: ... plus a slack per metric, so that a group of near-equal values rejects nobody for a trifle.
SLACK = {"word_milli": 1500, "symbols_milli": 200, "dup_lines_milli": 30}
#: Sides of the fence that reject.
LOW_SIDE = ("word_milli",)
GROUPS_BOUND = 200_000
#: Usable documents under which a group's quartiles are mixed with those of its parent (``supported_fences``).
SUPPORT = 30
#: A group's fence lies no farther out than this many reaches beyond the quartiles of its parent.
FAR = 2
#: Metrics that are not compared across languages: word lengths depend on the script.
OF_LANGUAGE = ("word_milli",)

_SPACE = "[\\x20\\x09-\\x0D]+"


def _repeated_words(words: Column) -> Column:
    """Words inside windows that the text holds twice or more."""
    w = REPEAT_WINDOW
    starts = F.sequence(F.lit(1), F.size(words) - (w - 1))
    hashed = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, w)))
    pairs = F.array_sort(F.zip_with(hashed, starts, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def hits(p: Column) -> Column:
        same = lambda a, b: (a["h"] == b["h"]) & (F.slice(words, a["i"], w) == F.slice(words, b["i"], w))
        flagged = F.transform(
            p,
            lambda x, k: F.struct(
                x["i"].alias("i"),
                (
                    F.coalesce(same(F.get(p, k - 1), x), F.lit(False))
                    | F.coalesce(same(F.get(p, k + 1), x), F.lit(False))
                ).alias("hit"),
            ),
        )
        return F.array_sort(F.transform(F.filter(flagged, lambda x: x["hit"]), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda i, k: F.least(F.lit(w), F.coalesce(F.get(at, k + 1) - i, F.lit(w))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)

    bound = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))  # noqa: E731  evaluates once
    some = bound(hashed, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(
        F.size(words) > w, F.when(some, bound(bound(pairs, hits), covered)).otherwise(F.lit(0).cast("long"))
    ).otherwise(F.lit(0).cast("long"))


def text_metrics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike("[^\\x20\\x09-\\x0D]"))
    once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))
    of_words = once(
        words,
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w).alias("n_repeat_words")),
    )
    return F.struct(
        of_words.alias("w"),
        F.length(F.regexp_replace(text, _SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        once(lines, lambda s: (F.size(s) - F.size(F.array_distinct(s))).cast("long")).alias("n_dup_lines"),
    )


def _cell(value: Column) -> Column:
    """The value with all but its five leading bits cleared: the sketch's cell."""
    low = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def _rates() -> dict[str, Column]:
    rate = lambda c, by: F.expr(f"{c} * {by} div greatest(n_words, 1)")
    return {
        "word_milli": rate("word_chars", 1000),
        "symbols_milli": rate("n_symbols", 1000),
        "dup_lines_milli": rate("n_dup_lines", 1000),
    }


def _sketch(metrics: DataFrame, groups: list[str]) -> DataFrame:
    cells = metrics.where(~F.col("base_failed")).select(
        *groups,
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), _cell(c).alias("cell")) for m, c in _rates().items()])
        ).alias("x"),
    )
    return cells.groupBy(*groups, "x.metric", "x.cell").agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    # a sketch has a few hundred cells at most, so these windows are small whatever the group holds
    upto = Window.partitionBy(*groups, "metric").orderBy("cell")
    whole = Window.partitionBy(*groups, "metric")
    ranked = sketch.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    quartile = lambda p: F.min(F.when(F.col("upto") * 4 >= F.col("total") * p, F.col("cell")))
    return ranked.groupBy(*groups, "metric").agg(
        quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("total").alias("total")
    )


def _slack() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv]), F.col("metric"))


def _by_group(limits: DataFrame, groups: list[str]) -> DataFrame:
    return limits.groupBy(*groups).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("high"))).alias(f"{m}_high") for m in SLACK],
        *[F.max(F.when(F.col("metric") == m, F.col("low"))).alias(f"{m}_low") for m in LOW_SIDE],
    )


def supported_fences(metrics: DataFrame) -> DataFrame:
    """Fences per (language, source) that hold with few documents and in groups of mostly junk.

    The sketches of a language's groups are added, and those of all languages.
    Quartiles of under SUPPORT documents are mixed with the parent's (the
    language's, and for it all documents'), the documents weighing against
    the rest of SUPPORT. No fence lies farther out than FAR reaches from the
    parent's quartiles. OF_LANGUAGE metrics have no parent above the language.
    """
    sketch = _sketch(metrics, ["g_lang", "g_source"])
    add = lambda keys: sketch.groupBy(*keys, "metric", "cell").agg(F.sum("n").alias("n"))
    above = _quartiles(add([]), []).where(~F.col("metric").isin(*OF_LANGUAGE))

    def under(own: DataFrame, parent: DataFrame, same: Column, keys: list[str]) -> DataFrame:
        part = F.least(F.col("total") / SUPPORT, F.lit(1.0))
        mixed = lambda q: F.when(
            F.col(f"p_{q}").isNotNull(), part * F.col(q) + (1 - part) * F.col(f"p_{q}")
        ).otherwise(F.col(q))
        joined = own.join(parent.select(*[F.col(c).alias(f"p_{c}") for c in parent.columns]), same, "left")
        rows = joined.select(*keys, "metric", "total", "p_q1", "p_q3", mixed("q1").alias("q1"), mixed("q3").alias("q3"))
        reach = SPREAD * (F.col("q3") - F.col("q1")) + _slack()
        far = FAR * (SPREAD * (F.col("p_q3") - F.col("p_q1")) + _slack())
        # least and greatest pass over a missing parent
        return rows.withColumns(
            {"high": F.least(F.col("q3") + reach, F.col("p_q3") + far), "low": F.greatest(F.col("q1") - reach, F.col("p_q1") - far)}
        )

    metric = F.col("metric") == F.col("p_metric")
    langs = under(_quartiles(add(["g_lang"]), ["g_lang"]), above, metric, ["g_lang"])
    langs = langs.select("g_lang", "metric", "q1", "q3")
    own = _quartiles(sketch, ["g_lang", "g_source"])
    limits = under(own, langs, metric & F.col("g_lang").eqNullSafe(F.col("p_g_lang")), ["g_lang", "g_source"])
    return _by_group(limits, ["g_lang", "g_source"])


def quality_rules(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` as a struct ``doc`` of the carried columns, with metrics and verdict.

    The metrics are computed once and stored; the sketches and the join then
    read thin columns. The fences (``supported_fences``) are broadcast when
    their counted number allows it; otherwise the null-safe join shuffles both
    sides.
    """
    carry = docs.columns if carry is None else carry
    m = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"),
        F.col("lang").alias("g_lang"),
        F.col("source").alias("g_source"),
        text_metrics(F.col("text")).alias("m"),
    )
    flat = m.select(
        "doc", "g_lang", "g_source", "m.w.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.w.n_repeat_words"
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
    )
    stored = materialize(flat, "quality")
    groups = ["g_lang", "g_source"]
    limits = materialize(supported_fences(stored), "quality-fences")
    limits = limits.withColumnsRenamed({g: f"f_{g}" for g in groups})
    limits = maybe_broadcast(limits, limits.count(), GROUPS_BOUND)
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"f_{g}")) for g in groups])
    rates = _rates()
    inside = reduce(
        lambda a, b: a & b,
        [rates[x] <= F.col(f"{x}_high") for x in SLACK] + [rates[x] >= F.col(f"{x}_low") for x in LOW_SIDE],
    )
    return stored.join(limits, same, "left").select(
        "doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


def op1_quality(docs: DataFrame) -> DataFrame:
    out = quality_rules(docs, ["doc_id"])
    return out.select("doc.doc_id", *[c for c in out.columns if c != "doc"])


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k FROM starts
), hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT doc_id, sum(step) AS n_repeat_words FROM (
    SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS step FROM hit
  ) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         word_chars * 1000 // greatest(n_words, 1) AS word_milli,
         n_symbols * 1000 // greatest(n_words, 1) AS symbols_milli,
         n_dup_lines * 1000 // greatest(n_words, 1) AS dup_lines_milli
  FROM m
), long AS (
  SELECT lang, source, 'w' AS metric, word_milli AS v FROM b WHERE NOT base_failed
  UNION ALL SELECT lang, source, 's', symbols_milli FROM b WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'd', dup_lines_milli FROM b WHERE NOT base_failed
), sketch AS (
  SELECT lang, source, metric, (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) AS cell,
         count(*) AS n FROM long GROUP BY ALL
), sl(metric, slack) AS (VALUES ('w', 1500), ('s', 200), ('d', 30)
), own AS (
  SELECT lang, source, metric, max(total) AS total, min(CASE WHEN upto * 4 >= total THEN cell END) AS q1,
         min(CASE WHEN upto * 4 >= total * 3 THEN cell END) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, metric ORDER BY cell) AS upto,
               sum(n) OVER (PARTITION BY lang, source, metric) AS total FROM sketch) GROUP BY ALL
), language AS (
  SELECT lang, metric, max(total) AS total, min(CASE WHEN upto * 4 >= total THEN cell END) AS q1,
         min(CASE WHEN upto * 4 >= total * 3 THEN cell END) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, metric ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY lang, metric) AS total
        FROM (SELECT lang, metric, cell, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY ALL
), everything AS (
  SELECT metric, min(CASE WHEN upto * 4 >= total THEN cell END) AS p1, min(CASE WHEN upto * 4 >= total * 3 THEN cell END) AS p3
  FROM (SELECT *, sum(n) OVER (PARTITION BY metric ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY metric) AS total
        FROM (SELECT metric, cell, sum(n) AS n FROM sketch WHERE metric <> 'w' GROUP BY ALL)) GROUP BY ALL
), parent AS (
  SELECT lang, metric,
         CASE WHEN p1 IS NULL THEN q1 ELSE least(total / 30, 1.0::DOUBLE) * q1 + (1 - least(total / 30, 1.0::DOUBLE)) * p1 END AS p1,
         CASE WHEN p3 IS NULL THEN q3 ELSE least(total / 30, 1.0::DOUBLE) * q3 + (1 - least(total / 30, 1.0::DOUBLE)) * p3 END AS p3
  FROM language LEFT JOIN everything USING (metric)
), mixed AS (
  SELECT o.lang, o.source, o.metric, slack, p1, p3,
         least(total / 30, 1.0::DOUBLE) * q1 + (1 - least(total / 30, 1.0::DOUBLE)) * p1 AS q1,
         least(total / 30, 1.0::DOUBLE) * q3 + (1 - least(total / 30, 1.0::DOUBLE)) * p3 AS q3
  FROM own o JOIN parent p ON o.lang IS NOT DISTINCT FROM p.lang AND o.metric = p.metric JOIN sl ON sl.metric = o.metric
), limits AS (
  SELECT lang, source, metric, greatest(q1 - (3 * (q3 - q1) + slack), p1 - 2 * (3 * (p3 - p1) + slack)) AS low,
         least(q3 + (3 * (q3 - q1) + slack), p3 + 2 * (3 * (p3 - p1) + slack)) AS high FROM mixed
), f AS (
  SELECT lang, source, max(low) FILTER (metric = 'w') AS wl, max(high) FILTER (metric = 'w') AS wh,
         max(high) FILTER (metric = 's') AS sh, max(high) FILTER (metric = 'd') AS dh
  FROM limits GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(word_milli BETWEEN wl AND wh AND symbols_milli <= sh AND dup_lines_milli <= dh, false)
         AS kept
FROM b LEFT JOIN f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source
"""
