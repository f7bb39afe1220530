"""URL rules by expression lookup: host suffixes times path prefixes, short digests first.

Each url gives one expression per (host suffix, path prefix of a length that
some rule has). Expressions meet the rules on the first eight hex digits of
their digest, an equi-join; the full digest confirms. Of the rules that fit,
the longest wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import maybe_broadcast

#: (action, host, path) of the production rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
SHORT = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expressions(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Array of host suffix + path prefix for every prefix length that rules have."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(fitting, lambda n: F.concat(s, F.substring(path, 1, n)))))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules with digests; of two rules with one expression, block counts."""
    frame = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    named = frame.select(F.concat("host", "path").alias("rule"), "verdict").groupBy("rule").agg(F.max("verdict").alias("verdict"))
    return named.withColumn("digest", F.sha2("rule", 256)).withColumn("short", F.substring("digest", 1, SHORT))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    default: str = DEFAULT,
    url_col: str = "url",
) -> DataFrame:
    """The input columns in a struct ``page``, with host, path, rule and verdict.

    Defined results: a null url or one without ``://`` has empty host and path
    and gets the default, as does a url that no rule fits; repeated rows are
    judged alike; an empty table gives an empty result. Lookups run once per
    distinct (host, path), so a hot page costs one; the distinct pairs are
    counted and the matches broadcast only within the bound.
    """
    lengths = sorted({len(p) for _, _, p in rules})
    url = F.col(f"`{url_col}`")
    parsed = pages.select(F.struct("*").alias("page"), host_of(url).alias("host"), path_of(url).alias("path"))
    table = rule_table(pages.sparkSession, rules)
    table = maybe_broadcast(table.withColumnRenamed("digest", "rule_digest"), len(rules))
    tried = (
        parsed.select("host", "path").where("host != ''").distinct()
        .withColumn("tried", F.explode(expressions(F.col("host"), F.col("path"), lengths)))
        .withColumn("digest", F.sha2("tried", 256))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    hits = tried.join(table, "short").where("digest = rule_digest")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    judged = parsed.join(best, ["host", "path"], "left")
    return judged.select(
        "page", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def op8_urls(pages: DataFrame) -> DataFrame:
    out = judge(pages.select("page_id", "url"))
    return out.select("page.page_id", "host", "path", "rule", "verdict")


OP8_SQL = r"""
WITH r(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), u AS (
  SELECT page_id, coalesce(lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), fit AS (
  SELECT page_id, h || p AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, h || p DESC) AS k
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (page_id)
"""
