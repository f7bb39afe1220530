"""License notices and licence texts by digest of their canonical form.

Canonical form: lower case, copyright clauses dropped, equivalent spellings
made one, everything but letters and digits turned into single spaces, so that
line breaks do not count. Every run of words that is as long as a known text
is looked up by a difference of prefix hashes; the SHA-256 digests of the runs
found are joined with the digests of the known texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.common import lean, maybe_broadcast, mix, powers, slices, text_batches, words
from tallyward.session import materialize

# Public licence texts and notices, by SPDX name.
KNOWN: dict[str, tuple[str, ...]] = {
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
    ),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.",),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

# Spellings that mean the same, as (pattern on the folded text, replacement).
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("organisation", "organization"),
    ("non commercial", "noncommercial"),
    ("version 2 0", "v2 0"),
    ("v 2 0", "v2 0"),
)

_COPYRIGHT = "(?i)^[^a-z0-9]*(copyright|\\(c\\)|©)"

#: Titles that stand before a text or not, and where a text is also given without its front or end matter.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
}
STARTS = {"GPL": "Everyone is permitted to copy", "LGPL": "Everyone is permitted to copy", "CC0": "Statement of Purpose"}
ENDS = ("END OF TERMS AND CONDITIONS", "For more information, please refer to <http")
#: Wordings of a text that are in use side by side.
WORDINGS = {
    "BSD-2-Clause": (("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"),),
    "BSD-3-Clause": (("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"),),
    "ISC": (("and/or distribute", "and distribute"),),
}
#: A text's first paragraph that another licence's notice is a part of.
OPENINGS = ("ISC",)


@cache
def known_texts() -> dict[str, tuple[str, ...]]:
    """KNOWN and the complete texts in ``license_texts/`` with their titles, numberings and wordings."""
    out = {name: list(texts) for name, texts in KNOWN.items()}
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        name, full = path.stem, path.read_text("utf-8")
        bodies = [full]
        for end in ENDS:
            bodies += [b[: b.index(end) + (len(end) if end.isupper() else 0)] for b in bodies if end in b]
        start = STARTS.get(name.split("-")[0])
        if start:
            bodies += [b[b.index(start) :] for b in bodies]
        for seen, used in WORDINGS.get(name, ()):
            bodies += [re.sub(r"\s+".join(map(re.escape, seen.split())), used, b) for b in bodies]
        if name.startswith("BSD"):
            bodies += [re.sub(r"(?m)^\s*\d\.", "", b) for b in bodies]
        texts = bodies + [f"{title}\n{b}" for title in TITLES.get(name, ()) for b in bodies]
        if name in OPENINGS:
            texts += [b.split("\n\n")[0] for b in bodies]
        out.setdefault(name, []).extend(dict.fromkeys(texts))
    return {name: tuple(texts) for name, texts in out.items()}


def _openers(known: Mapping[str, tuple[str, ...]]) -> str:
    """Pattern of the first two words of every known text."""
    pairs = {tuple(re.findall("[a-z0-9]+", t.lower())[:2]) for texts in known.values() for t in texts}
    return "|".join(sorted("[^a-z0-9]+".join(p).replace("licens", "licen[cs]").replace("licence", "licen[cs]e") for p in pairs))


def _clause(known: Mapping[str, tuple[str, ...]]) -> str:
    """Pattern of a copyright clause: from the start of a line to its end, or to where a known text may start.

    A line of a wrapped text that goes on with "copyright holders" or the like is none.
    """
    term = "notices?|holders?|owners?|licen[cs]es?|laws?|and|or|statements?|interests?|treaty|in|is|on|to|for|of"
    mark = rf"copyright\b(?![^a-z0-9]*(?:{term})\b)|\(c\)[^a-z0-9\n]*(?:\d{{4}}|copyright\b)|©"
    end = rf"(?=\b(?:{_openers(known)})\b|\n|\z)"
    return rf"(?i)(?<![^\n])[^a-z0-9\n]*(?:(?:{mark})[^\n]*?{end}|all rights reserved[^a-z0-9\n]*(?=\n|\z))"


def canonical(text: Column, known: Mapping[str, tuple[str, ...]]) -> Column:
    """Canonical form of a whole text."""
    folded = F.trim(F.regexp_replace(F.lower(F.regexp_replace(text, _clause(known), " ")), "[^a-z0-9]+", " "))
    for seen, used in (*SPELLINGS, ("https", "http")):
        folded = F.regexp_replace(folded, rf"\b{seen}\b", used)
    return folded


def known_digests(spark, known: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """(digest, license, canon) of every known text."""
    rows = [(name, text) for name, texts in known.items() for text in texts]
    frame = spark.createDataFrame(rows, "license string, text string")
    canon = frame.select(canonical(F.col("text"), known).alias("canon"), "license").where("canon <> ''").distinct()
    return canon.select(F.sha2("canon", 256).alias("digest"), "license", "canon")


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Words of a run's start that are looked up before the whole run.
START = 4


def _prefixes(h: np.ndarray) -> np.ndarray:
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum((h | np.uint64(1)) * powers(len(h), _BASE), out=total[1:])
    return total


def _runs(total: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words from the places ``at``."""
    return mix((total[at + size] - total[at]) * powers(len(total), _INVERSE)[at])


def _finder(known: list[str]):
    """For every row (doc_id, digests, whole): the runs that are known texts and lie in no longer such run."""
    by_start: dict[int, list[tuple[int, int]]] = {}
    sizes = [len(c.split()) for c in known]
    width = min([START, *sizes])
    for canon, size in zip(known, sizes):
        h, _ = words(np.frombuffer(canon.encode(), np.uint8), np.array([0, len(canon)]), lower=False)
        total, zero = _prefixes(h), np.zeros(1, np.int64)
        by_start.setdefault(int(_runs(total, zero, width)[0]), []).append((size, int(_runs(total, zero, size)[0])))
    by_start = {k: sorted(set(v), reverse=True) for k, v in by_start.items()}
    heads = np.array(sorted(by_start), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests: list[list[str]] = [[] for _ in range(batch.num_rows)]
            whole = [False] * batch.num_rows
            for lo, _, data, starts in slices(batch.column("canon")):
                h, first = words(data, starts, lower=False)
                if len(h) < width or not len(heads):
                    continue
                total = _prefixes(h)
                hashed = _runs(total, np.arange(len(h) - width + 1), width)
                near = np.minimum(np.searchsorted(heads, hashed), len(heads) - 1)
                end, last = 0, -1
                for at in np.flatnonzero(heads[near] == hashed):
                    row = int(np.searchsorted(first, at, "right")) - 1
                    if row != last:
                        end, last, split = 0, row, None
                    for size, full in by_start[int(hashed[at])]:
                        # places ascend and sizes descend, so a run is inside another if it ends no later
                        if end < at + size <= first[row + 1] and int(_runs(total, np.array([at]), size)[0]) == full:
                            split = split or data[starts[row] : starts[row + 1]].tobytes().split(b" ")
                            text = b" ".join(split[at - first[row] : at - first[row] + size])
                            end = at + size
                            digests[lo + row].append(hashlib.sha256(text).hexdigest())
                            whole[lo + row] |= bool(size == first[row + 1] - first[row])
                            break
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digests, pa.list_(pa.string())), pa.array(whole, pa.bool_())],
                ["doc_id", "digests", "whole"],
            )

    return run


def scan_licenses(
    docs: DataFrame, known: Mapping[str, tuple[str, ...]] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, licenses (sorted, comma-separated, null if none), n_notices, whole_text.

    A known text counts wherever its words follow each other, across line
    breaks and inside other text, unless they are part of a longer known text.
    ``whole_text`` tells that the canonical whole text is a known one. Equal
    texts inside a document count once. Only matches leave the scan; their
    digests are joined with the known ones.

    Defined results: a null or empty text has no notice; each row has the
    notices of its own text, whatever its id; an empty table gives an empty
    result; other columns are not read.
    """
    spark = docs.sparkSession
    known = known_texts() if known is None else known
    text_batches(spark)
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    texts = known_digests(spark, known).collect()
    table = spark.createDataFrame([(r["digest"], r["license"]) for r in texts], "digest string, license string")
    table = maybe_broadcast(table, len(texts))
    canon = slim.select("doc_id", canonical(F.col("text"), known).cast("binary").alias("canon"))
    fields = [
        slim.schema["doc_id"],
        T.StructField("digests", T.ArrayType(T.StringType())),
        T.StructField("whole", T.BooleanType()),
    ]
    # stored with a number for each row: what a row holds is joined back to that row, whatever its id
    scanned = canon.mapInArrow(lean(_finder(sorted({r["canon"] for r in texts}))), T.StructType(fields))
    rows = materialize(scanned.withColumn("row", F.monotonically_increasing_id()), "licence-scan")
    hits = rows.where(F.size("digests") > 0).select("row", F.explode("digests").alias("digest")).join(table, "digest")
    found = hits.groupBy("row").agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.countDistinct("digest").alias("n_notices")
    )
    return rows.join(found, "row", "left").select(
        "doc_id", "licenses", F.coalesce("n_notices", F.lit(0)).alias("n_notices"), F.col("whole").alias("whole_text")
    )


def op10_licenses(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs.select("doc_id", "text"))


def _sql_canonical(column: str) -> str:
    folded = f"trim(regexp_replace(lower({column}), '[^a-z0-9]+', ' ', 'g'))"
    for seen, used in SPELLINGS:
        folded = f"regexp_replace({folded}, '\\b{seen}\\b', '{used}', 'g')"
    return f"CASE WHEN regexp_matches({column}, '{_COPYRIGHT}') THEN '' ELSE {folded} END"


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP10_SQL = f"""
WITH known AS (
  SELECT DISTINCT license, {_sql_canonical("t")} AS c
  FROM (VALUES {", ".join(f"({_sql_text(n)}, {_sql_text(t)})" for n, ts in KNOWN.items() for t in ts)}) k(license, t)
), cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), folded AS (
  SELECT doc_id, i, {_sql_canonical("line")} AS c FROM cut
), parts AS (
  SELECT DISTINCT doc_id, c, false AS whole FROM folded WHERE c <> ''
  UNION ALL
  SELECT doc_id, string_agg(c, ' ' ORDER BY i), true FROM folded WHERE c <> '' GROUP BY doc_id
), hit AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
         count(DISTINCT CASE WHEN NOT whole THEN c END) AS n_notices, bool_or(whole) AS whole_text
  FROM parts JOIN known USING (c) GROUP BY doc_id
)
SELECT doc_id, licenses, coalesce(n_notices, 0) AS n_notices, coalesce(whole_text, false) AS whole_text
FROM documents LEFT JOIN hit USING (doc_id)
"""
