"""Queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyward.llm.common import read_table
from tallyward.llm.fingerprints import op2_fingerprints
from tallyward.llm.licenses import OP10_SQL, op10_licenses
from tallyward.llm.lines import OP13_SQL, op13_lines
from tallyward.llm.mixing import op7_mixing
from tallyward.llm.neardup import op4_neardup
from tallyward.llm.negatives import OP11_SQL, op11_negatives
from tallyward.llm.pieces import op3_pieces
from tallyward.llm.quality import OP1_SQL, op1_quality
from tallyward.llm.spelling import OP12_SQL, op12_spelling
from tallyward.llm.suffixes import op9_suffix
from tallyward.llm.toxicity import op6_toxicity
from tallyward.llm.urlrules import OP8_SQL, op8_urls
from tallyward.llm.warc import op5_warc


def _on(table: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(read_table(spark, sf_dir, table))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": _on("documents", op1_quality),
    "op2_fingerprints": _on("documents", op2_fingerprints),
    "op3_pieces": _on("documents", op3_pieces),
    "op4_neardup": _on("documents", op4_neardup),
    "op5_warc": _on("pages", op5_warc),
    "op6_toxicity": lambda spark, d: op6_toxicity(read_table(spark, d, "documents"), read_table(spark, d, "labels")),
    "op7_mixing": _on("documents", op7_mixing),
    "op8_urls": _on("pages", op8_urls),
    "op9_suffix": _on("documents", op9_suffix),
    "op10_licenses": _on("documents", op10_licenses),
    "op11_negatives": _on("embeddings", op11_negatives),
    "op12_spelling": _on("documents", op12_spelling),
    "op13_lines": _on("documents", op13_lines),
}

ORACLES: dict[str, str] = {
    "op1_quality": OP1_SQL,
    "op8_urls": OP8_SQL,
    "op10_licenses": OP10_SQL,
    "op11_negatives": OP11_SQL,
    "op12_spelling": OP12_SQL,
    "op13_lines": OP13_SQL,
}
