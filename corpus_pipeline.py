"""From raw documents to sampled pieces: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last
return the columns of ``documents``. No SQL can state these stages as a whole
(ORACLE_SQL is None); they are tested against brute force on small fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import read_table
from tallyward.llm.mixing import mix_sources
from tallyward.llm.neardup import drop_near_duplicates
from tallyward.llm.pieces import sample_pieces
from tallyward.llm.quality import quality_rules
from tallyward.llm.suffixes import remove_repeats
from tallyward.operators.ordered import running_totals
from tallyward.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs).where("kept").select("doc.*")


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that start earlier; a document may end up empty and stays."""
    out = remove_repeats(docs, carry=docs.columns, as_text=True)
    cut = {"text": F.when(F.col("carry.text").isNotNull(), F.col("kept")), "n_chars": F.length("kept").cast("long")}
    return out.select(*[cut.get(c, F.col(f"carry.`{c}`")).alias(c) for c in docs.columns])


def mix_by_weight(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many words of every source as the mix takes: whole documents, once per time, and at most one that is cut.

    A document taken in part would make the written mix another one than was
    computed. So the words taken in parts are added up per source and given to
    its partly taken documents in turn, whole ones as long as they last; the
    one at which they run out is cut behind its last word.
    """
    mixed = mix_sources(docs, carry=docs.columns).where("taken > 0")
    rest = mixed.select("row", F.col("carry.source").alias("source"), "size", (F.col("taken") % F.col("size")).alias("rest"))
    rest = materialize(rest.where("rest > 0"), "mix-parts")
    along = running_totals(rest, "row", {"size": F.sum("size"), "rest": F.sum("rest")}, ["source"], totals=True)
    left = F.col("total_rest") - (F.col("cum_size") - F.col("size"))
    shares = along.select("row", F.greatest(F.least("size", left), F.lit(0)).alias("part"))
    part = F.coalesce("part", F.lit(0))
    times = F.expr("taken div size").cast("int") + (part > 0).cast("int")
    copies = mixed.join(shares, "row", "left").where(times > 0)
    copies = copies.select("carry", "size", part.alias("part"), F.explode(F.sequence(F.lit(1), times)).alias("time"), times.alias("times"))
    cut = (F.col("time") == F.col("times")) & (F.col("part") > 0) & (F.col("part") < F.col("size"))
    upto = F.array_join(F.slice(F.split("carry.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), F.col("part").cast("int")), "")
    text = F.when(cut, upto).otherwise(F.col("carry.text"))
    new = {"text": text, "n_chars": F.when(cut, F.length(upto).cast("long")).otherwise(F.col("carry.n_chars"))}
    return copies.select(*[new.get(c, F.col(f"carry.`{c}`")).alias(c) for c in docs.columns])


def into_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document and whether they decode to its text."""
    out = sample_pieces(docs)
    return out.select(
        "doc_id", F.size("pieces").alias("n_pieces"), "pieces", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_quality),
    ("near duplicates", drop_duplicates),
    ("suffix-array repeats", cut_repeats),
    ("source mix", mix_by_weight),
    ("pieces", into_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored before the next reads them."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
