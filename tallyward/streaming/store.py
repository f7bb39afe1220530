"""Update batches of a stream as a small log-structured store.

Every batch is a directory ``batch_id=k`` below the sink, replaced when the
stream replays it. ``compact`` merges the base and all complete batches into a
new base and then names it in a manifest, whose file appears by a rename: a
reader sees the old state or the new one. A compaction that dies leaves a base
that no manifest names. A batch up to the manifest's that is replayed later
holds what the base has already, and readers pass over it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH = "batch_id"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def write_batch(df: DataFrame, sink: str, batch_id: int) -> None:
    """The batch's directory, written anew on a replay."""
    df.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/{_BATCH}={batch_id}")


def manifest(spark: SparkSession, sink: str) -> tuple[int, str | None]:
    """(last batch of the base, its directory); (-1, None) before the first compaction."""
    names = sorted(n for n in _children(spark, f"{sink}/_manifest") if n.endswith(".json"))
    if not names:
        return -1, None
    text = spark.read.text(f"{sink}/_manifest/{names[-1]}", wholetext=True).first()[0]
    found = json.loads(text)
    return found["upto"], found["base"]


def _newer(spark: SparkSession, sink: str, upto: int) -> list[int]:
    """Complete batches behind the base; one without its success mark is still being written."""
    ids = sorted(int(n.split("=")[1]) for n in _children(spark, sink) if n.startswith(f"{_BATCH}="))
    return [i for i in ids if i > upto and "_SUCCESS" in _children(spark, f"{sink}/{_BATCH}={i}")]


def open_batches(spark: SparkSession, sink: str) -> int:
    """Complete batches that no base holds yet."""
    return len(_newer(spark, sink, manifest(spark, sink)[0]))


def _merged(spark: SparkSession, sink: str, keys: Sequence[str], values: Sequence[str]) -> tuple[DataFrame, int]:
    """Newest values per key with their batch, from the base and the batches behind it."""
    upto, base = manifest(spark, sink)
    ids = _newer(spark, sink, upto)
    parts = []
    if base:
        parts.append(spark.read.parquet(base).withColumn(_BATCH, F.col(_BATCH).cast("long")))
    if ids:
        newer = spark.read.option("basePath", sink).parquet(*[f"{sink}/{_BATCH}={i}" for i in ids])
        parts.append(newer.withColumn(_BATCH, F.col(_BATCH).cast("long")))
    if not parts:
        raise FileNotFoundError(f"{sink} has no complete batch")
    rows = parts[0] if len(parts) == 1 else parts[0].select(*keys, *values, _BATCH).unionByName(parts[1].select(*keys, *values, _BATCH))
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), _BATCH).alias("v"), F.max(_BATCH).alias(_BATCH))
    return newest.select(*keys, *[F.col(f"v.{v}") for v in values], _BATCH), max(ids, default=upto)


def latest(spark: SparkSession, sink: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Last emitted values per key: the base and the batches behind it."""
    return _merged(spark, sink.rstrip("/"), keys, values)[0].drop(_BATCH)


def compact(spark: SparkSession, sink: str, keys: Sequence[str], values: Sequence[str]) -> int:
    """Merge base and batches into a new base; the last batch that it holds."""
    sink = sink.rstrip("/")
    rows, upto = _merged(spark, sink, keys, values)
    base = f"{sink}/_base/{uuid.uuid4().hex}"
    rows.write.parquet(base)
    fs, target = _path(spark, f"{sink}/_manifest/{upto:012d}.json")
    _, draft = _path(spark, f"{sink}/_manifest/{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(json.dumps({"upto": upto, "base": base}).encode())
    out.close()
    if not fs.rename(draft, target) and not fs.exists(target):
        raise OSError(f"the manifest {target} could not be written")
    return upto


def expire(spark: SparkSession, sink: str) -> None:
    """Remove batches that the base holds, bases that no manifest names, and older manifests.

    For a time without readers: one that began before may still list them.
    """
    sink = sink.rstrip("/")
    upto, base = manifest(spark, sink)
    gone = [f"{sink}/{n}" for n in _children(spark, sink) if n.startswith(f"{_BATCH}=") and int(n.split("=")[1]) <= upto]
    gone += [f"{sink}/_base/{n}" for n in _children(spark, f"{sink}/_base") if base is None or n != base.rsplit("/", 1)[1]]
    gone += [f"{sink}/_manifest/{n}" for n in _children(spark, f"{sink}/_manifest") if n != f"{upto:012d}.json"]
    for path in gone:
        fs, p = _path(spark, path)
        fs.delete(p, True)
