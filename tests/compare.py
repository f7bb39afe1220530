"""Side-by-side check of a catalog query and its SQL on the same Parquet files."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{data_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        if v == int(v) and abs(v) < 1e15:
            return (2, f"{v + 0.0:.6f}".replace("-0.000000", "0.000000"))
        return (2, f"{v:.6f}")
    if isinstance(v, int):
        return (2, f"{float(v):.6f}")
    if hasattr(v, "as_tuple"):
        return (2, f"{float(v):.6f}")
    return (3, str(v))


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def compare(df, con, sql: str) -> list[str]:
    """Problems found; an empty list means the results agree."""
    rel = con.sql(sql)
    problems = []
    if sorted(df.columns) != sorted(rel.columns):
        return [f"columns {sorted(df.columns)} != {sorted(rel.columns)}"]
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for name, t in df.dtypes:
        if SPARK_TO_DUCK.get(t, t) != types[name]:
            problems.append(f"type of {name}: {t} vs {types[name]}")
    cols = sorted(df.columns)
    ours = sorted(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())
    theirs = sorted(tuple(_norm(v) for v in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall())
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    left, right = set(ours), set(theirs)
    a, b = [r for r in ours if r not in right], [r for r in theirs if r not in left]
    if a or b:
        problems.append(f"values differ in {len(a)}/{len(b)} rows of {len(ours)}; cols {cols}")
        problems += [f"  ours   {[v for _, v in r]}" for r in a[:3]] + [f"  theirs {[v for _, v in r]}" for r in b[:3]]
    elif ours != theirs:
        problems.append("row multiplicities differ")
    return problems
