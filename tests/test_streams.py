"""Keyed window state, the store of update batches, and one ordering for all drift figures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyward.operators import drift as D
from tallyward.operators import tagged as G
from tallyward.streaming import jobs as S
from tallyward.streaming import store as B
from tallyward.streaming import windows as W


def arrivals(spark, folder, name, rows, schema):
    """One more file in the folder of a stream."""
    folder.mkdir(exist_ok=True)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder.parent / name))
    for f in (folder.parent / name).glob("part-*"):
        f.rename(folder / f"{name}-{f.name}")


# --- one ordering -------------------------------------------------------------


def plain_metrics(ref, rows, tau):
    """(n_ref, n_cur, n, n_positive, flagged_n, auc, ks) by comparing all pairs."""
    scores = [s for s, _ in rows if s is not None]
    known = [(s, y) for s, y in rows if s is not None and y is not None]
    pos, neg = [s for s, y in known if y], [s for s, y in known if not y]
    ref = [s for s in ref if s is not None]
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    ks = max(abs(sum(x >= c for x in ref) / len(ref) - sum(x >= c for x in scores) / len(scores)) for c in {*ref, *scores})
    return (len(ref), len(scores), len(known), len(pos), sum(s >= tau for s, _ in known), wins / (len(pos) * len(neg)) if pos and neg else None, ks)


@pytest.mark.parametrize("at_once", [32, 2])
def test_tagged_metrics(spark, monkeypatch, at_once):
    monkeypatch.setattr(G, "TAGS_AT_ONCE", at_once)
    rng = random.Random(6)
    value = lambda: rng.choice([None, 0.5, rng.randrange(40) / 40])
    ref = [value() for _ in range(120)]
    rows = [(t, value(), rng.choice([0, 1, None]) if t != "one class" else 1) for t in ("a", "b", "c", "one class", None) for _ in range(70)]
    df = spark.createDataFrame(rows, "t string, s double, y int")
    reference = G.score_counts(spark.createDataFrame([(s,) for s in ref], "s double"), "s")
    # the counts of two parts add up to those of the whole
    parts = [G.score_counts(df.where(f"pmod(hash(s, y), 2) = {k}"), "s", "y", ["t"]) for k in (0, 1)]
    counts = G.merge_counts(parts[0].unionByName(parts[1]), ["t"])
    got = {r.t: tuple(r)[1:] for r in G.tagged_metrics(reference, counts, "t", ["a", "b", "c", "one class", "absent"], 0.5).collect()}
    assert set(got) == {"a", "b", "c", "one class"}
    for t, found in got.items():
        want = plain_metrics(ref, [(s, y) for tag, s, y in rows if tag == t], 0.5)
        assert found[:5] == want[:5] and found[5:] == pytest.approx(want[5:])


def test_report_orders_scores_once(spark):
    ref = spark.range(200).select("id", (F.col("id") % 10 / 10).alias("s"), (F.col("id") % 7).cast("double").alias("f"))
    cur = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 9 / 9).alias("s"), (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 5).cast("double").alias("f"))
    fitted = D.fit_psi_reference(ref, ["f"])
    report = D.drift_report(ref, cur, "k", "s", "y", ["f"], 3, 0.5, fitted)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    orderings = [line for line in plan.splitlines() if "Window [" in line and "cum_ref" in line]
    assert len(orderings) == 1 and "score_curve" not in plan
    # with stored counts the reference itself takes no part
    stored = G.score_counts(ref, "s")
    again = D.drift_report(None, cur, "k", "s", "y", ["f"], 3, 0.5, fitted, stored)
    assert sorted(map(str, again.collect())) == sorted(map(str, report.collect()))


# --- store --------------------------------------------------------------------


def put(spark, sink, batch, rows):
    B.write_batch(spark.createDataFrame(rows, "k string, n long"), sink, batch)


def read(spark, sink):
    return {r.k: r.n for r in B.latest(spark, sink, ["k"], ["n"]).collect()}


def test_store_reads_base_and_newer_batches(spark, tmp_path):
    sink = str(tmp_path / "sink")
    with pytest.raises(FileNotFoundError):
        B.latest(spark, sink, ["k"], ["n"])
    put(spark, sink, 0, [("a", 1), ("b", 1)])
    put(spark, sink, 1, [("a", 2)])
    assert read(spark, sink) == {"a": 2, "b": 1} and B.open_batches(spark, sink) == 2
    assert B.compact(spark, sink, ["k"], ["n"]) == 1
    assert read(spark, sink) == {"a": 2, "b": 1} and B.open_batches(spark, sink) == 0
    put(spark, sink, 2, [("b", 5), ("c", 1)])
    assert read(spark, sink) == {"a": 2, "b": 5, "c": 1}
    assert B.compact(spark, sink, ["k"], ["n"]) == 2
    B.expire(spark, sink)
    assert not list((tmp_path / "sink").glob("batch_id=*")) and len(list((tmp_path / "sink/_base").iterdir())) == 1
    assert read(spark, sink) == {"a": 2, "b": 5, "c": 1}


def test_store_survives_kills_and_replays(spark, tmp_path):
    sink = tmp_path / "sink"
    for i in range(3):
        put(spark, str(sink), i, [("a", i), (f"own{i}", i)])
    want = {"a": 2, "own0": 0, "own1": 1, "own2": 2}
    # killed while it wrote its base: no manifest names the files
    (sink / "_base/dead").mkdir(parents=True)
    (sink / "_base/dead/part-0.parquet").write_bytes(b"half")
    assert read(spark, str(sink)) == want
    # killed before its manifest was in place
    (sink / "_manifest").mkdir()
    (sink / "_manifest/x.draft").write_text(json.dumps({"upto": 9, "base": "nowhere"}))
    assert read(spark, str(sink)) == want
    B.compact(spark, str(sink), ["k"], ["n"])
    # the stream replays a batch that the base holds
    put(spark, str(sink), 1, [("a", 1), ("own1", 1)])
    assert read(spark, str(sink)) == want
    # a batch being written has no success mark yet and does not count
    put(spark, str(sink), 3, [("a", 99)])
    mark = sink / "batch_id=3/_SUCCESS"
    mark.unlink()
    assert read(spark, str(sink)) == want
    put(spark, str(sink), 3, [("a", 3)])
    assert read(spark, str(sink)) == want | {"a": 3}
    B.expire(spark, str(sink))
    assert read(spark, str(sink)) == want | {"a": 3} and not (sink / "_base/dead").exists()


# --- windows ------------------------------------------------------------------

SCHEMA = "ts timestamp, s double, y int, f double"


def events(n, day, seed):
    rng = random.Random(seed)
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 4) + timedelta(days=day)
    return [
        (start + timedelta(minutes=rng.randrange(7 * 24 * 60)), rng.choice([None, rng.randrange(30) / 30]), rng.choice([0, 1, 1, None]), float(rng.randrange(12)))
        for _ in range(n)
    ]


def test_window_reports(spark, tmp_path):
    """Two runs over arriving files, a window split between them, late rows left out and counted."""
    base = spark.createDataFrame(events(300, 0, 1), SCHEMA)
    reference = W.fit_reference(base, "s", ["f"])
    inbox, ck, sink = tmp_path / "in", str(tmp_path / "ck"), str(tmp_path / "out")
    first, second, third = events(150, 0, 2), events(150, 0, 3), events(200, 21, 4)
    # the last rows of the third file move the watermark past the first window
    stream = lambda: W.window_counts(
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(inbox)), "ts", "7 days", "1 day", "s", "y", reference
    )
    arrivals(spark, inbox, "a", first, SCHEMA)
    W.run_window_counts(stream(), ck, sink, compact_every=2)
    arrivals(spark, inbox, "b", second, SCHEMA)
    arrivals(spark, inbox, "c", third, SCHEMA)
    W.run_window_counts(stream(), ck, sink, compact_every=2)
    late = S.LateRows(spark)
    arrivals(spark, inbox, "d", events(40, 0, 5), SCHEMA)
    query = W.run_window_counts(stream(), ck, sink, compact_every=2)
    assert late.total(query) == 40
    spark.streams.removeListener(late)

    got = {str(r.window_start)[:10]: r for r in W.window_reports(spark, sink, reference, 0.5).collect()}
    assert set(got) == {"2024-01-04", "2024-01-25"} and B.manifest(spark, sink)[0] >= 1
    ref = [s for _, s, _, _ in (tuple(r) for r in base.collect())]
    for day, rows in (("2024-01-04", first + second), ("2024-01-25", third)):
        r = got[day]
        want = plain_metrics(ref, [(s, y) for _, s, y, _ in rows], 0.5)
        assert r.n_rows == want[2] and r.auc_roc == pytest.approx(want[5]) and r.ks_stat == pytest.approx(want[6])
        assert r.flag_rate == pytest.approx(want[4] / want[2]) and r.pos_rate == pytest.approx(want[3] / want[2])
        whole = spark.createDataFrame(rows, SCHEMA).withColumn("p", F.lit(1))
        assert r.mean_psi == pytest.approx(D.psi(reference.bins, whole, "p").first()["psi"])
