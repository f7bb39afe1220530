import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyward.operators import ordered as O


def frame(spark, values, parts=3):
    return spark.createDataFrame([(v,) for v in values], "k long").repartition(parts)


def percent_rank_split(values, limits, last):
    n = len(values)
    out = {}
    for v in values:
        pr = sum(x < v for x in values) / (n - 1) if n > 1 else 0.0
        out[v] = next((name for name, f in limits if pr < f), last)
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 10, 11, 101])
def test_fraction_split_small_sizes(spark, n):
    values = [7 * i for i in range(n)]
    limits = [("train", 0.7), ("validation", 0.8)]
    got = {r.k: r.split_group for r in O.fraction_split(frame(spark, values), "k", limits, "holdout").collect()}
    assert got == percent_rank_split(values, limits, "holdout")


def test_fraction_split_keeps_ties_together(spark):
    values = [1] * 34 + [2] * 33 + [3] * 33
    limits = [("train", 0.34), ("validation", 0.67)]
    got = {r.k: r.split_group for r in O.fraction_split(frame(spark, values), "k", limits, "holdout").collect()}
    assert got == percent_rank_split(values, limits, "holdout")


def test_published_split_sizes(spark):
    df = spark.range(69_581).select((F.col("id") * 3 + 11).alias("k"))
    rows = O.fraction_split(df, "k", [("train", 0.7), ("validation", 0.8)], "holdout").groupBy("split_group").count().collect()
    assert {r[0]: r[1] for r in rows} == {"train": 48_706, "validation": 6_958, "holdout": 13_917}


@pytest.mark.parametrize("n,batches", [(10, 4), (3, 4), (8, 4), (1, 1), (17, 5)])
def test_batches_last_takes_remainder(spark, n, batches):
    rows = O.ordered_batches(frame(spark, list(range(n))), "k", batches).collect()
    size = n // batches
    for r in rows:
        want = min(r.k // size, batches - 1) if size else batches - 1
        assert r.batch == want


def test_order_statistics_inside_narrow_brackets(spark, monkeypatch):
    """Sketch coarser than the data: the bracketed path must stay exact."""
    monkeypatch.setattr(O, "SKETCH_ACCURACY", 200)
    rng = random.Random(5)
    values = [rng.randrange(3000) for _ in range(4000)] + [1500] * 2000  # a third on one key
    rng.shuffle(values)
    spots = [(0.1, 600), (0.25, 1500), (0.5, 3000), (0.9, 5399), (1.0, 5999)]
    got = O.order_statistics(frame(spark, values, 7), "k", [(f, lambda n, p=p: p) for f, p in spots])
    ordered = sorted(values)
    assert got.n == 6000
    assert got.cuts == [ordered[p] for _, p in spots]


def test_order_statistics_out_of_range(spark):
    got = O.order_statistics(frame(spark, [5, 6]), "k", [(0.0, lambda n: -1), (1.0, lambda n: n)])
    assert got.cuts == [None, None]
    empty = O.order_statistics(frame(spark, [1]).where("false"), "k", [(0.5, lambda n: 0)])
    assert (empty.n, empty.cuts) == (0, [None])


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("partitions", ["1", "17"])
def test_running_totals_equal_window(spark, descending, partitions):
    rng = random.Random(9)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(5)}", rng.randrange(200) / 10) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, k double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {(r.g, r.k): (r.n, r.cum_n) for r in O.running_totals(df, "k", {"n": F.count("*")}, ["g"], descending).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = F.col("k").desc() if descending else F.col("k")
    w = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    plain = df.groupBy("g", "k").agg(F.count("*").alias("n")).withColumn("c", F.sum("n").over(w))
    assert got == {(r.g, r.k): (r.n, r.c) for r in plain.collect()}


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (7.0,), (10.0,), (None,)], "v double")
    q = O.exact_quantiles(df, "v", [0.0, 0.1, 0.5, 1.0]).first()["quantiles"]
    assert q == pytest.approx([1.0, 1.4, 2.0, 10.0])


def test_bins(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.15,), (0.3,), (0.9,)], "s double")
    edges = [0.1, 0.2, 0.3]
    strict = [r.b for r in O.with_bin(df, "s", edges, "b").orderBy("s").collect()]
    inclusive = [r.b for r in O.with_bin(df, "s", edges, "b", inclusive=True).orderBy("s").collect()]
    assert strict == [0, 0, 1, 2, 3]
    assert inclusive == [0, 1, 1, 3, 3]


def test_null_groups_are_kept(spark):
    rows = [("a", 1), ("a", 3), (None, 2), (None, 5)]
    df = spark.createDataFrame(rows, "g string, k int")
    got = O.running_totals(df, "k", {"n": F.count("*")}, ["g"]).collect()
    assert {(r.g, r.k, r.cum_n) for r in got} == {("a", 1, 1), ("a", 3, 2), (None, 2, 1), (None, 5, 2)}
    quantiles = {r.g: r.quantiles for r in O.exact_quantiles(df, "k", [0.5], ["g"]).collect()}
    assert quantiles == {"a": [2.0], None: [3.5]}
