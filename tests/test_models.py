import threading

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyward.operators import logistic_fit as L
from tallyward.operators import models as M
from tallyward.operators import network_fit as NF
from tallyward.operators import network_paths as N
from tallyward.operators import tree_paths as T
from tallyward.operators.drift import fit_psi_reference
from tallyward.operators.evaluate import auc
from tallyward.operators.features import category_levels, fit_features, safe_names
from tallyward.plans import catalog_models as C
from tallyward.session import materialize_parts
from tallyward.sources import sinks
from tallyward.sources.readers import to_requests
from tallyward.streaming import jobs as S


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    df = spark.range(1500).select(
        n.alias("id"),
        (n % 11).cast("int").alias("x"),
        F.element_at(F.array(*[F.lit(v) for v in ("No", "Up", "Down", "odd")]), (n % 4 + 1).cast("int")).alias("med"),
        F.element_at(F.array(*[F.lit(v) for v in ("b", "a", "c")]), (n % 3 + 1).cast("int")).alias("cat"),
        (n % 5).cast("int").alias("noise"),
    )
    chance = 5 + 4 * F.col("x") + F.when(F.col("cat") == "c", 30).otherwise(0)
    return df.withColumn("y", ((F.col("id") * 7919 % 100) < chance).cast("int"))


@pytest.fixture(scope="module")
def fitted(rows):
    plan = fit_features(rows, ["x", "noise", "absent"], [("med_ord", "med", ["No", "Steady", "Down", "Up"])], ["cat"])
    return plan, plan.model(rows).transform(rows).select("id", "y", "features").cache()


def test_feature_plan(spark, rows, fitted):
    plan, matrix = fitted
    assert plan.names() == ["numeric__x", "numeric__noise", "med_ord__med", "nominal__cat_b", "nominal__cat_c"]
    new = spark.createDataFrame([(1, 5, "odd", "zzz", 2), (2, None, "Up", None, 2)], "id long, x int, med string, cat string, noise int")
    got = [tuple(r)[1:] for r in plan.columns(new, ["id"]).orderBy("id").collect()]
    assert got[0][2:] == (-1.0, 0.0, 0.0) and got[1][0] is None and got[1][2] == 3.0
    stats = plan.columns(rows, []).agg(F.avg("numeric__x"), F.stddev_pop("numeric__x")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1)
    assert safe_names(["a_[0-10)<"]) == ["a_(0-10)lt"]
    with pytest.raises(ValueError):
        fit_features(rows, ["absent"], [], [], strict=True)
    with pytest.raises(ValueError, match="levels"):
        category_levels(rows, ["id"], max_levels=100)


def test_constant_column_keeps_unit_scale(rows):
    plan = fit_features(rows.withColumn("k", F.lit(4)), ["k"], [], [])
    assert plan.scale["k"] == (4.0, 1.0)


def value(df, label="y"):
    return auc(df, "prob", label).first()["auc_roc"]


def test_models_learn_and_rank_features(spark, fitted):
    plan, matrix = fitted
    weighted, total = M.prepare(matrix, "y")
    lr = M.logistic("y", "features", 10.0, 0.5, total).fit(weighted)
    assert value(M.positive_probability(lr, matrix)) > 0.65
    top = M.coefficient_rank(lr, plan.names(), spark).orderBy("rank").first()
    assert top.feature in ("numeric__x", "nominal__cat_c")
    gbt = M.boosted_trees("y", "features", maxIter=5, maxDepth=3, seed=1).fit(weighted)
    assert value(M.positive_probability(gbt, matrix)) > 0.65
    drop = {r.feature: r.auc_drop for r in M.permutation_importance(lr, matrix, "id", "y", "features", plan.names()).collect()}
    assert set(drop) == set(plan.names())
    assert drop["numeric__x"] > drop["numeric__noise"] + 0.02
    lin = {r.feature: r.mean_abs for r in M.linear_attribution(lr, matrix, "features", plan.names()).collect()}
    assert lin["numeric__x"] > lin["numeric__noise"]


def test_paths_add_up_to_the_margin(spark, fitted):
    plan, matrix = fitted
    weighted, _ = M.prepare(matrix, "y")
    gbt = M.boosted_trees("y", "features", maxIter=6, maxDepth=4, seed=1).fit(weighted)
    scored = gbt.transform(matrix).select("id", "features", vector_to_array("rawPrediction")[1].alias("margin"))
    width = len(plan.names())
    rows = T.path_contributions(gbt, scored, "features", width, ["id", "margin"]).collect()
    assert len(rows) == 1500 and all(len(r.contributions) == width for r in rows)
    assert all(r.base + sum(r.contributions) == pytest.approx(r.margin, abs=1e-9) for r in rows)
    # one tree by hand: the contributions of a row follow its path through the node table
    nodes = {(r.tree, r.node): r for r in T.node_table(gbt, spark).collect()}
    row = scored.where("id = 7").first()
    want = [0.0] * width
    for tree in range(6):
        at = nodes[tree, 0]
        while at.left >= 0:
            to = nodes[tree, at.left if row.features[at.feature] <= at.threshold else at.right]
            want[at.feature] += at.weight * (to.value - at.value)
            at = to
    assert next(r for r in rows if r.id == 7).contributions == pytest.approx(want)
    mean = {r.feature: r.mean_abs for r in T.path_attribution(gbt, matrix, "features", plan.names()).collect()}
    assert mean["numeric__x"] > mean["numeric__noise"]


def test_gradients_add_up_to_the_probability(spark, fitted):
    plan, matrix = fitted
    names = plan.names()
    net = M.perceptron("y", "features", len(names), hidden=(6, 4), maxIter=40).fit(matrix)
    scored = M.positive_probability(net, matrix).select("id", "features", "prob")
    rows = N.gradient_contributions(net, scored, "features", ["id", "prob"]).collect()
    assert len(rows) == 1500 and all(abs(r.gap) <= 1e-6 for r in rows)
    assert all(r.base + sum(r.contributions) == pytest.approx(r.prob, abs=1e-5) for r in rows)
    # the layers give Spark's own probabilities, and their derivative is the slope between close points
    layers, x = N.Layers(net), np.array([r.features.toArray() for r in scored.orderBy("id").head(20)])
    want = [r.prob for r in scored.orderBy("id").head(20)]
    assert layers.probability(x) == pytest.approx(np.array(want), abs=1e-9)
    for j in range(len(names)):
        step = np.zeros(len(names))
        step[j] = 1e-5
        slope = (layers.probability(x + step) - layers.probability(x - step)) / 2e-5
        assert layers.gradient(x)[:, j] == pytest.approx(slope, abs=1e-6)
    # a row at the baseline has nothing to add; another baseline moves the base
    at = x[3].tolist()
    row = N.gradient_contributions(net, scored.where("id = 3"), "features", ["id", "prob"], baseline=at).first()
    assert row.base == pytest.approx(row.prob) and row.contributions == pytest.approx([0.0] * len(names))
    mean = {r.feature: r.mean_abs for r in N.gradient_attribution(net, matrix, "features", names).collect()}
    assert mean["numeric__x"] > mean["numeric__noise"]
    assert N.gradient_contributions(net, scored.where("id < 0"), "features", ["id"]).count() == 0
    with pytest.raises(ValueError, match="baseline"):
        N.gradient_contributions(net, scored, "features", ["id"], baseline=[0.0])


@pytest.mark.parametrize("steep", [60, 20_000])
def test_steps_of_steep_networks_are_closed_in_on(fitted, steep):
    plan, matrix = fitted
    net = M.perceptron("y", "features", len(plan.names()), hidden=(4,), maxIter=10).fit(matrix)
    layers = N.Layers(net)
    layers.layers = [(w * steep, b) for w, b in layers.layers]
    x = np.array([r.features.toArray() for r in matrix.orderBy("id").head(50)])
    start = np.linspace(-1, 1, x.shape[1])
    added, gap = layers.contributions(x, start, 1e-8)
    whole = layers.probability(x) - layers.probability(start[None, :])[0]
    assert np.ptp(whole) > 0.1 and np.abs(gap).max() <= 1e-6 and added.sum(axis=1) + gap == pytest.approx(whole)
    # without halving the step is missed
    loose, missed = layers.contributions(x, start, 2.0)
    assert np.abs(missed).max() > 1e-4 and loose.sum(axis=1) + missed == pytest.approx(whole)


def test_optimality_tells_a_fit_from_another(fitted):
    plan, matrix = fitted
    weighted, total = M.prepare(matrix, "y")
    fit = lambda c, steps: M.logistic("y", "features", c, 0.5, total).setMaxIter(steps).fit(weighted)
    worst = lambda m: M.optimality(m, weighted, "y", "features", "class_weight", plan.names()).agg(F.max("violation")).first()[0]
    assert worst(fit(0.05, 200)) < 1e-4 < 1e-2 < worst(fit(0.05, 1))
    rows = M.optimality(fit(0.0001, 200), weighted, "y", "features", "class_weight", plan.names()).collect()
    assert rows[-1].feature == "(Intercept)" and [r.feature for r in rows[:-1]] == plan.names()
    assert all(r.violation < 1e-4 for r in rows) and any(r.coefficient == 0 and r.slope != 0 for r in rows)


def test_permutation_does_not_depend_on_the_partitioning(spark, fitted):
    plan, matrix = fitted
    lr = fit_lr({"c": 1.0, "l1": 0.0}, matrix)
    few = matrix.where("id < 40")
    kept, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    for partitions in ("2", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got.append({tuple(r) for r in M.permutation_importance(lr, few, "id", "y", "features", plan.names()).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert got[0] == got[1] and any(drop for _, drop in got[0])


def test_permutation_scores_only_what_changes(fitted):
    """A partner with the same value needs no score of its own; the drops are those of all copies scored."""
    plan, matrix = fitted
    lr = fit_lr({"c": 10.0, "l1": 0.0}, matrix)
    seen = []

    class Counted:
        def transform(self, df):
            seen.append(df.count())
            return lr.transform(df)

    few = matrix.where("id < 300")
    got = {r.feature: r.auc_drop for r in M.permutation_importance(Counted(), few, "id", "y", "features", plan.names()).collect()}
    rows = few.select("id", "y", vector_to_array("features").alias("x"), F.xxhash64("id", F.lit(0)).alias("h")).collect()
    ring = sorted(rows, key=lambda r: (r.h, r.id))
    partner = {a.id: b.x for a, b in zip(ring, ring[1:] + ring[:1])}
    width = len(plan.names())
    changed = sum(r.x[j] != partner[r.id][j] for r in rows for j in range(width))
    assert seen == [len(rows) + changed] and changed < len(rows) * width

    def area(j):
        margin = lambda r: sum(c * (partner[r.id] if i == j else r.x)[i] for i, c in enumerate(lr.coefficients))
        pos, neg = ([margin(r) for r in rows if r.y == y] for y in (1, 0))
        return sum((p > n) + (abs(p - n) < 1e-12) / 2 for p in pos for n in neg) / (len(pos) * len(neg))

    assert all(got[name] == pytest.approx(area(-1) - area(j), abs=1e-4) for j, name in enumerate(plan.names()))


def fit_lr(params, rows):
    weighted, total = M.prepare(rows, "y")
    return M.logistic("y", "features", params["c"], params["l1"], total).fit(weighted)


def test_folds_deal_each_class_evenly(spark, rows):
    folds = M.stratified_fold(rows.select("id", "y"), "id", "y", 4)
    got = folds.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in got if r.y == y]
        assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
    unlabelled = spark.createDataFrame([(i, None) for i in range(6)], "id long, y int")
    assert M.stratified_fold(unlabelled, "id", "y", 2).groupBy("fold").count().count() == 2


def test_calibration(fitted):
    _, matrix = fitted
    fit = lambda rows: fit_lr({"c": 10.0, "l1": 0.0}, rows)
    platt = M.platt_ensemble(fit, matrix, "id", "y", k=3).transform(matrix)
    stats = platt.agg(F.avg("prob"), F.avg("y"), F.min("prob"), F.max("prob")).first()
    assert stats[0] == pytest.approx(stats[1], abs=0.03) and 0 < stats[2] < stats[3] < 1
    oof = M.out_of_fold(fit, matrix, "id", "y", k=3)
    assert oof.count() == matrix.count()
    curve = M.fit_isotonic(oof, "prob", "y")
    iso = M.apply_isotonic(curve, oof)
    s = iso.agg(F.avg("prob_calibrated"), F.min("prob_calibrated"), F.max("prob_calibrated")).first()
    assert s[0] == pytest.approx(stats[1], abs=0.02) and 0 <= s[1] <= s[2] <= 1


def test_search_prefers_the_better_penalty(fitted):
    _, matrix = fitted
    grid = [{"c": 1e-6, "l1": 1.0}, {"c": 1.0, "l1": 1.0}]
    best, score, trials = M.search(fit_lr, grid, matrix, matrix, "y")
    assert best == grid[1] and score > 0.65 and [p for p, _ in trials] == grid
    folded = M.stratified_fold(matrix, "id", "y", 3)
    best, score, trials = M.search_cv(fit_lr, grid, folded, "fold", 3, "y")
    assert best == grid[1] and score > 0.65 and [p for p, _ in trials] == grid
    assert len(M.random_grid({"a": [1, 2, 3], "b": [1, 2]}, 4, seed=2)) == 4


def test_successive_halving(spark, fitted, tmp_path):
    """Trials are dropped by rank, rungs are not fitted twice, and a lost rung is made again with the same result."""
    _, matrix = fitted
    grid = [{"c": c, "l1": 0.0} for c in (1e-7, 10.0, 1e-6, 1.0, 0.1)]
    calls = []

    def fit(params, rows, budget):
        calls.append((params["c"], budget))
        weighted, total = M.prepare(rows, "y")
        return M.logistic("y", "features", params["c"], params["l1"], total).setMaxIter(budget).fit(weighted)

    store = str(tmp_path / "search")
    run = lambda: [tuple(r) for r in M.successive_halving(fit, grid, matrix, matrix, "y", [1, 3, 9], store).orderBy("rung", "trial").collect()]
    first = run()
    by_rung = {k: [r for r in first if r[1] == k] for k in range(3)}
    assert [len(by_rung[k]) for k in range(3)] == [5, 3, 2] and len(calls) == 10
    for k in (0, 1):
        kept = {r[0] for r in by_rung[k] if r[4]}
        assert kept == {r[0] for r in by_rung[k + 1]}
        assert min(r[3] for r in by_rung[k] if r[4]) >= max([r[3] for r in by_rung[k] if not r[4]])
    assert sum(r[4] for r in by_rung[2]) == 1 and [r[2] for r in first] == [1] * 5 + [3] * 3 + [9] * 2
    calls.clear()
    assert run() == first and not calls
    (tmp_path / "search/rung=2/_SUCCESS").unlink()
    assert run() == first and len(calls) == 2


def test_minority_rows_are_repeated_not_dropped(rows):
    skewed = rows.withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    n = {r.y: r["count"] for r in M.repeat_minority(skewed, "y").groupBy("y").count().collect()}
    assert n == {0: 1350, 1: 1350}


def test_streamed_scores_equal_batch(spark, rows, tmp_path):
    plan = fit_features(rows, ["x"], [("med_ord", "med", ["No", "Up"])], ["cat"])
    weighted, total = M.prepare(rows, "y")
    model = Pipeline(stages=[*plan.stages(), M.logistic("y", "features", 1.0, 0.0, total)]).fit(weighted)
    sinks.save_model(model, str(tmp_path / "models"), "v1")
    loaded = sinks.load_model(str(tmp_path / "models"), "v1")
    cols = ["id", "x", "med", "cat"]
    inbox = str(tmp_path / "inbox")
    to_requests(rows, cols, F.expr("id div 100")).select("payload").write.text(inbox)
    schema = rows.select(*cols).schema
    out = str(tmp_path / "out")
    stream = S.score_requests(S.read_requests(spark, inbox, max_files=1), schema, loaded, 0.5, keep=["id"])
    S.run_available(stream, str(tmp_path / "ck"), out)
    batch = S.score_requests(spark.read.text(inbox).withColumnRenamed("value", "payload"), schema, model, 0.5, keep=["id"])
    got = {r.id: (r.probability, r.flagged) for r in spark.read.parquet(out).collect()}
    assert got == {r.id: (r.probability, r.flagged) for r in batch.collect()} and len(got) == 1500


def test_drift_report_per_arriving_batch(spark, tmp_path):
    base = spark.range(300).select(
        F.col("id").alias("k"), (F.col("id") % 50).cast("double").alias("f"), (F.col("id") % 61 / 61).alias("s"),
        (F.col("id") % 4 == 0).cast("int").alias("y"),
    )
    fitted = fit_psi_reference(base, ["f"])
    inbox, sink = str(tmp_path / "in"), str(tmp_path / "out")
    base.coalesce(1).write.parquet(inbox)
    base.withColumn("f", F.col("f") * 0.2).coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    S.run_drift_reports(stream, base, fitted, "k", "s", "y", 0.12, str(tmp_path / "ck"), sink)
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.drift_alert for r in rows) == [False, True]
    assert {r.n_rows for r in rows} == {300}


def test_windows_update_and_drop_late_rows(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    schema = "ts timestamp_ntz, kind string, value double"

    def arrive(name, rows):
        spark.sql("SELECT CAST(c1 AS timestamp_ntz) AS ts, c2 AS kind, CAST(c3 AS double) AS value FROM VALUES " + rows + " AS t(c1, c2, c3)").coalesce(1).write.parquet(str(tmp_path / name))
        for f in (tmp_path / name).glob("part-*"):
            f.rename(src / f"{name}-{f.name}")

    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    stream = lambda: S.window_totals(
        spark.readStream.schema(schema).parquet(str(src)), "ts", "7 days", "1 day", "kind", "value"
    )
    arrive("a", "('2024-01-04', 'k', 1), ('2024-01-05', 'k', 2)")
    S.run_updates(stream(), ck, sink)
    arrive("b", "('2024-01-06', 'k', 4), ('2024-01-20', 'k', 8)")
    S.run_updates(stream(), ck, sink)
    arrive("c", "('2024-01-04', 'k', 100), ('2024-01-21', 'k', 16)")  # first row is far behind the watermark
    late = S.LateRows(spark)
    query = S.run_updates(stream(), ck, sink)
    got = {str(r.window_start)[:10]: (r.n, r.total) for r in S.latest(spark, sink, ["window_start", "kind"], ["n", "total"]).collect()}
    assert got == {"2024-01-04": (3, 7.0), "2024-01-18": (2, 24.0)}
    assert late.total(query) >= 1
    spark.streams.removeListener(late)


def test_network_steps_are_those_of_repeated_rows(spark, fitted):
    plan, matrix = fitted
    skewed = matrix.where("y = 0 OR id % 3 = 0").repartition(3, "id").cache()
    copies = M.minority_copies(skewed, "y")
    assert skewed.agg(F.max(copies)).first()[0] > 1
    net = M.perceptron("y", "features", len(plan.names()), hidden=(6, 4), maxIter=6)
    want = net.fit(M.repeat_minority(skewed, "y"))
    got = NF.fit_network(net, skewed, copies, many=0)
    assert (NF.fit_network(net, skewed, copies).weights.toArray() == want.weights.toArray()).all()
    assert got.weights.toArray() == pytest.approx(want.weights.toArray(), abs=1e-9)
    assert NF.fit_network(net, skewed, many=0).weights.toArray() == pytest.approx(net.fit(skewed).weights.toArray(), abs=1e-9)
    # rows of one task are dealt to all cores, and a fit ends near where Spark's does
    blocks, stacks = NF.stored_blocks(skewed.coalesce(1), "y", "features", copies, 128, 1500)
    assert blocks.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert stacks == -(-skewed.agg(F.sum(copies)).first()[0] // 128) and blocks.map(lambda b: float(b[2].sum())).sum() == pytest.approx(stacks)
    blocks.unpersist()
    long = net.copy({net.maxIter: 60})
    assert abs(value(M.positive_probability(NF.fit_network(long, matrix, many=0), matrix)) - value(M.positive_probability(long.fit(matrix), matrix))) < 0.02
    with pytest.raises(Exception, match="NULL|null|Null|NaN"):
        NF.fit_network(net, skewed.withColumn("y", F.when(F.col("id") != 0, F.col("y"))), many=0)


def test_networks_of_folds_share_their_passes(spark, fitted, monkeypatch):
    plan, matrix = fitted
    folded = matrix.withColumn("fold", (F.col("id") % 3).cast("int")).repartition(3, "id").cache()
    net = M.perceptron("y", "features", len(plan.names()), hidden=(6, 4), maxIter=6)
    others = [F.col("fold") != i for i in range(3)]
    copies = [F.when(rest, M.minority_copies(folded.where(rest), "y")).otherwise(0) for rest in others]
    passes, evaluations, alone = [], [], NF.minimise_all
    monkeypatch.setattr(NF, "minimise_all", lambda evaluate, *rest: alone(lambda p: passes.append(len(p)) or evaluate(p), *rest))
    got = NF.fit_networks(net, folded, copies, many=0)
    together = len(passes)
    for rest, model, times in zip(others, got, copies):
        own = folded.where(rest)
        want = net.fit(M.repeat_minority(own, "y")).weights.toArray()
        assert model.weights.toArray() == pytest.approx(want, abs=1e-9)
        passes.clear()
        NF.fit_network(net, own, times, many=0)
        evaluations.append(len(passes))
    assert together == max(evaluations) < sum(evaluations)
    # few rows take Spark's own fit, fold by fold
    few = NF.fit_networks(net, folded, copies)
    assert (few[0].weights.toArray() == net.fit(M.repeat_minority(folded.where(others[0]), "y")).weights.toArray()).all()


def test_parts_are_written_without_a_sort(spark):
    rows = spark.range(40).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("part"), F.array("id").alias("v"))
    stored = materialize_parts(rows, "parts", "part", ["a", "b", "none"])
    assert sorted(stored.columns) == sorted(rows.columns)
    assert sorted(map(tuple, stored.select(*rows.columns).collect())) == sorted(map(tuple, rows.collect()))
    assert stored.where("part = 'none'").count() == 0


def test_compared_models_are_fitted_side_by_side(spark, monkeypatch):
    names = list(C.K.TRAINERS)
    meet = threading.Barrier(len(names), timeout=30)  # breaks if a fit waits for another to end
    monkeypatch.setattr(C, "data_state", lambda spark, d: (d,))
    monkeypatch.setattr(C, "_MATRICES", {("here",): "matrix"})
    monkeypatch.setattr(C, "_MODELS", {})
    monkeypatch.setattr(C.K, "TRAINERS", {name: lambda x, name=name: (meet.wait(), f"{name} of {x}")[1] for name in names})
    assert C.every_fitted(spark, "here") == {name: f"{name} of matrix" for name in names}
    assert list(C.every_fitted(spark, "here")) == names  # kept, so nothing waits at the barrier again


def test_calibrated_trees_have_the_reported_sizes(spark, monkeypatch):
    asked, rows = [], spark.range(2).select(F.col("id").alias("encounter_id"), F.lit("train").alias("split_group"), F.lit(1).alias("readmitted_30day"))

    class Kept:
        fit = staticmethod(lambda rows: None)
        transform = staticmethod(lambda df: df.withColumn("prob", F.lit(0.5)))

    for name in ("boosted_trees", "boosted_trees_deep"):
        monkeypatch.setattr(M, name, lambda *_, **params: asked.append(params["maxIter"]) or Kept)
    monkeypatch.setattr(M, "prepare", lambda rows, label: (rows, 1.0))
    monkeypatch.setattr(M, "platt_ensemble", lambda fit, train, *_: (fit(train), Kept)[1])
    monkeypatch.setattr(C, "matrix", lambda spark, d: C.K.Matrix(None, rows))
    assert C.catalog.queries["platt_boosted"](spark, "here").count() == 4
    assert asked == [C.K.BOOSTED["maxIter"], C.K.BOOSTED_DEEP["maxIter"]] == [217, 201]


def test_penalties_and_folds_share_their_passes(spark, fitted, monkeypatch):
    """Many logistic models in the passes of one, each with the steps of Spark's own fit."""
    _, matrix = fitted
    folded = matrix.withColumn("fold", (F.col("id") % 3).cast("int")).repartition(3, "id").cache()
    grid = [{"c": c, "l1": l1} for c in (0.003, 1.0) for l1 in (0.0, 0.5, 1.0)]
    models = [L.Penalised(i, p["c"], p["l1"]) for p in grid for i in range(3)]
    passes, alone = [], L.minimise_all
    monkeypatch.setattr(L, "minimise_all", lambda evaluate, searches: alone(lambda p: passes.append(len(p)) or evaluate(p), searches))
    got = L.fit_logistics(folded, "y", "features", "fold", 3, models, many=0)
    assert max(passes) == len(models) and len(passes) < 200
    for at in (0, 4, 8, 9, 13, 17):
        m = models[at]
        want = fit_lr({"c": m.c, "l1": m.l1_ratio}, folded.where(F.col("fold") != m.fold))
        assert got[at] == pytest.approx([*want.coefficients, want.intercept], abs=1e-7)
        assert ((got[at][:-1] == 0) == (want.coefficients.toArray() == 0)).all()
    together = lambda grid, df, many=0: L.held_out_scores(df, "y", "features", "fold", 3, [(p["c"], p["l1"]) for p in grid], many)
    want = M.search_cv(fit_lr, grid, folded, "fold", 3, "y")

    def never(params, rows):
        raise AssertionError("a trial was fitted alone")

    best, score, trials = M.search_cv(never, grid, folded, "fold", 3, "y", together=together)
    assert [p for p, _ in trials] == grid and [v for _, v in trials] == pytest.approx([v for _, v in want[2]], abs=1e-4)
    # few rows, missing values, other labels and folds of one class are left to Spark's own fit
    assert together(grid, folded, NF.MANY_ROWS) is None and M.search_cv(fit_lr, grid[:1], folded, "fold", 3, "y", together=lambda *_: None)[2]
    for odd in (F.when(F.col("id") != 5, F.col("y")), F.col("y") * 2, F.when(F.col("fold") == 0, F.col("y")).otherwise(0)):
        assert together(grid, folded.withColumn("y", odd)) is None


def test_network_passes_add_up_blocks_in_the_same_arrays(spark, fitted):
    rng, sizes = np.random.default_rng(3), [5, 4, 3, 2]
    flat = rng.normal(size=sum((a + 1) * b for a, b in zip(sizes, sizes[1:])))
    x, y, w = rng.normal(size=(40, 5)), rng.integers(0, 2, 40), rng.random(40) * (np.arange(40) % 4 > 0)
    space = NF.Passed.space_for(sizes, 25)

    def passed(flat, cuts):
        found = NF.Passed(flat, sizes, space)
        for lo, hi in zip(cuts, cuts[1:]):
            found.add(x[lo:hi], y[lo:hi], w[lo:hi])
        return found

    got = passed(flat, [0, 25, 26, 40])
    for i in range(len(flat)):
        nudge = np.eye(len(flat))[i] * 1e-6
        slope = (passed(flat + nudge, [0, 20, 40]).loss - passed(flat - nudge, [0, 20, 40]).loss) / 2e-6
        assert got.gradient[i] == pytest.approx(slope, abs=1e-7)
    # the start is drawn from one row, and odd rows are still found
    _, matrix = fitted
    net = M.perceptron("y", "features", 5, hidden=(4,), maxIter=2)
    held, fits = type(net).fit, []
    type(net).fit = lambda self, df, *rest: fits.append(df.count()) or held(self, df, *rest)
    try:
        NF.fit_network(net, matrix, many=0)
    finally:
        type(net).fit = held
    assert set(fits) == {1}
    last = lambda odd: F.when(F.col("id") == 1499, odd).otherwise(F.col("y"))
    for odd in (F.lit(None), F.lit(2), F.lit(-1), F.lit(0.5)):
        with pytest.raises(Exception, match="no class|null|NULL"):
            NF.fit_network(net, matrix.withColumn("y", last(odd)), F.lit(1), many=0)
