"""Line dedup, spelling variants and hard negatives against brute force on small rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import lines as L
from tallyward.llm import negatives as N
from tallyward.llm import spelling as S

# --- lines -------------------------------------------------------------------


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def plain_lines(rows):
    """(doc_id, n_lines, n_dropped, sha) by going through all lines."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[line_key(line)].add(i)
    out = []
    for i, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            k = line_key(line)
            known = [x for x in holders[k] if x is not None]
            shared = len(k) >= 10 and len(holders[k]) > 1
            if not (shared and i != min(known)):
                kept.append(line)
        n = len((text or "").split("\n"))
        out.append((i, n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


LINES = [
    (1, "A common line here\nown words of one\nA common line here"),
    (2, "  a COMMON line here\t\nshort\nshort\n"),
    (3, "a common line here"),
    (4, ""),
    (5, None),
    (6, "\n\n"),
    (7, "exactly 10\nshort"),
    (8, "EXACTLY 10\n\nshort"),
    (9, "ÀÉÎÕÜ àéîõü\nlast\r"),
    (10, "àéîõü àéîõü\nÀÉÎÕÜ àéîõü"),
    (11, "x" * 300_000 + "\n" + "many lines to come\n" * 3000 + "end"),
    (12, "many lines to come\nx\n" + "x" * 300_000),
    (12, "another text of twelve\nmany lines to come"),
    (12, "another text of twelve\nmany lines to come"),
    (None, "a common line here\nonly without an id\nonly without an id"),
    (None, "only without an id"),
    (-3, "many lines to come\n\nand a negative id"),
]


def check_lines(spark, rows):
    df = spark.createDataFrame([(*r, "e", "k", 1) for r in rows], "doc_id long, text string, pos string, key string, id int")
    got = sorted(map(str, map(tuple, L.op13_lines(df.repartition(3)).collect())))
    assert got == sorted(map(str, plain_lines(rows)))


def test_lines(spark):
    check_lines(spark, LINES)


def test_hot_lines_go_another_way(spark, monkeypatch):
    monkeypatch.setattr(L, "HOT_LINES", 3)
    monkeypatch.setattr(L, "HOT_KEYS", 10**6)
    check_lines(spark, LINES)


def test_lines_of_an_empty_table(spark, empty):
    assert L.op13_lines(empty).count() == 0


def test_lines_carry_columns(spark):
    df = spark.createDataFrame([(1, "the very same line", "k"), (2, "the very same line\nrest", "k")], "doc_id long, text string, kept string")
    got = {r.doc.doc_id: (r.doc.kept, r.kept, r.n_dropped) for r in L.dedup_lines(df).collect()}
    assert got == {1: ("k", "the very same line", 0), 2: ("k", "rest", 1)}


# --- words -------------------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(rows):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    n = {w: c for w, c in total.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], form[w], root, len(near[w]), n[form[w]] if form[w] else None))
    return out


def words_of(seed, docs=40):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 8))) for _ in range(25)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "abababab", "ababababa", "été" * 3, "Straße", "straße", "STRASSE", "naïveté"]

    def typo(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcdeé") + w[i + 1 :], w[:i] + rng.choice("abcé") + w[i:]])

    base += [typo(w) for w in base for _ in range(3)]
    weights = [1 / (k + 1) for k in range(len(base))]
    rng.shuffle(base)
    return [(i, " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(base, weights, k=60))) for i in range(docs)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spelling(spark, seed):
    rows = words_of(seed) + [(1000, None), (1001, ""), (None, "wordless wordless wordless wordles wordles wordles"), (3, "words_with9digits, and (brackets)")]
    rows += rows[:3]
    df = spark.createDataFrame([(*r, "w", 1, 2) for r in rows], "doc_id long, text string, word string, n int, id int").repartition(4)
    got = sorted(map(str, map(tuple, S.op12_spelling(df).collect())))
    want = plain_groups(rows)
    assert got == sorted(map(str, want)) and sum(w[2] is not None for w in want) > 10


def test_very_long_words(spark, monkeypatch):
    """A run of one letter has ties over its whole length; texts beyond the limit are matched one run at a time."""
    monkeypatch.setattr(S, "LONG_TEXT", 1000)
    long = "a" * 30_000
    words = [long, long + "a", long[:-1] + "b", "b" + long[1:], "x" + long]
    rows = [(i, " ".join(words)) for i in range(5)]
    # with ids that make no typo
    got = {r.word: r for r in S.op12_spelling(spark.createDataFrame([(None, t) for _, t in rows], "doc_id long, text string")).collect()}
    for w in words:
        assert got[w].n_near == sum(one_edit(w, x) for x in words)


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(4)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 7)))
        cost = [rng.randint(1, 9) for _ in places]
        at = dict(zip(places, cost))
        p, q = S.pivots(places, cost)
        assert q - p >= 2
        assert at[p] + at[q] == min(at[x] + at[y] for x, y in itertools.combinations(places, 2) if y - x >= 2)


def test_roots_of_a_long_chain(spark):
    links = spark.range(1, 40).select("id", (F.col("id") - 1).alias("form"))
    assert {(r.id, r.root) for r in S.roots(links).collect()} == {(i, 0) for i in range(1, 40)}


def test_spelling_of_an_empty_table(empty):
    assert S.op12_spelling(empty).count() == 0


# --- vectors -----------------------------------------------------------------


def plain_negatives(rows):
    usable = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        usable.append((k, i, [math.floor(256 * x) for x in v], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for k, i, v, label in usable:
        if i is None or i % 50:
            continue
        scored = [(dot(v, w), j, m, g) for g, j, w, m in usable]
        for s, j, _, _ in sorted((x for x in scored if x[2] == label and x[3] != k), key=order)[:5]:
            fit = [x for x in scored if x[2] != label and 50 * s <= 100 * x[0] <= 95 * s]
            out += [(i, j, r + 1, x[1], s, x[0]) for r, x in enumerate(sorted(fit, key=order)[:3])]
    return sorted(map(str, out))


def vectors(seed, n=400, dims=6):
    """Clusters with exact copies, ties and a hot vector; some rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    v = centres[rng.integers(0, 8, n)] + 0.3 * rng.normal(size=(n, dims))
    v[rng.random(n) < 0.3] = v[3]
    v = np.round(v, 2).astype(np.float32).astype(float).tolist()
    rows = [(int(i), x, int(rng.integers(0, 4))) for i, x in enumerate(v)]
    rows += [(50, v[7], 2), (50, v[7], 2), (None, v[9], 1), (None, v[9], 1), (450, None, 1), (451, v[1], None), (452, [None] * dims, 1)]
    rows += [(453, [float("nan")] * dims, 1), (500, [0.0] * dims, 1), (501, [], 2), (550, v[5][:3], 3), (-50, v[5] + [1.0], 3), (600, [float("inf")], 0)]
    return rows


def run_negatives(spark, rows):
    df = spark.createDataFrame([(*r, "s") for r in rows], "vec_id long, embedding array<double>, label int, score string")
    return sorted(map(str, map(tuple, N.op11_negatives(df.repartition(5)).collect())))


def test_negatives(spark):
    rows = vectors(1)
    want = plain_negatives(rows)
    assert run_negatives(spark, rows) == want and len(want) > 50


def test_negatives_over_many_shards(spark, monkeypatch):
    """Shards and anchor blocks of a few rows: routing, raised windows and cut hot cells all take part."""
    monkeypatch.setattr(N, "SHARD_ROWS", 16)
    monkeypatch.setattr(N, "ANCHORS", 3)
    monkeypatch.setattr(N, "LEAF", 2)
    rows = vectors(2)
    assert run_negatives(spark, rows) == plain_negatives(rows)


def test_negatives_beyond_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-(2**21), 2**21, 4)], int(i % 3)) for i in range(120)]
    assert run_negatives(spark, rows) == plain_negatives(rows)


def test_negatives_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    none = spark.createDataFrame([(1, None, None)], "vec_id long, embedding array<float>, label int")
    assert N.op11_negatives(empty).count() == N.op11_negatives(none).count() == 0


@pytest.mark.parametrize("dims", [1, 3, 20])
def test_tree_covers_and_bounds_hold(dims):
    rng = np.random.default_rng(dims)
    points = np.floor(50 * rng.normal(size=(500, dims)))
    points[100:200] = points[0]
    top = math.sqrt((points * points).sum(axis=1).max())
    lifted = N._lifted(points, top)
    tree = N.build_tree(lifted)
    assert sorted(tree["order"].tolist()) == list(range(500))

    def below(k):
        own = tree["order"][tree["own"][k] : tree["own"][k + 1]].tolist()
        return own + [x for c in tree["children"][tree["first"][k] : tree["first"][k + 1]] for x in below(int(c))]

    queries = points[rng.integers(0, 500, 20)]
    for k in range(len(tree["centre"])):
        inside = below(k)
        c = tree["centre"][k]
        assert (N._distances(lifted[inside], lifted[[c]]) <= tree["radius"][k] + 1e-6).all()
        for q in queries:
            lo, hi = N.bounds(points[[c]] @ q, tree["radius"][[k]], math.sqrt(q @ q), top)
            s = points[inside] @ q
            assert lo[0] <= s.min() and s.max() <= hi[0]
    # each level's radius shrinks
    for k in range(len(tree["centre"])):
        for c in tree["children"][tree["first"][k] : tree["first"][k + 1]]:
            assert tree["radius"][c] <= tree["radius"][k] / N.BASE + 1e-9
