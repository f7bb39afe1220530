"""Text operators against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import math
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import fingerprints as fp
from tallyward.llm import licenses, toxicity
from tallyward.llm.licenses import op10_licenses
from tallyward.llm.mixing import mix_sources, op7_mixing
from tallyward.llm.neardup import near_duplicates
from tallyward.llm.pieces import MODEL, decode, encode, op3_pieces, sample_pieces, vocabulary
from tallyward.llm.quality import op1_quality
from tallyward.llm.suffixes import op9_suffix
from tallyward.llm.toxicity import op6_toxicity
from tallyward.llm.urlrules import op8_urls
from tallyward.llm.warc import merge_runs, op5_warc

WORD = r"[^\x20\x09-\x0D]+"


def test_empty_tables(spark, empty):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for op in (op1_quality, fp.op2_fingerprints, op3_pieces, near_duplicates, op7_mixing, op9_suffix, op10_licenses):
        assert op(empty).count() == 0
    assert op5_warc(pages).count() == op8_urls(pages).count() == op6_toxicity(empty, labels).count() == 0


def test_quality_metrics(docs):
    got = {r.doc_id: r for r in op1_quality(docs).collect()}
    for d in docs.collect():
        text = d.text or ""
        w = re.findall(WORD, text)
        runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        times = Counter(runs)
        hit = {j for i, r in enumerate(runs) if times[r] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        r = got[d.doc_id]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * len(hit) > 30 * len(w))
        assert not (r.base_failed and r.kept)


def test_quality_of_small_groups(spark):
    """Junk in groups of two, and in one that is mostly junk; clean texts of small groups and rare languages stay."""
    clean = lambda i: " ".join(f"word{(i * 37 + k * k) % 997}" for k in range(60))
    junk = lambda i: " ".join(f"w{(i * 37 + k * k) % 997}#*|" for k in range(60))
    data = [(i, clean(i), "en", "big") for i in range(150)]
    data += [(1000, clean(100), "en", "two"), (1001, junk(101), "en", "two")]
    data += [(200 + i, junk(200 + i), "en", "mostly") for i in range(40)] + [(250, clean(250), "en", "mostly")]
    data += [(300, clean(300).replace("word", "verylongwordsofanotherscript"), "xx", "one"), (301, junk(301), "yy", "one")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in corpus_pipeline.keep_quality(spark, docs, "").collect()}
    assert set(range(150)) | {1000, 250, 300} <= kept
    assert not kept & {1001, 301, *range(200, 240)}


def test_fingerprints(docs):
    got = fp.op2_fingerprints(docs).collect()
    assert len(got) == docs.count()
    key = lambda d: (d.doc_id is not None, d.doc_id or 0)
    order = sorted(docs.collect(), key=key, reverse=True)
    by_id = defaultdict(list)
    for d, nxt in zip(order, order[1:] + order[:1]):
        x, y = d.text or "", nxt.text or ""
        edited = x[: len(x) - len(x) // 2] + y[: len(x) // 2]
        by_id[d.doc_id].append((len(x), hashlib.sha256(edited.encode()).hexdigest(), fp.fingerprint(fp.prefix_arrays(x))))
    for r in got:
        assert (r.n_chars, r.edited_sha256, r.fingerprint) in by_id[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    p, q = fp.prefix_arrays("abcabcabd"), fp.prefix_arrays("xxabcabcxx")
    assert fp.common_extension(p, 0, q, 2) == 6 and fp.common_extension(p, 3, q, 2) == 5
    assert fp.same_span(p, 0, p, 3, 3) and not fp.same_span(p, 0, p, 1, 3)


def test_likeness_of_edits_at_both_ends(spark):
    def near(a, b):
        p, q = fp.prefix_arrays(a), fp.prefix_arrays(b)
        return fp.likeness(p, q, fp.anchors(p), fp.anchors(q))

    rng = np.random.default_rng(3)
    base = [f"wört{x}" for x in rng.integers(0, 10**6, 200)]
    text = " ".join(base)
    edited = "X" + text[1:-1] + "Y"
    assert near(text, edited) == near(edited, text) == (len(text) - 2) / len(text)
    spread = list(base)
    for i in (1, 60, 130, 198):
        spread[i] = "#" * len(spread[i])
    gone = sum(len(base[i]) for i in (1, 60, 130, 198))
    assert (len(text) - gone - 40) / len(text) <= near(text, " ".join(spread)) <= (len(text) - gone) / len(text)
    assert near(text, " ".join(base[:90] + base[95:])) > 0.95
    other = " ".join(f"u{x}" for x in rng.integers(0, 10**6, 200))
    assert near(text, other) < 0.05 and near(text, text) == near("", "") == 1 and near(text, "") == 0
    docs = spark.createDataFrame([(1, edited), (2, text)], "doc_id long, text string")
    got = {r.doc_id: r.near_next for r in fp.op2_fingerprints(docs).collect()}
    # the query's likenesses are of the fingerprints, which see the edits' stretches, not their places
    assert 0.9 < got[2] == got[1] <= (len(text) - 2) / len(text)


def test_pieces_round_trip(docs):
    text = {(d.doc_id, d.text or "") for d in docs.collect()}
    got = sample_pieces(docs).collect()
    assert {(r.doc_id, bytes(r.decoded).decode()) for r in got} == text and len(got) == docs.count()
    again = {(r.doc_id, tuple(r.pieces)) for r in sample_pieces(docs.repartition(1)).collect()}
    assert again == {(r.doc_id, tuple(r.pieces)) for r in got}


def test_pieces_follow_the_lattice_distribution():
    vocab = vocabulary(MODEL)
    word, n = b" the", 4000
    drawn = Counter(tuple(x) for x in encode(vocab, [word] * n, np.arange(n)))
    weight = lambda piece: {**{(t, i): (i + 2.0) ** -1 for i, t in enumerate(vocab.text)}}[piece]
    total, paths = 0.0, {}

    def walk(at, path, w):
        nonlocal total
        if at == len(word):
            paths[tuple(path)] = w
            total += w
            return
        for i, t in enumerate(vocab.text):
            if t and len(t) > 1 and word.startswith(t, at):
                walk(at + len(t), [*path, i], w / (i + 2.0))
        single = int(vocab.single[word[at]])
        walk(at + 1, [*path, single], w * float(vocab.single_weight[word[at]]))

    walk(0, [], 1.0)
    for path, w in paths.items():
        assert abs(drawn[path] / n - w / total) < 0.03
    assert all(decode(vocab, np.array(p)) == word for p in drawn)


def test_near_duplicates(docs):
    got = near_duplicates(docs).collect()
    assert len(got) == docs.count()
    sets = {}
    for d in docs.collect():
        w = re.sub("[A-Z]", lambda m: m[0].lower(), d.text or "")
        w = re.findall(WORD, w)
        sets[d.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in root:
        for b in root:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for r in got:
        want = None if r.doc_id is None else find(r.doc_id)
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want, r.doc_id == want)


def test_components_of_a_chain(spark):
    from tallyward.llm.components import components

    edges = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    got = components(edges.union(spark.createDataFrame([(100, 101), (7, 7)], "a long, b long"))).collect()
    assert {(r.node, r.component) for r in got} == {(i, 0) for i in range(60)} | {(100, 100), (101, 100)}


def test_warc(spark):
    rows = [(i, f"http://a.example/{i % 3}", ["same body é", "", None, f"own {i}\r\n\r\nWARC/1.0"][i % 4]) for i in range(23)]
    rows += [(None, None, "no id")]
    got = op5_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, html in rows:
        first.setdefault(html or "", i)
    for r in got:
        html = (rows[r.page_id][2] if r.page_id is not None else "no id") or ""
        sha = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        own = first[html]
        want = ("response", None) if own == r.page_id else ("revisit", own)
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(html.encode()), sha, *want)
    seen = defaultdict(list)
    for r in got:
        seen[r.url_key].append((r.stamp, r.capture))
    assert all([c for _, c in sorted(v)] == list(range(1, len(v) + 1)) for v in seen.values())


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7])
def test_loser_tree(k):
    rng = np.random.default_rng(k)
    runs = [sorted(rng.integers(0, 50, rng.integers(0, 30)).tolist()) for _ in range(k)]
    assert list(merge_runs(runs)) == sorted(x for r in runs for x in r)


def test_toxicity(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"v{x}" for x in rng.integers(0, 200, 40)) + (" vile" if i % 4 == 0 else "") for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1000, None), (None, "vile")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got = op6_toxicity(docs, labels).collect()
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert len(got) == 402 and len(held) > 40
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_toxicity_sample(spark):
    texts = [f"plain words {i % 7} here" + (" vile" if i % 4 == 0 else "") for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = [*range(40), *range(1000, 9000)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in ids], "doc_id long, toxic int")
    # labels without a document take no place in the sample
    assert np.array_equal(toxicity.train(docs, labels, l1=0.1, rows=40), toxicity.train(docs, labels.where("doc_id < 40"), l1=0.1))
    assert toxicity.train(docs, labels, l1=0.1, rows=40).any()


def test_toxicity_rare_cells(spark):
    """A toxic word that a run over half of the rows each loses to its penalty."""
    texts = [f"v{i % 50} v{i % 31} v{i % 17}" + (f" vile{i % 3}" if i % 20 < 3 else "") for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 20 < 3)) for i in range(600)], "doc_id long, toxic int")
    words = spark.createDataFrame([(k, f"vile{k}") for k in range(3)], "doc_id long, text string")
    one, two = toxicity.train(docs, labels), toxicity.train(docs, labels, shards=2)
    worth = lambda w: [r.score for r in toxicity.score(words, w).orderBy("doc_id").collect()]
    assert all(a > b for a, b in zip(worth(one), worth(two)))


def test_toxicity_against_plain_ftrl(spark):
    """Weights and scores of a row-at-a-time learner that keeps a dictionary per coordinate."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"t{x}" for x in rng.integers(0, 12, 1 + i % 9)) + (" bad luck" if i % 5 == 0 else "") for i in range(120)]
    texts[7], texts[8] = "", None
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(120)], "doc_id long, toxic int")

    def cells(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        row, cell = toxicity.features(data, np.array([0, len(data)], np.int64))
        return sorted(set(cell.tolist())) + [1 << toxicity.BITS]

    order = spark.range(120).select("id", F.xxhash64("id").alias("draw")).orderBy("draw").collect()
    learned = [r.id for r in order if zlib.crc32(str(r.id).encode()) % 5]
    z, n, l1 = defaultdict(float), defaultdict(float), 0.3

    def weight(c):
        limit = 0.0 if c == 1 << toxicity.BITS else l1
        return 0.0 if abs(z[c]) <= limit else -(z[c] - math.copysign(limit, z[c])) / ((1.0 + math.sqrt(n[c])) / 0.5 + 0.2)

    for _ in range(2):
        for i in learned:
            at = cells(texts[i])
            w = {c: weight(c) for c in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - (i % 5 == 0)
            for c in at:
                z[c] += g - (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / 0.5 * w[c]
                n[c] += g * g
    got = toxicity.train(docs, labels, alpha=0.5, beta=1.0, l1=l1, l2=0.2, epochs=2)
    want = {c: weight(c) for c in z if weight(c)}
    assert set(np.flatnonzero(got).tolist()) == set(want)
    assert all(got[c] == pytest.approx(w, abs=1e-5) for c, w in want.items())
    for r in toxicity.score(docs, got).collect():
        margin = sum(weight(c) for c in cells(texts[r.doc_id]))
        assert r.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-5)


def test_mixing(docs):
    got = op7_mixing(docs).collect()
    assert len(got) == docs.count()
    size, taken, target = Counter(), Counter(), {}
    source = {d.doc_id: d.source for d in docs.collect()}
    for r in got:
        s = source[r.doc_id]
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    assert all(abs(taken[s] - target[s]) <= 1 and target[s] <= 3 * size[s] + 1e-9 for s in size)
    small = {(r.doc_id, r.taken) for r in mix_sources(docs, block=16).collect()}
    assert small == {(r.doc_id, r.taken) for r in mix_sources(docs.repartition(1), block=16).collect()}


def test_urls(spark):
    urls = ["http://www.Example.org/en/12", "https://example.org/es/x", "ftp://a.org/", "http://a.org", None, "no url", "http://x.com/de/?q", "http://x.com/fr/1#t"]
    got = op8_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in got] == [
        ("example.org/en/1", "block"), ("example.org/es/", "block"), ("org/", "allow"), (None, "allow"), (None, "allow"),
        (None, "allow"), ("com/de/", "block"), ("com/fr/", "allow"),
    ]
    assert got[0].host == "www.example.org" and got[3].path == "" and got[4].host == ""


def test_suffixes(docs):
    got = op9_suffix(docs).collect()
    order = sorted(docs.collect(), key=lambda d: (d.doc_id is not None, d.doc_id or 0))
    seen, want = set(), []
    for d in order:
        t = (d.text or "").encode()
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 99):
            if t[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(t[i : i + 100])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        want.append((d.doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def test_licenses(docs):
    got = {r.doc_id: r for r in op10_licenses(docs).collect()}
    assert got[14].licenses == "MIT" and got[14].whole_text and got[14].n_notices == 1
    assert got[0].licenses is None and got[7].n_notices == 0


def test_license_texts(spark):
    mit = licenses.known_texts()["MIT"][3]
    wrapped = "\n".join(textwrap.wrap(" ".join(mit.split()), 37))
    apache = next(t for t in licenses.known_texts()["Apache-2.0"] if "Definitions" in t)
    bsd = next(t for t in licenses.known_texts()["BSD-3-Clause"] if "Redistributions" in t)
    isc = next(t for t in licenses.known_texts()["ISC"] if "AS IS" in t)
    texts = [
        ("MIT License\n\nCopyright (c) 2020 X. Y.\n\n" + mit, "MIT", 1, True),
        ("some words before\n# " + wrapped.replace("\n", "\n# ") + "\n# and behind", "MIT", 1, False),
        ("Copyright 2020 X. Licensed under the MIT License.", "MIT", 1, True),
        ("code\n * Licensed under the\n * MIT\n * License.\n", "MIT", 1, False),
        (apache, "Apache-2.0", 1, True),
        ("/* Copyright (c) 1999, A, Inc. All rights reserved.\n" + bsd + "*/ int x;\n" + apache + "end", "Apache-2.0,BSD-3-Clause", 2, False),
        ("Copyright 2020 X\n" + isc, "ISC", 1, True),
        (mit[: len(mit) // 3], None, 0, False),
        ("Released under the MIT\nlicence or not. Released under the MIT License", "MIT", 1, False),
        ("Licensed under the Apache License, Version\n2.0 (the \"License\");", "Apache-2.0", 1, True),
    ]
    got = op10_licenses(spark.createDataFrame([(i, t[0]) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == [t[1:] for t in texts]


def test_pipeline(spark, docs, tmp_path):
    path = str(tmp_path)
    docs.write.parquet(f"{path}/documents.parquet")
    rest = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rest = stage(spark, rest, path)
        assert rest.columns == docs.columns, name
    final = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in final} <= {d.doc_id for d in docs.collect()}
    assert {0, 4, 5} <= {r.doc_id for r in final}
