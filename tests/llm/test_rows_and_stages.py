"""Repeated ids, many partitions, and every pipeline stage's rows and texts against plain Python."""

import hashlib
import os
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import fingerprints as fp
from tallyward.llm import neardup
from tallyward.llm.licenses import op10_licenses
from tallyward.llm.mixing import mix_sources
from tallyward.llm.pieces import MODEL, SEED, encode, op3_pieces, vocabulary

WORD = r"[^\x20\x09-\x0D]+"


def run(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_links_of_texts_that_share_an_id(spark):
    a, b = run("a", 60), run("b", 150)
    near_b = b.replace("b70", "x")
    rows = [(1, a), (1, b), (5, near_b), (7, b), (9, a), (9, run("c", 40))]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 56, 1), (1, 146, 1), (5, 146, 1), (7, 146, 1), (9, 36, 9), (9, 56, 1)]


def test_one_text_of_a_group_stays(spark):
    a, b = run("a", 60), run("b", 60)
    rows = [(1, a), (1, a), (1, a.upper()), (1, b), (2, a), (None, a), (None, a), (3, ""), (3, ""), (4, None)]
    kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ids = Counter((r.doc_id, (r.text or "").lower()) for r in kept)
    # empty texts are no near duplicates, but a row that repeats id and text goes
    assert ids == {(1, a): 1, (1, b): 1, (None, a): 2, (3, ""): 1, (4, ""): 1}


def test_hot_sets_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HOT_ROWS", 3)
    rows = [(i, run("a", 30)) for i in range(20)] + [(30 + i, run(f"d{i}", 20)) for i in range(4)] + [(40, run("d1", 20))]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 for i in range(20)} | {30: 30, 31: 31, 32: 32, 33: 33, 40: 31}


def test_notices_belong_to_their_row(spark):
    rows = [(None, "plain text"), (3, "Released under the MIT License."), (3, "other"), (None, "Released under the MIT License."), (5, None)]
    got = op10_licenses(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert Counter((r.doc_id, r.licenses, r.n_notices) for r in got) == {(None, None, 0): 1, (3, "MIT", 1): 1, (3, None, 0): 1, (None, "MIT", 1): 1, (5, None, 0): 1}


def test_fingerprints_at_many_partitions(spark):
    """The plan of thousands of parts is built, and the parts still follow each other."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of "), F.col("id")).alias("text"))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "5000")
        assert fp.op2_fingerprints(docs)._jdf.queryExecution().executedPlan() is not None
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        got = {r.doc_id: r.edited_sha256 for r in fp.op2_fingerprints(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    for i in range(400):
        x, y = f"text of {i}", f"text of {i - 1 if i else 399}"
        edited = x[: len(x) - len(x) // 2] + y[: len(x) // 2]
        assert got[i] == hashlib.sha256(edited.encode()).hexdigest()


def test_query_fingerprints_are_those_of_the_edited_text(docs):
    got = fp.op2_fingerprints(docs).collect()
    key = lambda d: (d.doc_id is not None, d.doc_id or 0)
    order = sorted(docs.collect(), key=key, reverse=True)
    want = defaultdict(set)
    for d, nxt in zip(order, order[1:] + order[:1]):
        x, y = d.text or "", nxt.text or ""
        edited = x[: len(x) - len(x) // 2] + y[: len(x) // 2]
        want[d.doc_id].add(fp.fingerprint(fp.prefix_arrays(edited)))
    assert all(r.edited_fingerprint in want[r.doc_id] for r in got)


def test_likeness_is_of_the_fingerprints(docs):
    got = fp.op2_fingerprints(docs).collect()
    marks = {}
    for r in got:
        marks.setdefault(r.doc_id, set()).add(r.fingerprint)
    key = lambda d: (d.doc_id is not None, d.doc_id or 0)
    order = sorted(docs.collect(), key=key, reverse=True)
    following = {d.doc_id: nxt.doc_id for d, nxt in zip(order, order[1:] + order[:1])}
    for r in got:
        assert r.near_edited == fp.fingerprint_likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next in {fp.fingerprint_likeness(r.fingerprint, m) for m in marks[following[r.doc_id]] | marks[r.doc_id]}


def test_fingerprint_likeness():
    rng = np.random.default_rng(8)
    mark = lambda t: fp.fingerprint(fp.prefix_arrays(t))
    near = lambda a, b: fp.fingerprint_likeness(mark(a), mark(b))
    sentences = [" ".join(f"wörd{x}" for x in rng.integers(0, 10**6, 12)) + ". " for _ in range(40)]
    text = "".join(sentences)
    other = "".join(" ".join(f"u{x}" for x in rng.integers(0, 10**6, 12)) + ". " for _ in range(40))
    assert near(text, text) == near("", "") == 1 and near(text, "") == near("", text) == 0
    assert near(text, other) < 0.05 and near(text, other) == near(other, text)
    assert near(text, "".join(sentences[:20]) + other[: len(text) // 2]) == pytest.approx(0.5, abs=0.05)
    # halves swapped (three stretches broken), edits at both ends (two), a hole, and a text three times as long at another level
    assert near(text, "".join(sentences[20:] + sentences[:20])) > 0.8
    assert near(text, "X" + text[1:-1] + "Y") > 0.9
    assert near(text, "".join(sentences[:18] + sentences[21:])) > 0.8
    assert near(text, text + other + other) == pytest.approx(len(text) / (len(text) + 2 * len(other)), abs=0.08)
    long = "".join(" ".join(f"v{x}" for x in rng.integers(0, 10**6, 12)) + ". " for _ in range(2000))
    level, parts = fp.stretches(fp.prefix_arrays(long))
    assert len(parts) <= fp.CHUNKS and level > fp.LEAST_RANK and sum(s for s, _, _ in parts) == len(long)
    # stretches of a level are those that the next finer ones add up to
    fine = fp.stretches(fp.prefix_arrays(text))[1]
    assert fp._coarser(fine, 99) == [(len(text), int(fp.prefix_arrays(text)[0][-1]))]
    for size in (1, 5, 16, 17, 40):
        assert near("é" * size, "é" * size) == 1 and 0 <= near("é" * size, "é" * (size + 1)) <= 1


def test_query_pieces(docs):
    """n_pieces and pieces_hash of the query are those of the pieces that encode draws."""
    spark = docs.sparkSession
    vocab = vocabulary(MODEL)
    rows = [(d.doc_id, (d.text or "").encode()) for d in docs.collect()]
    keys = np.array([i or 0 for i, _ in rows], np.int64)
    drawn = encode(vocab, [t for _, t in rows], keys, SEED)
    plain = spark.createDataFrame([(i, p.tolist()) for (i, _), p in zip(rows, drawn)], "doc_id long, pieces array<int>")
    want = plain.select("doc_id", F.size("pieces").alias("n"), F.xxhash64("pieces").alias("h")).collect()
    got = op3_pieces(docs).collect()
    assert sorted(map(str, ((r.doc_id, r.n_pieces, r.pieces_hash) for r in got))) == sorted(map(str, map(tuple, want)))


# --- mix ----------------------------------------------------------------------


def plain_taken(rows, block):
    """Words that the mix takes of each (source, key) by walking through slots and words one at a time."""
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len(re.findall(WORD, text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, full = {}, set()
    total = sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        spare = total - sum(3 * sizes[s] for s in full)
        level = {s: spare * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if level[s] > 3 * sizes[s]}
        if not over:
            target = {s: level.get(s, 3 * sizes[s]) for s in order}
            break
        full |= over
    return target, sizes


MIXED = [(i, ["a", "b", None, "d"][i % 7 % 4], run(f"w{i}x", 3 + i * 13 % 90)) for i in range(120)]
MIXED += [(200, "d", None), (201, "d", ""), (202, "tiny", "only three words"), (203, "tiny", run("z", 17)), (3, "a", run("again", 40))]


@pytest.mark.parametrize("block", [16, 64])
def test_words_taken_of_each_document(spark, block):
    df = spark.createDataFrame(MIXED, "doc_id long, source string, text string").repartition(3)
    got = mix_sources(df, block=block, carry=["text"]).collect()
    target, sizes = plain_taken(MIXED, block)
    taken = defaultdict(list)
    for r in got:
        source = next(s for i, s, t in MIXED if i == r.doc_id and t == r.carry.text)
        assert r.size == len(re.findall(WORD, r.carry.text or "")) and r.source_size == sizes[source]
        assert r.target == pytest.approx(target[source])
        taken[source].append((r.size, r.taken))
    for s, parts in taken.items():
        quota = round(target[s])
        assert sum(t for _, t in parts) == quota
        # every document is taken in all whole rounds, and at most once more
        rounds = quota // sizes[s] if sizes[s] else 0
        assert all(rounds * n <= t <= (rounds + 1) * n for n, t in parts)


def test_written_mix_is_the_computed_one(spark):
    rows = [(i, s, t, "en", None if t is None else len(t)) for i, s, t in MIXED]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, lang string, n_chars long").repartition(3)
    out = corpus_pipeline.mix_by_weight(spark, df, "")
    assert out.columns == df.columns
    target, sizes = plain_taken(MIXED, 4096)
    words, cut = Counter(), Counter()
    times = Counter()
    for r in out.collect():
        words[r.source] += len(re.findall(WORD, r.text))
        originals = [t for i, s, t in MIXED if i == r.doc_id and s == r.source]
        assert any(t and t.startswith(r.text) for t in originals) and r.n_chars == len(r.text)
        cut[r.source] += r.text not in originals
        times[r.doc_id, r.source, r.text] += 1
    assert all(words[s] == round(target[s]) for s in sizes)
    assert all(c <= 1 for c in cut.values()) and max(times.values()) <= 3


# --- stages -------------------------------------------------------------------


def test_near_duplicate_stage(spark, docs):
    got = {(r.doc_id, r.text) for r in corpus_pipeline.drop_duplicates(spark, docs, "").collect()}
    first = {}
    texts = {}
    for d in sorted(docs.collect(), key=lambda d: (d.doc_id is None, d.doc_id or 0)):
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), d.text or ""))
        texts[d.doc_id, d.text] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    for key, s in texts.items():
        near = [k for k, t in texts.items() if s and t and None not in (k[0], key[0]) and 100 * len(s & t) >= 75 * len(s | t)]
        first[key] = min((k[0] for k in near), default=key[0])
    # the fixture's groups are cliques: the least linked id is the least of the group
    assert got == {k for k in texts if first[k] == k[0]}


def test_repeats_stage(spark):
    """Long passages cut at byte places, multi-byte characters at the borders included; what is left is valid text."""
    passage = "é" + run("pässage", 30) + "ü"
    rows = [(i, t, "en", "a", None if t is None else len(t)) for i, t in enumerate([
        "first " + passage + " end", "ü" + passage + "é", passage, None, "", "clean words that nobody repeats", passage[:40],
    ])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.cut_repeats(spark, df, "").collect()}
    seen = set()
    for i, t, *_ in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(raw[k : k + 100])
        left = np.frombuffer(raw, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        if t is None:
            assert got[i].text is None
        else:
            assert got[i].text.replace("�", "") == left and got[i].n_chars == len(got[i].text)


def test_pieces_stage(spark, docs):
    got = corpus_pipeline.into_pieces(spark, docs, "").collect()
    vocab = vocabulary(MODEL)
    want = Counter((d.doc_id, hashlib.sha256((d.text or "").encode()).hexdigest()) for d in docs.collect())
    assert Counter((r.doc_id, r.decoded_sha256) for r in got) == want
    assert all(r.n_pieces == len(r.pieces) and hashlib.sha256(b"".join(vocab.text[p] for p in r.pieces)).hexdigest() == r.decoded_sha256 for r in got)


# --- long chunks ----------------------------------------------------------------


def test_long_chunks_have_the_lattice_of_short_ones(monkeypatch):
    from tallyward.llm import pieces as P

    vocab = vocabulary(MODEL)
    rng = np.random.default_rng(2)
    chunk = bytes(rng.choice(np.frombuffer("theinationéing".encode(), np.uint8), 60))
    short, long = P.Lattice(vocab, [chunk]), P.LongChunk(vocab, chunk)
    first, size, piece, upto, _ = long._filtered(0, len(chunk))
    assert (short.first[1:] - short.first[1] == first).all() and (short.piece == piece).all()
    assert np.abs(short.upto - upto).max() <= len(vocab.sizes) + 1  # rounding of the shares
    # any window gives the same path, and another seed another one
    text = bytes(rng.choice(np.frombuffer(b"theinationing", np.uint8), 3000))
    paths = []
    for window in (1 << 15, 500, 41):
        monkeypatch.setattr(P, "WINDOW", window)
        paths.append(encode(vocab, [text], np.array([4]))[0].tolist())
    assert paths[0] == paths[1] == paths[2] != encode(vocab, [text], np.array([5]))[0].tolist()


def test_lattice_of_many_lengths_and_its_lookups(monkeypatch):
    """Each chunk's edges are those it has alone, and few places are looked up among the pieces."""
    from tallyward.llm import pieces as P

    vocab = vocabulary(MODEL)
    words = b"the internationalisation of 2048 representations is responsible for misunderstandings".split()
    chunks = sorted({w[:n] for w in words for n in range(1, len(w) + 1)} | {b" " + w for w in words} | {"日本é".encode(), b" " * 20})
    looked_up = []
    monkeypatch.setattr(P.np, "searchsorted", lambda a, v, *more, real=np.searchsorted: (looked_up.append(np.size(v) if a.dtype == np.uint64 else 0), real(a, v, *more))[1])
    every = P.Lattice(vocab, chunks)
    monkeypatch.undo()
    assert sum(looked_up) < 2.5 * sum(map(len, chunks))  # 3.4 when all pairs and triples were looked up
    for k, chunk in enumerate(chunks):
        alone = P.Lattice(vocab, [chunk])
        base, stride = every.base[k], every.stride[k]
        for e in range(len(chunk) + 1):
            here, there = base + e * stride, e
            a, b = slice(every.first[here], every.first[here + 1]), slice(alone.first[there], alone.first[there + 1])
            assert every.piece[a].tolist() == alone.piece[b].tolist() and every.upto[a].tolist() == alone.upto[b].tolist()
            assert ((every.start[a] - base) // stride).tolist() == alone.start[b].tolist()
            want = {chunk[s:e] for s in range(e) if chunk[s:e] in set(vocab.text) or e - s == 1} if len(chunk) < 6 else None
            assert want is None or {vocab.text[i] for i in alone.piece[b]} == want


def test_unspaced_text_of_megabytes_in_bounded_memory():
    """4 MB of letters without a space take the memory of a window."""
    code = (
        "import resource, numpy as np\n"
        "from tallyward.llm.pieces import MODEL, decode, encode, vocabulary\n"
        "v = vocabulary(MODEL)\n"
        "t = bytes(np.random.default_rng(0).integers(97, 123, 4_000_000, dtype=np.uint8))\n"
        "out = encode(v, [t], np.array([3]))[0]\n"
        "assert decode(v, out) == t\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)\n"
    )
    top = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    done = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, timeout=600, env=os.environ | {"PYTHONPATH": top}
    )
    assert done.returncode == 0, done.stderr[-1500:]
    assert int(done.stdout.split()[-1]) < 1000


# --- archives -------------------------------------------------------------------


def test_histories_merge_the_archives_runs(spark, monkeypatch):
    """Many small archives: each is one sorted run, ranges cut runs, and a url in most captures spans ranges."""
    from tallyward.llm import warc

    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 200)
    rows = [(i, f"http://a.example/{'hot' if i % 3 else i % 7}", f"body {i % 5}" * (i % 4), "x", i) for i in range(90)] + [(7, "http://a.example/hot", "again", "x", 1), (None, None, None, "x", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, url_key string, row int").repartition(3)
    folder = warc.scratch_path(spark, "archives")
    warc.write_archives(pages.select("page_id", "url", "html"), folder)
    runs = warc.read_archives(spark, folder).collect()
    assert len(runs) > 3
    for r in runs:
        keys = list(zip(r.url_key, r.stamp, r.row))
        assert keys == sorted(keys)
    got = warc.op5_warc(pages).collect()
    assert len(got) == len(rows)
    histories = defaultdict(list)
    for r in got:
        histories[r.url_key].append((r.capture, r.stamp))
    for h in histories.values():
        h.sort()
        assert [c for c, _ in h] == list(range(1, len(h) + 1)) and [s for _, s in h] == sorted(s for _, s in h)
    assert max(map(len, histories.values())) > 50
    assert {r.stamp[:10] for r in got} == {"2000-01-01"} and all(r.stamp.endswith("Z") for r in got)
