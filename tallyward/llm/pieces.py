"""Sampled segmentations into pieces: forward filtering, backward sampling, lossless decoding.

The lattice of a text has a node per byte position and an edge per vocabulary
piece that matches there, plus one edge for every single byte, so every text
has a path. No piece has a space but at its front, so the lattice falls apart
at the places between a character and a space and is handled one such chunk
at a time; equal chunks share their forward sums. A chunk without spaces may be
a whole text: a long one is filtered in windows that hand on the sums of their
last nodes only, and drawn window by window from its end, each window's sums
being made again, so that memory does not grow with it. Backwards, the piece that
ends at a node is drawn with its share of the forward sum. The draws come from
a hash of the row key, the chunk's place and the step, so a row gets the same
pieces in every run.

Weights are powers of the piece's rank in the vocabulary (Zipf), since the
model's own scores are ranks. Decoding joins the pieces' bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import lean, mix, slices, text_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Weight of a piece of rank r is (r + 2) ** -ALPHA; of a single byte outside the vocabulary BYTE_WEIGHT.
ALPHA = 1.0
BYTE_WEIGHT = 1e-7
SEED = 7
SLICE = 1 << 19
#: Chunks up to this length are filtered side by side, longer ones in windows of nodes.
WIDE = 64
WINDOW = 1 << 15
_CHUNK = re.compile(rb" *[^ ]+| +")


class Pieces:
    """The vocabulary as byte strings; the mark of a space is a plain space."""

    def __init__(self, model: str, alpha: float, byte_weight: float):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        n = processor.get_piece_size()
        self.text: list[bytes] = [b""] * n
        self.byte_id = np.zeros(256, np.int64)
        by_size: dict[int, list[tuple[int, int]]] = {}
        for i in range(n):
            if processor.is_byte(i):
                value = int(processor.id_to_piece(i)[3:-1], 16)
                self.text[i] = bytes([value])
                self.byte_id[value] = i
            elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
                piece = processor.id_to_piece(i).replace("▁", " ").encode()
                self.text[i] = piece
                if b" " not in piece.lstrip(b" "):
                    by_size.setdefault(len(piece), []).append((self.key(piece), i))
        weight = (np.arange(n) + 2.0) ** -alpha
        # one edge per byte: the vocabulary's own piece of one byte, else the byte piece
        self.single = self.byte_id.copy()
        self.single_weight = np.full(256, byte_weight)
        for key, i in by_size.pop(1, []):
            self.single[key], self.single_weight[key] = i, weight[i]
        self.sizes = sorted(by_size)
        # longest piece by its first three bytes: most places start none of the longer ones
        self.reach = np.zeros(1 << 24, np.uint8)
        # which lengths its pieces have, a bit each from three on, the last for all that are longer
        self.lengths = np.zeros(1 << 24, np.uint16)
        for size in self.sizes:
            for _, i in by_size[size] if size > 2 else ():
                a, b, c = self.text[i][:3]
                self.lengths[a << 16 | b << 8 | c] |= self.length_bit(size)
                if size > 3:
                    self.reach[a << 16 | b << 8 | c] = size
        self.keys, self.ids, self.weights, self.bytes = {}, {}, {}, {}
        for size, pairs in by_size.items():
            keys = np.array([k for k, _ in pairs], np.uint64)
            ids = np.array([i for _, i in pairs], np.int64)
            order = np.argsort(keys)
            self.keys[size], self.ids[size] = keys[order], ids[order]
            self.weights[size] = weight[ids[order]]
            self.bytes[size] = np.frombuffer(b"".join([self.text[i] for i in ids[order].tolist()]), np.uint8).reshape(-1, size)
        # place of a piece of two bytes among them, -1: none
        self.pair = np.full(1 << 16, -1, np.int32)
        for at, i in enumerate(self.ids[2].tolist() if 2 in self.ids else ()):
            self.pair[self.text[i][0] << 8 | self.text[i][1]] = at

    @staticmethod
    def length_bit(size: int) -> int:
        return 1 << min(size - 3, 15)

    @staticmethod
    def key(piece: bytes) -> int:
        """Base-257 value modulo 2**64; up to 7 bytes it is exact, beyond it the bytes are compared."""
        k = 0
        for b in piece:
            k = (k * 257 + b) & 0xFFFFFFFFFFFFFFFF
        return k


@lru_cache(maxsize=2)
def vocabulary(model: str, alpha: float = ALPHA, byte_weight: float = BYTE_WEIGHT) -> Pieces:
    return Pieces(model, alpha, byte_weight)


class Lattice:
    """Edges of many chunks, sorted by end node, with cumulative shares of the forward sums.

    Nodes are numbered by length of chunk, place in it, chunk: the filter meets
    them in this order, so that its edges need no sort over all of them.
    """

    def __init__(self, vocab: Pieces, chunks: list[bytes]):
        self.sizes = np.array([len(c) for c in chunks], np.int64)
        small = np.flatnonzero(self.sizes <= WIDE)
        order = small[np.argsort(self.sizes[small], kind="stable")]
        groups = [g for g in np.split(order, np.flatnonzero(np.diff(self.sizes[order])) + 1) if len(g)]
        self.base = np.zeros(len(chunks), np.int64)
        self.stride = np.zeros(len(chunks), np.int64)  # from a chunk's node to its next
        found: list[tuple[np.ndarray, ...]] = []
        nodes = 0
        for group in groups:
            width = int(self.sizes[group[0]])
            grid = np.frombuffer(b"".join([chunks[k] for k in group]), np.uint8).reshape(len(group), width)
            self.base[group] = nodes + np.arange(len(group))
            self.stride[group] = len(group)
            found.append((np.zeros(len(group), np.int32), *(np.empty(0, t) for t in (np.int32, np.int32, np.int64))))
            found += self._filtered(vocab, grid, nodes)
            nodes += len(group) * (width + 1)
        parts = list(zip(*found))
        del found
        # edges into each node
        count = np.concatenate(parts[0])
        self.first = np.concatenate([np.zeros(1, np.int32), np.cumsum(count, dtype=np.int32)])
        self.start, self.piece = np.concatenate(parts[1]), np.concatenate(parts[2])
        # whole numbers: sums do not depend on what else is in the lattice
        self.upto = np.concatenate(parts[3])
        del parts
        np.cumsum(self.upto, out=self.upto)
        before = np.concatenate([np.zeros(1, np.int64), self.upto])[self.first[:-1]]
        self.upto -= np.repeat(before, count)

    @staticmethod
    def _filtered(vocab: Pieces, grid: np.ndarray, base: int):
        """Forward sums of chunks of one length, scaled per node; per place the nodes' (edge counts, start, piece, share)."""
        rows, width = grid.shape
        edges: list[list[tuple[np.ndarray, int, np.ndarray, np.ndarray]]] = [[] for _ in range(width + 1)]
        kind = np.uint16 if rows <= 1 << 16 else np.int64  # short numbers are sorted by counting
        every = np.arange(rows)
        for p in range(width):
            edges[p + 1].append((every, p, vocab.single[grid[:, p]], vocab.single_weight[grid[:, p]]))
        # place by place: a column of the grid is a stretch of this
        by_place = np.ascontiguousarray(grid.T)
        wide = by_place.astype(np.uint64)
        key = wide.copy()
        if width > 2:
            long = by_place.astype(np.int32)
            lengths = vocab.lengths[long[:-2] << 16 | long[1:-1] << 8 | long[2:]]
        for size in range(2, min(width, vocab.sizes[-1] if vocab.sizes else 1) + 1):
            key = key[:-1] * np.uint64(257) + wide[size - 1 :]
            if size not in vocab.keys:
                continue
            if size == 2:
                at = vocab.pair[by_place[:-1].astype(np.int32) << 8 | by_place[1:]]
                p, row = np.nonzero(at >= 0)
                which = at[p, row]
            else:
                table = vocab.keys[size]
                p, row = np.nonzero(lengths[: len(key)] & vocab.length_bit(size))
                wanted = key[p, row]
                at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
                hit = np.flatnonzero(table[at] == wanted)
                p, row, which = p[hit], row[hit], at[hit]
            if size > 7 and len(p):
                good = (by_place[p[:, None] + np.arange(size), row[:, None]] == vocab.bytes[size][which]).all(axis=1)
                p, row, which = p[good], row[good], which[good]
            if not len(p):
                continue
            piece, weight = vocab.ids[size][which], vocab.weights[size][which]
            cut = np.searchsorted(p, np.arange(width + 1))
            for q in np.flatnonzero(np.diff(cut)).tolist():
                s = slice(cut[q], cut[q + 1])
                edges[q + size].append((row[s], q, piece[s], weight[s]))
        log_sum = np.zeros((width + 1, rows))
        out = []
        for e in range(1, width + 1):
            parts = edges[e]
            values = [np.log(w) + log_sum[q, r] for r, q, _, w in parts]
            top = values[0].copy()
            for (r, *_), v in zip(parts[1:], values[1:]):
                top[r] = np.maximum(top[r], v)  # a part has a row once
            row = np.concatenate([x[0] for x in parts])
            mass = np.exp(np.concatenate(values) - top[row])
            total = np.bincount(row, weights=mass, minlength=rows)
            log_sum[e] = top + np.log(total)
            start = np.concatenate([base + x[1] * rows + x[0] for x in parts])
            order = np.argsort(row.astype(kind), kind="stable")
            share = np.rint(mass / total[row] * 2.0**32).astype(np.int64)
            out.append((
                np.bincount(row, minlength=rows).astype(np.int32), start[order].astype(np.int32),
                np.concatenate([x[2] for x in parts])[order].astype(np.int32), share[order],
            ))
        return out

    def sampled(self, chunk: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, row limits): one path per entry of ``chunk``, drawn from its end."""
        node = self.base[chunk] + self.sizes[chunk] * self.stride[chunk]
        root = self.base[chunk]
        live = np.arange(len(chunk))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        count = np.zeros(len(chunk), np.int64)
        step = 0
        while len(live):
            step += 1
            salt = np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            draw = (mix(seed[live] + salt) >> np.uint64(32)).astype(np.int64)
            at, last = self.first[node[live]].copy(), self.first[node[live] + 1] - 1
            left = np.flatnonzero((at < last) & (self.upto[at] <= draw))
            while len(left):
                at[left] += 1
                left = left[(at[left] < last[left]) & (self.upto[at[left]] <= draw[left])]
            steps.append((live, self.piece[at]))
            count[live] += 1
            node[live] = self.start[at]
            live = live[node[live] > root[live]]
        limits = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(limits[-1], np.int64)
        for k, (rows, piece) in enumerate(steps):
            out[limits[rows + 1] - 1 - k] = piece
        return out, limits


class LongChunk:
    """One chunk of any length: forward sums by window, the ends of all windows kept, one window's edges at a time."""

    def __init__(self, vocab: Pieces, chunk: bytes):
        self.vocab = vocab
        self.data = np.frombuffer(chunk, np.uint8)
        self.n = len(chunk)
        self.reach = max([1, *vocab.sizes])
        self.rings = [[0.0] * self.reach + [1.0]]  # sums of the nodes up to a window's start
        for a in range(0, self.n, WINDOW):
            self.rings.append(self._filtered(a, min(self.n, a + WINDOW))[-1])

    def _edges(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(end, size, piece, weight) of the edges that end at the nodes a + 1 .. b, sorted by end and size."""
        vocab, from_ = self.vocab, max(0, a - self.reach + 1)
        part = self.data[from_:b]
        place = np.arange(a, b)
        found = [(place + 1, np.ones(b - a, np.int64), vocab.single[self.data[a:b]], vocab.single_weight[self.data[a:b]])]
        wide = part.astype(np.uint64)
        key = wide.copy()
        if len(part) > 3:
            long = part.astype(np.int32)
            reach = vocab.reach[long[:-2] << 16 | long[1:-1] << 8 | long[2:]]
        for size in range(2, min(len(part), self.reach) + 1):
            key = key[:-1] * np.uint64(257) + wide[size - 1 :]
            if size not in vocab.keys:
                continue
            at = np.flatnonzero(reach[: len(key)] >= size) if size > 3 else np.arange(len(key))
            at = at[at + from_ + size > a]
            table = vocab.keys[size]
            which = np.minimum(np.searchsorted(table, key[at]), len(table) - 1)
            hit = table[which] == key[at]
            at, which = at[hit], which[hit]
            if size > 7:
                good = [vocab.text[vocab.ids[size][w]] == part[q : q + size].tobytes() for q, w in zip(at, which)]
                at, which = at[good], which[good]
            found.append((at + from_ + size, np.full(len(at), size), vocab.ids[size][which], vocab.weights[size][which]))
        end, size, piece, weight = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((size, end))
        return end[order], size[order], piece[order], weight[order]

    def _filtered(self, a: int, b: int):
        """Edges into the nodes a + 1 .. b as (first edge by node, size, piece, cumulative share), and the sums to hand on."""
        end, size, piece, weight = self._edges(a, b)
        first = np.searchsorted(end, np.arange(a + 1, b + 2))
        sums = list(self.rings[a // WINDOW])
        base = self.reach - a  # place of a node's sum in the list
        value = np.empty(len(end))
        total = np.empty(b - a)
        limits, starts, weights = first.tolist(), (end - size + base).tolist(), weight.tolist()
        for e in range(b - a):
            s = 0.0
            for j in range(limits[e], limits[e + 1]):
                v = weights[j] * sums[starts[j]]
                value[j] = v
                s += v
            sums.append(s)
            total[e] = s
            if s < 1e-200:  # only the last sums matter from here on, and only their ratios
                for k in range(len(sums) - self.reach - 1, len(sums)):
                    sums[k] *= 1e200
        share = np.rint(value / total[end - a - 1] * 2.0**32).astype(np.int64)
        upto = np.cumsum(share)
        before = np.concatenate([[0], upto])[first[:-1]]
        return first, size, piece, upto - before[end - a - 1], sums[-self.reach - 1 :]

    def sampled(self, seed: np.uint64) -> np.ndarray:
        """One path, drawn from the end."""
        out: list[int] = []
        node, step, draws = self.n, 0, []
        for a in range((self.n - 1) // WINDOW * WINDOW, -1, -WINDOW):
            first, size, piece, upto, _ = self._filtered(a, min(self.n, a + WINDOW))
            first, size, piece, upto = first.tolist(), size.tolist(), piece.tolist(), upto.tolist()
            while node > a:
                if step == len(draws):
                    steps = np.arange(step + 1, step + 1 + WINDOW, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    draws += (mix(np.uint64(seed) + steps) >> np.uint64(32)).tolist()
                draw = draws[step]
                step += 1
                at, last = first[node - a - 1], first[node - a] - 1
                while at < last and upto[at] <= draw:
                    at += 1
                out.append(piece[at])
                node -= size[at]
        return np.array(out[::-1], np.int64)


def encode(vocab: Pieces, texts: list[bytes], keys: np.ndarray, seed: int = SEED) -> list[np.ndarray]:
    """Sampled piece ids of each text, seeded by its key."""
    chunks: list[bytes] = []
    counts = []
    for text in texts:
        cut = _CHUNK.findall(text)
        chunks += cut
        counts.append(len(cut))
    if not chunks:
        return [np.empty(0, np.int64) for _ in texts]
    lengths = np.array([len(c) for c in chunks])
    counts = np.array(counts)
    begin = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(chunks)) - np.repeat(begin[:-1], counts)
    seeds = mix(np.repeat(mix(keys.view(np.uint64) + np.uint64(seed)), counts) + place.astype(np.uint64))
    short = np.flatnonzero(lengths <= WIDE)
    sizes = np.zeros(len(chunks), np.int64)
    ids = np.empty(0, np.int64)
    if len(short):
        names = np.empty(len(short), object)
        names[:] = [chunks[k] for k in short]
        code, distinct = pd.factorize(names)
        by_code = np.argsort(code, kind="stable")
        ids, limits = Lattice(vocab, list(distinct)).sampled(code[by_code], seeds[short[by_code]])
        short = short[by_code]
        sizes[short] = np.diff(limits)
    drawn = {k: LongChunk(vocab, chunks[k]).sampled(seeds[k]) for k in np.flatnonzero(lengths > WIDE).tolist()}
    for k, path in drawn.items():
        sizes[k] = len(path)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.empty(ends[-1], np.int64)
    own = sizes[short]
    out[np.repeat(starts[short] - (np.cumsum(own) - own), own) + np.arange(len(ids))] = ids
    for k, path in drawn.items():
        out[starts[k] : ends[k]] = path
    text_ends = np.concatenate([[0], ends])[begin]
    return [out[a:b] for a, b in zip(text_ends[:-1], text_ends[1:])]


def decode(vocab: Pieces, ids: np.ndarray) -> bytes:
    """The text's bytes."""
    return b"".join([vocab.text[i] for i in ids.tolist()])


def sample_pieces(
    docs: DataFrame,
    model: str = MODEL,
    alpha: float = ALPHA,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: doc_id, pieces (ids), decoded (bytes joined back from the ids).

    Defined results: null and empty texts have no pieces; a text without a
    space is one chunk, however long; equal texts of one id get equal pieces, a null id counts as 0; an empty table gives an empty
    result. The model file has to be readable at the path on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model, alpha)
        for batch in batches:
            keys = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, starts in slices(batch.column("text"), SLICE):
                texts = [data[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                pieces = encode(vocab, texts, keys[lo:hi], seed)
                decoded = [decode(vocab, p) for p in pieces]
                limits = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int32)
                flat = np.concatenate(pieces).astype(np.int32) if pieces else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.ListArray.from_arrays(pa.array(limits), pa.array(flat)),
                        pa.array(decoded, pa.binary()),
                    ],
                    ["doc_id", "pieces", "decoded"],
                )

    text_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return slim.mapInArrow(lean(run), "doc_id long, pieces array<int>, decoded binary")


def op3_pieces(docs: DataFrame) -> DataFrame:
    """doc_id, n_pieces, pieces_hash and the digest of the text decoded from the pieces."""
    out = sample_pieces(docs)
    return out.select(
        "doc_id",
        F.size("pieces").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
