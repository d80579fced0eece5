"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every piece of a word (a run of letters, of digits, or of other marks; capitals are told apart)
falls in one of ``BUCKETS`` buckets by hash. A bucket has a sparse random index vector; its
word vector is the sum of the index vectors found within ``WINDOW`` pieces of it, counted over
all documents, plus its own, scaled to length 1. A document is the mean of its pieces' vectors,
the mean of their squares, and the shares of pieces whose vector comes again one to ``AGAIN``
pieces on; so its size does not matter. A two-layer numpy network turns
that into a probability, and one temperature, fitted on labelled rows kept apart, calibrates it.

The word vectors are a table of fixed size whatever the corpus (BUCKETS x DIM numbers, 4 MB),
which is why it may be sent to every task. Contexts are added up inside each task first, and
then, block by block, in two shuffles of one row per task and block. The network is fitted on at
most about ``MOST_LABELLED`` labelled rows, taken by hash.

A null or empty text has the zero vector and gets the score the network gives that. A null
doc_id is held out. Labels that are null, repeat or contradict are each a row of their own. With
labels of one kind only, or none, the score is the share of label 1 (0.5 without any). Columns
other than text and doc_id are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, id_remainder, mix64, settle

BUCKETS = 1 << 14
DIM = 64
NONZERO = 4
WINDOW = 2
AGAIN = 6
POOLED = 2 * DIM + AGAIN
BLOCK = 256
MERGERS = 16  # tasks that first add up each block
MOST_LABELLED = 20_000
HIDDEN = 32
THRESHOLD = 0.3
WORDS_HELD = 500_000
TEXT_AT_ONCE = 2 << 20
PIECES = re.compile(rb"[A-Z]+(?![a-z\x80-\xff])|[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff]+")


class Pieces:
    """Bucket numbers of the pieces of words; words seen lately are remembered."""

    def __init__(self):
        self.held: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        held, words = self.held, text.split()
        new = set(words).difference(held)
        if len(held) + len(new) > WORDS_HELD:
            held.clear()
            new = set(words)
            if len(new) > WORDS_HELD:
                return np.array([b for w in words for b in buckets(w)], np.int32)
        for w in new:
            held[w] = buckets(w)
        return np.fromiter(chain.from_iterable(map(held.__getitem__, words)), np.int32)


def buckets(word: bytes) -> tuple[int, ...]:
    return tuple(xxhash.xxh32_intdigest(p) % BUCKETS for p in PIECES.findall(word))


def index_places() -> tuple[np.ndarray, np.ndarray]:
    """Per bucket NONZERO places of 1 or -1, drawn by hash; places may repeat."""
    draws = mix64(np.arange(BUCKETS * NONZERO, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)).reshape(BUCKETS, NONZERO)
    return (draws % np.uint64(DIM)).astype(np.int64), np.where(draws >> np.uint64(40) & np.uint64(1), 1.0, -1.0)


def index_vectors() -> np.ndarray:
    """The index vectors as a table, BUCKETS rows."""
    out = np.zeros((BUCKETS, DIM), np.int32)
    places, signs = index_places()
    np.add.at(out, (np.arange(BUCKETS)[:, None], places), signs.astype(np.int32))
    return out


def contexts(docs: DataFrame) -> DataFrame:
    """block, sums: for BLOCK buckets the sums of the index vectors around their pieces."""
    index = index_places()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, pieces, any_rows = np.zeros((BUCKETS, DIM)), Pieces(), False
        for batch in batches:
            for part in _parts(bytes_of(batch.column("text"))):
                any_rows = True
                ids = [pieces(t) for t in part]
                gap = np.full(WINDOW, -1, np.int32)
                line = np.concatenate([gap, *chain.from_iterable((i, gap) for i in ids)])
                for shift in range(1, WINDOW + 1):
                    a, b = line[:-shift], line[shift:]
                    both = (a >= 0) & (b >= 0)
                    # pairs in one place once, with their number: far fewer than positions
                    pairs, n = np.unique(a[both].astype(np.int64) * BUCKETS + b[both], return_counts=True)
                    _add(sums, pairs // BUCKETS, pairs % BUCKETS, n, index)
        if any_rows:
            merger = TaskContext.get().partitionId() % MERGERS
            blocks = sums.astype(np.int64).reshape(-1, BLOCK, DIM)
            full = [i for i, b in enumerate(blocks) if b.any()]
            yield pa.RecordBatch.from_pydict({"block": full, "merger": [merger] * len(full), "sums": [blocks[i].tobytes() for i in full]},
                                             pa.schema([("block", pa.int32()), ("merger", pa.int32()), ("sums", pa.binary())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for block, merger, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "merger", "sums"))):
                part = np.frombuffer(raw, np.int64)
                held[block, merger] = held[block, merger] + part if (block, merger) in held else part
        rows = [(b, m, s.tobytes()) for (b, m), s in held.items()]
        yield pa.RecordBatch.from_pydict({"block": [r[0] for r in rows], "merger": [0 for _ in rows], "sums": [r[2] for r in rows]},
                                         pa.schema([("block", pa.int32()), ("merger", pa.int32()), ("sums", pa.binary())]))

    schema = "block int, merger int, sums binary"
    counted = docs.select("text").mapInArrow(count, schema)
    return counted.repartition("block", "merger").mapInArrow(add, schema).repartition("block").mapInArrow(add, schema)


def _add(sums: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> None:
    """Index vectors of b around a and of a around b, n times each; only their few places are touched."""
    places, signs = index
    for here, there in ((a, b), (b, a)):
        at = here[:, None] * DIM + places[there]
        sums += np.bincount(at.ravel(), (signs[there] * n[:, None]).ravel(), minlength=sums.size).reshape(sums.shape)


def _parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    piece = np.cumsum([len(t) for t in texts]) // TEXT_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield texts[a:b]


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of word vectors, BUCKETS rows of length 1 (float32)."""
    sums = np.zeros((BUCKETS // BLOCK, BLOCK, DIM))
    table = settle(contexts(docs), "contexts").toArrow()
    for block, raw in zip(table.column("block").to_pylist(), table.column("sums").to_pylist()):
        sums[block] += np.frombuffer(raw, np.int64).reshape(BLOCK, DIM)
    sums = sums.reshape(BUCKETS, DIM)
    total = sums.sum(axis=0) / max(1.0, np.abs(sums).sum())
    sums = sums - np.abs(sums).sum(axis=1, keepdims=True) * total  # what all words have around them tells nothing
    sums = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    sums = sums + index_vectors() / np.sqrt(NONZERO)
    return (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(texts: list[bytes], vectors: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Mean, mean square and recurrence of the pieces' vectors, per text."""
    out = np.zeros((len(texts), POOLED), np.float32)
    for i, text in enumerate(texts):
        ids = pieces(text)
        if len(ids):
            kinds, n = np.unique(ids, return_counts=True)
            rows, share = vectors[kinds], (n / len(ids)).astype(np.float32)
            out[i, :DIM], out[i, DIM:2 * DIM] = share @ rows, share @ (rows * rows)
            out[i, 2 * DIM:] = [np.count_nonzero(ids[k:] == ids[:-k]) / len(ids) for k in range(1, AGAIN + 1)]
    return out


class Network:
    """Two layers, tanh between them, and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, apart: np.ndarray, hidden: int = HIDDEN, rounds: int = 60, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.fixed = None
        self.temperature = 1.0
        learn = ~apart
        if len(np.unique(y[learn])) < 2:
            self.fixed = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-3
        self.a = rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden))
        self.b, self.c, self.d = np.zeros(hidden), rng.normal(0, hidden ** -0.5, hidden), np.zeros(1)
        xs, ys = (x[learn] - self.mean) / self.scale, y[learn].astype(float)
        state = [(np.zeros_like(w), np.zeros_like(w)) for w in (self.a, self.b, self.c, self.d)]
        step = 0
        for _ in range(rounds):
            for rows in np.array_split(rng.permutation(len(xs)), max(1, len(xs) // 128)):
                step += 1
                h = np.tanh(xs[rows] @ self.a + self.b)
                error = (1 / (1 + np.exp(-(h @ self.c + self.d))) - ys[rows]) / len(rows)
                back = np.outer(error, self.c) * (1 - h * h)
                slopes = (xs[rows].T @ back + 1e-3 * self.a, back.sum(axis=0), h.T @ error + 1e-3 * self.c, error.sum(keepdims=True))
                for w, g, (m, v) in zip((self.a, self.b, self.c, self.d), slopes, state):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= 0.003 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        if apart.any():
            logits, truth = self._logits(x[apart]), y[apart]
            trials = np.geomspace(0.25, 8, 60)
            loss = [np.mean(np.logaddexp(0, np.where(truth > 0, -logits, logits) / t)) for t in trials]
            self.temperature = float(trials[int(np.argmin(loss))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.a + self.b) @ self.c + self.d[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(x), self.fixed)
        return 1 / (1 + np.exp(-np.clip(self._logits(x) / self.temperature, -60, 60)))


def pooled(docs: DataFrame, vectors) -> DataFrame:
    """``docs`` without its text, with the document vector ``pooled_`` (float32 bytes)."""
    names = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces()
        for batch in batches:
            x = pool(bytes_of(batch.column("text")), vectors.value, pieces)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array([v.tobytes() for v in x], pa.binary())], [*names, "pooled_"])

    return docs.mapInArrow(run, docs.select(*names, F.lit(b"").alias("pooled_")).schema)


def classify(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. ``labels`` has doc_id and quality."""
    spark = docs.sparkSession
    held_out = id_remainder(F.col("doc_id"), 5).eqNullSafe(0)
    texts = docs.select("doc_id", "text")
    vectors = spark.sparkContext.broadcast(word_vectors(texts))
    marked = labels.filter(~held_out & F.col("quality").isNotNull()).select("doc_id", "quality")
    key = F.pmod(F.xxhash64(F.lit(5), F.col("doc_id")), F.lit(1 << 30))
    count = marked.count()
    marked = marked.filter(key <= int(min(1.0, most_labelled / max(1, count)) * (1 << 30))).withColumn("apart", F.pmod(key, F.lit(5)) == 0)
    # at most about most_labelled rows: bounded, and far smaller than the texts
    rows = pooled(texts.join(F.broadcast(marked), "doc_id"), vectors).toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("quality", "ascending"), ("pooled_", "ascending")])  # reruns agree
    x = np.array([np.frombuffer(b, np.float32) for b in rows.column("pooled_").to_pylist()], np.float64).reshape(rows.num_rows, POOLED)
    y, apart = np.array(rows.column("quality").to_pylist(), float), np.array(rows.column("apart").to_pylist(), bool)
    network = spark.sparkContext.broadcast(Network(x, y, apart))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces()
        for batch in batches:
            x = pool(bytes_of(batch.column("text")), vectors.value, pieces).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(network.value.probability(x))], ["doc_id", "score"])

    scored = texts.mapInArrow(run, texts.select("doc_id", F.lit(0.0).alias("score")).schema)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
