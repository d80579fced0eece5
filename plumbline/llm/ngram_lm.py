"""Language-model scores by a weighted backoff automaton.

Words (A to Z lower-cased) and a closing ``end`` are the tokens. Every n-gram of the training
documents is counted, over all of them. The counts become an automaton: a context seen in
training is a state; an n-gram seen is an arc out of its context, weighted with the smoothed
probability ``(count + mu * p(shorter)) / (count of the context + mu)``; every state has a
failure arc to the state of its context less the first word, weighted ``mu / (count + mu)``.
At the root, words have ``(count - d) / N`` and the mass ``d * V / N`` taken from them (d by
the Good-Turing counts) is the probability of the one unknown word, so the probabilities of
the V + 1 words add up to 1 in every state. A text is scored in one traversal from left to
right that carries the state and adds up log10 probabilities.

The automaton grows with the corpus and is never in one place. Documents are packed in chunks
(words numbered per chunk); each chunk asks, per hash part, for the counts of its distinct
n-grams and tells its own training counts; a part adds them up and answers every chunk. So a
chunk gets exactly the states and arcs its texts can reach. All shuffles carry one packed row
per chunk and part, with a distinct n-gram once per chunk, however frequent it is.

N-grams are told apart by 64-bit hashes. A null text counts as empty and is one ``end``. A null
doc_id is held out (crc32 of an empty text is 0). Rows that repeat are counted and scored one
by one. Without training documents every token has probability 1 (V = 0). Further columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import shared_folder

from .common import bytes_of, id_remainder, mix64, words_of

ORDER = 2
MU = 100.0
CHUNK_BYTES = 8 << 20
TOKENS_PER_PART = 1 << 20
END, BEGIN = np.uint64(1), np.uint64(2)  # hashes of the marks; words have others
STEP = np.uint64(0x9E3779B97F4A7C15)
CHUNK_SCHEMA = "chunk bigint, held binary, sizes binary, tokens binary, words binary, train_docs bigint, train_tokens bigint, all_tokens bigint"


def _write(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Packed documents; doc_ids stay an array of their own type."""
    schema = docs.select(F.array("doc_id").alias("doc_ids"), *[F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in CHUNK_SCHEMA.split(", "))]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        index: dict[bytes, int] = {}
        tokens: list[np.ndarray] = []
        held: list[bool] = []
        size = 0

        def packed() -> pa.RecordBatch:
            sizes = np.array([len(t) for t in tokens], np.int64)
            apart = np.array(held, np.uint8)
            words = np.fromiter((xxhash.xxh64_intdigest(w) for w in index), np.uint64, len(index))
            row = {
                "doc_ids": [ids], "chunk": [place + number], "held": [apart.tobytes()], "sizes": [sizes.tobytes()], "tokens": [np.concatenate(tokens).tobytes()],
                "words": [np.concatenate([[END], words]).astype(np.uint64).tobytes()], "train_docs": [int((apart == 0).sum())],
                "train_tokens": [int(sizes[apart == 0].sum())], "all_tokens": [int(sizes.sum())]}
            return pa.RecordBatch.from_pydict(row, arrow)

        for batch in batches:
            arrow = pa.schema([pa.field("doc_ids", pa.list_(batch.schema.field("doc_id").type))] + [
                pa.field(n, pa.binary() if t == "binary" else pa.int64()) for n, t in (c.split() for c in CHUNK_SCHEMA.split(", "))])
            for doc_id, apart, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), bytes_of(batch.column("text"))):
                words = words_of(text)
                found = [index.setdefault(w, len(index) + 1) for w in words]
                tokens.append(np.array([*found, 0], np.int32))
                ids.append(doc_id)
                held.append(apart)
                size += len(text) + 64
                if size >= chunk_bytes:
                    yield packed()
                    number, size, ids, index, tokens, held = number + 1, 0, [], {}, [], []
        if ids:
            yield packed()

    return docs.select("doc_id", "text", id_remainder(F.col("doc_id"), 10).eqNullSafe(0).alias("held_out")).mapInArrow(run, schema)


class Grams:
    """The n-grams of a chunk: per order, distinct keys and for every position the number of its key.

    Positions are those of the tokens with a ``begin`` before each document. An n-gram that
    would reach over the beginning does not exist (number -1).
    """

    def __init__(self, sizes: np.ndarray, tokens: np.ndarray, words: np.ndarray, order: int):
        self.starts = np.cumsum(sizes + 1) - sizes - 1  # the begin of each document
        n = len(tokens) + len(sizes)
        is_begin = np.zeros(n, bool)
        is_begin[self.starts] = True
        hashed = np.empty(n, np.uint64)
        hashed[is_begin], hashed[~is_begin] = BEGIN, words[tokens]
        since = np.arange(n, dtype=np.int32) - np.repeat(self.starts.astype(np.int32), sizes + 1)
        self.keys, self.at, self.first = [], [], []
        for k in range(1, order + 1):
            hashed = mix64(hashed) if k == 1 else mix64(np.concatenate([[np.uint64(0)], hashed[:-1]]) * STEP + plain)
            if k == 1:
                plain = hashed
            there = np.flatnonzero(since >= k - 1).astype(np.int32)
            keys, first, at = np.unique(hashed[there], return_index=True, return_inverse=True)
            numbers = np.full(n, -1, np.int32)
            numbers[there] = at
            self.keys.append(keys)
            self.first.append(there[first])
            self.at.append(numbers)
            del first, at, there


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["held"], np.uint8) > 0, np.frombuffer(row["sizes"], np.int64),
            np.frombuffer(row["tokens"], np.int32), np.frombuffer(row["words"], np.uint64))


def _parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Borders of equal slices of the key space in sorted keys."""
    borders = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])


def _asked(chunks: DataFrame, order: int, parts: int) -> DataFrame:
    """Per chunk, order and part: the distinct n-grams and how often training documents have them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                held, sizes, tokens, words = _unpack(row)
                grams = Grams(sizes, tokens, words, order)
                training = np.repeat(~held, sizes + 1)
                for k, (keys, at) in enumerate(zip(grams.keys, grams.at), 1):
                    counts = np.bincount(at[training & (at >= 0)], minlength=len(keys)).astype(np.uint32)
                    cut = _parts_of(keys, parts)
                    out = {"part": range(parts), "gram": [k] * parts, "chunk": [row["chunk"]] * parts,
                           "keys": [keys[a:b].tobytes() for a, b in zip(cut, cut[1:])], "counts": [counts[a:b].tobytes() for a, b in zip(cut, cut[1:])]}
                    yield pa.RecordBatch.from_pydict(out, pa.schema([("part", pa.int32()), ("gram", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))

    asked = chunks.select("chunk", "held", "sizes", "tokens", "words").mapInArrow(run, "part int, gram int, chunk bigint, keys binary, counts binary")
    return asked.filter("length(keys) > 0")


def _answered(asked: DataFrame) -> DataFrame:
    """Per chunk, order and part: the counts over all training documents; and a row of totals per part."""
    begin = mix64(np.array([BEGIN]))[0]

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        out = {n: [] for n in ("chunk", "gram", "part", "bits", "totals", "kinds", "ones", "twos")}
        for gram in sorted(set(table.column("gram").to_pylist())):
            rows = table.filter(pc.equal(table.column("gram"), gram))
            keys = [np.frombuffer(k, np.uint64) for k in rows.column("keys").to_pylist()]
            counts = np.concatenate([np.frombuffer(c, np.uint32) for c in rows.column("counts").to_pylist()])
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            totals = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
            there = totals[distinct != begin]
            ends = np.cumsum([len(k) for k in keys])
            bits = 32 if totals.max(initial=0) < 1 << 31 else 64
            packed = totals.astype(f"i{bits // 8}")
            for chunk, a, b in zip(rows.column("chunk").to_pylist(), [0, *ends], ends):
                values = (chunk, gram, part, bits, packed[at[a:b]].tobytes(), 0, 0, 0)
                for n, v in zip(out, values):
                    out[n].append(v)
            values = (-1, gram, part, bits, b"", int((there > 0).sum()), int((there == 1).sum()), int((there == 2).sum()))
            for n, v in zip(out, values):
                out[n].append(v)
        return pa.table(out, pa.schema([("chunk", pa.int64()), ("gram", pa.int32()), ("part", pa.int32()), ("bits", pa.int32()), ("totals", pa.binary()), ("kinds", pa.int64()), ("ones", pa.int64()), ("twos", pa.int64())]))

    return asked.groupBy("part").applyInArrow(run, "chunk bigint, gram int, part int, bits int, totals binary, kinds bigint, ones bigint, twos bigint")


class Automaton:
    """States, arcs and failure arcs that a chunk's texts can reach.

    An arc or state is numbered by its n-gram in the chunk; those without training count do
    not exist.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], total: int, kinds: int, ones: int, twos: int, mu: float):
        self.grams, self.counts = grams, counts
        less = ones / (ones + 2 * twos) if ones and twos else 0.5
        if total:
            p = np.where(counts[0] > 0, (counts[0] - less) / total, less * kinds / total)
        else:
            p = np.ones(len(counts[0]))
        self.arc, self.fail = [np.log10(p)], []
        for k in range(1, len(counts)):
            # a context's first and last words, as n-grams of one order less
            at = grams.first[k]
            before, shorter = grams.at[k - 1][at - 1], grams.at[k - 1][at]
            p = (counts[k] + mu * p[shorter]) / (counts[k - 1][before] + mu)
            self.arc.append(np.log10(p))
            self.fail.append(np.log10(mu / (counts[k - 1] + mu)))
            del before, shorter

    def scores(self, sizes: np.ndarray) -> np.ndarray:
        """log10 probability of each document: one traversal, all documents abreast."""
        grams, top = self.grams, len(self.arc) - 1
        order = np.argsort(-sizes, kind="stable")
        starts, falling = grams.starts[order], -sizes[order]
        depth = np.full(len(sizes), 1 if top else 0)  # length of the state's context: begin
        if top:
            depth[self.counts[0][grams.at[0][starts]] == 0] = 0
        total = np.zeros(len(sizes))
        for step in range(1, int(sizes.max()) + 1 if len(sizes) else 1):
            n = int(np.searchsorted(falling, -step, side="right"))
            at, now, add = starts[:n] + step, depth[:n], np.zeros(n)
            went = np.full(n, -1)
            for k in range(top, 0, -1):
                rows = np.flatnonzero((now == k) & (went < 0))
                gram = grams.at[k][at[rows]]
                has = self.counts[k][gram] > 0
                add[rows] += np.where(has, self.arc[k][gram], self.fail[k - 1][grams.at[k - 1][at[rows] - 1]])
                went[rows[has]] = min(k + 1, top)
                now[rows[~has]] = k - 1  # the failure arc
            rows = np.flatnonzero(went < 0)
            word = grams.at[0][at[rows]]
            add[rows] += self.arc[0][word]
            went[rows] = np.where(self.counts[0][word] > 0, min(1, top), 0)
            depth[:n] = went
            total[:n] += add
        out = np.empty_like(total)
        out[order] = total
        return out


def score(docs: DataFrame, order: int = ORDER, mu: float = MU, chunk_bytes: int = CHUNK_BYTES, tokens_per_part: int = TOKENS_PER_PART) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    chunks = _write(_chunks(docs, chunk_bytes), "chunks")
    known = chunks.agg(F.sum("all_tokens"), F.sum("train_tokens"), F.sum("train_docs")).first()
    tokens, total = known[0] or 0, known[1] or 0
    answers = _write(_answered(_asked(chunks, order, max(1, math.ceil(tokens / tokens_per_part)))), "answers")
    kinds, ones, twos = (v or 0 for v in answers.filter("chunk < 0 and gram = 1").agg(F.sum("kinds"), F.sum("ones"), F.sum("twos")).first())
    own = answers.filter("chunk >= 0").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("gram", "part", "bits", "totals"))).alias("totals"))
    columns = ["doc_ids", "held", "sizes", "tokens", "words", "totals"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = math.log10(total + 0.1 * (kinds + 1))
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                held, sizes, tokens, words = _unpack(row)
                grams = Grams(sizes, tokens, words, order)
                counts = [np.concatenate([np.frombuffer(t["totals"], f"i{t['bits'] // 8}") for t in row["totals"] if t["gram"] == k]) for k in range(1, order + 1)]
                scores = Automaton(grams, counts, total, kinds, ones, twos, mu).scores(sizes)
                count = counts[0][grams.at[0]].astype(np.float64)
                base = np.log10(count + 0.1) - floor
                base[grams.starts], count[grams.starts] = 0, 0  # begin is no token
                doc_type = batch.schema.field("doc_ids").type.value_type
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], doc_type), pa.array(held), pa.array(sizes), pa.array(np.add.reduceat((count > 0).astype(np.int64), grams.starts)),
                     pa.array(np.full(len(sizes), total)), pa.array(np.add.reduceat(base, grams.starts)), pa.array(scores)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = docs.select("doc_id", *[F.lit(None).cast(t).alias(n) for n, t in (
        ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double"))]).schema
    return chunks.join(own, "chunk").select(*columns).mapInArrow(run, schema)
