"""Alignment of two tokenizers over a corpus, with pair counts by external spill counting.

A text is encoded by two vocabularies whose tokens cover the same bytes. Offsets where tokens of
both end cut it into groups; an A and a B token whose byte ranges overlap are a link, one per
stretch between neighbouring ends. A pair of ids counts as many links as hold it in the corpus,
and a link is best if no pair of its B id counts more.

A task gathers (pair, document) records with their number of links. Whenever ``SPILL`` records
are held, they are sorted side-major (by B id, then A id, then document), parted by the low bits
of the B id and spilled as zstd runs, one row a part; the documents of a spill are numbered
inside it. A part then holds all records of its B ids: a heap merges its runs pair by pair, so a
pair is counted when the next begins, and the best count of a B id is known when the next begins;
with it the part goes through its runs again and streams back, per spill, what every document
gains (best links, sum of counts). The sums meet per spill.

Parts grow in number with the corpus up to ``MOST_PARTS``. A part of more than ``HEAVY`` records
(large corpora, or one frequent B id) is split by spills: its groups count for themselves, the
counts of pairs are added by Spark, and every group streams back with the sums. So a task never
holds more than about ``HEAVY`` records and the counted pairs of one part.

Texts that are null or empty, or whose joined tokens of either side are not the text, have no
tokens and zeros. Rows that repeat, null ids included, are counted one by one; further columns
are not read; very long texts are encoded whole. An empty table gives an empty result. A and B
vocabularies have at most 2^20 tokens, a spill at most 2^24 documents.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, settle, slices
from .merges import byte_letters

SPILL = 4 << 20
HEAVY = 8 << 20
MOST_PARTS = 4096
RECORDS_A_BYTE = 0.4
TEXT_AT_ONCE = 1 << 20
ID_BITS, DOC_BITS = 20, 24
SPACE_MARK = "▁"


class Side:
    """One tokenizer: ids of texts and the bytes of every token."""

    def __init__(self, encode, tokens: list[bytes]):
        self.encode, self.tokens = encode, tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)


@lru_cache(maxsize=2)
def byte_level(path: str, pattern: str) -> Side:
    """A byte-level vocabulary file; a space is put before the text. Special strings are plain text."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters, vocabulary = byte_letters(), spec["model"]["vocab"]
    special = {t["content"] for t in spec["added_tokens"]}
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError("ids are not in the order of the merges")
    ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    library = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return Side(lambda texts: [library.encode_ordinary(" " + t) for t in texts], tokens)


@lru_cache(maxsize=2)
def pieces(path: str) -> Side:
    """A piece vocabulary that puts a space before the text itself."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    tokens = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace(SPACE_MARK, " ").encode() for n in names]
    return Side(lambda texts: library.encode(texts, num_threads=1), tokens)


class Aligned:
    """The tokens of some texts laid end to end: counts per text, group digests and links."""

    def __init__(self, texts: list[bytes], a: Side, b: Side, names: tuple[list, list]):
        words = [t.decode() for t in texts]
        ids_a, ids_b = a.encode(words), b.encode(words)
        for k, text in enumerate(texts):
            whole = b" " + text
            if not text or b"".join([a.tokens[i] for i in ids_a[k]]) != whole or b"".join([b.tokens[i] for i in ids_b[k]]) != whole:
                ids_a[k], ids_b[k] = [], []
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.fromiter((i for x in ids for i in x), np.int64, n.sum()) for ids, n in ((ids_a, self.n_a), (ids_b, self.n_b)))
        del ids_a, ids_b
        ends_a, ends_b = np.cumsum(a.sizes[flat_a]), np.cumsum(b.sizes[flat_b])
        size = int(ends_a[-1]) + 1 if len(ends_a) else 1
        in_a, in_b = np.zeros(size, np.int32), np.zeros(size, np.int32)
        in_a[ends_a], in_b[ends_b] = 1, 1
        # last byte of every text: those without tokens end where the one before does
        ends = np.concatenate([[0], ends_a])[np.cumsum(self.n_a)]
        until_a, until_b = np.cumsum(in_a, dtype=np.int32), np.cumsum(in_b, dtype=np.int32)
        both, either = in_a & in_b, in_a | in_b
        groups, until = np.cumsum(both, dtype=np.int32), np.cumsum(either, dtype=np.int32)
        self.n_groups, self.n_links = np.diff(groups[ends], prepend=0), np.diff(until[ends], prepend=0)
        at = np.flatnonzero(either)
        self.link_a, self.link_b = flat_a[until_a[at] - in_a[at]], flat_b[until_b[at] - in_b[at]]
        self.owner = np.repeat(np.arange(len(texts)), self.n_links)
        self.digests = self._digests(flat_a, flat_b, ends_a, ends_b, until_a, until_b, groups, both, names)

    def _digests(self, flat_a, flat_b, ends_a, ends_b, until_a, until_b, groups, both, names) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``: ids of a group's A tokens, then of its B tokens."""
        cut = np.concatenate([[0], np.flatnonzero(both)])  # group g lies after cut[g]
        group_a, group_b = groups[ends_a] - both[ends_a], groups[ends_b] - both[ends_b]
        order = np.empty(len(flat_a) + len(flat_b), np.int64)
        order[np.arange(len(flat_a)) + until_b[cut[group_a]]] = flat_a * 2 + both[ends_a]
        order[np.arange(len(flat_b)) + until_a[cut[group_b + 1]]] = len(names[0]) + flat_b * 2 + both[ends_b]
        table, stops = names[1], np.cumsum(self.n_a + self.n_b)
        parts = [table[i] for i in order.tolist()]
        return [hashlib.sha256(b"".join(parts[i:j])[:-1]).hexdigest() if j > i else "" for i, j in zip([0, *stops.tolist()], stops.tolist())]


def id_names(a: Side, b: Side) -> tuple[list, list]:
    """Every id as decimal text with what follows it: a comma, or the mark that ends its side of the group."""
    first = [str(i).encode() + mark for i in range(len(a.tokens)) for mark in (b",", b"|")]
    return first, first + [str(i).encode() + mark for i in range(len(b.tokens)) for mark in (b",", b";")]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 on, each in the narrowest type that holds it, zstd compressed."""
    narrow = [x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0)) for x in arrays]
    head = np.array([len(narrow), *(v for x in narrow for v in (len(x), x.itemsize))], np.int64)
    return zstandard.compress(head.tobytes() + b"".join(x.tobytes() for x in narrow), 3)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw, out = zstandard.decompress(blob), []
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * count, 8).reshape(-1, 2)
    at = 8 + 16 * count
    for n, width in head.tolist():
        out.append(np.frombuffer(raw, f"<u{width}", n, at).astype(np.int64))
        at += n * width
    return out


def spilled(records: list[np.ndarray], bits: int) -> Iterator[tuple[int, bytes, int]]:
    """Runs of a spill: part, zstd of (steps between pairs, documents of each, documents, links), records.

    A record is one number: the B id with its low ``bits`` moved to the front, the A id, the document.
    """
    found = np.sort(np.concatenate(records))
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    links, found = np.diff(np.append(first, len(found))), found[first]
    pair, doc = (found >> np.uint64(DOC_BITS)).view(np.int64), (found & np.uint64((1 << DOC_BITS) - 1)).astype(np.int64)
    edges = np.searchsorted(pair, np.arange(1 + (1 << bits), dtype=np.int64) << (2 * ID_BITS - bits))
    for part in np.flatnonzero(np.diff(edges)).tolist():
        i, j = int(edges[part]), int(edges[part + 1])
        own = pair[i:j]
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        yield part, pack(np.diff(own[starts], prepend=0), np.diff(np.append(starts, j - i)), doc[i:j], links[i:j]), j - i


def _moved(ids: np.ndarray, bits: int) -> np.ndarray:
    return (ids & (1 << bits) - 1) << (ID_BITS - bits) | ids >> bits


def encoded(docs: DataFrame, path_a: str, pattern: str, path_b: str, bits: int, spill: int = SPILL) -> DataFrame:
    """A row per document (doc_id, spill, doc: its number in the spill, counts) and a row per run (spill, part, run, records)."""
    id_schema = docs.select("doc_id").schema
    schema = id_schema.add("spill", "long").add("part", "integer").add("run", "binary").add("records", "long").add("doc", "integer")
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(path_a, pattern), pieces(path_b)
        names = id_names(a, b)
        number, held, waiting, records = TaskContext.get().partitionId() << 32, 0, 0, []
        arrow = None

        def rows(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        def runs() -> pa.RecordBatch:
            made = list(zip(*spilled(records, bits))) or [[], [], []]
            return rows(len(made[0]), spill=pa.array([number] * len(made[0]), pa.int64()), part=pa.array(made[0], pa.int64()),
                        run=pa.array(made[1], pa.binary()), records=pa.array(made[2], pa.int64()))

        for batch in slices(batches, "text", TEXT_AT_ONCE):
            if arrow is None:
                arrow = pa.schema([batch.schema.field("doc_id"), ("spill", pa.int64()), ("part", pa.int32()), ("run", pa.binary()), ("records", pa.int64()), ("doc", pa.int32()),
                                   *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string())])
            n = batch.num_rows
            if waiting + n > 1 << DOC_BITS or held > spill:
                yield runs()
                number, held, waiting, records = number + 1, 0, 0, []
            made = Aligned(bytes_of(batch.column("text")), a, b, names)
            found = (_moved(made.link_b, bits) << ID_BITS | made.link_a) << DOC_BITS | made.owner + waiting
            if len(found):
                records.append(found.view(np.uint64))
            yield rows(n, doc_id=batch.column("doc_id"), spill=pa.array([number] * n), doc=pa.array(np.arange(n) + waiting), n_a=pa.array(made.n_a), n_b=pa.array(made.n_b),
                       n_groups=pa.array(made.n_groups.astype(np.int64)), n_links=pa.array(made.n_links.astype(np.int64)), groups_sha256=pa.array(made.digests))
            held, waiting = held + len(found), waiting + n
        if records:
            yield runs()

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


class Run:
    """One run: its pairs with their links, and the documents of each pair."""

    def __init__(self, spill: int, blob: bytes):
        self.spill = spill
        steps, self.sizes, self.doc, self.links = unpack(blob)
        self.pair = np.cumsum(steps)
        self.count = np.add.reduceat(self.links, np.cumsum(self.sizes) - self.sizes) if len(steps) else steps

    def gains(self, pair: np.ndarray, count: np.ndarray, best: np.ndarray) -> tuple[int, bytes]:
        """What every document of the spill gains, given all pairs of the part."""
        at = np.repeat(np.searchsorted(pair, self.pair), self.sizes)
        docs, place = np.unique(self.doc, return_inverse=True)
        most, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        np.add.at(most, place, self.links * best[at])
        np.add.at(total, place, self.links * count[at])
        return self.spill, pack(np.diff(docs, prepend=0), most, total)


def merged(runs: list[Run]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of some runs in order, with their links: a heap merge of the runs."""
    pairs, counts, last = [], [], -1
    for pair, count in heapq.merge(*[zip(r.pair.tolist(), r.count.tolist()) for r in runs]):
        if pair == last:
            counts[-1] += count
        else:
            pairs.append(pair)
            counts.append(count)
            last = pair
    return np.array(pairs, np.int64), np.array(counts, np.int64)


def best_of(pair: np.ndarray, count: np.ndarray) -> np.ndarray:
    """1 where no pair of the same B id counts more; pairs are side-major."""
    if not len(pair):
        return pair
    side = pair >> ID_BITS
    starts = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    most = np.maximum.reduceat(count, starts)
    return (count == np.repeat(most, np.diff(np.append(starts, len(side))))).astype(np.int64)


GAINS = pa.schema([("spill", pa.int64()), ("gains", pa.binary())])


def _gains(runs: list[Run], pair: np.ndarray, count: np.ndarray) -> pa.Table:
    best = best_of(pair, count)
    rows = [r.gains(pair, count, best) for r in runs]
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=GAINS)


def _runs(table: pa.Table) -> list[Run]:
    return [Run(s, b) for s, b in zip(table.column("spill").to_pylist(), table.column("run").to_pylist())]


def _light(table: pa.Table) -> pa.Table:
    runs = _runs(table)
    return _gains(runs, *merged(runs))


def _count(table: pa.Table) -> pa.Table:
    pair, count = merged(_runs(table))
    part = pa.array(np.full(len(pair), table.column("part")[0].as_py(), np.int32))
    return pa.table({"part": part, "pair": pa.array(pair), "links": pa.array(count)})


def _heavy(runs: pa.Table, counted: pa.Table) -> pa.Table:
    pair, count = counted.column("pair").to_numpy(), counted.column("links").to_numpy()
    order = np.argsort(pair)
    return _gains(_runs(runs), pair[order], count[order])


def _sum(table: pa.Table) -> pa.Table:
    """Gains of the documents of one spill, all parts together."""
    size, parts = 0, [unpack(b) for b in table.column("gains").to_pylist()]
    parts = [(np.cumsum(steps), most, total) for steps, most, total in parts]
    size = max((int(d[-1]) + 1 for d, _, _ in parts if len(d)), default=0)
    best, summed = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for docs, most, total in parts:
        best[docs] += most
        summed[docs] += total
    return pa.table({"spill": pa.array(np.full(size, table.column("spill")[0].as_py(), np.int64)), "doc": pa.array(np.arange(size, dtype=np.int32)),
                     "n_best": pa.array(best), "count_sum": pa.array(summed)})


def align(docs: DataFrame, path_a: str, pattern: str, path_b: str, spill: int = SPILL, heavy: int = HEAVY, parts: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    if parts is None:
        size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
        parts = int(min(MOST_PARTS, max(1, size * RECORDS_A_BYTE * 2 / heavy)))
    bits = max(0, (parts - 1).bit_length())
    rows = settle(encoded(docs, path_a, pattern, path_b, bits, spill), "runs")
    runs = rows.filter("run is not null").select("spill", "part", "run", "records")
    loads = settle(runs.groupBy("part").agg(F.sum("records").alias("load")), "loads")  # MOST_PARTS rows at most
    groups = {r.part: -(-r.load // heavy) for r in loads.filter(F.col("load") > heavy).collect()}
    light = runs.filter(~F.col("part").isin(list(groups))) if groups else runs
    gains = light.groupBy("part").applyInArrow(_light, "spill bigint, gains binary")
    if groups:
        def shares() -> DataFrame:
            return F.broadcast(docs.sparkSession.createDataFrame(list(groups.items()), "part int, shares bigint"))

        split = runs.join(shares(), "part").withColumn("share", F.pmod(F.xxhash64("spill"), F.col("shares")))
        counted = split.groupBy("part", "share").applyInArrow(_count, "part int, pair bigint, links bigint").groupBy("part", "pair").agg(F.sum("links").alias("links"))
        counted = settle(counted, "pairs").join(shares(), "part").withColumn("share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)))
        streamed = split.groupBy("part", "share").cogroup(counted.groupBy("part", "share")).applyInArrow(_heavy, "spill bigint, gains binary")
        gains = gains.unionByName(streamed)
    summed = gains.groupBy("spill").applyInArrow(_sum, "spill bigint, doc int, n_best bigint, count_sum bigint")
    whole = rows.filter("run is null").drop("part", "run", "records").join(summed, ["spill", "doc"], "left")
    gained = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")]
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *gained, "groups_sha256")
