"""SimHash near-duplicates with pivot distance tables.

Fingerprints: every shingle of ``SHINGLE`` words (A to Z lower-cased, joined by spaces, repeats
included; a shorter text is one shingle) is hashed with XXH64; a bit is 1 when set in over half
of the hashes. A null text, or one without words, has fingerprint 0 and is linked like any other.

Links: two fingerprints that differ in at most ``bits`` places. Cut into ``bits + m`` blocks,
they agree on some m whole blocks, so each choice of m blocks is one table and rows that share
its bits are compared there; m grows with the number of fingerprints, so that rows by chance
in one place stay few. Every distinct fingerprint carries its Hamming distances to ``PIVOTS``
reference fingerprints: two fingerprints are at least as far apart as their distances to any
pivot differ, so a pair whose largest coordinate difference is above ``bits`` is discarded, and
the survivors are verified bit by bit. Only a spanning forest of each place's links leaves a
task, and a place with very many fingerprints is cut into groups whose pairs are shared out.

Groups: connected components over distinct fingerprints, found by alternating star contraction
on written tables. Rows that repeat, also with the same doc_id, are kept as they are. A
component without any doc_id has a null id. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, free_names, mix64, settle, slices, words_of

SHINGLE = 4
BITS = 4
SEED = 42
PIVOTS = 16
PER_PLACE = 32
SPLIT_ABOVE = 4096
AT_ONCE = 1 << 16
TEXT_AT_ONCE = 4 << 20


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = list(itertools.accumulate((len(w) + 1 for w in words), initial=0))
    hashed = xxhash.xxh64_intdigest
    last = max(1, len(words) - shingle + 1)
    stops = ends[min(shingle, len(words)):]
    return np.fromiter((hashed(joined[a:b - 1], SEED) for a, b in zip(ends[:last], stops)), np.uint64, last)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit integer."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), AT_ONCE):
        piece = hashes[i:i + AT_ONCE].astype("<u8")
        counts += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """``docs`` and the fingerprint of the text (signed 64-bit)."""
    schema = docs.select("*", F.lit(0).cast("bigint").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            fps = [fingerprint(shingle_hashes(t, shingle)) for t in bytes_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.int64())], [*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def pivots(count: int = PIVOTS) -> list[int]:
    return [int(v) for v in mix64(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)]


def block_masks(distinct: int, bits: int = BITS, per_place: int = PER_PLACE) -> list[int]:
    """A mask per choice of blocks, with so many fixed bits that chance puts few rows in a place."""
    blocks = bits + 1
    while blocks < 16 and distinct > per_place * 2 ** (64 * (blocks - bits) // blocks):
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    whole = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in itertools.combinations(whole, blocks - bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _near(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs are within ``bits``: first by the pivot coordinates, then bit by bit."""
    alive = np.arange(len(i))
    for column in table:
        a, b = column[i[alive]], column[j[alive]]
        alive = alive[np.maximum(a, b) - np.minimum(a, b) <= bits]
    return alive[np.bitwise_count(fp[i[alive]] ^ fp[j[alive]]) <= bits]


def _forest(fp: np.ndarray, table: np.ndarray, bits: int) -> tuple[list, list]:
    """Spanning forest of the links of one place, by search from member to member."""
    left, out_a, out_b = np.arange(len(fp)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            found = _near(fp, table, np.full(len(left), at), left, bits)
            new = left[found]
            out_a.append(np.full(len(new), at))
            out_b.append(new)
            queue.extend(new)
            left = np.delete(left, found)
    return out_a, out_b


def _sweep(place: np.ndarray, fp: np.ndarray, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of all places in rows sorted by place."""
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(place)]]))
    size_of = np.repeat(sizes, sizes)
    out_a, out_b = [], []
    small = size_of <= 16
    for shift in range(1, min(16, int(sizes.max()))):
        i = np.flatnonzero(small[:-shift] & (place[:-shift] == place[shift:]))
        near = _near(fp, table, i, i + shift, bits)
        out_a.append(i[near])
        out_b.append(i[near] + shift)
    for start, size in zip(starts[sizes > 16], sizes[sizes > 16]):
        a, b = _forest(fp[start:start + size], table[:, start:start + size], bits)
        out_a += [x + start for x in a]
        out_b += [x + start for x in b]
    none = np.empty(0, np.int64)
    a, b = np.concatenate([none, *out_a]), np.concatenate([none, *out_b])
    return fp[a], fp[b]


def links(distinct: DataFrame, count: int, bits: int = BITS, per_place: int = PER_PLACE, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints that connect what is within ``bits``."""
    packed = [
        sum((F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("bigint"), 8 * k) for k, p in enumerate(pivots()[8 * g:8 * g + 8])), F.lit(0).cast("bigint"))
        for g in range(PIVOTS // 8)]
    tables = F.array(*[F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m))) for t, m in enumerate(block_masks(count, bits, per_place))])
    rows = distinct.select("fp", *[c.alias(f"p{g}") for g, c in enumerate(packed)], F.explode(tables).alias("place"))
    crowded = rows.groupBy("place").count().filter(F.col("count") > split_above).select(
        F.col("place").alias("crowded"), F.ceil(F.col("count") / split_above).cast("int").alias("groups"))
    crowded = settle(crowded, "crowded")
    if crowded.isEmpty():
        cells = rows
    else:  # each row meets every group of its place in one cell
        own = F.pmod(F.xxhash64("fp"), F.col("groups")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("groups") - 1, F.lit(0))))
        met = rows.join(crowded, rows["place"] == crowded["crowded"], "left").withColumn("other", other)
        cell = F.xxhash64("place", F.least(own, F.col("other")), F.greatest(own, F.col("other")))
        cells = met.withColumn("place", F.when(F.col("groups").isNull(), F.col("place")).otherwise(cell)).drop("crowded", "groups", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def done(whole: pa.Table) -> pa.RecordBatch:
            place, fp, *p = (whole.column(c).to_numpy() for c in ("place", "fp", *[f"p{g}" for g in range(PIVOTS // 8)]))
            fp = fp.view(np.uint64)
            table = np.concatenate([c.astype("<i8").view(np.uint8).reshape(-1, 8).T for c in p])
            a, b = (x.view(np.int64) for x in _sweep(place, fp, table, bits))
            return pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            last = batch.column("place")[batch.num_rows - 1]
            if batch.column("place")[0] == last and kept[0].column("place")[0] == last:
                continue  # one place so far
            whole = pa.Table.from_batches(kept)
            cut = int(np.searchsorted(whole.column("place").to_numpy(), last.as_py()))
            yield done(whole.slice(0, cut))
            kept = whole.slice(cut).combine_chunks().to_batches()
        if kept:
            yield done(pa.Table.from_batches(kept))

    swept = cells.repartition("place").sortWithinPartitions("place").mapInArrow(run, "a bigint, b bigint")
    return swept.filter("a <> b").distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction; edges are (a, b) with a < b and stay so."""
    sides = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if large:
        sides = sides.unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")) if large else sides.groupBy("u").agg(F.min("v").alias("m"))
    joined = sides.join(least, "u")
    moved = joined.filter("v > u" if large else "v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return moved.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges but the roots; a root is the smallest node reachable."""
    edges, before = settle(edges, "edges"), None
    mark = (F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    while True:
        edges = settle(_star(settle(_star(edges, large=True), "large-star"), large=False), "small-star")
        now = edges.agg(*mark).first()
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, per_place: int = PER_PLACE, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest doc_id reachable), root."""
    marked = settle(with_fingerprint(docs.select("doc_id", "text"), shingle).drop("text"), "fingerprints")
    distinct = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(links(distinct, distinct.count(), bits, per_place, split_above))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = settle(rooted.select("fp", "root").join(named, "root"), "named")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, find: Callable = near_duplicates, mark: Callable = with_fingerprint, **parameters) -> DataFrame:
    """The documents that stay, all columns: one per component, with the smallest doc_id.

    Further columns, whatever their names, are carried. A null id counts as the largest. Of rows of a component that share that id, the one with
    the smallest fingerprint stays, and one of rows that share that too.
    """
    found = settle(find(docs, **parameters), "components")
    id_, fp_, stays, doc_fp = free_names(docs, "id_", "fp_", "stays_", "doc_fp_")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("first")
    firsts = found.groupBy("root").agg(first).select(F.col("first.doc_id").alias(id_), F.col("first.fp").alias(fp_))
    firsts = settle(firsts, "firsts")
    chosen = firsts.select(id_, F.lit(True).alias(stays)).distinct()
    ids = found.groupBy("doc_id").count().join(chosen, F.col("doc_id").eqNullSafe(F.col(id_)), "left")
    ids = settle(ids.filter(F.col(stays).isNull() | (F.col("count") > 1)).select(F.col("doc_id").alias(id_), stays), "dropped")
    gone, again = ids.hint("shuffle_hash"), ids.filter(stays)  # small rows; the texts are not sorted
    single = docs.join(gone, docs["doc_id"].eqNullSafe(gone[id_]), "left_anti")
    if again.isEmpty():
        return single
    some = mark(docs.join(again, docs["doc_id"].eqNullSafe(again[id_]), "left_semi"), out=doc_fp)
    some = some.join(firsts, some["doc_id"].eqNullSafe(firsts[id_]) & (some[doc_fp] == firsts[fp_]), "left_semi")
    return single.unionByName(some.dropDuplicates(["doc_id", doc_fp]).drop(doc_fp))
