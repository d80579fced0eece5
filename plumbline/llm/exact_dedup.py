"""Exact deduplication with a heavy-hitter split.

A Misra-Gries summary per partition finds the digests that may be frequent; they are counted
exactly and their winners, at most ``counters + 1`` rows whatever the input, are broadcast, so
copies of frequent texts are settled where they lie. All other digests, each with fewer than
``2 * rows / (counters + 1)`` rows, go through ordinary shuffles.

Texts are equal when their SHA-256 after lower-casing A to Z is equal; a null text counts as
empty. Of equal texts the row with the largest doc_id stays; null ids come last, and of rows
that repeat the id too exactly one stays. An empty table gives an empty result. Further
columns, whatever their names, are carried by ``deduplicate`` and not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, free_names, settle, slices

COUNTERS = 1024
TEXT_AT_ONCE = 4 << 20


def with_digest(docs: DataFrame, text: str = "text", out: str = "digest_") -> DataFrame:
    """``docs`` and the SHA-256 of the normalised text, as 32 bytes."""
    schema = docs.select("*", F.lit(b"").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, TEXT_AT_ONCE):
            digests = [hashlib.sha256(t.lower()).digest() for t in bytes_of(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def frequent(digests: DataFrame, rows: int, counters: int = COUNTERS) -> DataFrame:
    """Digests that may hold ``2 * rows / (counters + 1)`` rows or more; none of those is missed.

    A counter is short of the true count by at most ``n / (counters + 1)`` over a partition of
    n rows, so the sums are short by at most ``rows / (counters + 1)``; as they add up to
    ``rows`` at most, no more than ``counters + 1`` of them reach that value.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for pair in batch.column(0).value_counts():
                key = pair["values"].as_py()
                held[key] = held.get(key, 0) + pair["counts"].as_py()
            if len(held) > counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = {k: c - cut for k, c in held.items() if c > cut}
        yield pa.RecordBatch.from_pydict({"digest_": list(held), "held": list(held.values())},
                                         pa.schema([("digest_", pa.binary()), ("held", pa.int64())]))

    summed = digests.select("digest_").mapInArrow(run, "digest_ binary, held bigint").groupBy("digest_").agg(F.sum("held").alias("held"))
    return summed.filter(F.col("held") >= max(1.0, rows / (counters + 1))).select("digest_")


def assign(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, digest_, keep_id, group_size, kept."""
    keys = settle(with_digest(docs.select("doc_id", "text")).select("doc_id", "digest_", F.monotonically_increasing_id().alias("row_")), "digests")
    winner = F.max(F.struct("doc_id", "row_")).alias("win")
    size = F.count(F.lit(1)).alias("group_size")
    candidates = F.broadcast(frequent(keys, keys.count(), counters))
    # at most counters + 1 rows, verified by exact counts
    heavy = settle(keys.join(candidates, "digest_", "left_semi").groupBy("digest_").agg(size, winner).filter("group_size > 1"), "winners")
    few = keys.join(F.broadcast(heavy.select("digest_")), "digest_", "left_anti")
    many = keys.join(F.broadcast(heavy), "digest_")
    rest = few.join(few.groupBy("digest_").agg(size, winner), "digest_")
    return many.unionByName(rest).select(
        "doc_id", "digest_", F.col("win.doc_id").alias("keep_id"), "group_size", (F.col("row_") == F.col("win.row_")).alias("kept"))


def deduplicate(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, all columns; copies are removed by (doc_id, digest)."""
    digest, other, key, kept, rows = free_names(docs, "digest_", "other_", "id_", "any_kept_", "rows_")
    pairs = assign(docs.select("doc_id", "text"), counters).groupBy(F.col("doc_id").alias(key), F.col("digest_").alias(other))
    pairs = settle(pairs.agg(F.bool_or("kept").alias(kept), F.count(F.lit(1)).alias(rows)).filter(~F.col(kept) | (F.col(rows) > 1)), "dropped")
    table = with_digest(docs, out=digest)

    def matches(side: DataFrame):
        return table[digest].eqNullSafe(side[other]) & table["doc_id"].eqNullSafe(side[key])

    all_pairs, again = pairs.hint("shuffle_hash"), pairs.filter(kept).hint("shuffle_hash")  # small rows; the texts are not sorted
    single = table.join(all_pairs, matches(all_pairs), "left_anti")
    if again.isEmpty():
        return single.drop(digest)
    repeated = table.join(again, matches(again), "left_semi").dropDuplicates(["doc_id", digest])
    return single.unionByName(repeated).drop(digest)
