"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are centred on the mean, rotated by one random orthogonal matrix and kept as the signs
of their coordinates, packed in bits, with two correction scalars: the length of the centred
vector and the inner product of its direction with the code's. From those, the inner product
with a query is estimated without bias, and it misses by more than ``BOUND`` standard errors
only rarely. A candidate is reranked by its exact distance when its least possible distance
under that bound is below the k-th best exact distance known so far; a query's best are exact
distances, never estimates.

Queries go out in blocks of ``QUERIES_AT_ONCE``: a block is the same small size whatever the
table, and every task compares it with the codes it holds. Each task returns its k best per
query, and a rank per query over those gives the result.

Vectors that are null, zero or hold a null or non-finite component take no part. Nor do vectors
whose length differs from the index's ``dim`` (by default the commonest length, then the
larger). A row is no candidate of a query with its own vec_id. Query rows that repeat a vec_id
count once (the least vector); candidates that repeat one are each listed. Ties go to the
smaller vec_id. A null vec_id takes no part. With fewer than k candidates all are returned; empty
tables give an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

K = 10
BOUND = 3.0
SEED = 3
QUERIES_AT_ONCE = 2048
BLOCKS_AT_ONCE = 16  # searched in one job; more are written out in turn
ROWS_AT_ONCE = 1024


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def valid(table: DataFrame) -> DataFrame:
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good & some)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def centre(index: DataFrame, dim: int) -> np.ndarray:
    """The mean of all vectors: sums per task, then one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(dim), 0
        for batch in batches:
            total, rows = total + _matrix(batch.column("embedding"), dim).sum(axis=0), rows + batch.num_rows
        yield pa.RecordBatch.from_pydict({"at": list(range(dim)), "total": total, "n": [rows] * dim})

    table = index.select("embedding").mapInArrow(run, "at bigint, total double, n bigint").groupBy("at").agg(F.sum("total"), F.sum("n")).orderBy("at").toArrow()
    if not table.num_rows:
        return np.zeros(dim)
    return table.column(1).to_numpy() / np.maximum(1, table.column(2).to_numpy())


def coded(index: DataFrame, dim: int, middle: np.ndarray, seed: int = SEED) -> DataFrame:
    """vec_id, embedding, code (packed signs), size (length of the centred vector), along (inner product with the code)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim, seed)
        for batch in batches:
            x = (_matrix(batch.column("embedding"), dim) - middle) @ turn
            size = np.linalg.norm(x, axis=1)
            along = np.abs(x).sum(axis=1) / np.sqrt(dim) / np.where(size > 0, size, 1)
            code = np.packbits(x > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("embedding"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(size), pa.array(np.where(size > 0, along, 1.0))],
                ["vec_id", "embedding", "code", "size", "along"])

    schema = index.select("*", F.lit(b"").alias("code"), F.lit(0.0).alias("size"), F.lit(0.0).alias("along")).schema
    return index.mapInArrow(run, schema)


class Best:
    """The k nearest candidates of every query so far, by exact distance and then id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, middle: np.ndarray, k: int, bound: float, seed: int = SEED):
        self.ids, self.queries, self.k, self.bound = ids, queries, k, bound
        turned = (queries - middle) @ rotation(queries.shape[1], seed)
        self.size = np.linalg.norm(turned, axis=1)
        self.turned = turned / np.where(self.size > 0, self.size, 1)[:, None]
        self.distance = np.full((len(ids), k), np.inf)
        self.id = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.reranked = self.seen = 0

    def offer(self, ids: np.ndarray, vectors: np.ndarray, code: np.ndarray, size: np.ndarray, along: np.ndarray) -> None:
        dim = vectors.shape[1]
        signs = (np.unpackbits(code, axis=1, count=dim).astype(np.float64) * 2 - 1) / np.sqrt(dim)
        estimate = self.turned @ signs.T / along
        error = self.bound * np.sqrt(np.maximum(0, 1 - along * along)) / along / np.sqrt(max(1, dim - 1))
        cosine = np.minimum(1.0, estimate + error)
        least = np.sqrt(np.maximum(0, self.size[:, None] ** 2 + size ** 2 - 2 * self.size[:, None] * size * cosine))
        least *= 1 - 1e-9  # room for rounding
        own = self.ids[:, None] == ids
        least[own] = np.inf
        # the k candidates that may be nearest give a first k-th distance; then all others below it
        first = np.argpartition(least, min(self.k, least.shape[1]) - 1, axis=1)[:, :self.k]
        done = np.zeros(least.shape, bool)
        np.put_along_axis(done, first, True, axis=1)
        self._rerank(done & ~own, ids, vectors)
        self._rerank((least <= self.distance[:, -1:]) & ~done & ~own, ids, vectors)
        self.seen += least.size

    def _rerank(self, chosen: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.reranked += int(chosen.sum())
        for q in np.flatnonzero(chosen.any(axis=1)):
            rows = np.flatnonzero(chosen[q])
            exact = np.sqrt(((vectors[rows] - self.queries[q]) ** 2).sum(axis=1))
            distance, known = np.concatenate([self.distance[q], exact]), np.concatenate([self.id[q], ids[rows]])
            order = np.lexsort((known, distance))[:self.k]
            self.distance[q], self.id[q] = distance[order], known[order]


def nearest(queries: DataFrame, table: DataFrame, k: int = K, bound: float = BOUND, dim: int | None = None, block: int = QUERIES_AT_ONCE) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the ``k`` nearest rows of ``table`` per query."""
    good = valid(table.select("vec_id", "embedding"))
    if dim is None:
        common = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
        dim = common.dim if common else 1
    fits = F.size("embedding") == dim
    index = good.filter(fits)
    middle = centre(index, dim)
    index = settle(coded(index, dim, middle), "codes")
    asked = valid(queries.select("vec_id", "embedding")).filter(fits).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = settle(asked.repartitionByRange("vec_id"), "queries")
    spark, found, ids, vectors = table.sparkSession, [], [], []

    def best(parts: list[DataFrame]) -> DataFrame:
        """The k nearest per query over what the tasks returned."""
        near = parts[0]
        for more in parts[1:]:
            near = near.unionByName(more)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return near.select("query_id", "vec_id", "score").withColumn("rank", rank).filter(F.col("rank") <= k)

    def search() -> None:
        sent = spark.sparkContext.broadcast((np.array(ids, np.int64), np.array(vectors, np.float64).reshape(len(ids), dim)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = Best(*sent.value, middle, k, bound)
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                    rows = batch.slice(start, ROWS_AT_ONCE)
                    code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
                    held.offer(rows.column("vec_id").to_numpy().astype(np.int64), _matrix(rows.column("embedding"), dim), code,
                               rows.column("size").to_numpy(), rows.column("along").to_numpy())
            q, r = np.nonzero(np.isfinite(held.distance))
            yield pa.RecordBatch.from_pydict({"query_id": held.ids[q], "vec_id": held.id[q, r], "score": held.distance[q, r]})

        found.append(index.mapInArrow(run, "query_id bigint, vec_id bigint, score double"))
        if len(found) > BLOCKS_AT_ONCE:
            found[:] = [settle(best(found).drop("rank"), "neighbours")]

    for row in asked.toLocalIterator():  # one block in memory at a time
        ids.append(row.vec_id)
        vectors.append(row.embedding)
        if len(ids) == block:
            search()
            ids, vectors = [], []
    if ids or not found:
        search()
    return best(found).select("query_id", "rank", "vec_id", "score")
