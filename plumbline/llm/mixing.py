"""Mixing sources to target weights.

Documents get hash-random keys; each source is sorted by key in ranges, prefix sums of the
word counts run inside the ranges and over the range totals, and each source is cut at its
exact budget. A budget above the source's size takes whole epochs first.

The keys are uniform, so equal slices of the key space are even ranges; every source is
sliced alike, and one that holds a third of all rows is spread over all slices. Only range
totals (one row per source and slice) and source totals pass a window of their own.

A null or empty text has size 0. A null source is a source of its own, the last in order.
Rows that repeat are mixed as separate documents. A table without words has all targets 0.
An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, settle, split_column

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
ROWS_PER_SLICE = 2_000


def _targets(totals: DataFrame, weights: tuple, share: float, most: float) -> DataFrame:
    """Source totals and their targets: shares by weight, stopped at ``most`` times the size.

    Resharing the excess until no target is above its stop gives every source
    ``min(stop, level * weight)`` for one level. Sources reach their stop in the order of
    stop / weight, so the level follows from prefix sums in that order.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    weighed = weighed.withColumn("stop", F.lit(most) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("all") - F.col("stopped")) / F.col("open")
    swept = (
        weighed.withColumn("all", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("stopped", F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("first", F.when(level <= F.col("stop") / F.col("weight"), F.struct(F.row_number().over(by_ratio).alias("at"), level.alias("level"))))
        # the first source that the level does not stop, so neither the ones after it
        .withColumn("level", F.min("first").over(everything)["level"])
    )
    target = F.least(F.col("stop"), F.coalesce(F.col("level") * F.col("weight"), F.col("stop")))
    return swept.select("source", "source_size", target.alias("target"))


def first_words(text: str, count: int) -> str:
    """``text`` up to the end of its ``count``-th word."""
    word = next(itertools.islice(re.finditer(r"[^\x20\x09-\x0D]+", text), count - 1, None))
    return text[: word.end()]


def _between(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(value, high))


def mix(
    docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 7,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """One row per document: doc_id, source, key_, size, source_size, target, taken.

    ``taken`` counts the words the mix takes of the document, whole epochs included; the
    document at the budget's end is taken in part, so a source's sum is its target rounded down.
    """
    text_key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    base = docs.select(
        "doc_id", "source", split_column("text").cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_key).alias("key_"))
    base = settle(base, "sizes")
    count = max(1, math.ceil(base.count() / rows_per_slice))
    base = base.withColumn("slice", F.pmod(F.shiftrightunsigned("key_", 33), F.lit(count)).cast("int"))
    ranges = settle(base.groupBy("source", "slice").agg(F.sum("size").alias("words")), "ranges")
    totals = _targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    placed = ranges.alias("a").join(totals.alias("b"), same).select("a.*", "b.source_size", "b.target")
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    inside = Window.partitionBy("source", "slice").orderBy("key_", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ordered = base.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ordered.alias("a").join(placed.alias("b"), same & (F.col("a.slice") == F.col("b.slice"))).select(
        "a.doc_id", "a.source", "a.key_", "a.size", "b.source_size", "b.target", (F.col("a.ahead") + F.col("b.offset")).alias("ahead"))
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = budget - epochs * F.col("source_size")
    last = _between(rest - F.col("ahead"), F.lit(0), F.col("size"))
    return joined.withColumn("taken", (epochs * F.col("size") + last).cast("bigint")).drop("ahead")


def sample_text(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each epoch that takes a document.

    A document is repeated whole for each whole epoch; the one at the budget's end enters the
    last epoch with the words up to the cut. A document without words costs nothing and stays.
    Further columns, whatever their names, are carried.
    """
    text_key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    size_, taken_, rows_, id_, plan_key, doc_key = free_names(docs, "size_", "taken_", "rows_", "id_", "plan_key_", "doc_key_")
    plan = mix(docs.select("doc_id", "source", "text"), **parameters).groupBy(F.col("doc_id").alias(id_), F.col("key_").alias(plan_key)).agg(
        F.max("size").alias(size_), F.sum("taken").alias(taken_), F.count(F.lit(1)).alias(rows_))
    plan = plan.filter((F.col(taken_) > 0) | (F.col(size_) == 0))
    seed = parameters.get("seed", 7)
    keyed = docs.withColumn(doc_key, F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_key))
    small = plan.hint("shuffle_hash")  # small rows; the texts are not sorted
    joined = keyed.join(small, keyed["doc_id"].eqNullSafe(small[id_]) & (keyed[doc_key] == small[plan_key]))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cuts = [], []
            for i, (size, taken, same) in enumerate(zip(*(batch.column(c).to_pylist() for c in (size_, taken_, rows_)))):
                whole, part = divmod(-(-taken // same), size) if size else (1, 0)  # rows that repeat share evenly
                rows += [i] * (whole + (part > 0))
                cuts += [None] * whole + [part] * (part > 0)
            taken_rows = batch.select(schema.names).take(pa.array(rows, pa.int64()))
            at = schema.names.index("text")
            texts = [t if n is None else first_words(t, n) for t, n in zip(taken_rows.column(at).to_pylist(), cuts)]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(taken_rows.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.select(*docs.columns, size_, taken_, rows_).mapInArrow(run, schema)
