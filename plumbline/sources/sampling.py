"""Reproducible sampling by hash: independent of partitioning and row order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.exprs import small_table

HASH_RANGE = 1 << 60
SLOTS = 16  # bits of a slot; a slot is split by as many bits again


def key_hash(key: Column, seed: int = V.SEED) -> Column:
    """Uniform integer in [0, 2^60) from a key: the first 15 hex digits of an MD5.

    Every bit of key and seed reaches every bit of the result, so picks of different
    seeds are independent; other SQL engines compute the same picks.
    """
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def picked(hash_value: Column, share: float) -> Column:
    """True for about ``share`` of the rows."""
    return hash_value < F.lit(int(HASH_RANGE * share))


@dataclass
class Family:
    """One order of the rows (by hash) and the numbers of its first rows that are asked for."""

    hash: Column
    sizes: list[int]
    where: Column | None = None


def _slot(hash_value: Column, level: int = 0) -> Column:
    """The first (second, ...) group of bits of the hash."""
    return F.shiftright(hash_value, 60 - SLOTS * (level + 1)).bitwiseAND(F.lit((1 << SLOTS) - 1)).cast("int")


def _each(df: DataFrame, families: list[Family], **columns) -> DataFrame:
    """One row per row and family that wants it, with columns computed from the family's hash."""
    def row(i: int, family: Family) -> Column:
        made = F.struct(F.lit(i).alias("family"), *[f(family.hash).alias(n) for n, f in columns.items()])
        return made if family.where is None else F.when(family.where, made)

    rows = F.array_compact(F.array(*[row(i, f) for i, f in enumerate(families)]))
    return df.select(F.inline(rows))


def cut_points(df: DataFrame, families: list[Family], level: int = 0) -> dict[tuple[int, int], tuple[int, int]]:
    """For every (family, size): the slot that holds that row, and its place inside the slot.

    One histogram job for all families and sizes; a size beyond the rows has no entry. What
    comes back is one row per size.
    """
    slots = _each(df, families, slot=lambda h: _slot(h, level))
    histogram = slots.groupBy("family", "slot").agg(F.count("*").alias("n"))
    running = histogram.withColumn("upto", F.sum("n").over(Window.partitionBy("family").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)))
    sizes = small_table(df.sparkSession, "family INT, size BIGINT", [(i, n) for i, f in enumerate(families) for n in f.sizes])
    found = running.join(sizes, "family").filter((F.col("upto") >= F.col("size")) & (F.col("upto") - F.col("n") < F.col("size")))
    row = found.agg(F.collect_list(F.struct("family", "size", "slot", (F.col("size") - F.col("upto") + F.col("n")).alias("place"))).alias("cuts")).first()
    return {(r.family, r.size): (r.slot, r.place) for r in row.cuts}


def exact_sample(df: DataFrame, n: int, hash_value: Column, order: list[str]) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: those with the smallest hash, ties by ``order``.

    A plain ``orderBy(hash).limit(n)`` sends n rows of every task to one task. Here a
    histogram job over hash slots finds the one slot in which the n-th row lies, a second
    one the part of it. What is lower is kept where it is, and only that part, one row in
    2^32, is ranked. Rows that repeat one key have one hash and are ranked together.
    """
    if n <= 0:
        return df.limit(0)
    cut = cut_points(df, [Family(hash_value, [n])]).get((0, n))
    if cut is None:
        return df
    at, rest = cut
    sub_at, need = cut_points(df, [Family(hash_value, [rest], _slot(hash_value) == at)], 1)[0, rest]
    tagged = df.withColumn("_h", hash_value)
    slot, sub = _slot(F.col("_h")), _slot(F.col("_h"), 1)
    whole = tagged.filter((slot < at) | ((slot == at) & (sub < sub_at)))
    # one group only; its hash parts are the key, so it is found in the scan
    part = tagged.filter((slot == at) & (sub == sub_at))
    ranked = part.withColumn("_rn", F.row_number().over(Window.partitionBy(sub).orderBy("_h", *order)))
    return whole.unionByName(ranked.filter(F.col("_rn") <= need).drop("_rn")).drop("_h")


def nth_smallest(df: DataFrame, families: list[Family], key: str) -> list[dict[int, tuple[int, int] | None]]:
    """Per family and size n the n-th smallest (hash, key); None when n exceeds the rows.

    Two jobs over ``df`` for all of them: the histogram, and a ranking of the slots that hold
    the rows asked for, one row in 2^16 each.
    """
    cuts = cut_points(df, families)
    if not cuts:
        return [{n: None for n in f.sizes} for f in families]
    rows = _each(df, families, h=lambda h: h, k=lambda _: F.col(key).cast("long"))
    inside = F.lit(False)
    for (i, _), (slot, _) in cuts.items():
        inside = inside | ((F.col("family") == i) & (_slot(F.col("h")) == slot))
    met = rows.filter(inside).withColumn("slot", _slot(F.col("h")))
    ranked = met.withColumn("place", F.row_number().over(Window.partitionBy("family", "slot").orderBy("h", "k")))
    hit = F.lit(False)
    for (i, _), (slot, place) in cuts.items():
        hit = hit | ((F.col("family") == i) & (F.col("slot") == slot) & (F.col("place") == place))
    marks = ranked.filter(hit).agg(F.collect_list(F.struct("family", "slot", "place", "h", "k")).alias("marks")).first().marks
    at = {(m.family, m.slot, m.place): (m.h, m.k) for m in marks}
    return [{n: at[i, *cuts[i, n]] if (i, n) in cuts else None for n in f.sizes} for i, f in enumerate(families)]


def saved_sample(df: DataFrame, path: str, n: int, hash_value: Column, order: list[str], force: bool = False) -> DataFrame:
    """Write the sample once and reuse it; ``force`` rebuilds it."""
    mode = "overwrite" if force else "ignore"
    exact_sample(df, n, hash_value, order).write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
