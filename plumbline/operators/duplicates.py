"""Repeated rows by fingerprint, then verified.

A row is first counted under a 128-bit fingerprint, 16 bytes in the shuffle whatever its width.
Only rows whose fingerprint comes again meet as full rows, so the count is exact even where two
different rows share a fingerprint, and a table without repeats never shuffles a full row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Fingerprint = Callable[[list[str]], tuple[Column, Column]]


def fingerprint(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; the hash function passes over nulls, so where they stand is hashed too."""
    values = [F.col(c) for c in columns]
    nulls = [v.isNull() for v in values]
    return F.xxhash64(*values, *nulls), F.xxhash64(F.lit(7), *nulls, *values)


def with_fingerprint(df: DataFrame, marks: Fingerprint = fingerprint) -> DataFrame:
    a, b = marks(df.columns)
    return df.withColumns({"_fp_a": a, "_fp_b": b})


def members(df: DataFrame, repeated: DataFrame, marks: Fingerprint = fingerprint) -> DataFrame:
    """Distinct full rows among those whose fingerprint is in ``repeated`` (_fp_a, _fp_b), with their number ``_n``."""
    met = with_fingerprint(df, marks).join(repeated, ["_fp_a", "_fp_b"], "left_semi")
    return met.groupBy(*df.columns).agg(F.count("*").alias("_n"))


def duplicate_counts(df: DataFrame, by: list[str], marks: Fingerprint = fingerprint) -> DataFrame:
    """Per ``by``: rows (``_rows``) and extra copies of full rows (``_extra``). Nulls are equal to each other."""
    a, b = marks(df.columns)
    counted = df.select(*by, a.alias("_fp_a"), b.alias("_fp_b")).groupBy(*by, "_fp_a", "_fp_b").agg(F.count("*").alias("_n"))
    totals = counted.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"))
    extra = members(df, counted.filter("_n > 1").select("_fp_a", "_fp_b"), marks).groupBy(*by).agg(F.sum(F.col("_n") - 1).alias("_extra"))
    if not by:
        return totals.withColumn("_extra", F.coalesce(extra.scalar(), F.lit(0)))
    same = [totals[k].eqNullSafe(extra[k]) for k in by]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return totals.join(extra, condition, "left").select(*[totals[k] for k in by], "_rows", F.coalesce("_extra", F.lit(0)).alias("_extra"))
