"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


CALENDAR_DAYS = (-719162, 2932896)  # 0001-01-01 to 9999-12-31, counted from 1970-01-01


def rounded(x: Column, digits: int) -> Column:
    """Round a double half away from zero by scaling, as SQL engines on doubles do.

    Spark's own ``round(x, d)`` works on the decimal text of ``x``; scaling first
    gives the arithmetic most engines use, so results agree to the last bit.
    """
    scale = F.lit(float(10**digits))
    return F.round(x * scale, 0) / scale


def percent(part: Column, whole: Column, digits: int | None = None, empty: float | None = 0.0) -> Column:
    """``100 * part / whole``; ``empty`` when ``whole`` is zero."""
    value = F.lit(100.0) * part / whole
    if digits is not None:
        value = rounded(value, digits)
    otherwise = F.lit(None).cast("double") if empty is None else F.lit(float(empty))
    return F.when(whole > 0, value).otherwise(otherwise)


def reaches(part: Column, whole: Column, threshold: Column, digits: int | None = None) -> Column:
    """Whether ``part`` of ``whole`` is at least ``threshold`` percent, decided on the counts.

    ``digits`` compares the percentage rounded to so many decimals instead, which lets a
    few failures in many rows pass a 100 % threshold.
    """
    if digits is not None:
        return percent(part, whole, digits, 100.0) >= threshold
    exact = "decimal(38,6)"
    return part.cast(exact) * 100 >= threshold.cast("decimal(9,6)") * whole


def hundredths(rate: Column) -> Column:
    """A two-decimal percentage as a whole number of hundredths."""
    return F.round(rate * 100, 0).cast("long")


def mean_rate(rate: Column, where: Column | None = None) -> Column:
    """Mean of two-decimal percentages from integer sums.

    The sum is exact, so the mean does not depend on partitioning or row order.
    Null when no row qualifies.
    """
    units = hundredths(rate)
    if where is not None:
        units = F.when(where, units)
    return F.try_divide(F.sum(units), F.lit(100.0) * F.count(units))


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def banded(score: Column, bands, otherwise: str) -> Column:
    """Label of the first band whose lower bound ``score`` reaches."""
    expr = None
    for bound, label in bands:
        expr = F.when(score >= bound, label) if expr is None else expr.when(score >= bound, label)
    return expr.otherwise(otherwise)


def ranked(col: Column, ranks: dict, otherwise: int = 9) -> Column:
    """Rank of a label by a small fixed mapping."""
    expr = None
    for label, rank in ranks.items():
        expr = F.when(col == label, rank) if expr is None else expr.when(col == label, rank)
    return expr.otherwise(otherwise)


def add_all(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def event_date(df: DataFrame, name: str) -> Column:
    """Calendar date (UTC) of an event-time column: epoch milliseconds or a timestamp."""
    if isinstance(df.schema[name].dataType, (T.LongType, T.DoubleType, T.IntegerType)):
        # a time outside the calendar (say, nanoseconds taken for milliseconds) has no date
        days = F.floor(F.col(name) / F.lit(86400000)).try_cast("int")
        days = F.when(days.between(*CALENDAR_DAYS), days)
        return F.date_add(F.lit("1970-01-01").cast("date"), days)
    return F.to_date(F.col(name))


def wall_micros(time: Column) -> Column:
    """Microseconds of the wall-clock reading since 1970, whatever the session time zone."""
    day = F.unix_date(F.to_date(time)).cast("long") * 86_400_000_000
    minutes = (F.hour(time) * 60 + F.minute(time)).cast("long") * 60_000_000
    seconds = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")
    return day + minutes + seconds


def scalar(df: DataFrame, agg: Column) -> Column:
    """One aggregate of ``df`` as a scalar subquery, usable inside other expressions."""
    return df.agg(agg.alias("v")).scalar()


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def small_table(spark: SparkSession, columns: str, rows) -> DataFrame:
    """A table of fixed values as an inline relation.

    ``columns`` is a DDL string. The relation is part of the plan (no Python
    serialisation, no tasks of its own) and its exact size is known to Spark, so a
    join with it is broadcast without a hint.
    """
    from ..schemas import struct

    fields = struct(columns).fields
    names = ", ".join(f.name for f in fields)
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def numbered(df: DataFrame, name: str, fmt: str, bucket: list[str], order: list) -> DataFrame:
    """Consecutive ids 1..n in (bucket, order) order without sorting everything in one task.

    Rows are numbered inside their bucket; only the per-bucket counts (one row per
    bucket) pass through the single-partition running sum that yields the offsets.
    """
    from pyspark.sql import Window

    sizes = df.groupBy(*bucket).agg(F.count("*").alias("_n"))
    before = Window.orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*bucket).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, bucket)
        .withColumn(name, F.format_string(fmt, F.col("_offset") + F.col("_rn")))
        .drop("_rn", "_offset")
    )


def known_by(tests: DataFrame, as_of, column: str = "test_date") -> DataFrame:
    """Only what was known at the reference date; all rows when that is the latest date."""
    return tests if as_of is None else tests.filter(F.col(column) <= as_of_date(tests, as_of, column))


def as_of_date(tests: DataFrame, as_of, column: str = "test_date") -> Column:
    """The reference date: given, or the latest date of the table as a scalar subquery."""
    if as_of is None:
        return scalar(tests, F.max(column))
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
