"""Executable forms of the control rulebook.

Each function returns ONE row (total_records, fail_count) or the long form used by
``graded_rules``. Row predicates on one table are fused into one scan; everything keyed
is counted per key before any join or window. Windows only ever run over per-slice or
per-day summaries, never over the rows of a key, so a key with a third of all rows does
not become one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import percent, reaches, wall_micros


MONEY = "decimal(38,6)"  # amounts are summed as decimals of this type


def row_rules(df: DataFrame, rules: dict[str, tuple[Column, Column | None]]) -> DataFrame:
    """(rule_id, total_records, fail_count) for many row predicates in one scan."""
    aggs, items = [], []
    for rule, (passes, scope) in rules.items():
        scope = F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
        aggs += [F.count_if(scope).alias(f"{rule}__t"), F.count_if(scope & ~F.coalesce(passes, F.lit(False))).alias(f"{rule}__f")]
        items.append(F.struct(F.lit(rule).alias("rule_id"), F.col(f"{rule}__t").alias("total_records"), F.col(f"{rule}__f").alias("fail_count")))
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def _one(df: DataFrame, rule: str, total: Column, fail: Column) -> DataFrame:
    counts = df.agg(F.coalesce(total, F.lit(0)).cast("long").alias("t"), F.coalesce(fail, F.lit(0)).cast("long").alias("f"))
    item = F.struct(F.lit(rule).alias("rule_id"), F.col("t").alias("total_records"), F.col("f").alias("fail_count"))
    return counts.select(F.inline(F.array(item)))


# ---- predicates
def populated(col: str) -> Column:
    return F.col(col).isNotNull()


def not_blank(col: str) -> Column:
    return F.nullif(F.trim(F.col(col)), F.lit("")).isNotNull()


def in_range(col: str, low, high) -> Column:
    return F.col(col).between(F.lit(low), F.lit(high))


def matches(col: str, pattern: str) -> Column:
    return F.col(col).rlike(pattern)


def band_matches(value: Column, steps: list[tuple[float, str]], lowest: str, label: Column) -> Column:
    """The label implied by descending lower bounds equals the stored label."""
    expr = None
    for bound, name in steps:
        expr = F.when(value >= bound, name) if expr is None else expr.when(value >= bound, name)
    return expr.otherwise(lowest) == label


# ---- cross-table rules
def foreign_key(rule: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Every child row must find its parent; null keys fail."""
    kids = child.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
    known = parent.select(F.col(parent_key).alias("_k")).filter(F.col("_k").isNotNull()).distinct().withColumn("_known", F.lit(True))
    joined = kids.join(known, "_k", "left")
    return _one(joined, rule, F.sum("_n"), F.sum(F.when(F.col("_known").isNull(), F.col("_n"))))


def totals_match(rule: str, header: DataFrame, key: str, amount: str, detail: DataFrame, detail_key: str,
                 detail_amount: str, tolerance: float, money: str = MONEY) -> DataFrame:
    """Per header row the detail amounts must add up within an absolute tolerance.

    Amounts are summed as decimals, so the outcome does not depend on row order.
    Headers without detail are outside the scope.
    """
    sums = detail.groupBy(F.col(detail_key).alias("_k")).agg(F.sum(F.col(detail_amount).cast(money)).alias("_sum"))
    joined = header.select(F.col(key).alias("_k"), F.col(amount).cast(money).alias("_amount")).join(sums, "_k")
    ok = F.abs(F.col("_sum") - F.col("_amount")) <= F.lit(tolerance).cast(money)
    return _one(joined, rule, F.count("*"), F.count_if(~ok))


def periods_match(rule: str, left: DataFrame, left_date: str, left_amount: str, right: DataFrame, right_date: str,
                  right_amount: str, share: float, money: str = MONEY) -> DataFrame:
    """Monthly totals of two tables must agree within a relative tolerance (base: right)."""

    def monthly(df, date, amount, name):
        return df.groupBy(F.trunc(F.col(date), "month").alias("_m")).agg(F.sum(F.col(amount).cast(money)).cast("double").alias(name))

    joined = monthly(left, left_date, left_amount, "_l").join(monthly(right, right_date, right_amount, "_r"), "_m", "full")
    ok = F.coalesce(F.abs(F.col("_l") - F.col("_r")) / F.nullif(F.col("_r"), F.lit(0.0)) <= share, F.lit(False))
    return _one(joined, rule, F.count("*"), F.count_if(~ok))


def status_agrees(rule: str, header: DataFrame, key: str, header_cond: Column, detail: DataFrame, detail_key: str, detail_cond: Column) -> DataFrame:
    """A header flag must equal "all detail rows are flagged"; headers without detail are out of scope."""
    flags = detail.groupBy(F.col(detail_key).alias("_k")).agg(F.bool_and(detail_cond).alias("_all"))
    joined = header.select(F.col(key).alias("_k"), header_cond.alias("_flag")).join(flags, "_k")
    return _one(joined, rule, F.count("*"), F.count_if(F.col("_flag") != F.col("_all")))


# ---- timeliness
def recent_enough(rule: str, df: DataFrame, key: str, time: str, as_of: Column, limit: str) -> DataFrame:
    """Each key's latest row must lie within ``limit`` (an interval text) of ``as_of``."""
    latest = df.groupBy(key).agg(F.max(time).alias("_last"))
    ok = F.col("_last") >= as_of - F.expr(f"INTERVAL {limit}")
    return _one(latest, rule, F.count("*"), F.count_if(~ok))


BLOCK_SLICES = 4096  # slices of one key that one window sorts


def arrival_blocks(df: DataFrame, keys: list[Column], time: str, limit_seconds: int, block_slices: int = BLOCK_SLICES) -> DataFrame:
    """Gaps inside blocks of time: keys (``_k0`` on), block, rows, late gaps, first and last time.

    Time is cut into slices as wide as the limit. Two rows of one slice are always close
    enough, so a slice needs only its count, first and last time (map-side combined). A block
    is ``block_slices`` neighbouring slices of a key; the blocks of one key are spread over all
    tasks and each is scanned by itself.
    """
    limit = limit_seconds * 1_000_000
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    slices = (
        df.select(*named, wall_micros(F.col(time)).alias("_t"))
        .groupBy(*names, F.floor(F.col("_t") / limit).alias("_slice"))
        .agg(F.count("*").alias("_n"), F.min("_t").alias("_first"), F.max("_t").alias("_last"))
        .withColumn("_block", F.floor(F.col("_slice") / block_slices))
    )
    prev = F.lag("_last").over(Window.partitionBy(*names, "_block").orderBy("_slice"))
    return slices.withColumn("_gap", F.col("_first") - prev).groupBy(*names, "_block").agg(
        F.sum("_n").alias("_n"), F.count_if(F.col("_gap") > limit).alias("_late"), F.min("_first").alias("_first"), F.max("_last").alias("_last"))


def steady_arrival(rule: str, df: DataFrame, keys: list[Column], time: str, limit_seconds: int, block_slices: int = BLOCK_SLICES) -> DataFrame:
    """Consecutive rows of a key must be at most ``limit_seconds`` apart; first rows are out of scope.

    A carry scan: gaps are measured inside blocks of time (``arrival_blocks``), and the last
    time of each block is handed to the key's next one. Every row of a key but the first ends a
    gap, inside a slice, a block or between blocks, so the result is exact; the second window
    holds one row per block, so a key with all rows of the table is no single task. Rows
    without a time are in no gap, as before the first.
    """
    blocks = arrival_blocks(df, keys, time, limit_seconds, block_slices)
    names = [c for c in blocks.columns if c.startswith("_k")]
    handed = F.lag("_last").over(Window.partitionBy(*names).orderBy("_block"))
    met = blocks.withColumn("_gap", F.col("_first") - handed)
    late = F.sum("_late") + F.count_if(F.col("_gap") > limit_seconds * 1_000_000)
    return _one(met, rule, F.sum(F.col("_n") - 1) + F.count("_gap"), late)


def daily_deadline(rule: str, df: DataFrame, keys: list[str], time: str, first_before: int | None = None, last_from: int | None = None) -> DataFrame:
    """First row of each (key, day) before an hour, or last row at or after an hour."""
    day = F.to_date(time)
    span = df.groupBy(*keys, day.alias("_day")).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    ok = F.hour("_first") < first_before if first_before is not None else F.hour("_last") >= last_from
    return _one(span, rule, F.count("*"), F.count_if(~ok))


def next_day_deadline(rule: str, df: DataFrame, key: str, time: str, hour: int) -> DataFrame:
    """After every row of a key the next one must come by ``hour`` of the following day.

    All rows of a day but the last are followed on the same day. So per (key, day) only
    the count, first and last time are needed; rows of the key's last day: the final row
    has no successor and is out of scope.
    """
    days = df.groupBy(key, F.to_date(time).alias("_day")).agg(F.count("*").alias("_n"), F.min(time).alias("_first"))
    following = F.lead("_first").over(Window.partitionBy(key).orderBy("_day"))
    deadline = F.col("_day").cast("timestamp_ntz") + F.expr(f"INTERVAL {24 + hour} HOURS")
    spans = days.withColumn("_next", following).withColumn("_late", F.col("_next") > deadline)
    total = F.sum(F.col("_n") - 1) + F.count("_next")
    return _one(spans, rule, total, F.count_if("_late"))


def within_after(rule: str, detail: DataFrame, key: str, time: str, header: DataFrame, header_key: str, header_time: str, hours: int) -> DataFrame:
    """Detail rows must follow their header within ``hours``.

    Detail rows are counted per (key, time) before the join, so a header with very many
    detail rows is joined by its distinct times only.
    """
    kids = detail.groupBy(F.col(key).alias("_k"), F.col(time).alias("_t")).agg(F.count("*").alias("_n"))
    joined = kids.join(header.select(F.col(header_key).alias("_k"), F.col(header_time).alias("_h")), "_k")
    ok = F.col("_t") <= F.col("_h") + F.expr(f"INTERVAL {hours} HOURS")
    return _one(joined, rule, F.sum("_n"), F.sum(F.when(~ok, F.col("_n"))))


def graded_rules(counts: DataFrame, rulebook: DataFrame) -> DataFrame:
    """Rule results with rates and status against the rulebook thresholds."""
    c = F.col
    return (
        counts.join(rulebook, "rule_id")
        .withColumn("pass_count", c("total_records") - c("fail_count"))
        .withColumn("failure_rate", percent(c("fail_count"), c("total_records"), 2))
        .withColumn("control_effectiveness", percent(c("pass_count"), c("total_records"), 2, 100.0))
        .withColumn("status", F.when(reaches(c("pass_count"), c("total_records"), c("threshold")), "Pass").otherwise("Fail"))
        .select("rule_id", "rule_name", "category", "severity", "threshold", "total_records", "pass_count",
                "fail_count", "failure_rate", "control_effectiveness", "status")
    )
