"""Early-warning watchlist from measured null, duplicate and control-failure rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.exprs import add_all, as_of_date, hundredths, known_by, numbered, rounded

SIGNALS = {"null": "null_rate", "dup": "duplicate_rate", "fail": "control_failure_rate"}
TRENDS = {"null": "null_rate_trend", "dup": "duplicate_rate_trend", "fail": "control_failure_trend"}


PROFILE = ("cells", "null_cells", "profiled_rows", "dup_rows")
SKETCH = 16  # a sketch counts up to 2^16 keys exactly; beyond that its relative error is about 0.4 %


def key_counts(df: DataFrame, columns: list[str], key: list[str], by: list[str]) -> DataFrame:
    """Rows and null cells of ``columns`` per ``by`` and ``key``: what all profiles are summed from.

    Map-side combined, so a key with very many rows is one row afterwards. Null keys are equal
    to each other.
    """
    nulls = add_all([F.col(x).isNull().cast("long") for x in columns])
    return df.groupBy(*by, *[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)]).agg(F.count("*").alias("_n"), F.sum(nulls).alias("_nulls"))


def profile_of(counts: DataFrame, width: int, by: list[str], sketched: list[str] | None = None) -> DataFrame:
    """A profile per ``by`` of ``width`` columns from ``key_counts``.

    All measures are sums. Repeats are counted inside a group; keys that come again in another
    group are seen only by ``key_sketch``, a mergeable sketch of the distinct values of the
    columns ``sketched`` (which must contain the key).
    """
    sketch = [] if sketched is None else [F.theta_sketch_agg(F.xxhash64(*sketched), F.lit(SKETCH)).alias("key_sketch")]
    return counts.groupBy(*by).agg(
        (F.sum("_n") * width).alias("cells"), F.sum("_nulls").alias("null_cells"),
        F.sum("_n").alias("profiled_rows"), F.sum(F.col("_n") - 1).alias("dup_rows"), *sketch)


def profile(df: DataFrame, columns: list[str], key: list[str], by: list[str]) -> DataFrame:
    """Null cells of ``columns`` and repeated rows of ``key``, per ``by``; the measures are additive."""
    return profile_of(key_counts(df, columns, key, by), len(columns), by)


def roll_up_profile(measured: DataFrame, keys: list[str]) -> DataFrame:
    """Sum a profile to coarser keys; repeats stay those inside the finer groups."""
    return measured.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in PROFILE])


def period_duplicates(counts: DataFrame, key: list[str], end: Column, split: int = V.TREND_SPLIT_DAYS, early_days: int = V.TREND_SPLIT_DAYS) -> DataFrame:
    """Share of rows per dataset and period whose key came before in that period, in percent.

    ``counts`` has dataset_id, test_date, the columns ``key`` and ``_n``. Exact, in two levels:
    the days of a key are summed first, so only (dataset, key) rows are shuffled and a key that
    comes on many days is one row.
    """
    early, recent = _periods(end, split, early_days)
    per_key = counts.filter(early | recent).groupBy("dataset_id", *key).agg(
        *[F.coalesce(F.sum(F.when(p, F.col("_n"))), F.lit(0)).alias(n) for p, n in ((early, "_early"), (recent, "_recent"))])
    return per_key.groupBy("dataset_id").agg(*[
        _rate(F.sum(F.col(f"_{n}")) - F.count_if(F.col(f"_{n}") > 0), F.sum(f"_{n}")).alias(f"duplicate_rate_{n}") for n in ("early", "recent")])


def daily_failures(tests: DataFrame) -> DataFrame:
    """Additive failure-rate sums per (dataset, day)."""
    return tests.groupBy("dataset_id", "test_date").agg(
        F.sum(hundredths(F.col("failure_rate"))).alias("rate_hundredths"), F.count("*").alias("rate_tests")
    )


def _rate(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part, whole)


def _mean(units: Column, n: Column) -> Column:
    return F.try_divide(units, F.lit(100.0) * n)


def _repeats(rows: Column, keys: Column) -> Column:
    """Rows less the distinct keys that a sketch counts."""
    return F.greatest(rows - F.round(F.theta_sketch_estimate(keys)).cast("long"), F.lit(0))


def _periods(end: Column, split: int, early_days: int) -> tuple[Column, Column]:
    """Early and recent period before ``end``: the same bounds as ``history`` has on each day."""
    day, cut = F.col("test_date"), F.date_sub(end, split)
    return (day > F.date_sub(cut, early_days)) & (day <= cut), (day > cut) & (day <= end)


def period_rates(
    tests: DataFrame, profile: DataFrame, as_of=None, split: int = V.TREND_SPLIT_DAYS, early_days: int = V.TREND_SPLIT_DAYS,
    counts: DataFrame | None = None, key: list[str] | None = None,
) -> DataFrame:
    """Unrounded early and recent rates per dataset; a dataset without both periods is left out.

    Recent is after ``as_of - split`` up to ``as_of``, early the ``early_days`` before that. A row
    is a duplicate when its key came before in the same period: counted exactly from ``counts``
    (see ``period_duplicates``), else by the sketches of the profile. A profile without sketches
    sees repeats inside a day only.
    """
    end = as_of_date(tests, as_of)
    c = F.col
    early, recent = _periods(end, split, early_days)
    known = early | recent

    def both(df, specs):
        aggs = []
        for name, fn in specs.items():
            aggs += [fn(early).alias(f"{name}_early"), fn(recent).alias(f"{name}_recent")]
        return df.filter(known).groupBy("dataset_id").agg(*aggs)

    def total(col):
        return lambda cond: F.sum(F.when(cond, c(col)))

    failures = both(tests, {
        "control_failure_rate": lambda p: _mean(F.sum(F.when(p, hundredths(c("failure_rate")))), F.count_if(p)),
    })
    def repeats(p):
        return _repeats(total("profiled_rows")(p), F.theta_union_agg(F.when(p, c("key_sketch")), F.lit(SKETCH))) if "key_sketch" in profile.columns else total("dup_rows")(p)

    specs = {"null_rate": lambda p: _rate(total("null_cells")(p), total("cells")(p))}
    if counts is None:
        specs["duplicate_rate"] = lambda p: _rate(repeats(p), total("profiled_rows")(p))
    rates = failures.join(both(profile, specs), "dataset_id")
    if counts is not None:
        rates = rates.join(period_duplicates(counts, key, end, split, early_days), "dataset_id")
    return rates.dropna(subset=[f"{n}_{p}" for n in SIGNALS.values() for p in ("early", "recent")])


def trend_delta(early: Column, recent: Column, floor: float = V.TREND_FLOOR) -> Column:
    """Relative change in percent against the early rate, which is floored."""
    return (recent - early) / F.greatest(early, F.lit(floor)) * F.lit(100.0)


def trend_label(delta: Column, fires: Column | None = None, cut: float = V.TREND_CUT_PCT) -> Column:
    fires = F.lit(True) if fires is None else fires
    return F.when(fires & (delta > cut), "Deteriorating").when(fires & (delta < -cut), "Improving").otherwise("Stable")


def add_trends(rates: DataFrame, min_move: float | None = None) -> DataFrame:
    """Delta and trend per signal; with ``min_move`` a signal needs that absolute move to fire."""
    out = rates
    for sig, rate in SIGNALS.items():
        early, recent = F.col(f"{rate}_early"), F.col(f"{rate}_recent")
        fires = None if min_move is None else F.abs(recent - early) >= min_move
        out = out.withColumn(f"{sig}_delta", trend_delta(early, recent))
        out = out.withColumn(TRENDS[sig], trend_label(F.col(f"{sig}_delta"), fires))
    return out


def signal_counts(trends: DataFrame) -> DataFrame:
    def count(label):
        return add_all([(F.col(t) == label).cast("int") for t in TRENDS.values()])

    return trends.withColumn("det_count", count("Deteriorating")).withColumn("imp_count", count("Improving"))


def status_of(det: Column) -> Column:
    return F.when(det >= 2, "Watchlist").when(det == 1, "Monitor").otherwise("Clear")


def classify(counted: DataFrame) -> DataFrame:
    """Status, risk trend, priority, reason and action from the signal counts and criticality."""
    c = F.col
    det, imp, high = c("det_count"), c("imp_count"), c("regulatory_criticality") == "High"

    def by_outcome(two, one, improving, stable):
        return F.when(det >= 2, two).when(det == 1, one).when(imp >= 2, improving).otherwise(stable)

    firing = F.concat_ws("; ", *[
        F.when(c(TRENDS[s]) == "Deteriorating", F.format_string(text, rounded(c(f"{s}_delta"), 1)))
        for s, text in V.SIGNAL_TEXTS.items()
    ])
    return (
        counted.withColumn("watchlist_status", status_of(det))
        .withColumn("risk_trend", by_outcome(F.lit("Deteriorating"), F.lit("Caution"), F.lit("Improving"), F.lit("Stable")))
        .withColumn("priority", by_outcome(F.when(high, "High").otherwise("Medium"), F.when(high, "Medium").otherwise("Low"), F.lit("Low"), F.lit("Low")))
        .withColumn("watchlist_reason", by_outcome(firing, F.lit(V.MONITOR_REASON), F.lit(V.IMPROVING_REASON), F.lit(V.STABLE_REASON)))
        .withColumn("recommended_action", by_outcome(F.lit(V.WATCHLIST_ACTION), F.lit(V.MONITOR_ACTION), F.lit(V.IMPROVING_ACTION), F.lit(V.STABLE_ACTION)))
    )


def watchlist(
    tests: DataFrame, profile: DataFrame, inventory: DataFrame, as_of=None, min_move: float | None = None,
    counts: DataFrame | None = None, key: list[str] | None = None,
) -> DataFrame:
    """One row per dataset; rates are rounded only here, in the last projection."""
    info = inventory.select("dataset_id", "dataset_name", "domain", "regulatory_criticality")
    rates = period_rates(tests, profile, as_of, counts=counts, key=key)
    rated = signal_counts(add_trends(rates, min_move)).join(info, "dataset_id")
    out = classify(rated)
    for rate in SIGNALS.values():
        for p in ("early", "recent"):
            out = out.withColumn(f"{rate}_{p}", rounded(F.col(f"{rate}_{p}"), 2))
    return out.withColumn("review_date", as_of_date(tests, as_of))


WATCHLIST_COLUMNS = [
    "watchlist_id", "dataset_id", "dataset_name", "domain", "regulatory_criticality",
    "null_rate_early", "null_rate_recent", "null_rate_trend",
    "duplicate_rate_early", "duplicate_rate_recent", "duplicate_rate_trend",
    "control_failure_rate_early", "control_failure_rate_recent", "control_failure_trend",
    "watchlist_status", "risk_trend", "watchlist_reason", "priority", "recommended_action", "review_date",
]


def with_watchlist_ids(df: DataFrame) -> DataFrame:
    return numbered(df, "watchlist_id", "WL-%04d", ["domain"], ["dataset_id"]).select(*WATCHLIST_COLUMNS)


def reconcile(stored: DataFrame, tests: DataFrame, as_of=None) -> DataFrame:
    """Recompute the control-failure trend from the test history and the status from all trends."""
    c = F.col
    early, recent = _periods(as_of_date(tests, as_of), V.TREND_SPLIT_DAYS, V.TREND_SPLIT_DAYS)
    units = hundredths(c("failure_rate"))
    again = known_by(tests, as_of).groupBy("dataset_id").agg(
        _mean(F.sum(F.when(early, units)), F.count_if(early)).alias("_e"),
        _mean(F.sum(F.when(recent, units)), F.count_if(recent)).alias("_r"),
    ).filter(c("_e").isNotNull() & c("_r").isNotNull())
    trends = [c("null_rate_trend"), c("duplicate_rate_trend"), c("trend_recomputed")]

    def count(label):
        return add_all([(t == label).cast("int") for t in trends])

    return (
        again.select("dataset_id", trend_label(trend_delta(c("_e"), c("_r"))).alias("trend_recomputed"))
        .join(stored.select("dataset_id", "null_rate_trend", "duplicate_rate_trend", "control_failure_trend", "watchlist_status"), "dataset_id")
        .withColumn("det_count", count("Deteriorating")).withColumn("imp_count", count("Improving"))
        .withColumn("status_recomputed", status_of(c("det_count")))
        .withColumn("reconciled", c("status_recomputed") == c("watchlist_status"))
    )


def recovered_baseline(stored: DataFrame) -> DataFrame:
    """Early duplicate rate implied by the percentage in the reason text (before rounding)."""
    pct = F.regexp_extract("watchlist_reason", "Duplicate rate increased ([0-9.]+)%", 1)
    value = F.when(pct != "", pct.try_cast("double"))
    return stored.select(
        "dataset_id", "duplicate_rate_early", "duplicate_rate_recent", value.alias("reported_pct"),
        rounded(F.col("duplicate_rate_recent") / (F.lit(1.0) + value / F.lit(100.0)), 5).alias("implied_early"),
    ).filter(F.col("reported_pct").isNotNull())


def floor_check(rates: DataFrame, floor: float = V.TREND_FLOOR) -> DataFrame:
    """Smallest early rate per signal and whether the floor ever binds."""
    mins = rates.agg(*[F.min(f"{r}_early").alias(f"min_{r}_early") for r in SIGNALS.values()])
    lowest = F.least(*[F.col(f"min_{r}_early") for r in SIGNALS.values()])
    return mins.select(
        *[rounded(F.col(f"min_{r}_early"), 6).alias(f"min_{r}_early") for r in SIGNALS.values()], (lowest < floor).alias("floor_binds")
    )


SUMS = ("rate_hundredths", "rate_tests", "null_cells", "cells", "dup_rows", "profiled_rows")


def daily_rows(tests: DataFrame, profile: DataFrame) -> DataFrame:
    """What the watchlist of any date is summed from: one row per dataset and day."""
    return daily_failures(tests).join(profile, ["dataset_id", "test_date"], "full")


def _rates_of(sums: dict[str, Column], sketch: Column | None, name: str) -> dict[str, Column]:
    repeats = sums["dup_rows"] if sketch is None else _repeats(sums["profiled_rows"], sketch)
    return {
        f"control_failure_rate_{name}": _mean(sums["rate_hundredths"], sums["rate_tests"]),
        f"null_rate_{name}": _rate(sums["null_cells"], sums["cells"]),
        f"duplicate_rate_{name}": _rate(repeats, sums["profiled_rows"])}


def _judged(rates: DataFrame) -> DataFrame:
    known = rates.dropna(subset=[f"{n}_{p}" for n in SIGNALS.values() for p in ("early", "recent")])
    return signal_counts(add_trends(known)).withColumn("watchlist_status", status_of(F.col("det_count")))


def status_on(days: DataFrame, day: Column, split: int = V.TREND_SPLIT_DAYS, early_days: int = V.TREND_SPLIT_DAYS) -> DataFrame:
    """Status on one day of every dataset that has a row on it, from the ``daily_rows`` of its two periods."""
    c = F.col
    aggs = [F.bool_or(c("test_date") == day).alias("_today")]
    for name, period in zip(("early", "recent"), _periods(day, split, early_days)):
        sums = {m: F.sum(F.when(period, c(m))) for m in SUMS}
        sketch = F.theta_union_agg(F.when(period, c("key_sketch")), F.lit(SKETCH)) if "key_sketch" in days.columns else None
        aggs += [v.alias(k) for k, v in _rates_of(sums, sketch, name).items()]
    return _judged(days.groupBy("dataset_id").agg(*aggs).filter("_today").drop("_today").withColumn("test_date", day))


def history(tests: DataFrame, profile: DataFrame, early=(-29, -15), recent=(-14, 0)) -> DataFrame:
    """Watchlist status of every dataset on every day, from rolling windows.

    Runs over one row per (dataset, day); the windows are partitioned by dataset. With sketches
    in the profile, repeats are those over the whole window: the sketches of its days are merged.
    """
    out = daily_rows(tests, profile).withColumn("_day", F.unix_date("test_date"))
    for name, (lo, hi) in {"early": early, "recent": recent}.items():
        w = Window.partitionBy("dataset_id").orderBy("_day").rangeBetween(lo, hi)
        sketch = F.theta_union_agg("key_sketch", F.lit(SKETCH)).over(w) if "key_sketch" in profile.columns else None
        out = out.withColumns(_rates_of({m: F.sum(m).over(w) for m in SUMS}, sketch, name))
    return _judged(out)


def lead_time(hist: DataFrame, first_exceptions: DataFrame) -> DataFrame:
    """Days from a dataset's first watchlist or monitor flag to its first exception."""
    flags = hist.filter(F.col("watchlist_status") != "Clear").groupBy("dataset_id").agg(F.min("test_date").alias("first_flag"))
    return flags.join(first_exceptions, "dataset_id", "left").withColumn("lead_days", F.date_diff("first_exception", "first_flag"))


def newly_raised(before: DataFrame, after: DataFrame) -> DataFrame:
    """High-priority entries of the later watchlist that the earlier one did not have."""
    high = F.col("priority") == "High"
    return after.filter(high).join(before.filter(high).select("dataset_id"), "dataset_id", "left_anti")
