"""Exception detection over the control-test history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.exprs import as_of_date, hundredths, known_by, numbered, percent, rounded


def pair_states(tests: DataFrame, as_of=None, recent_days: int = V.RECENT_DAYS, last: int = V.REPEAT_LAST_TESTS) -> DataFrame:
    """One row per (dataset, rule): first failure in the recent window and the latest tests.

    The history is shuffled once on (dataset, rule); the aggregation reuses that
    partitioning. A window partition holds one row per test day of a pair.
    """
    start = F.date_sub(as_of_date(tests, as_of), recent_days)
    tests = known_by(tests, as_of)
    c = F.col
    w = Window.partitionBy("dataset_id", "rule_id").orderBy(c("test_date").desc())
    fails = c("status") == "Fail"
    latest = c("_rn") <= last
    return (
        tests.select("dataset_id", "rule_id", "test_date", "status", "failure_rate")
        .withColumn("_rn", F.row_number().over(w))
        .groupBy("dataset_id", "rule_id")
        .agg(
            F.min(F.when(fails & (c("test_date") >= start), F.struct("test_date", "failure_rate"))).alias("first_fail"),
            F.count_if(latest).alias("latest_tests"),
            F.count_if(latest & fails).alias("latest_fails"),
            F.sum(F.when(latest, hundredths(c("failure_rate")))).alias("latest_hundredths"),
        )
    )


def detect(
    tests: DataFrame,
    rulebook: DataFrame,
    inventory: DataFrame,
    as_of=None,
    recent_days: int = V.RECENT_DAYS,
    last: int = V.REPEAT_LAST_TESTS,
    min_fails: int = V.REPEAT_MIN_FAILS,
    with_ids: bool = True,
) -> DataFrame:
    """Critical, repeated and regulatory exceptions from one pass over the pair states.

    All three kinds are read off the same row, so no anti join against earlier kinds and
    no second scan of the history is needed.
    """
    c = F.col
    states = pair_states(tests, as_of, recent_days, last)
    rules = rulebook.select("rule_id", "rule_name", c("severity").alias("rule_severity"))
    info = inventory.select("dataset_id", "dataset_name", "regulatory_criticality", "owner", "steward")
    rows = states.join(rules, "rule_id").join(info, "dataset_id")
    failing = c("first_fail").isNotNull()
    # earliest failing pair of a dataset: its window holds one row per rule
    w = Window.partitionBy("dataset_id").orderBy(F.asc_nulls_last("first_fail.test_date"), "rule_id")
    rows = rows.withColumn("_nth", F.row_number().over(w))

    critical = failing & (c("rule_severity") == "Critical")
    repeated = (c("latest_tests") >= min_fails) & (c("latest_fails") >= min_fails) & ~critical
    regulatory = failing & (c("regulatory_criticality") == "High") & (c("_nth") == 1)

    def kind(rank: int, name: str, severity: Column, priority: int, rate: Column, action: Column) -> Column:
        return F.struct(
            F.lit(rank).alias("type_rank"), F.lit(name).alias("exception_type"), severity.alias("severity"),
            F.lit(priority).alias("priority"), rate.alias("failure_rate"), action.alias("recommended_action"),
        )

    mean_latest = rounded(c("latest_hundredths") / (F.lit(100.0) * c("latest_tests")), 2)
    kinds = F.array_compact(F.array(
        F.when(critical, kind(1, V.CRITICAL_FAILURE, F.lit("Critical"), 1, c("first_fail.failure_rate"),
                              F.concat(F.lit(V.CRITICAL_ACTION[0]), "owner", F.lit(V.CRITICAL_ACTION[1])))),
        F.when(repeated, kind(2, V.REPEATED_FAILURE,
                              F.when(c("rule_severity").isin("Critical", "High"), "High").otherwise("Medium"), 2, mean_latest,
                              F.concat(F.lit(V.REPEATED_ACTION[0]), "steward", F.lit(V.REPEATED_ACTION[1])))),
        F.when(regulatory, kind(3, V.REGULATORY_ISSUE, F.lit("Critical"), 1, c("first_fail.failure_rate"), F.lit(V.REGULATORY_ACTION))),
    ))
    found = rows.select("dataset_id", "dataset_name", "rule_id", "rule_name", "regulatory_criticality", F.inline(kinds))
    found = found.withColumn("detected_date", as_of_date(tests, as_of))
    if with_ids:
        found = numbered(found, "exception_id", "EXC-%04d", ["type_rank", "dataset_id"], ["rule_id"])
    return found


EXCEPTION_COLUMNS = [
    "exception_id", "exception_type", "dataset_id", "dataset_name", "rule_id", "rule_name", "severity", "priority",
    "detected_date", "failure_rate", "regulatory_criticality", "recommended_action",
]


def watchlist_coverage(exceptions: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Exceptions per watchlist status and their share of all exceptions."""
    per_dataset = exceptions.groupBy("dataset_id").agg(F.count("*").alias("n"))
    joined = per_dataset.join(watchlist.select("dataset_id", "watchlist_status"), "dataset_id", "left")
    counts = joined.groupBy(F.coalesce("watchlist_status", F.lit("None")).alias("watchlist_status")).agg(F.sum("n").alias("exceptions"))
    total = F.sum("exceptions").over(Window.partitionBy())
    return counts.withColumn("pct", percent(F.col("exceptions"), total, 1))


def exception_counts(exceptions: DataFrame) -> DataFrame:
    """Counts by type, severity, criticality and dataset, with share of the total, in one pass."""
    c = F.col
    dims = ["exception_type", "severity", "regulatory_criticality", "dataset_name"]
    sets = exceptions.groupingSets([[c(d)] for d in dims], *[c(d) for d in dims]).agg(
        F.count("*").alias("exceptions"), F.grouping_id().alias("_gid")
    )
    # exactly one of the four bits is clear in each set
    name = F.element_at(F.create_map(*[x for i, d in enumerate(dims) for x in (F.lit(15 - (8 >> i)), F.lit(d))]), c("_gid").cast("int"))
    total = F.sum("exceptions").over(Window.partitionBy("_gid"))
    return sets.select(
        name.alias("dimension"), F.coalesce(*dims).alias("value"), "exceptions", percent(c("exceptions"), total, 1).alias("pct")
    )
