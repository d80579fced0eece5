"""Remediation tickets and SLA tracking.

A ticket table may be as large as any fact table. Everything here is a row expression
or an additive count; joins meet pre-counted keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.exprs import percent, ranked, rounded

RESOLVED = "Resolved"


def sla_days(severity: Column, days: dict = V.SLA_DAYS, default: int = V.DEFAULT_SLA_DAYS) -> Column:
    return ranked(severity, days, default)


def is_breached(as_of: Column, sla_date: Column, status: Column) -> Column:
    return (as_of > sla_date) & (status != RESOLVED)


def raise_tickets(exceptions: DataFrame, as_of: Column, open_date: Column, status: Column, owner: Column, root_cause: Column, resolution: Column) -> DataFrame:
    """One ticket per exception; workflow fields come as columns over the exception rows.

    The ticket number is the exception number, so no second numbering is needed.
    """
    c = F.col
    out = exceptions.withColumns({"status": status, "owner": owner, "root_cause": root_cause, "open_date": open_date})
    out = out.withColumns({
        "ticket_id": F.concat(F.lit("REM-"), F.substring_index("exception_id", "-", -1)),
        "sla_date": F.date_add("open_date", sla_days(c("severity"))),
        "resolution_date": F.when(c("status") == RESOLVED, resolution),
        "verification_status": F.when(c("status") == RESOLVED, "Verified").otherwise("Pending"),
        "notes": F.concat(F.lit("Ticket raised for "), "exception_type", F.lit(" on "), "dataset_name", F.lit(".")),
    })
    return out.withColumn("sla_breach", is_breached(as_of, c("sla_date"), c("status"))).select(*TICKET_COLUMNS)


TICKET_COLUMNS = [
    "ticket_id", "exception_id", "dataset_id", "dataset_name", "rule_id", "rule_name", "severity", "status", "owner",
    "open_date", "sla_date", "sla_breach", "root_cause", "resolution_date", "verification_status", "notes",
]


def with_sla(tickets: DataFrame, as_of: Column) -> DataFrame:
    """Add sla_date and the breach flag as of a date to (severity, status, open_date) rows."""
    out = tickets.withColumn("sla_date", F.date_add("open_date", sla_days(F.col("severity"))))
    return out.withColumn("sla_breach", is_breached(as_of, F.col("sla_date"), F.col("status")))


def sla_tracking(tickets: DataFrame, as_of: Column) -> DataFrame:
    """Days open, SLA status and days overdue per ticket, evaluated at ``as_of``."""
    c = F.col
    late = as_of > c("sla_date")
    return tickets.withColumns({
        "sla_threshold_days": sla_days(c("severity")),
        "days_open": F.date_diff(as_of, c("open_date")),
        "sla_status": F.when(c("status") == RESOLVED, "ON_TIME").when(late, "OVERDUE").otherwise("OPEN"),
        "days_overdue": F.when(late & (c("status") != RESOLVED), F.date_diff(as_of, c("sla_date"))).otherwise(0),
    })


def stored_vs_live(tickets: DataFrame, as_of: Column) -> DataFrame:
    """How many stored breach flags disagree with the flag evaluated now."""
    live = is_breached(as_of, F.col("sla_date"), F.col("status"))
    return tickets.agg(
        F.count("*").alias("tickets"), F.count_if(live != F.col("sla_breach")).alias("mismatches"),
        F.count_if(live).alias("live_breaches"), F.count_if("sla_breach").alias("stored_breaches"),
    )


def breach_by(tickets: DataFrame, key: Column) -> DataFrame:
    """Breach and resolution rate by severity or any other key."""
    resolved = F.col("status") == RESOLVED
    g = tickets.groupBy(key).agg(
        F.count("*").alias("total"), F.count_if("sla_breach").alias("breached"), F.count_if(resolved).alias("ever_resolved"))
    return g.withColumn("breach_rate", percent(F.col("breached"), F.col("total"), 1)).withColumn(
        "pct_ever_resolved", percent(F.col("ever_resolved"), F.col("total"), 1))


def breach_by_weekday(tickets: DataFrame) -> DataFrame:
    """Breach rate by weekday opened (0 = Sunday)."""
    out = breach_by(tickets, (F.dayofweek("open_date") - 1).alias("weekday"))
    return out.select("weekday", "total", "breached", "breach_rate")


def resolution_time(tickets: DataFrame) -> DataFrame:
    """Mean days to resolution by severity and overall, in one pass."""
    days = F.date_diff("resolution_date", "open_date")
    solved = tickets.filter((F.col("status") == RESOLVED) & F.col("resolution_date").isNotNull())
    return solved.rollup("severity").agg(F.count("*").alias("resolved"), F.sum(days).alias("_d")).select(
        F.coalesce("severity", F.lit("All")).alias("severity"), "resolved",
        rounded(F.col("_d") / F.col("resolved"), 4).alias("mean_days"))


def failure_counts(tests: DataFrame) -> DataFrame:
    return tests.filter(F.col("status") == "Fail").groupBy("dataset_id", "rule_id").agg(F.count("*").alias("failure_count"))


def chronic_tickets(tests: DataFrame, tickets: DataFrame, min_fails: int = V.CHRONIC_MIN_FAILS) -> DataFrame:
    """Pairs that nearly always fail, with the number of tickets they ever got."""
    chronic = failure_counts(tests).filter(F.col("failure_count") >= min_fails)
    per_pair = tickets.groupBy("dataset_id", "rule_id").agg(F.count("*").alias("tickets"))
    return chronic.join(per_pair, ["dataset_id", "rule_id"], "left").fillna(0, ["tickets"])


def next_severity(severity: Column) -> Column:
    return F.when(severity == "Low", "Medium").when(severity == "Medium", "High").otherwise("Critical")


def escalate_chronic(tests: DataFrame, rulebook: DataFrame, min_fails: int = V.CHRONIC_MIN_FAILS) -> DataFrame:
    """Raise the severity of pairs whose failure count reaches the limit."""
    chronic = failure_counts(tests).filter(F.col("failure_count") >= min_fails)
    return chronic.join(rulebook.select("rule_id", "rule_name", "severity"), "rule_id").select(
        "dataset_id", "rule_id", "rule_name", "failure_count", F.col("severity").alias("current_severity"),
        next_severity(F.col("severity")).alias("escalated_severity"))


def failure_streaks(tests: DataFrame) -> DataFrame:
    """Runs of consecutive failing days per (dataset, rule).

    Gaps and islands: the day number minus its rank is constant within a run. A window
    partition holds one row per failing day of a pair.
    """
    w = Window.partitionBy("dataset_id", "rule_id").orderBy("test_date")
    fails = tests.filter(F.col("status") == "Fail").select("dataset_id", "rule_id", "test_date")
    runs = fails.withColumn("_run", F.unix_date("test_date") - F.row_number().over(w))
    return runs.groupBy("dataset_id", "rule_id", "_run").agg(
        F.min("test_date").alias("streak_start"), F.max("test_date").alias("streak_end"), F.count("*").alias("streak_days")).drop("_run")


def escalate_streaks(tests: DataFrame, rulebook: DataFrame, min_days: int = V.STREAK_DAYS) -> DataFrame:
    """Raise the severity of pairs that failed ``min_days`` or more days in a row."""
    longest = failure_streaks(tests).groupBy("dataset_id", "rule_id").agg(F.max("streak_days").alias("longest_streak"))
    return longest.filter(F.col("longest_streak") >= min_days).join(rulebook.select("rule_id", "severity"), "rule_id").select(
        "dataset_id", "rule_id", "longest_streak", F.col("severity").alias("current_severity"), next_severity(F.col("severity")).alias("escalated_severity"))


def stacked_by_severity(tickets: DataFrame) -> DataFrame:
    """Resolved / overdue / on-track counts by severity; resolved-late as an extra column."""
    c = F.col
    bucket = F.when(c("status") == RESOLVED, "resolved").when(c("sla_breach"), "overdue").otherwise("on_track")
    late = (c("status") == RESOLVED) & F.coalesce(c("resolution_date") > c("sla_date"), F.lit(False))
    pivoted = tickets.withColumn("_b", bucket).withColumn("_late", late.cast("int")).groupBy("severity").pivot("_b", ["resolved", "overdue", "on_track"]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_late").alias("late"))
    return pivoted.select(
        "severity", *[F.coalesce(f"{b}_n", F.lit(0)).alias(b) for b in ("resolved", "overdue", "on_track")],
        F.coalesce("resolved_late", F.lit(0)).alias("resolved_late"))


def distribution(tickets: DataFrame, columns: list[str]) -> DataFrame:
    """Count and share of every value of several columns, in one pass."""
    sets = tickets.groupingSets([[F.col(x)] for x in columns], *columns).agg(F.count("*").alias("tickets"), F.grouping_id().alias("_g"))
    full = 2 ** len(columns) - 1
    first = 2 ** (len(columns) - 1)
    name = F.element_at(F.create_map(*[x for i, d in enumerate(columns) for x in (F.lit(full - (first >> i)), F.lit(d))]), F.col("_g").cast("int"))
    total = F.sum("tickets").over(Window.partitionBy("_g"))
    return sets.select(name.alias("field"), F.coalesce(*columns).alias("value"), "tickets", percent(F.col("tickets"), total, 1).alias("pct"))


def verification_gap(tickets: DataFrame) -> DataFrame:
    """Resolved against verified: tickets closed without verification are the gap."""
    c = F.col
    resolved, verified = c("status") == RESOLVED, c("verification_status") == "Verified"
    return tickets.agg(
        F.count("*").alias("tickets"), F.count_if(resolved).alias("resolved"), F.count_if(verified).alias("verified"),
        F.count_if(~verified).alias("pending"), F.count_if(resolved & ~verified).alias("resolved_unverified"))


def reopened(tickets: DataFrame, tests: DataFrame) -> DataFrame:
    """Closed tickets whose control failed again after the resolution date.

    The match is on the pair; the date condition only filters within it, and a pair has
    one row per failing day.
    """
    closed = tickets.filter((F.col("status") == RESOLVED) & F.col("resolution_date").isNotNull()).select("ticket_id", "dataset_id", "rule_id", "resolution_date")
    fails = tests.filter(F.col("status") == "Fail").select("dataset_id", "rule_id", "test_date")
    return (
        closed.join(fails, ["dataset_id", "rule_id"]).filter(F.col("test_date") > F.col("resolution_date"))
        .groupBy("ticket_id", "dataset_id", "rule_id", "resolution_date")
        .agg(F.count("*").alias("later_failures"), F.min("test_date").alias("first_later_failure")))


def tiered_sla(tickets: DataFrame, owner_key: str, criticality: DataFrame, as_of: Column, tight_hours: int = 12) -> DataFrame:
    """Breach rate per severity and criticality under the standard and a tighter SLA.

    The tighter SLA gives Critical tickets on High-criticality datasets ``tight_hours``.
    Tickets are counted per (owner key, severity) before criticality is joined on.
    """
    c = F.col
    hours_open = F.date_diff(as_of, c("open_date")) * 24
    live = c("status") != RESOLVED
    std = live & (hours_open > sla_days(c("severity")) * 24)
    tight = live & (hours_open > F.when(c("severity") == "Critical", F.lit(tight_hours)).otherwise(sla_days(c("severity")) * 24))
    counts = tickets.groupBy(owner_key, "severity").agg(
        F.count("*").alias("_n"), F.count_if(std).alias("_std"), F.count_if(tight).alias("_tight"))
    joined = counts.join(criticality, owner_key)
    is_high = c("regulatory_criticality") == "High"
    g = joined.groupBy("severity", "regulatory_criticality").agg(
        F.sum("_n").alias("tickets"), F.sum("_std").alias("standard_breaches"),
        F.sum(F.when(is_high, c("_tight")).otherwise(c("_std"))).alias("tiered_breaches"))
    return g.withColumn("standard_rate", percent(c("standard_breaches"), c("tickets"), 1)).withColumn("tiered_rate", percent(c("tiered_breaches"), c("tickets"), 1))
