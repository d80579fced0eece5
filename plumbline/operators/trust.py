"""Domain trust scores and governance maturity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.exprs import add_all, as_of_date, banded, hundredths, known_by, percent, rounded, scalar


def dataset_effectiveness(tests: DataFrame, as_of=None, recent_days: int | None = V.RECENT_DAYS) -> DataFrame:
    """Additive effectiveness sums per dataset over the recent window (both ends inclusive)."""
    known = known_by(tests, as_of)
    if recent_days is not None:
        known = known.filter(F.col("test_date") >= F.date_sub(as_of_date(tests, as_of), recent_days))
    return known.groupBy("dataset_id").agg(
        F.sum(hundredths(F.col("control_effectiveness"))).alias("eff_hundredths"),
        F.count("*").alias("eff_tests"),
        F.count_if(F.col("status") == "Pass").alias("passes"),
    )


def domain_effectiveness(tests: DataFrame, inventory: DataFrame, as_of=None) -> DataFrame:
    """Mean effectiveness per domain; test rows are reduced to datasets before the join."""
    c = F.col
    return (
        dataset_effectiveness(tests, as_of).join(inventory.select("dataset_id", "domain"), "dataset_id")
        .groupBy("domain").agg((F.sum("eff_hundredths") / (F.lit(100.0) * F.sum("eff_tests"))).alias("avg_control_effectiveness"),
                               F.sum("eff_tests").alias("tests"), F.sum("passes").alias("passes"))
    )


def flag_counts(watchlist: DataFrame) -> DataFrame:
    """Watchlist and monitor datasets per domain."""
    return watchlist.groupBy("domain").agg(
        F.count_if(F.col("watchlist_status") == "Watchlist").alias("watchlist_count"),
        F.count_if(F.col("watchlist_status") == "Monitor").alias("monitor_count"),
    )


def trust_formula(eff: Column, watch: Column, monitor: Column) -> Column:
    lost = F.lit(float(V.WATCHLIST_PENALTY)) * watch + F.lit(float(V.MONITOR_PENALTY)) * monitor
    return F.least(F.greatest(eff - lost, F.lit(0.0)), F.lit(100.0))


def trust_category(score: Column) -> Column:
    return banded(score, V.TRUST_BANDS, "At Risk")


def domain_trust_exact(tests: DataFrame, watchlist: DataFrame, inventory: DataFrame, as_of=None) -> DataFrame:
    """Unrounded trust per domain; the category comes from the unrounded score."""
    c = F.col
    sizes = inventory.groupBy("domain").agg(F.count("*").alias("dataset_count"))
    return (
        domain_effectiveness(tests, inventory, as_of)
        .join(flag_counts(watchlist), "domain", "left").join(sizes, "domain")
        .fillna(0, ["watchlist_count", "monitor_count"])
        .withColumn("trust_score", trust_formula(c("avg_control_effectiveness"), c("watchlist_count"), c("monitor_count")))
    )


TRUST_COLUMNS = ["domain", "trust_score", "trust_category", "avg_control_effectiveness", "dataset_count"]


def presented(exact: DataFrame) -> DataFrame:
    c = F.col
    return exact.withColumn("trust_category", trust_category(c("trust_score"))).withColumn(
        "trust_score", rounded(c("trust_score"), 1)
    ).withColumn("avg_control_effectiveness", rounded(c("avg_control_effectiveness"), 1))


def trust_scores(tests: DataFrame, watchlist: DataFrame, inventory: DataFrame, as_of=None) -> DataFrame:
    """Domain rows plus the enterprise row: the mean of the unrounded domain scores.

    The domain and the enterprise row come from one rollup over the few domain rows.
    """
    exact = domain_trust_exact(tests, watchlist, inventory, as_of)
    rolled = exact.rollup("domain").agg(
        F.avg("trust_score").alias("trust_score"), F.avg("avg_control_effectiveness").alias("avg_control_effectiveness"),
        F.sum("dataset_count").alias("dataset_count"),
    )
    everything = scalar(inventory, F.count("*"))
    rolled = rolled.withColumn("dataset_count", F.when(F.col("domain").isNull(), everything).otherwise(F.col("dataset_count")))
    rolled = rolled.withColumn("domain", F.coalesce("domain", F.lit(V.ENTERPRISE)))
    return presented(rolled).select(*TRUST_COLUMNS)


def maturity(coverage: Column, sla_compliance: Column, automation: float = V.AUTOMATION_PCT, audit: float = V.AUDIT_COMPLETENESS) -> dict[str, Column]:
    return {
        "control_coverage": coverage,
        "automation_pct": F.lit(automation),
        "sla_compliance": sla_compliance,
        "audit_completeness": F.lit(audit),
    }


def coverage(bridge: DataFrame, inventory: DataFrame, rulebook: DataFrame) -> DataFrame:
    """Share of datasets with a control, and of rules that run anywhere."""
    used_ds, used_rules = bridge.select("dataset_id").distinct(), bridge.select("rule_id").distinct()
    ds = inventory.select("dataset_id").join(used_ds.withColumn("_u", F.lit(1)), "dataset_id", "left").agg(
        F.count("*").alias("datasets"), F.count("_u").alias("mapped_datasets"))
    rules = rulebook.select("rule_id").join(used_rules.withColumn("_u", F.lit(1)), "rule_id", "left").agg(
        F.count("*").alias("rules"), F.count("_u").alias("mapped_rules"))
    out = ds.select("datasets", "mapped_datasets", rules.select("rules").scalar().alias("rules"), rules.select("mapped_rules").scalar().alias("mapped_rules"))
    return out.withColumn("control_coverage", percent(F.col("mapped_datasets"), F.col("datasets"), 1)).withColumn(
        "rule_coverage", percent(F.col("mapped_rules"), F.col("rules"), 1))


def sla_compliance(tickets: DataFrame, empty: float = 100.0) -> DataFrame:
    """Share of tickets not in breach; 100 when there are none."""
    kept = F.count_if(~F.col("sla_breach"))
    return tickets.agg(percent(kept, F.count("*"), 1, empty).alias("sla_compliance"))


def governance_maturity(bridge: DataFrame, inventory: DataFrame, rulebook: DataFrame, tickets: DataFrame) -> DataFrame:
    """Weighted maturity score and level."""
    covered = coverage(bridge, inventory, rulebook).select("control_coverage")
    parts = maturity(F.col("control_coverage"), sla_compliance(tickets).scalar())
    row = covered.select(*[v.alias(k) for k, v in parts.items()])
    score = add_all([F.col(k) * F.lit(w) for k, w in V.MATURITY_WEIGHTS.items()])
    return row.withColumn("_s", score).select(
        rounded(F.col("_s"), 1).alias("maturity_score"), banded(F.col("_s"), V.MATURITY_BANDS, "Initial").alias("maturity_level"), *parts
    )


def maturity_gap(row: DataFrame) -> DataFrame:
    """Contribution of each input and the SLA compliance that would lift the score to the next level."""
    c = F.col
    score = add_all([c(k) * F.lit(w) for k, w in V.MATURITY_WEIGHTS.items()])
    base = row.withColumn("_s", score)
    target = F.when(c("_s") < 60, 60.0).when(c("_s") < 75, 75.0).when(c("_s") < 90, 90.0)
    need = c("sla_compliance") + (target - c("_s")) / F.lit(V.MATURITY_WEIGHTS["sla_compliance"])
    items = F.array(*[
        F.struct(F.lit(k).alias("component"), c(k).alias("value"), F.lit(w).alias("weight"), rounded(c(k) * F.lit(w), 3).alias("contribution"))
        for k, w in V.MATURITY_WEIGHTS.items()
    ])
    return base.withColumn("gap_to_next", rounded(target - c("_s"), 3)).withColumn("sla_needed", rounded(need, 1)).select(
        F.inline(items), "gap_to_next", "sla_needed")


def without_penalty(exact: DataFrame) -> DataFrame:
    """Enterprise score as it is and with every flag cleared."""
    return exact.agg(
        rounded(F.avg("trust_score"), 1).alias("enterprise_score"),
        rounded(F.avg("avg_control_effectiveness"), 1).alias("enterprise_score_if_no_penalty"),
    )


def total_failures(tests: DataFrame, inventory: DataFrame, as_of=None, recent_days: int | None = None) -> DataFrame:
    """Per domain: datasets whose every test failed, over the full history or a trailing window."""
    c = F.col
    per_dataset = dataset_effectiveness(tests, as_of, recent_days)
    return per_dataset.join(inventory.select("dataset_id", "domain"), "dataset_id").groupBy("domain").agg(
        F.count_if(c("passes") == 0).alias("all_fail_datasets"))


def binary_floor(trust: DataFrame, failures: DataFrame) -> DataFrame:
    """A domain with a dataset that failed every test scores 0 and is At Risk."""
    c = F.col
    hit = F.coalesce(c("all_fail_datasets"), F.lit(0)) > 0
    return trust.filter(c("domain") != V.ENTERPRISE).join(failures, "domain", "left").select(
        "domain", c("trust_score").alias("current_score"), c("trust_category").alias("current_category"),
        F.coalesce("all_fail_datasets", F.lit(0)).alias("all_fail_datasets"),
        F.when(hit, 0.0).otherwise(c("trust_score")).alias("fixed_score"),
        F.when(hit, "At Risk").otherwise(c("trust_category")).alias("fixed_category"),
    )


def simple_compliance(trust: DataFrame, tests: DataFrame, inventory: DataFrame, as_of=None) -> DataFrame:
    """Trust score next to the plain pass rate of the same window; the enterprise row has none."""
    c = F.col
    simple = domain_effectiveness(tests, inventory, as_of).select("domain", percent(c("passes"), c("tests"), 1).alias("simple_compliance_rate"))
    return trust.join(simple, "domain", "left").select(
        "domain", c("trust_score").alias("current_formula_score"), c("trust_category").alias("current_category"), "simple_compliance_rate")


def trust_history(tests: DataFrame, watch_history: DataFrame, inventory: DataFrame, recent_days: int = V.RECENT_DAYS) -> DataFrame:
    """Trust per (domain, day) with a trailing window and that day's watchlist flags."""
    c = F.col
    info = inventory.select("dataset_id", "domain")
    daily = (
        tests.groupBy("dataset_id", "test_date")
        .agg(F.sum(hundredths(c("control_effectiveness"))).alias("_h"), F.count("*").alias("_n"))
        .join(info, "dataset_id").groupBy("domain", "test_date").agg(F.sum("_h").alias("_h"), F.sum("_n").alias("_n"))
        .withColumn("_day", F.unix_date("test_date"))
    )
    w = Window.partitionBy("domain").orderBy("_day").rangeBetween(-recent_days, 0)
    eff = daily.withColumn("_eff", F.sum("_h").over(w) / (F.lit(100.0) * F.sum("_n").over(w)))
    flags = watch_history.join(info, "dataset_id").groupBy("domain", "test_date").agg(
        F.count_if(c("watchlist_status") == "Watchlist").alias("_w"), F.count_if(c("watchlist_status") == "Monitor").alias("_m"))
    both = eff.join(flags, ["domain", "test_date"], "left").fillna(0, ["_w", "_m"])
    return both.select("domain", "test_date", trust_formula(c("_eff"), c("_w"), c("_m")).alias("trust_score"))


def swings(hist: DataFrame, points: float = 5.0) -> DataFrame:
    """Consecutive scores of a domain that differ by more than ``points``."""
    prev = F.lag("trust_score").over(Window.partitionBy("domain").orderBy("test_date"))
    c = F.col
    return hist.withColumn("previous_score", prev).withColumn("swing", c("trust_score") - c("previous_score")).filter(
        F.abs("swing") > points
    ).select("domain", "test_date", rounded(c("previous_score"), 1).alias("previous_score"), rounded(c("trust_score"), 1).alias("trust_score"), rounded(c("swing"), 2).alias("swing"))
