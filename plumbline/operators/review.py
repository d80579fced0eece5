"""Facts of the monthly governance review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.exprs import percent

c = F.col


def business_risk(critical: Column, trust: Column) -> Column:
    return F.when((critical > 3) | (trust < 75), "High").when((critical > 0) | (trust < 85), "Medium").otherwise("Low")


def scalars(trust: DataFrame, watchlist: DataFrame, exceptions: DataFrame, tickets: DataFrame) -> DataFrame:
    """One row: overall trust and category, watchlist, critical exceptions, breaches, compliance."""
    enterprise = trust.filter(c("domain") == V.ENTERPRISE).select(c("trust_score").alias("overall_trust"), c("trust_category").alias("overall_category"))
    wl = watchlist.agg(F.count_if(c("watchlist_status") == "Watchlist").alias("v")).scalar()
    crit = exceptions.agg(F.count_if(c("severity") == "Critical").alias("v")).scalar()
    t = tickets.agg(F.struct(F.count_if("sla_breach").alias("b"), F.count("*").alias("n")).alias("v")).scalar()
    return enterprise.select("overall_trust", "overall_category", wl.alias("watchlist_count"), crit.alias("critical_exceptions"), t.alias("_t")).select(
        "overall_trust", "overall_category", "watchlist_count", "critical_exceptions", c("_t.b").alias("sla_breaches"),
        percent(c("_t.n") - c("_t.b"), c("_t.n"), 1, 100.0).alias("sla_compliance"))


def _joined(names: Column) -> Column:
    return F.array_join(F.sort_array(F.collect_set(names)), ", ")


def names(watchlist: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Watchlist dataset names and distinct names with critical exceptions.

    A set of dataset names is bounded by the inventory.
    """
    crit = exceptions.agg(_joined(F.when(c("severity") == "Critical", c("dataset_name"))).alias("v")).scalar()
    return watchlist.agg(_joined(F.when(c("watchlist_status") == "Watchlist", c("dataset_name"))).alias("watchlist_datasets")).select(
        "watchlist_datasets", crit.alias("critical_datasets"))


def leading_root_cause(tickets: DataFrame) -> DataFrame:
    """Most frequent root cause; ties go to the first name."""
    return tickets.groupBy("root_cause").agg(F.count("*").alias("tickets")).orderBy(c("tickets").desc(), "root_cause").limit(1)


def actions(facts: DataFrame, listed: DataFrame) -> DataFrame:
    """Conditional action list in order, from the review scalars and the dataset names."""
    row = facts.withColumn("_names", listed.select("watchlist_datasets").scalar())

    def item(key: str, text: Column | None = None, when: Column | None = None) -> Column:
        priority, fixed = V.REVIEW_ACTIONS[key]
        s = F.struct(F.lit(priority).alias("priority"), (F.lit(fixed) if text is None else text).alias("action"))
        return s if when is None else F.when(when, s)

    def filled(key: str, value: Column) -> Column:
        return F.format_string(V.REVIEW_ACTIONS[key][1], value)

    items = F.array_compact(F.array(
        item("critical", filled("critical", c("critical_exceptions")), c("critical_exceptions") > 0),
        item("watchlist", filled("watchlist", c("_names")), c("watchlist_count") > 0),
        item("breach", filled("breach", c("sla_breaches")), c("sla_breaches") > 0),
        item("feeds"), item("timeliness"), item("maturity"),
    ))
    return row.select(F.posexplode(items).alias("position", "item")).select((c("position") + 1).alias("position"), "item.priority", "item.action")


def current_vs_target(facts: DataFrame, maturity: DataFrame) -> DataFrame:
    """Metric, current value and target as text rows."""
    level = maturity.select("maturity_level").scalar()
    row = facts.withColumn("_level", level)
    rows = (
        ("Data Trust Score", F.format_string("%.1f/100", "overall_trust"), "90+/100"),
        ("Datasets on Watchlist", c("watchlist_count").cast("string"), "0"),
        ("Critical Exceptions", c("critical_exceptions").cast("string"), "0"),
        ("SLA Compliance", F.format_string("%.1f%%", "sla_compliance"), "98%+"),
        ("Governance Maturity", c("_level"), "Managed"),
    )
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(m).alias("metric"), v.alias("current_value"), F.lit(t).alias("target")) for i, (m, v, t) in enumerate(rows, 1)])))
