"""Analysis and dashboard queries over the governance tables.

Inputs are the test history (one row per dataset, rule and day), the rulebook, the
inventory and the tables derived from them. Every query reduces the history to its own
keys before it joins anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.exprs import as_of_date, hundredths, known_by, percent, ranked, rounded

c = F.col
CRITICALITY_RANK = {"High": 0, "Medium": 1, "Low": 2}
PRIORITY_RANK = {"High": 0, "Medium": 1, "Low": 2}


def _fail() -> Column:
    return c("status") == "Fail"


def _pass() -> Column:
    return c("status") == "Pass"


def _mean(rate: str) -> Column:
    return F.sum(hundredths(c(rate))) / (F.lit(100.0) * F.count("*"))


def recent(tests: DataFrame, as_of=None, days: int = V.RECENT_DAYS) -> DataFrame:
    return known_by(tests, as_of).filter(c("test_date") >= F.date_sub(as_of_date(tests, as_of), days))


def tests_and_fails(tests: DataFrame, *keys) -> DataFrame:
    return tests.groupBy(*keys).agg(F.count("*").alias("tests_run"), F.count_if(_fail()).alias("fails"))


# ---- inventory and rulebook
def inventory_mix(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("category", "regulatory_criticality").agg(F.count("*").alias("dataset_count"))


def rulebook_mix(rulebook: DataFrame, weight: Column) -> DataFrame:
    """Counts by category and severity with all subtotals."""
    return rulebook.cube("category", "severity").agg(weight.alias("rules")).select(
        F.coalesce("category", F.lit("All")).alias("category"), F.coalesce("severity", F.lit("All")).alias("severity"), "rules")


def ungoverned(inventory: DataFrame, rulebook: DataFrame, bridge: DataFrame) -> DataFrame:
    """Datasets without a rule and rules without a dataset."""
    ds = inventory.select("dataset_id").join(bridge.select("dataset_id"), "dataset_id", "left_anti")
    rules = rulebook.select("rule_id").join(bridge.select("rule_id"), "rule_id", "left_anti")
    return ds.select(F.lit("dataset").alias("kind"), c("dataset_id").cast("string").alias("id")).unionByName(
        rules.select(F.lit("rule").alias("kind"), c("rule_id").alias("id")))


# ---- pass and fail rates
def fail_rate_by_dataset(tests: DataFrame) -> DataFrame:
    return tests_and_fails(tests, "dataset_id").withColumn("fail_rate_pct", percent(c("fails"), c("tests_run"), 1))


def status_mix(tests: DataFrame) -> DataFrame:
    n = tests.groupBy("status").agg(F.count("*").alias("n"))
    return n.withColumn("pct", percent(c("n"), F.sum("n").over(Window.partitionBy()), 1))


def fail_rate_by_category(tests: DataFrame, rulebook: DataFrame) -> DataFrame:
    per_rule = tests_and_fails(tests, "rule_id").join(rulebook.select("rule_id", "category"), "rule_id")
    g = per_rule.groupBy("category").agg(F.sum("tests_run").alias("total_tests"), F.sum("fails").alias("failures"))
    return g.withColumn("fail_rate", percent(c("failures"), c("total_tests"), 1))


def dataset_totals(tests: DataFrame, dataset_id=None) -> DataFrame:
    """Totals, fail rate and mean effectiveness; of one dataset when given."""
    if dataset_id is not None:
        tests = tests.filter(c("dataset_id") == dataset_id)
    g = tests.groupBy("dataset_id").agg(F.count("*").alias("total_tests"), F.count_if(_fail()).alias("fails"), _mean("control_effectiveness").alias("_e"))
    return g.select("dataset_id", "total_tests", "fails", percent(c("fails"), c("total_tests"), 1).alias("fail_rate"), rounded(c("_e"), 1).alias("avg_effectiveness"))


def rule_effectiveness(tests: DataFrame, rulebook: DataFrame, dataset_id=None) -> DataFrame:
    if dataset_id is not None:
        tests = tests.filter(c("dataset_id") == dataset_id)
    g = tests.groupBy("dataset_id", "rule_id").agg(_mean("control_effectiveness").alias("_e"), F.count("*").alias("n_tests"), F.count_if(_fail()).alias("fails"))
    return g.join(rulebook.select("rule_id", "rule_name", "threshold", "severity"), "rule_id").select(
        "dataset_id", "rule_id", "rule_name", "threshold", "severity", rounded(c("_e"), 2).alias("avg_eff"), "n_tests", "fails")


def controls_per_dataset(tests: DataFrame, catalog_size: Column) -> DataFrame:
    pairs = tests.select("dataset_id", "rule_id").distinct()
    g = pairs.groupBy("dataset_id").agg(F.count("*").alias("controls_assigned"))
    return g.withColumn("pct_of_catalog", percent(c("controls_assigned"), catalog_size, 1))


def failed_controls_recent(tests: DataFrame, as_of=None) -> DataFrame:
    pairs = recent(tests, as_of).filter(_fail()).select("rule_id", "dataset_id").distinct()
    return pairs.agg(F.count("*").alias("failed_controls"))


def mean_effectiveness_windows(tests: DataFrame, as_of=None) -> DataFrame:
    """Mean effectiveness over the last 7 and 30 days in one pass."""
    end = as_of_date(tests, as_of)
    units = hundredths(c("control_effectiveness"))

    def mean(days):
        inside = c("test_date") >= F.date_sub(end, days)
        return rounded(F.try_divide(F.sum(F.when(inside, units)), F.lit(100.0) * F.count_if(inside)), 1)

    return known_by(tests, as_of).agg(mean(7).alias("avg_effectiveness_7d"), mean(30).alias("avg_effectiveness_30d"))


def latest_day(tests: DataFrame) -> DataFrame:
    today = tests.filter(c("test_date") == as_of_date(tests, None))
    g = today.agg(F.count("*").alias("controls"), F.count_if(_pass()).alias("passed"), F.count_if(_fail()).alias("failed"))
    return g.withColumn("pass_rate", percent(c("passed"), c("controls"), 1))


def category_recent(tests: DataFrame, rulebook: DataFrame, as_of=None) -> DataFrame:
    g = recent(tests, as_of).groupBy("rule_id").agg(
        F.sum(hundredths(c("control_effectiveness"))).alias("_h"), F.count("*").alias("_n"), F.count_if(_fail()).alias("_f"))
    j = g.join(rulebook.select("rule_id", "category"), "rule_id").groupBy("category").agg(
        F.sum("_h").alias("_h"), F.sum("_n").alias("_n"), F.sum("_f").alias("fail_count"))
    return j.select("category", rounded(c("_h") / (F.lit(100.0) * c("_n")), 1).alias("avg_effectiveness"), "fail_count")


def daily_trend(tests: DataFrame) -> DataFrame:
    g = tests.groupBy("dataset_id", "test_date").agg(_mean("control_effectiveness").alias("_e"), F.count_if(_fail()).alias("fail_count"))
    return g.select("dataset_id", "test_date", rounded(c("_e"), 2).alias("avg_effectiveness"), "fail_count")


def scorecard(tests: DataFrame, inventory: DataFrame, as_of=None) -> DataFrame:
    """Per dataset over the recent window. Grouping by rule first makes the distinct count a plain count."""
    per_rule = recent(tests, as_of).groupBy("dataset_id", "rule_id").agg(
        F.count_if(_pass()).alias("_p"), F.count_if(_fail()).alias("_f"), F.sum(hundredths(c("control_effectiveness"))).alias("_h"), F.count("*").alias("_n"))
    g = per_rule.groupBy("dataset_id").agg(
        F.count("*").alias("controls_tested"), F.sum("_p").alias("passed"), F.sum("_f").alias("failed"), F.sum("_h").alias("_h"), F.sum("_n").alias("_n"))
    return g.join(inventory.select("dataset_id", "dataset_name", "domain", "regulatory_criticality"), "dataset_id").select(
        "dataset_id", "dataset_name", "domain", "regulatory_criticality", "controls_tested", "passed", "failed",
        rounded(c("_h") / (F.lit(100.0) * c("_n")), 1).alias("avg_effectiveness"))


def fails_by_severity_recent(tests: DataFrame, rulebook: DataFrame, as_of=None) -> DataFrame:
    per_rule = recent(tests, as_of).filter(_fail()).groupBy("rule_id").agg(F.count("*").alias("_n"))
    return per_rule.join(rulebook.select("rule_id", "severity"), "rule_id").groupBy("severity").agg(F.sum("_n").alias("fail_count"))


def daily_pass_rate(tests: DataFrame) -> DataFrame:
    g = tests.groupBy("test_date").agg(F.count("*").alias("tests"), F.count_if(_pass()).alias("passed"))
    return g.withColumn("pass_rate", percent(c("passed"), c("tests"), 2))


def pass_rate_range(daily: DataFrame) -> DataFrame:
    """Lowest, highest and mean daily rate, and the overall rate."""
    return daily.agg(
        F.min("pass_rate").alias("min_rate"), F.max("pass_rate").alias("max_rate"),
        rounded(F.sum(hundredths(c("pass_rate"))) / (F.lit(100.0) * F.count("*")), 2).alias("mean_rate"),
        rounded(F.lit(100.0) * F.sum("passed") / F.sum("tests"), 2).alias("overall_rate"))


def slice_by(tests: DataFrame, inventory: DataFrame, domains=None, criticalities=None) -> DataFrame:
    """Cross filter: keep the tests of datasets in the chosen domains and criticalities."""
    keep = inventory
    if domains:
        keep = keep.filter(c("domain").isin(*domains))
    if criticalities:
        keep = keep.filter(c("regulatory_criticality").isin(*criticalities))
    return tests.join(keep.select("dataset_id"), "dataset_id", "left_semi")


def top_failing_rules(tests: DataFrame, rulebook: DataFrame, top: int = 10) -> DataFrame:
    """Controls by failure count and by failure rate; the top ``top`` by count."""
    g = tests_and_fails(tests, "rule_id").withColumn("fail_rate", percent(c("fails"), c("tests_run"), 1))
    by_count = Window.orderBy(c("fails").desc(), "rule_id")
    by_rate = Window.orderBy(c("fail_rate").desc())
    ranked_rules = g.withColumn("count_rank", F.row_number().over(by_count)).withColumn("rate_rank", F.dense_rank().over(by_rate))
    return ranked_rules.filter(c("count_rank") <= top).join(rulebook.select("rule_id", "rule_name", "category", "severity"), "rule_id").select(
        "count_rank", "rule_id", "rule_name", "category", "severity", "fails", "tests_run", "fail_rate", "rate_rank")


def first_last_effectiveness(tests: DataFrame) -> DataFrame:
    """Mean effectiveness on the first and the last day and the change between them."""
    daily = tests.groupBy("test_date").agg(_mean("control_effectiveness").alias("_e"))
    g = daily.agg(F.min("test_date").alias("first_day"), F.max("test_date").alias("last_day"),
                  F.min_by("_e", "test_date").alias("_a"), F.max_by("_e", "test_date").alias("_b"))
    return g.select("first_day", "last_day", rounded(c("_a"), 2).alias("first_effectiveness"), rounded(c("_b"), 2).alias("last_effectiveness"),
                    rounded(c("_b") - c("_a"), 2).alias("change"))


def alert_volume(tests: DataFrame) -> DataFrame:
    """Mean number of tests and failures per day."""
    daily = tests_and_fails(tests, "test_date")
    return daily.agg(F.count("*").alias("days"), rounded(F.sum("tests_run") / F.count("*"), 2).alias("tests_per_day"),
                     rounded(F.sum("fails") / F.count("*"), 2).alias("fails_per_day"))


def missing_tests(tests: DataFrame, bridge: DataFrame) -> DataFrame:
    """Expected (dataset, rule, day) runs that have no result.

    Every mapped pair is expected on every day between the first and the last test day;
    the calendar is one scalar, exploded per pair.
    """
    span = tests.agg(F.sequence(F.min("test_date"), F.max("test_date")).alias("v")).scalar()
    expected = bridge.select("dataset_id", "rule_id", F.explode(span).alias("test_date"))
    return expected.join(tests.select("dataset_id", "rule_id", "test_date"), ["dataset_id", "rule_id", "test_date"], "left_anti")


def co_failures(tests: DataFrame) -> DataFrame:
    """Pairs of rules that fail on the same (dataset, day), with the share of common failures.

    A (dataset, day) holds one row per rule, so its failing rules form a set bounded by the
    rulebook. Equal sets are counted first; pairs are read off the distinct sets only.
    """
    fails = tests.filter(_fail())
    sets = fails.groupBy("dataset_id", "test_date").agg(F.sort_array(F.collect_set("rule_id")).alias("_rules"))
    sets = sets.groupBy("_rules").agg(F.count("*").alias("_times"))
    firsts = sets.select("_rules", "_times", F.posexplode("_rules").alias("_i", "rule_a"))
    pairs = firsts.select("rule_a", "_times", F.explode(F.expr("slice(_rules, _i + 2, size(_rules))")).alias("rule_b"))
    both = pairs.groupBy("rule_a", "rule_b").agg(F.sum("_times").alias("both_fail"))
    single = fails.groupBy("rule_id").agg(F.count("*").alias("_n"))
    out = both.join(single.select(c("rule_id").alias("rule_a"), c("_n").alias("a_fails")), "rule_a").join(
        single.select(c("rule_id").alias("rule_b"), c("_n").alias("b_fails")), "rule_b")
    return out.select("rule_a", "rule_b", "both_fail", "a_fails", "b_fails",
                      percent(c("both_fail"), c("a_fails") + c("b_fails") - c("both_fail"), 2).alias("overlap_pct"))


def driver_rules(tests: DataFrame, inventory: DataFrame, as_of=None, top: int = 3) -> DataFrame:
    """Per domain, the rules whose mean effectiveness fell most from the early to the recent period.

    The periods are those of the watchlist: the 15 days up to the date, and the 15 before them.
    """
    cut = F.date_sub(as_of_date(tests, as_of), V.TREND_SPLIT_DAYS)
    tests = tests.filter(c("test_date") > F.date_sub(cut, V.TREND_SPLIT_DAYS))
    early = c("test_date") <= cut
    units = hundredths(c("control_effectiveness"))
    per_pair = known_by(tests, as_of).groupBy("dataset_id", "rule_id").agg(
        F.coalesce(F.sum(F.when(early, units)), F.lit(0)).alias("_eh"), F.count_if(early).alias("_en"),
        F.coalesce(F.sum(F.when(~early, units)), F.lit(0)).alias("_rh"), F.count_if(~early).alias("_rn"))
    g = per_pair.join(inventory.select("dataset_id", "domain"), "dataset_id").groupBy("domain", "rule_id").agg(
        *[F.sum(x).alias(x) for x in ("_eh", "_en", "_rh", "_rn")])
    g = g.filter((c("_en") > 0) & (c("_rn") > 0)).withColumn(
        "change", rounded(c("_rh") / (F.lit(100.0) * c("_rn")) - c("_eh") / (F.lit(100.0) * c("_en")), 2))
    w = Window.partitionBy("domain").orderBy("change", "rule_id")
    return g.withColumn("driver_rank", F.row_number().over(w)).filter(c("driver_rank") <= top).select("domain", "rule_id", "change", "driver_rank")


def tier_targets(tests: DataFrame, inventory: DataFrame, targets: dict[str, float]) -> DataFrame:
    """Pass rate against a target that differs per criticality tier."""
    per_dataset = tests.groupBy("dataset_id").agg(F.count("*").alias("_n"), F.count_if(_pass()).alias("_p"))
    g = per_dataset.join(inventory.select("dataset_id", "regulatory_criticality"), "dataset_id").groupBy("regulatory_criticality").agg(
        F.sum("_n").alias("tests"), F.sum("_p").alias("passed"))
    target = ranked(c("regulatory_criticality"), targets, 0.0)
    return g.withColumn("pass_rate", percent(c("passed"), c("tests"), 1)).withColumn("target", target.cast("double")).withColumn(
        "gap", rounded(c("target") - c("pass_rate"), 1))


def near_breaches(tests: DataFrame, rulebook: DataFrame, margin: float) -> DataFrame:
    """Passing tests within ``margin`` points of their threshold."""
    j = tests.filter(_pass()).join(rulebook.select("rule_id", "threshold"), "rule_id")
    headroom = rounded(c("control_effectiveness") - c("threshold"), 2)
    return j.withColumn("headroom", headroom).filter(c("headroom").between(0.0, margin)).select(
        "test_id", "test_date", "dataset_id", "rule_id", "control_effectiveness", "threshold", "headroom")


# ---- watchlist
def trust_vs_watchlist(trust: DataFrame, watchlist: DataFrame) -> DataFrame:
    flags = watchlist.groupBy("domain").agg(
        F.count_if(c("watchlist_status") == "Watchlist").alias("n_watchlist"), F.count_if(c("watchlist_status") == "Monitor").alias("n_monitor"))
    return trust.select("domain", "trust_score", "trust_category").join(flags, "domain", "left").fillna(0, ["n_watchlist", "n_monitor"])


def priority_vs_failures(watchlist: DataFrame, tests: DataFrame) -> DataFrame:
    per_dataset = tests.groupBy("dataset_id").agg(F.count("*").alias("total_tests"), F.count_if(_fail()).alias("fails"))
    return watchlist.select("dataset_id", "watchlist_status", "priority").join(per_dataset, "dataset_id")


def watchlist_listing(watchlist: DataFrame) -> DataFrame:
    return watchlist.orderBy("watchlist_status", "priority", "dataset_name")


def watchlist_filtered(watchlist: DataFrame, statuses, priorities) -> DataFrame:
    return watchlist.filter(c("watchlist_status").isin(*statuses) & c("priority").isin(*priorities))


METRICS = (
    ("Null Rate", "null_rate", "null_rate_trend"),
    ("Duplicate Rate", "duplicate_rate", "duplicate_rate_trend"),
    ("Ctrl Failure Rate", "control_failure_rate", "control_failure_trend"),
)


def trend_rows(watchlist: DataFrame) -> DataFrame:
    """Three metric rows per dataset: early, recent, trend."""
    items = F.array(*[
        F.struct(F.lit(m).alias("metric"), c(f"{r}_early").alias("early"), c(f"{r}_recent").alias("recent"), c(t).alias("trend")) for m, r, t in METRICS])
    return watchlist.select("dataset_name", F.inline(items))


def trend_heatmap(watchlist: DataFrame) -> DataFrame:
    """-1 / 0 / 1 per dataset and metric."""
    score = F.when(c("trend") == "Deteriorating", -1).when(c("trend") == "Improving", 1).otherwise(0)
    rows = trend_rows(watchlist).withColumn("score", score)
    wide = rows.groupBy("dataset_name").pivot("metric", [m for m, _, _ in METRICS]).agg(F.first("score"))
    return wide.select("dataset_name", *[c(m).alias(m.lower().replace(" ", "_")) for m, _, _ in METRICS])


def all_flagged_domains(watchlist: DataFrame) -> DataFrame:
    """Domains whose every dataset is on the watchlist."""
    g = watchlist.groupBy("domain").agg(F.count("*").alias("datasets"), F.bool_and(c("watchlist_status") == "Watchlist").alias("coordinated"),
                                        F.count_if(c("watchlist_status") == "Watchlist").alias("on_watchlist"))
    return g.select("domain", "datasets", "on_watchlist", "coordinated")


# ---- exceptions
def by_source_system(inventory: DataFrame, exceptions: DataFrame, watchlist: DataFrame) -> DataFrame:
    exc = exceptions.groupBy("dataset_id").agg(F.count("*").alias("_e"))
    wl = watchlist.select("dataset_id", (c("watchlist_status") == "Watchlist").cast("int").alias("_w"))
    j = inventory.select("dataset_id", "source_system").join(exc, "dataset_id", "left").join(wl, "dataset_id", "left")
    return j.groupBy("source_system").agg(F.count("*").alias("datasets"), F.coalesce(F.sum("_e"), F.lit(0)).alias("exceptions"),
                                          F.coalesce(F.sum("_w"), F.lit(0)).alias("on_watchlist"))


def critical_density(bridge: DataFrame, rulebook: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Share of critical controls per dataset next to its exception load."""
    controls = bridge.join(rulebook.select("rule_id", "severity"), "rule_id").groupBy("dataset_id").agg(
        F.count("*").alias("controls"), F.count_if(c("severity") == "Critical").alias("critical_controls"))
    exc = exceptions.groupBy("dataset_id").agg(F.count("*").alias("exceptions"))
    return controls.join(exc, "dataset_id", "left").fillna(0, ["exceptions"]).withColumn(
        "critical_pct", percent(c("critical_controls"), c("controls"), 1))


def risk_rank(inventory: DataFrame, watchlist: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Rank datasets by watchlist priority, criticality and exception count."""
    exc = exceptions.groupBy("dataset_id").agg(F.count("*").alias("exceptions"))
    j = inventory.select("dataset_id", "dataset_name", "regulatory_criticality").join(
        watchlist.select("dataset_id", "priority"), "dataset_id").join(exc, "dataset_id", "left").fillna(0, ["exceptions"])
    w = Window.orderBy(ranked(c("priority"), PRIORITY_RANK), ranked(c("regulatory_criticality"), CRITICALITY_RANK), c("exceptions").desc())
    return j.withColumn("risk_rank", F.rank().over(w))


# ---- KPI rows
def ticket_kpis(tickets: DataFrame) -> DataFrame:
    status = c("status")
    g = tickets.agg(
        F.count("*").alias("total_tickets"), F.count_if(status.isin("Open", "Assigned", "In Progress")).alias("open_issues"),
        F.count_if(status == "Escalated").alias("escalated"), F.count_if(status == "Resolved").alias("resolved"), F.count_if("sla_breach").alias("sla_breaches"))
    return g.withColumn("sla_compliance", percent(c("total_tickets") - c("sla_breaches"), c("total_tickets"), 1, 100.0))


def executive_row(exceptions: DataFrame, tickets: DataFrame, watchlist: DataFrame) -> DataFrame:
    """One KPI row; the exception and watchlist figures are scalar subqueries on the ticket row."""
    serious = (c("regulatory_criticality") == "High") & c("severity").isin("Critical", "High")
    exc = exceptions.agg(F.struct(F.count_if(c("severity") == "Critical").alias("a"), F.count_if(serious).alias("b")).alias("v"))
    wl = watchlist.agg(F.count_if(c("watchlist_status") == "Watchlist").alias("v"))
    return ticket_kpis(tickets).withColumn("_x", exc.scalar()).select(
        c("_x.a").alias("critical_exceptions"), "open_issues", "sla_breaches", "sla_compliance", c("escalated").alias("escalated_backlog"),
        wl.scalar().alias("watchlist_count"), c("_x.b").alias("regulatory_issues"))


def measures(trust: DataFrame, tickets: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Average domain trust, critical issues, overdue tickets and watchlist count."""
    avg_trust = trust.filter(c("domain") != V.ENTERPRISE).agg(rounded(F.avg("trust_score"), 2).alias("v"))
    wl = watchlist.agg(F.count_if(c("watchlist_status") == "Watchlist").alias("v"))
    return tickets.agg(F.count_if(c("severity") == "Critical").alias("critical_issues"), F.count_if("sla_breach").alias("overdue_tickets")).select(
        avg_trust.scalar().alias("avg_trust_score"), "critical_issues", "overdue_tickets", wl.scalar().alias("watchlist_count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def tickets_listed(tickets: DataFrame, severities=None, statuses=None) -> DataFrame:
    if severities:
        tickets = tickets.filter(c("severity").isin(*severities))
    if statuses:
        tickets = tickets.filter(c("status").isin(*statuses))
    return tickets.orderBy("severity", "open_date")


def domain_ranking(trust: DataFrame) -> DataFrame:
    return trust.filter(c("domain") != V.ENTERPRISE).orderBy("trust_score", "domain")


REGISTRY_COLUMNS = ["exception_id", "exception_type", "dataset_name", "rule_name", "severity", "failure_rate", "regulatory_criticality", "recommended_action"]


def exception_registry(exceptions: DataFrame) -> DataFrame:
    return exceptions.select(*REGISTRY_COLUMNS)
