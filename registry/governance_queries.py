"""Registered queries of the governance side: controls, exceptions, watchlist, trust, analysis, review."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import fixed_values as V
from plumbline.operators import analysis, controls, exceptions, remediation, review, trust, watchlist
from plumbline.plans.watchlist_days import WatchlistDays
from plumbline.session import settle, shared_folder

from .core import register
from .governance_data import AS_OF, Governance, sql

c = F.col
FAILS = "count(*) FILTER (WHERE status = 'Fail')"
RECENT = f"test_date >= {AS_OF} - 7"
EFF = "sum(CAST(round(control_effectiveness * 100) AS BIGINT)) / (100e0 * count(*))"
TEST_COLS = "test_id, test_date, dataset_id, rule_id, total_records, pass_count, fail_count, failure_rate, control_effectiveness, status"


def add(name: str, query: Callable[[Governance], DataFrame], body: str, settled: bool = False, days_back: int = 0, **more: str) -> None:
    """Register a query; ``settled`` is only a matter of cost, for those that read a layer more than once."""
    register(name, lambda spark, sf: query(Governance(spark, sf, settled, days_back)), sql(body, days_back, **more))


def layered(name: str, query: Callable[[Governance], DataFrame], body: str, days_back: int = 0, **more: str) -> None:
    add(name, query, body, settled=True, days_back=days_back, **more)


# ---------------------------------------------------------------- controls
INV_COLS = "dataset_id, dataset_name, domain, category, owner, steward, refresh_frequency, source_system, regulatory_criticality"
# the inventory with the rows measured for each data set
add("g01_inventory",
    lambda g: g.inventory.join(g.profile.groupBy("dataset_id").agg(F.sum("profiled_rows").alias("measured_rows")), "dataset_id", "left").fillna(0, ["measured_rows"])
    .select(*INV_COLS.split(", "), "measured_rows"),
    f"SELECT {INV_COLS}, coalesce(n, 0)::BIGINT AS measured_rows FROM inv LEFT JOIN (SELECT dataset_id, sum(profiled_rows) AS n FROM prof GROUP BY 1) USING (dataset_id)")
add("g02_rulebook_in_use",
    lambda g: g.rulebook.join(g.tests.groupBy("rule_id").agg(F.count("*").alias("tests")), "rule_id", "left").fillna(0, ["tests"]),
    "SELECT rb.*, coalesce(tests, 0) AS tests FROM rb LEFT JOIN (SELECT rule_id, count(*) AS tests FROM gt GROUP BY 1) USING (rule_id)")
add("g03_applicability", lambda g: g.bridge, "SELECT dataset_id, rule_id FROM bridge")
add("g04_lookup",
    lambda g: controls.lookup(g.spark, g.tests, "rule_id", "ACCU-B").join(controls.lookup(g.spark, g.rulebook, "rule_id", "ACCU-B"), "rule_id")
    .join(controls.lookup(g.spark, g.inventory, "dataset_id", 7), "dataset_id").select("dataset_name", "rule_name", "test_date", "failure_rate"),
    "SELECT dataset_name, rule_name, test_date, failure_rate FROM gt JOIN rb USING (rule_id) JOIN inv USING (dataset_id) WHERE rule_id = 'ACCU-B' AND dataset_id = 7")
add("g05_control_tests", lambda g: g.tests, f"SELECT {TEST_COLS} FROM gt")
# a history that was graded when all thresholds were lower
OLD = 5.0
OLD_GT = f"SELECT gt.*, rb.threshold, CASE WHEN CAST(pass_count AS DECIMAL(30,2)) * 100 >= CAST(threshold - {OLD} AS DECIMAL(7,2)) * total_records THEN 'Pass' ELSE 'Fail' END AS stored FROM gt JOIN rb USING (rule_id)"


def _graded_before(g: Governance) -> DataFrame:
    older = g.rulebook.withColumn("threshold", c("threshold") - OLD)
    return controls.reconcile(controls.test_results(g.counters, older, g.bridge), g.rulebook, g.inventory)


add("g06_status_recomputed", lambda g: _graded_before(g).select("test_id", "dataset_name", "rule_name", "category", "threshold", "status", "status_recomputed", "reconciled"),
    f"SELECT test_id, dataset_name, rule_name, rb.category, o.threshold, stored AS status, status AS status_recomputed, stored = status AS reconciled FROM ({OLD_GT}) o JOIN rb USING (rule_id) JOIN inv USING (dataset_id)")
add("g07_status_mismatches", lambda g: controls.mismatches(_graded_before(g)), f"SELECT count(*) AS tests, count(*) FILTER (WHERE status <> stored) AS mismatches FROM ({OLD_GT})")

# ---------------------------------------------------------------- exceptions
EX_COLS = ", ".join(exceptions.EXCEPTION_COLUMNS)
for _name, _kind in (("x01_critical_failure", V.CRITICAL_FAILURE), ("x02_repeated_failure", V.REPEATED_FAILURE), ("x03_regulatory_issue", V.REGULATORY_ISSUE)):
    add(_name,
        lambda g, k=_kind: g.plain_exceptions.filter(c("exception_type") == k).select("dataset_id", "rule_id", "severity", "priority", "failure_rate", "recommended_action"),
        f"SELECT dataset_id, rule_id, severity, priority, failure_rate, recommended_action FROM ex WHERE exception_type = '{_kind}'")
layered("x04_exceptions", lambda g: g.exceptions.select(*exceptions.EXCEPTION_COLUMNS), f"SELECT {EX_COLS} FROM ex")
add("x05_recent_critical_tests",
    lambda g: analysis.recent(g.tests, g.as_of).join(g.rulebook.filter(c("severity") == "Critical").select("rule_id"), "rule_id", "left_semi").select("test_id", "status"),
    f"SELECT test_id, status FROM gt WHERE {RECENT} AND rule_id IN (SELECT rule_id FROM rb WHERE severity = 'Critical')")
layered("x06_watchlist_coverage", lambda g: exceptions.watchlist_coverage(g.plain_exceptions, g.watchlist),
    "SELECT coalesce(watchlist_status, 'None') AS watchlist_status, count(*) AS exceptions, round(100e0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM ex LEFT JOIN wl USING (dataset_id) GROUP BY 1")
add("x07_exception_counts", lambda g: exceptions.exception_counts(g.plain_exceptions),
    " UNION ALL ".join(f"SELECT '{d}' AS dimension, {d} AS value, count(*) AS exceptions, round(100e0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM ex GROUP BY {d}"
                       for d in ("exception_type", "severity", "regulatory_criticality", "dataset_name")))

# ---------------------------------------------------------------- watchlist
RATES = [f"{r}_{p}" for r in ("null_rate", "duplicate_rate", "control_failure_rate") for p in ("early", "recent")]
SIX = ", ".join(f"round({r}, 4) AS {r}" for r in RATES)


def _rates(g: Governance):
    from plumbline.functions.exprs import rounded

    r = g.rates()
    return r.select("dataset_id", *[rounded(c(x), 4).alias(x) for x in RATES])


def _trends(g: Governance, move=None):
    return watchlist.signal_counts(watchlist.add_trends(g.rates(), move))


layered("w01_null_rates", lambda g: _rates(g).select("dataset_id", *RATES[0:2]), f"SELECT dataset_id, {', '.join(SIX.split(', ')[0:0])}round(null_rate_early, 4) AS null_rate_early, round(null_rate_recent, 4) AS null_rate_recent FROM wl_r")
layered("w02_duplicate_rates", lambda g: _rates(g).select("dataset_id", *RATES[2:4]), "SELECT dataset_id, round(duplicate_rate_early, 4) AS duplicate_rate_early, round(duplicate_rate_recent, 4) AS duplicate_rate_recent FROM wl_r")
layered("w03_failure_rates", lambda g: _rates(g).select("dataset_id", *RATES[4:6]), "SELECT dataset_id, round(control_failure_rate_early, 4) AS control_failure_rate_early, round(control_failure_rate_recent, 4) AS control_failure_rate_recent FROM wl_r")
TREND_COLS = ["null_rate_trend", "duplicate_rate_trend", "control_failure_trend"]
layered("w04_trends", lambda g: _trends(g).select("dataset_id", *TREND_COLS), f"SELECT dataset_id, {', '.join(TREND_COLS)} FROM wl_t")
layered("w05_signal_counts", lambda g: _trends(g).select("dataset_id", "det_count", "imp_count"), "SELECT dataset_id, det_count, imp_count FROM wl_c")
layered("w06_status", lambda g: g.watchlist.select("dataset_id", "watchlist_status", "risk_trend", "priority"), "SELECT dataset_id, watchlist_status, risk_trend, priority FROM wl")
layered("w07_reason", lambda g: g.watchlist.select("dataset_id", "watchlist_reason", "recommended_action"), "SELECT dataset_id, watchlist_reason, recommended_action FROM wl")
layered("w07b_watchlist_table", lambda g: watchlist.with_watchlist_ids(g.watchlist),
    "SELECT printf('WL-%04d', row_number() OVER (ORDER BY domain, dataset_id)) AS watchlist_id, " + ", ".join(watchlist.WATCHLIST_COLUMNS[1:]) + " FROM wl")
# the watchlist stored a week ago against today's history
layered("w08_reconcile", lambda g: watchlist.reconcile(g.watchlist_at(7), g.tests, g.as_of).select("dataset_id", "control_failure_trend", "trend_recomputed", "watchlist_status", "status_recomputed", "reconciled"),
    "SELECT *, status_recomputed = watchlist_status AS reconciled FROM (SELECT dataset_id, wl7.control_failure_trend, wl_t.control_failure_trend AS trend_recomputed, watchlist_status, "
    "CASE (wl7.null_rate_trend = 'Deteriorating')::INT + (wl7.duplicate_rate_trend = 'Deteriorating')::INT + (wl_t.control_failure_trend = 'Deteriorating')::INT "
    "WHEN 0 THEN 'Clear' WHEN 1 THEN 'Monitor' ELSE 'Watchlist' END AS status_recomputed FROM wl7 JOIN wl_t USING (dataset_id))")
layered("w09_recovered_baseline", lambda g: watchlist.recovered_baseline(g.watchlist),
    r"SELECT * FROM (SELECT dataset_id, duplicate_rate_early, duplicate_rate_recent, CAST(p AS DOUBLE) AS reported_pct, round(duplicate_rate_recent / (1e0 + CAST(p AS DOUBLE) / 100e0), 5) AS implied_early FROM "
    r"(SELECT *, nullif(regexp_extract(watchlist_reason, 'Duplicate rate increased ([0-9.]+)%', 1), '') AS p FROM wl)) WHERE reported_pct IS NOT NULL")
layered("w10_floor_check", lambda g: watchlist.floor_check(g.rates()),
    "SELECT round(min(null_rate_early), 6) AS min_null_rate_early, round(min(duplicate_rate_early), 6) AS min_duplicate_rate_early, round(min(control_failure_rate_early), 6) AS min_control_failure_rate_early, "
    "least(min(null_rate_early), min(duplicate_rate_early), min(control_failure_rate_early)) < 0.01 AS floor_binds FROM wl_r")
layered("w11_damped_trend", lambda g: _trends(g, 0.5).select("dataset_id", *TREND_COLS, "det_count"), f"SELECT dataset_id, {', '.join(TREND_COLS)}, det_count FROM wlm_c")
add("w12_watchlist_history", lambda g: g.history.select("dataset_id", "test_date", "det_count", "imp_count", "watchlist_status"),
    "SELECT dataset_id, test_date, det_count, imp_count, watchlist_status FROM wh")


def _day_by_day(g: Governance) -> DataFrame:
    """The last three days added one by one to a state that holds the days before them."""
    rows = settle(watchlist.daily_rows(g.tests, g.profile), "daily-rows")
    last = rows.agg(F.max("test_date").alias("v")).first().v
    kept = WatchlistDays(g.spark, shared_folder(g.spark, "watchlist-days"))
    before = last - dt.timedelta(days=3)
    kept.log.publish(kept.log.snapshot(), [kept._write(rows.filter(c("test_date") <= F.lit(before)), "-state")], note=before.isoformat())
    for back in (2, 1, 0, 0):  # the last day twice: it is added once
        kept.add(rows, last - dt.timedelta(days=back))
    return kept.history()


layered("w12d_history_day_by_day", lambda g: _day_by_day(g).select("dataset_id", "test_date", "det_count", "imp_count", "watchlist_status"),
    "SELECT dataset_id, test_date, det_count, imp_count, watchlist_status FROM wh WHERE test_date > (SELECT max(test_date) FROM wh0) - 3")
FIRST_EXC = "SELECT dataset_id, min(test_date) AS first_exception FROM gt JOIN rb USING (rule_id) WHERE status = 'Fail' AND severity = 'Critical' GROUP BY 1"


def _lead_time(g: Governance):
    firsts = g.tests.filter(c("status") == "Fail").join(g.rulebook.filter(c("severity") == "Critical").select("rule_id"), "rule_id", "left_semi")
    return watchlist.lead_time(g.history, firsts.groupBy("dataset_id").agg(F.min("test_date").alias("first_exception")))


add("w12b_lead_time", _lead_time,
    f"SELECT dataset_id, first_flag, first_exception, CAST(first_exception - first_flag AS INT) AS lead_days FROM (SELECT dataset_id, min(test_date) AS first_flag FROM wh WHERE watchlist_status <> 'Clear' GROUP BY 1) LEFT JOIN ({FIRST_EXC}) USING (dataset_id)")

# ---------------------------------------------------------------- tickets raised from exceptions
TK_COLS = ", ".join(remediation.TICKET_COLUMNS)
layered("r01_raise_tickets", lambda g: g.tickets, f"SELECT {TK_COLS} FROM tk")
layered("r08_chronic_vs_tickets", lambda g: remediation.chronic_tickets(g.tests, g.tickets),
    f"SELECT f.*, coalesce(tickets, 0) AS tickets FROM (SELECT dataset_id, rule_id, count(*) AS failure_count FROM gt WHERE status = 'Fail' GROUP BY 1, 2 HAVING count(*) >= 27) f LEFT JOIN (SELECT dataset_id, rule_id, count(*) AS tickets FROM tk GROUP BY 1, 2) USING (dataset_id, rule_id)")
NEXT = "CASE severity WHEN 'Low' THEN 'Medium' WHEN 'Medium' THEN 'High' ELSE 'Critical' END"
add("r09_escalate_chronic", lambda g: remediation.escalate_chronic(g.tests, g.rulebook),
    f"SELECT dataset_id, rule_id, rule_name, count(*) AS failure_count, severity AS current_severity, {NEXT} AS escalated_severity FROM gt JOIN rb USING (rule_id) WHERE status = 'Fail' GROUP BY ALL HAVING count(*) >= 27")
ISLANDS = "SELECT dataset_id, rule_id, min(test_date) AS streak_start, max(test_date) AS streak_end, count(*) AS streak_days FROM (SELECT *, test_date - CAST(row_number() OVER (PARTITION BY dataset_id, rule_id ORDER BY test_date) AS INT) AS island FROM gt WHERE status = 'Fail') GROUP BY dataset_id, rule_id, island"
add("r10_failure_streaks", lambda g: remediation.failure_streaks(g.tests), ISLANDS)
add("r10b_streak_escalation", lambda g: remediation.escalate_streaks(g.tests, g.rulebook),
    f"SELECT dataset_id, rule_id, longest_streak, severity AS current_severity, {NEXT} AS escalated_severity FROM (SELECT dataset_id, rule_id, max(streak_days) AS longest_streak FROM ({ISLANDS}) GROUP BY 1, 2) JOIN rb USING (rule_id) WHERE longest_streak >= 7")
layered("r14_reopened", lambda g: remediation.reopened(g.tickets, g.tests),
    "SELECT ticket_id, t.dataset_id, t.rule_id, resolution_date, count(*) AS later_failures, min(test_date) AS first_later_failure FROM tk t JOIN gt ON t.dataset_id = gt.dataset_id AND t.rule_id = gt.rule_id AND gt.status = 'Fail' AND test_date > resolution_date WHERE t.status = 'Resolved' GROUP BY ALL")

# ---------------------------------------------------------------- trust and maturity
layered("t01_domain_effectiveness", lambda g: trust.presented(g.trust_exact).select("domain", "avg_control_effectiveness"), "SELECT domain, avg_control_effectiveness FROM tr WHERE domain <> 'Enterprise (Overall)'")
layered("t02_domain_flags", lambda g: trust.flag_counts(g.watchlist),
    "SELECT domain, count(*) FILTER (WHERE watchlist_status = 'Watchlist') AS watchlist_count, count(*) FILTER (WHERE watchlist_status = 'Monitor') AS monitor_count FROM wl GROUP BY 1")
layered("t03_domain_trust", lambda g: trust.presented(g.trust_exact).select("domain", "trust_score", "trust_category", "watchlist_count", "monitor_count"),
    "SELECT domain, round(trust_score, 1) AS trust_score, CASE WHEN trust_score >= 90 THEN 'Trusted' WHEN trust_score >= 75 THEN 'Monitor' ELSE 'At Risk' END AS trust_category, watchlist_count, monitor_count FROM tx")
layered("t04_dataset_count", lambda g: g.trust_exact.select("domain", "dataset_count"), "SELECT domain, dataset_count FROM tx")
layered("t05_trust_with_enterprise", lambda g: g.trust, "SELECT domain, trust_score, trust_category, avg_control_effectiveness, dataset_count FROM tr")
layered("t06_maturity", lambda g: g.maturity, "SELECT * FROM mt")
add("t07_coverage", lambda g: trust.coverage(g.bridge, g.inventory, g.rulebook),
    "SELECT *, round(100e0 * mapped_datasets / datasets, 1) AS control_coverage, round(100e0 * mapped_rules / rules, 1) AS rule_coverage FROM (SELECT (SELECT count(*) FROM inv) AS datasets, (SELECT count(DISTINCT dataset_id) FROM bridge) AS mapped_datasets, (SELECT count(*) FROM rb) AS rules, (SELECT count(DISTINCT rule_id) FROM bridge) AS mapped_rules)")
layered("t08_without_penalty", lambda g: trust.without_penalty(g.trust_exact), "SELECT round(avg(trust_score), 1) AS enterprise_score, round(avg(avg_control_effectiveness), 1) AS enterprise_score_if_no_penalty FROM tx")


def _floor_sql(source: str) -> str:
    return (f"SELECT tr.domain, trust_score AS current_score, trust_category AS current_category, coalesce(n, 0) AS all_fail_datasets, CASE WHEN n > 0 THEN 0e0 ELSE trust_score END AS fixed_score, CASE WHEN n > 0 THEN 'At Risk' ELSE trust_category END AS fixed_category "
            f"FROM tr LEFT JOIN (SELECT domain, count(*) FILTER (WHERE p = 0) AS n FROM (SELECT dataset_id, count(*) FILTER (WHERE status = 'Pass') AS p FROM gt WHERE {source} GROUP BY 1) JOIN inv USING (dataset_id) GROUP BY 1) f ON f.domain = tr.domain WHERE tr.domain <> 'Enterprise (Overall)'")


layered("t09_binary_floor", lambda g: trust.binary_floor(g.trust, trust.total_failures(g.tests, g.inventory)), _floor_sql("true"))
layered("t09b_binary_floor_one_control",
    lambda g: trust.binary_floor(g.trust, trust.total_failures(g.tests.filter(c("rule_id") == "ACCU-C"), g.inventory, g.as_of, 7)), _floor_sql(f"rule_id = 'ACCU-C' AND {RECENT}"))
layered("t10_simple_compliance", lambda g: trust.simple_compliance(g.trust, g.tests, g.inventory, g.as_of),
    "SELECT tr.domain, trust_score AS current_formula_score, trust_category AS current_category, round(100e0 * passes / tests, 1) AS simple_compliance_rate FROM tr LEFT JOIN te ON te.domain = tr.domain")
TH = {
    "th0": "SELECT domain, test_date, test_date - DATE '1970-01-01' AS d, sum(CAST(round(control_effectiveness * 100) AS BIGINT)) AS h, count(*) AS n FROM gt JOIN inv USING (dataset_id) GROUP BY ALL",
    "th1": "SELECT domain, test_date, sum(h) OVER w / (100e0 * sum(n) OVER w) AS eff FROM th0 WINDOW w AS (PARTITION BY domain ORDER BY d RANGE BETWEEN 7 PRECEDING AND CURRENT ROW)",
    "th2": "SELECT domain, test_date, count(*) FILTER (WHERE watchlist_status = 'Watchlist') AS w, count(*) FILTER (WHERE watchlist_status = 'Monitor') AS m FROM wh JOIN inv USING (dataset_id) GROUP BY 1, 2",
    "th": "SELECT domain, test_date, least(greatest(eff - (3e0 * coalesce(w, 0) + 1e0 * coalesce(m, 0)), 0e0), 100e0) AS score FROM th1 LEFT JOIN th2 USING (domain, test_date)",
}
layered("t11_trust_swings", lambda g: trust.swings(trust.trust_history(g.tests, g.history, g.inventory), 1.5),
    "SELECT domain, test_date, round(prev, 1) AS previous_score, round(score, 1) AS trust_score, round(score - prev, 2) AS swing FROM (SELECT *, lag(score) OVER (PARTITION BY domain ORDER BY test_date) AS prev FROM th) WHERE abs(score - prev) > 1.5", **TH)
layered("t12_maturity_gap", lambda g: trust.maturity_gap(g.maturity),
    """SELECT component, value, weight, round(value * weight, 3) AS contribution, round(t - s, 3) AS gap_to_next, round(sla + (t - s) / 0.25e0, 1) AS sla_needed FROM (
       SELECT *, CASE WHEN s < 60 THEN 60e0 WHEN s < 75 THEN 75e0 WHEN s < 90 THEN 90e0 END AS t FROM (
         SELECT sla_compliance AS sla, control_coverage * 0.3e0 + automation_pct * 0.3e0 + sla_compliance * 0.25e0 + audit_completeness * 0.15e0 AS s,
           unnest(['control_coverage', 'automation_pct', 'sla_compliance', 'audit_completeness']) AS component,
           unnest([control_coverage, automation_pct, sla_compliance, audit_completeness]) AS value, unnest([0.3e0, 0.3e0, 0.25e0, 0.15e0]) AS weight FROM mt0))""")

# ---------------------------------------------------------------- analysis and dashboard
# of the data sets that have test results
add("d01_inventory_mix", lambda g: analysis.inventory_mix(g.inventory.join(g.bridge, "dataset_id", "left_semi")),
    "SELECT category, regulatory_criticality, count(*) AS dataset_count FROM inv WHERE dataset_id IN (SELECT dataset_id FROM bridge) GROUP BY 1, 2")
add("d02_fail_rate_by_dataset", lambda g: analysis.fail_rate_by_dataset(g.tests), f"SELECT dataset_id, count(*) AS tests_run, {FAILS} AS fails, round(100e0 * {FAILS} / count(*), 1) AS fail_rate_pct FROM gt GROUP BY 1")
add("d03_status_mix", lambda g: analysis.status_mix(g.tests), "SELECT status, count(*) AS n, round(100e0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM gt GROUP BY 1")
layered("d04_trust_vs_watchlist", lambda g: analysis.trust_vs_watchlist(g.trust, g.watchlist),
    "SELECT tr.domain, trust_score, trust_category, coalesce(n_watchlist, 0) AS n_watchlist, coalesce(n_monitor, 0) AS n_monitor FROM tr LEFT JOIN (SELECT domain, count(*) FILTER (WHERE watchlist_status = 'Watchlist') AS n_watchlist, count(*) FILTER (WHERE watchlist_status = 'Monitor') AS n_monitor FROM wl GROUP BY 1) f ON f.domain = tr.domain")
add("d05_fail_rate_by_category", lambda g: analysis.fail_rate_by_category(g.tests, g.rulebook),
    f"SELECT category, count(*) AS total_tests, {FAILS} AS failures, round(100e0 * {FAILS} / count(*), 1) AS fail_rate FROM gt JOIN rb USING (rule_id) GROUP BY 1")
layered("d06_priority_vs_failures", lambda g: analysis.priority_vs_failures(g.watchlist, g.tests),
    f"SELECT dataset_id, watchlist_status, priority, count(*) AS total_tests, {FAILS} AS fails FROM wl JOIN gt USING (dataset_id) GROUP BY 1, 2, 3")
add("d07_one_dataset_totals", lambda g: analysis.dataset_totals(g.tests, 3),
    f"SELECT dataset_id, count(*) AS total_tests, {FAILS} AS fails, round(100e0 * {FAILS} / count(*), 1) AS fail_rate, round({EFF}, 1) AS avg_effectiveness FROM gt WHERE dataset_id = 3 GROUP BY 1")
add("d08_rule_effectiveness", lambda g: analysis.rule_effectiveness(g.tests, g.rulebook),
    f"SELECT dataset_id, rule_id, rule_name, threshold, severity, round({EFF}, 2) AS avg_eff, count(*) AS n_tests, {FAILS} AS fails FROM gt JOIN rb USING (rule_id) GROUP BY ALL")
add("d09_controls_per_dataset", lambda g: analysis.controls_per_dataset(g.tests, g.rulebook.agg(F.count("*").alias("v")).scalar()),
    "SELECT dataset_id, count(DISTINCT rule_id) AS controls_assigned, round(100e0 * count(DISTINCT rule_id) / (SELECT count(*) FROM rb), 1) AS pct_of_catalog FROM gt GROUP BY 1")
add("d10_failed_controls_recent", lambda g: analysis.failed_controls_recent(g.tests, g.as_of), f"SELECT count(DISTINCT ROW(rule_id, dataset_id)) AS failed_controls FROM gt WHERE {RECENT} AND status = 'Fail'")


def _mean_in(days: int) -> str:
    inside = f"FILTER (WHERE test_date >= {AS_OF} - {days})"
    return f"round(sum(CAST(round(control_effectiveness * 100) AS BIGINT)) {inside} / (100e0 * count(*) {inside}), 1) AS avg_effectiveness_{days}d"


add("d11_mean_effectiveness", lambda g: analysis.mean_effectiveness_windows(g.tests, g.as_of), f"SELECT {_mean_in(7)}, {_mean_in(30)} FROM gt")
layered("d12_executive_row", lambda g: analysis.executive_row(g.plain_exceptions, g.tickets, g.watchlist),
    """SELECT (SELECT count(*) FROM ex WHERE severity = 'Critical') AS critical_exceptions, count(*) FILTER (WHERE status IN ('Open','Assigned','In Progress')) AS open_issues,
       count(*) FILTER (WHERE sla_breach) AS sla_breaches, CASE WHEN count(*) > 0 THEN round(100e0 * count(*) FILTER (WHERE NOT sla_breach) / count(*), 1) ELSE 100e0 END AS sla_compliance,
       count(*) FILTER (WHERE status = 'Escalated') AS escalated_backlog, (SELECT count(*) FROM wl WHERE watchlist_status = 'Watchlist') AS watchlist_count,
       (SELECT count(*) FROM ex WHERE regulatory_criticality = 'High' AND severity IN ('Critical','High')) AS regulatory_issues FROM tk""")
layered("d13_domain_ranking", lambda g: analysis.domain_ranking(g.trust), "SELECT domain, trust_score, trust_category, avg_control_effectiveness, dataset_count FROM tr WHERE domain <> 'Enterprise (Overall)' ORDER BY trust_score, domain")
WL_SHOW = "dataset_id, dataset_name, watchlist_status, priority, risk_trend"
add("d14_watchlist_listing", lambda g: analysis.watchlist_listing(g.watchlist).select(*WL_SHOW.split(", ")), f"SELECT {WL_SHOW} FROM wl ORDER BY watchlist_status, priority, dataset_name")
add("d14b_watchlist_status_counts", lambda g: g.watchlist.groupBy("watchlist_status").agg(F.count("*").alias("datasets")), "SELECT watchlist_status, count(*) AS datasets FROM wl GROUP BY 1")
add("d15_watchlist_filtered", lambda g: analysis.watchlist_filtered(g.watchlist, ["Watchlist", "Monitor"], ["High", "Medium"]).select(*WL_SHOW.split(", ")),
    f"SELECT {WL_SHOW} FROM wl WHERE watchlist_status IN ('Watchlist','Monitor') AND priority IN ('High','Medium')")
_METRIC_SQL = " UNION ALL ".join(f"SELECT dataset_name, '{m}' AS metric, {r}_early AS early, {r}_recent AS recent, {t} AS trend FROM wl" for m, r, t in analysis.METRICS)
add("d16_trend_rows", lambda g: analysis.trend_rows(g.watchlist), _METRIC_SQL)
add("d17_trend_heatmap", lambda g: analysis.trend_heatmap(g.watchlist),
    "SELECT dataset_name, " + ", ".join(f"CASE {t} WHEN 'Deteriorating' THEN -1 WHEN 'Improving' THEN 1 ELSE 0 END AS {m.lower().replace(' ', '_')}" for m, _, t in analysis.METRICS) + " FROM wl")
add("d18_latest_day", lambda g: analysis.latest_day(g.tests),
    f"SELECT count(*) AS controls, count(*) FILTER (WHERE status = 'Pass') AS passed, {FAILS} AS failed, round(100e0 * count(*) FILTER (WHERE status = 'Pass') / count(*), 1) AS pass_rate FROM gt WHERE test_date = {AS_OF}")
add("d19_category_recent", lambda g: analysis.category_recent(g.tests, g.rulebook, g.as_of), f"SELECT category, round({EFF}, 1) AS avg_effectiveness, {FAILS} AS fail_count FROM gt JOIN rb USING (rule_id) WHERE {RECENT} GROUP BY 1")
add("d20_daily_trend", lambda g: analysis.daily_trend(g.tests), f"SELECT dataset_id, test_date, round({EFF}, 2) AS avg_effectiveness, {FAILS} AS fail_count FROM gt GROUP BY 1, 2")
add("d21_scorecard", lambda g: analysis.scorecard(g.tests, g.inventory, g.as_of),
    f"SELECT dataset_id, dataset_name, domain, regulatory_criticality, count(DISTINCT rule_id) AS controls_tested, count(*) FILTER (WHERE status = 'Pass') AS passed, {FAILS} AS failed, round({EFF}, 1) AS avg_effectiveness FROM gt JOIN inv USING (dataset_id) WHERE {RECENT} GROUP BY 1, 2, 3, 4")
add("d22_fails_by_severity", lambda g: analysis.fails_by_severity_recent(g.tests, g.rulebook, g.as_of), f"SELECT severity, count(*) AS fail_count FROM gt JOIN rb USING (rule_id) WHERE {RECENT} AND status = 'Fail' GROUP BY 1")
layered("d25_exception_registry", lambda g: analysis.exception_registry(g.exceptions), f"SELECT {', '.join(analysis.REGISTRY_COLUMNS)} FROM ex")
DAILY = "SELECT test_date, count(*) AS tests, count(*) FILTER (WHERE status = 'Pass') AS passed, round(100e0 * count(*) FILTER (WHERE status = 'Pass') / count(*), 2) AS pass_rate FROM gt GROUP BY 1"
RANGE = "SELECT min(pass_rate) AS min_rate, max(pass_rate) AS max_rate, round(sum(CAST(round(pass_rate * 100) AS BIGINT)) / (100e0 * count(*)), 2) AS mean_rate, round(100e0 * sum(passed) / sum(tests), 2) AS overall_rate FROM "
add("d26_daily_pass_rate", lambda g: analysis.daily_pass_rate(g.tests), DAILY)
add("d26b_pass_rate_range", lambda g: analysis.pass_rate_range(analysis.daily_pass_rate(g.tests)), RANGE + f"({DAILY})")
layered("d27_measures", lambda g: analysis.measures(g.trust, g.tickets, g.watchlist),
    "SELECT (SELECT round(avg(trust_score), 2) FROM tr WHERE domain <> 'Enterprise (Overall)') AS avg_trust_score, count(*) FILTER (WHERE severity = 'Critical') AS critical_issues, count(*) FILTER (WHERE sla_breach) AS overdue_tickets, (SELECT count(*) FROM wl WHERE watchlist_status = 'Watchlist') AS watchlist_count FROM tk")
add("d28_cross_filter", lambda g: analysis.pass_rate_range(analysis.daily_pass_rate(analysis.slice_by(g.tests, g.inventory, ["ASIA", "EUROPE"], ["High", "Medium"]))),
    RANGE + "(" + DAILY.replace("FROM gt", "FROM gt WHERE dataset_id IN (SELECT dataset_id FROM inv WHERE domain IN ('ASIA','EUROPE') AND regulatory_criticality IN ('High','Medium'))") + ")")
add("d29_top_failing_rules", lambda g: analysis.top_failing_rules(g.tests, g.rulebook),
    f"SELECT count_rank, rule_id, rule_name, category, severity, fails, tests_run, fail_rate, rate_rank FROM (SELECT *, CAST(row_number() OVER (ORDER BY fails DESC, rule_id) AS INT) AS count_rank, CAST(dense_rank() OVER (ORDER BY fail_rate DESC) AS INT) AS rate_rank FROM (SELECT rule_id, count(*) AS tests_run, {FAILS} AS fails, round(100e0 * {FAILS} / count(*), 1) AS fail_rate FROM gt GROUP BY 1)) JOIN rb USING (rule_id) WHERE count_rank <= 10")
add("d30_first_last_effectiveness", lambda g: analysis.first_last_effectiveness(g.tests),
    f"SELECT min(test_date) AS first_day, max(test_date) AS last_day, round(arg_min(e, test_date), 2) AS first_effectiveness, round(arg_max(e, test_date), 2) AS last_effectiveness, round(arg_max(e, test_date) - arg_min(e, test_date), 2) AS change FROM (SELECT test_date, {EFF} AS e FROM gt GROUP BY 1)")
_RANKS = "CASE {0} WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 WHEN 'Low' THEN 2 ELSE 9 END"
layered("d31_risk_rank", lambda g: analysis.risk_rank(g.inventory, g.watchlist, g.plain_exceptions),
    f"SELECT *, CAST(rank() OVER (ORDER BY {_RANKS.format('priority')}, {_RANKS.format('regulatory_criticality')}, exceptions DESC) AS INT) AS risk_rank FROM (SELECT dataset_id, inv.dataset_name, inv.regulatory_criticality, priority, coalesce(n, 0) AS exceptions FROM inv JOIN (SELECT dataset_id, priority FROM wl) USING (dataset_id) LEFT JOIN (SELECT dataset_id, count(*) AS n FROM ex GROUP BY 1) USING (dataset_id))")
add("d32_rulebook_mix", lambda g: analysis.rulebook_mix(g.rulebook.join(g.tests.groupBy("rule_id").agg(F.count("*").alias("_n")), "rule_id"), F.count("*")),
    "SELECT coalesce(category, 'All') AS category, coalesce(severity, 'All') AS severity, count(*) AS rules FROM rb WHERE rule_id IN (SELECT rule_id FROM gt) GROUP BY CUBE (category, severity)")
add("d33_ungoverned", lambda g: analysis.ungoverned(g.inventory, g.rulebook, g.bridge),
    "SELECT 'dataset' AS kind, CAST(dataset_id AS VARCHAR) AS id FROM inv WHERE dataset_id NOT IN (SELECT dataset_id FROM bridge) UNION ALL SELECT 'rule', rule_id FROM rb WHERE rule_id NOT IN (SELECT rule_id FROM bridge)")
add("d34_missing_tests", lambda g: analysis.missing_tests(g.tests, g.bridge),
    "SELECT dataset_id, rule_id, test_date FROM (SELECT dataset_id, rule_id, CAST(unnest(range((SELECT min(test_date) FROM gt), (SELECT max(test_date) FROM gt) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS test_date FROM bridge) e WHERE NOT EXISTS (SELECT 1 FROM gt WHERE gt.dataset_id = e.dataset_id AND gt.rule_id = e.rule_id AND gt.test_date = e.test_date)")
add("d35_co_failures", lambda g: analysis.co_failures(g.tests),
    "SELECT rule_a, rule_b, both_fail, a.n AS a_fails, b.n AS b_fails, round(100e0 * both_fail / (a.n + b.n - both_fail), 2) AS overlap_pct FROM (SELECT x.rule_id AS rule_a, y.rule_id AS rule_b, count(*) AS both_fail FROM gt x JOIN gt y ON x.dataset_id = y.dataset_id AND x.test_date = y.test_date AND x.rule_id < y.rule_id WHERE x.status = 'Fail' AND y.status = 'Fail' GROUP BY 1, 2) p "
    "JOIN (SELECT rule_id, count(*) AS n FROM gt WHERE status = 'Fail' GROUP BY 1) a ON a.rule_id = rule_a JOIN (SELECT rule_id, count(*) AS n FROM gt WHERE status = 'Fail' GROUP BY 1) b ON b.rule_id = rule_b")
add("d36_alert_volume", lambda g: analysis.alert_volume(g.tests),
    f"SELECT count(*) AS days, round(sum(t) / CAST(count(*) AS DOUBLE), 2) AS tests_per_day, round(sum(f) / CAST(count(*) AS DOUBLE), 2) AS fails_per_day FROM (SELECT test_date, count(*) AS t, {FAILS} AS f FROM gt GROUP BY 1)")
layered("d37_table_counts",
    lambda g: analysis.table_counts({"data_inventory": g.inventory, "control_rulebook": g.rulebook, "control_test_results": g.tests, "exceptions": g.plain_exceptions,
                                     "dq_watchlist": g.watchlist, "remediation_tickets": g.tickets, "domain_trust_scores": g.trust, "governance_maturity": g.maturity}),
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in
                       (("data_inventory", "inv"), ("control_rulebook", "rb"), ("control_test_results", "gt"), ("exceptions", "ex"), ("dq_watchlist", "wl"), ("remediation_tickets", "tk"), ("domain_trust_scores", "tr"), ("governance_maturity", "mt"))))
layered("d37b_enterprise_row", lambda g: g.trust.filter(c("domain") == V.ENTERPRISE).select("domain", "trust_score"), "SELECT domain, trust_score FROM tr WHERE domain = 'Enterprise (Overall)'")
EARLY = f"test_date <= {AS_OF} - 15"
add("d38_driver_rules", lambda g: analysis.driver_rules(g.tests, g.inventory, g.as_of),
    f"SELECT domain, rule_id, change, CAST(driver_rank AS INT) AS driver_rank FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY change, rule_id) AS driver_rank FROM (SELECT domain, rule_id, round(sum(h) FILTER (WHERE NOT e) / (100e0 * count(*) FILTER (WHERE NOT e)) - sum(h) FILTER (WHERE e) / (100e0 * count(*) FILTER (WHERE e)), 2) AS change FROM (SELECT domain, rule_id, {EARLY} AS e, CAST(round(control_effectiveness * 100) AS BIGINT) AS h FROM gt JOIN inv USING (dataset_id) WHERE test_date > {AS_OF} - 30) GROUP BY 1, 2 HAVING bool_or(e) AND bool_or(NOT e))) WHERE driver_rank <= 3")
TARGETS = {"High": 95.0, "Medium": 85.0, "Low": 75.0}
add("d39_tier_targets", lambda g: analysis.tier_targets(g.tests, g.inventory, TARGETS),
    "SELECT *, round(target - pass_rate, 1) AS gap FROM (SELECT regulatory_criticality, count(*) AS tests, count(*) FILTER (WHERE status = 'Pass') AS passed, round(100e0 * count(*) FILTER (WHERE status = 'Pass') / count(*), 1) AS pass_rate, CASE regulatory_criticality WHEN 'High' THEN 95e0 WHEN 'Medium' THEN 85e0 ELSE 75e0 END AS target FROM gt JOIN inv USING (dataset_id) GROUP BY 1)")
add("d40_coordinated_domains", lambda g: analysis.all_flagged_domains(g.watchlist),
    "SELECT domain, count(*) AS datasets, count(*) FILTER (WHERE watchlist_status = 'Watchlist') AS on_watchlist, bool_and(watchlist_status = 'Watchlist') AS coordinated FROM wl GROUP BY 1")
layered("d41_by_source_system", lambda g: analysis.by_source_system(g.inventory, g.plain_exceptions, g.watchlist),
    "SELECT source_system, count(*) AS datasets, coalesce(sum(n), 0)::BIGINT AS exceptions, count(*) FILTER (WHERE watchlist_status = 'Watchlist') AS on_watchlist FROM inv LEFT JOIN (SELECT dataset_id, count(*) AS n FROM ex GROUP BY 1) USING (dataset_id) LEFT JOIN (SELECT dataset_id, watchlist_status FROM wl) USING (dataset_id) GROUP BY 1")
layered("d42_critical_density", lambda g: analysis.critical_density(g.bridge, g.rulebook, g.plain_exceptions),
    "SELECT dataset_id, controls, critical_controls, coalesce(n, 0) AS exceptions, round(100e0 * critical_controls / controls, 1) AS critical_pct FROM (SELECT dataset_id, count(*) AS controls, count(*) FILTER (WHERE severity = 'Critical') AS critical_controls FROM bridge JOIN rb USING (rule_id) GROUP BY 1) LEFT JOIN (SELECT dataset_id, count(*) AS n FROM ex GROUP BY 1) USING (dataset_id)")
add("d43_near_breaches", lambda g: analysis.near_breaches(g.tests, g.rulebook, 2.0),
    "SELECT * FROM (SELECT test_id, test_date, dataset_id, rule_id, control_effectiveness, threshold, round(control_effectiveness - threshold, 2) AS headroom FROM gt JOIN rb USING (rule_id) WHERE status = 'Pass') WHERE headroom BETWEEN 0 AND 2")
layered("d44_newly_raised", lambda g: watchlist.newly_raised(g.watchlist_at(7), g.watchlist).select("dataset_id", "watchlist_status", "priority"),
    "SELECT dataset_id, watchlist_status, priority FROM wl WHERE priority = 'High' AND dataset_id NOT IN (SELECT dataset_id FROM wl7 WHERE priority = 'High')")

# ---------------------------------------------------------------- monthly review
M1 = """SELECT trust_score AS overall_trust, trust_category AS overall_category, (SELECT count(*) FROM wl WHERE watchlist_status = 'Watchlist') AS watchlist_count,
    (SELECT count(*) FROM ex WHERE severity = 'Critical') AS critical_exceptions, (SELECT count(*) FROM tk WHERE sla_breach) AS sla_breaches,
    (SELECT CASE WHEN count(*) > 0 THEN round(100e0 * count(*) FILTER (WHERE NOT sla_breach) / count(*), 1) ELSE 100e0 END FROM tk) AS sla_compliance FROM tr WHERE domain = 'Enterprise (Overall)'"""
M2 = """SELECT (SELECT coalesce(string_agg(dataset_name, ', ' ORDER BY dataset_name), '') FROM (SELECT DISTINCT dataset_name FROM wl WHERE watchlist_status = 'Watchlist')) AS watchlist_datasets,
    (SELECT coalesce(string_agg(dataset_name, ', ' ORDER BY dataset_name), '') FROM (SELECT DISTINCT dataset_name FROM ex WHERE severity = 'Critical')) AS critical_datasets"""


def _facts(g: Governance):
    return review.scalars(g.trust, g.watchlist, g.plain_exceptions, g.tickets)


def _names(g: Governance):
    return review.names(g.watchlist, g.plain_exceptions)


A = V.REVIEW_ACTIONS
layered("m01_review_scalars", _facts, M1)
layered("m02_names", _names, M2)
layered("m03_leading_root_cause", lambda g: review.leading_root_cause(g.tickets), "SELECT root_cause, count(*) AS tickets FROM tk GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
layered("m04_business_risk", lambda g: _facts(g).select("overall_trust", "critical_exceptions", review.business_risk(c("critical_exceptions"), c("overall_trust")).alias("business_risk")),
    f"SELECT overall_trust, critical_exceptions, CASE WHEN critical_exceptions > 3 OR overall_trust < 75 THEN 'High' WHEN critical_exceptions > 0 OR overall_trust < 85 THEN 'Medium' ELSE 'Low' END AS business_risk FROM ({M1})")
layered("m05_actions", lambda g: review.actions(_facts(g), _names(g)),
    f"""SELECT CAST(row_number() OVER (ORDER BY o) AS INT) AS position, priority, action FROM (
        SELECT 1 AS o, '{A['critical'][0]}' AS priority, printf('{A['critical'][1]}', critical_exceptions) AS action FROM ({M1}) WHERE critical_exceptions > 0
        UNION ALL SELECT 2, '{A['watchlist'][0]}', printf('{A['watchlist'][1]}', watchlist_datasets) FROM ({M1}), ({M2}) WHERE watchlist_count > 0
        UNION ALL SELECT 3, '{A['breach'][0]}', printf('{A['breach'][1]}', sla_breaches) FROM ({M1}) WHERE sla_breaches > 0
        UNION ALL SELECT 4, '{A['feeds'][0]}', '{A['feeds'][1]}' UNION ALL SELECT 5, '{A['timeliness'][0]}', '{A['timeliness'][1]}'
        UNION ALL SELECT 6, '{A['maturity'][0]}', '{A['maturity'][1].replace(chr(39), chr(39) * 2)}')""")
layered("m06_current_vs_target", lambda g: review.current_vs_target(_facts(g), g.maturity),
    f"""SELECT 1 AS position, 'Data Trust Score' AS metric, printf('%.1f/100', overall_trust) AS current_value, '90+/100' AS target FROM ({M1})
        UNION ALL SELECT 2, 'Datasets on Watchlist', CAST(watchlist_count AS VARCHAR), '0' FROM ({M1}) UNION ALL SELECT 3, 'Critical Exceptions', CAST(critical_exceptions AS VARCHAR), '0' FROM ({M1})
        UNION ALL SELECT 4, 'SLA Compliance', printf('%.1f%%', sla_compliance), '98%+' FROM ({M1}) UNION ALL SELECT 5, 'Governance Maturity', maturity_level, 'Managed' FROM mt""")


# ---------------------------------------------------------------- the same at a past date
layered("x04b_exceptions_past", lambda g: g.exceptions.select(*exceptions.EXCEPTION_COLUMNS), f"SELECT {EX_COLS} FROM ex", days_back=10)
layered("t05b_trust_past", lambda g: g.trust, "SELECT domain, trust_score, trust_category, avg_control_effectiveness, dataset_count FROM tr", days_back=10)
add("d11b_mean_effectiveness_past", lambda g: analysis.mean_effectiveness_windows(g.tests, g.as_of), f"SELECT {_mean_in(7)}, {_mean_in(30)} FROM gt", days_back=10)
add("d22b_fails_by_severity_past", lambda g: analysis.fails_by_severity_recent(g.tests, g.rulebook, g.as_of),
    f"SELECT severity, count(*) AS fail_count FROM gt JOIN rb USING (rule_id) WHERE {RECENT} AND status = 'Fail' GROUP BY 1", days_back=10)
layered("w08b_reconcile_past", lambda g: watchlist.reconcile(g.watchlist, g.tests, g.as_of).select("dataset_id", "control_failure_trend", "trend_recomputed", "reconciled"),
        "SELECT dataset_id, wl.control_failure_trend, wl_t.control_failure_trend AS trend_recomputed, true AS reconciled FROM wl JOIN wl_t USING (dataset_id)", days_back=5)
# the rolling history of the last day is the watchlist of that day, for the datasets with rows on it
layered("w12c_history_of_the_last_day", lambda g: g.history.filter(c("test_date") == g.as_of).select("dataset_id", "det_count", "watchlist_status"),
        f"SELECT dataset_id, det_count, watchlist_status FROM wl WHERE dataset_id IN (SELECT dataset_id FROM gt WHERE test_date = {AS_OF} UNION SELECT dataset_id FROM prof WHERE test_date = {AS_OF})")
