"""Published formula values and edge cases of exceptions, watchlist, trust and tickets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline import fixed_values as V
from plumbline.operators import analysis, controls, exceptions, remediation, trust, watchlist

D0 = dt.date(2024, 3, 31)
TEST_DDL = "test_id string, test_date date, dataset_id string, rule_id string, total_records bigint, pass_count bigint, fail_count bigint, failure_rate double, control_effectiveness double, status string"


def make_tests(spark, rows):
    """rows: (days before D0, dataset, rule, failure rate, status)"""
    data = [(f"T{i}", D0 - dt.timedelta(days=d), ds, rule, 100, 0, 0, rate, 100.0 - rate, status) for i, (d, ds, rule, rate, status) in enumerate(rows)]
    return spark.createDataFrame(data, TEST_DDL)


def test_fixed_tables(spark):
    inv, rb, br = controls.default_inventory(spark), controls.default_rulebook(spark), controls.applicability(spark)
    assert (inv.count(), rb.count(), br.count()) == (13, 30, 45)
    unused = analysis.ungoverned(inv, rb, br).collect()
    assert [(r.kind, r.id) for r in unused] == [("rule", "ACCU-005")]
    cov = trust.coverage(br, inv, rb).first()
    assert (cov.control_coverage, cov.rule_coverage) == (100.0, 96.7)
    sev = {r.severity: r.rules for r in analysis.rulebook_mix(rb, F.count("*")).filter("category = 'All'").collect()}
    assert sev == {"Critical": 12, "High": 11, "Medium": 6, "Low": 1, "All": 30}


FLAGS = {"DS-002": "Watchlist", "DS-006": "Watchlist", **{f"DS-{i:03d}": "Watchlist" for i in (8, 9, 10, 11, 12, 13)}}
EFF = {"Operations": 90.0, "Sales": 83.0, "Transaction": 86.0, "Finance": 99.9, "Reference": 98.3, "HR": 98.7, "Risk": 95.1, "Customer": 95.8, "Product": 97.9}
TRUST = {"Operations": (81.0, "Monitor"), "Sales": (80.0, "Monitor"), "Transaction": (83.0, "Monitor"), "Finance": (98.9, "Trusted"), "Reference": (92.3, "Trusted"),
         "HR": (95.7, "Trusted"), "Risk": (94.1, "Trusted"), "Customer": (93.8, "Trusted"), "Product": (96.9, "Trusted"), V.ENTERPRISE: (90.6, "Trusted")}


def _trust_inputs(spark):
    inv = controls.default_inventory(spark)
    domains = {r.dataset_id: r.domain for r in inv.collect()}
    tests = make_tests(spark, [(0, ds, "R", round(100.0 - EFF[dom], 2), "Fail") for ds, dom in domains.items()])
    wl = spark.createDataFrame([(ds, dom, FLAGS.get(ds, "Monitor")) for ds, dom in domains.items()], "dataset_id string, domain string, watchlist_status string")
    return tests, wl, inv


def test_published_trust_scores(spark):
    tests, wl, inv = _trust_inputs(spark)
    got = {r.domain: (r.trust_score, r.trust_category) for r in trust.trust_scores(tests, wl, inv).collect()}
    assert got == TRUST
    assert trust.without_penalty(trust.domain_trust_exact(tests, wl, inv)).first().enterprise_score_if_no_penalty == 93.9


def test_binary_floor_sets_zero(spark):
    tests, wl, inv = _trust_inputs(spark)
    fixed = trust.binary_floor(trust.trust_scores(tests, wl, inv), trust.total_failures(tests, inv)).collect()
    assert {(r.fixed_score, r.fixed_category) for r in fixed} == {(0.0, "At Risk")}


def _tickets(spark, spec):
    rows, n = [], 0
    for severity, resolved, overdue, on_track in spec:
        for status, age, count in (("Resolved", 0, resolved), ("Open", 40, overdue), ("Open", 0, on_track)):
            for _ in range(count):
                n += 1
                rows.append((f"REM-{n:04d}", severity, status, D0 - dt.timedelta(days=age), None, "Feed Delay", "Pending"))
    df = spark.createDataFrame(rows, "ticket_id string, severity string, status string, open_date date, resolution_date date, root_cause string, verification_status string")
    return remediation.with_sla(df, F.lit(D0))


PUBLISHED = [("Critical", 6, 10, 3), ("High", 2, 11, 2), ("Medium", 2, 0, 6)]


def test_published_ticket_rates(spark):
    t = _tickets(spark, PUBLISHED)
    stacked = {r.severity: (r.resolved, r.overdue, r.on_track) for r in remediation.stacked_by_severity(t).collect()}
    assert stacked == {s: tuple(x) for s, *x in PUBLISHED}
    rates = {r.severity: r.breach_rate for r in remediation.breach_by(t, F.col("severity")).collect()}
    assert rates == {"Critical": 52.6, "High": 73.3, "Medium": 0.0}
    assert analysis.ticket_kpis(t).first().sla_compliance == 50.0


def test_published_maturity(spark):
    row = trust.governance_maturity(controls.applicability(spark), controls.default_inventory(spark), controls.default_rulebook(spark), _tickets(spark, PUBLISHED)).first()
    assert (row.maturity_score, row.maturity_level, row.control_coverage, row.sla_compliance) == (83.0, "Managed", 100.0, 50.0)


def test_no_tickets_means_full_compliance(spark):
    empty = _tickets(spark, [])
    assert trust.sla_compliance(empty).first().sla_compliance == 100.0
    assert analysis.ticket_kpis(empty).first().sla_compliance == 100.0


def _rules(spark):
    return spark.createDataFrame([("C", "crit", "A", 99.0, "Critical"), ("H", "high", "A", 99.0, "High"), ("M", "med", "A", 99.0, "Medium")], "rule_id string, rule_name string, category string, threshold double, severity string")


def _inventory(spark):
    return spark.createDataFrame([("X", "ds x", "d", "o", "s", "High"), ("Y", "ds y", "d", "o", "s", "Low")], "dataset_id string, dataset_name string, domain string, owner string, steward string, regulatory_criticality string")


def test_exceptions(spark):
    t = make_tests(spark, [
        (8, "X", "C", 9.0, "Fail"), (7, "X", "C", 5.0, "Fail"), (0, "X", "C", 7.0, "Fail"),  # day 8 lies outside, day 7 inside the window
        *[(d, "Y", "H", 2.0 + d, "Fail") for d in (0, 1, 2)], (3, "Y", "H", 0.0, "Pass"), (4, "Y", "H", 0.0, "Pass"), (5, "Y", "H", 50.0, "Fail"),
        *[(d, "Y", "M", 1.0, "Fail") for d in (0, 1)],  # two failures are not repeated
        *[(d, "Y", "C", 4.0, "Fail") for d in (0, 1, 2)],  # critical suppresses repeated
    ])
    rows = exceptions.detect(t, _rules(spark), _inventory(spark)).orderBy("exception_id").collect()
    got = [(r.exception_id, r.exception_type, r.dataset_id, r.rule_id, r.severity, r.priority, r.failure_rate) for r in rows]
    assert got == [
        ("EXC-0001", V.CRITICAL_FAILURE, "X", "C", "Critical", 1, 5.0),
        ("EXC-0002", V.CRITICAL_FAILURE, "Y", "C", "Critical", 1, 4.0),
        ("EXC-0003", V.REPEATED_FAILURE, "Y", "H", "High", 2, 1.8),
        ("EXC-0004", V.REGULATORY_ISSUE, "X", "C", "Critical", 1, 5.0),
    ]


def test_no_exceptions_keep_the_schema(spark):
    none = exceptions.detect(make_tests(spark, [(0, "X", "C", 0.0, "Pass")]), _rules(spark), _inventory(spark))
    assert none.count() == 0 and set(exceptions.EXCEPTION_COLUMNS) <= set(none.columns)


@pytest.mark.parametrize("early,recent,label", [(10.0, 11.0, "Stable"), (10.0, 11.2, "Deteriorating"), (10.0, 8.9, "Improving"), (0.0, 0.001, "Stable"), (0.0, 0.0011, "Deteriorating")])
def test_trend(spark, early, recent, label):
    delta = watchlist.trend_delta(F.lit(early), F.lit(recent))
    assert spark.range(1).select(watchlist.trend_label(delta).alias("t")).first().t == label


@pytest.mark.parametrize("det,imp,crit,want", [
    (2, 0, "High", ("Watchlist", "Deteriorating", "High")), (3, 0, "Low", ("Watchlist", "Deteriorating", "Medium")),
    (1, 2, "High", ("Monitor", "Caution", "Medium")), (1, 0, "Low", ("Monitor", "Caution", "Low")),
    (0, 2, "High", ("Clear", "Improving", "Low")), (0, 1, "High", ("Clear", "Stable", "Low")),
])
def test_watchlist_status(spark, det, imp, crit, want):
    cols = {t: F.lit("Deteriorating" if i < det else "Stable") for i, t in enumerate(watchlist.TRENDS.values())}
    deltas = {f"{s}_delta": F.lit(12.34) for s in watchlist.TRENDS}
    df = spark.range(1).withColumns({"det_count": F.lit(det), "imp_count": F.lit(imp), "regulatory_criticality": F.lit(crit), **cols, **deltas})
    r = watchlist.classify(df).first()
    assert (r.watchlist_status, r.risk_trend, r.priority) == want
    if det == 2:
        assert r.watchlist_reason == "Null rate increased 12.3%; Duplicate rate increased 12.3%"


def test_recovered_baseline_uses_the_unrounded_percentage(spark):
    df = spark.createDataFrame([("DS-012", 0.01, 0.14, "Null rate increased 16.2%; Duplicate rate increased 1192.9%")], "dataset_id string, duplicate_rate_early double, duplicate_rate_recent double, watchlist_reason string")
    assert watchlist.recovered_baseline(df).first().implied_early == 0.01083


def test_dataset_without_both_periods_is_left_out(spark):
    t = make_tests(spark, [(0, "X", "C", 1.0, "Fail"), (0, "Y", "C", 1.0, "Fail"), (20, "Y", "C", 2.0, "Fail")])
    prof = t.select("dataset_id", "test_date", F.lit(10).alias("cells"), F.lit(1).alias("null_cells"), F.lit(10).alias("profiled_rows"), F.lit(0).alias("dup_rows"))
    assert [r.dataset_id for r in watchlist.period_rates(t, prof).collect()] == ["Y"]


def test_streaks_and_escalation(spark):
    t = make_tests(spark, [(d, "X", "H", 1.0, "Fail") for d in range(0, 8)] + [(d, "X", "H", 1.0, "Fail") for d in range(10, 13)] + [(9, "X", "H", 0.0, "Pass")])
    assert sorted(r.streak_days for r in remediation.failure_streaks(t).collect()) == [3, 8]
    (r,) = remediation.escalate_streaks(t, _rules(spark)).collect()
    assert (r.longest_streak, r.current_severity, r.escalated_severity) == (8, "High", "Critical")


def test_resolved_is_on_time_and_overdue_days(spark):
    t = _tickets(spark, [("Critical", 1, 1, 1)])
    rows = {r.ticket_id: (r.sla_status, r.days_overdue) for r in remediation.sla_tracking(t, F.lit(D0)).collect()}
    assert rows == {"REM-0001": ("ON_TIME", 0), "REM-0002": ("OVERDUE", 39), "REM-0003": ("OPEN", 0)}
