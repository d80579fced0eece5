"""Governance bindings: datasets are nations, domains are regions, the fact is ``events``."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import fixed_values as V
from plumbline import schemas
from plumbline.functions.exprs import small_table
from plumbline.operators import controls, exceptions, remediation, trust, watchlist
from plumbline.operators.controls import Control
from plumbline.session import settle

from .core import table
from .event_data import CTES as EVENT_CTES
from .event_data import dirty_events

# rule id, name, category, threshold, severity, scope SQL, predicate SQL (for the DuckDB side)
RULES = (
    ("COMP-A", "Payload key present", "Completeness", 99.0, "Critical", "true", "json_extract_string(props, '$.k') <> '0'"),
    ("ACCU-A", "Value within upper range", "Accuracy", 95.0, "Critical", "true", "value <= 150"),
    ("ACCU-B", "Value at least one", "Accuracy", 90.0, "High", "true", "value >= 1"),
    ("ACCU-C", "Value within narrow range", "Accuracy", 99.0, "Medium", "true", "value <= 100"),
    ("CONS-A", "No error events", "Consistency", 80.0, "High", "true", "event_type <> 'error'"),
    ("CONS-B", "Purchases have a real value", "Consistency", 85.0, "Medium", "event_type = 'purchase'", "value >= 5"),
    ("CONS-C", "Refunds have a value", "Consistency", 90.0, "High", "event_type = 'refund'", "value > 0"),
    ("TIME-A", "Arrives after six", "Timeliness", 70.0, "Low", "true", "hour(ts) >= 6"),
    ("COMP-Z", "Test events carry a value", "Completeness", 99.0, "Low", "event_type = 'test'", "value IS NOT NULL"),
)
# declared mapping: rule k applies to data set d unless (d + k) % 7 = 0; one data set and one rule
# are mapped nowhere, and COMP-Z never has rows in scope
UNMAPPED_DATASET, UNMAPPED_RULE, MAPPED_OUT = 24, 7, 7
KEY = ["user_id", "_key0"]  # an event of one kind by one user is expected once in a period
TEAMS = ("Data Engineering Team", "Source System Team", "Data Governance Office", "Finance Operations", "Risk Technology", "CRM Team")
CAUSES = ("Source System Failure", "ETL Failure", "Manual Entry Error", "Mapping Issue", "Feed Delay")
STATUSES = ("Resolved", "Open", "In Progress", "Escalated", "Assigned")


def gov_controls() -> list[Control]:
    k, v, kind = F.get_json_object("props", "$.k"), F.col("value"), F.col("event_type")
    return [
        Control("COMP-A", k != "0"), Control("ACCU-A", v <= 150), Control("ACCU-B", v >= 1), Control("ACCU-C", v <= 100),
        Control("CONS-A", kind != "error"), Control("CONS-B", v >= 5, kind == "purchase"), Control("CONS-C", v > 0, kind == "refund"),
        Control("TIME-A", F.hour("ts") >= 6), Control("COMP-Z", v.isNotNull(), kind == "test"),
    ]


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


class Governance:
    """The governance tables of one scale factor, each derived lazily from the base tables.

    With ``settled`` the test history and the profile (one row per dataset, rule and day) are
    written once to the shared folder and read back: what builds several layers on them scans
    the fact table once for each, and a lost executor does not bring that scan back. The
    reference date is the latest date of the test history, or ``days_back`` days before it.
    """

    def __init__(self, spark: SparkSession, sf: str, settled: bool = False, days_back: int = 0):
        self.spark, self.sf, self.settled, self.days_back = spark, sf, settled, days_back

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf, name)

    @cached_property
    def inventory(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        key, name = F.col("n_nationkey"), F.col("n_name")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            key.alias("dataset_id"), name.alias("dataset_name"), F.col("r_name").alias("domain"),
            _pick(("Regulatory Critical", "Business Critical", "Operational Critical", "Reference Data"), key).alias("category"),
            F.concat(F.lit("Head of "), name).alias("owner"), F.concat(F.lit("Steward of "), name).alias("steward"),
            _pick(("Daily", "Weekly", "Monthly"), key).alias("refresh_frequency"),
            F.concat(F.lit("SYS-"), (key % 5).cast("string")).alias("source_system"),
            _pick(("High", "Medium", "Low"), key).alias("regulatory_criticality"),
        )

    @cached_property
    def rulebook(self) -> DataFrame:
        return small_table(self.spark, schemas.RULEBOOK_DDL, [r[:5] for r in RULES])

    @cached_property
    def counters(self) -> DataFrame:
        """Daily counters per dataset: one scan of the events, reduced on the events' own keys,
        then joined to the customer and rolled up to the nation."""
        per_key = controls.control_counters(self.table("events"), ["user_id", F.to_date("ts").alias("test_date")], gov_controls())
        return controls.roll_up(per_key.join(self.owners, "user_id"), ["dataset_id", "test_date"])

    @cached_property
    def owners(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("dataset_id"))

    @cached_property
    def tests(self) -> DataFrame:
        tests = controls.test_results(self.counters, self.rulebook, self.bridge)
        return settle(tests, "test-history") if self.settled else tests

    @cached_property
    def key_days(self) -> DataFrame:
        """Rows and null cells of the events with defects per dataset, day and key (user and event)."""
        events = dirty_events(self.spark, self.sf, [F.col("user_id"), F.to_date("ts").alias("test_date")])
        per_key = watchlist.key_counts(events, ["visitorid", "event", "itemid"], ["event"], ["user_id", "test_date"])
        counts = per_key.join(self.owners, "user_id").select("dataset_id", "test_date", *KEY, "_n", "_nulls")
        return settle(counts, "key-days") if self.settled else counts

    @cached_property
    def profile(self) -> DataFrame:
        """Null cells, repeated events and a sketch of the keys, per dataset and day."""
        measured = watchlist.profile_of(self.key_days, 3, ["dataset_id", "test_date"], KEY)
        return settle(measured, "profile") if self.settled else measured

    def rates(self, as_of=None) -> DataFrame:
        return watchlist.period_rates(self.tests, self.profile, self.as_of if as_of is None else as_of, counts=self.key_days, key=KEY)

    @cached_property
    def bridge(self) -> DataFrame:
        """The declared mapping of datasets to rules."""
        rules = F.array(*[F.lit(r[0]) for r in RULES])
        pairs = self.inventory.select("dataset_id", F.posexplode(rules).alias("k", "rule_id"))
        mapped = (F.col("dataset_id") != UNMAPPED_DATASET) & (F.col("k") != UNMAPPED_RULE) & ((F.col("dataset_id") + F.col("k")) % MAPPED_OUT != 0)
        return pairs.filter(mapped).select("dataset_id", "rule_id")

    @cached_property
    def as_of(self):
        """The latest date of the test history, less ``days_back`` days."""
        latest = self.tests.agg(F.max("test_date").alias("v"))
        day = F.lit(latest.first().v) if self.settled else latest.scalar()
        return F.date_sub(day, self.days_back) if self.days_back else day

    @cached_property
    def watchlist(self) -> DataFrame:
        return self.watchlist_at(0)

    def watchlist_at(self, days_back: int) -> DataFrame:
        as_of = F.date_sub(self.as_of, days_back) if days_back else self.as_of
        return watchlist.watchlist(self.tests, self.profile, self.inventory, as_of, counts=self.key_days, key=KEY)

    @cached_property
    def history(self) -> DataFrame:
        return watchlist.history(self.tests, self.profile)

    @cached_property
    def plain_exceptions(self) -> DataFrame:
        """Exceptions without their sequential ids, for everything that only counts them."""
        return exceptions.detect(self.tests, self.rulebook, self.inventory, self.as_of, with_ids=False)

    @cached_property
    def exceptions(self) -> DataFrame:
        return exceptions.detect(self.tests, self.rulebook, self.inventory, self.as_of)

    @cached_property
    def tickets(self) -> DataFrame:
        """One ticket per exception with a workflow state derived from its number."""
        no = F.substring_index("exception_id", "-", -1).cast("int")
        opened = F.date_sub("detected_date", (no % 11).cast("int"))
        return remediation.raise_tickets(
            self.exceptions, self.as_of, open_date=opened, status=_pick(STATUSES, no), owner=_pick(TEAMS, no),
            root_cause=_pick(CAUSES, no), resolution=F.date_add(opened, (no % 3 + 1).cast("int")))

    @cached_property
    def trust_exact(self) -> DataFrame:
        return trust.domain_trust_exact(self.tests, self.watchlist, self.inventory, self.as_of)

    @cached_property
    def trust(self) -> DataFrame:
        return trust.trust_scores(self.tests, self.watchlist, self.inventory, self.as_of)

    @cached_property
    def maturity(self) -> DataFrame:
        return trust.governance_maturity(self.bridge, self.inventory, self.rulebook, self.tickets)


# ------------------------------------------------------------------ SQL side
def _case(values, expr):
    return f"CASE {expr} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _cells() -> str:
    parts = [
        f"SELECT c_nationkey AS dataset_id, CAST(ts AS DATE) AS test_date, '{r[0]}' AS rule_id, count(*) AS total_records, "
        f"count(*) FILTER (WHERE NOT coalesce({r[6]}, false)) AS fail_count FROM events JOIN customer ON user_id = c_custkey WHERE {r[5]} GROUP BY 1, 2"
        for r in RULES
    ]
    return "\nUNION ALL ".join(parts)


SIGNAL_RATES = ("null_rate", "duplicate_rate", "control_failure_rate")


def watchlist_ctes(name: str, as_of: str, min_move: float | None = None) -> dict[str, str]:
    """Watchlist at a date as a chain of CTEs ending in ``name``."""
    early, recent = f"test_date > {as_of} - 30 AND test_date <= {as_of} - 15", f"test_date > {as_of} - 15 AND test_date <= {as_of}"
    delta = {s: f"({s}_recent - {s}_early) / greatest({s}_early, 0.01e0) * 100e0" for s in SIGNAL_RATES}
    tname = {"null_rate": "null_rate_trend", "duplicate_rate": "duplicate_rate_trend", "control_failure_rate": "control_failure_trend"}
    guard = {s: "" if min_move is None else f"abs({s}_recent - {s}_early) >= {min_move}e0 AND " for s in SIGNAL_RATES}
    trends = ", ".join(
        f"CASE WHEN {guard[s]}{s}_delta > 10 THEN 'Deteriorating' WHEN {guard[s]}{s}_delta < -10 THEN 'Improving' ELSE 'Stable' END AS {tname[s]}" for s in SIGNAL_RATES)

    def count(label):
        return " + ".join(f"({tname[s]} = '{label}')::INT" for s in SIGNAL_RATES)

    texts = {"null_rate": "Null rate increased %.1f%%", "duplicate_rate": "Duplicate rate increased %.1f%%", "control_failure_rate": "Control failure rate worsening (%.1f%%)"}
    reason = ", ".join(f"CASE WHEN {tname[s]} = 'Deteriorating' THEN printf('{texts[s]}', round({s}_delta, 1)) END" for s in SIGNAL_RATES)
    return {
        f"{name}_r": f"""SELECT dataset_id, f.e AS control_failure_rate_early, f.r AS control_failure_rate_recent,
            p.ne AS null_rate_early, p.nr AS null_rate_recent, q.de AS duplicate_rate_early, q.dr AS duplicate_rate_recent FROM
            (SELECT dataset_id, sum(CAST(round(failure_rate * 100) AS BIGINT)) FILTER (WHERE {early}) / (100e0 * count(*) FILTER (WHERE {early})) AS e,
                sum(CAST(round(failure_rate * 100) AS BIGINT)) FILTER (WHERE {recent}) / (100e0 * count(*) FILTER (WHERE {recent})) AS r FROM gt GROUP BY 1) f JOIN
            (SELECT dataset_id, 100e0 * sum(null_cells) FILTER (WHERE {early}) / sum(cells) FILTER (WHERE {early}) AS ne,
                100e0 * sum(null_cells) FILTER (WHERE {recent}) / sum(cells) FILTER (WHERE {recent}) AS nr
                FROM prof GROUP BY 1) p USING (dataset_id) JOIN
            (SELECT dataset_id, 100e0 * (sum(e) - count(*) FILTER (WHERE e > 0)) / nullif(sum(e), 0) AS de, 100e0 * (sum(r) - count(*) FILTER (WHERE r > 0)) / nullif(sum(r), 0) AS dr FROM (
                SELECT dataset_id, user_id, event, coalesce(sum(n) FILTER (WHERE {early}), 0) AS e, coalesce(sum(n) FILTER (WHERE {recent}), 0) AS r FROM kd GROUP BY 1, 2, 3) GROUP BY 1) q USING (dataset_id)
            WHERE f.e IS NOT NULL AND f.r IS NOT NULL AND NOT isnan(f.e) AND NOT isnan(f.r) AND ne IS NOT NULL AND nr IS NOT NULL AND de IS NOT NULL AND dr IS NOT NULL""",
        f"{name}_t": f"SELECT *, {trends} FROM (SELECT *, {', '.join(f'{delta[s]} AS {s}_delta' for s in SIGNAL_RATES)} FROM {name}_r)",
        f"{name}_c": f"SELECT *, {count('Deteriorating')} AS det_count, {count('Improving')} AS imp_count FROM {name}_t",
        name: f"""SELECT c.dataset_id, dataset_name, domain, regulatory_criticality, {', '.join(f'round({s}_{p}, 2) AS {s}_{p}' for s in SIGNAL_RATES for p in ('early', 'recent'))},
            null_rate_trend, duplicate_rate_trend, control_failure_trend, det_count, imp_count,
            CASE WHEN det_count >= 2 THEN 'Watchlist' WHEN det_count = 1 THEN 'Monitor' ELSE 'Clear' END AS watchlist_status,
            CASE WHEN det_count >= 2 THEN 'Deteriorating' WHEN det_count = 1 THEN 'Caution' WHEN imp_count >= 2 THEN 'Improving' ELSE 'Stable' END AS risk_trend,
            CASE WHEN det_count >= 2 THEN CASE WHEN regulatory_criticality = 'High' THEN 'High' ELSE 'Medium' END
                 WHEN det_count = 1 THEN CASE WHEN regulatory_criticality = 'High' THEN 'Medium' ELSE 'Low' END ELSE 'Low' END AS priority,
            CASE WHEN det_count >= 2 THEN concat_ws('; ', {reason}) WHEN det_count = 1 THEN '{V.MONITOR_REASON}'
                 WHEN imp_count >= 2 THEN '{V.IMPROVING_REASON}' ELSE '{V.STABLE_REASON}' END AS watchlist_reason,
            CASE WHEN det_count >= 2 THEN '{V.WATCHLIST_ACTION}' WHEN det_count = 1 THEN '{V.MONITOR_ACTION}'
                 WHEN imp_count >= 2 THEN '{V.IMPROVING_ACTION}' ELSE '{V.STABLE_ACTION}' END AS recommended_action,
            {as_of} AS review_date FROM {name}_c c JOIN inv USING (dataset_id)""",
    }


AS_OF = "(SELECT max(test_date) FROM gt)"

CTES: dict[str, str] = {
    "inv": f"""SELECT n_nationkey AS dataset_id, n_name AS dataset_name, r_name AS domain,
        {_case(("Regulatory Critical", "Business Critical", "Operational Critical", "Reference Data"), "n_nationkey")} AS category,
        'Head of ' || n_name AS owner, 'Steward of ' || n_name AS steward, {_case(("Daily", "Weekly", "Monthly"), "n_nationkey")} AS refresh_frequency,
        'SYS-' || n_nationkey % 5 AS source_system, {_case(("High", "Medium", "Low"), "n_nationkey")} AS regulatory_criticality
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "rb": "SELECT * FROM (VALUES " + ", ".join(f"('{r[0]}', '{r[1]}', '{r[2]}', {r[3]}e0, '{r[4]}')" for r in RULES) + ") AS t(rule_id, rule_name, category, threshold, severity)",
    "bridge": "SELECT n_nationkey AS dataset_id, rule_id FROM nation, (VALUES " + ", ".join(f"({k}, '{r[0]}')" for k, r in enumerate(RULES)) + ") AS t(k, rule_id) "
        f"WHERE n_nationkey <> {UNMAPPED_DATASET} AND k <> {UNMAPPED_RULE} AND (n_nationkey + k) % {MAPPED_OUT} <> 0",
    "cells": _cells(),
    "gt": """SELECT 'TEST-' || strftime(test_date, '%Y%m%d') || '-' || dataset_id || '-' || rule_id AS test_id, test_date, dataset_id, rule_id, total_records,
        total_records - fail_count AS pass_count, fail_count, round(100e0 * fail_count / total_records, 2) AS failure_rate,
        round(100e0 * (total_records - fail_count) / total_records, 2) AS control_effectiveness,
        CASE WHEN CAST(total_records - fail_count AS DECIMAL(30,2)) * 100 >= CAST(threshold AS DECIMAL(7,2)) * total_records THEN 'Pass' ELSE 'Fail' END AS status
        FROM cells JOIN rb USING (rule_id) JOIN bridge USING (dataset_id, rule_id)""",
    "gev": EVENT_CTES["b"].replace("SELECT event_id,", "SELECT user_id, CAST(events.ts AS DATE) AS test_date, event_id,", 1),
    "kd": """SELECT c_nationkey AS dataset_id, test_date, user_id, event, count(*) AS n, sum((visitorid IS NULL)::INT + (event IS NULL)::INT + (itemid IS NULL)::INT) AS nulls
        FROM (SELECT * FROM gev UNION ALL SELECT * FROM gev WHERE event_id % 250 = 3) JOIN customer ON user_id = c_custkey GROUP BY ALL""",
    "prof": """SELECT dataset_id, test_date, sum(n) * 3 AS cells, sum(nulls) AS null_cells, sum(n) AS profiled_rows, sum(n - 1) AS dup_rows FROM kd GROUP BY 1, 2""",
    **watchlist_ctes("wl", AS_OF),
    **watchlist_ctes("wl7", f"({AS_OF} - 7)"),
    **watchlist_ctes("wlm", AS_OF, 0.5),
    "px": f"""SELECT g.dataset_id, g.rule_id, rb.severity AS rule_severity, rule_name, dataset_name, regulatory_criticality, owner, steward,
        min(CASE WHEN g.status = 'Fail' AND test_date >= {AS_OF} - 7 THEN test_date END) AS first_fail,
        arg_min(failure_rate, test_date) FILTER (WHERE g.status = 'Fail' AND test_date >= {AS_OF} - 7) AS first_rate,
        count(*) FILTER (WHERE rn <= 5) AS ln, count(*) FILTER (WHERE rn <= 5 AND g.status = 'Fail') AS lf,
        sum(CAST(round(failure_rate * 100) AS BIGINT)) FILTER (WHERE rn <= 5) AS lh
        FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, rule_id ORDER BY test_date DESC) AS rn FROM gt) g
        JOIN rb USING (rule_id) JOIN inv USING (dataset_id) GROUP BY ALL""",
    "x1": f"""SELECT 1 AS type_rank, '{V.CRITICAL_FAILURE}' AS exception_type, dataset_id, dataset_name, rule_id, rule_name, 'Critical' AS severity, 1 AS priority,
        first_rate AS failure_rate, regulatory_criticality, 'Immediately escalate to ' || owner || '. Halt downstream reporting until resolved.' AS recommended_action
        FROM px WHERE rule_severity = 'Critical' AND first_fail IS NOT NULL""",
    "x2": f"""SELECT 2 AS type_rank, '{V.REPEATED_FAILURE}' AS exception_type, dataset_id, dataset_name, rule_id, rule_name,
        CASE WHEN rule_severity IN ('Critical','High') THEN 'High' ELSE 'Medium' END AS severity, 2 AS priority, round(lh / (100e0 * ln), 2) AS failure_rate,
        regulatory_criticality, 'Assign to ' || steward || ' for root cause investigation. Target resolution within 48 hours.' AS recommended_action
        FROM px WHERE ln >= 3 AND lf >= 3 AND NOT EXISTS (SELECT 1 FROM x1 WHERE x1.dataset_id = px.dataset_id AND x1.rule_id = px.rule_id)""",
    "x3": f"""SELECT 3 AS type_rank, '{V.REGULATORY_ISSUE}' AS exception_type, dataset_id, dataset_name, rule_id, rule_name, 'Critical' AS severity, 1 AS priority,
        first_rate AS failure_rate, regulatory_criticality, '{V.REGULATORY_ACTION}' AS recommended_action
        FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY first_fail, rule_id) AS nth FROM px WHERE first_fail IS NOT NULL AND regulatory_criticality = 'High') WHERE nth = 1""",
    "ex": f"""SELECT printf('EXC-%04d', row_number() OVER (ORDER BY type_rank, dataset_id, rule_id)) AS exception_id, *, {AS_OF} AS detected_date
        FROM (SELECT * FROM x1 UNION ALL SELECT * FROM x2 UNION ALL SELECT * FROM x3)""",
    "tk0": f"""SELECT *, CAST(substr(exception_id, 5) AS INT) AS no FROM ex""",
    "tk1": f"""SELECT 'REM-' || substr(exception_id, 5) AS ticket_id, exception_id, dataset_id, dataset_name, rule_id, rule_name, severity, exception_type, no,
        {_case(STATUSES, "no")} AS status, {_case(TEAMS, "no")} AS owner, {_case(CAUSES, "no")} AS root_cause, detected_date - no % 11 AS open_date FROM tk0""",
    "tk2": """SELECT *, open_date + CASE severity WHEN 'Critical' THEN 1 WHEN 'High' THEN 3 WHEN 'Medium' THEN 7 WHEN 'Low' THEN 14 ELSE 7 END AS sla_date FROM tk1""",
    "tk": f"""SELECT ticket_id, exception_id, dataset_id, dataset_name, rule_id, rule_name, severity, status, owner, open_date, sla_date,
        ({AS_OF} > sla_date AND status <> 'Resolved') AS sla_breach, root_cause,
        CASE WHEN status = 'Resolved' THEN open_date + no % 3 + 1 END AS resolution_date,
        CASE WHEN status = 'Resolved' THEN 'Verified' ELSE 'Pending' END AS verification_status,
        'Ticket raised for ' || exception_type || ' on ' || dataset_name || '.' AS notes FROM tk2""",
    "te": f"""SELECT domain, sum(CAST(round(control_effectiveness * 100) AS BIGINT)) / (100e0 * count(*)) AS avg_control_effectiveness,
        count(*) AS tests, count(*) FILTER (WHERE status = 'Pass') AS passes
        FROM gt JOIN inv USING (dataset_id) WHERE test_date >= {AS_OF} - 7 GROUP BY 1""",
    "tx": """SELECT te.*, coalesce(w, 0) AS watchlist_count, coalesce(m, 0) AS monitor_count, dataset_count,
        least(greatest(avg_control_effectiveness - (3e0 * coalesce(w, 0) + 1e0 * coalesce(m, 0)), 0e0), 100e0) AS trust_score FROM te
        LEFT JOIN (SELECT domain, count(*) FILTER (WHERE watchlist_status = 'Watchlist') AS w, count(*) FILTER (WHERE watchlist_status = 'Monitor') AS m FROM wl GROUP BY 1) USING (domain)
        JOIN (SELECT domain, count(*) AS dataset_count FROM inv GROUP BY 1) USING (domain)""",
    "ta": """SELECT domain, trust_score, avg_control_effectiveness, dataset_count FROM tx UNION ALL
        SELECT 'Enterprise (Overall)', avg(trust_score), avg(avg_control_effectiveness), (SELECT count(*) FROM inv) FROM tx""",
    "tr": """SELECT domain, round(trust_score, 1) AS trust_score, CASE WHEN trust_score >= 90 THEN 'Trusted' WHEN trust_score >= 75 THEN 'Monitor' ELSE 'At Risk' END AS trust_category,
        round(avg_control_effectiveness, 1) AS avg_control_effectiveness, dataset_count FROM ta""",
    "mt0": """SELECT round(100e0 * (SELECT count(DISTINCT dataset_id) FROM bridge) / (SELECT count(*) FROM inv), 1) AS control_coverage, 85e0 AS automation_pct,
        (SELECT CASE WHEN count(*) > 0 THEN round(100e0 * count(*) FILTER (WHERE NOT sla_breach) / count(*), 1) ELSE 100e0 END FROM tk) AS sla_compliance, 100e0 AS audit_completeness""",
    "mt": """SELECT round(s, 1) AS maturity_score, CASE WHEN s >= 90 THEN 'Optimized' WHEN s >= 75 THEN 'Managed' WHEN s >= 60 THEN 'Developing' ELSE 'Initial' END AS maturity_level,
        control_coverage, automation_pct, sla_compliance, audit_completeness FROM
        (SELECT *, control_coverage * 0.3e0 + automation_pct * 0.3e0 + sla_compliance * 0.25e0 + audit_completeness * 0.15e0 AS s FROM mt0)""",
    "wh0": """SELECT dataset_id, test_date, test_date - DATE '1970-01-01' AS d, rh, rn, null_cells, cells, dup_rows, profiled_rows FROM
        (SELECT dataset_id, test_date, sum(CAST(round(failure_rate * 100) AS BIGINT)) AS rh, count(*) AS rn FROM gt GROUP BY 1, 2) FULL JOIN prof USING (dataset_id, test_date)""",
    "whk": """SELECT dataset_id, wh0.test_date, count(DISTINCT (user_id, event)) FILTER (WHERE kd.test_date <= wh0.test_date - 15) AS ke, count(DISTINCT (user_id, event)) FILTER (WHERE kd.test_date > wh0.test_date - 15) AS kr
        FROM wh0 LEFT JOIN kd USING (dataset_id) WHERE kd.test_date IS NULL OR kd.test_date BETWEEN wh0.test_date - 29 AND wh0.test_date GROUP BY 1, 2""",
    "wh1": """SELECT dataset_id, test_date, sum(rh) OVER e / (100e0 * sum(rn) OVER e) AS control_failure_rate_early, sum(rh) OVER r / (100e0 * sum(rn) OVER r) AS control_failure_rate_recent,
        100e0 * sum(null_cells) OVER e / sum(cells) OVER e AS null_rate_early, 100e0 * sum(null_cells) OVER r / sum(cells) OVER r AS null_rate_recent,
        100e0 * (sum(profiled_rows) OVER e - ke) / sum(profiled_rows) OVER e AS duplicate_rate_early, 100e0 * (sum(profiled_rows) OVER r - kr) / sum(profiled_rows) OVER r AS duplicate_rate_recent
        FROM wh0 JOIN whk USING (dataset_id, test_date) WINDOW e AS (PARTITION BY dataset_id ORDER BY d RANGE BETWEEN 29 PRECEDING AND 15 PRECEDING), r AS (PARTITION BY dataset_id ORDER BY d RANGE BETWEEN 14 PRECEDING AND CURRENT ROW)""",
    "wh": """SELECT dataset_id, test_date, det_count, imp_count, CASE WHEN det_count >= 2 THEN 'Watchlist' WHEN det_count = 1 THEN 'Monitor' ELSE 'Clear' END AS watchlist_status FROM (
        SELECT dataset_id, test_date, """ + ", ".join(
            "(" + " + ".join(f"(({s}_recent - {s}_early) / greatest({s}_early, 0.01e0) * 100e0 {op})::INT" for s in SIGNAL_RATES) + f") AS {n}"
            for n, op in (("det_count", "> 10"), ("imp_count", "< -10"))) +
        """ FROM wh1 WHERE control_failure_rate_early IS NOT NULL AND null_rate_early IS NOT NULL AND duplicate_rate_early IS NOT NULL)""",
}


def sql(body: str, days_back: int = 0, **more: str) -> str:
    """``body`` behind the CTEs it needs (found by name, transitively).

    With ``days_back`` the test history ends so many days before its latest date.
    """
    import re

    every: dict[str, str] = {}
    for name, text in {**CTES, **more}.items():
        if name == "gt" and days_back:
            every["gt_all"] = text
            text = f"SELECT * FROM gt_all WHERE test_date <= (SELECT max(test_date) FROM gt_all) - {days_back}"
        every[name] = text
    need: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\b[a-z][a-z0-9_]*\b", text)):
            if word in every and word not in need:
                need.add(word)
                visit(every[word])

    visit(body)
    order = [n for n in every if n in need]
    # a CTE may be declared before one it uses only by mistake; declaration order is dependency order
    return "WITH " + ",\n".join(f"{n} AS ({every[n]})" for n in order) + "\n" + body
