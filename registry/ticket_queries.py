"""Registered ticket queries: every order is a ticket, its lines give the resolution date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import analysis, remediation

from .core import register, table

c = F.col
AS_OF_TEXT = "2001-08-01"


def as_of(days_back: int = 0):
    return F.lit(dt.date(2001, 8, 1) - dt.timedelta(days=days_back))


def order_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets without a resolution date: one scan of orders."""
    o = table(spark, sf, "orders")
    pr = c("o_orderpriority")
    severity = F.when(pr == "1-URGENT", "Critical").when(pr == "2-HIGH", "High").when(pr == "3-MEDIUM", "Medium").otherwise("Low")
    status = F.when(c("o_orderstatus") == "F", "Resolved").when(c("o_orderstatus") == "P", "In Progress").otherwise("Open")
    verified = (c("o_orderstatus") == "F") & (c("o_orderkey") % 3 != 0)
    return o.select(
        F.concat(F.lit("REM-"), c("o_orderkey").cast("string")).alias("ticket_id"), "o_orderkey", "o_custkey",
        severity.alias("severity"), status.alias("status"), F.to_date("o_orderdate").alias("open_date"),
        F.concat(F.lit("TEAM-"), (c("o_custkey") % 6).cast("string")).alias("owner"),
        F.concat(F.lit("RC"), (c("o_orderkey") % 5).cast("string")).alias("root_cause"),
        F.when(verified, "Verified").otherwise("Pending").alias("verification_status"),
    )


def sla_tickets(spark, sf, days_back: int = 0) -> DataFrame:
    return remediation.with_sla(order_tickets(spark, sf), as_of(days_back))


def resolved_tickets(spark, sf) -> DataFrame:
    """Adds the resolution date: the last ship date of a resolved order's lines."""
    lines = table(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.max(F.to_date("l_shipdate")).alias("_last"))
    t = sla_tickets(spark, sf).join(lines, "o_orderkey", "left")
    return t.withColumn("resolution_date", F.when(c("status") == "Resolved", c("_last"))).drop("_last")


SEVERITY = "CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium' ELSE 'Low' END"
TICKETS = f"""WITH t0 AS (SELECT 'REM-' || o_orderkey AS ticket_id, o_orderkey, o_custkey, {SEVERITY} AS severity,
    CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'P' THEN 'In Progress' ELSE 'Open' END AS status, CAST(o_orderdate AS DATE) AS open_date,
    'TEAM-' || o_custkey % 6 AS owner, 'RC' || o_orderkey % 5 AS root_cause,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 <> 0 THEN 'Verified' ELSE 'Pending' END AS verification_status, DATE '{AS_OF_TEXT}' AS today FROM orders),
  t1 AS (SELECT *, CASE severity WHEN 'Critical' THEN 1 WHEN 'High' THEN 3 WHEN 'Medium' THEN 7 ELSE 14 END AS days FROM t0),
  tk AS (SELECT *, open_date + days AS sla_date, (today > open_date + days AND status <> 'Resolved') AS sla_breach FROM t1),
  tr AS (SELECT tk.*, CASE WHEN status = 'Resolved' THEN last END AS resolution_date FROM tk LEFT JOIN (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS last FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)
"""
BREACH = "count(*) AS total, count(*) FILTER (WHERE sla_breach) AS breached, round(100e0 * count(*) FILTER (WHERE sla_breach) / count(*), 1) AS breach_rate"

register("r02_sla_breach", lambda s, sf: sla_tickets(s, sf).select("ticket_id", "severity", "sla_date", "sla_breach"),
         TICKETS + "SELECT ticket_id, severity, sla_date, sla_breach FROM tk")
register("r03_sla_tracking",
         lambda s, sf: remediation.sla_tracking(sla_tickets(s, sf), as_of()).select("ticket_id", "status", "sla_threshold_days", "days_open", "sla_status", "days_overdue").orderBy(c("days_overdue").desc(), "ticket_id"),
         TICKETS + """SELECT ticket_id, status, days AS sla_threshold_days, CAST(today - open_date AS INT) AS days_open,
            CASE WHEN status = 'Resolved' THEN 'ON_TIME' WHEN today > sla_date THEN 'OVERDUE' ELSE 'OPEN' END AS sla_status,
            CAST(CASE WHEN today > sla_date AND status <> 'Resolved' THEN today - sla_date ELSE 0 END AS INT) AS days_overdue FROM tk ORDER BY days_overdue DESC, ticket_id""")
register("r04_stored_vs_live", lambda s, sf: remediation.stored_vs_live(sla_tickets(s, sf, 30), as_of()),
         TICKETS + """SELECT count(*) AS tickets, count(*) FILTER (WHERE live <> stored) AS mismatches, count(*) FILTER (WHERE live) AS live_breaches, count(*) FILTER (WHERE stored) AS stored_breaches
            FROM (SELECT sla_breach AS live, (today - 30 > sla_date AND status <> 'Resolved') AS stored FROM tk)""")
register("r05_breach_by_severity", lambda s, sf: remediation.breach_by(sla_tickets(s, sf), c("severity")),
         TICKETS + f"SELECT severity, {BREACH}, count(*) FILTER (WHERE status = 'Resolved') AS ever_resolved, round(100e0 * count(*) FILTER (WHERE status = 'Resolved') / count(*), 1) AS pct_ever_resolved FROM tk GROUP BY 1")
register("r06_resolution_time", lambda s, sf: remediation.resolution_time(resolved_tickets(s, sf)),
         TICKETS + "SELECT coalesce(severity, 'All') AS severity, count(*) AS resolved, round(CAST(sum(resolution_date - open_date) AS DOUBLE) / count(*), 4) AS mean_days FROM tr WHERE resolution_date IS NOT NULL GROUP BY ROLLUP (severity)")
register("r07_breach_by_weekday", lambda s, sf: remediation.breach_by_weekday(sla_tickets(s, sf)),
         TICKETS + f"SELECT CAST(dayofweek(open_date) AS INT) AS weekday, {BREACH} FROM tk GROUP BY 1")
register("r11_stacked_by_severity", lambda s, sf: remediation.stacked_by_severity(resolved_tickets(s, sf)),
         TICKETS + "SELECT severity, count(*) FILTER (WHERE status = 'Resolved') AS resolved, count(*) FILTER (WHERE sla_breach) AS overdue, count(*) FILTER (WHERE status <> 'Resolved' AND NOT sla_breach) AS on_track, count(*) FILTER (WHERE resolution_date > sla_date) AS resolved_late FROM tr GROUP BY 1")
register("r12_distributions", lambda s, sf: remediation.distribution(order_tickets(s, sf), ["status", "owner", "root_cause"]),
         TICKETS + " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS value, count(*) AS tickets, round(100e0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM tk GROUP BY {f}" for f in ("status", "owner", "root_cause")))
register("r13_verification_gap", lambda s, sf: remediation.verification_gap(order_tickets(s, sf)),
         TICKETS + "SELECT count(*) AS tickets, count(*) FILTER (WHERE status = 'Resolved') AS resolved, count(*) FILTER (WHERE verification_status = 'Verified') AS verified, count(*) FILTER (WHERE verification_status <> 'Verified') AS pending, count(*) FILTER (WHERE status = 'Resolved' AND verification_status <> 'Verified') AS resolved_unverified FROM tk")


def _criticality(spark, sf):
    n = c("c_nationkey") % 3
    return table(spark, sf, "customer").select(
        c("c_custkey").alias("o_custkey"), F.when(n == 0, "High").when(n == 1, "Medium").otherwise("Low").alias("regulatory_criticality"))


register("r15_tiered_sla", lambda s, sf: remediation.tiered_sla(order_tickets(s, sf), "o_custkey", _criticality(s, sf), as_of()),
         TICKETS + """SELECT *, round(100e0 * standard_breaches / tickets, 1) AS standard_rate, round(100e0 * tiered_breaches / tickets, 1) AS tiered_rate FROM (
            SELECT severity, crit AS regulatory_criticality, count(*) AS tickets, count(*) FILTER (WHERE sla_breach) AS standard_breaches,
            count(*) FILTER (WHERE status <> 'Resolved' AND (today - open_date) * 24 > CASE WHEN severity = 'Critical' AND crit = 'High' THEN 12 ELSE days * 24 END) AS tiered_breaches
            FROM tk JOIN (SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS crit FROM customer) ON c_custkey = o_custkey GROUP BY 1, 2)""")
register("d23_ticket_list",
         lambda s, sf: analysis.tickets_listed(sla_tickets(s, sf), ["Critical", "High"], ["Open", "Assigned", "In Progress", "Escalated"]).select("ticket_id", "severity", "status", "open_date", "sla_breach"),
         TICKETS + "SELECT ticket_id, severity, status, open_date, sla_breach FROM tk WHERE severity IN ('Critical','High') AND status IN ('Open','Assigned','In Progress','Escalated') ORDER BY severity, open_date")
register("d24_ticket_kpis", lambda s, sf: analysis.ticket_kpis(sla_tickets(s, sf)),
         TICKETS + "SELECT count(*) AS total_tickets, count(*) FILTER (WHERE status IN ('Open','Assigned','In Progress')) AS open_issues, count(*) FILTER (WHERE status = 'Escalated') AS escalated, count(*) FILTER (WHERE status = 'Resolved') AS resolved, count(*) FILTER (WHERE sla_breach) AS sla_breaches, round(100e0 * count(*) FILTER (WHERE NOT sla_breach) / count(*), 1) AS sla_compliance FROM tk")
