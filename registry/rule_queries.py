"""Registered queries of the thirty executable rule forms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import fixed_values as V
from plumbline.operators import rules
from plumbline.operators.controls import default_rulebook

from .core import register, table

c = F.col
RULEBOOK = "rb AS (SELECT * FROM (VALUES " + ", ".join(f"('{r}', '{n}', '{cat}', {t}e0, '{s}')" for r, n, cat, t, s in V.RULEBOOK) + ") AS t(rule_id, rule_name, category, threshold, severity))"


def graded(counts: str, prefix: str = "") -> str:
    """SQL that grades (rule_id, total_records, fail_count) rows."""
    return (f"WITH {RULEBOOK}{', ' + prefix if prefix else ''}, cnt AS ({counts}) "
            "SELECT *, CASE WHEN CAST(pass_count AS DECIMAL(30,2)) * 100 >= CAST(threshold AS DECIMAL(7,2)) * total_records THEN 'Pass' ELSE 'Fail' END AS status FROM ("
            "SELECT rule_id, rule_name, category, severity, threshold, total_records, total_records - fail_count AS pass_count, fail_count, "
            "CASE WHEN total_records > 0 THEN round(100e0 * fail_count / total_records, 2) ELSE 0e0 END AS failure_rate, "
            "CASE WHEN total_records > 0 THEN round(100e0 * (total_records - fail_count) / total_records, 2) ELSE 100e0 END AS control_effectiveness FROM cnt JOIN rb USING (rule_id))")


def row_sql(rule: str, tab: str, ok: str, scope: str = "true") -> str:
    return f"SELECT '{rule}' AS rule_id, count(*) FILTER (WHERE {scope}) AS total_records, count(*) FILTER (WHERE {scope} AND NOT coalesce({ok}, false)) AS fail_count FROM {tab}"


def add(name, counts, sql, prefix=""):
    register(name, lambda s, sf: rules.graded_rules(counts(s, sf), default_rulebook(s)), graded(sql, prefix))


def band():
    return rules.band_matches(c("o_totalprice"), [(400000.0, "1"), (300000.0, "2"), (200000.0, "3"), (100000.0, "4")], "5", F.substring("o_orderpriority", 1, 1))


# rule -> (table, passing expression, scope, passing SQL, scope SQL); expressions are built when a session exists
ROW_RULES = {
    "COMP-001": ("orders", lambda: rules.populated("o_custkey"), None, "o_custkey IS NOT NULL", "true"),
    "COMP-002": ("lineitem", lambda: rules.populated("l_extendedprice"), None, "l_extendedprice IS NOT NULL", "true"),
    "COMP-003": ("customer", lambda: rules.not_blank("c_name"), None, "trim(c_name) <> ''", "true"),
    "COMP-004": ("customer", lambda: rules.populated("c_mktsegment"), None, "c_mktsegment IS NOT NULL", "true"),
    "COMP-005": ("part", lambda: rules.populated("p_brand"), None, "p_brand IS NOT NULL", "true"),
    "COMP-006": ("supplier", lambda: rules.populated("s_nationkey"), None, "s_nationkey IS NOT NULL", "true"),
    "COMP-007": ("orders", lambda: rules.populated("o_orderstatus"), None, "o_orderstatus IS NOT NULL", "true"),
    "COMP-008": ("events", lambda: F.get_json_object("props", "$.k").isNotNull(), lambda: c("event_type") != "error", "json_extract_string(props, '$.k') IS NOT NULL", "event_type <> 'error'"),
    "ACCU-001": ("lineitem", lambda: c("l_extendedprice") > 0, None, "l_extendedprice > 0", "true"),
    "ACCU-002": ("lineitem", lambda: F.to_date("l_shipdate").between(F.lit(dt.date(1995, 1, 1)), F.lit(dt.date(2001, 8, 1))), None, "CAST(l_shipdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-08-01'", "true"),
    "ACCU-003": ("part", lambda: rules.in_range("p_size", 2, 48), None, "p_size BETWEEN 2 AND 48", "true"),
    "ACCU-004": ("customer", lambda: rules.in_range("c_acctbal", 0.0, 10000.0), None, "c_acctbal BETWEEN 0 AND 10000", "true"),
    "ACCU-005": ("lineitem", lambda: rules.in_range("l_discount", 0.0, 0.08), None, "l_discount BETWEEN 0e0 AND 0.08e0", "true"),
    "ACCU-006": ("customer", lambda: rules.matches("c_name", "^Customer#[0-9]{9}$"), None, "regexp_matches(c_name, '^Customer#[0-9]{9}$')", "true"),
    "ACCU-008": ("part", lambda: c("p_retailprice") > 0, None, "p_retailprice > 0", "true"),
    "CONS-005": ("orders", band, None, "CASE WHEN o_totalprice >= 400000 THEN '1' WHEN o_totalprice >= 300000 THEN '2' WHEN o_totalprice >= 200000 THEN '3' WHEN o_totalprice >= 100000 THEN '4' ELSE '5' END = substr(o_orderpriority, 1, 1)", "true"),
}


def fused(spark, sf, tab: str, chosen) -> DataFrame:
    """All chosen row rules of one table in one scan."""
    specs = {r: (ROW_RULES[r][1](), ROW_RULES[r][2]() if ROW_RULES[r][2] else None) for r in chosen}
    return rules.row_rules(table(spark, sf, tab), specs)


def _key(rule: str) -> str:
    names = {r: n for r, n, *_ in V.RULEBOOK}
    return f"rule_{rule.lower().replace('-', '')}_" + names[rule].lower().replace(" ", "_").replace("-", "_")


for _rule, (_tab, _, _, _ok, _scope) in ROW_RULES.items():
    add(_key(_rule), lambda s, sf, r=_rule, t=_tab: fused(s, sf, t, [r]), row_sql(_rule, _tab, _ok, _scope))

FK = "SELECT '{r}' AS rule_id, count(*) AS total_records, count(*) FILTER (WHERE {k} IS NULL OR {k} NOT IN (SELECT {pk} FROM {p})) AS fail_count FROM {t}"
add(_key("ACCU-007"), lambda s, sf: rules.totals_match("ACCU-007", table(s, sf, "orders"), "o_orderkey", "o_totalprice", table(s, sf, "lineitem"), "l_orderkey", "l_extendedprice", 0.01),
    "SELECT 'ACCU-007' AS rule_id, count(*) AS total_records, count(*) FILTER (WHERE abs(s - CAST(o_totalprice AS DECIMAL(38,6))) > 0.01) AS fail_count FROM orders JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(38,6))) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
add(_key("CONS-001"), lambda s, sf: rules.foreign_key("CONS-001", table(s, sf, "orders"), "o_custkey", table(s, sf, "customer"), "c_custkey"), FK.format(r="CONS-001", k="o_custkey", pk="c_custkey", p="customer", t="orders"))
add(_key("CONS-002"), lambda s, sf: rules.foreign_key("CONS-002", table(s, sf, "lineitem"), "l_orderkey", table(s, sf, "orders"), "o_orderkey"), FK.format(r="CONS-002", k="l_orderkey", pk="o_orderkey", p="orders", t="lineitem"))
add(_key("CONS-003"), lambda s, sf: rules.foreign_key("CONS-003", table(s, sf, "supplier"), "s_nationkey", table(s, sf, "nation"), "n_nationkey"), FK.format(r="CONS-003", k="s_nationkey", pk="n_nationkey", p="nation", t="supplier"))
add(_key("CONS-004"), lambda s, sf: rules.foreign_key("CONS-004", table(s, sf, "lineitem"), "l_partkey", table(s, sf, "part").filter(c("p_partkey") % 10 != 7), "p_partkey"),
    FK.format(r="CONS-004", k="l_partkey", pk="p_partkey", p="part WHERE p_partkey % 10 <> 7", t="lineitem"))
add(_key("CONS-006"), lambda s, sf: rules.periods_match("CONS-006", table(s, sf, "lineitem"), "l_shipdate", "l_extendedprice", table(s, sf, "orders"), "o_orderdate", "o_totalprice", 0.001),
    """SELECT 'CONS-006' AS rule_id, count(*) AS total_records, count(*) FILTER (WHERE NOT coalesce(abs(l - o) / o <= 0.001e0, false)) AS fail_count FROM
       (SELECT date_trunc('month', l_shipdate)::DATE AS m, CAST(sum(CAST(l_extendedprice AS DECIMAL(38,6))) AS DOUBLE) AS l FROM lineitem GROUP BY 1) FULL JOIN
       (SELECT date_trunc('month', o_orderdate)::DATE AS m, CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) AS o FROM orders GROUP BY 1) USING (m)""")
add(_key("CONS-007"), lambda s, sf: rules.status_agrees("CONS-007", table(s, sf, "orders"), "o_orderkey", c("o_orderstatus") == "F", table(s, sf, "lineitem"), "l_orderkey", c("l_linestatus") == "F"),
    "SELECT 'CONS-007' AS rule_id, count(*) AS total_records, count(*) FILTER (WHERE (o_orderstatus = 'F') <> a) AS fail_count FROM orders JOIN (SELECT l_orderkey, bool_and(l_linestatus = 'F') AS a FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
add(_key("TIME-001"), lambda s, sf: rules.recent_enough("TIME-001", table(s, sf, "events"), "user_id", "ts", table(s, sf, "events").agg(F.max("ts").alias("v")).scalar(), "24 HOURS"),
    "SELECT 'TIME-001' AS rule_id, count(*) AS total_records, count(*) FILTER (WHERE last < (SELECT max(ts) FROM events) - INTERVAL 24 HOUR) AS fail_count FROM (SELECT user_id, max(ts) AS last FROM events GROUP BY 1)")
GAP = "SELECT '{r}' AS rule_id, count(prev) AS total_records, count(*) FILTER (WHERE t - prev > INTERVAL {i}) AS fail_count FROM (SELECT {t} AS t, lag({t}) OVER (PARTITION BY {k} ORDER BY {t}) AS prev FROM {src})"
add(_key("TIME-002"), lambda s, sf: rules.steady_arrival("TIME-002", table(s, sf, "events"), [c("event_type"), F.to_date("ts")], "ts", 15 * 60),
    GAP.format(r="TIME-002", t="ts", k="event_type, CAST(ts AS DATE)", src="events", i="15 MINUTE"))
add(_key("TIME-003"), lambda s, sf: rules.daily_deadline("TIME-003", table(s, sf, "events"), ["user_id"], "ts", first_before=8),
    "SELECT 'TIME-003' AS rule_id, count(*) AS total_records, count(*) FILTER (WHERE hour(f) >= 8) AS fail_count FROM (SELECT user_id, CAST(ts AS DATE) AS d, min(ts) AS f FROM events GROUP BY 1, 2)")
add(_key("TIME-004"), lambda s, sf: rules.daily_deadline("TIME-004", table(s, sf, "events"), ["event_type"], "ts", last_from=22),
    "SELECT 'TIME-004' AS rule_id, count(*) AS total_records, count(*) FILTER (WHERE hour(l) < 22) AS fail_count FROM (SELECT event_type, CAST(ts AS DATE) AS d, max(ts) AS l FROM events GROUP BY 1, 2)")
add(_key("TIME-005"), lambda s, sf: rules.next_day_deadline("TIME-005", table(s, sf, "events"), "user_id", "ts", 7),
    "SELECT 'TIME-005' AS rule_id, count(nxt) AS total_records, count(*) FILTER (WHERE nxt > CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 31 HOUR) AS fail_count FROM (SELECT ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events)")
add(_key("TIME-006"), lambda s, sf: rules.steady_arrival("TIME-006", table(s, sf, "lineitem"), [c("l_suppkey")], "l_shipdate", 31 * 86400),
    GAP.format(r="TIME-006", t="l_shipdate", k="l_suppkey", src="lineitem", i="31 DAY"))
add(_key("TIME-007"), lambda s, sf: rules.within_after("TIME-007", table(s, sf, "lineitem"), "l_orderkey", "l_shipdate", table(s, sf, "orders"), "o_orderkey", "o_orderdate", 33),
    "SELECT 'TIME-007' AS rule_id, count(*) AS total_records, count(*) FILTER (WHERE l_shipdate > o_orderdate + INTERVAL 33 HOUR) AS fail_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey")


def whole_rulebook(spark, sf) -> DataFrame:
    """All row rules in one pass per base table (the keyed rules have their own queries)."""
    by_table: dict[str, list[str]] = {}
    for rule, (tab, *_rest) in ROW_RULES.items():
        by_table.setdefault(tab, []).append(rule)
    parts = [fused(spark, sf, tab, chosen) for tab, chosen in by_table.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rules.graded_rules(out, default_rulebook(spark))


register("g05b_rulebook_row_rules", whole_rulebook, graded(" UNION ALL ".join(row_sql(r, t, ok, sc) for r, (t, _, _, ok, sc) in ROW_RULES.items())))
