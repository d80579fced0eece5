"""Registered queries of the event-quality side: checks, scores, runs, cleansing."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import fixed_values as V
from plumbline.functions.exprs import wall_micros
from plumbline.operators import checks, cleanse, runs, scoring
from plumbline.operators.checks import run_checks
from plumbline.session import settle
from plumbline.sources import catalog, sampling

from .core import register, table
from .event_data import CTES, category_tree, dirty_events, dirty_rules, item_catalog

W0, W1 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-30 23:59:59'"
IN_WINDOW = f"ts BETWEEN {W0} AND {W1}"
EVENT_COLS = "event_id, ts, visitorid, event, itemid, transactionid"
OK_EVENTS = "('view','addtocart','transaction')"


def sql(body: str, *extra: str) -> str:
    base = [f"{n} AS ({q})" for n, q in CTES.items()]
    return "WITH " + ",\n".join([*base, *extra]) + "\n" + body


# ---------------------------------------------------------------- SQL of the checks
# ``src`` carries the batch key as column k; every check returns (k, total_records, failed_records, gap_days)
def _count_check(total: str, failed: str, src: str) -> str:
    return (f"SELECT k, count(*) FILTER (WHERE {total}) AS total_records, "
            f"count(*) FILTER (WHERE {failed}) AS failed_records, NULL::INT AS gap_days FROM {src} GROUP BY k")


def check_select(rule: str, src: str) -> str:
    if rule in ("COMP-001", "COMP-002", "COMP-003"):
        col = {"COMP-001": "visitorid", "COMP-002": "itemid", "COMP-003": "event"}[rule]
        return _count_check("true", f"{col} IS NULL", src)
    if rule in ("COMP-004", "CONS-001"):
        return _count_check("event = 'transaction'", "event = 'transaction' AND transactionid IS NULL", src)
    if rule == "VALID-001":
        return _count_check("true", f"event IS NOT NULL AND event NOT IN {OK_EVENTS}", src)
    if rule == "VALID-002":
        return _count_check("true", f"ts IS NOT NULL AND NOT ({IN_WINDOW})", src)
    if rule == "VALID-003":
        return _count_check("true", "itemid <= 0", src)
    if rule == "CONS-002":
        return _count_check("event IN ('view','addtocart')", "event IN ('view','addtocart') AND transactionid IS NOT NULL", src)
    if rule == "UNIQ-001":
        return (f"SELECT k, coalesce(sum(n),0)::BIGINT AS total_records, coalesce(sum(n) FILTER (WHERE n > 1),0)::BIGINT AS failed_records, NULL::INT AS gap_days FROM "
                f"(SELECT k, transactionid, count(*) FILTER (WHERE event = 'transaction' AND transactionid IS NOT NULL) AS n FROM {src} GROUP BY k, transactionid) GROUP BY k")
    if rule == "UNIQ-002":
        return (f"SELECT k, sum(n)::BIGINT AS total_records, sum(n - 1)::BIGINT AS failed_records, NULL::INT AS gap_days FROM "
                f"(SELECT k, {EVENT_COLS}, count(*) AS n FROM {src} GROUP BY k, {EVENT_COLS}) GROUP BY k")
    if rule == "CONS-003":
        return (f"SELECT a.k, CASE WHEN v = 0 THEN n ELSE v END AS total_records, coalesce(f, 0) AS failed_records, NULL::INT AS gap_days FROM "
                f"(SELECT k, count(*) AS n, count(DISTINCT CASE WHEN ts IS NOT NULL THEN visitorid END) AS v FROM {src} GROUP BY k) a LEFT JOIN "
                f"(SELECT k, count(*) AS f FROM (SELECT k, event, row_number() OVER (PARTITION BY k, visitorid ORDER BY ts, event_id) AS rn FROM {src} "
                f"WHERE visitorid IS NOT NULL AND ts IS NOT NULL AND event IS NOT NULL) WHERE rn = 1 AND event = 'transaction' GROUP BY k) b ON a.k = b.k")
    if rule == "FRESH-001":
        return (f"SELECT k, 1::BIGINT AS total_records, CASE WHEN max(ts) BETWEEN {W0} AND {W1} THEN 0 ELSE 1 END::BIGINT AS failed_records, NULL::INT AS gap_days FROM {src} GROUP BY k")
    if rule == "FRESH-002":
        return (f"SELECT k, coalesce(max(d) - min(d) + 1, 1)::BIGINT AS total_records, CASE WHEN coalesce(max(g),0) >= 7 THEN max(g) ELSE 0 END::BIGINT AS failed_records, "
                f"coalesce(max(g),0)::INT AS gap_days FROM (SELECT k, d, d - lag(d) OVER (PARTITION BY k ORDER BY d) - 1 AS g FROM "
                f"(SELECT DISTINCT k, CAST(ts AS DATE) AS d FROM {src} WHERE ts IS NOT NULL)) GROUP BY k")
    if rule == "RI-001":
        return (f"SELECT k, count(*) AS total_records, count(*) FILTER (WHERE itemid IS NOT NULL AND itemid NOT IN (SELECT itemid FROM items)) AS failed_records, NULL::INT AS gap_days FROM {src} GROUP BY k")
    if rule == "RI-002":
        return (f"SELECT k, (SELECT count(*) FROM items WHERE categoryid IS NOT NULL) AS total_records, "
                f"(SELECT count(*) FROM items WHERE categoryid IS NOT NULL AND categoryid NOT IN (SELECT categoryid FROM cats)) AS failed_records, NULL::INT AS gap_days "
                f"FROM (SELECT DISTINCT k FROM {src})")
    raise KeyError(rule)


def checks_cte(src: str, rules=checks.ALL_CHECKS) -> str:
    parts = []
    for i, (rule, desc, dim, sev) in enumerate(V.EVENT_CHECKS, 1):
        desc = "timestamp must fall within dataset observation window (2024-01-01 to 2024-01-30)" if rule == "VALID-002" else desc
        if rule in rules:
            parts.append(f"SELECT {i} AS ordinal, '{rule}' AS rule_id, '{desc}' AS rule_desc, '{dim}' AS dimension, '{sev}' AS severity, k, total_records, failed_records, gap_days FROM ({check_select(rule, src)})")
    union = "\nUNION ALL ".join(parts)
    return (f"SELECT *, CASE WHEN total_records > 0 THEN round(100e0 * failed_records / total_records, 4) ELSE 0e0 END AS failure_pct, "
            f"CASE WHEN failed_records = 0 THEN 'PASS' WHEN severity IN ('critical','high') THEN 'FAIL' ELSE 'WARN' END AS status FROM ({union})")


ONE = "src AS (SELECT *, 'R1' AS k FROM ev)"
DAILY = "src AS (SELECT *, 'RUN-' || strftime(ts, '%Y%m%d') AS k FROM ev)"
CHECK_COLS = "ordinal, rule_id, rule_desc, dimension, severity, status, total_records, failed_records, failure_pct, gap_days"


def score_cte(checks_name: str = "chk") -> str:
    dims = list(V.DIMENSION_WEIGHTS)
    pen = "CASE WHEN status = 'PASS' THEN 0 ELSE CASE severity WHEN 'critical' THEN 25 WHEN 'high' THEN 15 WHEN 'medium' THEN 8 WHEN 'low' THEN 3 ELSE 0 END END"
    cols = ", ".join(f"greatest(0e0, 100e0 - coalesce(sum({pen}) FILTER (WHERE dimension = '{d}'), 0)) AS score_{d}" for d in dims)
    total = " + ".join(f"score_{d} * {w}e0" for d, w in V.DIMENSION_WEIGHTS.items())
    sev = ", ".join(f"count(*) FILTER (WHERE status <> 'PASS' AND severity = '{s}') AS {s}_failures" for s in V.SEVERITY_PENALTIES)
    return (
        f"SELECT *, CASE WHEN has_critical_failure THEN CASE WHEN quality_score >= 60 THEN 'Warning' ELSE 'Critical' END "
        f"WHEN quality_score >= 90 THEN 'Excellent' WHEN quality_score >= 75 THEN 'Good' WHEN quality_score >= 60 THEN 'Warning' ELSE 'Critical' END AS status "
        f"FROM (SELECT *, round({total}, 2) AS quality_score FROM (SELECT k, {cols}, "
        f"count(*) FILTER (WHERE status = 'PASS') AS pass_count, count(*) FILTER (WHERE status = 'FAIL') AS fail_count, count(*) FILTER (WHERE status = 'WARN') AS warn_count, "
        f"{sev}, coalesce(bool_or(status = 'FAIL' AND severity = 'critical'), false) AS has_critical_failure FROM {checks_name} GROUP BY k))")


# ---------------------------------------------------------------- checks
def _checks(spark, sf, rules=checks.ALL_CHECKS, by=(), events=None):
    events = dirty_events(spark, sf) if events is None else events
    return run_checks(events, item_catalog(spark, sf), category_tree(spark, sf), dirty_rules(), rules=rules, by=by)


NAMES = {
    "COMP-001": "c01_null_visitorid", "COMP-002": "c02_null_itemid", "COMP-003": "c03_null_event", "COMP-004": "c04_txn_without_id",
    "UNIQ-001": "c05_dup_transactionid", "UNIQ-002": "c06_dup_rows", "VALID-001": "c07_event_allow_list", "VALID-002": "c08_time_window",
    "VALID-003": "c09_positive_itemid", "CONS-001": "c10_txn_must_have_id", "CONS-002": "c11_browse_has_id", "CONS-003": "c12_first_event",
    "FRESH-001": "c13_latest_event", "FRESH-002": "c14_longest_gap", "RI-001": "c15_item_in_catalog", "RI-002": "c16_category_in_tree",
}
for _rule, _name in NAMES.items():
    register(
        _name,
        lambda spark, sf, r=_rule: _checks(spark, sf, [r]).select(*CHECK_COLS.split(", ")),
        sql(f"SELECT {CHECK_COLS} FROM chk", ONE, f"chk AS ({checks_cte('src', [_rule])})"),
    )

register("c17_result_row",
         lambda spark, sf: _checks(spark, sf, list(checks._DAILY)).select("rule_id", "status", "failure_pct"),
         sql("SELECT rule_id, status, failure_pct FROM chk", ONE, f"chk AS ({checks_cte('src', checks._DAILY)})"))
register("c18_all_checks",
         lambda spark, sf: _checks(spark, sf).select(*CHECK_COLS.split(", ")).orderBy("ordinal"),
         sql(f"SELECT {CHECK_COLS} FROM chk ORDER BY ordinal", ONE, f"chk AS ({checks_cte('src')})"))

_BAD = {
    "COMP-001": "visitorid IS NULL", "COMP-002": "itemid IS NULL", "COMP-003": "event IS NULL",
    "COMP-004": "event = 'transaction' AND transactionid IS NULL", "VALID-001": f"event NOT IN {OK_EVENTS}",
    "VALID-002": f"NOT ({IN_WINDOW})", "VALID-003": "itemid <= 0", "CONS-001": "event = 'transaction' AND transactionid IS NULL",
    "CONS-002": "event IN ('view','addtocart') AND transactionid IS NOT NULL",
}
register("c19_failing_samples",
         lambda spark, sf: checks.failing_samples(dirty_events(spark, sf), 3, dirty_rules(), ["event_id"]).select("rule_id", "sample_no", *EVENT_COLS.split(", ")),
         sql("SELECT rule_id, sample_no, " + EVENT_COLS + " FROM (SELECT *, (row_number() OVER (PARTITION BY rule_id ORDER BY event_id))::INT AS sample_no FROM ("
             + " UNION ALL ".join(f"SELECT '{r}' AS rule_id, {EVENT_COLS} FROM ev WHERE {cond}" for r, cond in _BAD.items()) + ")) WHERE sample_no <= 3"))

# ---------------------------------------------------------------- scores
DIM_COLS = [f"score_{d}" for d in V.DIMENSION_WEIGHTS]
SCORE_COLS = ["quality_score", "status", "pass_count", "fail_count", "warn_count", "critical_failures", "high_failures",
              "medium_failures", "low_failures", "has_critical_failure", *DIM_COLS]
CHK, SCORED = f"chk AS ({checks_cte('src')})", f"scored AS ({score_cte()})"


def _scored(spark, sf):
    return scoring.quality_scores(_checks(spark, sf), by=[])


def _score_query(name, cols):
    register(name, lambda spark, sf: _scored(spark, sf).select(*cols), sql(f"SELECT {', '.join(cols)} FROM scored", ONE, CHK, SCORED))


register("a01_dimension_score", lambda spark, sf: scoring.dimension_scores(_checks(spark, sf), by=[]),
         sql("SELECT dimension, greatest(0e0, 100e0 - sum(CASE WHEN status = 'PASS' THEN 0 ELSE CASE severity WHEN 'critical' THEN 25 WHEN 'high' THEN 15 WHEN 'medium' THEN 8 ELSE 3 END END)) AS score FROM chk GROUP BY dimension", ONE, CHK))
# a run of completeness and validity checks only: the other dimensions default to 100
_SOME = [r for r in checks.ALL_CHECKS if r.startswith(("COMP", "VALID"))]
register("a02_default_dimensions",
         lambda spark, sf: scoring.quality_scores(_checks(spark, sf, _SOME), by=[]).select(*DIM_COLS, "quality_score"),
         sql(f"SELECT {', '.join(DIM_COLS)}, quality_score FROM scored", ONE, f"chk AS ({checks_cte('src', _SOME)})", SCORED))
_score_query("a03_quality_score", ["quality_score"])
_score_query("a04_status_counts", ["pass_count", "fail_count", "warn_count"])
_score_query("a05_severity_breakdown", ["critical_failures", "high_failures", "medium_failures", "low_failures"])
_score_query("a06_critical_flag", ["has_critical_failure"])
_score_query("a07_status_override", ["quality_score", "has_critical_failure", "status"])
_score_query("a08_full_run", SCORE_COLS)


def daily_runs(spark, sf):
    """Check results of one run per event day, all days in one job."""
    events = dirty_events(spark, sf).withColumn("run_id", F.concat(F.lit("RUN-"), F.date_format("ts", "yyyyMMdd")))
    return _checks(spark, sf, by=["run_id"], events=events), events


def daily_summary(spark, sf):
    results, _ = daily_runs(spark, sf)
    return scoring.quality_scores(results).withColumn("run_date", F.to_date(F.substring("run_id", 5, 8), "yyyyMMdd"))


def daily_log(spark, sf):
    _, events = daily_runs(spark, sf)
    log = events.groupBy("run_id").agg(F.count("*").alias("total_records"))
    return log.withColumn("run_date", F.to_date(F.substring("run_id", 5, 8), "yyyyMMdd"))


register("a09_score_history", lambda spark, sf: daily_summary(spark, sf).select("run_id", *SCORE_COLS),
         sql(f"SELECT k AS run_id, {', '.join(SCORE_COLS)} FROM scored", DAILY, CHK, SCORED))

# ---------------------------------------------------------------- run queries and report rows
RUN_COLS = ["run_id", "run_date", "quality_score", "status", "total_records"]
LOG = "lg AS (SELECT k, count(*) AS total_records, strptime(substr(k, 5), '%Y%m%d')::DATE AS run_date FROM src GROUP BY k)"


SEV_RANK = "CASE severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 9 END"
RANKED = f"ranked AS (SELECT *, (row_number() OVER (PARTITION BY k ORDER BY {SEV_RANK}, failure_pct DESC, rule_id))::INT AS issue_rank FROM chk WHERE status <> 'PASS')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TEXTS = "texts AS (SELECT * FROM (VALUES " + ", ".join(f"('{r}', {_quoted(a)}, {_quoted(b)})" for r, a, b in V.RULE_TEXTS) + ") AS t(rule_id, business_impact, recommendation))"
register("q05_top_issues",
         lambda spark, sf: runs.ranked_issues(daily_runs(spark, sf)[0], ["run_id"], 5).select("run_id", "issue_rank", "rule_id", "severity", "failed_records", "failure_pct"),
         sql("SELECT k AS run_id, issue_rank, rule_id, severity, failed_records, failure_pct FROM ranked WHERE issue_rank <= 5", DAILY, CHK, RANKED))
register("q06_rule_texts",
         lambda spark, sf: runs.rule_texts(_checks(spark, sf)).select("rule_id", "status", "business_impact", "recommendation"),
         sql("SELECT rule_id, status, business_impact, recommendation FROM chk JOIN texts USING (rule_id)", ONE, CHK, TEXTS))
_DIM_ORDER = "CASE dimension " + " ".join(f"WHEN '{d}' THEN {i}" for i, d in enumerate(V.DIMENSION_WEIGHTS, 1)) + " END"
register("q07_by_dimension",
         lambda spark, sf: runs.grouped_by_dimension(_checks(spark, sf)).select("dimension_order", "dimension", "rule_id", "severity", "status", "failed_records", "failure_pct"),
         sql(f"SELECT {_DIM_ORDER} AS dimension_order, dimension, rule_id, severity, status, failed_records, failure_pct FROM chk ORDER BY 1, ordinal", ONE, CHK))
register("q08_recommendations",
         lambda spark, sf: runs.rule_texts(runs.ranked_issues(_checks(spark, sf), [])).select("issue_rank", "severity", "rule_id", "recommendation"),
         sql("SELECT issue_rank, severity, rule_id, recommendation FROM ranked JOIN texts USING (rule_id)", ONE, CHK, RANKED, TEXTS))

# ---------------------------------------------------------------- catalog
PROPS = """props AS (SELECT epoch_ms(l_shipdate) AS "timestamp", l_partkey AS itemid,
    CASE WHEN l_returnflag = 'R' THEN 'available' ELSE 'categoryid' END AS property,
    CASE WHEN l_quantity = 13 THEN 'unknown' ELSE CAST(l_suppkey AS VARCHAR) || '.0' END AS value FROM lineitem)"""


def item_properties(spark, sf):
    """Line items as a long history of item properties."""
    li = table(spark, sf, "lineitem")
    return li.select(
        (wall_micros(F.col("l_shipdate")) / 1000).cast("long").alias("timestamp"), F.col("l_partkey").alias("itemid"),
        F.when(F.col("l_returnflag") == "R", "available").otherwise("categoryid").alias("property"),
        F.when(F.col("l_quantity") == 13, "unknown").otherwise(F.concat(F.col("l_suppkey").cast("string"), F.lit(".0"))).alias("value"))


register("k01_latest_category", lambda spark, sf: catalog.item_catalog(item_properties(spark, sf)),
         sql("""SELECT itemid, TRY_CAST(value AS DOUBLE) AS categoryid FROM (
             SELECT *, row_number() OVER (PARTITION BY itemid ORDER BY "timestamp" DESC, value DESC) AS rn FROM props WHERE property = 'categoryid') WHERE rn = 1""", PROPS))
register("k02_catalog_fallback", lambda spark, sf: catalog.item_catalog(item_properties(spark, sf), "no such property"),
         sql("SELECT DISTINCT itemid, NULL::DOUBLE AS categoryid FROM props", PROPS))

# ---------------------------------------------------------------- sampling, cleansing, corruption
P = sampling.HASH_RANGE


def hash_sql(key: str, seed: int = V.SEED) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 15) AS BIGINT)"


def share_sql(seed: int, share: float, key: str = "event_id") -> str:
    return f"{hash_sql(key, seed)} < {int(P * share)}"


DISTINCT = f"dd AS (SELECT {EVENT_COLS}, count(*) AS copies FROM ev GROUP BY {EVENT_COLS})"
FIRSTS = f"ft AS (SELECT *, row_number() OVER (PARTITION BY transactionid ORDER BY ts, event_id) AS rn FROM dd WHERE event = 'transaction' AND transactionid IS NOT NULL)"
CLEAN = f"""cl AS (SELECT {EVENT_COLS} FROM dd WHERE event IN ('view','addtocart') AND {IN_WINDOW}
    UNION ALL SELECT {EVENT_COLS} FROM ft WHERE rn = 1 AND {IN_WINDOW})"""

register("s04_exact_sample",
         lambda spark, sf: sampling.exact_sample(table(spark, sf, "events"), 500, sampling.key_hash(F.col("event_id")), ["event_id"]).select("event_id", "user_id", "event_type", "value"),
         f"SELECT event_id, user_id, event_type, value FROM events ORDER BY {hash_sql('event_id')}, event_id LIMIT 500")


def clean_set(spark, sf):
    return cleanse.clean(dirty_events(spark, sf), dirty_rules())


def corruptor(base):
    return cleanse.Corruptor(base, "event_id", dirty_rules(), F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))


register("k03_clean", lambda spark, sf: clean_set(spark, sf), sql(f"SELECT {EVENT_COLS} FROM cl", DISTINCT, FIRSTS, CLEAN))
register("k04_clean_audit", lambda spark, sf: cleanse.clean_audit(dirty_events(spark, sf), dirty_rules()),
         sql(f"""SELECT 1 AS step_no, 'duplicate_rows' AS step, sum(copies - 1)::BIGINT AS rows_removed FROM dd
             UNION ALL SELECT 2, 'txn_without_id', count(*) FROM dd WHERE event = 'transaction' AND transactionid IS NULL
             UNION ALL SELECT 3, 'invalid_event', count(*) FROM dd WHERE event IS NULL OR event NOT IN {OK_EVENTS}
             UNION ALL SELECT 4, 'duplicate_txn_id', count(*) FROM ft WHERE rn > 1
             UNION ALL SELECT 5, 'out_of_window', (SELECT count(*) FROM dd WHERE event IN ('view','addtocart') AND NOT ({IN_WINDOW})) + (SELECT count(*) FROM ft WHERE rn = 1 AND NOT ({IN_WINDOW}))""",
             DISTINCT, FIRSTS))

FAKE_ITEM = f"9000000 + {hash_sql('event_id', 10)} % 999999"
INVALID = "CASE event_id % 5 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(V.INVALID_EVENT_SAMPLES)) + " END"


def nth_sql(seed: int, n: int, where: str = "true", source: str = "cl") -> str:
    return f"event_id IN (SELECT event_id FROM {source} WHERE {where} ORDER BY {hash_sql('event_id', seed)}, event_id LIMIT {n})"


def _corrupt(name, step, replaced: dict[str, str], copies: str | None = None):
    """Register one defect on the clean set with the SQL of the replaced columns or of the copies."""
    cols = ", ".join(f"{replaced[x]} AS {x}" if x in replaced else x for x in EVENT_COLS.split(", "))
    body = f"SELECT {cols} FROM cl"
    if copies:
        body += f" UNION ALL SELECT {EVENT_COLS} FROM cl WHERE {copies}"

    def run(spark, sf):
        # counted defects look their rows up in the clean set first, so it is written once
        base = settle(clean_set(spark, sf), "clean-set") if "LIMIT" in (copies or body) else clean_set(spark, sf)
        return step(corruptor(base), base)

    register(name, run, sql(body, DISTINCT, FIRSTS, CLEAN))


_corrupt("k05_null_columns", lambda c, d: c.null_items(c.null_visitors(d, 0.1), 0.05),
         {"visitorid": f"CASE WHEN {share_sql(1, 0.1)} THEN NULL ELSE visitorid END", "itemid": f"CASE WHEN {share_sql(2, 0.05)} THEN NULL ELSE itemid END"})
_corrupt("k06_null_txn_ids", lambda c, d: c.null_transaction_ids(d, 0.1),
         {"transactionid": f"CASE WHEN event = 'transaction' AND {share_sql(3, 0.1)} THEN NULL ELSE transactionid END"})
_corrupt("k07_ids_on_views", lambda c, d: c.ids_on_views(d, 0.1),
         {"transactionid": f"CASE WHEN event = 'view' AND {share_sql(4, 0.1)} THEN printf('FAKE_TXN_%06d', event_id) ELSE transactionid END"})
_corrupt("k08_duplicate_rows", lambda c, d: c.duplicate_rows(d, 150), {}, nth_sql(5, 150))
_corrupt("k09_duplicate_txns", lambda c, d: c.duplicate_transactions(d, 100), {}, nth_sql(6, 100, "event = 'transaction'"))
_corrupt("k10_invalid_events", lambda c, d: c.invalid_events(d, 0.05), {"event": f"CASE WHEN {share_sql(7, 0.05)} THEN {INVALID} ELSE event END"})
_corrupt("k11_out_of_range_times", lambda c, d: c.out_of_range_times(d, 200), {"ts": f"CASE WHEN {nth_sql(8, 200)} THEN TIMESTAMP '2000-01-01' ELSE ts END"})
_corrupt("k12_unknown_items", lambda c, d: c.unknown_items(d, 0.06), {"itemid": f"CASE WHEN {share_sql(9, 0.06)} THEN {FAKE_ITEM} ELSE itemid END"})


# the tiers, as one SQL frame with the tier name as batch key k
def _tier_sql(tier: str, visitors: float, items: float | None, txn: float | None, views: float | None, dup: int, dup_txn: int | None, invalid: float, moved: int | None, fake: float | None) -> str:
    tid = "transactionid"
    if txn:
        tid = f"CASE WHEN event = 'transaction' AND {share_sql(3, txn)} THEN NULL ELSE {tid} END"
    if views:
        tid = f"CASE WHEN event = 'view' AND {share_sql(4, views)} THEN printf('FAKE_TXN_%06d', event_id) ELSE {tid} END"
    item = "itemid"
    if items:
        item = f"CASE WHEN {share_sql(2, items)} THEN NULL ELSE itemid END"
    if fake:
        item = f"CASE WHEN {share_sql(9, fake)} THEN {FAKE_ITEM} ELSE {item} END"
    when = f"CASE WHEN {nth_sql(8, moved)} THEN TIMESTAMP '2000-01-01' ELSE ts END" if moved else "ts"
    copies = f"2 - (NOT {nth_sql(5, dup)})::INT" if dup else "1"
    if dup_txn:
        copies = f"({copies}) * (2 - (NOT (event = 'transaction' AND {nth_sql(6, dup_txn, chr(101) + 'vent = ' + chr(39) + 'transaction' + chr(39))}))::INT)"
    return (f"SELECT event_id, {when} AS ts, CASE WHEN {share_sql(1, visitors)} THEN NULL ELSE visitorid END AS visitorid, "
            f"CASE WHEN {share_sql(7, invalid)} THEN {INVALID} ELSE event END AS event, {item} AS itemid, {tid} AS transactionid, '{tier}' AS k "
            f"FROM (SELECT *, unnest(range({copies})) AS copy_no FROM cl)")


TIERS = ("src AS (SELECT *, 'clean' AS k FROM cl UNION ALL " + " UNION ALL ".join([
    _tier_sql("light", 0.005, None, None, None, 150, None, 0.005, None, None),
    _tier_sql("moderate", 0.010, None, 0.015, None, 250, 100, 0.008, 200, None),
    _tier_sql("severe", 0.04, 0.025, 0.05, 0.015, 700, 400, 0.025, 700, 0.06),
]) + ")")


def tiers(spark, sf):
    """The four tiers. They are data sets of their own: the clean set and the tiers are
    each written once and read back, as their consumers scan them several times."""
    base = settle(clean_set(spark, sf), "clean-set")
    return settle(corruptor(base).tiers(), "tiers")


register("k13_quality_tiers",
         lambda spark, sf: tiers(spark, sf).groupBy("tier").agg(F.count("*").alias("row_count"), F.count_if(F.col("visitorid").isNull()).alias("null_visitors"), F.sum("itemid").alias("item_sum")),
         sql("SELECT k AS tier, count(*) AS row_count, count(*) FILTER (WHERE visitorid IS NULL) AS null_visitors, sum(itemid)::BIGINT AS item_sum FROM src GROUP BY k", DISTINCT, FIRSTS, CLEAN, TIERS))
register("k14_audit", lambda spark, sf: cleanse.audit(tiers(spark, sf), dirty_rules(), ["tier"]),
         sql(f"""SELECT k AS tier, count(*) AS total_rows, count(*) FILTER (WHERE visitorid IS NULL) AS null_visitorid, count(*) FILTER (WHERE itemid IS NULL) AS null_itemid,
             count(*) FILTER (WHERE event NOT IN {OK_EVENTS}) AS invalid_events, count(*) FILTER (WHERE event = 'transaction') AS transaction_rows,
             count(*) FILTER (WHERE event = 'transaction' AND transactionid IS NULL) AS txn_without_id, count(*) FILTER (WHERE NOT ({IN_WINDOW})) AS out_of_range,
             count(*) - count(DISTINCT ROW(event_id, ts, visitorid, event, itemid, transactionid)) AS duplicate_rows,
             count(*) FILTER (WHERE event = 'transaction' AND transactionid IS NOT NULL) - count(DISTINCT CASE WHEN event = 'transaction' THEN transactionid END) AS duplicate_txn_ids
             FROM src GROUP BY k""", DISTINCT, FIRSTS, CLEAN, TIERS))
register("k15_tier_bands",
         lambda spark, sf: scoring.band_check(scoring.quality_scores(_checks(spark, sf, by=["tier"], events=tiers(spark, sf)), by=["tier"])).select("tier", "quality_score", "status", "band_low", "band_high", "in_band"),
         sql("""SELECT k AS tier, quality_score, status, lo AS band_low, hi AS band_high, quality_score BETWEEN lo AND hi AS in_band FROM scored
             JOIN (VALUES ('clean',90,100),('light',75,89),('moderate',60,74),('severe',0,59)) AS t(tier, lo, hi) ON k = tier""", DISTINCT, FIRSTS, CLEAN, TIERS, CHK, SCORED))
