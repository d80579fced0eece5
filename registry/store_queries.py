"""Registered queries of sources, sinks and streams: they read back what they wrote.

Every run writes to a fresh folder under the shared working folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.functions.exprs import small_table, wall_micros
from plumbline.operators import controls, runs, scoring
from plumbline.operators.exceptions import EXCEPTION_COLUMNS
from plumbline.operators.watchlist import WATCHLIST_COLUMNS
from plumbline.session import shared_folder
from plumbline.sources import readers, sampling, store
from plumbline.streaming import arrivals, control_stream, silence

from . import event_queries as ev
from .core import register, table
from .event_data import dirty_events
from .governance_data import Governance, gov_controls, sql as gov_sql

c = F.col


# ---------------------------------------------------------------- CSV scans
def _events_csv(spark, sf) -> str:
    """The dirty events as a CSV with padded header names and decimal ids, as exports have them."""
    path = shared_folder(spark, "events-csv")
    e = dirty_events(spark, sf)
    out = e.select(
        F.floor(wall_micros(c("ts")) / 1000).alias("timestamp"), F.format_string("%d.0", c("visitorid")).alias(" visitorid"),
        "event", c("itemid").alias(" itemid "), "transactionid")
    out = out.withColumn(" visitorid", F.when(c("` visitorid`") != "null.0", c("` visitorid`")))
    store.export_csv(out, path)
    return path


register("s01_csv_events", lambda s, sf: readers.load_events(s, full=_events_csv(s, sf)),
         ev.sql("SELECT epoch_us(ts) // 1000 AS \"timestamp\", visitorid, event, itemid, transactionid FROM ev"))


def _two_orders_csv(spark, sf) -> str:
    """One folder of event files whose columns are in two orders."""
    path = shared_folder(spark, "events-two-orders")
    e = dirty_events(spark, sf).select(F.floor(wall_micros(c("ts")) / 1000).alias("timestamp"), "visitorid", "event", "itemid", "transactionid", "event_id")
    for k, names in enumerate((["timestamp", "visitorid", "event", "itemid", "transactionid"], ["itemid", "transactionid", "visitorid", "timestamp", "event"])):
        e.filter(F.pmod("event_id", F.lit(2)) == k).select(*names).write.mode("append").option("header", True).csv(path)
    return path


register("s01b_csv_two_orders", lambda s, sf: readers.load_events(s, full=_two_orders_csv(s, sf)),
         ev.sql("SELECT epoch_us(ts) // 1000 AS \"timestamp\", visitorid, event, itemid, transactionid FROM ev"))


def _property_parts(spark, sf):
    base = shared_folder(spark, "item-properties")
    props = ev.item_properties(spark, sf)
    first = c("timestamp") < 915148800000
    store.export_csv(props.filter(first), f"{base}/part1")
    store.export_csv(props.filter(~first), f"{base}/part2")
    return [f"{base}/part1", f"{base}/part2"]


register("s02_csv_property_parts",
         lambda s, sf: readers.load_item_properties(s, _property_parts(s, sf)).groupBy("property").agg(
             F.count("*").alias("row_count"), F.countDistinct("itemid").alias("items"), F.sum(c("timestamp").cast("decimal(38,0)")).cast("string").alias("time_sum")),
         ev.sql("SELECT property, count(*) AS row_count, count(DISTINCT itemid) AS items, CAST(sum(\"timestamp\") AS VARCHAR) AS time_sum FROM props GROUP BY 1", ev.PROPS))


def _tree_csv(spark, sf) -> str:
    path = shared_folder(spark, "category-tree")
    p = table(spark, sf, "part")
    tree = p.select(c("p_size").cast("long").alias("categoryid"), F.when(c("p_size") > 10, F.floor(c("p_size") / 10)).alias("parentid")).distinct()
    store.export_csv(tree, path)
    return path


register("s03_csv_category_tree", lambda s, sf: readers.load_category_tree(s, _tree_csv(s, sf)),
         "SELECT DISTINCT CAST(p_size AS BIGINT) AS categoryid, CASE WHEN p_size > 10 THEN CAST(p_size // 10 AS BIGINT) END AS parentid FROM part")


def _saved_sample(spark, sf):
    path = shared_folder(spark, "sample")
    e = table(spark, sf, "events").select("event_id", "event_type")
    h = sampling.key_hash(c("event_id"))
    sampling.saved_sample(e, path, 200, h, ["event_id"])
    # the second call finds the saved sample and keeps it, although it asks for another size
    return sampling.saved_sample(e, path, 900, h, ["event_id"])


register("s04b_saved_sample", _saved_sample, f"SELECT event_id, event_type FROM events ORDER BY {ev.hash_sql('event_id')}, event_id LIMIT 200")


# ---------------------------------------------------------------- result store
def _filled(spark, sf, *what: str) -> store.ResultStore:
    """A store that was written twice with the same runs."""
    st = store.ResultStore(spark, shared_folder(spark, "store"))
    results, events = ev.daily_runs(spark, sf)
    day = F.to_timestamp(F.substring("run_id", 5, 8), "yyyyMMdd")
    for _ in range(2):
        if "log" in what:
            st.append_run_log(events.groupBy("run_id").agg(F.count("*").alias("total_records")).withColumn("run_timestamp", day).withColumn("dataset_name", F.lit("events")).withColumn("status", F.lit("COMPLETED")))
        if "results" in what:
            st.append_results(results)
        if "summary" in what:
            st.append_summary(scoring.quality_scores(results).withColumn("run_timestamp", day).withColumn("dataset_name", F.lit("events")))
    return st


def _repeated(spark, sf) -> store.ResultStore:
    """Appends that repeat run ids, in one batch and over batches."""
    st = store.ResultStore(spark, shared_folder(spark, "store"))
    log = _filled(spark, sf, "log").read("dq_run_log")
    st.append_run_log(log.unionByName(log.withColumn("total_records", F.lit(0).cast("bigint"))))
    st.append_run_log(log)
    return st


LOG_SQL = "SELECT k AS run_id, run_date, 'events' AS dataset_name, total_records, 'COMPLETED' AS status FROM lg"
register("s05_run_log",
         lambda s, sf: _filled(s, sf, "log").read("dq_run_log").select("run_id", F.to_date("run_timestamp").alias("run_date"), "dataset_name", "total_records", "status"),
         ev.sql(LOG_SQL, ev.DAILY, ev.LOG))
RESULT_COLS = "rule_id, rule_desc, dimension, severity, status, total_records, failed_records, failure_pct"


def _results(spark, sf):
    st = _filled(spark, sf, "results")
    st.append_results(st.read("dq_results").filter(F.lit(False)))  # an empty append changes nothing
    return st.read("dq_results")


register("s06_results", _results, ev.sql(f"SELECT k AS run_id, {RESULT_COLS} FROM chk", ev.DAILY, ev.CHK))
INTS = ["pass_count", "fail_count", "warn_count", "critical_failures", "high_failures", "medium_failures", "low_failures"]
SUMMARY_SQL = "SELECT k AS run_id, 'events' AS dataset_name, quality_score, status, " + ", ".join(f"CAST({x} AS INT) AS {x}" for x in INTS) + ", " + ", ".join(ev.DIM_COLS) + " FROM scored"
register("s07_summary", lambda s, sf: _filled(s, sf, "summary").read("dq_summary").drop("run_timestamp"), ev.sql(SUMMARY_SQL, ev.DAILY, ev.CHK, ev.SCORED))
register("s09_unique_run_ids",
         lambda s, sf: _repeated(s, sf).read("dq_run_log").agg(F.count("*").alias("rows_stored"), F.countDistinct("run_id").alias("run_ids")),
         ev.sql("SELECT count(*) AS rows_stored, count(*) AS run_ids FROM lg", ev.DAILY, ev.LOG))


# ---------------------------------------------------------------- queries over stored runs
def _dated(df):
    return df.withColumn("run_timestamp", F.to_date("run_timestamp")).withColumnRenamed("run_timestamp", "run_date")


def _runs(pick):
    def query(spark, sf):
        st = _filled(spark, sf, "log", "summary")
        return _dated(pick(st.read("dq_summary"), st.read("dq_run_log"))).select(*ev.RUN_COLS)
    return query


RUNS_SQL = "SELECT scored.k AS run_id, run_date, quality_score, status, total_records FROM scored LEFT JOIN lg ON scored.k = lg.k ORDER BY run_date"
register("q01_all_summaries", _runs(runs.all_summaries), ev.sql(RUNS_SQL, ev.DAILY, ev.CHK, ev.SCORED, ev.LOG))
register("q02_results_of_run", lambda s, sf: runs.results_of_run(_filled(s, sf, "results").read("dq_results"), "RUN-20240115").select("run_id", *RESULT_COLS.split(", ")),
         ev.sql(f"SELECT k AS run_id, {RESULT_COLS} FROM chk WHERE k = 'RUN-20240115' ORDER BY dimension, rule_id", ev.DAILY, ev.CHK))
register("q03_latest_run", _runs(runs.latest_run), ev.sql(RUNS_SQL + " DESC LIMIT 1", ev.DAILY, ev.CHK, ev.SCORED, ev.LOG))
register("q04_run_log", lambda s, sf: _dated(runs.run_log_newest_first(_filled(s, sf, "log").read("dq_run_log"))).select("run_id", "run_date", "total_records"),
         ev.sql("SELECT k AS run_id, run_date, total_records FROM lg ORDER BY run_date DESC", ev.DAILY, ev.LOG))


def _refresh(spark, sf):
    from plumbline.plans.governance import refresh

    return refresh(Governance(spark, sf), shared_folder(spark, "governance"))


def _refreshed_counts(spark, sf):
    from plumbline.operators.analysis import table_counts

    return table_counts(_refresh(spark, sf))


register("s08_full_refresh", _refreshed_counts,
         gov_sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in
                                    (("data_inventory", "inv"), ("control_rulebook", "rb"), ("control_test_results", "gt"), ("exceptions", "ex"),
                                     ("dq_watchlist", "wl"), ("remediation_tickets", "tk"), ("domain_trust_scores", "tr"), ("governance_maturity", "mt")))))
register("s08b_refreshed_watchlist", lambda s, sf: _refresh(s, sf)["dq_watchlist"],
         gov_sql("SELECT printf('WL-%04d', row_number() OVER (ORDER BY domain, dataset_id)) AS watchlist_id, " + ", ".join(WATCHLIST_COLUMNS[1:]) + " FROM wl"))
register("s08c_refreshed_exceptions", lambda s, sf: _refresh(s, sf)["exceptions"], gov_sql("SELECT " + ", ".join(EXCEPTION_COLUMNS) + " FROM ex"))


def _exported(spark, sf):
    path = shared_folder(spark, "export")
    store.export_csv(Governance(spark, sf).tests, path)
    schema = schemas.struct("test_id STRING, test_date DATE, dataset_id INT, rule_id STRING, total_records BIGINT, pass_count BIGINT, fail_count BIGINT,"
                            " failure_rate DOUBLE, control_effectiveness DOUBLE, status STRING")
    return readers.read_table(spark, path, schema)


register("s10_csv_export", _exported,
         gov_sql("SELECT test_id, test_date, dataset_id, rule_id, total_records, pass_count, fail_count, failure_rate, control_effectiveness, status FROM gt"))


def _relations(spark, sf):
    t = lambda n: table(spark, sf, n)
    parts = [
        store.relationship(t("orders"), "o_custkey", t("customer"), "c_custkey", "orders -> customer"),
        store.relationship(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey", "lineitem -> orders"),
        store.relationship(t("customer"), "c_nationkey", t("nation"), "n_nationkey", "customer -> nation"),
        store.relationship(t("events"), "user_id", t("customer"), "c_custkey", "events -> customer"),
        store.relationship(t("lineitem"), "l_partkey", t("part").filter(c("p_partkey") % 10 != 7), "p_partkey", "lineitem -> reduced part"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _relation_sql(child, key, parent, pk, name):
    return (f"SELECT *, CASE WHEN repeated_parent_keys > 0 AND repeated_child_keys > 0 THEN 'many-to-many' WHEN repeated_parent_keys > 0 THEN 'one-to-many' WHEN repeated_child_keys > 0 THEN 'many-to-one' ELSE 'one-to-one' END AS cardinality FROM ("
            f"SELECT '{name}' AS relationship, (SELECT count(*) FROM {child}) AS child_rows, (SELECT count(*) FROM {child} WHERE {key} NOT IN (SELECT {pk} FROM {parent})) AS orphan_rows, "
            f"(SELECT count(*) FROM (SELECT {key} FROM {child} GROUP BY 1 HAVING count(*) > 1)) AS repeated_child_keys, (SELECT count(*) FROM (SELECT {pk} FROM {parent} GROUP BY 1 HAVING count(*) > 1)) AS repeated_parent_keys)")


def _type_check(spark, sf):
    """The given tables against a declared layout that is wrong in three columns."""
    expected = {"orders": schemas.struct("o_orderkey BIGINT, o_custkey INT, o_totalprice INT"),
                "events": schemas.struct("event_id BIGINT, value STRING")}
    return store.type_mismatches(spark, {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in expected}, expected)


register("s11b_type_check", _type_check,
         """SELECT e.table_name, e.column_name, e.expected, a.actual FROM
            (VALUES ('orders', 'o_orderkey', 'bigint'), ('orders', 'o_custkey', 'int'), ('orders', 'o_totalprice', 'int'), ('events', 'event_id', 'bigint'), ('events', 'value', 'string')) AS e(table_name, column_name, expected)
            JOIN (SELECT 'orders' AS table_name, column_name, lower(column_type) AS actual FROM (DESCRIBE orders) UNION ALL SELECT 'events', column_name, lower(column_type) FROM (DESCRIBE events)) a
            USING (table_name, column_name) WHERE expected <> actual""")


register("s11_relationships", _relations, " UNION ALL ".join(_relation_sql(*r) for r in (
    ("orders", "o_custkey", "customer", "c_custkey", "orders -> customer"), ("lineitem", "l_orderkey", "orders", "o_orderkey", "lineitem -> orders"),
    ("customer", "c_nationkey", "nation", "n_nationkey", "customer -> nation"), ("events", "user_id", "customer", "c_custkey", "events -> customer"),
    ("lineitem", "l_partkey", "(SELECT * FROM part WHERE p_partkey % 10 <> 7)", "p_partkey", "lineitem -> reduced part"))))


# ---------------------------------------------------------------- streams
def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _arrivals(spark, sf):
    base = shared_folder(spark, "arrivals")
    counts = arrivals.arrival_counts(_stream(spark, sf), "event_type", "ts")
    arrivals.start_arrivals(counts, f"{base}/windows", f"{base}/progress").awaitTermination()
    closed = spark.read.schema(counts.schema).parquet(f"{base}/windows")
    return closed.withColumns({x: c(x).cast("timestamp_ntz") for x in ("window_start", "window_end")})


CLOSED = """SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end, count(*) AS arrivals FROM events
    GROUP BY 1, 2, 3 HAVING time_bucket(INTERVAL 15 MINUTE, any_value(ts)) + INTERVAL 15 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 15 MINUTE"""
register("e01_arrival_windows", _arrivals, CLOSED)
FEEDS = ("click", "error", "purchase", "refund", "view", "heartbeat")


def _silent(spark, sf):
    """Missed windows of the expected feeds; refunds stop on the 20th and no heartbeat ever comes."""
    closed = _arrivals(spark, sf)
    closed = closed.filter((c("event_type") != "refund") | (c("window_start") < F.lit("2024-01-20").cast("timestamp_ntz")))
    feeds = small_table(spark, "event_type STRING", [(f,) for f in FEEDS])
    return arrivals.missed_windows(closed, "event_type", feeds=feeds, horizon=closed.agg(F.max("window_end").alias("v")).scalar())


register("e01b_missed_arrivals", _silent,
         f"""WITH w AS (SELECT * FROM ({CLOSED}) WHERE event_type <> 'refund' OR window_start < TIMESTAMP '2024-01-20'),
             f AS (SELECT unnest({list(FEEDS)}) AS event_type UNION SELECT event_type FROM w),
             p AS (SELECT event_type, window_start FROM w UNION SELECT event_type, (SELECT min(window_start) FROM w) - INTERVAL 15 MINUTE FROM f UNION SELECT event_type, (SELECT max(window_end) FROM w) FROM f)
             SELECT event_type, prev + INTERVAL 15 MINUTE AS missed_from, window_start AS missed_to, CAST(epoch(window_start - prev) // 900 - 1 AS BIGINT) AS missed_windows FROM
             (SELECT event_type, window_start, lag(window_start) OVER (PARTITION BY event_type ORDER BY window_start) AS prev FROM p) WHERE window_start > prev + INTERVAL 15 MINUTE""")
register("e01c_each_missed_window", lambda s, sf: arrivals.each_window(arrivals.missed_windows(_arrivals(s, sf), "event_type"), "event_type"),
         f"""SELECT event_type, unnest(generate_series(prev + INTERVAL 15 MINUTE, window_start - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS missed_window FROM
             (SELECT event_type, window_start, lag(window_start) OVER (PARTITION BY event_type ORDER BY window_start) AS prev FROM ({CLOSED})) WHERE window_start > prev + INTERVAL 15 MINUTE""")


def _silence_alerts(spark, sf):
    """Users without an event for two days when the stream has read everything."""
    base = shared_folder(spark, "silence")
    alerts = silence.silent_feeds(_stream(spark, sf), "user_id", "ts", limit_minutes=2 * 1440)
    silence.start_alerts(alerts, f"{base}/alerts", f"{base}/progress").awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{base}/alerts").select("user_id", c("silent_since").cast("timestamp_ntz").alias("silent_since"))


register("e01d_silence_alerts", _silence_alerts,
         """SELECT user_id, date_trunc('millisecond', max(ts)) AS silent_since FROM events WHERE user_id IS NOT NULL GROUP BY 1
            HAVING max(ts) + INTERVAL 2 DAY < (SELECT max(ts) FROM events) - INTERVAL 15 MINUTE""")


def _incremental(spark, sf):
    g = Governance(spark, sf)
    base = shared_folder(spark, "control-stream")
    owners = g.table("customer").select(c("c_custkey").alias("user_id"), c("c_nationkey").alias("dataset_id"))

    def counters(batch):
        per_key = controls.control_counters(batch, ["user_id", F.to_date("ts").alias("test_date")], gov_controls())
        return controls.roll_up(per_key.join(owners, "user_id"), ["dataset_id", "test_date"])

    keys = ["dataset_id", "test_date"]
    control_stream.start_counters(_stream(spark, sf), counters, f"{base}/counters", f"{base}/progress", keys).awaitTermination()
    return controls.test_results(control_stream.accumulated(spark, f"{base}/counters", keys), g.rulebook, g.bridge)


register("e02_incremental_tests", _incremental,
         gov_sql("SELECT test_id, test_date, dataset_id, rule_id, total_records, pass_count, fail_count, failure_rate, control_effectiveness, status FROM gt"))
