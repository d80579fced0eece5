"""Scenarios of the sixteen event checks on tiny frames."""

import pytest
from pyspark.sql import functions as F

from plumbline import fixed_values as V
from plumbline import schemas
from plumbline.operators.checks import EventRules, run_checks

W0, W1, DAY = V.WINDOW_START_MS, V.WINDOW_END_MS, 86_400_000
DEFAULT = {"timestamp": W0 + 1000, "visitorid": 1, "event": "view", "itemid": 100, "transactionid": None}


def events(spark, rows):
    data = [tuple({**DEFAULT, **r}[c] for c in schemas.EVENTS.fieldNames()) for r in rows]
    return spark.createDataFrame(data, schemas.EVENTS)


def items(spark, ids=(100,), cats=None):
    return spark.createDataFrame([(i, float(c)) for i, c in zip(ids, cats or [10] * len(ids))], "itemid bigint, categoryid double")


def tree(spark, ids=(10,)):
    return spark.createDataFrame([(i, None) for i in ids], schemas.CATEGORY_TREE)


def txn(tid, **more):
    return {"event": "transaction", "transactionid": tid, **more}


CASES = [
    ("COMP-001", [{"visitorid": 1}, {"visitorid": 2}], "PASS", 0, 2),
    ("COMP-001", [{"visitorid": None}, {}, {"visitorid": None}], "FAIL", 2, 3),
    ("COMP-002", [{"itemid": 100}, {"itemid": 200}], "PASS", 0, 2),
    ("COMP-002", [{"itemid": None}, {"itemid": 100}], "FAIL", 1, 2),
    ("COMP-003", [{"event": None}, {}], "FAIL", 1, 2),
    ("COMP-004", [txn(None), txn("T1"), {}], "FAIL", 1, 2),
    ("UNIQ-001", [txn("T1"), txn("T2")], "PASS", 0, 2),
    ("UNIQ-001", [txn("T1"), txn("T1"), txn("T2")], "FAIL", 2, 3),
    ("UNIQ-001", [txn(None), txn(None), {"transactionid": "T1"}], "PASS", 0, 0),
    ("UNIQ-002", [{"visitorid": 1}, {"visitorid": 2}], "PASS", 0, 2),
    ("UNIQ-002", [{}, {}], "FAIL", 1, 2),
    ("VALID-001", [{"event": e} for e in V.VALID_EVENTS], "PASS", 0, 3),
    ("VALID-001", [{"event": "view"}, {"event": "click"}, {"event": "hover"}, {"event": None}], "FAIL", 2, 4),
    ("VALID-002", [{"timestamp": W0 + 1000}, {"timestamp": W1 - 1000}, {"timestamp": W0}, {"timestamp": W1}], "PASS", 0, 4),
    ("VALID-002", [{"timestamp": W0 + 1000}, {"timestamp": 946684800000}, {"timestamp": None}], "FAIL", 1, 3),
    ("VALID-003", [{"itemid": 0}, {"itemid": -1}, {"itemid": None}, {"itemid": 5}], "FAIL", 2, 4),
    ("CONS-001", [{}, txn("T1")], "PASS", 0, 1),
    ("CONS-001", [txn(None), txn("T1")], "FAIL", 1, 2),
    ("CONS-002", [{}, {"event": "addtocart"}], "PASS", 0, 2),
    ("CONS-002", [{"transactionid": "T9"}, {}], "FAIL", 1, 2),
    ("CONS-003", [{"timestamp": W0 + 1}, txn("T1", timestamp=W0 + 2)], "PASS", 0, 1),
    ("CONS-003", [txn("T1")], "WARN", 1, 1),
    ("CONS-003", [{"visitorid": None}, txn("T1", visitorid=None)], "PASS", 0, 2),
    ("CONS-003", [{"event": None, "timestamp": W0 + 1}, txn("T1", timestamp=W0 + 2)], "WARN", 1, 1),
    ("CONS-003", [{"event": None}], "PASS", 0, 1),
    ("FRESH-001", [{"timestamp": W0 + DAY}], "PASS", 0, 1),
    ("FRESH-001", [{"timestamp": 946684800000}], "FAIL", 1, 1),
    ("FRESH-001", [{"timestamp": None}], "FAIL", 1, 1),
    ("FRESH-002", [{"timestamp": W0 + i * DAY} for i in range(10)], "PASS", 0, 10),
    ("FRESH-002", [{"timestamp": W0 + 1000}, {"timestamp": W0 + 10 * DAY}], "WARN", 9, 11),
    ("FRESH-002", [{"timestamp": W0}, {"timestamp": W0 + 7 * DAY}], "PASS", 0, 8),
    ("FRESH-002", [{"timestamp": None}], "PASS", 0, 1),
]


@pytest.mark.parametrize("rule,rows,status,failed,total", CASES)
def test_event_check(spark, rule, rows, status, failed, total):
    (r,) = run_checks(events(spark, rows), items(spark), tree(spark), rules=[rule]).collect()
    assert (r.rule_id, r.status, r.failed_records, r.total_records) == (rule, status, failed, total)


@pytest.mark.parametrize("ids,known,status,failed", [((100, 200), (100, 200, 300), "PASS", 0), ((100, 999), (100, 200), "FAIL", 1)])
def test_items_in_catalog(spark, ids, known, status, failed):
    df = events(spark, [{"itemid": i} for i in ids])
    (r,) = run_checks(df, items(spark, known), tree(spark), rules=["RI-001"]).collect()
    assert (r.status, r.failed_records, r.total_records) == (status, failed, len(ids))


@pytest.mark.parametrize("cats,known,status,failed", [((10, 20), (10, 20, 30), "PASS", 0), ((10, 999), (10, 20), "FAIL", 1)])
def test_categories_in_tree(spark, cats, known, status, failed):
    (r,) = run_checks(events(spark, [{}]), items(spark, (1, 2), cats), tree(spark, known), rules=["RI-002"]).collect()
    assert (r.status, r.failed_records, r.total_records) == (status, failed, 2)


def test_gap_days_is_reported_even_below_the_alert(spark):
    df = events(spark, [{"timestamp": W0}, {"timestamp": W0 + 4 * DAY}])
    (r,) = run_checks(df, rules=["FRESH-002"]).collect()
    assert (r.gap_days, r.failed_records) == (3, 0)


def test_all_checks_on_an_empty_frame(spark):
    rows = run_checks(events(spark, []), items(spark, []), tree(spark, []), run_id="R").orderBy("ordinal").collect()
    assert [r.rule_id for r in rows] == [c[0] for c in V.EVENT_CHECKS]
    assert {r.rule_id for r in rows if r.status != "PASS"} == {"FRESH-001"}
    assert all(r.failure_pct in (0.0, 100.0) and r.run_id == "R" for r in rows)


def test_equal_timestamps_are_settled_by_the_tie_column(spark):
    rows = [(1, W0, 7, "view"), (2, W0, 7, "transaction"), (3, W0, 8, "transaction"), (4, W0, 8, "view"), (5, W0, 9, None), (6, W0, 9, "transaction")]
    df = spark.createDataFrame([(i, t, v, e, 1, "T") for i, t, v, e in rows], "event_id bigint, timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid string")
    (r,) = run_checks(df, cfg=EventRules(tie="event_id"), rules=["CONS-003"]).collect()
    assert (r.total_records, r.failed_records) == (3, 2)


def test_batches_give_the_same_rows_as_separate_runs(spark):
    one = events(spark, [{"visitorid": None}, txn("T1"), txn("T1"), {"itemid": 7}])
    two = events(spark, [txn(None, visitorid=None), {"event": "click", "timestamp": 946684800000}])
    both = one.withColumn("batch", F.lit("a")).unionByName(two.withColumn("batch", F.lit("b")))
    got = {(r.batch, r.rule_id): (r.status, r.total_records, r.failed_records, r.gap_days) for r in run_checks(both, items(spark), tree(spark), by=["batch"]).collect()}
    want = {}
    for name, df in (("a", one), ("b", two)):
        for r in run_checks(df, items(spark), tree(spark)).collect():
            want[(name, r.rule_id)] = (r.status, r.total_records, r.failed_records, r.gap_days)
    assert got == want
