"""Inputs that once gave wrong or no answers."""

import itertools

import pytest
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.operators import analysis, exceptions, rules, trust, watchlist
from plumbline.operators.checks import EventRules, run_checks
from plumbline.operators.controls import reconcile, test_results as control_results
from plumbline.sources import readers, sampling, store
from plumbline.streaming import arrivals


def test_few_failures_in_many_rows_fail_a_full_threshold(spark):
    counters = spark.createDataFrame([(1, "2024-01-01", 1_000_000, 40), (2, "2024-01-01", 1_000_000, 0)], "dataset_id int, d string, R__total bigint, R__fail bigint")
    counters = counters.select("dataset_id", F.to_date("d").alias("test_date"), "R__total", "R__fail")
    book = spark.createDataFrame([("R", "rule", "Accuracy", 100.0, "Critical")], "rule_id string, rule_name string, category string, threshold double, severity string")
    tests = control_results(counters, book)
    assert {r.dataset_id: (r.control_effectiveness, r.status) for r in tests.collect()} == {1: (100.0, "Fail"), 2: (100.0, "Pass")}
    assert {r.status for r in control_results(counters, book, compare_digits=2).collect()} == {"Pass"}
    inventory = spark.createDataFrame([(1, "a"), (2, "b")], "dataset_id int, dataset_name string")
    assert all(r.reconciled for r in reconcile(tests, book, inventory).collect())
    stored = tests.withColumn("status", F.lit("Pass"))
    assert sorted(r.reconciled for r in reconcile(stored, book, inventory).collect()) == [False, True]
    counts = spark.createDataFrame([("R", 10**12, 10)], "rule_id string, total_records bigint, fail_count bigint")
    assert rules.graded_rules(counts, book).first().status == "Fail"


def test_small_and_huge_amounts_add_up(spark):
    head = spark.createDataFrame([(1, 0.04), (2, 2e16)], "k int, a double")
    lines = spark.createDataFrame([(1, 0.004)] * 10 + [(2, 1e16)] * 2, "k int, a double")
    row = rules.totals_match("R", head, "k", "a", lines, "k", "a", 0.001).first()
    assert (row.total_records, row.fail_count) == (2, 0)


@pytest.mark.parametrize("odd", [1_430_438_401_000_000_000, -1, -(2**62), 2**63 - 1])
def test_absurd_times_are_reported_not_fatal(spark, odd):
    day = 86_400_000
    rows = [(1_430_438_401_000 + i * day, 1, "view", 5, None) for i in range(3)] + [(odd, 1, "view", 5, None)]
    events = spark.createDataFrame(rows, schemas.EVENTS)
    found = {r.rule_id: r for r in run_checks(events, rules=["VALID-002", "FRESH-001", "FRESH-002", "COMP-001"]).collect()}
    assert (found["VALID-002"].total_records, found["VALID-002"].failed_records) == (4, 1)
    assert found["COMP-001"].total_records == 4
    if abs(odd) > 10**15:
        assert (found["FRESH-002"].total_records, found["FRESH-002"].failed_records) == (3, 0)


def test_texts_name_the_parameters(spark):
    events = spark.createDataFrame([(0, 1, "view", 5, None)], schemas.EVENTS)
    cfg = EventRules(window_start=1_704_067_200_000, window_end=1_706_659_199_000, gap_days=3, valid_events=("view", "buy"))
    text = {r.rule_id: r.rule_desc for r in run_checks(events, cfg=cfg, rules=["VALID-001", "VALID-002", "FRESH-002"]).collect()}
    assert "(2024-01-01 to 2024-01-30)" in text["VALID-002"] and " 3 consecutive" in text["FRESH-002"] and text["VALID-001"].endswith(": view, buy")


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"timestamp","itemid"," property ","value"\n1,2,p,x\n3,4,"a,b",NULL\n')
    (tmp_path / "b.csv").write_text("itemid,timestamp,value,property\n20,10,N/A,nan\n,7.0,y,z\n")
    df = readers.load_item_properties(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    got = {(r["timestamp"], r.itemid, r.property, r.value) for r in df.collect()}
    assert got == {(1, 2, "p", "x"), (3, 4, "a,b", None), (10, 20, None, None), (7, None, "z", "y")}
    (tmp_path / "c.csv").write_text("itemid,time,value,property\n1,2,3,4\n")
    with pytest.raises(ValueError, match="timestamp"):
        readers.load_item_properties(spark, str(tmp_path / "c.csv"))


def test_picks_of_different_seeds_are_independent(spark):
    ids, share = 100_000, 0.04
    picks = [F.sum((sampling.picked(sampling.key_hash(F.col("id"), a), share) & sampling.picked(sampling.key_hash(F.col("id"), b), share)).cast("int"))
             for a, b in itertools.combinations(range(1, 10), 2)]
    together = spark.range(ids).agg(*picks).first()
    expected = ids * share * share
    assert all(abs(n - expected) < 6 * expected ** 0.5 for n in together)
    gaps = spark.range(10_000).filter(sampling.picked(sampling.key_hash(F.col("id")), 0.05)).orderBy("id").collect()
    assert len({b.id - a.id for a, b in zip(gaps, gaps[1:])}) > 20


def test_exact_sample_with_one_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    for n in (0, 1, 500, 1500, 3000, 5000):
        assert sampling.exact_sample(df, n, sampling.key_hash(F.col("k")), ["id"]).count() == min(n, 3000)


def _history(spark, days, failing_from):
    rows = [(d, "D1", "R", 100, 0 if d < failing_from else 50) for d in range(days)]
    df = spark.createDataFrame(rows, "d int, dataset_id string, rule_id string, total_records bigint, fail_count bigint")
    rate = F.col("fail_count") * 100.0 / F.col("total_records")
    return df.select(
        F.col("d").cast("string").alias("test_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("test_date"), "dataset_id", "rule_id", "total_records",
        (F.col("total_records") - F.col("fail_count")).alias("pass_count"), "fail_count", rate.alias("failure_rate"), (100.0 - rate).alias("control_effectiveness"),
        F.when(F.col("fail_count") > 0, "Fail").otherwise("Pass").alias("status"))


def test_a_past_date_does_not_see_what_came_later(spark):
    tests = _history(spark, 40, 20)
    book = spark.createDataFrame([("R", "rule", "Accuracy", 100.0, "Critical")], "rule_id string, rule_name string, category string, threshold double, severity string")
    inventory = spark.createDataFrame([("D1", "one", "dom", "High", "o", "s")], "dataset_id string, dataset_name string, domain string, regulatory_criticality string, owner string, steward string")
    assert exceptions.detect(tests, book, inventory, "2024-01-16").count() == 0
    assert exceptions.detect(tests, book, inventory, "2024-01-25").count() > 0
    assert trust.domain_effectiveness(tests, inventory, "2024-01-16").first().avg_control_effectiveness == 100.0
    assert analysis.mean_effectiveness_windows(tests, "2024-01-16").first() == (100.0, 100.0)
    measured = tests.select("dataset_id", "test_date", F.lit(100).alias("cells"), F.lit(1).alias("null_cells"), F.lit(100).alias("profiled_rows"), F.lit(1).alias("dup_rows"))
    for day in ("2024-01-31", "2024-02-05", "2024-02-09"):
        made = watchlist.watchlist(tests, measured, inventory, day)
        row = watchlist.reconcile(made, tests, day).first()
        assert row.trend_recomputed == row.control_failure_trend and row.reconciled
        rolling = watchlist.history(tests, measured).filter(F.col("test_date") == day).first()
        assert rolling.control_failure_trend == row.control_failure_trend


def test_profile_counts_real_nulls_and_repeats(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, "x"), ("a", None, None), ("b", None, "y"), ("b", None, "y")], "d string, k int, v string")
    got = {r.d: (r.cells, r.null_cells, r.profiled_rows, r.dup_rows) for r in watchlist.profile(df, ["k", "v"], ["k"], ["d"]).collect()}
    assert got == {"a": (6, 3, 3, 1), "b": (4, 2, 2, 1)}


def _key_rows(spark, rows):
    """(dataset, day, key) rows as key counts and a profile with sketches."""
    df = spark.createDataFrame(rows, "dataset_id string, day string, k string").withColumn("test_date", F.to_date("day"))
    counts = watchlist.key_counts(df, ["k"], ["k"], ["dataset_id", "test_date"])
    return counts, watchlist.profile_of(counts, 1, ["dataset_id", "test_date"], ["_key0"])


def test_a_key_on_two_days_is_one_repeat_of_the_period(spark):
    rows = [("D1", "2024-01-20", "a"), ("D1", "2024-01-25", "a"), ("D1", "2024-01-25", "b"), ("D1", "2024-01-25", None), ("D1", "2024-01-26", None),
            ("D1", "2024-01-10", "a"), ("D1", "2024-01-11", "c"), ("D1", "2023-12-01", "c"), ("D2", "2024-01-20", "a")]
    counts, measured = _key_rows(spark, rows)
    got = {r.dataset_id: (r.duplicate_rate_early, r.duplicate_rate_recent) for r in watchlist.period_duplicates(counts, ["_key0"], F.lit("2024-01-30").cast("date")).collect()}
    assert got == {"D1": (0.0, 40.0), "D2": (None, 0.0)}  # of five rows "a" and the null key come again
    tests = _history(spark, 59, 0).withColumn("test_date", F.date_sub("test_date", 30))
    exact = watchlist.period_rates(tests, measured, "2024-01-30", counts=counts, key=["_key0"]).first()
    sketched = watchlist.period_rates(tests, measured, "2024-01-30").first()
    assert exact.duplicate_rate_recent == sketched.duplicate_rate_recent == 40.0 and exact.duplicate_rate_early == sketched.duplicate_rate_early == 0.0
    assert watchlist.period_rates(tests, measured.drop("key_sketch"), "2024-01-30").first().duplicate_rate_recent == 0.0


def test_rolling_duplicates_beyond_the_exact_range(spark):
    # 120,000 keys on each of ten days, half of them the same on all days
    key = F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(-F.col("id") * 10 - F.col("d"))
    df = spark.range(120_000).crossJoin(spark.range(10).select(F.col("id").alias("d"))).select(
        F.lit("D1").alias("dataset_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("d").cast("int")).alias("test_date"), key.alias("k"))
    measured = watchlist.profile_of(watchlist.key_counts(df, ["k"], ["k"], ["dataset_id", "test_date"]), 1, ["dataset_id", "test_date"], ["_key0"])
    tests = _history(spark, 40, 0).withColumn("test_date", F.date_add("test_date", 0))
    last = watchlist.history(tests, measured, early=(-9, -5), recent=(-4, 0)).filter("test_date = '2024-01-10'").first()
    truth = 100.0 * (1 - (60_000 + 5 * 60_000) / (5 * 120_000))
    assert abs(last.duplicate_rate_recent - truth) < 1.0 and abs(last.duplicate_rate_early - truth) < 1.0


def test_silent_feeds_are_reported(spark):
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:15:00"), ("b", "2024-01-01 00:00:00"), ("b", "2024-01-01 06:00:00")]
    closed = spark.createDataFrame(rows, "k string, t string").select("k", F.col("t").cast("timestamp_ntz").alias("window_start"))
    feeds = spark.createDataFrame([("a",), ("b",), ("never",)], "k string")
    horizon = F.lit("2024-01-01 06:15:00").cast("timestamp_ntz")
    got = {(r.k, str(r.missed_from)[11:16], str(r.missed_to)[11:16], r.missed_windows) for r in arrivals.missed_windows(closed, "k", feeds=feeds, horizon=horizon).collect()}
    assert got == {("a", "00:30", "06:15", 23), ("b", "00:15", "06:00", 23), ("never", "00:00", "06:15", 25)}


def test_one_row_per_run_id(spark, tmp_path):
    st = store.ResultStore(spark, str(tmp_path))
    runs = spark.createDataFrame([("r1", 5), ("r1", 3), ("r2", 1)], "run_id string, total_records bigint")
    runs = runs.select("*", F.lit("2024-01-01").cast("timestamp").alias("run_timestamp"), F.lit("e").alias("dataset_name"), F.lit("DONE").alias("status"))
    for _ in range(2):
        st.append_run_log(runs)
    assert sorted((r.run_id, r.total_records) for r in st.read("dq_run_log").collect()) == [("r1", 3), ("r2", 1)]


def test_a_history_kept_day_by_day_equals_the_batch(spark, tmp_path):
    import datetime as dt

    from plumbline.plans.watchlist_days import WatchlistDays

    tests = _history(spark, 60, 25).filter(F.col("test_date") != "2024-02-10")  # one day without tests
    keys = [("D1", str(dt.date(2024, 1, 1) + dt.timedelta(days=d)), k) for d in range(60) for k in ("a", f"k{d % 9}", None)[: 1 + d % 3]]
    _, measured = _key_rows(spark, keys)
    rows = watchlist.daily_rows(tests, measured).cache()
    want = {r.test_date: r for r in watchlist.history(tests, measured).collect()}
    first = dt.date(2024, 1, 1)
    kept = WatchlistDays(spark, str(tmp_path / "again"))
    start = first + dt.timedelta(days=44)
    kept.log.publish(kept.log.snapshot(), [kept._write(rows.filter(F.col("test_date") < F.lit(start)), "-state")], note=(start - dt.timedelta(days=1)).isoformat())
    for d in range(44, 60):
        assert kept.add(rows, first + dt.timedelta(days=d))
    assert not kept.add(rows, first + dt.timedelta(days=50))
    got = kept.history().collect()
    columns = ["dataset_id", "det_count", "imp_count", "watchlist_status", "null_rate_early", "duplicate_rate_early", "duplicate_rate_recent", "control_failure_rate_recent"]
    assert {r.test_date: [r[c] for c in columns] for r in got} == {day: [r[c] for c in columns] for day, r in want.items() if day >= start}
    assert kept.state().agg(F.countDistinct("test_date")).first()[0] == 30
    assert kept.state().filter(F.col("test_date") < "2024-01-31").isEmpty()
