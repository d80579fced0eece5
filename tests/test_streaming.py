"""Streams in several micro-batches give what the batch operators give."""

from pyspark.sql import functions as F

from plumbline.operators import controls
from plumbline.streaming import arrivals, control_stream
from registry.core import table
from registry.governance_data import Governance, gov_controls


def _files(spark, sf, tmp_path):
    e = table(spark, sf, "events")
    path = str(tmp_path / "in")
    for week in range(4):  # one file per period, written in time order
        day = F.dayofmonth("ts")
        last = 31 if week == 3 else 8 * week + 8
        e.filter((day > 8 * week) & (day <= last)).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path), e


def test_incremental_control_tests(spark, sf, tmp_path):
    stream, _ = _files(spark, sf, tmp_path)
    g = Governance(spark, sf)
    owners = g.table("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("dataset_id"))

    def counters(batch):
        per_key = controls.control_counters(batch, ["user_id", F.to_date("ts").alias("test_date")], gov_controls())
        return controls.roll_up(per_key.join(owners, "user_id"), ["dataset_id", "test_date"])

    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):  # the second start finds nothing new
        control_stream.start_counters(stream, counters, out, progress, ["dataset_id", "test_date"]).awaitTermination()
    log = control_stream.CounterLog(spark, out, ["dataset_id", "test_date"])
    assert log.log.snapshot().note == "3" and len(log.log.snapshot().folders) == 1  # four batches, merged
    got = controls.test_results(control_stream.accumulated(spark, out, ["dataset_id", "test_date"]), g.rulebook, g.bridge)
    assert sorted(got.collect()) == sorted(g.tests.collect())


def test_arrival_windows_close_once(spark, sf, tmp_path):
    stream, e = _files(spark, sf, tmp_path)
    counts = arrivals.arrival_counts(stream, "event_type", "ts")
    arrivals.start_arrivals(counts, str(tmp_path / "w"), str(tmp_path / "p")).awaitTermination()
    closed = spark.read.schema(counts.schema).parquet(str(tmp_path / "w"))
    batch = e.withColumn("ts", F.col("ts").cast("timestamp")).groupBy("event_type", F.window("ts", "15 minutes").alias("w")).agg(F.count("*").alias("n"))
    want = {(r.event_type, r.w.start): r.n for r in batch.collect()}
    got = {(r.event_type, r.window_start): r.arrivals for r in closed.collect()}
    assert closed.count() == len(got) and got.items() <= want.items()
    open_windows = set(want) - set(got)
    last = max(s for _, s in want)
    assert open_windows and all((last - s).total_seconds() <= 1800 for _, s in open_windows)


def test_missed_windows_are_the_empty_ones(spark):
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 01:00:00"), ("b", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:15:00")]
    df = spark.createDataFrame(rows, "k string, t string").select("k", F.col("t").cast("timestamp").alias("window_start"))
    got = [(r.k, str(r.missed_window)) for r in arrivals.each_window(arrivals.missed_windows(df, "k"), "k").orderBy("missed_window").collect()]
    assert got == [("a", f"2024-01-01 00:{m}:00") for m in ("15", "30", "45")]


def _counts(spark, n):
    return spark.createDataFrame([(n % 3, 1, n)], "k int, n_total bigint, n_fail bigint")


def test_counters_of_many_batches_stay_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(control_stream, "roll_up", lambda df, keys: df.groupBy(*keys).agg(F.sum("n_total").alias("n_total"), F.sum("n_fail").alias("n_fail")))
    log = control_stream.CounterLog(spark, str(tmp_path / "c"), ["k"])
    batches = 70
    for n in range(batches):
        assert log.add(_counts(spark, n), n)
        if n in (5, 63):
            assert not log.add(_counts(spark, n), n)  # the same batch once more
    want = {k: (sum(1 for n in range(batches) if n % 3 == k), sum(n for n in range(batches) if n % 3 == k)) for k in range(3)}
    assert {r.k: (r.n_total, r.n_fail) for r in log.read().collect()} == want
    # at most three folders in each of log4(n) levels: 70 is 1012 to the base of four; 1,000 is 33220, ten folders
    assert len(log.log.snapshot().folders) == 1 + 0 + 1 + 2
    assert len(log.log._names("data")) < 20 and len(log.log.versions()) <= 3


def test_a_batch_that_fails_before_it_is_published_counts_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(control_stream, "roll_up", lambda df, keys: df.groupBy(*keys).agg(F.sum("n_total").alias("n_total"), F.sum("n_fail").alias("n_fail")))
    log = control_stream.CounterLog(spark, str(tmp_path / "c"), ["k"])
    log.add(_counts(spark, 0), 0)

    def stop(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(control_stream.CommitLog, "publish", stop)
        for _ in range(2):
            try:
                log.add(_counts(spark, 1), 1)
            except OSError:
                pass
    assert sum(r.n_total for r in log.read().collect()) == 1
    assert log.add(_counts(spark, 1), 1) and sum(r.n_total for r in log.read().collect()) == 2
    log.add(_counts(spark, 2), 2)
    assert len(log.log._names("data")) <= 3  # what the failed attempts left is gone
