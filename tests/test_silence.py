"""Silent feeds are reported while the stream runs, once per silence, also over restarts."""

from pyspark.sql import functions as F

from plumbline.streaming import silence

DDL = "feed string, at string"


def _add(spark, folder, *rows):
    """One more file, so one more micro-batch."""
    df = spark.createDataFrame(rows, DDL).select("feed", F.to_timestamp("at").cast("timestamp_ntz").alias("at"))
    df.coalesce(1).write.mode("append").parquet(folder)


def _run(spark, tmp_path):
    stream = spark.readStream.schema("feed string, at timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    alerts = silence.silent_feeds(stream, "feed", "at", limit_minutes=30, delay="5 minutes")
    silence.start_alerts(alerts, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    found = spark.read.schema(alerts.schema).parquet(str(tmp_path / "out")).collect()
    return sorted((r.feed, str(r.silent_since)[11:16]) for r in found)


def _at(minute):
    return f"2024-01-01 {minute // 60:02}:{minute % 60:02}:00"


def test_one_alert_per_silence_and_none_twice(spark, tmp_path):
    folder = str(tmp_path / "in")
    # "a" sends every ten minutes, "b" stops after 10 minutes, comes back at 100 and stops again; "c" is late but there
    _add(spark, folder, ("a", _at(0)), ("b", _at(0)), ("c", _at(0)), (None, _at(0)), ("a", None))
    _add(spark, folder, ("a", _at(10)), ("b", _at(10)), ("c", _at(9)))
    _add(spark, folder, ("a", _at(20)), ("a", _at(30)), ("c", _at(29)), ("c", _at(12)))
    assert _run(spark, tmp_path) == []
    _add(spark, folder, ("a", _at(50)), ("c", _at(51)))
    _add(spark, folder, ("a", _at(60)), ("c", _at(61)))
    assert _run(spark, tmp_path) == [("b", "00:10")]  # the watermark is at 56, past 40
    assert _run(spark, tmp_path) == [("b", "00:10")]  # a restart raises nothing again
    _add(spark, folder, ("a", _at(90)), ("c", _at(85)))
    _add(spark, folder, ("a", _at(100)), ("b", _at(100)), ("c", _at(99)))
    assert _run(spark, tmp_path) == [("b", "00:10")]
    _add(spark, folder, ("a", _at(150)))
    _add(spark, folder, ("a", _at(151)))
    assert _run(spark, tmp_path) == [("b", "00:10"), ("b", "01:40"), ("c", "01:39")]
