"""Feed-arrival monitor: fixed windows of an event stream and the windows that stayed empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.exprs import scalar, wall_micros


def arrival_counts(stream: DataFrame, key: str, time: str, width: str = "15 minutes", delay: str = "15 minutes") -> DataFrame:
    """Rows per (key, window). State holds only the open windows; the watermark drops closed ones.

    Watermarks need an instant: a time without zone is read in the session time zone.
    """
    return (
        stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).groupBy(F.col(key), F.window(time, width).alias("_w")).agg(F.count("*").alias("arrivals"))
        .select(key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "arrivals")
    )


def start_arrivals(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each closed window once to files; processes what is available and stops."""
    return (
        counts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def missed_windows(closed: DataFrame, key: str, width: str = "15 minutes", feeds: DataFrame | None = None, horizon: Column | None = None) -> DataFrame:
    """Ranges of empty windows per key: key, missed_from, missed_to (exclusive), missed_windows.

    Between a key's windows with arrivals, one row each, only the ends of a gap are kept, so
    one stray time does not make a row per window. With ``horizon`` (the start of the first
    window that is not closed yet) every key is watched from the first window of any key up to
    it: a feed that stopped is reported; ``feeds`` names the expected keys, so one that never
    started is too.
    """
    step = F.expr(f"INTERVAL {width}")
    points = closed.select(key, "window_start")
    if horizon is not None:
        watched = points.select(key)
        watched = (watched if feeds is None else watched.unionByName(feeds.select(key))).distinct()
        first = scalar(closed, F.min("window_start"))
        ends = F.explode(F.array(first - step, horizon))
        points = points.unionByName(watched.select(key, ends.alias("window_start"))).distinct()
    prev = F.lag("window_start").over(Window.partitionBy(key).orderBy("window_start"))
    gaps = points.select(key, "window_start", prev.alias("_prev")).filter(F.col("window_start") > F.col("_prev") + step)
    length = wall_micros(F.col("window_start")) - wall_micros(F.col("_prev") + step)
    one = wall_micros(F.col("_prev") + step) - wall_micros(F.col("_prev"))
    return gaps.select(key, (F.col("_prev") + step).alias("missed_from"), F.col("window_start").alias("missed_to"), F.floor(length / one).cast("bigint").alias("missed_windows"))


def each_window(missed: DataFrame, key: str, width: str = "15 minutes") -> DataFrame:
    """One row per empty window of the ranges."""
    step = F.expr(f"INTERVAL {width}")
    return missed.select(key, F.explode(F.sequence("missed_from", F.col("missed_to") - step, step)).alias("missed_window"))
