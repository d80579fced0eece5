"""Alerts for silent feeds, raised while the stream runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Silence(StatefulProcessor):
    """Per feed: the latest time seen and one timer on it.

    Every newer row moves the timer to its time plus the limit. When the watermark passes the
    timer nothing has come in between, so the feed is silent and one alert is raised; the next
    row sets a timer again. Both are in the checkpoint, so a restart raises nothing twice.
    """

    def __init__(self, key: str, limit_ms: int):
        self.key, self.limit_ms = key, limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("ms", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(frame.iloc[:, -1].max()) for frame in rows)  # frames may come without names; the time is last
        seen = self.last.get()[0] if self.last.exists() else None
        if seen is None or newest > seen:
            if seen is not None:
                self.handle.deleteTimer(seen + self.limit_ms)
            self.last.update((newest,))
            self.handle.registerTimer(newest + self.limit_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since = self.last.get()[0]
        yield pd.DataFrame({self.key: [key[0]], "silent_since_ms": [since], "noticed_ms": [timerValues.getCurrentWatermarkInMs()]})

    def close(self) -> None:
        pass


def silent_feeds(stream: DataFrame, key: str, time: str, limit_minutes: int = 15, delay: str = "15 minutes") -> DataFrame:
    """One row per silence: key, silent_since (the last time seen) and noticed_at (the watermark then).

    A feed is silent when the watermark, the newest time of all feeds less ``delay``, is past
    its last row by ``limit_minutes``. State is one number per feed. Rows without a key or a
    time are no arrivals. Times without zone are read in the session time zone.
    """
    kind = stream.schema[key].dataType
    at = F.col(time).cast("timestamp")
    arrivals = stream.select(F.col(key), at.alias("_at"), F.unix_millis(at).alias("_ms")).filter(F.col(key).isNotNull() & F.col("_at").isNotNull())
    schema = T.StructType([T.StructField(key, kind), T.StructField("silent_since_ms", T.LongType()), T.StructField("noticed_ms", T.LongType())])
    alerts = arrivals.withWatermark("_at", delay).groupBy(key).transformWithStateInPandas(
        statefulProcessor=Silence(key, limit_minutes * 60_000), outputStructType=schema, outputMode="Append", timeMode="eventTime")
    return alerts.select(key, F.timestamp_millis("silent_since_ms").alias("silent_since"), F.timestamp_millis("noticed_ms").alias("noticed_at"))


def start_alerts(alerts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every alert once to files; processes what is available and stops."""
    session = alerts.sparkSession
    before = session.conf.get(PROVIDER, None)
    session.conf.set(PROVIDER, ROCKSDB)  # timers need it; a query keeps the setting it starts with
    try:
        return (
            alerts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
    finally:
        session.conf.unset(PROVIDER) if before is None else session.conf.set(PROVIDER, before)
