"""Incremental control tests: counters per micro-batch, tests from their sum."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.controls import roll_up
from ..sources.commit_log import CommitLog, Snapshot

FAN = 4  # folders of one level that are merged into one of the next


def start_counters(stream: DataFrame, counters: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Write the additive counters of every micro-batch to a log of folders (see ``CounterLog``)."""
    session = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        CounterLog(session, path, keys).add(counters(batch), batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class CounterLog:
    """Additive counters of micro-batches, merged in levels.

    A batch is a folder of level 0. Whenever ``FAN`` folders of a level are there, they are
    summed over ``keys`` into one of the next level, so after n batches there are at most
    ``FAN - 1`` folders for each of log(n) levels and every row is rewritten log(n) times. A
    batch and its merges become visible by one manifest, which also holds the batch number: a
    batch that runs again after a failure is found there and not counted twice, and one that
    failed before has left nothing visible. Folders of earlier versions are kept for one batch,
    for readers that have just opened them.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.keys, self.log = spark, keys, CommitLog(spark, path)

    def read(self, snapshot: Snapshot | None = None) -> DataFrame:
        """Counters over all batches so far, per ``keys``."""
        folders = (snapshot or self.log.snapshot()).folders
        return roll_up(self._rows(folders), self.keys)

    def _rows(self, folders) -> DataFrame:
        return self.spark.read.parquet(*[self.log.location(f) for f in folders])

    def _write(self, rows: DataFrame, level: int) -> str:
        folder = self.log.stage(f"-{level}")
        rows.write.parquet(self.log.location(folder))
        return folder

    def add(self, rows: DataFrame, batch_id: int) -> bool:
        """Add the counters of one batch; False if it was added before."""
        base = self.log.snapshot()
        if base.note is not None and int(base.note) >= batch_id:
            return False
        self.log.expire(keep=1)
        live, added, level = list(base.folders), [self._write(rows, 0)], 0
        live += added
        while True:
            same = [f for f in live if int(f.rsplit("-", 1)[1]) == level]
            if len(same) < FAN:
                break
            level += 1
            merged = self._write(roll_up(self._rows(same), self.keys).coalesce(1), level)
            live = [f for f in live if f not in same] + [merged]
        removed = [f for f in base.folders if f not in live]
        if not self.log.publish(base, [f for f in live if f not in base.folders], removed, str(batch_id)):
            raise RuntimeError("another stream writes to this log")
        return True


def accumulated(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Counters over all batches so far."""
    return CounterLog(spark, path, keys).read()
