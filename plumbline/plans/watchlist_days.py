"""The watchlist history kept day by day: a new day reads that day and the state, nothing else."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators.watchlist import status_on
from ..sources.commit_log import CommitLog, Snapshot


class WatchlistDays:
    """Statuses of all days so far, and the daily rows the next day will need.

    The state is one row per dataset and day for the days of both trend periods (30): adding a
    day takes its rows in and lets the oldest day go, so its cost does not grow with the history.
    State and statuses of a day become visible together, by one manifest that names the day; a
    day that is added again, or one before it, changes nothing, and a run that stops half-way
    leaves nothing visible.
    """

    def __init__(self, spark: SparkSession, root: str, split: int = V.TREND_SPLIT_DAYS, early_days: int = V.TREND_SPLIT_DAYS):
        self.spark, self.split, self.early_days, self.log = spark, split, early_days, CommitLog(spark, root)

    def _read(self, snapshot: Snapshot, kind: str) -> DataFrame | None:
        frames = [self.spark.read.parquet(self.log.location(f)) for f in snapshot.folders if f.endswith(kind)]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def _write(self, rows: DataFrame, kind: str) -> str:
        folder = self.log.stage(kind)
        rows.write.parquet(self.log.location(folder))
        return folder

    def add(self, rows: DataFrame, day: dt.date) -> bool:
        """Add the ``daily_rows`` of one day; False if that day, or a later one, was added before."""
        base = self.log.snapshot()
        if base.note is not None and day.isoformat() <= base.note:
            return False
        today, state = rows.filter(F.col("test_date") == F.lit(day)), self._read(base, "-state")
        kept = today if state is None else state.unionByName(today)
        first = day - dt.timedelta(days=self.split + self.early_days - 1)
        folder = self._write(kept.filter(F.col("test_date") >= F.lit(first)).coalesce(1), "-state")
        state = self.spark.read.parquet(self.log.location(folder))
        status = self._write(status_on(state, F.lit(day), self.split, self.early_days).coalesce(1), "-status")
        old = [f for f in base.folders if f.endswith("-state")]
        if not self.log.publish(base, [folder, status], old, day.isoformat()):
            raise RuntimeError("another run adds days to this history")
        return True

    def state(self) -> DataFrame | None:
        return self._read(self.log.snapshot(), "-state")

    def history(self) -> DataFrame | None:
        """One row per dataset and day, as ``watchlist.history`` gives; None before the first day."""
        return self._read(self.log.snapshot(), "-status")
