"""The event-quality run: check, score and store one or many batches."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import EventRules, run_checks
from ..operators.scoring import quality_scores
from ..session import settle
from ..sources.store import ResultStore


def run(events: DataFrame, items: DataFrame, categories: DataFrame, dataset_name: str, store: ResultStore | None = None,
        cfg: EventRules = EventRules(), run_timestamp: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """One run over one data set: (check results, summary row), stored when a store is given.

    The sixteen result rows are settled once, so scoring and storing do not repeat the scans.
    """
    run_id = uuid.uuid4().hex[:8]
    stamp = F.lit(run_timestamp or dt.datetime.now())
    results = settle(run_checks(events, items, categories, cfg, run_id), "check-results")
    summary = quality_scores(results).withColumn("dataset_name", F.lit(dataset_name)).withColumn("run_timestamp", stamp)
    if store is not None:
        total = results.filter(F.col("rule_id") == "COMP-001").select("run_id", "total_records")
        store.append_run_log(total.withColumn("run_timestamp", stamp).withColumn("dataset_name", F.lit(dataset_name)).withColumn("status", F.lit("COMPLETED")))
        store.append_results(results)
        store.append_summary(summary)
    return results, summary
