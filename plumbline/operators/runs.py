"""Queries over stored runs and the ranked report rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.exprs import ranked, small_table


def all_summaries(summary: DataFrame, run_log: DataFrame) -> DataFrame:
    """Every summary with its record total, oldest first."""
    return summary.join(run_log.select("run_id", "total_records"), "run_id", "left").orderBy("run_timestamp")


def results_of_run(results: DataFrame, run_id: str) -> DataFrame:
    return results.filter(F.col("run_id") == run_id).orderBy("dimension", "rule_id")


def latest_run(summary: DataFrame, run_log: DataFrame) -> DataFrame:
    """Newest summary: a top-1 per task, merged; empty when nothing is stored."""
    newest = summary.orderBy(F.col("run_timestamp").desc(), "run_id").limit(1)
    return newest.join(run_log.select("run_id", "total_records"), "run_id", "left")


def run_log_newest_first(run_log: DataFrame) -> DataFrame:
    return run_log.orderBy(F.col("run_timestamp").desc())


def rule_texts(results: DataFrame) -> DataFrame:
    """Business impact and recommendation per rule, with the default texts."""
    texts = small_table(results.sparkSession, "rule_id STRING, business_impact STRING, recommendation STRING", V.RULE_TEXTS)
    return results.join(texts, "rule_id", "left").fillna(
        {"business_impact": "", "recommendation": V.DEFAULT_RECOMMENDATION})


def ranked_issues(results: DataFrame, by: list[str], top: int | None = None) -> DataFrame:
    """Non-passing checks by severity, then failure share; ``top`` per run when given."""
    issues = results.filter(F.col("status") != "PASS")
    w = Window.partitionBy(*by).orderBy(ranked(F.col("severity"), V.SEVERITY_RANK), F.col("failure_pct").desc(), "rule_id")
    out = issues.withColumn("issue_rank", F.row_number().over(w))
    return out if top is None else out.filter(F.col("issue_rank") <= top)


def grouped_by_dimension(results: DataFrame) -> DataFrame:
    """All results in the fixed dimension order of the report."""
    order = {d: i for i, d in enumerate(V.DIMENSION_WEIGHTS, 1)}
    return results.withColumn("dimension_order", ranked(F.col("dimension"), order, 99)).orderBy("dimension_order", "ordinal")
