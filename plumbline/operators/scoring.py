"""Severity-penalty quality scores over check results, for one run or many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.exprs import add_all, banded, ranked, rounded

DIMENSIONS = tuple(V.DIMENSION_WEIGHTS)


def penalty(penalties: dict = V.SEVERITY_PENALTIES) -> Column:
    """Points lost by one result row: zero when it passed."""
    return F.when(F.col("status").isin("FAIL", "WARN"), ranked(F.col("severity"), penalties, 0)).otherwise(0)


def dimension_scores(results: DataFrame, by=("run_id",), penalties: dict = V.SEVERITY_PENALTIES) -> DataFrame:
    """Score per dimension, not below zero."""
    lost = F.sum(penalty(penalties))
    return results.groupBy(*by, "dimension").agg(F.greatest(F.lit(0.0), F.lit(100.0) - lost).alias("score"))


def quality_status(score: Column, critical: Column) -> Column:
    """Label of a score; a critical failure allows Warning at best."""
    return F.when(critical, F.when(score >= 60, "Warning").otherwise("Critical")).otherwise(
        banded(score, V.QUALITY_BANDS, "Critical")
    )


def quality_scores(
    results: DataFrame,
    by=("run_id",),
    weights: dict = V.DIMENSION_WEIGHTS,
    penalties: dict = V.SEVERITY_PENALTIES,
) -> DataFrame:
    """One summary row per run: score, status, counts and the dimension scores.

    The dimensions are few and fixed, so all of them come from one aggregation with
    conditional sums; a dimension without results scores 100.
    """
    c = F.col
    failing = c("status").isin("FAIL", "WARN")
    aggs = [
        F.greatest(
            F.lit(0.0),
            F.lit(100.0) - F.coalesce(F.sum(F.when(c("dimension") == d, penalty(penalties))), F.lit(0)),
        ).alias(f"score_{d}")
        for d in weights
    ]
    aggs += [F.count_if(c("status") == s).alias(f"{s.lower()}_count") for s in ("PASS", "FAIL", "WARN")]
    aggs += [F.count_if(failing & (c("severity") == s)).alias(f"{s}_failures") for s in penalties]
    aggs.append(
        F.coalesce(F.bool_or((c("status") == "FAIL") & (c("severity") == "critical")), F.lit(False)).alias("has_critical_failure")
    )
    scored = results.groupBy(*by).agg(*aggs)
    total = add_all([c(f"score_{d}") * F.lit(w) for d, w in weights.items()])
    scored = scored.withColumn("quality_score", rounded(total, 2))
    return scored.withColumn("status", quality_status(c("quality_score"), c("has_critical_failure")))


def band_check(scores: DataFrame, tier: str = "tier", bands: dict = V.TIER_SCORE_BANDS) -> DataFrame:
    """Compare each tier's score with the band expected for it."""
    low = ranked(F.col(tier), {k: v[0] for k, v in bands.items()}, 0)
    high = ranked(F.col(tier), {k: v[1] for k, v in bands.items()}, 100)
    return scores.withColumn("band_low", low).withColumn("band_high", high).withColumn(
        "in_band", F.col("quality_score").between(F.col("band_low"), F.col("band_high"))
    )
