"""Dimension scores, weighted score, critical override."""

import pytest
from pyspark.sql import functions as F

from plumbline import fixed_values as V
from plumbline.operators.scoring import band_check, dimension_scores, quality_scores, quality_status

DIMS = list(V.DIMENSION_WEIGHTS)


def results(spark, rows):
    return spark.createDataFrame([("R", f"X-{i}", *r) for i, r in enumerate(rows)], "run_id string, rule_id string, dimension string, severity string, status string")


@pytest.mark.parametrize("rows,score", [
    ([("critical", "PASS")], 100.0), ([("critical", "FAIL")], 75.0), ([("high", "FAIL")], 85.0), ([("medium", "WARN")], 92.0),
    ([("low", "WARN")], 97.0), ([("critical", "FAIL")] * 5, 0.0),
])
def test_dimension_score(spark, rows, score):
    (r,) = dimension_scores(results(spark, [("completeness", *x) for x in rows])).collect()
    assert r.score == score


def test_all_pass(spark):
    (r,) = quality_scores(results(spark, [(d, "high", "PASS") for d in DIMS])).collect()
    assert (r.quality_score, r.status, r.pass_count, r.fail_count, r.critical_failures) == (100.0, "Excellent", 6, 0, 0)


def test_critical_failure_overrides_the_score(spark):
    rows = [(DIMS[0], "critical", "FAIL")] + [(d, "high", "PASS") for d in DIMS[1:]]
    (r,) = quality_scores(results(spark, rows)).collect()
    assert (r.has_critical_failure, r.quality_score, r.status) == (True, 95.0, "Warning")


def test_severity_counts_and_default_dimensions(spark):
    rows = [("completeness", "critical", "FAIL"), ("uniqueness", "critical", "FAIL"), ("referential_integrity", "high", "FAIL"),
            ("consistency", "medium", "WARN"), ("completeness", "critical", "PASS")]
    (r,) = quality_scores(results(spark, rows)).collect()
    assert (r.critical_failures, r.high_failures, r.medium_failures, r.low_failures) == (2, 1, 1, 0)
    assert (r.score_validity, r.score_freshness) == (100.0, 100.0)


@pytest.mark.parametrize("score,critical,status", [
    (95.0, False, "Excellent"), (80.0, False, "Good"), (65.0, False, "Warning"), (50.0, False, "Critical"), (95.0, True, "Warning"), (45.0, True, "Critical"),
])
def test_status(spark, score, critical, status):
    assert spark.range(1).select(quality_status(F.lit(score), F.lit(critical)).alias("s")).first().s == status


def test_band_check(spark):
    df = spark.createDataFrame([("clean", 95.0), ("light", 87.0), ("moderate", 90.0)], "tier string, quality_score double")
    assert {r.tier: r.in_band for r in band_check(df).collect()} == {"clean": True, "light": True, "moderate": False}
