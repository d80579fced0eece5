"""Rule-threshold control tests measured on real rows, per dataset and day.

Counters of a control (rows in scope, rows failing) are additive. They are computed on
the fact table's own keys first, combined map-side, and rolled up again after the
dimension join: the join sees one row per (key, day), not the fact rows, so a key that
holds a third of the data costs no more than any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from .. import schemas
from ..functions.exprs import percent, reaches, small_table


@dataclass(frozen=True)
class Control:
    """An executable control: rows in ``scope`` must satisfy ``passes`` (null fails)."""

    rule_id: str
    passes: Column
    scope: Column | None = None


def default_inventory(spark: SparkSession) -> DataFrame:
    return small_table(spark, schemas.INVENTORY_DDL, V.INVENTORY)


def default_rulebook(spark: SparkSession) -> DataFrame:
    rows = [(*r, V.RULE_DESCRIPTIONS[r[0]]) for r in V.RULEBOOK]
    return small_table(spark, schemas.RULEBOOK_DDL + ", description STRING", rows)


def applicability(spark: SparkSession, mapping=V.APPLICABLE_RULES) -> DataFrame:
    """Dataset -> rule bridge, one row per pair."""
    pairs = [(d, r) for d, rules in mapping.items() for r in rules]
    return small_table(spark, schemas.BRIDGE_DDL, pairs)


def control_counters(fact: DataFrame, keys: list, controls, extra: dict[str, Column] | None = None) -> DataFrame:
    """One scan for all controls: ``{rule}__total`` and ``{rule}__fail`` per key group.

    ``extra`` adds further additive measures (row conditions to count).
    """
    aggs = [F.count("*").alias("n_rows")]
    for k in controls:
        scope = F.lit(True) if k.scope is None else F.coalesce(k.scope, F.lit(False))
        ok = F.coalesce(k.passes, F.lit(False))
        aggs += [F.count_if(scope).alias(f"{k.rule_id}__total"), F.count_if(scope & ~ok).alias(f"{k.rule_id}__fail")]
    for name, cond in (extra or {}).items():
        aggs.append(F.count_if(cond).alias(name))
    return fact.groupBy(*keys).agg(*aggs)


def roll_up(counters: DataFrame, keys: list[str]) -> DataFrame:
    """Sum additive counters to coarser keys."""
    numeric = [c for c in counters.columns if c == "n_rows" or c.endswith(("__total", "__fail")) or c.startswith("m_")]
    return counters.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numeric])


def test_results(counters: DataFrame, rulebook: DataFrame, bridge: DataFrame | None = None, compare_digits: int | None = None) -> DataFrame:
    """Long control-test rows from wide counters keyed (dataset_id, test_date).

    A rule without rows in scope gives no row. ``bridge`` keeps only mapped pairs.
    Both the failure rate and the effectiveness come from the counts, and so does the
    status; ``compare_digits`` compares the rounded effectiveness instead.
    """
    rules = [c[: -len("__total")] for c in counters.columns if c.endswith("__total")]
    args = ", ".join(f"'{r}', `{r}__total`, `{r}__fail`" for r in rules)
    long = counters.select(
        "dataset_id", "test_date", F.expr(f"stack({len(rules)}, {args}) AS (rule_id, total_records, fail_count)")
    ).filter(F.col("total_records") > 0)
    if bridge is not None:
        long = long.join(bridge, ["dataset_id", "rule_id"], "left_semi")
    c = F.col
    measured = long.select(
        F.concat_ws("-", F.lit("TEST"), F.date_format("test_date", "yyyyMMdd"), c("dataset_id").cast("string"), c("rule_id")).alias("test_id"),
        "test_date", "dataset_id", "rule_id", "total_records",
        (c("total_records") - c("fail_count")).alias("pass_count"), "fail_count",
        percent(c("fail_count"), c("total_records"), 2).alias("failure_rate"),
        percent(c("total_records") - c("fail_count"), c("total_records"), 2).alias("control_effectiveness"),
    )
    return (
        measured.join(rulebook.select("rule_id", "threshold"), "rule_id")
        .withColumn("status", F.when(reaches(c("pass_count"), c("total_records"), c("threshold"), compare_digits), "Pass").otherwise("Fail"))
        .select(*schemas.TESTS.fieldNames())
    )


def reconcile(tests: DataFrame, rulebook: DataFrame, inventory: DataFrame) -> DataFrame:
    """Recompute the status from counts and threshold and compare with the stored one."""
    c = F.col
    again = F.when(reaches(c("pass_count"), c("total_records"), c("threshold")), "Pass").otherwise("Fail")
    return (
        tests.join(rulebook.select("rule_id", "rule_name", "category", "threshold"), "rule_id")
        .join(inventory.select("dataset_id", "dataset_name"), "dataset_id")
        .withColumn("status_recomputed", again)
        .withColumn("reconciled", c("status") == c("status_recomputed"))
    )


def mismatches(reconciled: DataFrame) -> DataFrame:
    return reconciled.agg(F.count("*").alias("tests"), F.count_if(~F.col("reconciled")).alias("mismatches"))


def lookup(spark: SparkSession, table: DataFrame, key: str, value) -> DataFrame:
    """Point lookup of one rule or dataset."""
    return table.filter(F.col(key) == value)
