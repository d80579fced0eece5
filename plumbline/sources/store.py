"""Result tables as parquet: appends with unique run ids, full refresh, export, load checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.scoring import DIMENSIONS
from .commit_log import CommitLog


class ResultStore:
    """Three append-only tables under one shared folder, each with a commit log.

    ``run_id`` is unique: rows whose id is already stored are dropped before the append, so a
    retried write adds nothing, and of rows that repeat an id inside one append to the log or
    the summary one is kept. Writers may append at the same time: rows become visible by a
    numbered manifest (see ``commit_log``), and the writer that comes second to a number drops
    the runs the first one stored. A writer that crashes leaves nothing visible.
    Detail rows are partitioned by run, and reading one run opens only its folders.
    """

    TABLES = {
        "dq_run_log": (schemas.RUN_LOG, ["dataset_name"]),
        "dq_results": (schemas.RESULTS, ["run_id"]),
        "dq_summary": (schemas.SUMMARY, []),
    }

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log(self, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{table}")

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The rows as of a version (the last one, if not given)."""
        log = self.log(table)
        return self._rows(log, table, log.snapshot(version).folders)

    def _rows(self, log: CommitLog, table: str, folders) -> DataFrame:
        schema, _ = self.TABLES[table]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", log.location("data")).parquet(*[log.location(f) for f in folders]).select(*schema.fieldNames())

    def _stage(self, log: CommitLog, table: str, rows: DataFrame) -> tuple[str, DataFrame]:
        """Write rows to a folder of their own; no reader sees it yet."""
        schema, parts = self.TABLES[table]
        folder = log.stage()
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        writer = typed.write.mode("errorifexists")
        (writer.partitionBy(*parts) if parts else writer).parquet(log.location(folder))
        return folder, self._rows(log, table, [folder])

    def _append(self, rows: DataFrame, table: str) -> None:
        log = self.log(table)
        base = log.snapshot()
        stored = self._rows(log, table, base.folders)
        folder, staged = self._stage(log, table, rows.join(stored.select("run_id").distinct(), "run_id", "left_anti"))
        while not staged.isEmpty():
            if log.publish(base, [folder]):
                return
            last = log.snapshot()
            added = [f for f in last.folders if f not in set(base.folders)]
            theirs = self._rows(log, table, added).select("run_id").distinct()
            if not staged.join(theirs, "run_id", "left_semi").isEmpty():
                folder, staged = self._stage(log, table, staged.join(theirs, "run_id", "left_anti"))
            base = last

    def _one_per_run(self, rows: DataFrame) -> DataFrame:
        """Of rows with one run_id the first in the order of their values."""
        least = rows.groupBy("run_id").agg(F.min(F.struct(*[c for c in rows.columns if c != "run_id"])).alias("_row"))
        return least.select("run_id", "_row.*").select(*rows.columns)

    def append_run_log(self, runs: DataFrame) -> None:
        self._append(self._one_per_run(runs), "dq_run_log")

    def append_results(self, results: DataFrame) -> None:
        """Adds nothing for an empty input."""
        self._append(results, "dq_results")

    def append_summary(self, scores: DataFrame) -> None:
        """Flat summary rows; a missing dimension score is stored as 100."""
        cols = set(scores.columns)
        for d in DIMENSIONS:
            name = f"score_{d}"
            value = F.coalesce(F.col(name), F.lit(100.0)) if name in cols else F.lit(100.0)
            scores = scores.withColumn(name, value)
        self._append(self._one_per_run(scores), "dq_summary")

    def compact(self, table: str) -> bool:
        """Merge all folders of a table into one; False if a writer came in between (nothing changes then).

        Readers of earlier versions keep their folders.
        """
        log = self.log(table)
        base = log.snapshot()
        if len(base.folders) < 2:
            return True
        _, parts = self.TABLES[table]
        rows = self._rows(log, table, base.folders)
        folder, _ = self._stage(log, table, rows.repartition(*parts) if parts else rows.coalesce(1))
        return log.publish(base, [folder], base.folders)


def refresh_tables(tables: dict[str, DataFrame], root: str, partition_by: dict[str, list[str]] | None = None) -> None:
    """Replace every governance table; an empty frame keeps its schema."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        keys = (partition_by or {}).get(name)
        (writer.partitionBy(*keys) if keys else writer).parquet(f"{root.rstrip('/')}/{name}")


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def type_mismatches(spark: SparkSession, actual: dict[str, DataFrame], expected: dict) -> DataFrame:
    """(table_name, column_name, expected, actual) for every column of the wrong type."""
    from ..functions.exprs import small_table

    bad = []
    for table, schema in expected.items():
        have = dict(actual[table].dtypes)
        for field in schema.fields:
            if have.get(field.name) != field.dataType.simpleString():
                bad.append((table, field.name, field.dataType.simpleString(), have.get(field.name)))
    ddl = "table_name STRING, column_name STRING, expected STRING, actual STRING"
    return small_table(spark, ddl, bad) if bad else spark.createDataFrame([], ddl)


def relationship(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Cardinality of child -> parent: rows, orphan rows, repeated keys on both sides.

    Both sides are counted per key before they meet, so a hot key is one row in the join.
    """
    kids = child.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_kids"))
    parents = parent.groupBy(F.col(parent_key).alias("_k")).agg(F.count("*").alias("_parents"))
    both = kids.join(parents, "_k", "full")
    c = F.col
    agg = both.agg(
        F.coalesce(F.sum("_kids"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(c("_parents").isNull(), c("_kids"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(c("_kids") > 1).alias("repeated_child_keys"),
        F.count_if(c("_parents") > 1).alias("repeated_parent_keys"),
    )
    kind = (
        F.when((c("repeated_parent_keys") > 0) & (c("repeated_child_keys") > 0), "many-to-many")
        .when(c("repeated_parent_keys") > 0, "one-to-many")
        .when(c("repeated_child_keys") > 0, "many-to-one")
        .otherwise("one-to-one")
    )
    return agg.select(F.lit(name).alias("relationship"), "*", kind.alias("cardinality"))
