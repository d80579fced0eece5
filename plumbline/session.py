"""Session defaults and the shared working folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


SHUFFLE_BYTES = 256 * 1024 * 1024  # aimed size of one shuffle partition


def build_session(master: str | None = None, app: str = "plumbline", input_tb: float | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC.

    ``input_tb`` sizes the shuffles for the data at hand: enough initial partitions that
    one fits in memory even if a stage shuffles all of it; adaptive execution merges the
    ones that turn out small. Further settings are given as ``spark__sql__name=value``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # do not record a Python call site per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if input_tb:
        initial = max(200, math.ceil(input_tb * 2**40 / SHUFFLE_BYTES))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", initial).config(
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLE_BYTES)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is missing (a local run) a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="plumbline-")
        return os.path.join(base, purpose)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df, purpose: str):
    """Write an intermediate table once to the shared folder and read it back.

    Cuts lineage at a reuse point; the written files survive the loss of executors.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
