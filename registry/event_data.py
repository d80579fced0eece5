"""Event bindings: the test tables seen as an event table with known defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.checks import EventRules

from .core import table


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def dirty_rules() -> EventRules:
    return EventRules(
        window_start=_moment("2024-01-01 00:00:00"), window_end=_moment("2024-01-30 23:59:59"), time="ts", tie="event_id")


def dirty_events(spark: SparkSession, sf: str, keep=()) -> DataFrame:
    """All events with defects that depend on ``event_id`` only, plus repeated rows.

    Copies come from ``explode`` so that the source is scanned once. ``keep`` adds columns
    of the clean events.
    """
    e = table(spark, sf, "events")
    i, kind = F.col("event_id"), F.col("event_type")
    event = (
        F.when(i % 333 == 0, None).when(kind == "click", "addtocart").when(kind == "purchase", "transaction").otherwise(kind))
    txn = (
        F.when((kind == "purchase") & (i % 50 != 0), F.concat(F.lit("T"), (i - i % 3).cast("string")))
        .when((kind == "view") & (i % 400 == 1), "FAKE"))
    rows = e.select(
        *keep, i,
        F.when(i % 500 == 7, _moment("2000-01-01 00:00:00")).otherwise(F.col("ts")).alias("ts"),
        F.when(i % 200 == 0, None).otherwise(F.col("user_id")).alias("visitorid"),
        event.alias("event"),
        F.when(i % 150 == 0, None).otherwise(F.get_json_object("props", "$.k").cast("bigint")).alias("itemid"),
        txn.alias("transactionid"),
    )
    copies = F.when(i % 250 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy")


def item_catalog(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.filter(F.col("p_partkey") % 10 != 7).select(F.col("p_partkey").alias("itemid"), F.col("p_size").alias("categoryid"))


def category_tree(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.filter(F.col("p_size") <= 45).select(F.col("p_size").alias("categoryid")).distinct()


CTES = {
    "b": """SELECT event_id,
    CASE WHEN event_id % 500 = 7 THEN TIMESTAMP '2000-01-01' ELSE ts END AS ts,
    CASE WHEN event_id % 200 = 0 THEN NULL ELSE user_id END AS visitorid,
    CASE WHEN event_id % 333 = 0 THEN NULL
         WHEN event_type = 'click' THEN 'addtocart'
         WHEN event_type = 'purchase' THEN 'transaction'
         ELSE event_type END AS event,
    CASE WHEN event_id % 150 = 0 THEN NULL
         ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS itemid,
    CASE WHEN event_type = 'purchase' AND event_id % 50 <> 0
              THEN 'T' || CAST(event_id - event_id % 3 AS VARCHAR)
         WHEN event_type = 'view' AND event_id % 400 = 1 THEN 'FAKE' END AS transactionid
  FROM events""",
    "ev": "SELECT * FROM b UNION ALL SELECT * FROM b WHERE event_id % 250 = 3",
    "items": "SELECT p_partkey AS itemid, p_size AS categoryid FROM part WHERE p_partkey % 10 <> 7",
    "cats": "SELECT DISTINCT p_size AS categoryid FROM part WHERE p_size <= 45",
}
