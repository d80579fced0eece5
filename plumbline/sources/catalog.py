"""Slowly changing item properties reduced to the current category per item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_values(props: DataFrame, name: str) -> DataFrame:
    """Most recent value of one property per item.

    Equal timestamps are settled by the larger value, so the result does not depend
    on file order. Only rows of the property are scanned (the filter is pushed down). The
    history is first reduced to the latest time of each value, by a hash aggregation with the
    value in the key (a maximum of texts would sort all raw rows), and then to one value.
    """
    return (
        props.filter(F.col("property") == name)
        .groupBy("itemid", "value").agg(F.max("timestamp").alias("timestamp"))
        .groupBy("itemid")
        .agg(F.max_by("value", F.struct("timestamp", "value")).alias("value"))
    )


def item_catalog(props: DataFrame, name: str = "categoryid") -> DataFrame:
    """(itemid, categoryid); when the property never occurs, every item with no category."""
    if props.filter(F.col("property") == name).isEmpty():
        return props.select("itemid").distinct().withColumn("categoryid", F.lit(None).cast("double"))
    return latest_values(props, name).select("itemid", F.col("value").try_cast("double").alias("categoryid"))
