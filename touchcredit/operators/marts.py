"""Daily channel mart (A1, U2) and mart materialization."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAILY_KEYS = ["attribution_model", "conversion_date", "attributed_channel"]


def channel_daily(credited: DataFrame) -> DataFrame:
    """By model x day x channel: ``count(*)``, ``round(sum(revenue), 2)``.

    ``credited`` holds both models (the union of the two marts). Partial
    aggregation runs before the shuffle, so only one row per key and map
    task crosses the network.
    """
    return credited.groupBy(*DAILY_KEYS).agg(
        F.count(F.lit(1)).alias("conversions"),
        F.round(F.sum("purchase_revenue"), 2).alias("revenue"),
    )


def union_marts(first: DataFrame, last: DataFrame) -> DataFrame:
    """``first UNION ALL last`` by column name."""
    return first.unionByName(last)


def write_mart(df: DataFrame, path: str, partition_by: list[str] | None = None,
               sort_within: list[str] | None = None) -> None:
    """Drop-and-recreate materialization; ``sortWithinPartitions`` keeps
    files ordered for readers without a global sort."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
