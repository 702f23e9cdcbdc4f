"""Touchpoints and conversions.

Both are projections with an event-name filter; Catalyst pushes the filter
through the union into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit import config as C
from touchcredit.functions import columns as fc


def touchpoints(stg: DataFrame) -> DataFrame:
    """One row per ``session_start``. ``touchpoint_us`` is the time in
    micros (arithmetic uses it); ``touchpoint_ts`` the timestamp."""
    return stg.where(F.col("event_name") == C.TOUCH_EVENT).select(
        "user_pseudo_id",
        "ga_session_id",
        F.col("event_timestamp").alias("touchpoint_us"),
        F.col("event_ts").alias("touchpoint_ts"),
        fc.source_or_default("source").alias("source"),
        fc.medium_or_default("medium").alias("medium"),
        "campaign",
        fc.channel_label("source", "medium").alias("channel"),
        F.col("event_date").alias("touch_date"),
    )


def conversions(stg: DataFrame) -> DataFrame:
    """One row per ``purchase``; the key is user + micros, not an order id."""
    return stg.where(F.col("event_name") == C.CONVERSION_EVENT).select(
        fc.conversion_id("user_pseudo_id", "event_timestamp").alias("conversion_id"),
        "user_pseudo_id",
        F.col("event_date").alias("conversion_date"),
        F.col("event_timestamp").alias("conversion_us"),
        F.col("event_ts").alias("conversion_ts"),
        "purchase_revenue",
    )
