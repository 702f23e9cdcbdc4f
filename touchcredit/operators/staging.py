"""Staging relation ``stg_events``.

One flat row per event from the nested batch export, unioned with the flat
streaming table. No dedupe across the feeds: an event present in both is
present twice (the conversion key then collides and the quality checks
report it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit import config as C
from touchcredit.functions import columns as fc
from touchcredit.functions import params as fp
from touchcredit.sources.schemas import STG_COLUMNS


def flatten_batch(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Nested raw export -> flat staging rows.

    Acquisition fields fall back to ``traffic_source`` per field
    independently: source may come from the params and medium from the
    traffic source of the same row.
    """
    keep = keep or []
    return raw.select(
        "event_date",
        "event_timestamp",
        fc.micros_to_ts("event_timestamp").alias("event_ts"),
        "event_name",
        "user_pseudo_id",
        fp.param_int("ga_session_id").alias("ga_session_id"),
        F.coalesce(fp.param_str("source"), F.col("traffic_source.source")).alias("source"),
        F.coalesce(fp.param_str("medium"), F.col("traffic_source.medium")).alias("medium"),
        F.coalesce(fp.param_str("campaign"), F.col("traffic_source.name")).alias("campaign"),
        F.col("ecommerce.purchase_revenue").cast("double").alias("purchase_revenue"),
        F.lit(C.BATCH_TAG).alias("_source"),
        *keep,
    )


def flatten_stream(stream_table: DataFrame) -> DataFrame:
    """Flat streaming table -> staging rows (columns passed through;
    ``event_id`` and ``ingested_at`` are not carried)."""
    return stream_table.select(
        "event_date",
        "event_timestamp",
        fc.micros_to_ts("event_timestamp").alias("event_ts"),
        "event_name",
        "user_pseudo_id",
        F.col("ga_session_id").cast("bigint").alias("ga_session_id"),
        "source",
        "medium",
        "campaign",
        F.col("purchase_revenue").cast("double").alias("purchase_revenue"),
        F.lit(C.STREAM_TAG).alias("_source"),
    )


def stg_events(batch_raw: DataFrame, stream_table: DataFrame | None = None) -> DataFrame:
    """``batch UNION ALL streaming``."""
    out = flatten_batch(batch_raw)
    if stream_table is not None:
        out = out.unionByName(flatten_stream(stream_table))
    return out.select(*STG_COLUMNS)


def param_lookup(batch_raw: DataFrame) -> DataFrame:
    """P1/P2 alone: the raw param values, before any fallback, with the
    repeated-key flags (§ trap: several matches of one key)."""
    keys = ("source", "medium", "campaign")
    return batch_raw.select(
        "event_timestamp",
        "user_pseudo_id",
        fp.param_int("ga_session_id").alias("ga_session_id"),
        *[fp.param_str(k).alias(f"param_{k}") for k in keys],
        F.size(F.coalesce(F.col("event_params"), F.array())).alias("n_params"),
        (fp.repeated_key("ga_session_id") | fp.repeated_key("source")
         | fp.repeated_key("medium") | fp.repeated_key("campaign")).alias("has_repeated_key"),
    )


def source_fallback(batch_raw: DataFrame) -> DataFrame:
    """Where each acquisition field came from ('param', 'traffic'
    or NULL when neither has it)."""
    out = []
    for field, tf in (("source", "source"), ("medium", "medium"), ("campaign", "name")):
        p = fp.param_str(field)
        t = F.col(f"traffic_source.{tf}")
        out.append(F.coalesce(p, t).alias(field))
        out.append(F.when(p.isNotNull(), F.lit("param")).when(t.isNotNull(), F.lit("traffic")).alias(f"{field}_from"))
    return batch_raw.select(
        "event_timestamp",
        "user_pseudo_id",
        fp.param_int("ga_session_id").alias("ga_session_id"),
        *out,
    )
