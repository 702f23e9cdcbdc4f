"""Explicit schemas: no inference anywhere."""

from pyspark.sql import types as T

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
])

EVENT_PARAM = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", PARAM_VALUE),
])

TRAFFIC_SOURCE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("medium", T.StringType()),
    T.StructField("name", T.StringType()),
])

ECOMMERCE = T.StructType([T.StructField("purchase_revenue", T.DoubleType())])

# Raw batch export, one row per event, nested; stored partitioned by event_date.
RAW_BATCH = T.StructType([
    T.StructField("event_date", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
    T.StructField("traffic_source", TRAFFIC_SOURCE),
    T.StructField("ecommerce", ECOMMERCE),
])

# Flat streaming event (the streaming table and the stream source).
STREAM_FLAT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("ga_session_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("medium", T.StringType()),
    T.StructField("campaign", T.StringType()),
    T.StructField("purchase_revenue", T.DoubleType()),
    T.StructField("ingested_at", T.TimestampType()),
])

# Flat CSV export: every field read as text, integer casts done explicitly.
CSV_FLAT_TEXT = T.StructType([
    T.StructField("event_date", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("ga_session_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("medium", T.StringType()),
    T.StructField("campaign", T.StringType()),
    T.StructField("purchase_revenue", T.StringType()),
])
CSV_COLUMNS = [f.name for f in CSV_FLAT_TEXT.fields]

STG_COLUMNS = [
    "event_date", "event_timestamp", "event_ts", "event_name", "user_pseudo_id",
    "ga_session_id", "source", "medium", "campaign", "purchase_revenue", "_source",
]
