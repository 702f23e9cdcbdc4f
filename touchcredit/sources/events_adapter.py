"""Map the given ``events`` table (event_id, ts, user_id, event_type, value,
props) onto the two feeds the pipeline reads.

Pure column expressions over a Parquet scan: no shuffle, and every filter on
``ts`` or ``event_id`` is pushed to the scan. The rule, per row, with
``k`` = the integer in ``props``:

* event_date = UTC day of ts 'yyyyMMdd'; event_timestamp = micros of ts (UTC)
* event_name from event_type (``EVENT_NAMES``); user_pseudo_id = 'user_' || user_id
* acquisition values come from a number j by arithmetic (``acquisition``): the source has 5 values and is absent where
  j % 4 = 3, the medium has 3 and is absent where j % 5 = 4, the campaign has 2 and is present where j % 3 = 1. So every
  mixture of present and absent fields occurs (a medium without source, a campaign alone, nothing)
* event_params: ga_session_id = event_id; when k is even also the values of j = k, those that are present
* traffic_source = the values of j = floor(k / 7), all NULL when k % 10 = 1
* ecommerce.purchase_revenue = value on purchases, else NULL
* feed split: event_id % 10 = 0 goes to the streaming feed, the rest to batch
* replay: rows of the stream with event_id % 20 = 0 are delivered twice in their
  own day's file and once more in the next day's file
* ingested_at = ts + k seconds
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.functions import columns as fc

# --- values of our own mapping ---------------------------------------------
# event_type -> event_name ('error' is kept on purpose: it violates the
# accepted values of the staging relation).
EVENT_NAMES = {
    "click": "session_start",
    "view": "page_view",
    "signup": "begin_checkout",
    "purchase": "purchase",
    "error": "error",
}
STREAM_MODULUS = 10   # event_id % 10 = 0 -> streaming feed
HOT_USER_ID = 999_999  # skew variant: event_id % 3 = 0 is moved to this one user
HOT_MODULUS = 3
REPLAY_MODULUS = 20   # streaming rows with event_id % 20 = 0 are replayed
# ------------------------------------------------------------------------------

FEEDS = ("all", "batch", "streaming")


# Schema of the given table, stated so the scan needs no inference job.
EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _sql_lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def acquisition(j: str) -> dict[str, str]:
    """Source, medium and campaign of the number ``j``, as SQL that Spark and the oracle's engine both read."""
    return {
        "source": f"CASE WHEN ({j}) % 4 <> 3 THEN concat('origin', ({j}) % 5) END",
        "medium": f"CASE WHEN ({j}) % 5 <> 4 THEN concat('kind', ({j}) % 3) END",
        "campaign": f"CASE WHEN ({j}) % 3 = 1 THEN concat('push', ({j}) % 2) END",
    }


# The name map as a SQL literal (one parse on the JVM instead of many Column round trips).
_EVENT_NAME_SQL = "CASE event_type " + " ".join(
    f"WHEN {_sql_lit(a)} THEN {_sql_lit(b)}" for a, b in EVENT_NAMES.items()) + " END"


def _param_sql(key: str, string_value: str = "CAST(NULL AS STRING)", int_value: str = "CAST(NULL AS BIGINT)") -> str:
    return (f"named_struct('key', '{key}', 'value', named_struct("
            f"'string_value', CAST({string_value} AS STRING), 'int_value', CAST({int_value} AS BIGINT)))")


_SID = _param_sql("ga_session_id", int_value="event_id")
_LISTED = ", ".join(f"CASE WHEN _k % 2 = 0 AND _p_{name} IS NOT NULL THEN {_param_sql(name, string_value='_p_' + name)} END"
                    for name in ("source", "medium", "campaign"))
_RAW_SQL = [
    "date_format(timestamp_micros(_us), 'yyyyMMdd') AS event_date",
    "_us AS event_timestamp",
    f"{_EVENT_NAME_SQL} AS event_name",
    "concat('user_', CAST(user_id AS STRING)) AS user_pseudo_id",
    f"array_compact(array({_SID}, {_LISTED})) AS event_params",
    """named_struct('source', CASE WHEN _k % 10 <> 1 THEN _t_source END, 'medium', CASE WHEN _k % 10 <> 1 THEN _t_medium END,
                    'name', CASE WHEN _k % 10 <> 1 THEN _t_campaign END) AS traffic_source""",
    "named_struct('purchase_revenue', CASE WHEN event_type = 'purchase' THEN CAST(value AS DOUBLE) END) AS ecommerce",
]


def with_hot_user(events: DataFrame) -> DataFrame:
    """Skew variant of the given table: every third event (event_id % 3 = 0)
    belongs to one user, so one key holds a third of all rows."""
    return events.withColumn(
        "user_id", F.when(F.col("event_id") % HOT_MODULUS == 0, F.lit(HOT_USER_ID).cast("bigint"))
        .otherwise(F.col("user_id")))


def restrict_days(events: DataFrame, lo: str, hi: str) -> DataFrame:
    """Keep events whose UTC day is in ``[lo, hi]`` ('yyyyMMdd'), as a range
    on ``ts`` the Parquet reader can use (event_date is derived from ts)."""
    start = f"{lo[:4]}-{lo[4:6]}-{lo[6:]} 00:00:00"
    end = f"{hi[:4]}-{hi[4:6]}-{hi[6:]} 00:00:00"
    return events.where(f"ts >= TIMESTAMP_NTZ'{start}' AND ts < TIMESTAMP_NTZ'{end}' + INTERVAL 1 DAY")


def _feed_filter(events: DataFrame, feed: str) -> DataFrame:
    if feed == "all":
        return events
    if feed == "batch":
        return events.where(f"event_id % {STREAM_MODULUS} <> 0")
    if feed == "streaming":
        return events.where(f"event_id % {STREAM_MODULUS} = 0")
    raise ValueError(f"feed must be one of {FEEDS}")


def _raw_with(events: DataFrame, feed: str, extra: list[str]) -> DataFrame:
    b = _feed_filter(events, feed).selectExpr(
        "event_id", "user_id", "event_type", "value",
        "CAST(get_json_object(props, '$.k') AS INT) AS _k",
        "unix_micros(CAST(ts AS TIMESTAMP)) AS _us",
    ).selectExpr(
        "*",
        *(f"{sql} AS _p_{name}" for name, sql in acquisition("_k").items()),
        *(f"{sql} AS _t_{name}" for name, sql in acquisition("_k DIV 7").items()),
    )
    return b.selectExpr(*_RAW_SQL, *extra)


def raw_batch(events: DataFrame, feed: str = "all") -> DataFrame:
    """Nested raw batch frame with the ``RAW_BATCH`` schema."""
    return _raw_with(events, feed, [])


def stream_rows(events: DataFrame, feed: str = "all") -> DataFrame:
    """Events as flat stream rows (one per event, before replay): all of
    them, or the ``streaming`` part of the feed split.

    Acquisition fields are the values the batch path derives (param, else
    traffic source), so the two feeds together equal the whole table.
    """
    from touchcredit.operators.staging import flatten_batch  # avoid an import cycle

    raw = _raw_with(events, feed,
                    ["timestamp_micros(_us + CAST(_k AS BIGINT) * 1000000) AS ingested_at"])
    flat = flatten_batch(raw, keep=["ingested_at"])
    out = flat.select(
        fc.event_key().alias("event_id"),
        "event_date", "event_timestamp", "event_name", "user_pseudo_id", "ga_session_id",
        "source", "medium", "campaign", "purchase_revenue", "ingested_at",
    )
    return out


def stream_deliveries(events: DataFrame, feed: str = "all") -> DataFrame:
    """Every delivery of the stream (of all events, or of the ``streaming`` part), with the file (``batch_id``,
    a day 'yyyyMMdd') it arrives in: each row once in its own day's file,
    rows with event_id % 20 = 0 a second time in the same file and a third
    time in the next day's file. ``copy`` numbers the deliveries 0..2."""
    rows = stream_rows(events, feed)
    replay = (F.col("ga_session_id") % REPLAY_MODULUS) == 0
    copies = F.when(replay, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    d = rows.withColumn("copy", F.explode(copies))
    day = F.to_date(F.col("event_date"), "yyyyMMdd")
    batch_day = F.when(F.col("copy") == 2, F.date_add(day, 1)).otherwise(day)
    return d.withColumn("batch_id", F.date_format(batch_day, "yyyyMMdd"))
