"""Downstream refresh (X3) and near-real-time credit.

X3: after the stream is merged, rebuild the marts in batch from the export
and the streaming table; the result is written (lineage cut) and the
reports read the written tables.

X6: in the same ``foreachBatch`` as the idempotent merge, credit with the
as-of operator what the target holds for the micro-batch's keys: its
conversions, and every known conversion that its touchpoints can change
(same user, conversion within the lookback after the touchpoint), orphans
included, so a touchpoint that arrives late still wins the conversions it
should. A copy that the merge skipped changes nothing. Only what can matter is
read: the time range (by UTC day, never by the day that the producer states,
which follows its own zone) and the users involved. Credits are
appended as versions, numbered on from what the table holds for those days,
so that a new checkpoint goes on where the last ended, and read through
``latest_credits``; rows equal to the current credit are skipped, so a retried
batch adds nothing. No watermark is needed and no event is dropped for
lateness.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchcredit import config as C
from touchcredit.config import AttributionConfig
from touchcredit.functions import columns as fc
from touchcredit.operators import credit as cr
from touchcredit.operators import journeys, marts, staging
from touchcredit.session import cut_lineage
from touchcredit.streaming import compact, ingest

LIVE_COLUMNS = cr.MART_COLUMNS + ["touchpoint_us"]
CREDIT_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in (
    ("conversion_id", T.StringType()), ("conversion_date", T.StringType()), ("purchase_revenue", T.DoubleType()),
    ("attributed_channel", T.StringType()), ("attribution_model", T.StringType()),
    ("touchpoint_us", T.LongType()), ("version", T.LongType()), ("credit_day", T.StringType()))])


def refresh_marts(batch_raw: DataFrame, stream_table: DataFrame | None, out_dir: str,
                  config: AttributionConfig = AttributionConfig()) -> dict[str, str]:
    """X3 + S7: rebuild and overwrite the credit relation and the daily
    mart. The daily mart is computed from the written credit relation."""
    spark = batch_raw.sparkSession
    stg = staging.stg_events(batch_raw, stream_table)
    credited = cr.credit(journeys.touchpoints(stg), journeys.conversions(stg), config.lookback_us,
                         chunk_us=config.chunk_us)
    paths = {"attribution": f"{out_dir}/attribution", "channel_daily": f"{out_dir}/mart_channel_daily"}
    marts.write_mart(credited.select(*LIVE_COLUMNS), paths["attribution"], partition_by=["attribution_model"])
    written = spark.read.parquet(paths["attribution"])
    marts.write_mart(marts.channel_daily(written), paths["channel_daily"],
                     partition_by=["attribution_model"],
                     sort_within=["conversion_date", "attributed_channel"])
    return paths


def _spread(days: set[str], before_us: int = 0, after_us: int = 0) -> list[str]:
    """``days`` and those from ``before_us`` earlier to ``after_us`` later: a set, so that one odd time in a batch adds
    its own neighbourhood and not all history up to it."""
    back, ahead = (-(-us // C.MICROS_PER_DAY) for us in (before_us, after_us))
    out = set()
    for d in days:
        day = _dt.date(int(d[:4]), int(d[4:6]), int(d[6:]))
        for k in range(-back, ahead + 1):
            try:
                out.add((day + _dt.timedelta(days=k)).isoformat().replace("-", ""))
            except OverflowError:  # beyond the calendar
                pass
    return sorted(out)


def _of_days(table: DataFrame, time: str, day: str, days: list[str]) -> DataFrame:
    """Rows whose ``time`` (micros) lies in ``days``; pruned by ``day``, its UTC day, where the table is stored by it."""
    return table.where((F.col(day) if day in table.columns else fc.micros_to_day(time)).isin(days))


def _latest(rows: DataFrame) -> DataFrame:
    best = F.max(F.struct("version", *LIVE_COLUMNS)).alias("_b")
    return rows.groupBy("conversion_id", "attribution_model").agg(best) \
        .select(*[F.col(f"_b.{c}").alias(c) for c in LIVE_COLUMNS])


def latest_credits(credit_path: str, spark: SparkSession) -> DataFrame:
    """The live credit view: for each (conversion, model) the row of the
    highest version (partial aggregate, so a much re-credited conversion
    never gathers in one task)."""
    return _latest(ingest.stored(spark, credit_path, CREDIT_SCHEMA))


def credit_micro_batch(spark: SparkSession, batch_rows: DataFrame, touch_table: DataFrame,
                       conv_table: DataFrame, target_path: str, credit_path: str,
                       config: AttributionConfig, version: int = 0, orphan_path: str | None = None,
                       daily_path: str | None = None) -> int:
    """Credit one merged micro-batch; return how many credit rows were appended.

    ``batch_rows`` are the target's rows for the batch's keys (``ingest.held_rows``).
    Probes: their conversions, plus every known conversion that their touchpoints
    can change (same user, on the days from the touchpoint's to a lookback later),
    including earlier orphans. Known conversions come from ``conv_table`` (the
    batch feed; stored by ``conversion_day``) and the stream table;
    touchpoints from ``touch_table`` (stored by ``touch_day``) and the stream
    table. Every read is pruned to the UTC days and the time range, and
    semi-joined to the users involved. Results are appended with a version above those
    of the same days, at least ``version``, stored by the UTC day of the conversion; rows equal to the latest
    known credit are skipped, so a retried batch appends nothing. With ``orphan_path`` the probes' orphan status is
    logged (``log_orphans``), with ``daily_path`` the daily mart is brought up to date (``refresh_days``)."""
    L = config.lookback_us
    flat = staging.flatten_stream(batch_rows)
    new_conv = journeys.conversions(flat)
    new_touch = journeys.touchpoints(flat)
    kinds = (C.CONVERSION_EVENT, C.TOUCH_EVENT)
    seen = flat.where(F.col("event_name").isin(*kinds) & F.col("event_timestamp").isNotNull()) \
        .select("event_name", fc.micros_to_day("event_timestamp").alias("day")).distinct().collect()
    conv_days, touch_days = ({r["day"] for r in seen if r["event_name"] == kind and len(r["day"]) == 8} for kind in kinds)
    if not conv_days and not touch_days:
        return 0
    stream = ingest.stored(spark, target_path, ingest.TARGET_SCHEMA)

    def streamed(days: list[str]) -> DataFrame:
        return staging.flatten_stream(_of_days(stream, "event_timestamp", "event_day", days).select(*ingest.FLAT_COLUMNS))

    cols = ["conversion_id", "user_pseudo_id", "conversion_date", "conversion_us", "purchase_revenue"]
    probes = new_conv.select(*cols)
    affected = _spread(touch_days, after_us=L)
    if touch_days:
        users = new_touch.select("user_pseudo_id").distinct()
        known = (_of_days(conv_table, "conversion_us", "conversion_day", affected).select(*cols)
                 .unionByName(journeys.conversions(streamed(affected)).select(*cols))
                 .join(users, "user_pseudo_id", "left_semi"))
        probes = probes.unionByName(known)
    probe_days = sorted(conv_days | set(affected))
    users = probes.select("user_pseudo_id").distinct()
    need = ["user_pseudo_id", "ga_session_id", "touchpoint_us", "channel"]
    before = _spread(set(probe_days), before_us=L)
    touch = (_of_days(touch_table, "touchpoint_us", "touch_day", before).select(*need)
             .unionByName(journeys.touchpoints(streamed(before)).select(*need))
             .join(users, "user_pseudo_id", "left_semi"))
    new = cr.credit(touch, probes, L, chunk_us=config.chunk_us) \
        .select(*LIVE_COLUMNS, fc.micros_to_day("conversion_us").alias("credit_day"))
    if orphan_path:
        new = cut_lineage(new, "micro_batch_credit")
        log_orphans(spark, probes, new, orphan_path, probe_days)
    held = ingest.stored(spark, credit_path, CREDIT_SCHEMA).where(F.col("credit_day").isin(probe_days))
    last = held.agg(F.max("version")).first()[0]
    if last is not None:
        current = _latest(held.join(probes.select("conversion_id").distinct(), "conversion_id", "left_semi"))
        # unchanged: nothing to add; a missing revenue equals a missing revenue
        old = current.toDF(*[f"_{c}" for c in LIVE_COLUMNS])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LIVE_COLUMNS if c not in ("conversion_id", "attribution_model")]
        key = [F.col(c) == F.col(f"_{c}") for c in ("conversion_id", "attribution_model")]
        new = new.join(old, key + same, "left_anti")
        version = max(version, last + 1)
    new = new.withColumn("version", F.lit(int(version)).cast("bigint")).persist()
    n = new.count()
    if n:
        new.write.mode("append").partitionBy("credit_day").parquet(credit_path)
    new.unpersist()
    if daily_path:
        # also when nothing is new: a retry after a crash between both writes
        refresh_days(spark, credit_path, daily_path, probe_days)
    return n


def compact_credits(spark: SparkSession, credit_path: str, **sizes: int) -> dict[str, int]:
    """Few files a day, and of each (conversion, model) the row of the highest version alone; ``latest_credits``, and
    the version a later micro-batch goes on from, stay as they are."""
    def newest(rows: DataFrame) -> DataFrame:
        best = F.max(F.struct("version", *LIVE_COLUMNS)).alias("_b")
        return rows.groupBy("credit_day", "conversion_id", "attribution_model").agg(best) \
            .select("credit_day", "_b.version", *[F.col(f"_b.{c}").alias(c) for c in LIVE_COLUMNS])

    return compact.compact(spark, credit_path, CREDIT_SCHEMA, "credit_day", "conversion_id", keep=newest, **sizes)


# ---- orphans as the stream goes (Q4 + X6) ----------------------------------------------------------

ORPHAN_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in (
    ("conversion_id", T.StringType()), ("conversion_date", T.StringType()), ("conversion_us", T.LongType()),
    ("orphan", T.BooleanType()), ("version", T.LongType()), ("conversion_day", T.StringType()))])


def _last_status(rows: DataFrame) -> DataFrame:
    best = F.max(F.struct("version", "conversion_date", "conversion_us", "orphan")).alias("_b")
    return rows.groupBy("conversion_id").agg(best).select(
        "conversion_id", *[F.col(f"_b.{c}").alias(c) for c in ("conversion_date", "conversion_us", "orphan")])


def log_orphans(spark: SparkSession, probes: DataFrame, credited: DataFrame, orphan_path: str, days: list[str]) -> int:
    """Append how the probes' status changed: a conversion without credit becomes an orphan, and is withdrawn (a row
    with ``orphan`` false) when a late touchpoint credits it. A status that is as known is skipped, so a retried
    batch adds nothing. Reads the log of the probes' days only; returns the number of rows added."""
    given = probes.where("conversion_id is not null").groupBy("conversion_id").agg(
        F.max("conversion_date").alias("conversion_date"), F.max("conversion_us").alias("conversion_us"))
    hit = credited.select("conversion_id", F.lit(False).alias("_no")).distinct()
    now = given.join(hit, "conversion_id", "left").select(
        *given.columns, F.coalesce("_no", F.lit(True)).alias("orphan"), fc.micros_to_day("conversion_us").alias("conversion_day"))
    held = ingest.stored(spark, orphan_path, ORPHAN_SCHEMA).where(F.col("conversion_day").isin(days))
    last = held.agg(F.max("version")).first()[0]
    old = _last_status(held).select("conversion_id", F.col("orphan").alias("_was"))
    # never logged and credited: nothing to say
    changed = now.join(old, "conversion_id", "left").where(F.col("orphan") != F.coalesce("_was", F.lit(False))).drop("_was")
    changed = changed.withColumn("version", F.lit(0 if last is None else last + 1).cast("bigint")).persist()
    n = changed.count()
    if n:
        changed.write.mode("append").partitionBy("conversion_day").parquet(orphan_path)
    changed.unpersist()
    return n


def live_orphans(orphan_path: str, spark: SparkSession) -> DataFrame:
    """conversion_id, conversion_date of the conversions that have no credit as of the last micro-batch."""
    return _last_status(ingest.stored(spark, orphan_path, ORPHAN_SCHEMA)).where("orphan") \
        .select("conversion_id", "conversion_date")


# ---- the daily mart as the stream goes (A1 + X3) -------------------------------------------------------

DAILY_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in (
    ("attribution_model", T.StringType()), ("conversion_date", T.StringType()), ("attributed_channel", T.StringType()),
    ("conversions", T.LongType()), ("revenue", T.DoubleType()), ("credit_day", T.StringType()))])


def refresh_days(spark: SparkSession, credit_path: str, daily_path: str, days: list[str]) -> None:
    """Rewrite the daily mart's rows of ``days`` (UTC days of conversions) from the latest credits of those days.

    The mart is stored by that day; other days are neither read nor written. The rows of a day come from the credit
    versions alone (old rows replaced by new ones), never from the mart itself, so a retry gives the same.
    One day's rows may carry several stated dates; readers fold them (``live_daily``)."""
    rows = ingest.stored(spark, credit_path, CREDIT_SCHEMA).where(F.col("credit_day").isin(days))
    best = F.max(F.struct("version", *LIVE_COLUMNS)).alias("_b")
    latest = rows.groupBy("credit_day", "conversion_id", "attribution_model").agg(best) \
        .select("credit_day", *[F.col(f"_b.{c}").alias(c) for c in LIVE_COLUMNS])
    daily = latest.groupBy("credit_day", *marts.DAILY_KEYS).agg(
        F.count(F.lit(1)).alias("conversions"), F.sum("purchase_revenue").alias("revenue"))
    daily.select(*[f.name for f in DAILY_SCHEMA]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("credit_day").parquet(daily_path)


def live_daily(daily_path: str, spark: SparkSession) -> DataFrame:
    """The daily mart (A1) as of the last micro-batch."""
    return ingest.stored(spark, daily_path, DAILY_SCHEMA).groupBy(*marts.DAILY_KEYS).agg(
        F.sum("conversions").alias("conversions"), F.round(F.sum("revenue"), 2).alias("revenue"))


def start_live_credit(source: DataFrame, touch_table: DataFrame, conv_table: DataFrame, target_path: str,
                      credit_path: str, checkpoint_path: str, config: AttributionConfig = AttributionConfig(),
                      trigger: dict | None = None, orphan_path: str | None = None, daily_path: str | None = None):
    """X1 + X6 in one ``foreachBatch``: merge, then credit the batch (its
    conversions and the known conversions its touchpoints affect). Read the
    result with ``latest_credits``."""

    def _sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        ingest.batch_jobs_adaptive(df)
        df = df.persist()
        try:
            ingest.merge_batch(df, target_path)
            held = ingest.held_rows(spark, df, target_path).persist()
            credit_micro_batch(spark, held, touch_table, conv_table, target_path, credit_path, config,
                               orphan_path=orphan_path, daily_path=daily_path)
            held.unpersist()
        finally:
            df.unpersist()

    w = source.writeStream.foreachBatch(_sink).option("checkpointLocation", checkpoint_path)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()

