"""Named queries over the given tables: ``name -> f(spark, sf_dir)``.

Every query reads the given ``events`` table in full (or the trailing window
the query is about) and returns a lazy DataFrame. Timestamps leave as bigint
micros or text, counts as bigint, revenue as double rounded to 2 dp.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit import config as C
from touchcredit.config import AttributionConfig
from touchcredit.functions import columns as fc
from touchcredit.operators import credit as cr
from touchcredit.operators import journeys
from touchcredit.operators import marts as mt
from touchcredit.operators import quality as dq
from touchcredit.operators import reports as rp
from touchcredit.operators import staging
from touchcredit.plans.pipeline import AS_OF, Inputs, Pipeline, driver_inputs
from touchcredit.session import cut_lineage, ensure_utc, shared_dir
from touchcredit.sources import batch as batch_src
from touchcredit.sources import csv_flat
from touchcredit.sources import events_adapter as ea
from touchcredit.sources import published
from touchcredit.streaming import compact, ingest, live
from touchcredit.streaming.source import flat_event_stream, write_delivery_files

Query = Callable[[SparkSession, str], DataFrame]

AS_OF_US = 1_706_659_200_000_000  # 2024-01-31 00:00:00 UTC in micros

STG_OUT = ["event_date", "event_timestamp", "event_name", "user_pseudo_id", "ga_session_id",
           "source", "medium", "campaign", "purchase_revenue", "_source"]
TOUCH_OUT = ["user_pseudo_id", "ga_session_id", "touchpoint_us", "source", "medium",
             "campaign", "channel"]
CONV_OUT = ["conversion_id", "user_pseudo_id", "conversion_date", "conversion_us",
            "purchase_revenue"]


def pipeline(spark: SparkSession, sf_dir: str, lookback_days: int = C.DEFAULT_LOOKBACK_DAYS,
             split_feeds: bool = False, batch_window_days: int | None = None,
             chunk_us: int | None = None, hot_user: bool = False) -> Pipeline:
    cfg = AttributionConfig(lookback_days=lookback_days, as_of=AS_OF,
                            batch_window_days=batch_window_days)
    if chunk_us is not None:
        cfg = dataclasses.replace(cfg, chunk_us=chunk_us)
    return Pipeline(driver_inputs(spark, sf_dir, split_feeds=split_feeds,
                                  batch_window_days=batch_window_days, hot_user=hot_user), cfg)


# --- staging and journeys --------------------------------------------------------

def _staged(p: Pipeline) -> DataFrame:
    return p.stg.select(*STG_OUT, F.date_format("event_ts", rp.ISO_MICROS).alias("event_ts"))


def q_stg_events(spark, sf_dir):
    return _staged(pipeline(spark, sf_dir))


def q_stg_param_lookup(spark, sf_dir):
    return staging.param_lookup(driver_inputs(spark, sf_dir).batch_raw)


def q_stg_source_fallback(spark, sf_dir):
    return staging.source_fallback(driver_inputs(spark, sf_dir).batch_raw)


def q_stg_batch_window(spark, sf_dir):
    """S1 with a 14-day trailing window up to ``as_of`` (prunes days)."""
    return _staged(pipeline(spark, sf_dir, batch_window_days=14))


def q_stg_export_trailing(spark, sf_dir):
    """Every event written as the day-partitioned nested export, of which the 14 days before the newest one and that
    one are read back; the days are known only when the query runs."""
    ensure_utc(spark)
    path = shared_dir(spark, "touchcredit", f"export-{uuid.uuid4().hex[:12]}")
    batch_src.write_export(ea.raw_batch(ea.load_events(spark, sf_dir)), path)
    batch_src.write_days(spark, path)
    return _staged(Pipeline(Inputs(batch_src.read_trailing(spark, path, 14))))


def q_touchpoints(spark, sf_dir):
    return pipeline(spark, sf_dir).touchpoints.select(*TOUCH_OUT)


def q_conversions(spark, sf_dir):
    return pipeline(spark, sf_dir).conversions.select(*CONV_OUT)


# --- attribution -----------------------------------------------------------------

def _attribution(model: str, days: int, chunk_us: int | None = None) -> Query:
    def q(spark, sf_dir):
        p = pipeline(spark, sf_dir, lookback_days=days, chunk_us=chunk_us)
        return cr.credit_events(p.stg, p.config.lookback_us,
                                chunk_us=p.config.chunk_us, models=(model,)).select(*cr.MART_COLUMNS)
    return q


def q_attribution_split_hot_7d(spark, sf_dir):
    """Both models, 7 days, with two levels of chunks, minutes split into
    seconds: must equal the plain credit."""
    p = pipeline(spark, sf_dir, lookback_days=7)
    return cr.credit(p.touchpoints, p.conversions, p.config.lookback_us, chunk_us=p.config.chunk_us,
                     fine_us=1_000_000).select(*cr.MART_COLUMNS)


def q_channel_daily_hot_user(spark, sf_dir):
    """Skew case: a third of all events belong to one user."""
    return pipeline(spark, sf_dir, hot_user=True).channel_daily


def q_attribution_last_click_30d_hot_user(spark, sf_dir):
    p = pipeline(spark, sf_dir, hot_user=True)
    return cr.credit_events(p.stg, p.config.lookback_us, chunk_us=p.config.chunk_us,
                            models=(C.LAST_CLICK,)).select(*cr.MART_COLUMNS)


def _channel_daily(days: int) -> Query:
    def q(spark, sf_dir):
        return pipeline(spark, sf_dir, lookback_days=days).channel_daily
    return q


# --- reports -----------------------------------------------------------------

def q_model_totals(spark, sf_dir):
    return rp.model_totals(pipeline(spark, sf_dir).credited)


def q_channel_breakdown(spark, sf_dir):
    return rp.ordered_breakdown(rp.channel_breakdown(pipeline(spark, sf_dir).credited))


def q_channel_compare(spark, sf_dir):
    return rp.channel_compare(pipeline(spark, sf_dir).credited) \
        .orderBy(F.col("lc_revenue").desc(), "attributed_channel")


def q_channel_scaled(spark, sf_dir):
    return rp.channel_scaled(rp.channel_compare(pipeline(spark, sf_dir).credited))


def q_trend_14(spark, sf_dir):
    return rp.trend(pipeline(spark, sf_dir).channel_daily, 14)


def q_model_disagreement(spark, sf_dir):
    return rp.model_disagreement(pipeline(spark, sf_dir).credited)


def q_model_disagreement_sample(spark, sf_dir):
    return rp.disagreement_sample(rp.model_disagreement(pipeline(spark, sf_dir).credited), 5)


def q_last_click_breakdown(spark, sf_dir):
    """Q8 part: the last-click channel breakdown, revenue descending."""
    b = rp.channel_breakdown(pipeline(spark, sf_dir).credited)
    return b.where(F.col("attribution_model") == C.LAST_CLICK) \
        .select("attributed_channel", "conversions", "revenue") \
        .orderBy(F.col("revenue").desc_nulls_last(), "attributed_channel")


def q_channel_daily_ordered(spark, sf_dir):
    """T5: the mart in presentation order (date, model, channel)."""
    return rp.ordered_daily(pipeline(spark, sf_dir).channel_daily)


def q_report_bundle(spark, sf_dir):
    """The report written as a dataset of JSON lines and read back."""
    p = pipeline(spark, sf_dir).with_written_credit()
    live = rp.latest_events(_stream_table(spark, sf_dir), 20)
    path = shared_dir(spark, "touchcredit", f"report-{uuid.uuid4().hex[:12]}")
    rp.write_report(rp.report_lines(rp.model_totals(p.credited), rp.channel_breakdown(p.credited), p.channel_daily,
                                    rp.trend(p.channel_daily, 14), live, generated_at=AS_OF.isoformat()), path)
    # counters are absent from some sections: as doubles, a null means the same to every reader of the result
    return rp.read_report(spark, path).withColumns({c: F.col(c).cast("double") for c in (
        "conversions", "first_click", "last_click", "chart_max")})


# --- stream ---------------------------------------------------------------------

def _deliveries(spark, sf_dir, feed: str = "all") -> DataFrame:
    """Every event as a stream delivery, with replays; or the streaming part of the feed split."""
    ensure_utc(spark)
    return ea.stream_deliveries(ea.load_events(spark, sf_dir), feed)


def _stream_table(spark, sf_dir) -> DataFrame:
    return ingest.dedupe_deliveries(_deliveries(spark, sf_dir))


def q_stream_dedupe(spark, sf_dir):
    t = _stream_table(spark, sf_dir)
    return t.withColumn("ingested_at", F.date_format("ingested_at", rp.ISO_MICROS))


def q_stream_replay_counts(spark, sf_dir):
    return ingest.replay_counts(_deliveries(spark, sf_dir))


def q_stream_union_marts(spark, sf_dir):
    return pipeline(spark, sf_dir, split_feeds=True).channel_daily


def q_latest_events_20(spark, sf_dir):
    return rp.latest_events(_stream_table(spark, sf_dir), 20)


def q_latest_events_5(spark, sf_dir):
    """The 5 newest streamed events."""
    return rp.latest_events(_stream_table(spark, sf_dir), 5)


def q_stream_lag(spark, sf_dir):
    return rp.stream_lag(_stream_table(spark, sf_dir), AS_OF_US)


def q_event_id_hash(spark, sf_dir):
    return pipeline(spark, sf_dir).stg.select("ga_session_id", fc.event_key().alias("event_key"))


def _csv_feed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All staging rows written as header CSV files below the shared folder and read back, with some of them once more
    in files that lack the last column, as a producer with another version would send them. Blanks are quoted
    (``""``) in every other row. The files are parsed once; good rows and rejects come from the written parse."""
    ensure_utc(spark)
    root = shared_dir(spark, "touchcredit", f"csv-{uuid.uuid4().hex[:12]}")
    stg = pipeline(spark, sf_dir).stg
    blank = [F.when(F.col("event_timestamp") % 2 == 1, F.coalesce(F.col(c).cast("string"), F.lit("")))
             .otherwise(F.col(c).cast("string")).alias(c)
             for c in ("source", "medium", "campaign", "purchase_revenue")]
    flat = stg.select(*[c for c in csv_flat.CSV_COLUMNS if c not in ("source", "medium", "campaign", "purchase_revenue")], *blank)
    csv_flat.write_csv(flat, f"{root}/full")
    csv_flat.write_csv(flat.where(F.col("event_timestamp") % 13 == 0), f"{root}/short", drop=1)
    rows = csv_flat.read_checked(spark, [f"{root}/full", f"{root}/short"])
    return csv_flat.split(cut_lineage(rows, "csv_rows"))


def q_stg_csv_clean(spark, sf_dir):
    """The good rows of the CSV files, cleaned."""
    return csv_flat.clean(_csv_feed(spark, sf_dir)[0])


def q_csv_rejects(spark, sf_dir):
    """The rows of the CSV files that could not be read, and why."""
    return _csv_feed(spark, sf_dir)[1].select("event_date", "event_timestamp", "event_name", "user_pseudo_id", "ga_session_id", "reason")


# --- quality --------------------------------------------------------------------

def q_dq_not_null(spark, sf_dir):
    p = pipeline(spark, sf_dir).with_written_credit()
    marts_only = {k: v for k, v in p.relations().items() if k.startswith("mart_")}
    return dq.not_null_staged(dq.staging_profile(p.stg)).unionByName(dq.not_null(marts_only))


def q_dq_unique(spark, sf_dir):
    return dq.unique(pipeline(spark, sf_dir).with_written_credit().relations())


def q_dq_accepted_values(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    return dq.accepted_values_staged(dq.staging_profile(p.stg), p.channel_daily)


def _last_only(p: Pipeline) -> DataFrame:
    return cr.mart(cr.credit_events(p.stg, p.config.lookback_us,
                                    chunk_us=p.config.chunk_us, models=(C.LAST_CLICK,)), C.LAST_CLICK)


def _orphans(days: int) -> Query:
    def q(spark, sf_dir):
        p = pipeline(spark, sf_dir, lookback_days=days)
        return dq.orphans(p.conversions, _last_only(p))
    return q


def _orphan_rate(days: int) -> Query:
    def q(spark, sf_dir):
        p = pipeline(spark, sf_dir, lookback_days=days)
        return dq.orphan_rate(p.conversions, _last_only(p))
    return q


def q_dq_revenue_conserved(spark, sf_dir):
    p = pipeline(spark, sf_dir).with_written_credit()
    return dq.revenue_conserved(p.channel_daily, p.credited)


def q_dq_stream_keys(spark, sf_dir):
    d = _deliveries(spark, sf_dir)
    return dq.stream_keys(d, ingest.dedupe_deliveries(d))


def q_dq_freshness(spark, sf_dir):
    return dq.freshness_staged(dq.staging_profile(pipeline(spark, sf_dir).stg), AS_OF_US)


def q_dq_freshness_feeds(spark, sf_dir):
    """Both feeds of the split, and one that is expected and brings nothing."""
    stg = pipeline(spark, sf_dir, split_feeds=True).stg
    return dq.freshness(stg, AS_OF_US, feeds=(C.BATCH_TAG, C.STREAM_TAG, "backfill")).drop("newest_event_us")


def q_dq_rowcount_7d(spark, sf_dir):
    return dq.rowcount_vs_trailing(pipeline(spark, sf_dir).with_written_credit().channel_daily, AS_OF)


def q_dq_summary(spark, sf_dir):
    p = pipeline(spark, sf_dir).with_written_credit()
    rel = p.relations()
    # every staging-level rule from one pass (written: several checks read it)
    profile = cut_lineage(dq.staging_profile(p.stg), "staging_profile")
    # both attribution marts are slices of the credit relation: one pass each
    not_null = (dq.not_null_staged(profile).unionByName(dq.not_null_credit(p.credited))
                .unionByName(dq.not_null({"mart_channel_daily": p.channel_daily})))
    unique = dq.unique({"int_conversions": p.conversions}).unionByName(dq.unique_credit(p.credited))
    return dq.summary(
        not_null, unique, dq.accepted_values_staged(profile, p.channel_daily),
        dq.orphan_rate(p.conversions, p.mart(C.LAST_CLICK)), dq.revenue_conserved(p.channel_daily, p.credited),
        dq.freshness_staged(profile, AS_OF_US),
        dq.repeated_param_keys(staging.param_lookup(p.inputs.batch_raw)),
        dq.rowcount_vs_trailing(p.channel_daily, AS_OF),
    )


def _live_run(spark, sf_dir, feed: str) -> dict[str, str]:
    """The stream feed (with replays) arrives as day files; a Structured Streaming query merges each micro-batch
    idempotently, credits it at once against both feeds' touchpoints, logs orphans and brings the daily mart up to
    date. With ``feed='all'`` every event comes by the stream and the batch tables are empty."""
    ensure_utc(spark)
    root = shared_dir(spark, "touchcredit", f"live-{uuid.uuid4().hex[:12]}")
    paths = {k: f"{root}/{k}" for k in ("stream_table", "live_credit", "orphans", "daily")}
    write_delivery_files(_deliveries(spark, sf_dir, feed), f"{root}/incoming")
    ev = ea.load_events(spark, sf_dir)
    batch_stg = staging.stg_events(ea.raw_batch(ev if feed == "streaming" else ev.where(F.lit(False)), "batch"))
    cfg = AttributionConfig(lookback_days=C.DEFAULT_LOOKBACK_DAYS, as_of=AS_OF)
    q = live.start_live_credit(
        flat_event_stream(spark, f"{root}/incoming/batch_id=*/*.parquet", max_files_per_trigger=64),
        journeys.touchpoints(batch_stg), journeys.conversions(batch_stg),
        paths["stream_table"], paths["live_credit"], f"{root}/checkpoint", cfg,
        **({} if feed == "streaming" else {"orphan_path": paths["orphans"], "daily_path": paths["daily"]}))
    q.awaitTermination()
    return paths


def q_stream_attribution(spark, sf_dir):
    """X6 end to end: the live credits of the streamed conversions (a tenth of the events comes by the stream)."""
    paths = _live_run(spark, sf_dir, "streaming")
    return live.latest_credits(paths["live_credit"], spark) \
        .join(ingest.read_target(spark, paths["stream_table"]).where(F.col("event_name") == C.CONVERSION_EVENT)
              .select(fc.conversion_id().alias("conversion_id")).distinct(), "conversion_id", "left_semi") \
        .select(*cr.MART_COLUMNS)


def q_stream_compacted(spark, sf_dir):
    """The deduplicated stream table after many small micro-batches, compacted twice and cleared of old files."""
    ensure_utc(spark)
    root = shared_dir(spark, "touchcredit", f"compacted-{uuid.uuid4().hex[:12]}")
    write_delivery_files(_deliveries(spark, sf_dir), f"{root}/incoming")
    source = flat_event_stream(spark, f"{root}/incoming/batch_id=*/*.parquet", max_files_per_trigger=32)
    ingest.start_ingest(source, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    for least in (2, 1):
        ingest.compact_target(spark, f"{root}/table", least_files=least)
        compact.vacuum(spark, f"{root}/table")
    t = ingest.read_target(spark, f"{root}/table")
    return t.withColumn("ingested_at", F.date_format("ingested_at", rp.ISO_MICROS))


def q_stream_orphans(spark, sf_dir):
    """Q4 + X6: orphans as the stream's log has them after its last micro-batch; every event comes by the stream."""
    return live.live_orphans(_live_run(spark, sf_dir, "all")["orphans"], spark)


def q_stream_channel_daily(spark, sf_dir):
    """A1 + X3: the daily mart kept by the stream, touched days only; every event comes by the stream."""
    return live.live_daily(_live_run(spark, sf_dir, "all")["daily"], spark)


def q_mart_published(spark, sf_dir):
    """The daily mart written from the written credit, published, rebuilt, published again and read back."""
    ensure_utc(spark)
    root = shared_dir(spark, "touchcredit", f"published-{uuid.uuid4().hex[:12]}")
    p = pipeline(spark, sf_dir)
    published.publish(spark, f"{root}/attribution", lambda path: mt.write_mart(
        p.credited.select(*cr.MART_COLUMNS), path, partition_by=["attribution_model"]))
    for _ in range(2):
        credited = published.read(spark, f"{root}/attribution")
        published.publish(spark, f"{root}/channel_daily", lambda path, credited=credited: mt.write_mart(
            mt.channel_daily(credited), path, partition_by=["attribution_model"], sort_within=["conversion_date", "attributed_channel"]))
    return published.read(spark, f"{root}/channel_daily").select(*mt.DAILY_KEYS, "conversions", "revenue")


def queries() -> dict[str, Query]:

    out: dict[str, Query] = {
        "stg_events": q_stg_events,
        "stg_param_lookup": q_stg_param_lookup,
        "stg_source_fallback": q_stg_source_fallback,
        "stg_batch_window": q_stg_batch_window,
        "stg_export_trailing": q_stg_export_trailing,
        "touchpoints": q_touchpoints,
        "conversions": q_conversions,
    }
    for model in C.MODELS:
        for days in (1, 7, 30):
            out[f"attribution_{model}_{days}d"] = _attribution(model, days)
    # Same credit with one-second chunks: exercises the cross-chunk carry on
    # nearly every conversion; must equal the result of the usual chunks.
    out["attribution_first_click_7d_fine_chunks"] = _attribution(C.FIRST_CLICK, 7, chunk_us=1_000_000)
    out["attribution_last_click_7d_fine_chunks"] = _attribution(C.LAST_CLICK, 7, chunk_us=1_000_000)
    # ... and with chunks as wide as the lookback: nearly all work in-chunk.
    out["attribution_first_asof_7d"] = _attribution(C.FIRST_CLICK, 7, chunk_us=7 * C.MICROS_PER_DAY)
    out["attribution_last_asof_7d"] = _attribution(C.LAST_CLICK, 7, chunk_us=7 * C.MICROS_PER_DAY)
    out["attribution_split_hot_7d"] = q_attribution_split_hot_7d
    out["channel_daily"] = _channel_daily(30)
    out["channel_daily_hot_user"] = q_channel_daily_hot_user
    out["attribution_last_click_30d_hot_user"] = q_attribution_last_click_30d_hot_user
    out["channel_daily_1d"] = _channel_daily(1)
    out["channel_daily_7d"] = _channel_daily(7)
    out.update({
        "model_totals": q_model_totals,
        "channel_breakdown": q_channel_breakdown,
        "channel_compare": q_channel_compare,
        "channel_scaled": q_channel_scaled,
        "trend_14": q_trend_14,
        "model_disagreement": q_model_disagreement,
        "model_disagreement_sample": q_model_disagreement_sample,
        "latest_events_20": q_latest_events_20,
        "latest_events_5": q_latest_events_5,
        "last_click_breakdown": q_last_click_breakdown,
        "channel_daily_ordered": q_channel_daily_ordered,
        "report_bundle": q_report_bundle,
        "stream_dedupe": q_stream_dedupe,
        "stream_replay_counts": q_stream_replay_counts,
        "stream_union_marts": q_stream_union_marts,
        "stream_lag": q_stream_lag,
        "event_id_hash": q_event_id_hash,
        "stg_csv_clean": q_stg_csv_clean,
        "csv_rejects": q_csv_rejects,
        "stream_compacted": q_stream_compacted,
        "dq_not_null": q_dq_not_null,
        "dq_unique": q_dq_unique,
        "dq_accepted_values": q_dq_accepted_values,
        "dq_orphans": _orphans(30),
        "dq_orphans_1d": _orphans(1),
        "dq_orphan_rate": _orphan_rate(30),
        "dq_orphan_rate_7d": _orphan_rate(7),
        "dq_revenue_conserved": q_dq_revenue_conserved,
        "dq_freshness": q_dq_freshness,
        "dq_freshness_feeds": q_dq_freshness_feeds,
        "dq_stream_keys": q_dq_stream_keys,
        "dq_rowcount_7d": q_dq_rowcount_7d,
        "dq_summary": q_dq_summary,
        "stream_attribution": q_stream_attribution,
        "stream_orphans": q_stream_orphans,
        "stream_channel_daily": q_stream_channel_daily,
        "mart_published": q_mart_published,
    })
    return out

