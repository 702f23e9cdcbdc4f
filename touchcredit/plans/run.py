"""Production batch run: export + streaming table -> written marts,
reports and checks (the ``run`` + ``test`` cycle).

The credit relation is computed once and written; the daily mart, the
reports and the checks read the written tables (lineage cut, restartable
after executor loss, nothing recomputed from the raw scan). Output goes to a
folder the caller names, by default under the cluster's shared checkpoint
folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit import config as C
from touchcredit.config import AttributionConfig
from touchcredit.functions import columns as fc
from touchcredit.operators import credit as cr
from touchcredit.operators import journeys, marts, quality, reports, staging
from touchcredit.session import apply_scale_conf, ensure_utc, input_bytes, shared_dir
from touchcredit.sources import batch as batch_src
from touchcredit.streaming import ingest

MICROS_PER_DAY = C.MICROS_PER_DAY


def run_batch(spark: SparkSession, export_path: str, stream_table_path: str | None,
              config: AttributionConfig, out_dir: str | None = None,
              size_to_input: bool = True) -> dict[str, str]:
    ensure_utc(spark)
    if size_to_input:
        # shuffle partitions / split sizes from the input's byte size (metadata only)
        total = input_bytes(spark, export_path) + (input_bytes(spark, stream_table_path)
                                                   if stream_table_path else 0)
        apply_scale_conf(spark, total)
    out_dir = out_dir or shared_dir(spark, "touchcredit", "marts")
    as_of = config.as_of or _dt.date.today()
    raw = batch_src.read_export(spark, export_path, as_of, config.batch_window_days)
    stream = ingest.read_target(spark, stream_table_path) if stream_table_path else None
    stg = staging.stg_events(raw, stream)
    conv = journeys.conversions(stg)
    credited = cr.credit_events(stg, config.lookback_us, chunk_us=config.chunk_us,
                                fine_us=config.fine_us)

    paths = {k: f"{out_dir}/{k}" for k in (
        "attribution", "mart_channel_daily", "conversions", "touchpoints", "model_totals",
        "channel_breakdown", "channel_compare", "trend", "dq_summary")}
    # compact touchpoint table by day: what the live credit reads per micro-batch
    touch = journeys.touchpoints(stg).drop("touchpoint_ts")
    marts.write_mart(touch.withColumn("touch_day", fc.micros_to_day("touchpoint_us")), paths["touchpoints"],
                     partition_by=["touch_day"])
    marts.write_mart(credited.select(*cr.MART_COLUMNS, "touchpoint_us"), paths["attribution"],
                     partition_by=["attribution_model"])
    # conversions are written too: the orphan check and Q1/Q2 read them
    marts.write_mart(conv.select("conversion_id", "user_pseudo_id", "conversion_date", "conversion_us",
                                 "conversion_ts", "purchase_revenue",
                                 fc.micros_to_day("conversion_us").alias("conversion_day")), paths["conversions"],
                     partition_by=["conversion_day"])
    att = spark.read.parquet(paths["attribution"])
    marts.write_mart(marts.channel_daily(att), paths["mart_channel_daily"],
                     partition_by=["attribution_model"], sort_within=["conversion_date", "attributed_channel"])
    daily = spark.read.parquet(paths["mart_channel_daily"])
    marts.write_mart(reports.model_totals(att), paths["model_totals"])
    marts.write_mart(reports.channel_breakdown(att), paths["channel_breakdown"])
    marts.write_mart(reports.channel_compare(att), paths["channel_compare"])
    marts.write_mart(reports.trend(daily, 14), paths["trend"])

    convs = spark.read.parquet(paths["conversions"])
    rel = {
        "int_conversions": convs,
        "mart_attribution_first_click": cr.mart(att, C.FIRST_CLICK),
        "mart_attribution_last_click": cr.mart(att, C.LAST_CLICK),
        "mart_channel_daily": daily,
    }
    # all staging-level rules from one pass over the export
    paths["staging_profile"] = f"{out_dir}/staging_profile"
    marts.write_mart(quality.staging_profile(stg), paths["staging_profile"])
    profile = spark.read.parquet(paths["staging_profile"])
    as_of_us = int(_dt.datetime(as_of.year, as_of.month, as_of.day,
                                tzinfo=_dt.timezone.utc).timestamp()) * 1_000_000
    feeds = (C.BATCH_TAG, C.STREAM_TAG) if stream is not None else (C.BATCH_TAG,)
    summary = quality.summary(
        quality.not_null_staged(profile).unionByName(quality.not_null_credit(att))
        .unionByName(quality.not_null({"mart_channel_daily": daily})),
        quality.unique({"int_conversions": convs}).unionByName(quality.unique_credit(att)),
        quality.accepted_values_staged(profile, daily),
        quality.orphan_rate(convs, rel["mart_attribution_last_click"]), quality.revenue_conserved(daily, att),
        quality.freshness_staged(profile, as_of_us, feeds), quality.repeated_param_keys(staging.param_lookup(raw)),
        quality.rowcount_vs_trailing(daily, as_of),
    )
    marts.write_mart(summary, paths["dq_summary"])
    # the report, from the written tables
    paths["report_bundle"] = f"{out_dir}/report_bundle"
    live = (reports.latest_events(stream, 20) if stream is not None
            else spark.createDataFrame([], "event_id string, event_name string, user_pseudo_id string, "
                                           "source string, medium string, purchase_revenue double, "
                                           "ingested_at string"))
    reports.write_report(reports.report_lines(
        *[spark.read.parquet(paths[k]) for k in ("model_totals", "channel_breakdown", "mart_channel_daily", "trend")],
        live, generated_at=as_of.isoformat()), paths["report_bundle"])
    return paths


def run_csv(spark: SparkSession, csv_path: str, config: AttributionConfig,
            out_dir: str | None = None) -> dict[str, str]:
    """The flat-file pipeline: header CSV -> cleaned staging -> credit ->
    marts, plus the validation report (totals per model, last-click
    breakdown, a sample of conversions the models credit differently)."""
    from touchcredit.sources import csv_flat

    ensure_utc(spark)
    out_dir = out_dir or shared_dir(spark, "touchcredit", "csv_marts")
    stg = csv_flat.to_staging(csv_flat.clean(csv_flat.read_csv(spark, csv_path)))
    credited = cr.credit_events(stg, config.lookback_us, chunk_us=config.chunk_us)
    paths = {k: f"{out_dir}/{k}" for k in ("attribution", "mart_channel_daily", "model_totals",
                                            "last_click_breakdown", "disagreement_sample")}
    marts.write_mart(credited.select(*cr.MART_COLUMNS), paths["attribution"], partition_by=["attribution_model"])
    att = spark.read.parquet(paths["attribution"])
    marts.write_mart(marts.channel_daily(att), paths["mart_channel_daily"],
                     sort_within=["conversion_date", "attribution_model", "attributed_channel"])
    marts.write_mart(reports.model_totals(att), paths["model_totals"])
    marts.write_mart(reports.channel_breakdown(cr.mart(att, C.LAST_CLICK).withColumn(
        "attribution_model", F.lit(C.LAST_CLICK))), paths["last_click_breakdown"])
    marts.write_mart(reports.disagreement_sample(reports.model_disagreement(att), 5), paths["disagreement_sample"])
    return paths


def read_outputs(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Written outputs as DataFrames (the report with the fields of its lines)."""
    return {k: (reports.read_report(spark, v) if k == "report_bundle" else spark.read.parquet(v))
            for k, v in paths.items()}
