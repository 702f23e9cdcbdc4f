"""Report queries over the credited rows and the daily mart (A2–A9, J3,
J5, T1–T6). Every input here is already aggregated or is the credit
relation; the only limits are the top-k reports themselves. Global maxima
are windows over already-aggregated frames (at most 14 dates, one row per
channel); top-k lists are ``orderBy().limit()`` (a bounded take)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchcredit import config as C

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def model_totals(credited: DataFrame) -> DataFrame:
    """A2: conversions and revenue per model."""
    return credited.groupBy("attribution_model").agg(
        F.count(F.lit(1)).alias("conversions"),
        F.round(F.sum("purchase_revenue"), 2).alias("revenue"),
    )


def channel_breakdown(credited: DataFrame) -> DataFrame:
    """A3: per model and channel; presentation order model, revenue desc."""
    return credited.groupBy("attribution_model", "attributed_channel").agg(
        F.count(F.lit(1)).alias("conversions"),
        F.round(F.sum("purchase_revenue"), 2).alias("revenue"),
    )


def ordered_breakdown(breakdown: DataFrame) -> DataFrame:
    return breakdown.orderBy("attribution_model", F.col("revenue").desc_nulls_last(), "attributed_channel")


def channel_compare(credited: DataFrame) -> DataFrame:
    """J5 as one conditional aggregation (no join): both models side by
    side per channel, a missing side counts 0."""
    def side(model: str, prefix: str):
        is_m = F.col("attribution_model") == model
        return [
            F.count_if(is_m).alias(f"{prefix}_conversions"),
            F.coalesce(F.round(F.sum(F.when(is_m, F.col("purchase_revenue"))), 2), F.lit(0.0))
             .alias(f"{prefix}_revenue"),
        ]
    return credited.groupBy("attributed_channel").agg(*side(C.FIRST_CLICK, "fc"), *side(C.LAST_CLICK, "lc"))


def channel_scaled(compare: DataFrame) -> DataFrame:
    """A6 + T6: each side as a percentage of the largest channel revenue of
    either model (at least 1), one decimal; ordered by last-click revenue.
    The maximum is a one-row aggregate (partial + final), not a window that
    would gather every channel in one task; ties are ordered by channel."""
    top = F.greatest(F.lit(1.0), compare.agg(F.max(F.greatest("fc_revenue", "lc_revenue")).alias("m")).scalar())
    return compare.orderBy(F.col("lc_revenue").desc(), "attributed_channel").select(
        "attributed_channel", "fc_revenue", "lc_revenue",
        F.round(F.col("fc_revenue") / top * 100, 1).alias("fc_pct"),
        F.round(F.col("lc_revenue") / top * 100, 1).alias("lc_pct"),
    )


def trend(daily: DataFrame, n_dates: int = 14) -> DataFrame:
    """A5 + T3 + A9: conversions per model on the last ``n_dates`` dates
    that have data (not calendar days), zero-filled, plus the chart scale
    (largest value, at least 1) and the MM/DD label of each date.

    One branch: the mart is folded per date (partial + final aggregate),
    the top ``n_dates`` dates are taken (a bounded top-k), and the scale is
    a window over those at most ``n_dates`` rows."""
    per = (daily.groupBy("conversion_date")
           .agg(*[F.coalesce(F.sum(F.when(F.col("attribution_model") == m, F.col("conversions"))),
                             F.lit(0)).cast("bigint").alias(m) for m in C.MODELS])
           .orderBy(F.col("conversion_date").desc()).limit(n_dates))
    top = F.max(F.greatest(*[F.col(m) for m in C.MODELS])).over(Window.partitionBy(F.lit(1)))
    label = F.concat(F.substring("conversion_date", 5, 2), F.lit("/"), F.substring("conversion_date", 7, 2))
    return per.withColumn("chart_max", F.greatest(F.lit(1), top).cast("bigint")).withColumn("label", label) \
        .orderBy("conversion_date")


def model_disagreement(credited: DataFrame) -> DataFrame:
    """Conversions the two models credit to different channels. One
    conditional aggregation per conversion instead of a self-join, so the
    credit relation is read once."""
    def ch(model: str):
        return F.max(F.when(F.col("attribution_model") == model, F.col("attributed_channel")))
    both = credited.groupBy("conversion_id").agg(ch(C.FIRST_CLICK).alias("first_channel"),
                                                  ch(C.LAST_CLICK).alias("last_channel"))
    return both.where(F.col("first_channel") != F.col("last_channel"))


def disagreement_sample(disagreement: DataFrame, n: int = 5) -> DataFrame:
    """T4: the first ``n`` disagreements by key (top-k, not a full sort)."""
    return disagreement.orderBy("conversion_id").limit(n)


def latest_events(stream_table: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most recently ingested events (ties by key)."""
    return (stream_table.orderBy(F.col("ingested_at").desc(), F.col("event_id").asc()).limit(n)
            .select("event_id", "event_name", "user_pseudo_id", "source", "medium", "purchase_revenue",
                    F.date_format("ingested_at", ISO_MICROS).alias("ingested_at")))


def stream_lag(stream_table: DataFrame, now_us: int, alert_seconds: int = 300) -> DataFrame:
    """X5 + A8: rows in the stream table, newest ingest time, lag against
    ``now`` (passed in, never read from the clock) and an alert flag; an
    empty table has no newest time and alerts."""
    newest = F.max(F.unix_micros("ingested_at"))
    lag = (F.lit(int(now_us)) - newest) / F.lit(1_000_000.0)
    return stream_table.agg(
        F.count(F.lit(1)).alias("n_rows"),
        newest.alias("newest_ingested_us"),
        F.round(lag, 3).alias("lag_seconds"),
    ).withColumn("status", F.when(F.col("lag_seconds") <= alert_seconds, F.lit("ok")).otherwise(F.lit("alert")))


def ordered_daily(daily: DataFrame) -> DataFrame:
    """T5: presentation order of the mart."""
    return daily.orderBy("conversion_date", "attribution_model", "attributed_channel")


#: What orders the lines of a section; a key that a section has no use for is null there.
LINE_ORDER = ["day", "model", "rank", "name"]
REPORT_FIELDS = ("generated_at string, attribution_model string, conversion_date string, attributed_channel string, "
                 "conversions bigint, revenue double, first_click bigint, last_click bigint, chart_max bigint, label string, "
                 "event_id string, event_name string, user_pseudo_id string, source string, medium string, "
                 "purchase_revenue double, ingested_at string")


def _lines(rows: DataFrame, section: str, **keys: Column) -> DataFrame:
    """One line of JSON for each row (nulls written), with its section and keys."""
    kinds = {"day": "string", "model": "string", "rank": "double", "name": "string"}
    return rows.select(F.lit(section).alias("section"), *[keys.get(k, F.lit(None)).cast(kinds[k]).alias(k) for k in LINE_ORDER],
                       F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json"))


def report_lines(totals: DataFrame, breakdown: DataFrame, daily: DataFrame, trend_df: DataFrame, live: DataFrame,
                 generated_at: str) -> DataFrame:
    """The report as lines of JSON in named sections: ``meta`` (``generated_at``, passed in, not read from a clock),
    ``totals`` by model, ``channel_breakdown`` by model and falling revenue (NULL last, then channel), ``channel_daily`` in
    presentation order, ``trend`` by date, ``live_events`` newest first. An empty relation has no lines."""
    model, channel, day = F.col("attribution_model"), F.col("attributed_channel"), F.col("conversion_date")
    parts = [
        _lines(totals.sparkSession.range(1).select(F.lit(generated_at).alias("generated_at")), "meta"),
        _lines(totals, "totals", model=model),
        _lines(breakdown, "channel_breakdown", model=model, rank=-F.coalesce("revenue", F.lit(float("-inf"))), name=channel),
        _lines(daily, "channel_daily", day=day, model=model, name=channel),
        _lines(trend_df, "trend", day=day),
        _lines(live, "live_events", rank=-F.unix_micros(F.to_timestamp("ingested_at")), name=F.col("event_id")),
    ]
    return reduce(DataFrame.unionByName, parts)


def write_report(lines: DataFrame, path: str) -> None:
    """Write ``report_lines`` as text, a folder for each section. Lines are dealt by range of their order and sorted in each
    task, so a section's files, by name, hold it in order, however many channels or days it has: no relation is folded
    into one row or sent through one task. The lines are written to ``<path>-lines`` first, since finding the ranges reads them
    once more."""
    lines.write.mode("overwrite").parquet(f"{path}-lines")
    order = ["section", *LINE_ORDER]
    # a section that can be null would be sorted again, by itself alone, for the folders
    (lines.sparkSession.read.schema(lines.schema).parquet(f"{path}-lines")
     .withColumn("section", F.coalesce("section", F.lit("")))
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .select("section", "json")
     .write.mode("overwrite").partitionBy("section").text(path))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The sections of a written report with the fields of their lines; a field that a section lacks is null."""
    lines = spark.read.text(path).withColumn("section", F.col("section").cast("string"))
    return lines.select("section", F.from_json("value", REPORT_FIELDS).alias("r")).select("section", "r.*")
