"""Data-quality checks (Q1–Q9). A check returns the violating rows or a
count per rule; zero rows / zero failures = pass. One aggregate computes
every column's NULL count of a relation, and every staging-level rule comes
from one pass over staging (``staging_profile``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit import config as C
from touchcredit.functions import columns as fc

# --- fixed values: the columns each relation must not leave NULL -------------
NOT_NULL = {
    "stg_events": ["event_timestamp", "event_name", "user_pseudo_id"],
    "int_touchpoints": ["touchpoint_ts", "channel"],
    "int_conversions": ["conversion_id", "conversion_ts", "purchase_revenue"],
    "mart_attribution_first_click": ["conversion_id", "attributed_channel", "purchase_revenue"],
    "mart_attribution_last_click": ["conversion_id", "attributed_channel", "purchase_revenue"],
    "mart_channel_daily": ["attribution_model", "conversion_date", "conversions"],
}
# Relations whose key must be unique.
UNIQUE = {
    "int_conversions": "conversion_id",
    "mart_attribution_first_click": "conversion_id",
    "mart_attribution_last_click": "conversion_id",
}
# ----------------------------------------------------------------------------


def null_counts(df: DataFrame, relation: str, columns: list[str]) -> DataFrame:
    """Q1 for one relation: one aggregate pass, one output row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return agg.unpivot([], columns, "column_name", "failures") \
        .select(F.lit(relation).alias("relation"), "column_name", F.col("failures").cast("bigint"))


def not_null(relations: dict[str, DataFrame]) -> DataFrame:
    """Q1 for the relations given (a subset of ``NOT_NULL`` is fine)."""
    out = None
    for rel, cols in NOT_NULL.items():
        if rel not in relations:
            continue
        part = null_counts(relations[rel], rel, cols)
        out = part if out is None else out.unionByName(part)
    return out


def staging_profile(stg: DataFrame) -> DataFrame:
    """One pass over staging for every staging-level check: per feed and event name
    (a handful of rows) the row count, the NULL counts that the staging,
    touchpoint and conversion rules need, and the newest event time.
    Touchpoints and conversions are filters of staging, so their rules are
    the same counts restricted to their event name."""
    ts, user = F.col("event_timestamp"), F.col("user_pseudo_id")
    channel = fc.channel_label("source", "medium")
    return stg.groupBy("_source", "event_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(ts.isNull()).alias("ts_null"),
        F.count_if(user.isNull()).alias("user_null"),
        F.count_if(user.isNull() | ts.isNull()).alias("key_null"),
        F.count_if(F.col("purchase_revenue").isNull()).alias("revenue_null"),
        F.count_if(channel.isNull()).alias("channel_null"),
        F.max(ts).alias("newest"),
    )


def not_null_staged(profile: DataFrame) -> DataFrame:
    """Q1 rows of the staging, touchpoint and conversion relations from the
    profile (same output as ``null_counts`` on each relation)."""
    name = F.col("event_name")

    def where(cond, col):
        return F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0)).cast("bigint")
    touch, conv = name == C.TOUCH_EVENT, name == C.CONVERSION_EVENT
    row = profile.agg(
        where(F.lit(True), "ts_null").alias("a"),
        F.coalesce(F.sum(F.when(name.isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("b"),
        where(F.lit(True), "user_null").alias("c"),
        where(touch, "ts_null").alias("d"),
        where(touch, "channel_null").alias("e"),
        where(conv, "key_null").alias("f"),
        where(conv, "ts_null").alias("g"),
        where(conv, "revenue_null").alias("h"),
    )
    spec = [("stg_events", "event_timestamp", "a"), ("stg_events", "event_name", "b"),
            ("stg_events", "user_pseudo_id", "c"), ("int_touchpoints", "touchpoint_ts", "d"),
            ("int_touchpoints", "channel", "e"), ("int_conversions", "conversion_id", "f"),
            ("int_conversions", "conversion_ts", "g"), ("int_conversions", "purchase_revenue", "h")]
    rows = F.array(*[F.struct(F.lit(r).alias("relation"), F.lit(c).alias("column_name"),
                              F.col(k).alias("failures")) for r, c, k in spec])
    return row.select(F.inline(rows))


def accepted_values_staged(profile: DataFrame, daily: DataFrame) -> DataFrame:
    """Q3 from the profile (event names) and the daily mart (models)."""
    names = (profile.where(~F.col("event_name").isin(*C.ACCEPTED_EVENT_NAMES))
             .groupBy("event_name").agg(F.sum("n").alias("n"))
             .select(F.lit("stg_events").alias("relation"), F.lit("event_name").alias("column_name"),
                     F.col("event_name").alias("value"), F.col("n").alias("n_rows")))
    models = (daily.where(~F.col("attribution_model").isin(*C.MODELS)).groupBy("attribution_model").count()
              .select(F.lit("mart_channel_daily").alias("relation"), F.lit("attribution_model").alias("column_name"),
                      F.col("attribution_model").alias("value"), F.col("count").alias("n_rows")))
    return names.unionByName(models)


def freshness_staged(profile: DataFrame, as_of_us: int, feeds: tuple[str, ...] = (C.BATCH_TAG,)) -> DataFrame:
    """Q6 from the profile's newest event times."""
    return freshness(profile.select("_source", F.col("newest").alias("event_timestamp")), as_of_us, feeds=feeds)


_MART_OF = {C.FIRST_CLICK: "mart_attribution_first_click", C.LAST_CLICK: "mart_attribution_last_click"}


def not_null_credit(credited: DataFrame) -> DataFrame:
    """Q1 rows of both attribution marts from one aggregate over the credit
    relation (the marts are its two model slices)."""
    cols = NOT_NULL[_MART_OF[C.FIRST_CLICK]]
    model = F.col("attribution_model")
    agg = credited.agg(*[F.count_if((model == m) & F.col(c).isNull()).alias(f"{m}|{c}")
                         for m in C.MODELS for c in cols])
    rows = F.array(*[F.struct(F.lit(_MART_OF[m]).alias("relation"), F.lit(c).alias("column_name"),
                              F.col(f"`{m}|{c}`").cast("bigint").alias("failures"))
                     for m in C.MODELS for c in cols])
    return agg.select(F.inline(rows))


def unique_credit(credited: DataFrame) -> DataFrame:
    """Q2 rows of both attribution marts from one grouping of the credit
    relation by (key, model)."""
    dup = (credited.where(F.col("conversion_id").isNotNull())
           .groupBy("conversion_id", "attribution_model").count().where("count > 1"))
    agg = dup.agg(*[F.count_if(F.col("attribution_model") == m).alias(m) for m in C.MODELS])
    rows = F.array(*[F.struct(F.lit(_MART_OF[m]).alias("relation"), F.lit("conversion_id").alias("column_name"),
                              F.col(m).cast("bigint").alias("failures")) for m in C.MODELS])
    return agg.select(F.inline(rows))


def duplicate_keys(df: DataFrame, relation: str, key: str) -> DataFrame:
    """Q2 detail: key values present more than once (NULL keys excluded)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
            .select(F.lit(relation).alias("relation"), F.col(key).alias("key_value"),
                    F.col("count").alias("n_rows")))


def unique(relations: dict[str, DataFrame]) -> DataFrame:
    """Q2 summary: number of duplicated key values per relation (for the
    relations given)."""
    out = None
    for rel, key in UNIQUE.items():
        if rel not in relations:
            continue
        d = duplicate_keys(relations[rel], rel, key)
        part = d.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(rel).alias("relation"), F.lit(key).alias("column_name"), F.col("failures").cast("bigint"))
        out = part if out is None else out.unionByName(part)
    return out


def accepted_values(stg: DataFrame, daily: DataFrame) -> DataFrame:
    """Q3: values outside the accepted sets, with their row counts (NULLs
    are not judged, as in a ``NOT IN`` filter)."""
    def bad(df, rel, col, allowed):
        return (df.where(~F.col(col).isin(*allowed)).groupBy(col).count()
                .select(F.lit(rel).alias("relation"), F.lit(col).alias("column_name"),
                        F.col(col).alias("value"), F.col("count").alias("n_rows")))
    return bad(stg, "stg_events", "event_name", C.ACCEPTED_EVENT_NAMES) \
        .unionByName(bad(daily, "mart_channel_daily", "attribution_model", C.MODELS))


def orphans(conversions: DataFrame, last_mart: DataFrame) -> DataFrame:
    """Q4: conversions without a last-click credit (anti join)."""
    return conversions.join(last_mart.select("conversion_id"), "conversion_id", "left_anti") \
        .select("conversion_id", "conversion_date")


def orphan_rate(conversions: DataFrame, last_mart: DataFrame) -> DataFrame:
    """Q4 as a rate: one left join and one aggregate (the mart has one row
    per conversion, which the unique check asserts)."""
    credited = last_mart.select("conversion_id", F.lit(True).alias("_hit"))
    j = conversions.join(credited, "conversion_id", "left")
    return j.agg(
        F.count(F.lit(1)).alias("conversions"),
        F.count_if(F.col("_hit").isNull()).alias("orphans"),
    ).withColumn("orphan_rate", F.round(F.col("orphans") / F.col("conversions"), 6))


def revenue_conserved(daily: DataFrame, credited: DataFrame | None = None,
                      tolerance: float = 0.005) -> DataFrame:
    """Q5: totals per model re-summed from the rounded mart, side by side
    by conditional aggregation. ``ref_violation`` is the plain ``!=`` (a
    missing model yields no violation). ``strict_violation`` is null-safe
    (one model missing fails) and, when ``credited`` is given, compares the
    unrounded totals of the credit relation within ``tolerance``."""
    def total(df, col, m, rnd):
        s_ = F.sum(F.when(F.col("attribution_model") == m, F.col(col)))
        return F.round(s_, 2) if rnd else s_
    t = daily.agg(total(daily, "revenue", C.FIRST_CLICK, True).alias("first_click_total"),
                  total(daily, "revenue", C.LAST_CLICK, True).alias("last_click_total"))
    ref = F.coalesce(F.col("first_click_total") != F.col("last_click_total"), F.lit(False))
    if credited is None:
        strict = ~F.col("first_click_total").eqNullSafe(F.col("last_click_total"))
        return t.select("first_click_total", "last_click_total", ref.alias("ref_violation"),
                        strict.alias("strict_violation"))
    u = credited.agg(total(credited, "purchase_revenue", C.FIRST_CLICK, False).alias("_f"),
                     total(credited, "purchase_revenue", C.LAST_CLICK, False).alias("_l"))
    f, l_ = F.col("_f"), F.col("_l")
    strict = (F.when(f.isNull() & l_.isNull(), F.lit(False))
              .when(f.isNull() | l_.isNull(), F.lit(True))
              .otherwise(F.abs(f - l_) > F.lit(tolerance)))
    # two one-row aggregates side by side: a scalar subquery, not a join
    return t.select("first_click_total", "last_click_total", ref.alias("ref_violation"),
                    u.select(strict.alias("s")).scalar().alias("strict_violation"))


def stream_keys(deliveries: DataFrame, target: DataFrame) -> DataFrame:
    """Idempotency-key health: delivered rows without a key (NULL user,
    time or name; never hashed as text) and keys present twice in the
    target (must be 0)."""
    null_keys = deliveries.agg(F.count_if(F.col("event_id").isNull()).cast("bigint").alias("null_keys"))
    dup = duplicate_keys(target, "events_streaming", "event_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    return null_keys.select("null_keys", dup.scalar().alias("duplicate_keys_in_target"))


def freshness(stg: DataFrame, as_of_us: int, warn_hours: int = C.FRESHNESS_WARN_HOURS,
              error_hours: int = C.FRESHNESS_ERROR_HOURS, feeds: tuple[str, ...] = (C.BATCH_TAG,)) -> DataFrame:
    """Q6: for each expected feed the hours since its newest event against
    ``as_of``; warn / error. The expected feeds are a relation of their own,
    so a feed that brings nothing has no newest time and is an error, however
    live the others are. Feeds that nobody expects are not judged."""
    newest = stg.groupBy("_source").agg(F.max("event_timestamp").alias("newest_event_us"))
    expected = stg.sparkSession.createDataFrame([(f,) for f in feeds], "feed string")
    hours = (F.lit(int(as_of_us)) - F.col("newest_event_us")) / F.lit(3_600_000_000.0)
    t = expected.join(newest, F.col("feed") == F.col("_source"), "left") \
        .select("feed", "newest_event_us", F.round(hours, 3).alias("hours_since"))
    return t.withColumn(
        "status",
        F.when(F.col("hours_since") <= warn_hours, F.lit("pass"))
        .when(F.col("hours_since") <= error_hours, F.lit("warn"))
        .otherwise(F.lit("error")),
    )


def rowcount_vs_trailing(daily: DataFrame, as_of: _dt.date, ratio: float = 0.5) -> DataFrame:
    """Q7: mart rows per calendar day against the mean of the 7 days
    before it (a silent day counts 0). Each day's count is spread to the 7
    following days (a bounded 7x explode) and re-summed: no global window."""
    per_day = daily.groupBy(F.to_date("conversion_date", "yyyyMMdd").alias("d")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))
    last_day = F.lit(as_of - _dt.timedelta(days=1))
    calendar = per_day.agg(F.min("d").alias("lo")) \
        .select(F.explode(F.sequence(F.col("lo"), last_day)).alias("d"))
    spread = per_day.select(F.explode(F.sequence(F.lit(1), F.lit(7))).alias("i"), "d", "n_rows") \
        .select(F.date_add("d", F.col("i")).alias("d"), "n_rows") \
        .groupBy("d").agg(F.sum("n_rows").alias("prev7"))
    out = calendar.join(per_day, "d", "left").join(spread, "d", "left").select(
        F.date_format("d", "yyyyMMdd").alias("conversion_date"),
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        F.round(F.coalesce("prev7", F.lit(0)) / F.lit(7.0), 3).alias("prev7_avg"),
    )
    return out.withColumn(
        "status",
        F.when((F.col("prev7_avg") > 0) & (F.col("n_rows") < F.col("prev7_avg") * F.lit(ratio)), F.lit("fail"))
        .otherwise(F.lit("pass")),
    )


def repeated_param_keys(param_lookup: DataFrame) -> DataFrame:
    """Rows whose params repeat a looked-up key (first match is used)."""
    return param_lookup.agg(F.count_if("has_repeated_key").cast("bigint").alias("failures"))


def summary(not_null_df: DataFrame, unique_df: DataFrame, accepted_df: DataFrame,
            orphan_rate_df: DataFrame, conserved_df: DataFrame, fresh_df: DataFrame,
            repeats_df: DataFrame, rowcount_df: DataFrame) -> DataFrame:
    """Q9: one row per check: name, failures, status."""
    def st(f):
        return F.when(f > 0, F.lit("fail")).otherwise(F.lit("pass"))
    nn = not_null_df.select(F.concat(F.lit("not_null:"), "relation", F.lit("."), "column_name").alias("check_name"),
                            "failures")
    un = unique_df.select(F.concat(F.lit("unique:"), "relation", F.lit("."), "column_name").alias("check_name"),
                          "failures")
    acc = accepted_df.groupBy("relation", "column_name").agg(F.sum("n_rows").alias("failures"))
    keys = F.array(*[F.struct(F.lit(r).alias("relation"), F.lit(c).alias("column_name"))
                     for r, c in (("stg_events", "event_name"), ("mart_channel_daily", "attribution_model"))])
    acc_all = accepted_df.sparkSession.range(1).select(F.explode(keys).alias("k")) \
        .select("k.relation", "k.column_name") \
        .join(acc, ["relation", "column_name"], "left") \
        .select(F.concat(F.lit("accepted_values:"), "relation", F.lit("."), "column_name").alias("check_name"),
                F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))
    orph = orphan_rate_df.select(F.lit("no_orphaned_conversions").alias("check_name"),
                                 F.col("orphans").cast("bigint").alias("failures"))
    cons = conserved_df.select(F.lit("revenue_conserved").alias("check_name"),
                               F.col("ref_violation").cast("bigint").alias("failures"))
    cons2 = conserved_df.select(F.lit("revenue_conserved_null_safe").alias("check_name"),
                                F.col("strict_violation").cast("bigint").alias("failures"))
    rep = repeats_df.select(F.lit("param_repeated_keys").alias("check_name"), "failures")
    rc = rowcount_df.agg(F.count_if(F.col("status") == "fail").cast("bigint").alias("failures")) \
        .select(F.lit("mart_rowcount_7d").alias("check_name"), "failures")
    counted = nn.unionByName(un).unionByName(acc_all).unionByName(orph).unionByName(cons) \
        .unionByName(cons2).unionByName(rep).unionByName(rc) \
        .select("check_name", F.col("failures").cast("bigint").alias("failures"))
    counted = counted.withColumn("status", st(F.col("failures")))
    fresh = fresh_df.select(
        F.concat(F.lit("source_freshness:"), "feed").alias("check_name"),
        F.when(F.col("status") == "pass", F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("failures"),
        F.col("status"),
    )
    return counted.unionByName(fresh)
