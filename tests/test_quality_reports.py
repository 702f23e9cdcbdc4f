"""Quality checks find exactly the planted rows; reports on fixtures."""

import datetime as dt

from conftest import CONV_SCHEMA, DAY, TOUCH_SCHEMA, conv_row
from touchcredit import config as C
from touchcredit.operators import credit as cr
from touchcredit.operators import marts, quality, reports

DAILY_SCHEMA = "attribution_model string, conversion_date string, attributed_channel string, conversions bigint, revenue double"
C0 = 1_706_000_000_000_000


def test_missing_model_fails_only_null_safe_check(spark):
    daily = spark.createDataFrame([("first_click", "20240101", "A", 1, 10.0)], DAILY_SCHEMA)
    r = quality.revenue_conserved(daily).collect()[0]
    assert r.last_click_total is None
    assert r.ref_violation is False and r.strict_violation is True


def test_conserved_on_clean_marts(spark):
    daily = spark.createDataFrame([("first_click", "20240101", "A", 1, 10.0),
                                   ("last_click", "20240101", "B", 1, 10.0)], DAILY_SCHEMA)
    r = quality.revenue_conserved(daily).collect()[0]
    assert r.ref_violation is False and r.strict_violation is False


def test_orphans_and_duplicates_are_reported(spark):
    touches = spark.createDataFrame([("u", 1, C0 - 10, "A")], TOUCH_SCHEMA)
    convs = spark.createDataFrame([conv_row("u", C0), conv_row("u", C0), conv_row("w", C0),
                                   conv_row("u", C0 + 40 * DAY)], CONV_SCHEMA)
    credited = cr.credit(touches, convs, 30 * DAY)
    last = cr.mart(credited, C.LAST_CLICK)
    orph = {r.conversion_id for r in quality.orphans(convs, last).collect()}
    assert orph == {f"w-{C0}", f"u-{C0 + 40 * DAY}"}
    dup = quality.duplicate_keys(convs, "int_conversions", "conversion_id").collect()
    assert [(r.key_value, r.n_rows) for r in dup] == [(f"u-{C0}", 2)]
    assert quality.duplicate_keys(last, "mart", "conversion_id").count() == 0
    rate = quality.orphan_rate(convs, last).collect()[0]
    assert (rate.conversions, rate.orphans) == (4, 2)


def test_null_user_flagged_not_null(spark):
    convs = spark.createDataFrame([conv_row(None, C0), conv_row("u", C0)], CONV_SCHEMA)
    r = quality.null_counts(convs, "int_conversions", ["conversion_id", "user_pseudo_id"]).collect()
    assert {x.column_name: x.failures for x in r} == {"conversion_id": 1, "user_pseudo_id": 1}


def test_sparse_trend_last_14_present_dates_zero_filled(spark):
    dates = [(dt.date(2024, 1, 1) + dt.timedelta(days=2 * i)).strftime("%Y%m%d") for i in range(20)]
    rows = []
    for i, d in enumerate(dates):
        rows.append(("first_click", d, "A", i + 1, 1.0))
        if i % 3 == 0:
            rows.append(("last_click", d, "A", 100, 1.0))
    daily = spark.createDataFrame(rows, DAILY_SCHEMA)
    out = sorted(reports.trend(daily, 14).collect(), key=lambda r: r.conversion_date)
    assert [r.conversion_date for r in out] == dates[-14:]
    assert all((r.last_click == 100) == (dates.index(r.conversion_date) % 3 == 0) for r in out)
    assert all(r.last_click in (0, 100) for r in out)
    assert out[0].chart_max == 100


def test_channel_compare_missing_side_is_zero(spark):
    cred = spark.createDataFrame(
        [("c1", "20240101", 5.0, "A", "first_click"), ("c1", "20240101", 5.0, "B", "last_click")],
        "conversion_id string, conversion_date string, purchase_revenue double, attributed_channel string, "
        "attribution_model string")
    cmp = {r.attributed_channel: r for r in reports.channel_compare(cred).collect()}
    assert (cmp["A"].lc_conversions, cmp["A"].lc_revenue) == (0, 0.0)
    assert (cmp["B"].fc_conversions, cmp["B"].fc_revenue) == (0, 0.0)
    scaled = {r.attributed_channel: r for r in reports.channel_scaled(reports.channel_compare(cred)).collect()}
    assert scaled["A"].fc_pct == 100.0 and scaled["B"].lc_pct == 100.0
    dis = reports.model_disagreement(cred).collect()
    assert [(r.first_channel, r.last_channel) for r in dis] == [("A", "B")]


def test_rowcount_flags_silent_day(spark):
    rows = [("first_click", (dt.date(2024, 1, 1) + dt.timedelta(days=i)).strftime("%Y%m%d"), "A", 1, 1.0)
            for i in range(10) if i != 8]
    out = {r.conversion_date: r for r in
           quality.rowcount_vs_trailing(spark.createDataFrame(rows, DAILY_SCHEMA), dt.date(2024, 1, 11)).collect()}
    assert out["20240109"].n_rows == 0 and out["20240109"].status == "fail"
    assert out["20240105"].status == "pass"


def test_daily_mart_counts_null_revenue(spark):
    cred = spark.createDataFrame(
        [("c1", "20240101", None, "A", "first_click"), ("c2", "20240101", 2.5, "A", "first_click")],
        "conversion_id string, conversion_date string, purchase_revenue double, attributed_channel string, "
        "attribution_model string")
    r = marts.channel_daily(cred).collect()[0]
    assert (r.conversions, r.revenue) == (2, 2.5)


def test_same_purchase_in_both_feeds(spark):
    from touchcredit.operators import journeys, staging
    from touchcredit.sources.schemas import RAW_BATCH, STREAM_FLAT
    us = C0
    raw = spark.createDataFrame([
        ("20240123", us - 100, "session_start", "u", [("ga_session_id", (None, 1))], ("google", "cpc", None), (None,)),
        ("20240123", us, "purchase", "u", [("ga_session_id", (None, 1))], (None, None, None), (12.5,)),
    ], RAW_BATCH)
    stream = spark.createDataFrame([("k1", "20240123", us, "purchase", "u", 1, None, None, None, 12.5, None)],
                                   STREAM_FLAT)
    stg = staging.stg_events(raw, stream)
    conv = journeys.conversions(stg)
    credited = cr.credit(journeys.touchpoints(stg), conv, 30 * DAY)
    assert credited.count() == 2  # one row per model
    assert quality.duplicate_keys(conv, "int_conversions", "conversion_id").count() == 1


def test_strict_conservation_uses_unrounded_totals(spark):
    daily = spark.createDataFrame([("first_click", "20240101", "A", 1, 10.0),
                                   ("last_click", "20240101", "B", 1, 10.0)], DAILY_SCHEMA)
    cred = spark.createDataFrame(
        [("c1", "20240101", 10.0, "A", "first_click"), ("c1", "20240101", 10.004, "B", "last_click")],
        "conversion_id string, conversion_date string, purchase_revenue double, attributed_channel string, "
        "attribution_model string")
    r = quality.revenue_conserved(daily, cred).collect()[0]
    assert r.ref_violation is False and r.strict_violation is False
    cred2 = cred.where("attribution_model = 'first_click'")
    assert quality.revenue_conserved(daily, cred2).collect()[0].strict_violation is True


def test_mart_checks_from_credit_relation(spark):
    cred = spark.createDataFrame(
        [("c1", "20240101", 5.0, "A", "first_click"), ("c1", "20240101", 5.0, "A", "first_click"),
         ("c2", "20240101", None, None, "last_click"), (None, "20240101", 1.0, "B", "last_click")],
        "conversion_id string, conversion_date string, purchase_revenue double, attributed_channel string, "
        "attribution_model string")
    nn = {(r.relation, r.column_name): r.failures for r in quality.not_null_credit(cred).collect()}
    assert nn[("mart_attribution_last_click", "attributed_channel")] == 1
    assert nn[("mart_attribution_last_click", "purchase_revenue")] == 1
    assert nn[("mart_attribution_last_click", "conversion_id")] == 1
    assert nn[("mart_attribution_first_click", "conversion_id")] == 0
    un = {r.relation: r.failures for r in quality.unique_credit(cred).collect()}
    assert un == {"mart_attribution_first_click": 1, "mart_attribution_last_click": 0}
