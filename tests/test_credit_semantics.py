"""Hand-written fixtures for the boundary, tie, NULL and duplicate rules."""

import datetime as dt

import pytest

from conftest import CONV_SCHEMA, DAY, TOUCH_SCHEMA, conv_row
from touchcredit import config as C
from touchcredit.operators.credit import credit

L = 30 * DAY
C0 = 1_706_000_000_000_000  # a conversion time


def run(spark, touches, convs, lookback=L, chunk_us=3_600_000_000):
    t = spark.createDataFrame(touches, TOUCH_SCHEMA)
    c = spark.createDataFrame(convs, CONV_SCHEMA)
    rows = credit(t, c, lookback, chunk_us=chunk_us).collect()
    return {(r.conversion_id, r.attribution_model): r for r in rows}


@pytest.mark.parametrize("chunk", [3_600_000_000, 1, 7 * DAY, 10 ** 12])
def test_edge_low_inclusive(spark, chunk):
    out = run(spark, [("u", 1, C0 - L, "A"), ("u", 2, C0 - L - 1, "B")], [conv_row("u", C0)], chunk_us=chunk)
    assert out[(f"u-{C0}", C.FIRST_CLICK)].attributed_channel == "A"
    assert out[(f"u-{C0}", C.LAST_CLICK)].attributed_channel == "A"


@pytest.mark.parametrize("chunk", [3_600_000_000, 1, 7 * DAY])
def test_edge_high_inclusive(spark, chunk):
    out = run(spark, [("u", 1, C0, "A"), ("u", 2, C0 + 1, "B"), ("u", 3, C0 - 5, "Z")],
              [conv_row("u", C0)], chunk_us=chunk)
    assert out[(f"u-{C0}", C.LAST_CLICK)].attributed_channel == "A"
    assert out[(f"u-{C0}", C.FIRST_CLICK)].attributed_channel == "Z"


def test_dst_lookback_is_elapsed_time(spark):
    # Conversion shortly after the March 2024 clock change in New York; the
    # touch is exactly 30 * 24 h earlier. A zoned "30 days" would span 1 h less.
    c_us = int(dt.datetime(2024, 3, 20, 12, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = run(spark, [("u", 1, c_us - L, "A")], [conv_row("u", c_us)])
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert out[(f"u-{c_us}", C.FIRST_CLICK)].attributed_channel == "A"


def test_tie_session(spark):
    out = run(spark, [("u", 9, C0 - 10, "NINE"), ("u", 7, C0 - 10, "SEVEN")], [conv_row("u", C0)])
    assert out[(f"u-{C0}", C.FIRST_CLICK)].attributed_channel == "SEVEN"
    assert out[(f"u-{C0}", C.LAST_CLICK)].attributed_channel == "NINE"


def test_tie_null_session(spark):
    out = run(spark, [("u", None, C0 - 10, "NULLSID"), ("u", 5, C0 - 10, "FIVE")], [conv_row("u", C0)])
    assert out[(f"u-{C0}", C.FIRST_CLICK)].attributed_channel == "NULLSID"
    assert out[(f"u-{C0}", C.LAST_CLICK)].attributed_channel == "FIVE"


def test_tie_full_is_stable(spark):
    touches = [("u", 4, C0 - 10, "B"), ("u", 4, C0 - 10, "A")]
    for _ in range(2):
        out = run(spark, touches, [conv_row("u", C0)])
        assert out[(f"u-{C0}", C.FIRST_CLICK)].attributed_channel == "A"
        assert out[(f"u-{C0}", C.LAST_CLICK)].attributed_channel == "B"


def test_direct_is_valid_last_click(spark):
    out = run(spark, [("u", 1, C0 - 100, "google / cpc"), ("u", 2, C0 - 50, "(direct) / (none)")],
              [conv_row("u", C0)])
    assert out[(f"u-{C0}", C.LAST_CLICK)].attributed_channel == "(direct) / (none)"
    assert out[(f"u-{C0}", C.FIRST_CLICK)].attributed_channel == "google / cpc"


def test_orphans_get_no_row(spark):
    out = run(spark, [("v", 1, C0 - L - 1, "OLD")], [conv_row("u", C0), conv_row("v", C0)])
    assert out == {}


def test_null_user_never_joins(spark):
    out = run(spark, [(None, 1, C0 - 10, "A"), ("u", 2, C0 - 10, "B")], [conv_row(None, C0)])
    assert out == {}


def test_duplicate_conversion_one_row_per_model(spark):
    convs = [conv_row("u", C0, revenue=5.0), conv_row("u", C0, revenue=7.0)]
    out = run(spark, [("u", 1, C0 - 10, "A")], convs)
    assert len(out) == 2
    # the same conversion row is credited by both models (revenue conserved)
    assert {r.purchase_revenue for r in out.values()} == {7.0}


def test_null_revenue_counts(spark):
    out = run(spark, [("u", 1, C0 - 10, "A")], [conv_row("u", C0, revenue=None)])
    assert len(out) == 2 and all(r.purchase_revenue is None for r in out.values())


def test_touch_after_conversion_not_used_by_first_click(spark):
    # the earliest touch at or after c - L is after c: no first-click credit,
    # and no last-click credit either (no touch at or before c)
    out = run(spark, [("u", 1, C0 + 10, "LATE")], [conv_row("u", C0)])
    assert out == {}


def test_many_conversions_share_history(spark):
    touches = [("u", i, C0 - i * DAY, f"T{i}") for i in range(1, 40)]
    convs = [conv_row("u", C0 - k * DAY // 2) for k in range(0, 10)]
    out = run(spark, touches, convs, chunk_us=DAY)
    for k in range(10):
        c = C0 - k * DAY // 2
        lo = c - L
        eligible = [t for t in touches if lo <= t[2] <= c]
        assert out[(f"u-{c}", C.FIRST_CLICK)].attributed_channel == min(eligible, key=lambda t: t[2])[3]
        assert out[(f"u-{c}", C.LAST_CLICK)].attributed_channel == max(eligible, key=lambda t: t[2])[3]


def test_single_scan_credit_equals_two_frame_credit(spark):
    from touchcredit.operators import journeys, staging
    from touchcredit.operators.credit import credit_events
    from touchcredit.sources import events_adapter as ea
    stg = staging.stg_events(ea.raw_batch(ea.load_events(spark, "/root/testdata/sf0.001")))
    a = credit(journeys.touchpoints(stg), journeys.conversions(stg), 7 * DAY)
    b = credit_events(stg, 7 * DAY)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0
