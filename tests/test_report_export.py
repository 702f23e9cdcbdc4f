"""The report as a dataset of ordered JSON lines (S8), and the export scan pruned by a relation."""

import glob
import json
import os

import pytest

from touchcredit.operators import reports as rp
from touchcredit.plans import catalogue
from touchcredit.sources import batch as batch_src
from touchcredit.sources import events_adapter as ea
from touchcredit.sources.schemas import RAW_BATCH

SF = "/root/testdata/sf0.001"
LIVE = ("event_id string, event_name string, user_pseudo_id string, source string, medium string, "
        "purchase_revenue double, ingested_at string")


def frames(spark, channels=3000):
    models = ("first_click", "last_click")
    totals = spark.createDataFrame([(m, 7, 1.5) for m in models], "attribution_model string, conversions bigint, revenue double")
    rows = [(m, f"c{i:05d}", i % 5, None if i % 100 == 0 else float(i * 7 % 90)) for m in models for i in range(channels)]
    breakdown = spark.createDataFrame(rows, "attribution_model string, attributed_channel string, conversions bigint, revenue double")
    daily = spark.createDataFrame(
        [(m, d, c, 1, 2.0) for m in models for d in ("20240102", "20240101", None) for c in ("b", "a \"x\"\nand more", None)],
        "attribution_model string, conversion_date string, attributed_channel string, conversions bigint, revenue double")
    live = spark.createDataFrame(
        [("k2", "page_view", "u", None, None, None, "2024-01-01T00:00:01.000001"),
         ("k1", "page_view", "u", None, None, 2.5, "2024-01-01T00:00:01.000001"),
         ("k3", "page_view", "u", None, None, None, "2024-01-01T00:00:01.000002")], LIVE)
    return totals, breakdown, daily, rp.trend(daily.where("conversion_date is not null"), 14), live


def section(path, name):
    """A section's lines, its files taken by name."""
    files = sorted(glob.glob(os.path.join(path, f"section={name}", "part-*")))
    return files, [json.loads(line) for f in files for line in open(f, encoding="utf-8").read().splitlines()]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_files_by_name_hold_each_section_in_order(spark, scratch, adaptive):
    path = os.path.join(scratch, "report")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        totals, breakdown, daily, trend, live = frames(spark)
        rp.write_report(rp.report_lines(totals, breakdown, daily, trend, live, "2024-01-31"), path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files, got = section(path, "channel_breakdown")
    key = lambda r: (r["attribution_model"], -(float("-inf") if r["revenue"] is None else r["revenue"]), r["attributed_channel"])
    assert got == sorted((r.asDict() for r in breakdown.collect()), key=key)
    if adaptive == "false":
        assert len(files) > 1  # dealt to several tasks, still in order by name
    _, got = section(path, "channel_daily")
    low = lambda v: (v is not None, v or "")  # noqa: E731 - nulls first, as Spark sorts them
    want = sorted((r.asDict() for r in daily.collect()),
                  key=lambda r: (low(r["conversion_date"]), r["attribution_model"], low(r["attributed_channel"])))
    assert got == want
    assert [r["event_id"] for r in section(path, "live_events")[1]] == ["k3", "k1", "k2"]
    assert [r["conversion_date"] for r in section(path, "trend")[1]] == ["20240101", "20240102"]
    assert section(path, "meta")[1] == [{"generated_at": "2024-01-31"}]


def test_report_reads_back_what_was_written(spark, scratch):
    path = os.path.join(scratch, "report")
    totals, breakdown, daily, trend, live = frames(spark, 10)
    rp.write_report(rp.report_lines(totals, breakdown, daily, trend, live, "x"), path)
    back = rp.read_report(spark, path)
    for name, rows in {"totals": totals, "channel_breakdown": breakdown, "channel_daily": daily, "trend": trend, "live_events": live}.items():
        got = back.where(back.section == name).select(*rows.columns)
        assert got.exceptAll(rows).count() == 0 and got.count() == rows.count()


def test_report_of_empty_relations_is_its_meta_line(spark, scratch):
    path = os.path.join(scratch, "report")
    parts = [f.where("1 = 0") for f in frames(spark, 1)]
    rp.write_report(rp.report_lines(*parts, "x"), path)
    assert [(r.section, r.generated_at) for r in rp.read_report(spark, path).collect()] == [("meta", "x")]


def _export(spark, scratch):
    path = os.path.join(scratch, "export")
    batch_src.write_export(ea.raw_batch(ea.load_events(spark, SF)), path)
    batch_src.write_days(spark, path)
    return path


def test_trailing_window_prunes_the_export_at_run_time(spark, scratch):
    path = _export(spark, scratch)
    read = batch_src.read_trailing(spark, path, 3)
    plan = read._sc._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "formatted")
    assert "dynamicpruning" in [line for line in plan.splitlines() if line.startswith("PartitionFilters")][0]
    # days outside the window are not opened: damage a file of one and read on
    days = sorted(d for d in os.listdir(path) if d.startswith("event_date="))
    broken = glob.glob(os.path.join(path, days[0], "part-*.parquet"))[0]
    open(broken, "wb").write(b"not parquet at all")
    got = batch_src.read_trailing(spark, path, 3)
    assert sorted({r.event_date for r in got.select("event_date").collect()}) == [d[-8:] for d in days[-4:]]


def test_trailing_window_edges(spark, scratch):
    path = _export(spark, scratch)
    whole = spark.read.schema(RAW_BATCH).parquet(path)
    assert batch_src.read_trailing(spark, path, 10_000).count() == whole.count()
    newest = whole.agg({"event_date": "max"}).first()[0]
    assert batch_src.read_trailing(spark, path, 0).count() == whole.where(whole.event_date == newest).count()
    # an export without a day holds nothing in any window; one row without a date is in none
    none = os.path.join(scratch, "none")
    batch_src.write_export(whole.where("event_name = 'purchase'").limit(1).selectExpr(
        "cast(null as string) event_date", *[f.name for f in RAW_BATCH.fields if f.name != "event_date"]), none)
    batch_src.write_days(spark, none)
    assert batch_src.read_trailing(spark, none, 60).count() == 0


def test_report_query_runs_over_all_days(spark):
    got = catalogue.queries()["report_bundle"](spark, SF)
    daily = catalogue.queries()["channel_daily"](spark, SF)
    assert got.where("section = 'channel_daily'").count() == daily.count()
