"""The production batch run writes marts equal to the lazy pipeline."""

import datetime as dt
import os

from touchcredit.config import AttributionConfig
from touchcredit.operators import marts
from touchcredit.plans import catalogue
from touchcredit.plans.run import read_outputs, run_batch
from touchcredit.sources import batch as batch_src
from touchcredit.sources import events_adapter as ea
from touchcredit.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_run_batch_matches_catalogue(spark, scratch):
    ev = ea.load_events(spark, SF)
    export = os.path.join(scratch, "export")
    batch_src.write_export(ea.raw_batch(ev, "batch"), export)
    target = os.path.join(scratch, "stream_table")
    ingest.merge_batch(ea.stream_deliveries(ev, "streaming").select(*ingest.FLAT_COLUMNS), target)
    cfg = AttributionConfig(lookback_days=30, as_of=dt.date(2024, 1, 31), batch_window_days=60)
    out = read_outputs(spark, run_batch(spark, export, target, cfg, os.path.join(scratch, "out")))
    want = catalogue.queries()["channel_daily"](spark, SF)
    cols = marts.DAILY_KEYS + ["conversions", "revenue"]
    assert out["mart_channel_daily"].select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert out["mart_channel_daily"].count() == want.count()
    s = {r.check_name: r for r in out["dq_summary"].collect()}
    assert s["accepted_values:stg_events.event_name"].status == "fail"  # 'error' events planted
    assert s["revenue_conserved"].status == "pass"
    assert s["unique:mart_attribution_last_click.conversion_id"].failures == 0


def test_scale_conf_grows_with_input():
    from touchcredit.session import scale_conf
    small = scale_conf(10 * 1024 ** 3)
    big = scale_conf(100 * 1024 ** 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) > 100_000
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_run_batch_writes_report_bundle(spark, scratch):
    ev = ea.load_events(spark, SF)
    export = os.path.join(scratch, "export")
    batch_src.write_export(ea.raw_batch(ev), export)
    cfg = AttributionConfig(lookback_days=30, as_of=dt.date(2024, 1, 31), batch_window_days=60)
    paths = run_batch(spark, export, None, cfg, os.path.join(scratch, "out"))
    rows = read_outputs(spark, paths)["report_bundle"].collect()
    assert {r.attribution_model for r in rows if r.section == "totals"} == {"first_click", "last_click"}
    assert "live_events" not in {r.section for r in rows}
    assert sum(r.section == "channel_daily" for r in rows) == spark.read.parquet(paths["mart_channel_daily"]).count()


def test_run_csv_matches_export_pipeline(spark, scratch):
    from touchcredit.operators import staging
    from touchcredit.plans.run import run_csv
    from touchcredit.sources import csv_flat
    ev = ea.load_events(spark, SF)
    csv_path = os.path.join(scratch, "events_csv")
    csv_flat.write_csv(staging.stg_events(ea.raw_batch(ev)), csv_path)
    cfg = AttributionConfig(lookback_days=30)
    out = read_outputs(spark, run_csv(spark, csv_path, cfg, os.path.join(scratch, "csv_out")))
    want = catalogue.queries()["channel_daily"](spark, SF)
    cols = marts.DAILY_KEYS + ["conversions", "revenue"]
    assert out["mart_channel_daily"].select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert out["mart_channel_daily"].count() == want.count()
    assert out["disagreement_sample"].count() == 5


def test_batch_outputs_feed_the_live_credit(spark, scratch):
    from touchcredit.operators import credit as cr
    from touchcredit.streaming import live
    from touchcredit.streaming.source import flat_event_stream, write_delivery_files
    ev = ea.load_events(spark, SF)
    export = os.path.join(scratch, "export")
    batch_src.write_export(ea.raw_batch(ev, "batch"), export)
    cfg = AttributionConfig(lookback_days=30, as_of=dt.date(2024, 1, 31), batch_window_days=60)
    paths = run_batch(spark, export, None, cfg, os.path.join(scratch, "out"))
    incoming = os.path.join(scratch, "in")
    write_delivery_files(ea.stream_deliveries(ev, "streaming"), incoming)
    q = live.start_live_credit(
        flat_event_stream(spark, f"{incoming}/batch_id=*/*.parquet", max_files_per_trigger=40),
        spark.read.parquet(paths["touchpoints"]), spark.read.parquet(paths["conversions"]),
        os.path.join(scratch, "stream_table"), os.path.join(scratch, "credits"),
        os.path.join(scratch, "ckpt"), cfg)
    q.awaitTermination()
    got = live.latest_credits(os.path.join(scratch, "credits"), spark).select(*cr.MART_COLUMNS)
    want = catalogue.queries()["attribution_first_click_30d"](spark, SF).unionByName(
        catalogue.queries()["attribution_last_click_30d"](spark, SF))
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0  # every live credit equals the full batch credit
