"""Structured Streaming ingest: replay is a no-op, restart adds nothing,
late events are kept, counters match the batch form, refresh equals batch."""

import os

from pyspark.sql import functions as F

from touchcredit.operators import marts
from touchcredit.plans.pipeline import Pipeline, driver_inputs
from touchcredit.sources import events_adapter as ea
from touchcredit.sources.schemas import STREAM_FLAT
from touchcredit.streaming import ingest, live
from touchcredit.streaming.source import flat_event_stream, write_delivery_files

SF = "/root/testdata/sf0.001"
COLS = [f.name for f in STREAM_FLAT.fields]


def _deliveries(spark):
    return ea.stream_deliveries(ea.load_events(spark, SF))


def _run(spark, src_glob, target, ckpt, metrics=None, max_files=None):
    q = ingest.start_ingest(flat_event_stream(spark, src_glob, max_files_per_trigger=max_files),
                            target, ckpt, metrics)
    q.awaitTermination()


def test_ingest_replay_and_restart(spark, scratch):
    d = _deliveries(spark)
    incoming = os.path.join(scratch, "in")
    write_delivery_files(d, incoming)
    target, ckpt, metrics = (os.path.join(scratch, x) for x in ("target", "ckpt", "metrics"))
    _run(spark, f"{incoming}/batch_id=*/*.parquet", target, ckpt, metrics, max_files=5)
    t = ingest.read_target(spark, target)
    expect = ingest.dedupe_deliveries(d)
    assert t.count() == expect.count() == t.select("event_id").distinct().count()
    assert t.select(*COLS).exceptAll(expect.select(*COLS)).count() == 0
    m = spark.read.parquet(metrics)
    tot = m.agg(F.sum("n_in"), F.sum("n_new")).first()
    assert tot[0] == d.count() and tot[1] == expect.count()

    # restart on the same checkpoint: nothing new to read, nothing added
    _run(spark, f"{incoming}/batch_id=*/*.parquet", target, ckpt, metrics, max_files=5)
    assert ingest.read_target(spark, target).count() == expect.count()

    # the whole feed sent again as new files (a full replay): 0 new rows
    again = os.path.join(scratch, "in2")
    write_delivery_files(d, again)
    _run(spark, f"{again}/batch_id=*/*.parquet", target, os.path.join(scratch, "ckpt2"))
    assert ingest.read_target(spark, target).count() == expect.count()


def test_retry_of_same_batch_is_noop(spark, scratch):
    d = _deliveries(spark).select(*COLS)
    target = os.path.join(scratch, "target")
    first = ingest.merge_batch(d, target)
    second = ingest.merge_batch(d, target)
    assert first["n_new"] == d.select("event_id").distinct().count()
    assert first["n_skipped"] == first["n_in"] - first["n_new"]
    assert second["n_new"] == 0 and second["n_skipped"] == second["n_in"]


def test_late_event_is_ingested(spark, scratch):
    d = _deliveries(spark).select(*COLS)
    target = os.path.join(scratch, "target")
    ingest.merge_batch(d, target)
    newest = d.agg(F.max("event_timestamp")).first()[0]
    late = d.limit(1).withColumn("event_timestamp", F.lit(newest - 10 * 86_400_000_000)) \
        .withColumn("event_id", F.lit("late000000000000"))
    r = ingest.merge_batch(late, target)
    assert r["n_new"] == 1
    assert ingest.read_target(spark, target).where("event_id = 'late000000000000'").count() == 1


def test_replay_counts_match_streaming_counters(spark):
    counts = ingest.replay_counts(_deliveries(spark)).collect()
    assert all(r.n_in == r.n_new + r.n_skipped for r in counts)
    assert sum(r.n_new for r in counts) == ea.load_events(spark, SF).count()


def test_refresh_equals_batch(spark, scratch):
    inputs = driver_inputs(spark, SF, split_feeds=True)
    paths = live.refresh_marts(inputs.batch_raw, inputs.stream_table, os.path.join(scratch, "marts"))
    written = spark.read.parquet(paths["channel_daily"])
    batch = Pipeline(driver_inputs(spark, SF)).channel_daily
    cols = marts.DAILY_KEYS + ["conversions", "revenue"]
    assert written.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert written.count() == batch.count()


def test_live_credit_equals_batch_for_streamed_conversions(spark):
    import duckdb

    import __spark_entry__ as ent
    got = ent.queries()["stream_attribution"](spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    want = con.execute(ent.oracle_sql()["stream_attribution"]).df()
    key = ["conversion_id", "attribution_model"]
    g = got.sort_values(key).reset_index(drop=True)
    w = want[list(got.columns)].sort_values(key).reset_index(drop=True)
    assert len(g) == len(w) > 0
    assert (g.fillna(-1).values == w.fillna(-1).values).all()


def test_stop_mid_stream_and_restart(spark, scratch):
    import time

    d = _deliveries(spark)
    incoming = os.path.join(scratch, "in")
    write_delivery_files(d, incoming)
    target, ckpt = os.path.join(scratch, "target"), os.path.join(scratch, "ckpt")
    src = f"{incoming}/batch_id=*/*.parquet"
    q = ingest.start_ingest(flat_event_stream(spark, src, max_files_per_trigger=3), target, ckpt,
                            trigger={"processingTime": "1 second"})
    deadline = time.time() + 120
    while time.time() < deadline and (q.lastProgress is None or q.lastProgress.get("batchId", -1) < 1):
        time.sleep(0.5)
    q.stop()  # stopped part-way: some files done, the rest pending
    partial = ingest.read_target(spark, target).count()
    expect = ingest.dedupe_deliveries(d)
    assert 0 < partial < expect.count()
    _run(spark, src, target, ckpt, max_files=3)  # restart from the checkpoint
    t = ingest.read_target(spark, target)
    assert t.count() == expect.count() == t.select("event_id").distinct().count()


def test_late_touchpoint_recredits_live(spark, scratch):
    """A conversion credited (or orphaned) before a touchpoint that should
    win it arrives is re-credited when that touchpoint arrives."""
    import datetime as dt

    from touchcredit.config import AttributionConfig
    from touchcredit.operators import journeys, staging
    from touchcredit.sources.schemas import RAW_BATCH

    day = 86_400_000_000
    c0 = 1_706_000_000_000_000
    ts = dt.datetime(2024, 1, 20)

    def row(key, name, user, us, src=None, med=None, rev=None):
        return (key, "20240123", us, name, user, 1, src, med, None, rev, ts)
    target, credits = os.path.join(scratch, "target"), os.path.join(scratch, "credits")
    empty = staging.stg_events(spark.createDataFrame([], RAW_BATCH))
    touch_t, conv_t = journeys.touchpoints(empty), journeys.conversions(empty)
    cfg = AttributionConfig(lookback_days=30)
    b1 = spark.createDataFrame([
        row("k1", "session_start", "u", c0 - 5 * day, "early", "cpc"),
        row("k2", "purchase", "u", c0, rev=10.0),
        row("k3", "purchase", "w", c0, rev=3.0),        # orphan for now
    ], STREAM_FLAT)
    for version, batch in ((0, b1),):
        ingest.merge_batch(batch, target)
        live.credit_micro_batch(spark, ingest.one_per_key(batch), touch_t, conv_t, target, credits, cfg, version)
    now = {(r.conversion_id, r.attribution_model): r.attributed_channel
           for r in live.latest_credits(credits, spark).collect()}
    assert now[(f"u-{c0}", "last_click")] == "early / cpc" and (f"w-{c0}", "last_click") not in now
    b2 = spark.createDataFrame([
        row("k4", "session_start", "u", c0 - day, "late", "email"),    # later than 'early', before c0
        row("k5", "session_start", "w", c0 - 2 * day, "wlate", "social"),
    ], STREAM_FLAT)
    ingest.merge_batch(b2, target)
    live.credit_micro_batch(spark, ingest.one_per_key(b2), touch_t, conv_t, target, credits, cfg, 1)
    live.credit_micro_batch(spark, ingest.one_per_key(b2), touch_t, conv_t, target, credits, cfg, 1)  # retry
    now = {(r.conversion_id, r.attribution_model): r.attributed_channel
           for r in live.latest_credits(credits, spark).collect()}
    assert now[(f"u-{c0}", "last_click")] == "late / email"
    assert now[(f"u-{c0}", "first_click")] == "early / cpc"
    assert now[(f"w-{c0}", "last_click")] == "wlate / social"
    assert spark.read.parquet(credits).count() == 2 + 1 + 2  # first pass, changed last click, new orphan credit


DAY = 86_400_000_000
C0 = 1_706_000_000_000_000


def _row(key, name, user, us, src=None, med=None, rev=None):
    import datetime as dt
    return (key, "20240123", us, name, user, 1, src, med, None, rev, dt.datetime(2024, 1, 20))


def _journeys(spark, rows=()):
    from touchcredit.operators import journeys, staging
    stg = staging.flatten_stream(spark.createDataFrame(list(rows), STREAM_FLAT))
    return journeys.touchpoints(stg), journeys.conversions(stg)


def _live(spark, scratch, batches, touch, conv):
    """Each batch merged and credited, as the stream's sink does; the live view."""
    from touchcredit.config import AttributionConfig
    target, credits = os.path.join(scratch, "target"), os.path.join(scratch, "credits")
    for batch in batches:
        df = spark.createDataFrame(batch, STREAM_FLAT)
        ingest.merge_batch(df, target)
        live.credit_micro_batch(spark, ingest.held_rows(spark, df, target), touch, conv, target, credits,
                                AttributionConfig(lookback_days=30))
    return {(r.conversion_id, r.attribution_model): r for r in live.latest_credits(credits, spark).collect()}


def test_skipped_copy_does_not_change_credit(spark, scratch):
    touch, conv = _journeys(spark)
    first = [_row("k1", "session_start", "u", C0 - DAY, "s", "m"), _row("k2", "purchase", "u", C0, rev=10.0)]
    now = _live(spark, scratch, [first, [_row("k2", "purchase", "u", C0, rev=99.0)]], touch, conv)
    assert {r.purchase_revenue for r in now.values()} == {10.0} and len(now) == 2


def test_stated_day_does_not_prune_known_rows(spark, scratch):
    """The batch feed's day follows its own zone, here a day early; the credit goes by time."""
    touch, conv = _journeys(spark, [_row("b1", "session_start", "u", C0 - 30 * DAY, "edge", "m")])
    touch = touch.withColumn("touch_date", F.lit("20231223"))
    now = _live(spark, scratch, [[_row("k2", "purchase", "u", C0, rev=1.0)]], touch, conv)
    assert {r.attributed_channel for r in now.values()} == {"edge / m"} and len(now) == 2


def test_versions_go_on_after_a_new_checkpoint(spark, scratch):
    touch, conv = _journeys(spark)
    batches = [[_row("k1", "session_start", "u", C0 - 5 * DAY, "early", "m"), _row("k2", "purchase", "u", C0, rev=None)],
               [_row("k3", "session_start", "u", C0 - 3 * DAY, "later", "m")],
               [_row("k4", "session_start", "u", C0 - DAY, "latest", "m")]]
    now = _live(spark, scratch, batches, touch, conv)
    assert now[(f"u-{C0}", "last_click")].attributed_channel == "latest / m"
    versions = spark.read.parquet(os.path.join(scratch, "credits")).groupBy("attribution_model").agg(F.count("*").alias("n"))
    assert {r.attribution_model: r.n for r in versions.collect()} == {"first_click": 1, "last_click": 3}


def test_key_alone_decides(spark, scratch):
    """A key without a time, or sent again with another time, is stored once."""
    target = os.path.join(scratch, "target")
    assert ingest.read_target(spark, target).count() == 0  # absent: empty
    batch = spark.createDataFrame([_row("n", "purchase", "u", None), _row("m", "purchase", "u", C0)], STREAM_FLAT)
    assert ingest.merge_batch(batch, target)["n_new"] == 2
    again = spark.createDataFrame([_row("n", "purchase", "u", None), _row("m", "purchase", "u", C0 + 9 * DAY)], STREAM_FLAT)
    assert ingest.merge_batch(again, target) == {"n_in": 2, "n_new": 0, "n_skipped": 2}
    assert ingest.read_target(spark, target).count() == 2
