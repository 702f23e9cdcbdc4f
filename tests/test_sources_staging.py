"""Sources (export with partition pruning, CSV) and staging rules."""

import datetime as dt
import os

from pyspark.sql import functions as F

from touchcredit import config as C
from touchcredit.operators import journeys, staging
from touchcredit.sources import batch as batch_src
from touchcredit.sources import csv_flat
from touchcredit.sources import events_adapter as ea
from touchcredit.sources.schemas import RAW_BATCH

SF = "/root/testdata/sf0.001"


def raw_row(params, traffic=(None, None, None), name="session_start", us=1_704_100_000_000_000,
            user="u1", revenue=None, date="20240101"):
    p = None if params is None else [(k, (s, i)) for k, s, i in params]
    return (date, us, name, user, p, traffic, (revenue,))


def test_mixed_fallback_per_field(spark):
    raw = spark.createDataFrame([raw_row([("source", "news", None)], traffic=("tsrc", "tmed", "tname"))], RAW_BATCH)
    r = staging.flatten_batch(raw).collect()[0]
    assert (r.source, r.medium, r.campaign) == ("news", "tmed", "tname")
    tp = journeys.touchpoints(staging.stg_events(raw)).collect()[0]
    assert tp.channel == "news / tmed"


def test_duplicate_param_key_first_wins_and_is_counted(spark):
    raw = spark.createDataFrame([raw_row([("ga_session_id", None, 5), ("source", "first", None),
                                          ("source", "second", None)])], RAW_BATCH)
    r = staging.flatten_batch(raw).collect()[0]
    assert r.source == "first" and r.ga_session_id == 5
    look = staging.param_lookup(raw).collect()[0]
    assert look.has_repeated_key is True


def test_no_params_gives_null_session_and_defaults(spark):
    raw = spark.createDataFrame([raw_row([]), raw_row(None, us=1_704_100_000_000_001)], RAW_BATCH)
    tps = journeys.touchpoints(staging.stg_events(raw)).collect()
    assert [t.ga_session_id for t in tps] == [None, None]
    assert {t.channel for t in tps} == {"(direct) / (none)"}


def test_union_keeps_both_feeds(spark):
    ev = ea.load_events(spark, SF)
    raw = ea.raw_batch(ev, "batch")
    stream = ea.stream_rows(ev, "streaming")
    stg = staging.stg_events(raw, stream)
    n_all = ev.count()
    assert stg.count() == n_all
    assert stg.where(F.col("_source") == C.STREAM_TAG).count() == ev.where("event_id % 10 = 0").count()


def test_export_window_prunes_partitions(spark, scratch):
    ev = ea.load_events(spark, SF)
    path = os.path.join(scratch, "export")
    batch_src.write_export(ea.raw_batch(ev), path)
    full = batch_src.read_export(spark, path, None, None)
    win = batch_src.read_export(spark, path, dt.date(2024, 1, 31), 14)
    assert full.count() == ev.count()
    days = {r.event_date for r in win.select("event_date").distinct().collect()}
    assert min(days) >= "20240117" and max(days) <= "20240131"
    plan = win.where(F.col("event_name") == "purchase")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "EqualTo(event_name,purchase)" in plan


def test_csv_empty_fields_become_null_then_defaults(spark, scratch):
    path = os.path.join(scratch, "events.csv")
    with open(path, "w") as f:
        f.write(",".join(csv_flat.CSV_COLUMNS) + "\n")
        f.write("20240101,1704100000000000,session_start,u1,7,,,,\n")
        f.write("20240101,1704100000000001,purchase,u1,7,google,cpc,,12.5\n")
        f.write("20240101,junk,purchase,u1,7,google,cpc,,not-a-number\n")
    rows = csv_flat.clean(csv_flat.read_csv(spark, path)).orderBy("event_timestamp").collect()
    assert rows[0].event_timestamp is None and rows[0].purchase_revenue is None  # junk line survives as NULLs
    first = rows[1]
    assert (first.source, first.medium, first.campaign, first.purchase_revenue) == (None, None, None, None)
    assert rows[2].purchase_revenue == 12.5
    assert abs(rows[2].event_ts_seconds - 1704100000.000001) < 1e-6
    stg = csv_flat.clean(csv_flat.read_csv(spark, path)).withColumn("event_ts", F.timestamp_micros("event_timestamp"))
    tp = journeys.touchpoints(stg).collect()
    assert tp[0].channel == "(direct) / (none)"


def test_csv_roundtrip_matches_staging(spark):
    ev = ea.load_events(spark, SF)
    stg = staging.stg_events(ea.raw_batch(ev))
    back = csv_flat.clean(csv_flat.parse_lines(csv_flat.to_csv_lines(stg)))
    cols = ["event_date", "event_timestamp", "event_name", "user_pseudo_id", "ga_session_id",
            "source", "medium", "campaign", "purchase_revenue"]
    assert back.select(*cols).exceptAll(stg.select(*cols)).count() == 0
    assert back.count() == stg.count()


def test_mapped_feeds_have_the_declared_schemas(spark):
    from touchcredit.sources.schemas import RAW_BATCH, STREAM_FLAT

    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]
    ev = ea.load_events(spark, SF)
    assert shape(ea.raw_batch(ev).schema) == shape(RAW_BATCH)
    assert shape(ea.stream_rows(ev).schema) == shape(STREAM_FLAT)
