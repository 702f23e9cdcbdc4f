"""Compaction of the appended tables, and the CSV reject table."""

import os

import pytest
from pyspark.sql import functions as F

from test_streaming import C0, DAY, _row
from touchcredit import config as C
from touchcredit.sources import csv_flat, published
from touchcredit.sources.schemas import STREAM_FLAT
from touchcredit.streaming import compact, ingest, live


def _batch(spark, keys, day=0):
    return spark.createDataFrame([_row(k, "purchase", "u", C0 + day * DAY + n, rev=1.0) for n, k in enumerate(keys)], STREAM_FLAT)


def _view(spark, target):
    return sorted(tuple(r) for r in ingest.read_target(spark, target).collect())


def _files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def _filled(spark, scratch):
    target = os.path.join(scratch, "t")
    for n in range(4):
        ingest.merge_batch(_batch(spark, [f"k{n}-{i}" for i in range(20)]), target)
    ingest.merge_batch(_batch(spark, ["other"], day=3), target)
    return target


def test_same_view_before_during_and_after(spark, scratch):
    target = _filled(spark, scratch)
    before, files = _view(spark, target), _files(target)
    pinned = ingest.read_target(spark, target)  # a reader that has listed its files
    done = ingest.compact_target(spark, target, least_files=3)
    assert done["days"] == 1 and done["files"] == files - _files(os.path.join(target, "event_day=" + _day_of(spark, target, "other")))
    assert _view(spark, target) == before and sorted(map(tuple, pinned.collect())) == before
    assert _files(target + compact.SIDE) == 1  # one file in place of all of that day's
    assert compact.vacuum(spark, target) == 0  # the last compaction's files stay for readers in flight
    # the merge goes on beside it: a replay adds nothing, a new key is seen
    assert ingest.merge_batch(_batch(spark, ["k1-3", "k2-4"]), target)["n_new"] == 0
    assert ingest.merge_batch(_batch(spark, ["new"]), target)["n_new"] == 1
    after = _view(spark, target)
    assert len(after) == len(before) + 1
    ingest.compact_target(spark, target, least_files=2)  # the compacted file and the new one
    assert compact.vacuum(spark, target) == done["files"]
    assert _view(spark, target) == after and _files(target) + _files(target + compact.SIDE) < files
    assert ingest.compact_target(spark, target, least_files=2) == {"days": 0, "files": 0}


def test_batches_of_several_days(spark, scratch):
    """One task writes files of the same name into several days: each is replaced and deleted by itself."""
    target = os.path.join(scratch, "t")
    for n in range(3):
        rows = _batch(spark, [f"a{n}-{i}" for i in range(5)])
        for day in range(1, 4 - n):
            rows = rows.unionByName(_batch(spark, [f"b{n}-{day}-{i}" for i in range(5)], day))
        ingest.merge_batch(rows.coalesce(1), target)
    before = _view(spark, target)
    assert len(before) == 45
    for least in (3, 2, 1, 1):
        ingest.compact_target(spark, target, least_files=least)
        assert _view(spark, target) == before
        compact.vacuum(spark, target)
        assert _view(spark, target) == before
    assert _files(target) == 0 and ingest.merge_batch(_batch(spark, ["a1-3"]), target)["n_new"] == 0


def _day_of(spark, target, key):
    return compact.stored(spark, target, ingest.TARGET_SCHEMA).where(F.col("event_id") == key).first()["event_day"]


def test_killed_compaction_changes_nothing(spark, scratch, monkeypatch):
    target = _filled(spark, scratch)
    before = _view(spark, target)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(published, "swap", killed)
        with pytest.raises(RuntimeError):
            ingest.compact_target(spark, target, least_files=2)
    assert _view(spark, target) == before
    ingest.compact_target(spark, target, least_files=2)
    compact.vacuum(spark, target)  # drops the generation that no manifest names
    assert _view(spark, target) == before and _files(target + compact.SIDE) == 1


def test_rows_are_dealt_over_files_and_null_days_kept(spark, scratch):
    target = os.path.join(scratch, "t")
    rows = ingest.with_event_day(_batch(spark, [f"k{i}" for i in range(300)])
                                 .withColumn("event_timestamp", F.when(F.col("event_id") != "k7", F.col("event_timestamp"))))
    for k in range(3):
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k).write.mode("append").partitionBy("event_day").parquet(target)
    before = _view_any(spark, target)
    assert compact.compact(spark, target, ingest.TARGET_SCHEMA, "event_day", "event_id", least_files=1, rows_per_file=100)["days"] == 2
    assert _view_any(spark, target) == before and len(before) == 300
    assert _files(target + compact.SIDE) >= 3


def _view_any(spark, target):
    return sorted((r.event_id, r.event_day or "") for r in compact.stored(spark, target, ingest.TARGET_SCHEMA).collect())


def test_credits_keep_the_latest_version(spark, scratch):
    path = os.path.join(scratch, "credit")
    for version in range(3):
        spark.createDataFrame([(f"c{i}", "20240101", 1.0, f"ch{version}", C.LAST_CLICK, 5, version, "20240101")
                               for i in range(version, 5)], live.CREDIT_SCHEMA).write.mode("append").partitionBy("credit_day").parquet(path)
    view = lambda: sorted(map(tuple, live.latest_credits(path, spark).collect()))
    before = view()
    live.compact_credits(spark, path, least_files=2)
    assert view() == before
    left = compact.stored(spark, path, live.CREDIT_SCHEMA)
    assert left.count() == 5 and left.agg(F.max("version")).first()[0] == 2


def test_absent_table(spark, scratch):
    path = os.path.join(scratch, "none")
    assert ingest.compact_target(spark, path) == {"days": 0, "files": 0} and compact.vacuum(spark, path) == 0
    assert ingest.read_target(spark, path).count() == 0


HEADER = ",".join(csv_flat.CSV_COLUMNS) + "\n"


def _write(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(HEADER + "".join(line + "\n" for line in lines))


def test_rejects_keep_the_line_and_say_why(spark, scratch):
    _write(scratch, "a.csv",
           '20240101,1000001,purchase,u1,7,"","",,12.5',  # quoted blanks
           "20240101,1000002,purchase,u1,7",  # torn
           "20240101,1000003,purchase,u1,7,s,m,c,1.0,more")
    _write(scratch, "b.csv",
           "20240101,soon,purchase,u2,7,s,m,c,1.0",
           "20240101,,purchase,u2,7,s,m,c,1.0",
           "20240101,1000004,purchase,u2,x7,s,m,c,1.0",
           "20240101,1000005,purchase,u2,,s,m,c,dear",
           '20240101,1000006,purchase,u2,,"a ""quoted"", one",m,c,""')
    good, bad = csv_flat.split(csv_flat.read_checked(spark, scratch))
    clean = {r.event_timestamp: r for r in csv_flat.clean(good).collect()}
    assert set(clean) == {1000001, 1000006}
    assert (clean[1000001].source, clean[1000001].medium, clean[1000001].campaign, clean[1000001].purchase_revenue) == (None, None, None, 12.5)
    assert clean[1000006].source == 'a "quoted", one' and clean[1000006].purchase_revenue is None and clean[1000006].ga_session_id is None
    rejected = bad.collect()
    assert sorted(r.reason for r in rejected) == ["event_timestamp", "event_timestamp", "fields", "fields", "ga_session_id", "purchase_revenue"]
    torn = next(r for r in rejected if r.event_timestamp == "1000002")
    assert torn.line == "20240101,1000002,purchase,u1,7" and torn.user_pseudo_id == "u1" and torn.source is None


def test_quoted_newlines_and_several_files(spark, scratch):
    for name in ("one", "two"):
        _write(os.path.join(scratch, name), "x.csv", '20240101,5,purchase,u,1,"two\nlines",m,c,1.0', "20240101,6,purchase,u,1,s,m,c,2.0")
    rows = csv_flat.read_checked(spark, [os.path.join(scratch, n) for n in ("one", "two")], quoted_newlines=True)
    good, bad = csv_flat.split(rows)
    assert sorted(r.source for r in good.collect()) == ["s", "s", "two\nlines", "two\nlines"] and bad.count() == 0
    # without it the halves are rejected, never taken for rows
    good, bad = csv_flat.split(csv_flat.read_checked(spark, os.path.join(scratch, "one")))
    assert [r.source for r in good.collect()] == ["s"] and bad.count() == 2
