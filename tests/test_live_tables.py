"""The key index of the merge, published versions, the stream's orphan log and its daily mart."""

import os

import pytest
from pyspark.sql import functions as F

from test_streaming import C0, DAY, _journeys, _row
from touchcredit.config import AttributionConfig
from touchcredit.operators import credit as cr
from touchcredit.operators import marts
from touchcredit.sources import published
from touchcredit.sources.schemas import STREAM_FLAT
from touchcredit.streaming import ingest, keyindex, live


def _batch(spark, keys, day=0, us=None):
    return spark.createDataFrame([_row(k, "purchase", "u", C0 + day * DAY + n if us is None else us(n), rev=1.0)
                                  for n, k in enumerate(keys)], STREAM_FLAT)


def test_a_batch_opens_the_buckets_of_its_keys_only(spark, scratch):
    target = os.path.join(scratch, "t")
    for n in range(4):  # grows over several depths
        assert ingest.merge_batch(_batch(spark, [f"k{n}-{i}" for i in range(400)], n), target, keys_per_bucket=20)["n_new"] == 400
    index = ingest.key_index(spark, target, 20)
    assert index.state["keys"] == 1600 <= 20 << index.state["depth"] and index.state["depth"] > keyindex.LEAST_DEPTH
    seen = index.seen(_batch(spark, ["k2-7", "new"]))
    assert [r.event_id for r in seen.collect()] == ["k2-7"]
    scans = [line for line in seen._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line]
    assert scans and all("PartitionFilters: [" in s and "bucket" in s.split("PartitionFilters")[1] for s in scans)
    # what a batch of one key reads is bounded by the bucket's size, at any size of the table
    sizes = index._keys().groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert sizes <= 3 * 20
    index.compact()
    assert ingest.merge_batch(_batch(spark, [f"k1-{i}" for i in range(400)], 9), target, 20)["n_new"] == 0


@pytest.mark.parametrize("day", [0, None])
def test_crash_between_table_and_index_adds_nothing_twice(spark, scratch, monkeypatch, day):
    target = os.path.join(scratch, "t")
    ingest.merge_batch(_batch(spark, ["a", "b"]), target)
    batch = _batch(spark, ["b", "c", "d"], us=(lambda n: None) if day is None else None)

    def fails(self, keys, n):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(keyindex.KeyIndex, "add", fails)
        with pytest.raises(RuntimeError):
            ingest.merge_batch(batch, target)
    assert ingest.key_index(spark, target).state["pending"] is None  # mended
    assert ingest.merge_batch(batch, target)["n_new"] == 0
    assert sorted(r.event_id for r in ingest.read_target(spark, target).collect()) == ["a", "b", "c", "d"]


def test_crash_before_the_table_is_written_loses_nothing(spark, scratch):
    target = os.path.join(scratch, "t")
    ingest.merge_batch(_batch(spark, ["a"]), target)
    ingest.key_index(spark, target).begin(["20240123"])
    assert ingest.merge_batch(_batch(spark, ["a", "z"]), target) == {"n_in": 2, "n_new": 1, "n_skipped": 1}


def test_table_without_an_index_is_indexed(spark, scratch):
    target = os.path.join(scratch, "t")
    ingest.with_event_day(_batch(spark, ["a", "b"])).write.partitionBy("event_day").parquet(target)
    assert ingest.merge_batch(_batch(spark, ["b", "c"]), target)["n_new"] == 1


def test_killed_rebuild_leaves_the_published_mart(spark, scratch):
    root = os.path.join(scratch, "mart")
    with pytest.raises(ValueError):
        published.read(spark, root)
    published.publish(spark, root, lambda p: marts.write_mart(spark.range(3), p))
    pinned = published.current(spark, root)

    def killed(path):
        marts.write_mart(spark.range(99), path)
        raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        published.publish(spark, root, killed)
    assert published.read(spark, root).count() == 3 and published.current(spark, root) == pinned
    published.publish(spark, root, lambda p: marts.write_mart(spark.range(5), p))
    assert published.read(spark, root).count() == 5
    assert spark.read.parquet(pinned).count() == 3  # a reader in flight keeps its version
    assert published.retire(spark, root) == 1  # the killed rebuild's folder
    published.publish(spark, root, lambda p: marts.write_mart(spark.range(6), p))
    assert published.retire(spark, root) == 1 and published.read(spark, root).count() == 6


def _step(spark, scratch, rows, touch, conv):
    paths = {k: os.path.join(scratch, k) for k in ("target", "credits", "orphans", "daily")}
    df = spark.createDataFrame(rows, STREAM_FLAT)
    ingest.merge_batch(df, paths["target"])
    held = ingest.held_rows(spark, df, paths["target"])
    live.credit_micro_batch(spark, held, touch, conv, paths["target"], paths["credits"], AttributionConfig(lookback_days=30),
                            orphan_path=paths["orphans"], daily_path=paths["daily"])
    return paths


def test_orphans_and_daily_mart_follow_the_stream(spark, scratch):
    touch, conv = _journeys(spark)
    batches = [
        [_row("c1", "purchase", "u", C0, rev=10.0), _row("c2", "purchase", "w", C0 + DAY, rev=2.5), _row("n", "purchase", None, C0)],
        [_row("t1", "session_start", "u", C0 - DAY, "s", "m")],  # late: credits c1
        [_row("t1", "session_start", "u", C0 - DAY, "s", "m")],  # sent again
        [_row("t2", "session_start", "u", C0 - 40 * DAY, "s", "m"), _row("c3", "purchase", "w", C0 + 5 * DAY, rev=1.0)],
        [_row("t3", "session_start", "w", C0, "w", "m"), _row("t4", "session_start", "u", C0 - 100, "x", "m")],
    ]
    want = [{f"u-{C0}", f"w-{C0 + DAY}"}, {f"w-{C0 + DAY}"}, {f"w-{C0 + DAY}"}, {f"w-{C0 + DAY}", f"w-{C0 + 5 * DAY}"}, set()]
    for batch, orphans in zip(batches, want, strict=True):
        paths = _step(spark, scratch, batch, touch, conv)
        assert {r.conversion_id for r in live.live_orphans(paths["orphans"], spark).collect()} == orphans
        full = marts.channel_daily(live.latest_credits(paths["credits"], spark).select(*cr.MART_COLUMNS)) \
            if os.path.exists(paths["credits"]) else None
        got = live.live_daily(paths["daily"], spark)
        assert sorted(map(tuple, got.collect())) == (sorted(map(tuple, full.select(*got.columns).collect())) if full else [])
    log = spark.read.parquet(paths["orphans"])
    assert log.count() == 6  # three became orphans, three were withdrawn; the copy added nothing
    assert log.where("not orphan").count() == 3


def test_only_touched_days_are_rewritten(spark, scratch):
    touch, conv = _journeys(spark)
    paths = _step(spark, scratch, [_row("t", "session_start", "u", C0 - DAY, "s", "m"), _row("a", "purchase", "u", C0, rev=1.0),
                                   _row("b", "purchase", "u", C0 + 20 * DAY, rev=2.0)], touch, conv)

    def files():
        return {d: sorted(os.listdir(os.path.join(paths["daily"], d))) for d in os.listdir(paths["daily"]) if "=" in d}
    before = files()
    _step(spark, scratch, [_row("c", "purchase", "u", C0 + 20 * DAY + 7, rev=4.0)], touch, conv)
    after = files()
    assert len(before) == 2 and sum(before[d] != after[d] for d in before) == 1
    assert live.live_daily(paths["daily"], spark).agg(F.sum("conversions")).first()[0] == 6


def test_one_odd_time_adds_its_own_days():
    near = live._spread({"20240101", "00010101"}, before_us=2 * DAY, after_us=DAY)
    assert near == ["00010101", "00010102", "20231230", "20231231", "20240101", "20240102"]
