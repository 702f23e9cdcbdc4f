"""Plan properties that matter at scale: no pair joins, no single-partition
exchanges in the credit path, pruned reads."""

from touchcredit.plans import catalogue

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_credit_has_no_pair_join_or_global_exchange(spark):
    p = catalogue.pipeline(spark, SF)
    plan = _plan(p.channel_daily)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in plan, bad
    # the credit join is an equi-join on (user, chunk) only
    assert "_chunk" in plan


def test_reads_prune_columns(spark):
    plan = _plan(catalogue.queries()["conversions"](spark, SF))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "props" not in scan.split("ReadSchema")[1]  # conversions never need props


def test_orphan_check_credits_last_click_only(spark):
    plan = _plan(catalogue.queries()["dq_orphans"](spark, SF))
    assert "first_click" not in plan


def test_merge_reads_keys_of_its_buckets_only(spark, scratch):
    import os

    from touchcredit.sources import events_adapter as ea
    from touchcredit.streaming import ingest
    target = os.path.join(scratch, "t")
    feed = ea.stream_deliveries(ea.load_events(spark, SF)).select(*ingest.FLAT_COLUMNS)
    ingest.merge_batch(feed, target)
    few = feed.limit(2).select("event_id")
    plan = _plan(ingest.key_index(spark, target).seen(few))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "bucket" in line][0]
    assert "PartitionFilters: [" in scan and "bucket" in scan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<event_id:string>" in scan
