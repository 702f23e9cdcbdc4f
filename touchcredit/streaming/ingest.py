"""Idempotent ingest of the flat event stream.

Insert-only merge on ``event_id``: within a micro-batch one row per key
(earliest ``ingested_at``, then the other columns, so the choice is fixed),
then an anti-join against the keys already in the target, then an append.
A replayed batch, a resent file, or a retry after a crash between append and
checkpoint commit all find their keys present and add nothing: the key, not
the batch id, decides.

No watermark in front of the merge: it would drop late events, which the
streaming table accepts, and it would forget keys, which never expire here.

The target is Parquet partitioned by ``event_day``, the UTC day of
``event_timestamp``, for the readers that need some days. The key alone
decides, so a copy with another or no timestamp is a copy all the same: the
merge asks an index of all keys in hash buckets (``keyindex``), of which a batch
opens the buckets of its own keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchcredit.functions import columns as fc
from touchcredit.sources.schemas import STREAM_FLAT
from touchcredit.streaming import compact
from touchcredit.streaming.compact import stored
from touchcredit.streaming.keyindex import KEYS_PER_BUCKET, KeyIndex

TARGET_SCHEMA = T.StructType(list(STREAM_FLAT.fields) + [T.StructField("event_day", T.StringType())])
FLAT_COLUMNS = [f.name for f in STREAM_FLAT.fields]
_ORDER = ["ingested_at"] + [c for c in FLAT_COLUMNS if c not in ("event_id", "ingested_at")]


def one_per_key(rows: DataFrame, first_by: list[str] | None = None) -> DataFrame:
    """One row per ``event_id``: the smallest ``(first_by..., ingested_at,
    other columns)``. Aggregation with a map-side partial step, so a key
    sent many times never gathers in one task. NULL keys are dropped (the
    quality checks count them)."""
    first_by = first_by or []
    best = F.min(F.struct(*[F.col(c) for c in first_by + _ORDER])).alias("_r")
    return (rows.where(F.col("event_id").isNotNull())
            .groupBy("event_id").agg(best)
            .select("event_id", *[F.col(f"_r.{c}").alias(c) for c in _ORDER])
            .select(*FLAT_COLUMNS))


def dedupe_deliveries(deliveries: DataFrame) -> DataFrame:
    """Batch form of the whole stream: what the target holds after every
    delivery was merged in ``batch_id`` order (a key keeps the row of the
    first batch it arrived in)."""
    return one_per_key(deliveries, first_by=["batch_id"])


def replay_counts(deliveries: DataFrame) -> DataFrame:
    """A7 for every batch at once: rows in, rows new, rows skipped.

    A key is new in the first batch it arrives in; every other copy (same
    batch or later) is skipped."""
    first = deliveries.where(F.col("event_id").isNotNull()) \
        .groupBy("event_id").agg(F.min("batch_id").alias("batch_id"))
    new = first.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_new"))
    n_in = deliveries.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_in"))
    return (n_in.join(new, "batch_id", "left")
            .select("batch_id", "n_in", F.coalesce("n_new", F.lit(0)).cast("bigint").alias("n_new"))
            .withColumn("n_skipped", F.col("n_in") - F.col("n_new")))


def with_event_day(df: DataFrame) -> DataFrame:
    return df.withColumn("event_day", fc.micros_to_day("event_timestamp"))


def held_rows(spark: SparkSession, batch: DataFrame, target_path: str) -> DataFrame:
    """What the target holds for a merged batch's keys, of the days of the
    batch's own copies: every row the batch added, also in an earlier try,
    as the target has it. A copy that the merge skipped does not show."""
    days = sorted(r[0] for r in batch.select(fc.micros_to_day("event_timestamp")).distinct().collect() if r[0])
    keys = batch.select("event_id").distinct()
    return (stored(spark, target_path, TARGET_SCHEMA).where(F.col("event_day").isin(days))
            .join(keys, "event_id", "left_semi").select(*FLAT_COLUMNS))


def key_index(spark: SparkSession, target_path: str, keys_per_bucket: int = KEYS_PER_BUCKET) -> KeyIndex:
    """The index of the target's keys, beside it; made or mended here where that is needed."""
    def rows(days: list[str | None] | None) -> DataFrame:
        table = stored(spark, target_path, TARGET_SCHEMA)
        if days is not None:
            table = table.where(F.col("event_day").isin([d for d in days if d]) | (
                F.col("event_day").isNull() if None in days else F.lit(False)))
        return table.select("event_id")

    return KeyIndex(spark, f"{target_path}-keys", rows, keys_per_bucket)


def merge_batch(batch: DataFrame, target_path: str, keys_per_bucket: int = KEYS_PER_BUCKET) -> dict:
    """Merge one micro-batch into the target; return the A7 counters.

    Meant for ``foreachBatch``: the batch is persisted for the counts and
    the write, then released."""
    spark = batch.sparkSession
    index = key_index(spark, target_path, keys_per_bucket)
    batch = batch.select(*FLAT_COLUMNS).persist()
    try:
        n_in = batch.count()
        new = with_event_day(one_per_key(batch))
        new = new.join(index.seen(batch.select("event_id")), "event_id", "left_anti").persist()
        days = {r["event_day"]: r["count"] for r in new.groupBy("event_day").count().collect()}
        n_new = sum(days.values())
        if n_new:
            index.begin(sorted(days, key=str))
            new.write.mode("append").partitionBy("event_day").parquet(target_path)
            index.add(new.select("event_id"), n_new)
        new.unpersist()
        return {"n_in": n_in, "n_new": n_new, "n_skipped": n_in - n_new}
    finally:
        batch.unpersist()


def batch_jobs_adaptive(df: DataFrame) -> None:
    """Structured Streaming turns adaptive execution off in the session it
    clones for a query; the work inside ``foreachBatch`` is ordinary batch
    jobs (aggregates, anti-joins, writes), so turn it back on there: shuffle
    partitions are coalesced to the micro-batch's size."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def start_ingest(source: DataFrame, target_path: str, checkpoint_path: str,
                 metrics_path: str | None = None, trigger: dict | None = None):
    """``readStream`` frame -> idempotent target. Returns the StreamingQuery.

    Counters of each micro-batch are appended to ``metrics_path`` (one row
    per batch id; a retried batch appends again, readers keep the last)."""

    def _sink(df: DataFrame, batch_id: int) -> None:
        batch_jobs_adaptive(df)
        counts = merge_batch(df, target_path)
        if metrics_path:
            spark = df.sparkSession
            spark.createDataFrame(
                [(int(batch_id), counts["n_in"], counts["n_new"], counts["n_skipped"])],
                "batch_id bigint, n_in bigint, n_new bigint, n_skipped bigint",
            ).write.mode("append").parquet(metrics_path)

    w = source.writeStream.foreachBatch(_sink).option("checkpointLocation", checkpoint_path)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def read_target(spark: SparkSession, target_path: str) -> DataFrame:
    """The deduplicated streaming table (flat columns); no rows before the first merge."""
    return stored(spark, target_path, TARGET_SCHEMA).select(*FLAT_COLUMNS)


def compact_target(spark: SparkSession, target_path: str, **sizes: int) -> dict[str, int]:
    """Few files a day in place of one a micro-batch, with the merge going on beside it (``compact``)."""
    return compact.compact(spark, target_path, TARGET_SCHEMA, "event_day", "event_id", **sizes)
