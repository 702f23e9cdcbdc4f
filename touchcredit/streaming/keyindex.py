"""Index of the keys that a stream table holds, in hash buckets.

The merge asks which of a micro-batch's keys are known. Keys lie in ``2^depth`` buckets by their hash, one partition folder each, and
depth grows with the table (a bucket has about ``keys_per_bucket`` keys), so a micro-batch of m keys opens at most m
buckets of bounded size: what it reads does not grow with the table. Files carry Parquet Bloom filters on the key.

Order of writes: a mark in the index's pointer names the days that the batch will add to, then the rows are
appended to the table, then their keys to the index, then the mark goes. A crash in between leaves the
mark; the next merge then adds the keys of exactly those days that the index lacks. A table without an index (an
older one) is indexed whole, once. Keys are never forgotten and time plays no part, so replays, late
copies and copies without a time are found. One writer per table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.sources import published

KEYS_PER_BUCKET = 100_000
LEAST_DEPTH, MOST_DEPTH = 4, 20
SCHEMA = "event_id string, bucket int"


def bucket_of(depth: int) -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(1 << depth)).cast("int").alias("bucket")


class KeyIndex:
    """The index at ``path``; ``rows(days)`` gives the table's event_id column, of some days or (None) of all."""

    def __init__(self, spark: SparkSession, path: str, rows, keys_per_bucket: int = KEYS_PER_BUCKET):
        self.spark, self.path, self.rows, self.limit = spark, path, rows, keys_per_bucket
        self.state = published.pointer(spark, path)
        if self.state is None:
            self._rebuild(self.rows(None), None)
        elif self.state.get("pending") is not None:
            self._recover()

    # -- reading -----------------------------------------------------------------------------------------

    def _keys(self, buckets: list[int] | None = None) -> DataFrame:
        folder = f"{self.path}/{self.state['folder']}"
        if not published.exists(self.spark, folder):
            return self.spark.createDataFrame([], SCHEMA)
        keys = self.spark.read.schema(SCHEMA).parquet(folder)
        return keys if buckets is None else keys.where(F.col("bucket").isin(buckets))

    def seen(self, keys: DataFrame) -> DataFrame:
        """event_id of those of ``keys`` that the index holds. Reads the buckets of the keys only; their list
        is bounded by the number of buckets."""
        keys = keys.where("event_id is not null").select("event_id", bucket_of(self.state["depth"]))
        buckets = sorted(r["bucket"] for r in keys.select("bucket").distinct().collect())
        return self._keys(buckets).join(keys, ["bucket", "event_id"], "left_semi").select("event_id")

    # -- writing -----------------------------------------------------------------------------------------

    def _write(self, keys: DataFrame, folder: str, depth: int) -> None:
        (keys.select("event_id", bucket_of(depth)).repartition("bucket").sortWithinPartitions("bucket", "event_id")
         .write.mode("append").option("parquet.bloom.filter.enabled#event_id", "true").partitionBy("bucket")
         .parquet(f"{self.path}/{folder}"))

    def _swap(self, **changes) -> None:
        self.state = (self.state or {}) | changes
        published.swap(self.spark, self.path, self.state)

    def begin(self, days: list[str | None]) -> None:
        """Before rows of ``days`` go into the table."""
        self._swap(pending=days)

    def add(self, keys: DataFrame, n: int) -> None:
        """The keys of the rows that went in; takes the mark away."""
        self._write(keys, self.state["folder"], self.state["depth"])
        total = self.state["keys"] + n
        self._swap(keys=total, pending=None)
        if total > self.limit << self.state["depth"] and self.state["depth"] < MOST_DEPTH:
            self._rebuild(self._keys().select("event_id"), total)

    def _recover(self) -> None:
        left = self.rows(self.state["pending"]).where("event_id is not null").select("event_id").distinct()
        left = left.join(self.seen(left), "event_id", "left_anti").persist()
        self.add(left, left.count())
        left.unpersist()

    def _rebuild(self, keys: DataFrame, n: int | None) -> None:
        """All keys into a new folder of the depth that their number asks for, then the pointer to it."""
        keys = keys.where("event_id is not null").select("event_id").distinct()
        n = keys.count() if n is None else n
        depth = LEAST_DEPTH
        while n > (self.limit << depth) // 4 and depth < MOST_DEPTH:
            depth += 1
        folder = published.new_folder()
        if n:
            self._write(keys, folder, depth)
        self._swap(folder=folder, before=(self.state or {}).get("folder"), depth=depth, keys=n, pending=None)

    def compact(self) -> None:
        """Rewrite the index with one file a bucket (each batch adds a small one to the buckets it touches)."""
        self._rebuild(self._keys().select("event_id"), self.state["keys"])
        published.retire(self.spark, self.path)
