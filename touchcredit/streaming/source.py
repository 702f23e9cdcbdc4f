"""Stream source of flat events (S5): a file source with an explicit
schema. A message bus (Kafka) is the production swap; the rest of the
streaming code only needs a streaming DataFrame with the flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchcredit.sources.schemas import STREAM_FLAT


def flat_event_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """``path`` may be a glob (e.g. ``dir/*/*.parquet`` for one folder per
    delivered batch)."""
    r = spark.readStream.schema(STREAM_FLAT).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path)


FILES_PER_BATCH = 4


def write_delivery_files(deliveries: DataFrame, path: str, order_col: str = "batch_id") -> None:
    """Write the deliveries as one folder per batch (``order_col=value``) in
    a single job, then, on a local file system, stamp the folders' files
    with increasing modification times in batch order: the file source
    takes the oldest files first. Test and demo helper that replays a
    derived feed as arriving files."""
    import os

    from pyspark.sql import functions as F

    cols = [f.name for f in STREAM_FLAT.fields]
    # up to FILES_PER_BATCH files per batch folder: no batch lands whole in one task
    spread = F.pmod(F.xxhash64("event_id"), F.lit(FILES_PER_BATCH))
    deliveries.select(*cols, order_col).repartition(F.col(order_col), spread) \
        .write.mode("overwrite").partitionBy(order_col).parquet(path)
    local = path[len("file:"):] if path.startswith("file:") else path
    if not local.startswith("/"):
        return  # not a local file system: arrival order is the writer's
    path = local
    folders = sorted(d for d in os.listdir(path) if d.startswith(f"{order_col}="))
    base = 1_600_000_000
    for i, d in enumerate(folders):
        full = os.path.join(path, d)
        for name in os.listdir(full):
            os.utime(os.path.join(full, name), (base + 10 * i, base + 10 * i))
