"""Raw batch export: writer and trailing-window scans.

The export is stored as Parquet partitioned by ``event_date`` ('yyyyMMdd'),
the analogue of daily shards. A window filter on the partition column, with
constant bounds, is pruned at planning time: only the shards inside the
window are listed and read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.sources.schemas import RAW_BATCH


def window_bounds(as_of: _dt.date, days: int) -> tuple[str, str]:
    """Both ends inclusive: ``as_of - days`` .. ``as_of`` as 'yyyyMMdd'."""
    lo = as_of - _dt.timedelta(days=int(days))
    return lo.strftime("%Y%m%d"), as_of.strftime("%Y%m%d")


def window_predicate(as_of: _dt.date | None, days: int | None, col: str = "event_date") -> Column | None:
    if as_of is None or days is None:
        return None
    lo, hi = window_bounds(as_of, days)
    return F.col(col).between(F.lit(lo), F.lit(hi))


def write_export(raw: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a raw batch frame as date shards. ``overwrite`` uses dynamic
    partition overwrite so a re-export of some days leaves the others."""
    # No repartition by date: a day can be far larger than one task; every
    # task writes its own files into the day folders it touches.
    (raw.select(*[f.name for f in RAW_BATCH.fields])
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path))


def read_export(spark: SparkSession, path: str, as_of: _dt.date | None = None,
                days: int | None = 60) -> DataFrame:
    """S1 (trailing ``days`` up to ``as_of``, partition-pruned) or S2
    (full history when ``as_of`` or ``days`` is None). The source path is an
    argument (S9: same models on another dataset)."""
    df = spark.read.schema(RAW_BATCH).parquet(path)
    pred = window_predicate(as_of, days)
    return df if pred is None else df.where(pred)


def restrict_window(raw: DataFrame, as_of: _dt.date | None, days: int | None) -> DataFrame:
    """Apply the trailing window to an already loaded raw frame."""
    pred = window_predicate(as_of, days)
    return raw if pred is None else raw.where(pred)


def write_days(spark: SparkSession, path: str) -> None:
    """``<path>-days``: one row for each day the export holds, with its number of events (counted from file footers).
    To be renewed after each ``write_export``."""
    (spark.read.schema(RAW_BATCH).parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n_rows"))
     .write.mode("overwrite").parquet(f"{path}-days"))


def trailing_days(spark: SparkSession, path: str, days: int) -> DataFrame:
    """The days (``event_date``) of the export from ``days`` before the newest one it holds on; events without a
    date are in none."""
    held = spark.read.schema("event_date string, n_rows bigint").parquet(f"{path}-days")
    newest = held.agg(F.max("event_date")).scalar()
    first = F.date_format(F.date_sub(F.to_date(newest, "yyyyMMdd"), int(days)), "yyyyMMdd")
    return held.where(F.col("event_date") >= first).select("event_date")


def read_trailing(spark: SparkSession, path: str, days: int = 60) -> DataFrame:
    """S1 without a stated ``as_of``: the trailing window ends with the newest day of the export. The window is a relation
    that only running the query can tell, so the scan is pruned then: the join with the days becomes a dynamic filter
    on the partition column, and days outside are not listed for reading."""
    return spark.read.schema(RAW_BATCH).parquet(path).join(trailing_days(spark, path, days), "event_date", "left_semi")
