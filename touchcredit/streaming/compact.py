"""Compaction of the tables that micro-batches append to.

Every micro-batch adds small files to the days it touches. ``compact`` rewrites the days that hold many into
few files of a side folder, ``<table>-files/generation=.../<day>=...``, and then swaps a manifest in, in one rename: it
names the files that were replaced and the generations that count. ``stored`` reads the table's own files less the
replaced ones, and those generations. So a reader sees the same rows before, during and after; a compaction that is
killed leaves a generation that no manifest names. Files that were appended meanwhile are in no list and stay as
they are. ``vacuum`` deletes what an earlier compaction than the last replaced, so that readers in flight keep
their files; the manifest holds the names of two compactions at most.

One compaction or vacuum at a time for a table; appends may go on beside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchcredit.sources import published

SIDE = "-files"
GENERATION = "generation"
#: Days that one run rewrites; what is left is for the next run.
DAYS_A_RUN = 366
#: A file's name alone will not do: one task gives its files of several days the same name.
PATH = "_metadata.file_path"


def _start() -> dict:
    return {"number": 0, "generations": [], "replaced": {}}


def _parts(spark: SparkSession, path: str, schema: T.StructType, state: dict | None) -> list[DataFrame]:
    """The table's own files that count, and the compacted ones; each with its ``_metadata``."""
    try:
        own = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if state is None:
        return [own]
    both = [own]
    if state["generations"]:
        wide = T.StructType([*schema.fields, T.StructField(GENERATION, T.StringType())])
        both.append(spark.read.schema(wide).parquet(f"{path}{SIDE}").where(F.col(GENERATION).isin(state["generations"])))
    gone = list(state["replaced"])
    return [p.where(~F.col(PATH).isin(gone)) for p in both] if gone else both


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, compacted or not; without rows where nothing was written yet."""
    columns = [f.name for f in schema.fields]
    # the manifest before the files: what it does not name yet is still there
    parts = [p.select(*columns) for p in _parts(spark, path, schema, published.pointer(spark, f"{path}{SIDE}"))]
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _day(day: str) -> Column:
    return F.coalesce(F.col(day), F.lit(""))


def compact(spark: SparkSession, path: str, schema: T.StructType, day: str, key: str,
            keep: Callable[[DataFrame], DataFrame] | None = None, least_files: int = 8,
            rows_per_file: int = 2_000_000) -> dict[str, int]:
    """Rewrite the days with ``least_files`` files or more; how many days and files were replaced.

    ``keep`` drops rows that no view of the table shows (older versions). A day's rows are dealt over its
    new files by a hash of ``key``, a file for each ``rows_per_file`` of them, so that a hot day is no single task."""
    root = f"{path}{SIDE}"
    state = published.pointer(spark, root) or _start()
    parts = _parts(spark, path, schema, state)
    columns = [f.name for f in schema.fields]
    if not parts:
        return {"days": 0, "files": 0}
    # the parts' file lists are fixed here: what is counted is what is rewritten
    files = None
    for p in parts:
        seen = p.groupBy(_day(day).alias("d"), F.col(PATH).alias("path")).agg(F.count(F.lit(1)).alias("n"))
        files = seen if files is None else files.unionByName(seen)
    days = files.groupBy("d").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("n")) \
        .where(F.col("files") >= least_files).orderBy("d").limit(DAYS_A_RUN).collect()
    if not days:
        return {"days": 0, "files": 0}
    chosen = [r["d"] for r in days]
    old = files.where(F.col("d").isin(chosen)).select("path").collect()  # file names of those days, no rows
    rows = None
    for p in parts:
        part = p.where(_day(day).isin(chosen)).select(*columns)
        rows = part if rows is None else rows.unionByName(part)
    if keep is not None:
        rows = keep(rows).select(*columns)
    into = F.create_map(*[F.lit(x) for r in days for x in (r["d"], -(-r["n"] // rows_per_file))])
    salt = F.pmod(F.xxhash64(key), F.element_at(into, _day(day)))
    generation = f"{state['number'] + 1}-{uuid.uuid4().hex[:12]}"
    rows.withColumn("__salt", salt).repartition(day, "__salt").drop("__salt") \
        .write.option("maxRecordsPerFile", rows_per_file).partitionBy(day).parquet(f"{root}/{GENERATION}={generation}")
    number = state["number"] + 1
    replaced = state["replaced"] | {r["path"]: number for r in old}
    published.swap(spark, root, {"number": number, "generations": [*state["generations"], generation], "replaced": replaced})
    return {"days": len(days), "files": len(old)}


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the files that were replaced before the last compaction, and what killed ones left; how many files."""
    root = f"{path}{SIDE}"
    state = published.pointer(spark, root)
    if state is None:
        return 0
    jvm = spark.sparkContext._jvm
    fs, top = published._fs(spark, root)
    gone = {path for path, number in state["replaced"].items() if number < state["number"]}
    for old in gone:
        # file_path is an encoded URI
        fs.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(old)), False)

    def holds_data(generation: str) -> bool:
        found = fs.listFiles(jvm.org.apache.hadoop.fs.Path(f"{root}/{GENERATION}={generation}"), True)
        while found.hasNext():
            if found.next().getPath().getName().endswith(".parquet"):
                return True
        return False

    live = [g for g in state["generations"] if holds_data(g)]
    published.swap(spark, root, {"number": state["number"], "generations": live,
                                 "replaced": {k: v for k, v in state["replaced"].items() if k not in gone}})
    for status in fs.listStatus(top):
        name = status.getPath().getName()
        if name.startswith(f"{GENERATION}=") and name.split("=", 1)[1] not in live:
            fs.delete(status.getPath(), True)
    return len(gone)
