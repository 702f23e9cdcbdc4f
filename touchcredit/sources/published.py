"""Versioned folders behind a pointer.

A table is written whole into a folder of its own; a small pointer file then names that folder, swapped in by one
atomic rename. A reader asks for the pointer once and stays with the folder it names: a rebuild that is
killed leaves an unnamed folder and the old table, a rebuild that ends changes what the next reader sees. Old versions stay
until ``retire`` drops them, so that readers in flight keep their files.

The pointer is JSON: ``folder`` (relative to the root) and whatever the writer adds. One writer per root.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path, so that any store Spark knows will do."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def pointer(spark: SparkSession, root: str) -> dict | None:
    """What the pointer says; None before the first publication."""
    fs, p = _fs(spark, f"{root}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def swap(spark: SparkSession, root: str, value: dict) -> None:
    """Make ``value`` the pointer, in one rename."""
    sc = spark.sparkContext
    fs, draft = _fs(spark, f"{root}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    hadoop = sc._jvm.org.apache.hadoop.fs
    overwrite = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    overwrite[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    context.rename(draft, hadoop.Path(f"{root}/{POINTER}"), overwrite)


def new_folder() -> str:
    return f"v-{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, write: Callable[[str], None], **also) -> str:
    """``write`` a new version into the folder it is given, then point to it. Returns the folder's path."""
    folder = new_folder()
    write(f"{root}/{folder}")
    before = pointer(spark, root)
    swap(spark, root, {"folder": folder, "before": before and before["folder"], **also})
    return f"{root}/{folder}"


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the published version: pin it, read it as often as needed."""
    now = pointer(spark, root)
    return now and f"{root}/{now['folder']}"


def read(spark: SparkSession, root: str) -> DataFrame:
    """The published table, as of now."""
    path = current(spark, root)
    if path is None:
        raise ValueError(f"nothing is published at {root}")
    return spark.read.parquet(path)


def retire(spark: SparkSession, root: str) -> int:
    """Drop all folders but the published one and the one before it (also those of killed rebuilds); how many."""
    now = pointer(spark, root)
    fs, p = _fs(spark, root)
    gone = 0
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if now and status.isDirectory() and name.startswith("v-") and name not in (now["folder"], now.get("before")):
            fs.delete(status.getPath(), True)
            gone += 1
    return gone
