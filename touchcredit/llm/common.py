"""Helpers the operators share: the shared folder, cutting lineage, tables, folds, words of a batch."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the NumPy helpers take at once; a longer document is taken whole, alone.
SLICE_BYTES = 2 << 20
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder's path below ``spark.checkpoint.dir``.

    Without that setting a local session (tests) gets a temporary folder; a cluster raises, since
    executors and the driver there share no local disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _local.get(sc.applicationId)
        if base is None:
            base = _local[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: send it along, once a session, unless PYTHONPATH names its folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if sc.applicationId in _shipped or root in map(os.path.abspath, os.environ.get("PYTHONPATH", "").split(os.pathsep)):
        return
    to = os.path.join(tempfile.mkdtemp(prefix="llm-package-"), "touchcredit")
    sc.addPyFile(shutil.make_archive(to, "zip", root, "touchcredit"))
    _shipped.add(sc.applicationId)


def cut(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, a lost executor costs no recomputation."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about ``limit`` bytes together, one row at least."""
    text = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pc.fill_null(pc.binary_length(text), 0)).astype(np.int64)
    run = np.cumsum(sizes) // max(1, limit)
    cuts = np.flatnonzero(np.diff(run)) + 1
    start = 0
    for end in [*cuts.tolist(), len(sizes)]:
        if end > start:
            yield batch.slice(start, end - start)
        start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each row's offsets in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 2 + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BYTE_CODE = mix(np.arange(256, dtype=np.uint64), 7)
BASE = np.uint64(0xD6E8FEB86659FD93)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """BASE and its inverse modulo 2^64 to the powers 0 to n - 1 at least, kept for the next batch."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for k, base in enumerate((BASE, inverse)):
                _powers[k] = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size, base))])
    return _powers


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, by a rolling polynomial: a few operations a byte."""
    n = len(raw)
    p, inverse = powers(n + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_CODE[raw] * p[:n], dtype=np.uint64)])
        value = (sums[ends] - sums[starts]) * inverse[starts]
        return mix(value + (ends - starts).astype(np.uint64))


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes other than space and \\t to \\r; a run ends with its row."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1
