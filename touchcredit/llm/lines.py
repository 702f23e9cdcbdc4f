"""Line dedup with two Bloom filters.

A line's key is the line stripped of space and \\t to \\r, with A-Z lower-cased. The first pass puts the
hash of every document's distinct keys into a filter of hashes seen once and, when it is there already,
into one of hashes seen twice. Tasks fill their own pair of filters; pairs merge bit by bit, where a bit
that both have once counts as seen twice. So a key of two documents is always in the second filter.
Filters are merged in segments, each by a reduce task. Only lines found in the second filter are shuffled,
where their keys are counted exactly and, for first-occurrence dedup, their first place is chosen.

The filters are a bounded table (``filter_bytes`` each, sent to the tasks), whatever the input. Beyond
their room more lines are suspected and shuffled; results are the same.

Defined results: null or empty text is one empty line; a key shorter than ``min_chars`` is never
counted or dropped; rows of equal doc_id count as one document (null too), and each keeps its own
lines; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchcredit.llm.common import cut, mix, table

MIN_CHARS = 1
MIN_DOCS = 10
FILTER_BYTES = 4 << 20
SEGMENT_BYTES = 1 << 16
#: A key is sent to the rows, not shuffled with them, if more than one in so many pairs of line and document is its.
COMMON = 1000
PROBES = 4
STRIP = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = str.maketrans(UPPER, LOWER)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIP)), UPPER, LOWER)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def places(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """PROBES bit places of each hash."""
    h = hashes.astype(np.int64).view(np.uint64)
    return np.stack([mix(h, salt) % np.uint64(n_bits) for salt in range(11, 11 + PROBES)])


def _fill(n_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(n_bytes * 8, bool), np.zeros(n_bytes * 8, bool)
        for batch in batches:
            h, n = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            at = places(h, n_bytes * 8)
            again = once[at].all(axis=0) | (n > 1)
            # keys of one batch that share all their places
            twice[at[:, again].ravel()] = True
            once[at.ravel()] = True
        a, b = np.packbits(once), np.packbits(twice)
        for s in range(0, n_bytes, SEGMENT_BYTES):
            if a[s : s + SEGMENT_BYTES].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int64()), pa.array([a[s : s + SEGMENT_BYTES].tobytes()], pa.binary()),
                     pa.array([b[s : s + SEGMENT_BYTES].tobytes()], pa.binary())], ["segment", "once", "twice"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a segment; holds one pair of segments at a time for each segment of its partition."""
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for s, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            once, twice = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            if s in seen:
                o, t = seen[s]
                seen[s] = o | once, t | twice | (o & once)
            else:
                seen[s] = once, twice
    for s, (o, t) in seen.items():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([o.tobytes()], pa.binary()),
                                          pa.array([t.tobytes()], pa.binary())], ["segment", "once", "twice"])


def build_filters(keys: DataFrame, n_bytes: int = FILTER_BYTES) -> np.ndarray:
    """Bits of hashes seen at least twice; ``keys`` has one bigint column, a row for each key of each document.

    The result has ``n_bytes`` whatever the input; the driver only puts its segments side by side.
    """
    schema = "segment bigint, once binary, twice binary"
    pairs = keys.mapInArrow(_fill(n_bytes), schema)
    merged = pairs.repartition("segment").mapInArrow(_merge, schema).select("segment", "twice")
    bits = np.zeros(n_bytes, np.uint8)
    for s, b in merged.toLocalIterator():
        bits[s : s + len(b)] = np.frombuffer(b, np.uint8)
    return np.unpackbits(bits).astype(bool)


def _suspects(bits) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool)
        for batch in batches:
            h = batch.column(batch.schema.get_field_index("h")).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(twice[places(h, len(twice))].all(axis=0)))

    return run


def suspected(lines: DataFrame, n_bytes: int = FILTER_BYTES) -> DataFrame:
    """Rows of ``lines`` (with a bigint column ``h``, one row a key and document) whose hash may be there twice."""
    spark = lines.sparkSession
    bits = spark.sparkContext.broadcast(np.packbits(build_filters(lines.select("h"), n_bytes)).tobytes())
    return lines.mapInArrow(_suspects(bits), lines.schema)


def document_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, key, h: one row for each distinct key of a row of documents."""
    keys = F.array_distinct(F.transform(split_lines(F.col("text")), line_key))
    keys = docs.select("doc_id", F.explode(keys).alias("key"))
    if min_chars > 0:
        keys = keys.where(F.length("key") >= min_chars)
    return keys.withColumn("h", F.xxhash64("key"))


def frequent_keys(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                  n_bytes: int = FILTER_BYTES) -> DataFrame:
    """doc_id, key of every key that ``min_docs`` documents or more have. ``min_docs`` must be 2 or more."""
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more: the filters hold what is seen twice")
    maybe = cut(suspected(document_keys(docs, min_chars), n_bytes).select("doc_id", "key"))
    # distinct pairs first, then counts: both combine before the shuffle, so one very common line is no hot group
    pairs = maybe.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    often = cut(pairs.groupBy("key").agg(F.sum("one").alias("n")).where(F.col("n") >= min_docs))
    # going back to the documents, a very common line would be: those with more than a share of all pairs are fewer
    # than its inverse, whatever the input, and are sent to the rows; all others meet theirs in a shuffle
    total = often.agg(F.sum("n")).first()[0] or 0
    common = F.col("n") * COMMON > total
    hot, rest = (F.broadcast(often.where(common).select("key")), often.where(~common).select("key"))
    found = maybe.join(hot, "key", "left_semi").unionByName(
        maybe.join(hot, "key", "left_anti").join(rest, "key", "left_semi"))
    return found.select("doc_id", "key").distinct()


def _without(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    """The lines of each text whose key is not among its drops, and the number of the others; one look-up a line."""
    left, dropped = [], []
    for text, drop in zip(texts, drops, strict=True):
        if drop is None:
            left.append(None)
            dropped.append(0)
            continue
        lines, gone = (text or "").split("\n"), set(drop)
        kept = [x for x in lines if x.strip(STRIP).translate(_LOWER) not in gone]
        left.append("\n".join(kept))
        dropped.append(len(lines) - len(kept))
    return pd.DataFrame({"left": left, "dropped": dropped})


def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                        n_bytes: int = FILTER_BYTES) -> DataFrame:
    """``docs`` with ``kept`` (its other lines, joined by \\n), ``n_lines`` and ``n_dropped``."""
    drops = (frequent_keys(docs, min_docs, min_chars, n_bytes)
             .groupBy(F.col("doc_id").alias("__d")).agg(F.collect_set("key").alias("__drop")))
    rows = docs.drop("kept", "n_lines", "n_dropped")
    joined = rows.join(drops, rows["doc_id"].eqNullSafe(drops["__d"]), "left")
    text = F.coalesce("text", F.lit(""))
    # texts that lose nothing do not go to Python
    without = F.pandas_udf(_without, "left string, dropped int")
    cleaned = joined.withColumn("__c", without(F.when(F.col("__drop").isNotNull(), text), F.col("__drop")))
    return cleaned.select(*rows.columns, F.coalesce("__c.left", text).alias("kept"),
                          (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n_lines"),
                          F.col("__c.dropped").alias("n_dropped"))


def first_occurrences(docs: DataFrame, min_chars: int = MIN_CHARS, n_bytes: int = FILTER_BYTES) -> DataFrame:
    """key, doc_id: the first document (smallest id, null last) of every key that more than one has."""
    maybe = suspected(document_keys(docs, min_chars), n_bytes).select("doc_id", "key")
    found = maybe.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("__last"),
                                     F.max(F.col("doc_id").isNull()).alias("__null"))
    return found.where("doc_id <> __last or (__null and doc_id is not null)").select("key", "doc_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_frequent_lines(docs)
    return out.select("doc_id", F.col("n_lines").cast("long"), F.col("n_dropped").cast("long"),
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = r"""
with d as (select row_number() over () r, doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
l as (select r, doc_id, unnest(ls) line, generate_subscripts(ls, 1) i from d),
k as (select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k from l),
f as (select k from k where length(k) >= 1 group by k having count(distinct coalesce(doc_id, -9223372036854775807)) >= 10)
select any_value(doc_id) doc_id, count(*)::bigint n_lines, count(f.k)::bigint n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (f.k is null), '')) kept_sha256
from k left join f on k.k = f.k group by r
"""
