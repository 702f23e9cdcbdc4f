"""Importance resampling towards a target, with hashed n-gram features and segment deduplication.

Words never cross a newline, so a text's features (runs of 1 to ``ORDERS`` words) are those within its lines and
those that cross from line to line. Every distinct line of the corpus has its features counted once, times
its occurrences; cross-line runs are counted apart, from the words beside line ends only. A feature's bucket is the crc32 of its bytes modulo
the number of buckets: registers of words are computed byte by byte for all words at once, and the register
of a run from those of its words, since crc32 is linear (zero bytes are shifted in through tables).

1. Task by task, distinct lines with their occurrences, and the cross-line counts; lines meet by a 128-bit
   digest with a map-side sum (a line of every document is one row a block) in a written line table.
2. Bucket counts: sums over that table and the cross-line counts, 10,000 numbers whatever the input. The same
   for the target gives each bucket's gain.
3. Each distinct line's weight (the sum of its features' gains), once; documents get their lines' weights by
   position (see ``blocks``) and add the gains of their cross-line runs.
4. Gumbel top share: score = weight + noise of the id; rows are ranged by score, numbered in their range, and the ranges' sizes
   give the rank. No row of documents is collected.

Lines are hashed twice from the written table (for counts, then for weights): their buckets would need more
room than their text.

Defined results: a null text is empty, without features, weight 0; a null doc_id counts as empty text in the noise and as last in
ties; rows of equal doc_id are drawn one by one; a null or empty target gives gains of the corpus alone; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchcredit.llm.blocks import BLOCK_BYTES, assemble, codes_of, dictionary_blocks, tiled
from touchcredit.llm.common import LOWER, cut, slices, table, text_bytes

BUCKETS = 10_000
ORDERS = 3
LEAST_WORDS = 20
SHARE = 5
NEWLINE = 0x0A
#: Bytes of a word that the tables go through; the library's crc32 takes longer ones.
SHORT = 64
#: Bytes that make words, after lower-casing: digits, a to z and everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True

# ---- crc32 of runs of words ---------------------------------------------------------------------------


def _byte_table() -> np.ndarray:
    """The register after each byte, from the reflected polynomial."""
    reg = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        reg = np.where(reg & 1, (reg >> 1) ^ np.uint32(0xEDB88320), reg >> 1)
    return reg


STEP = _byte_table()
_zeros: dict[int, np.ndarray] = {}


def zeros(n: int) -> np.ndarray:
    """Tables (4, 256): what n zero bytes make of a register, by its four bytes."""
    if n not in _zeros:
        reg = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
        if n <= SHORT + 1:
            for _ in range(n):
                reg = STEP[reg & 0xFF] ^ (reg >> 8)
        else:
            half = zeros(n // 2)
            reg = _through(half, _through(half, reg))
            if n % 2:
                reg = STEP[reg & 0xFF] ^ (reg >> 8)
        if n > SHORT + 1:
            return reg
        _zeros[n] = reg
    return _zeros[n]


def _through(tables: np.ndarray, reg: np.ndarray) -> np.ndarray:
    return (tables[0][reg & 0xFF] ^ tables[1][(reg >> 8) & 0xFF]) ^ (tables[2][(reg >> 16) & 0xFF] ^ tables[3][reg >> 24])


_short: list[np.ndarray] = []


def shift(reg: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers after ``n`` zero bytes each."""
    if not _short:
        _short.append(np.ascontiguousarray(np.stack([zeros(k) for k in range(SHORT + 2)]).reshape(-1)))
    flat, base = _short[0], np.minimum(n, SHORT + 1) * 1024
    out = (flat[base + (reg & 0xFF)] ^ flat[base + 256 + ((reg >> 8) & 0xFF)]) \
        ^ (flat[base + 512 + ((reg >> 16) & 0xFF)] ^ flat[base + 768 + (reg >> 24)])
    for k in np.flatnonzero(n > SHORT + 1).tolist():
        out[k] = _through(zeros(int(n[k])), reg[k : k + 1])[0]
    return out


def word_registers(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The register, from 0, of a space and then the word, for each word."""
    size = ends - starts
    reg = np.full(len(starts), STEP[0x20], np.uint32)
    live = np.flatnonzero(size <= SHORT)
    for k in range(SHORT):
        live = live[size[live] > k]
        if not len(live):
            break
        r = reg[live]
        reg[live] = STEP[(r ^ raw[starts[live] + k]) & 0xFF] ^ (r >> 8)
    for k in np.flatnonzero(size > SHORT).tolist():
        reg[k] = zlib.crc32(raw[starts[k] : ends[k]].tobytes(), int(STEP[0x20]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return reg


def run_buckets(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int = BUCKETS) -> list[np.ndarray]:
    """For n = 1, 2, ...: the bucket of the run of n words that ends at each word (words taken as one sequence)."""
    size = ends - starts
    own = word_registers(raw, starts, ends)
    full = np.uint32(0xFFFFFFFF)
    reg = shift(np.full(len(own), full ^ STEP[0x20], np.uint32), size) ^ own
    out = [(reg ^ full) % np.uint32(buckets)]
    for _ in range(1, ORDERS):
        before = np.concatenate([reg[:1], reg[:-1]])
        reg = shift(before, size + 1) ^ own
        out.append((reg ^ full) % np.uint32(buckets))
    return out


# ---- words, lines, runs -----------------------------------------------------------------------------


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start, end and row of each word, and the rows' offsets."""
    raw, offsets = text_bytes(column)
    raw = LOWER[raw]
    if not len(raw):
        z = np.zeros(0, np.int64)
        return raw, z, z, z, offsets
    inside = WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return raw, starts, ends, np.searchsorted(offsets, starts, "right") - 1, offsets


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every run of words inside each row."""
    raw, starts, ends, row, _ = words(column)
    rows, buckets = [], []
    for n, bucket in enumerate(run_buckets(raw, starts, ends)):
        same = np.ones(len(row), bool)
        same[:n] = False
        same[n:] &= row[n:] == row[: len(row) - n]
        rows.append(row[same])
        buckets.append(bucket[same])
    return np.concatenate(rows), np.concatenate(buckets).astype(np.int64)


def cross_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every run of words that crosses a newline inside a text, and each row's number of words."""
    raw, starts, ends, row, _ = words(column)
    line = np.searchsorted(np.flatnonzero(raw == NEWLINE), starts)
    near = np.zeros(len(row) + ORDERS, bool)
    for k in np.flatnonzero((line[1:] != line[:-1]) & (row[1:] == row[:-1])) + 1 if len(row) else []:
        near[max(0, k - ORDERS + 1) : k + ORDERS - 1] = True
    at = np.flatnonzero(near[: len(row)])
    rows, buckets = [], []
    for n, bucket in enumerate(run_buckets(raw, starts[at], ends[at])):
        if n:
            a, b = at[: len(at) - n], at[n:]
            cross = (b - a == n) & (row[a] == row[b]) & (line[a] != line[b])
            rows.append(row[b][cross])
            buckets.append(bucket[n:][cross])
    return np.concatenate(rows), np.concatenate(buckets).astype(np.int64), np.bincount(row, minlength=len(column))


def lines_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lines of all texts (with the newline before them) and each row's number of lines; an empty text has none."""
    raw, offsets = text_bytes(column)
    if not len(raw):
        return pa.array([], pa.large_string()), np.zeros(len(column), np.int64)
    at = raw == NEWLINE
    begin = offsets[:-1]
    at[begin[begin < offsets[1:]]] = True
    starts = np.flatnonzero(at)
    # the newline stays in the part as its first byte: it is no word's
    return tiled(raw, starts), np.diff(np.searchsorted(starts, offsets))


def digests(lines: pa.Array) -> list[bytes]:
    """128 bits of each line without its newline: lines that only differ in standing first are one line."""
    return [hashlib.blake2b(x.as_buffer(), digest_size=16).digest() for x in pc.utf8_ltrim(lines, "\n")]


# ---- counts --------------------------------------------------------------------------------------------

_LINES = "key binary, line string, n bigint, cross array<bigint>"


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's distinct lines with their occurrences; at the end the task's cross-line counts."""
    names, total = ["key", "line", "n", "cross"], np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for piece in slices(batch, "text", BLOCK_BYTES):
            text = piece.column("text")
            _, bucket, _ = cross_features(text)
            total += np.bincount(bucket, minlength=BUCKETS)
            lines, _ = lines_of(text)
            found = pc.utf8_ltrim(lines, "\n").dictionary_encode()
            m = len(found.dictionary)
            n = np.bincount(np.asarray(found.indices, np.int64), minlength=m) if m else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests(found.dictionary), pa.binary()), found.dictionary.cast(pa.string()),
                 pa.array(n, pa.int64()), pa.nulls(m, pa.list_(pa.int64()))], names)
    if total.any():
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([None], pa.string()),
                                          pa.array([None], pa.int64()), pa.array([total], pa.list_(pa.int64()))], names)


def line_table(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct lines (key, line, n occurrences), and the tasks' cross-line counts (array of all buckets)."""
    rows = docs.select("text").mapInArrow(_line_rows, _LINES)
    # one shuffle for both: cross-line counts have no key, so each gets one of its own
    key = F.coalesce("key", F.sha2(F.to_json("cross").cast("binary"), 256).cast("binary"))
    merged = cut(rows.groupBy(key.alias("key"), F.col("cross").isNull().alias("__line"))
                 .agg(F.any_value("line").alias("line"), F.sum(F.coalesce("n", F.lit(1))).alias("n"),
                      F.any_value("cross").alias("cross")))
    return merged.where("__line").select("key", "line", "n"), merged.where("not __line").select("n", "cross")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for piece in slices(batch, "line"):
            row, bucket = line_features(piece.column("line"))
            times = piece.column("n").to_numpy()[row]
            # in halves of 26 bits: bincount adds up doubles
            total += np.bincount(bucket, times & 0x3FFFFFF, BUCKETS).astype(np.int64)
            total += np.bincount(bucket, times >> 26, BUCKETS).astype(np.int64) << 26
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def bucket_counts(lines: DataFrame, cross: DataFrame) -> np.ndarray:
    """All features of a line table by bucket."""
    within = lines.select("line", "n").mapInArrow(_count, "bucket bigint, n bigint")
    across = cross.select(F.col("n").alias("times"), F.posexplode("cross").alias("bucket", "c")) \
        .select(F.col("bucket").cast("bigint"), (F.col("c") * F.col("times")).alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in within.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of how much likelier a bucket is in the target), with one added to each bucket."""
    big_s, big_t = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (big_s + BUCKETS) / ((s + 1.0) * (big_t + BUCKETS))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


# ---- weights ----------------------------------------------------------------------------------------


def _sums(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of values by row, in whole numbers (each below 2^53 in a block)."""
    return np.bincount(row, values, n).astype(np.int64) if len(row) else np.zeros(n, np.int64)


def _weigh(gain: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "line"):
                row, bucket = line_features(piece.column("line"))
                n = piece.num_rows
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), pa.array(_sums(row, gain[bucket], n)), pa.array(np.bincount(row, minlength=n))],
                    ["key", "weight", "features"])

    return run


def _split(gain: np.ndarray) -> Callable[[pa.RecordBatch], tuple[pa.Array, np.ndarray, dict]]:
    def run(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, dict]:
        text = batch.column("text")
        row, bucket, n_words = cross_features(text)
        n = len(text)
        lines, counts = lines_of(text)
        return _keys(lines), counts, {
            "n_words": pa.array(n_words, pa.int64()), "cross_weight": pa.array(_sums(row, gain[bucket], n)),
            "cross_features": pa.array(np.bincount(row, minlength=n), pa.int64())}

    return run


def _keys(lines: pa.Array) -> pa.Array:
    """The digest of each line; each distinct line is digested once."""
    found = lines.dictionary_encode()
    return pa.array(digests(found.dictionary), pa.binary()).take(found.indices)


def _put(documents: pa.Table, results: pa.Table) -> pa.Table:
    codes, counts = codes_of(documents)
    row = np.repeat(np.arange(len(counts)), counts)
    weight, features = (results.column(c).to_numpy() for c in ("weight", "features"))
    n = len(counts)
    return pa.table({
        "doc_id": documents.column("doc_id"), "n_words": documents.column("n_words"),
        "n_features": _sums(row, features[codes], n) + documents.column("cross_features").to_numpy(),
        "weight": _sums(row, weight[codes], n) + documents.column("cross_weight").to_numpy()})


def weights(docs: DataFrame, target: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row of ``docs`` towards ``target`` (both have text); written."""
    lines, cross = line_table(docs)
    gain = gains(bucket_counts(lines, cross), bucket_counts(*line_table(target)))
    weighed = lines.select("key", "line").mapInArrow(_weigh(gain), "key binary, weight bigint, features bigint")
    documents, parts = dictionary_blocks(
        docs, _split(gain), "binary", "n_words bigint, cross_weight bigint, cross_features bigint", block_bytes)
    found = parts.join(weighed, parts["part"] == weighed["key"]).select("block", "k", "weight", "features")
    return cut(assemble(documents, found, _put, "doc_id bigint, n_words bigint, n_features bigint, weight bigint"))


# ---- the draw ---------------------------------------------------------------------------------------------


def noise(doc_id: Column, seed: int = 42) -> Column:
    """floor(1000 * Gumbel noise) of an id, from the first 8 hex digits of sha256(seed:id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(weighed: DataFrame, least_words: int = LEAST_WORDS, share: int = SHARE) -> DataFrame:
    """``weighed`` (doc_id, n_words, weight, ...) with ``score`` and ``rank``: 1, 2, ... for the ``share`` percent
    of documents of ``least_words`` or more that score highest (ties to the smaller id), null for the rest."""
    spark = weighed.sparkSession
    rows = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"))) \
        .withColumn("__open", F.col("n_words") >= least_words)
    order = [F.col("__open").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a place in a range is the low 33 bits of the id, the range the bits above
    rows = cut(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
               .withColumn("__place", F.monotonically_increasing_id()))
    rows = rows.withColumn("__range", F.shiftright("__place", 33)).withColumn("__at", F.col("__place").bitwiseAND((1 << 33) - 1))
    sizes = rows.groupBy("__range").agg(F.count("*").alias("__n"), F.sum(F.col("__open").cast("long")).alias("__o"))
    # one row a range
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sizes = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"),
                         F.floor(F.sum("__o").over(everything) * share / 100).alias("__drawn"))
    rank = F.col("__base") + F.col("__at") + 1
    return rows.join(sizes, "__range").withColumn("rank", F.when(rank <= F.col("__drawn"), rank)) \
        .drop("__open", "__place", "__range", "__at", "__base", "__drawn")


def resample(docs: DataFrame, target: DataFrame, least_words: int = LEAST_WORDS, share: int = SHARE) -> DataFrame:
    """Rows of ``docs`` (whole, with ``rank``) that the draw takes; ids are taken to be unique."""
    taken = draw(weights(docs, target), least_words, share).where("rank is not null").select("doc_id", "rank")
    return docs.drop("rank").join(taken, "doc_id")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = draw(weights(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return out.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


OP12_SQL = r"""
with recursive
texts as (
    select 'd' side, row_number() over () r, doc_id, coalesce(text, '') as text from documents
    union all select 'b', row_number() over (), null, coalesce(text, '') from benchmark),
listed as (
    select side, r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from texts),
runs as materialized (
    select side, r, unnest(list_transform(range(1, greatest(len(w) - n + 2, 1)), lambda i: array_to_string(w[i:i + n - 1], ' '))) f
    from listed, (values (1), (2), (3)) o(n)),
spelled as materialized (select f, encode(f) b from (select distinct f from runs)),
steps as (
    select i, i as reg, 0 as k from range(256) t(i)
    union all
    select i, case when reg & 1 = 1 then xor(reg >> 1, 3988292384) else reg >> 1 end, k + 1 from steps where k < 8),
step as materialized (select list(reg order by i) t from steps where k = 8),
crc as (
    select f, b, 0::bigint k, 4294967295::bigint reg from spelled
    union all
    select f, b, k + 1, xor(reg >> 8, t[xor(reg & 255, ('0x' || hex(b[k + 1:k + 1]))::int) + 1])::bigint
    from crc, step where k < octet_length(b)),
bucket as (select f, xor(reg, 4294967295) % 10000 bucket from crc where k = octet_length(b)),
hits as (select side, r, bucket from runs join bucket using (f)),
counts as (select bucket, count(*) filter (side = 'd') s, count(*) filter (side = 'b') t from hits group by bucket),
sums as (select coalesce(sum(s), 0) big_s, coalesce(sum(t), 0) big_t from counts),
gain as (select bucket, floor(1000 * ln((t + 1)::double * (big_s + 10000)::double / ((s + 1)::double * (big_t + 10000)::double)))::bigint g
    from counts, sums),
weighed as (select r, count(*) n, sum(g)::bigint w from hits join gain using (bucket) where side = 'd' group by r),
scored as (
    select r, doc_id, len(listed.w) words, coalesce(n, 0)::bigint n_features, coalesce(weighed.w, 0)::bigint weight,
        coalesce(weighed.w, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint
            + 0.5::double) / 4294967296::double)))::bigint score
    from listed left join weighed using (r) where side = 'd'),
ranked as (
    select r, row_number() over (order by score desc, doc_id nulls last) p, count(*) over () n from scored where words >= 20)
select doc_id, n_features, weight, score, case when p <= (5 * n) // 100 then p end as rank
from scored left join ranked using (r)
"""
