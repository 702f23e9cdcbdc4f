"""Filter interaction audit: what each quality filter removes in every order in which the filters can be applied.

``measure`` passes once over the bytes of each text with a table-driven transducer: a table gives each byte its
class (word or space, capital, symbol, code-point start, so UTF-8 continuation bytes count nothing), the state is whether a word is open,
and a change of state ends or begins a word. The words' spans go into an open-addressing hash table whose
every hit is verified byte by byte: a slot holds the first span that claimed it, and a span whose row, length or
bytes differ from the slot's goes on to the next slot. So the count of distinct words does not rest on
hashes. Tables and byte arrays are those of one slice of texts.

``audit`` needs one number for each document: the mask of filters that it fails. Documents are counted by (part,
mask), and all orders and steps follow from at most 2^filters counts a part. With the mask, a document is removed at the
first of its filters in the order; the Shapley sum over all orders counts it (orders / number of filters that it fails) times for each.

Copies are found by a 128-bit digest of the text: the smallest id of each digest (a map-side minimum) is joined back on
digest and id together, so thousands of copies of one text do not meet in one task.

Defined results: null text is empty; a null part is the empty string; a null doc_id has no smaller id, is no smaller id of another row, and
has no labels; rows of equal id and text are not copies of each other; several labels of one id count
as one that has the best quality and any toxicity; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm.common import cut, mix, slices, span_hashes, table, text_bytes

# ---- the transducer ------------------------------------------------------------------------------------

IN_WORD, CAPITAL, SYMBOL, POINT = 1, 2, 4, 8
CLASS = np.full(256, IN_WORD | POINT, np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = POINT
CLASS[0x41:0x5B] |= CAPITAL
CLASS[list(b"#$%&*|")] |= SYMBOL
CLASS[0x80:0xC0] = IN_WORD


def transduce(raw: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Counts of each row's bytes by class, and start and end of its words; a row's end closes its word."""
    kind = CLASS[raw]

    def count(flag: int) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(kind & flag), offsets))

    counts = {"capitals": count(CAPITAL), "symbols": count(SYMBOL),
              "points": np.diff(offsets) - np.diff(np.searchsorted(np.flatnonzero(~kind & POINT), offsets))}
    state = (kind & IN_WORD).astype(bool)
    closed = np.zeros(len(raw) + 1, bool)
    closed[offsets] = True
    opens = state.copy()
    opens[1:] &= ~state[:-1] | closed[1:-1]
    ends = state.copy()
    ends[:-1] &= ~state[1:] | closed[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(ends) + 1
    counts["words"] = np.diff(np.searchsorted(starts, offsets))
    return counts, starts, ends


# ---- the verified table ----------------------------------------------------------------------------------


def same_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` bytes at ``a`` and at ``b`` hold the same bytes, eight at a time."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(raw) + 1,), (1,))
    same = np.ones(len(a), bool)
    live, at = np.arange(len(a)), 0
    while len(live):
        left = size[live] - at
        keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * np.maximum(8 - left, 0).astype(np.uint64))
        equal = ((lanes[a[live] + at] ^ lanes[b[live] + at]) & keep) == 0
        same[live[~equal]] = False
        live = live[equal & (left > 8)]
        at += 8
    return same


def first_of_each(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray,
                  hashes: np.ndarray | None = None) -> np.ndarray:
    """For each span the span that stands for it: one of its row with the same bytes, itself if it came first."""
    n = len(starts)
    if hashes is None:
        hashes = span_hashes(raw, starts, ends)
    with np.errstate(over="ignore"):
        key = mix(hashes ^ (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    mask = (1 << max(1, (2 * n - 1).bit_length())) - 1
    slots = np.full(mask + 1, -1, np.int64)
    at = (key & np.uint64(mask)).astype(np.int64)
    size, owner, pending = ends - starts, np.full(n, -1, np.int64), np.arange(n)
    while len(pending):
        slot = at[pending]
        free = slots[slot] < 0
        # backwards, so that the first of several claimants stays
        slots[slot[free][::-1]] = pending[free][::-1]
        holder = slots[slot]
        match = (rows[pending] == rows[holder]) & (size[pending] == size[holder]) & (key[pending] == key[holder])
        check = np.flatnonzero(match & (holder != pending))
        match[check] = same_bytes(raw, starts[pending[check]], starts[holder[check]], size[pending[check]])
        owner[pending[match]] = holder[match]
        pending = pending[~match]
        at[pending] = (at[pending] + 1) & mask
    return owner


def distinct_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each row's number of distinct words."""
    rows = np.searchsorted(offsets, starts, "right") - 1
    own = first_of_each(raw, starts, ends, rows) == np.arange(len(starts))
    return np.bincount(rows[own], minlength=len(offsets) - 1)


# ---- measures ---------------------------------------------------------------------------------------------

_COUNTS = ["words", "different", "points", "capitals", "symbols"]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            raw, offsets = text_bytes(piece.column("text"))
            counts, starts, ends = transduce(raw, offsets)
            counts["different"] = distinct_words(raw, starts, ends, offsets)
            view = memoryview(np.ascontiguousarray(raw))
            at = offsets.tolist()
            digest = [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("part"), *(pa.array(counts[c], pa.int64()) for c in _COUNTS),
                 pa.array(digest, pa.binary())], ["doc_id", "part", *_COUNTS, "digest"])


def measure(docs: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part, words, different (distinct words), points, capitals, symbols, digest of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    return rows.mapInArrow(_measure, "doc_id bigint, part string, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", digest binary")


def mark_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: whether a row with a smaller doc_id has the same digest."""
    first = rows.where("doc_id is not null").groupBy(F.col("digest").alias("__g")).agg(F.min("doc_id").alias("__first"))
    found = rows.join(first, (rows["digest"] == F.col("__g")) & (rows["doc_id"] == F.col("__first")), "left")
    return found.withColumn("copy", F.col("__first").isNull() & F.col("doc_id").isNotNull()).drop("__g", "__first")


#: Letter and failure condition of each filter, over the columns of ``measure`` and ``copy``.
FILTERS: dict[str, str] = {
    "A": "words < 200",
    "B": "100 * different < 50 * words",
    "C": "100 * capitals > 3 * points",
    "D": "symbols > 0",
    "E": "copy",
}

# ---- the audit -----------------------------------------------------------------------------------------


def audit(rows: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS) -> DataFrame:
    """Every order of ``filters``, step by step, by part: see the module. ``rows`` has doc_id, part and what the
    conditions read; ``labels`` doc_id, quality, toxic."""
    letters = "".join(filters)
    mask = sum((F.expr(c).cast("int") * (1 << k) for k, c in enumerate(filters.values())), F.lit(0))
    masks = cut(rows.select("doc_id", "part", mask.alias("mask")))
    flags = labels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).cast("long").alias("good"),
                                         F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("long").alias("toxic"))
    zero = F.lit(0).cast("long")
    every = masks.groupBy("part", "mask").agg(F.count("*").alias("n")).withColumns({"good": zero, "toxic": zero})
    labelled = masks.join(flags, "doc_id").groupBy("part", "mask").agg(zero.alias("n"), F.sum("good").alias("good"),
                                                                     F.sum("toxic").alias("toxic"))
    counted = every.unionByName(labelled).groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))

    # all orders and steps: a list of fixed length, spread over the few counted rows
    steps = [{"filter_order": "".join(order), "step": k + 1, "bit": 1 << letters.index(order[k]),
              "earlier": sum(1 << letters.index(x) for x in order[:k])}
             for order in itertools.permutations(letters) for k in range(len(letters))]
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, bit: int, earlier: int>>")
    orders = math.factorial(len(letters))
    t = counted.select("*", F.inline(listed))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) != 0
    several = F.bit_count("mask")

    def total(condition: Column, value: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    return t.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone, F.col("n")).alias("kept"), total(fails & ~gone, F.col("n")).alias("removed"),
        total(fails & gone, F.col("n")).alias("redundant"), total(F.col("mask") == F.col("bit"), F.col("n")).alias("unique_fails"),
        total(fails & ~gone, F.col("good")).alias("good_lost"), total(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
        total(fails, F.col("n") * F.floor(F.lit(orders) / several)).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(mark_copies(cut(measure(table(spark, sf_dir, "documents")))), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') as text, coalesce(lang, '') as part from documents),
word as (select r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) w from d),
size as (select r, count(*) words, count(distinct w) different from word group by r),
first as (select text, min(doc_id) f from d group by text),
label as (select doc_id, max(coalesce(quality, 0) = 1)::int good, max(coalesce(toxic, 0) = 1)::int toxic from labels group by doc_id),
failed as (
    select d.part, coalesce(good, 0) good, coalesce(toxic, 0) toxic,
        case when coalesce(words, 0) < 200 then 'A' else '' end
        || case when 100 * coalesce(different, 0) < 50 * coalesce(words, 0) then 'B' else '' end
        || case when 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 3 * length(d.text) then 'C' else '' end
        || case when regexp_matches(d.text, '[#$%&*|]') then 'D' else '' end
        || case when d.doc_id > f then 'E' else '' end fails
    from d left join size using (r) left join first on d.text = first.text left join label on d.doc_id = label.doc_id),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) x),
orders as (
    select a.x || b.x || c.x || d.x || e.x o from letter a, letter b, letter c, letter d, letter e
    where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (select o, s, substr(o, s, 1) letter, substr(o, 1, s - 1) earlier from orders, range(1, 6) t(s)),
tally as (select part, fails, count(*) n, sum(good) good, sum(toxic) toxic from failed group by all),
seen as (
    select part, o, s, letter, fails, n, good, toxic, contains(fails, letter) hit, translate(fails, earlier, '') <> fails gone
    from tally, steps),
out as (
    select part, o filter_order, s::int step, letter,
        coalesce(sum(n) filter (not hit and not gone), 0)::bigint kept, coalesce(sum(n) filter (hit and not gone), 0)::bigint removed,
        coalesce(sum(n) filter (hit and gone), 0)::bigint redundant, coalesce(sum(n) filter (fails = letter), 0)::bigint unique_fails,
        coalesce(sum(good) filter (hit and not gone), 0)::bigint good_lost,
        coalesce(sum(toxic) filter (hit and not gone), 0)::bigint toxic_lost
    from seen group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) over (partition by part, letter))::bigint shapley
from out
"""
