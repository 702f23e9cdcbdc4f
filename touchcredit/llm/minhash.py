"""MinHash near-dedup with HyperMinHash sketches.

A document's set is its distinct word shingles. One hash of a shingle gives its bucket, a second one a
value; a bucket keeps its smallest value, compressed to the number of leading zeros and the ten bits after
them. Empty buckets take over the register of another bucket by a fixed rule that depends on which
are filled, so that small sets compare as well as large ones. Registers in bands propose pairs, a
collision-corrected estimate drops the unlikely, and the full sets decide.

Work is kept linear in the size of a group. Documents of equal sets form one class first. In each band
a class is compared with one class of its bucket only, the one with most company; of these, each class checks its likeliest
on the full sets. Components of the links found leave few buckets with classes of different components;
only there all proposed pairs of different components are compared, registers first, then full sets, in blocks
of bounded size, and only links come out. A pair inside a component needs no check, as it could not change the result.

Defined results: null or empty text has the empty set, links with nothing, and is a component of its own;
a document with fewer words than a shingle has its whole sequence as one shingle; equal rows have the
same component; a null doc_id gets the smallest id its text can reach, null if none, and is not kept;
an empty table gives no rows; extra columns are ignored or passed through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm.common import LOWER, cut, mix, slices, span_hashes, table, text_bytes, word_spans
from touchcredit.llm.graph import components

WORDS = 4
SIMILARITY = 80
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: How far an estimate may lie below the similarity: nearly five standard deviations of REGISTERS registers at 0.8.
SLACK = 0.15
#: Rows of a block of a bucket, and shingles that a group of blocks checks together, about.
BLOCK = 512
GROUP_WORDS = 1 << 20

_rule = mix(np.arange(REGISTERS * 256, dtype=np.uint64), 21).reshape(REGISTERS, 256) % np.uint64(REGISTERS)
DONORS = _rule.astype(np.int64)


def shingle_sets(column: pa.Array, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's distinct shingles, by row then hash; A-Z lower-cased."""
    raw, offsets = text_bytes(column)
    starts, ends, rows = word_spans(raw, offsets)
    n, count = len(starts), np.bincount(rows, minlength=len(column)) if len(starts) else np.zeros(len(column), np.int64)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = span_hashes(LOWER[raw], starts, ends)
    place = np.arange(n) - (np.cumsum(count) - count)[rows]
    length = np.minimum(count[rows], width)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            nxt = np.concatenate([word[k:], np.zeros(min(k, n), np.uint64)])[:n]
            h = np.where(k < length, mix(h * np.uint64(0x9E3779B97F4A7C15) + nxt, 31), h)
    keep = place + length <= count[rows]
    rows, h = rows[keep], h[keep]
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])
    return rows[new], h[new]


def registers(rows: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
    """(n_rows, REGISTERS) of 16-bit registers; rows without shingles have zeros."""
    out = np.zeros((n_rows, REGISTERS), np.uint16)
    if not len(h):
        return out
    # h is sorted within a row, so its high bits give the buckets in order
    bucket = ((h >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
    value = mix(h, 41)
    cell = rows * REGISTERS + bucket
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    least = np.minimum.reduceat(value, first)
    # leading zeros from the exponent of the top 52 bits, which a double holds exactly
    top = least >> np.uint64(12)
    zeros = np.where(top > 0, 52 - np.frexp(top.astype(np.float64))[1], 52).astype(np.uint64)
    after = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    filled = np.zeros((n_rows, REGISTERS), bool)
    filled.ravel()[cell[first]] = True
    out.ravel()[cell[first]] = (zeros << np.uint64(MANTISSA)) | after
    return _fill_empty(out, filled)


def _fill_empty(out: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Each empty register takes that of the first filled bucket in its own fixed order of donors."""
    r, j = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for k in range(DONORS.shape[1]):
        if not len(r):
            return out
        donor = DONORS[j, k]
        ok = filled[r, donor]
        out[r[ok], j[ok]] = out[r[ok], donor[ok]]
        r, j = r[~ok], j[~ok]
    if len(r):  # a handful: the next filled bucket to the right
        step = np.argmax(filled[r[:, None], (j[:, None] + np.arange(REGISTERS)) % REGISTERS], axis=1)
        out[r, j] = out[r, (j + step) % REGISTERS]
    return out


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers, corrected for registers that are equal by chance.

    Two unrelated buckets agree if their smallest values have as many leading zeros and the same mantissa.
    """
    same = (a == b).mean(axis=-1)
    zeros = np.arange(48)
    def by_zeros(n: np.ndarray) -> np.ndarray:
        load = np.maximum(n, REGISTERS)[..., None] / REGISTERS
        return np.exp(-load * 2.0 ** -(zeros + 1)) - np.exp(-load * 2.0**-zeros)
    chance = (by_zeros(na) * by_zeros(nb)).sum(axis=-1) * 2.0**-MANTISSA
    return (same - chance) / (1 - chance)


def _sketch(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                rows, h = shingle_sets(piece.column(1), width)
                n = piece.num_rows
                count = np.bincount(rows, minlength=n)
                regs = registers(rows, h, n)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(2), pa.array(count, pa.int64()), pa.array(digests(rows, h, n), pa.binary()),
                     pa.array([r.tobytes() for r in regs], pa.binary())], ["doc_id", "tid", "n", "node", "regs"])

    return run


def digests(rows: np.ndarray, h: np.ndarray, n_rows: int) -> list[bytes | None]:
    """16 bytes that name a set: two sums of mixed hashes; null for the empty set."""
    out = np.zeros((n_rows, 2), np.uint64)
    if len(h):
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        for k in range(2):
            out[rows[first], k] = np.add.reduceat(mix(h, 51 + k), first)
    has = np.bincount(rows, minlength=n_rows) > 0
    return [x.tobytes() if y else None for x, y in zip(out, has, strict=True)]


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), regs.shape[:2])
        for k in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + regs[:, :, k], 61)
        node = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
        place = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(place), node], ["band", "place", "node"])


def _arrays(regs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(regs.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, ra, rb, na, nb = batch.columns
        est = estimate(_arrays(ra), _arrays(rb), na.to_numpy(), nb.to_numpy())
        ok = est >= SIMILARITY / 100 - SLACK
        yield pa.RecordBatch.from_arrays([a, b, pa.array(est)], ["a", "b", "est"]).filter(pa.array(ok))


def _likely(pdf: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Each row with the other rows of its block pair that are likely links to other components, by their registers.
    A pair that shares several buckets is taken in the first of them only."""
    regs, n = _arrays(pa.array(pdf["regs"], pa.binary())), pdf["n"].to_numpy()
    comp, block, place = pdf["comp"].to_numpy(), pdf["block"].to_numpy(), pdf["place"].to_numpy()
    for (_, i, j), at in pdf.groupby(["band", "i", "j"], sort=False).indices.items():
        left, right = at[block[at] == i], at[block[at] == j]
        bands = regs[right].reshape(-1, BANDS, ROWS)
        for x in left:
            other = (comp[right] != comp[x]) & ((i != j) | (right > x))
            if other.any():
                shared = (bands[other] == regs[x].reshape(BANDS, ROWS)).all(axis=2)
                other = right[other][shared.argmax(axis=1) == place[x]]
                other = other[estimate(regs[x], regs[other], n[[x]], n[other]) >= SIMILARITY / 100 - SLACK]
                if len(other):
                    yield x, other


def _with_partner(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows that have a likely link."""
    keep = np.zeros(len(pdf), bool)
    for x, other in _likely(pdf):
        keep[x] = True
        keep[other] = True
    return pdf[keep]


def _verified(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of the likely pairs whose full sets are similar enough."""
    sets, node, found = pdf["shingles"].to_numpy(), pdf["node"].to_numpy(), []
    sizes = np.array([len(s) for s in sets])
    for x, others in _likely(pdf):
        most = np.minimum(sizes[x], sizes[others]) / np.maximum(sizes[x], sizes[others])
        own = np.sort(sets[x])
        for y in others[100 * most >= SIMILARITY]:
            at = np.minimum(np.searchsorted(own, sets[y]), len(own) - 1)
            common = int((own[at] == sets[y]).sum())
            if 100 * common >= SIMILARITY * (sizes[x] + sizes[y] - common):
                found.append((min(node[x], node[y]), max(node[x], node[y])))
    return pd.DataFrame(found, columns=["a", "b"])


def _sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                rows, h = shingle_sets(piece.column(1), width)
                n = piece.num_rows
                at = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests(rows, h, n), pa.binary()),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))], ["node", "shingles"])

    return run


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    a, b = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    both = pairs.join(a, "a").join(b, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return both.where(100 * F.col("common") >= SIMILARITY * union).select("a", "b")


def text_id() -> Column:
    return F.xxhash64(F.col("text"))


def near_components(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """doc_id, tid (hash of the text), n_shingles, node (name of its set), label (of its component; both null
    without words) and component_id of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text", text_id().alias("tid"))
    sketches = cut(docs.mapInArrow(_sketch(width), "doc_id long, tid long, n long, node binary, regs binary"))
    full = sketches.where("node is not null")
    classes = cut(full.groupBy("node").agg(F.first("regs").alias("regs"), F.first("n").alias("n"),
                                           F.min("doc_id").alias("doc_id")))
    bands = classes.select("node", "regs").mapInArrow(_bands, "band bigint, place int, node binary")
    bands = cut(bands)
    sizes = bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    shared = cut(bands.join(sizes, "band"))
    sketch = classes.select("node", "regs", "n")

    # a bucket's centre is the class that shares most buckets with most others: of a group of edited copies, most
    # likely their original, which is nearer to them than they are to each other
    central = shared.groupBy("node").agg(F.sum("size").alias("central"))
    centres = (shared.join(central, "node").groupBy("band")
               .agg(F.max_by("node", F.struct("central", "node")).alias("first")))
    stars = shared.join(centres, "band").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    stars = (stars.join(sketch.toDF("a", "ra", "na"), "a").join(sketch.toDF("b", "rb", "nb"), "b")
             .select("a", "b", "ra", "rb", "na", "nb").mapInArrow(_estimates, "a binary, b binary, est double"))
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("est", "a")).alias("a"))
    best = cut(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    involved = shared.select("node").distinct().join(classes.select("node", "doc_id"), "node")
    wanted = involved.select(F.col("doc_id").alias("__d")).distinct()
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["__d"]), "left_semi")
    sets = texts.mapInArrow(_sets(width), "node binary, shingles array<bigint>")
    sets = sets.where("node is not null").groupBy("node").agg(F.first("shingles").alias("shingles"))
    sets = cut(sets)

    links = cut(linked(best, sets))
    labels = components(links)
    members = shared.join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node"))
    members = cut(members.select("band", "place", "node", "comp", "size"))
    open_bands = (members.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
                  .where("x <> y").select("band"))
    rest = members.join(open_bands, "band", "left_semi").join(sketch, "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rest = (rest.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other"))
    rest = cut(rest.select("band", "place", "node", "comp", "regs", "n", "block", "i", "j"))
    pair = F.xxhash64("band", "i", "j")

    def dealt(rows: DataFrame, groups: int) -> DataFrame:
        return rows.withColumn("g", F.pmod(pair, F.lit(groups)))

    groups = dealt(rest, max(1, rest.count() // (2 * BLOCK))).groupBy("g")
    schema = "band bigint, place int, node binary, comp binary, regs binary, n bigint, block int, i int, j int, g bigint"
    likely = cut(groups.applyInPandas(_with_partner, schema))
    words = likely.agg(F.sum("n")).first()[0] or 0
    checked = dealt(likely, max(1, words // GROUP_WORDS)).join(sets, "node")
    more = checked.groupBy("g").applyInPandas(_verified, "a binary, b binary")
    links = cut(links.unionByName(more))
    labels = cut(components(links))
    per_class = full.groupBy("node").agg(F.min("doc_id").alias("least"))
    per_class = per_class.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    small = per_class.groupBy("label").agg(F.min("least").alias("component_id"))
    named = per_class.join(small, "label").select("node", "label", "component_id")
    out = sketches.select("doc_id", "tid", F.col("n").alias("n_shingles"), "node")
    with_set = out.where("node is not null").join(named, "node").select(*out.columns, "label", "component_id")
    bare = out.where("node is null").withColumn("label", F.lit(None).cast("binary"))
    return with_set.unionByName(bare.withColumn("component_id", F.col("doc_id")))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def dedup(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` with one row of each group of near copies: of its smallest doc_id (null last), then the
    smallest text hash, then the smallest row. Rows without words have no copies and all stay."""
    found = cut(near_components(docs, width).select("doc_id", "tid", "node", "label"))
    key = ["doc_id", "tid"]
    first = (found.where("label is not null").groupBy("label")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), *key)).alias("k")))
    first = first.select("k.doc_id", "k.tid", F.lit(True).alias("chosen"))
    rows = found.groupBy("doc_id", "tid", F.col("node").isNull().alias("bare")).agg(F.count("*").alias("copies"))
    same = (first["doc_id"].eqNullSafe(rows["doc_id"])) & (first["tid"] == rows["tid"])
    keys = (rows.join(first, same, "left").where(F.col("bare") | F.col("chosen"))
            .select(rows["doc_id"].alias("__d"), rows["tid"].alias("__t"),
                    (~F.col("bare") & (F.col("copies") > 1)).alias("__again")))
    kept = docs.join(cut(keys), docs["doc_id"].eqNullSafe(F.col("__d")) & (text_id() == F.col("__t")))
    once = kept.where(~F.col("__again")).select(*docs.columns)
    row = F.struct(*docs.columns)
    pick = F.first(row) if any("map<" in t for _, t in docs.dtypes) else F.min(row)
    again = kept.where("__again").groupBy("__d", "__t").agg(pick.alias("__row"))
    return once.unionByName(again.select("__row.*"))
