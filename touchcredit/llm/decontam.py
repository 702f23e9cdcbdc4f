"""Benchmark decontamination by SimHash of item-sized windows. DataFrame functions only.

An item of n shingles is compared with windows of n shingles. Each side is its five-word shingles with their counts
(weights). A 64-bit SimHash stands for it; fingerprints are cut into RADIUS + 1 blocks, and two fingerprints
that differ in at most RADIUS bits share a block, so that joining on blocks finds all of them. Pairs
within the radius are checked exactly: sum of smaller counts over sum of larger ones, ``SIMILARITY`` or more.
A document with fewer shingles than the item is its own, only window: the whole of it is compared, exactly and
without fingerprints, so an item that lost words at either end is found as well.

A window needs a fingerprint only if it can reach that similarity with an item: then so many of its places have a
shingle of that item. These places are counted from where documents and items share a shingle, which loses no
window, and the window meets only the items it was taken for in the join on blocks. For a pair just at 0.8
the fingerprints differ in 10 bits on average; more than RADIUS is over 4 standard deviations away.

Windows overlap, so nothing is spread over the n windows a place lies in: a count over a window is the difference of
two running sums over places, for the places of an item, for the bits of the SimHash, and for the exact check (the
occurrence of a shingle that an item has c times counts in those windows that hold fewer than c earlier ones).

Words are runs of letters and digits, lower-cased. Defined results: null and empty texts match nothing; an
item of fewer than five words has its whole sequence as its shingle; repeated items and documents give one row;
rows of equal doc_id are one document with several texts; a null doc_id stays null; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchcredit.llm.common import cut, table

WORDS = 5
SIMILARITY = 0.8
BITS = 64
RADIUS = 23


def text_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words, in order."""
    n = F.size(words) - width
    at = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))


def bit(b: int) -> Column:
    return F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1))


def packed(count: str) -> Column:
    """The SimHash from the columns b0 to b63, how many of ``count`` hashes have each bit."""
    fp = F.lit(0).cast("long")
    for b in range(BITS):
        fp = fp.bitwiseOR(F.when(2 * F.col(f"b{b}") > F.col(count), F.shiftleft(F.lit(1).cast("long"), b))
                          .otherwise(F.lit(0).cast("long")))
    return fp


def simhash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys and fp: the SimHash of each group's column ``h``, each row of weight 1."""
    sums = rows.groupBy(*keys).agg(F.count("*").alias("w"), *[F.sum(bit(b)).alias(f"b{b}") for b in range(BITS)])
    return sums.select(*keys, packed("w").alias("fp"))


def window_simhash(places: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, tid, n, start, fp of each of ``windows`` (doc_id, tid, n, start) over ``places`` (doc_id, tid, p, h): the
    running sums at its last place less those before its first."""
    ends = windows.select("doc_id", "tid", F.lit(None).cast("long").alias("h"), "n", "start", F.explode(F.array(
        F.struct((F.col("start") + F.col("n") - 1).alias("p"), F.lit(1).alias("sign")),
        F.struct((F.col("start") - 1).alias("p"), F.lit(-1).alias("sign")))).alias("e"))
    ends = ends.select("doc_id", "tid", "e.p", "h", "n", "start", "e.sign")
    rows = places.select("doc_id", "tid", "p", "h", *[F.lit(None).cast("int").alias(c) for c in ("n", "start", "sign")])
    by_place = Window.partitionBy("doc_id", "tid").orderBy("p")  # rows of one place are peers
    sums = rows.unionByName(ends).select(
        "doc_id", "tid", "n", "start", "sign", *[F.sum(bit(b)).over(by_place).alias(f"b{b}") for b in range(BITS)])
    sums = sums.where("sign is not null").groupBy("doc_id", "tid", "n", "start").agg(
        *[F.sum(F.col("sign") * F.coalesce(F.col(f"b{b}"), F.lit(0))).alias(f"b{b}") for b in range(BITS)])
    return sums.select("doc_id", "tid", "n", "start", packed("n").alias("fp"))


def covered(spans: DataFrame, keys: list[str], least: Column) -> DataFrame:
    """keys, start, count: the starts that ``least`` or more of the ``spans`` (keys, first, last) of a group hold."""
    steps = spans.select(*keys, F.explode(F.array(
        F.struct(F.col("first").alias("at"), F.lit(1).alias("step")),
        F.struct((F.col("last") + 1).alias("at"), F.lit(-1).alias("step")))).alias("s"))
    steps = steps.groupBy(*keys, F.col("s.at").alias("at")).agg(F.sum("s.step").alias("step"))
    in_order = Window.partitionBy(*keys).orderBy("at")
    runs = steps.select(*keys, "at", F.sum("step").over(in_order).alias("count"), F.lead("at").over(in_order).alias("end"))
    runs = runs.where((F.col("count") >= least) & F.col("end").isNotNull())
    return runs.select(*keys, F.explode(F.sequence(F.col("at"), F.col("end") - 1)).alias("start"), "count")


def blocks(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """A row for each block of ``fp``, with its number and value."""
    ends = [BITS * k // (radius + 1) for k in range(radius + 2)]
    values = [F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
              for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]
    return rows.withColumn("__b", F.explode(F.array(*values))).select(*rows.columns, "__b.block", "__b.value")


def _of_width(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """doc_id, item_id, start, similarity, distance of windows that match items with shingles of ``width`` words."""
    # items: key, n (shingles), place, h
    items = items.where(F.col("width") == width).select("key", "n", F.posexplode("s").alias("place", "h"))
    items = cut(items)
    counts = items.groupBy("key", "n", "h").agg(F.count("*").alias("ci"))
    counts = cut(counts)
    known = counts.select("key", "n", F.col("h").alias("ih"), "ci")
    said = docs.withColumn("m", F.size("words") - (width - 1))
    said = said.select("doc_id", "tid", "m", F.posexplode(shingles(F.col("words"), width)).alias("p", "h"))
    # the least common weight at which a window of n, or a whole document of m shingles, is similar enough
    need = F.ceil(F.col("n") * F.lit(2 * SIMILARITY / (1 + SIMILARITY)) - F.lit(1e-6))
    whole = F.col("m") < F.col("n")
    enough = F.when(whole, F.col("m") >= F.ceil(F.col("n") * F.lit(SIMILARITY) - F.lit(1e-6))).otherwise(F.lit(True))
    said = said.join(known, F.col("h") == F.col("ih")).where(enough)
    said = cut(said.select("doc_id", "tid", "m", "key", "n", "p", "h", "ci").distinct())  # rows of equal id and text are one

    # whole documents with fewer shingles than the item
    short = said.where(whole).groupBy("doc_id", "tid", "m", "key", "n", "h", "ci").agg(F.count("*").alias("cw"))
    short = short.groupBy("doc_id", "tid", "m", "key", "n").agg(F.sum(F.least("cw", "ci")).alias("common"))
    short = short.withColumn("similarity", F.col("common") / (F.col("n") + F.col("m") - F.col("common")))
    short = short.where(F.col("similarity") >= SIMILARITY).select(
        "doc_id", "tid", "key", F.lit(0).alias("start"), "similarity", F.lit(None).cast("int").alias("distance"))

    # windows that hold enough places with a shingle of the item
    pair = ["doc_id", "tid", "m", "key", "n"]
    hits = said.where(~whole)
    pairs = (hits.groupBy(*pair).agg(F.count("*").alias("places")).where(F.col("places") >= need)
             .select(F.col("doc_id").alias("d"), F.col("tid").alias("t"), F.col("key").alias("k")))
    hits = hits.join(pairs, hits["doc_id"].eqNullSafe(pairs["d"]) & (hits["tid"] == pairs["t"]) & (hits["key"] == pairs["k"]), "left_semi")
    # a place lies in the windows that start from first to last
    last = F.least(F.col("p"), F.col("m") - F.col("n"))
    hits = cut(hits.withColumn("first", F.greatest(F.col("p") - F.col("n") + 1, F.lit(0))).withColumn("last", last))
    windows = cut(covered(hits, pair, need).select("doc_id", "tid", "key", "n", "start"))
    spots = windows.select("doc_id", "tid", "n", "start").distinct()

    asked = windows.select(F.col("doc_id").alias("d"), F.col("tid").alias("t")).distinct()
    texts = docs.join(asked, docs["doc_id"].eqNullSafe(F.col("d")) & (docs["tid"] == F.col("t")), "left_semi")
    places = texts.select("doc_id", "tid", F.posexplode(shingles(F.col("words"), width)).alias("p", "h")).distinct()
    ours = window_simhash(places, spots)
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("doc_id", "tid", "n", "start")]
    ours = windows.alias("x").join(ours.alias("y"), same[0] & same[1] & same[2] & same[3]).select("x.*", "y.fp")
    theirs = simhash(items, ["key", "n"])
    a = blocks(ours)
    b = blocks(theirs.withColumnRenamed("fp", "ifp").withColumn("fp", F.col("ifp"))).drop("fp", "n")
    near = a.join(b, ["key", "block", "value"]).withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))))
    near = cut(near.where(F.col("distance") <= RADIUS).select("doc_id", "tid", "key", "n", "start", "distance").distinct())

    # the exact check: an occurrence counts from behind the ci-th one before it
    turn = F.row_number().over(Window.partitionBy(*pair, "h").orderBy("p"))
    turns = cut(hits.withColumn("turn", turn))
    back = turns.select(F.col("doc_id").alias("d"), F.col("tid").alias("t"), F.col("key").alias("k"), F.col("h").alias("g"),
                        (F.col("turn") + F.col("ci")).alias("u"), F.col("p").alias("q"))
    spans = turns.join(back, turns["doc_id"].eqNullSafe(back["d"]) & (turns["tid"] == back["t"]) & (turns["key"] == back["k"])
                       & (turns["h"] == back["g"]) & (turns["turn"] == back["u"]), "left")
    spans = spans.withColumn("first", F.greatest(F.col("first"), F.coalesce(F.col("q") + 1, F.lit(0)))).where("first <= last")
    exact = covered(spans.select(*pair, "first", "last"), pair, need)
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("doc_id", "tid", "key", "start")]
    found = (near.alias("x").join(exact.alias("y"), same[0] & same[1] & same[2] & same[3])
             .select("x.*", (F.col("count") / (2 * F.col("x.n") - F.col("count"))).alias("similarity")))
    found = found.where(F.col("similarity") >= SIMILARITY).select("doc_id", "tid", "key", "start", "similarity", "distance")
    return found.unionByName(short)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, tid (hash of the text), item_id, start (first word of the window), similarity, distance (null for a
    document shorter than the item): the best window (then the first) of every document's text and benchmark item that match."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("tid"), text_words(F.col("text")).alias("words"))
    items = benchmark.select("item_id", text_words(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    width = F.least(F.size("words"), F.lit(WORDS))
    items = items.select(F.struct("item_id", F.xxhash64("words").alias("h")).alias("key"), width.alias("width"), "words")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most WORDS values
    items = items.withColumn("s", F.coalesce(*[F.when(F.col("width") == w, shingles(F.col("words"), w)) for w in widths])
                             if widths else F.array().cast("array<bigint>"))
    items = cut(items.select("key", "width", "s", F.size("s").alias("n")))
    out = None
    for w in widths:
        part = _of_width(docs, items, w)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.select("doc_id", "tid", F.struct(F.lit(None).cast("long").alias("item_id")).alias("key"), F.lit(0).alias("start"),
                          F.lit(0.0).alias("similarity"), F.lit(0).alias("distance")).where(F.lit(False))
    out = out.withColumn("item_id", F.col("key.item_id"))
    best = F.min_by(F.struct("start", "similarity", "distance"), F.struct(-F.col("similarity"), F.col("start")))
    return out.groupBy("doc_id", "tid", "item_id").agg(best.alias("b")).select("doc_id", "tid", "item_id", "b.*")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = F.min_by(F.struct("start", "similarity", "distance"), F.struct(-F.col("similarity"), F.col("start")))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.similarity", "b.start"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    bad = matches(docs, benchmark).select(F.col("doc_id").alias("__d"), F.col("tid").alias("__t")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("__d")) & (F.xxhash64(docs["text"]) == F.col("__t"))
    return docs.join(cut(bad), same, "left_anti")


OP3_SQL = r"""
with dw as (select doc_id, text, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') w
    from (select distinct doc_id, text from documents)),
iw as (select distinct item_id, w, array_to_string(w, ' ') it, least(len(w), 5) k from (select item_id,
    list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') w from benchmark) where len(w) > 0),
ds as (select doc_id, text, k, len(w) - k + 1 m, unnest(range(1, len(w) - k + 2)) p, w
    from dw, (select distinct k from iw) where len(w) >= k),
dsh as (select doc_id, text, k, m, p, array_to_string(w[p:p + k - 1], ' ') s from ds),
ish as (select item_id, it, k, len(w) - k + 1 n, array_to_string(w[p:p + k - 1], ' ') s
    from (select *, unnest(range(1, len(w) - k + 2)) p from iw)),
ic as (select item_id, it, k, n, s, count(*) ci from ish group by all),
hit as (select doc_id, text, item_id, it, k, n, m, p from dsh join ic using (k, s)),
win as (select distinct doc_id, text, item_id, it, k, n, m, st, least(n, m) size from (
    select *, unnest(range(greatest(p - n + 1, 1), p + 1)) st from hit where m >= n
    union all select *, 1 st from hit where m < n) where st + least(n, m) - 1 <= m),
cw as (select win.*, s, count(*) c from win join dsh on dsh.doc_id is not distinct from win.doc_id and dsh.text = win.text
    and dsh.k = win.k and dsh.p between st and st + size - 1 group by all),
sim as (select doc_id, text, item_id, it, st, sum(least(c, ci)) / (n + size - sum(least(c, ci))) similarity
    from cw join ic using (item_id, it, k, n, s) group by doc_id, text, item_id, it, st, n, size)
select doc_id, item_id, max(similarity)::double similarity, arg_min(st - 1, (-similarity, st))::int "start"
from sim where similarity >= 0.8 group by doc_id, item_id
"""
