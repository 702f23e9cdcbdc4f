"""Mixing sources to target weights by Pareto order sampling.

Every document of a source has the same expected number of copies times its own ``weight`` (1 by
default), scaled so that the source's expected words meet its target. The whole part of that number
is taken for certain. For the rest, with inclusion probability p, documents are ranked by
``(u / (1 - u)) / (p / (1 - p))`` (u: uniform from a hash of seed and id) and taken in that order
while the source's words come nearer to its target.

A source is never put in one task: ranks are cut into bins of equal width of ``q / (1 + q)``. The
cut falls near q = 1 whatever p is, where a bin holds at most about 1 / BINS of a source. Words are
summed by bin first (partial aggregates), and only the bin in which the target is met is ordered.

Defined results: null text has size 0 and is never taken; null source is a source of its own, last
in order; repeated rows are rows of their own (each counted and taken separately, ties of rank broken
by id, size and copies, else equal); an empty table gives no rows; columns of other names are left
alone by ``mix_documents`` (its own are listed in ADDED and replace columns of that name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchcredit.llm.common import cut, table

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
BINS = 4096
SEED = "pareto-1"
ADDED = ("size", "source_size", "target", "copies", "taken")


def text_size(text: Column) -> Column:
    """Runs of other bytes than space and \\t to \\r; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target): shares of the whole by weight, none above ``most`` times its size.

    The table of sources is small beside the documents (one row each). Sources are filled up in the
    order of limit to weight: once one's equal share of what is left reaches no limit, none later does.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.row_number().over(order) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (place % len(weights) + 1).cast("int")).cast("long")
    per = per.withColumn("w", w).withColumn("limit", F.lit(most).cast("long") * F.col("source_size"))
    fill = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before, rest = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = per.withColumn("level", (F.sum("source_size").over(rest) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
                         / (F.sum("w").over(rest) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    per = per.withColumn("full", F.col("limit") <= F.col("level") * F.col("w"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("w"), F.col("level")))).over(rest)["level"]
    return per.select("source", "source_size", F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        F.least(F.col("limit").cast("double"), F.col("w") * level)).alias("target"))


def uniform(doc_id: Column, seed: str) -> Column:
    """In (0, 1), from the first 12 hex digits of an MD5 of seed and id."""
    h = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(h, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(2**48))


def ranked(rows: DataFrame, totals: DataFrame, most: int, seed: str) -> DataFrame:
    """``rows`` (doc_id, source, size, __m) with certain copies, rank and bin of rank of the rest."""
    rows = rows.join(totals, rows["source"].eqNullSafe(totals["__s"])).drop("__s")
    expected = F.when((F.col("size") > 0) & (F.col("__load") > 0),
                      F.least(F.col("target") * F.col("__m") / F.col("__load"), F.lit(float(most)))).otherwise(F.lit(0.0))
    rows = rows.withColumn("__c", expected).withColumn("__whole", F.floor("__c").cast("long"))
    u, p = uniform(F.col("doc_id"), seed), F.col("__c") - F.col("__whole")
    rows = rows.withColumn("__q", F.when(p > 0, u / (1.0 - u) / (p / (1.0 - p))))
    return rows.withColumn("__bin", F.floor(F.col("__q") / (1.0 + F.col("__q")) * BINS).cast("int"))


def cut_points(narrow: DataFrame, weights: tuple[int, ...], most: int, seed: str) -> DataFrame:
    """One row a source: its totals and target, the words still needed after the certain copies, and the
    bin of ranks in which they are met with the words before that bin."""
    totals = source_targets(narrow.select("source", "size"), weights, most)
    loads = narrow.groupBy(F.col("source").alias("__s")).agg(F.sum(F.col("__m") * F.col("size")).alias("__load"))
    totals = cut(totals.join(loads, totals["source"].eqNullSafe(loads["__s"]))
                 .select("__s", "source_size", "target", "__load"))
    words = F.sum(F.when(F.col("__q").isNotNull(), F.col("size")).otherwise(F.lit(0)))
    bins = (ranked(narrow, totals, most, seed).groupBy("source", "target", "__bin")
            .agg(F.sum(F.col("__whole") * F.col("size")).alias("sure"), words.alias("words")))
    each = Window.partitionBy("source")
    run = F.sum("words").over(each.orderBy(F.col("__bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.select("source", "__bin", "words", (F.col("target") - F.sum("sure").over(each)).alias("need"),
                       (run - F.col("words")).alias("start"))
    here = F.col("__bin").isNotNull() & (F.col("start") < F.col("need")) & (F.col("start") + F.col("words") >= F.col("need"))
    met = bins.groupBy(F.col("source").alias("__k")).agg(
        F.max("need").alias("__need"), F.max(F.when(here, F.col("__bin"))).alias("__met"),
        F.max(F.when(here, F.col("start"))).alias("__start"))
    return cut(totals.join(met, totals["__s"].eqNullSafe(met["__k"])).drop("__k"))


def mix_documents(docs: DataFrame, weight: str | None = None, weights: tuple[int, ...] = WEIGHTS,
                  most: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (copies times size) of each row.

    ``weight`` names a column of positive weights that make inclusion unequal within a source. If ``docs``
    has a column size and no text, that is the size.
    """
    given = [c for c in docs.columns if c not in ADDED]
    size = text_size(F.col("text")) if "text" in docs.columns else F.col("size").cast("long")
    mine = F.lit(1.0) if weight is None else F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = docs.withColumn("size", size).drop(*ADDED[1:]).withColumn("__m", mine)
    points = cut_points(cut(rows.select("doc_id", "source", "size", "__m")), weights, most, seed)
    rows = ranked(rows, points, most, seed)
    at_cut = F.coalesce(F.col("__bin") == F.col("__met"), F.lit(False))
    # only rows of the bin of the cut are ordered; no other row is shuffled
    run = F.sum("size").over(Window.partitionBy("source").orderBy("__q", "doc_id", "size")
                             .rowsBetween(Window.unboundedPreceding, 0))
    rows = (rows.where(~at_cut).withColumn("__run", F.lit(None).cast("long"))
            .unionByName(rows.where(at_cut).withColumn("__run", run)))
    end, need = F.col("__start") + F.col("__run"), F.col("__need")
    enters = end - F.col("size") < need
    extra = (F.when(F.col("__q").isNull() | (need <= 0), 0)
             .when(F.col("__run").isNotNull(), ((end <= need) | (enters & (end - need <= need - (end - F.col("size"))))).cast("int"))
             .when(F.col("__met").isNull() | (F.col("__bin") < F.col("__met")), 1).otherwise(0))
    rows = rows.withColumn("copies", (F.col("__whole") + extra).cast("long"))
    return rows.select(*given, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op5_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = cut(docs.select("doc_id", "source", text_size(F.col("text")).alias("size")))
    mixed = mix_documents(sizes)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def repeat(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each document as many times as it was taken, with its own columns."""
    mixed = mix_documents(docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("__row")))
    return mixed.where("copies > 0").withColumn("__i", F.explode(F.expr("sequence(1L, copies)"))).select("__row.*")


OP5_SQL = rf"""
with d as (select doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size from documents),
s0 as (select source, sum(size)::bigint source_size from d group by source),
s1 as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 w, 3 * source_size lim from s0),
s2 as (select *, (sum(source_size) over () - coalesce(sum(lim) over (order by lim / w, source nulls last
        rows between unbounded preceding and 1 preceding), 0))
    / (sum(w) over () - coalesce(sum(w) over (order by lim / w, source nulls last
        rows between unbounded preceding and 1 preceding), 0)) lev from s1),
s3 as (select *, lim <= lev * w isfull from s2),
s as (select source, source_size, case when isfull then lim::double else least(lim::double, w *
    (select arg_min(lev, lim / w) from s3 where not isfull)) end target from s3),
e as (select d.*, source_size, target, case when size > 0 then least(target * 1.0::double / source_size, 3.0::double)
    else 0.0::double end c, (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 12))::bigint::double + 0.5)
    / 281474976710656.0::double u from d join s on d.source is not distinct from s.source),
q as (select *, floor(c)::bigint whole, c - floor(c) p from e),
r as (select *, case when p > 0 then u / (1.0::double - u) / (p / (1.0::double - p)) end q,
    target - sum(whole * size) over (partition by source) need from q),
f as (select *, sum(size) over (partition by source, p > 0 order by q, doc_id, size
    rows between unbounded preceding and current row) fin from r)
select doc_id, size, source_size, target, ((whole + case when p > 0 and need > 0 and (fin <= need or
    (fin - size < need and fin - need <= need - (fin - size))) then 1 else 0 end) * size)::bigint taken from f
"""
