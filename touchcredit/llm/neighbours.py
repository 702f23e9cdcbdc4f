"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Equal vectors are one node. The graph starts from exact neighbours within small blocks of vectors that share
their nearest pivot (``SETS`` sets of pivots; a block has about ``BLOCK`` vectors, larger cells are split by pivots of their
own, see ``cells``, and those that cannot be split are dealt out by hash). Each round joins a sample of every node's neighbours, in both directions, with each other (neighbours of
neighbours) and keeps the best ``DEGREE`` for each node, until less than the share ``STOP`` of them changes, however
many rounds that takes (a list only ever improves, so the rounds end). A search holds a beam of the best nodes seen for
each query; in each round the beam's unexpanded nodes are joined with their neighbours. All rounds are Spark
joins; the first pivots, at most ``PIVOTS`` vectors of a set, are all that comes to the driver, and cells grow in number beyond them.

The beam's best are ranked again by exact cosine in double precision on the original vectors; equal vectors
come in by their smallest ids, of which no more than the wanted number are needed.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component takes no part, nor
does one of another length than the commonest (of equally common ones the longest); lengths however small or large are compared, as
each vector is scaled by a power of two first, which changes no bit of a cosine; rows of equal id and vector are one row, and no row of a query's
own id is its neighbour; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchcredit.llm.cells import matrix, split_cells
from touchcredit.llm.common import cut, table

NEAREST = 5
DEGREE = 32
#: Neighbours of each direction that a round joins, drawn anew, and pairs that each of them may gain there.
SAMPLED = 14
GAINED = 8
STOP = 0.02
SETS = 6
BLOCK = 2000
PIVOTS = 1024
BEAM = 128
#: Links that a search follows backwards from a node.
BACK = 64
ENTRIES = 4
GROUP = 128


def vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, vec (doubles) of the rows that take part, each pair once."""
    doubles = F.transform(vec_col, lambda x: x.cast("double"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), doubles.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0))
    # -0.0 and 0.0 are one value
    rows = rows.select("id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec"), F.size("vec").alias("n"))
    common = rows.groupBy("n").agg(F.count("*").alias("c")).orderBy(F.col("c").desc(), F.col("n").desc()).first()
    return rows.where(F.col("n") == F.lit(common["n"] if common else 0)).select("id", "vec").distinct()


def scaled(vec: Column) -> Column:
    """``vec`` times a power of two that brings its largest component near 1, so that no product under- or overflows."""
    largest = F.array_max(F.transform(vec, lambda x: F.abs(x)))
    power = F.greatest(F.lit(-1000.0), F.least(F.lit(1000.0), -F.floor(F.log2(largest))))
    return F.transform(vec, lambda x: x * F.pow(F.lit(2.0), power))


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["node", "unit"])


def _place(pivots: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the nearest pivot of each set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1).to_pylist())
                for k, p in enumerate(pivots):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(np.full(len(x), k, np.int32)),
                         pa.array((x @ p.T).argmax(axis=1).astype(np.int32))], ["node", "unit", "round", "pivot"])

    return run


def _edges(node: np.ndarray, other: np.ndarray, sim: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"u": node, "w": other, "sim": sim.astype(np.float32)})


def _block_neighbours(pdf: pd.DataFrame) -> pd.DataFrame:
    x, node = matrix(list(pdf["unit"])), pdf["node"].to_numpy()
    k = min(DEGREE // 2, len(x) - 1)
    if k < 1:
        return _edges(node[:0], node[:0], np.zeros(0))
    s = x @ x.T
    np.fill_diagonal(s, -2)
    best = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return _edges(np.repeat(node, k), node[best].ravel(), np.take_along_axis(s, best, 1).ravel())


def _local_join(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each centre v of a group, the similarities of all pairs of its neighbours: for each, those of the best
    few that beat its worst neighbour."""
    pdf = pdf.sort_values("v", kind="stable")
    x, u, worst = matrix(list(pdf["unit"])), pdf["u"].to_numpy(), pdf["worst"].to_numpy()
    _, first, size = np.unique(pdf["v"].to_numpy(), return_index=True, return_counts=True)
    width = int(size.max())
    at = first[:, None] + np.arange(width)
    real = np.arange(width) < size[:, None]
    at = np.where(real, at, 0)
    s = np.matmul(x[at], x[at].transpose(0, 2, 1))
    s[~(real[:, :, None] & real[:, None, :])] = -2
    s[:, np.arange(width), np.arange(width)] = -2
    keep = min(GAINED, width)
    best = np.argpartition(-s, keep - 1, axis=2)[:, :, :keep]
    sim = np.take_along_axis(s, best, 2)
    rows = np.broadcast_to(at[:, :, None], sim.shape)
    ok = (sim > worst[rows]) & (sim > -2)
    others = np.take_along_axis(np.broadcast_to(at[:, None, :], s.shape), best, 2)
    out = _edges(u[rows[ok]], u[others[ok]], sim[ok])
    return out.drop_duplicates(["u", "w"])


def _top(rows: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """The first n of each key; Spark keeps n of each before it shuffles."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("__r", rank).where(F.col("__r") <= n).drop("__r")


def _sample(nodes: DataFrame, n: int, salt: int) -> list[tuple[int, bytes]]:
    return [(r["node"], bytes(r["unit"])) for r in nodes.orderBy(F.xxhash64("node", F.lit(salt))).limit(n).collect()]


def build_graph(nodes: DataFrame) -> tuple[DataFrame, list[tuple[int, bytes]]]:
    """(u, w, sim): at most DEGREE neighbours of each node of (node, unit); and the pivots."""
    n = nodes.count()
    pivots = max(1, min(PIVOTS, 2 * n // BLOCK))
    sets = [_sample(nodes, pivots, salt) for salt in range(SETS)] if n else []
    if not n:
        return nodes.select(F.col("node").alias("u"), F.col("node").alias("w"), F.lit(0.0).cast("float").alias("sim")), []
    placed = cut(nodes.mapInArrow(_place([matrix([v for _, v in s]) for s in sets]),
                                  "node bigint, unit binary, round int, pivot int"))
    placed = split_cells(placed.select("node", "unit", F.xxhash64("round", "pivot").alias("cell")), BLOCK)
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    blocks = placed.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("node", "cell"), "parts"))
    found = (blocks.select("node", "unit", "cell", "part").groupBy("cell", "part")
             .applyInPandas(_block_neighbours, "u bigint, w bigint, sim float"))
    best_first = [F.col("sim").desc(), F.col("w")]
    graph = cut(_top(found.distinct(), "u", best_first, DEGREE))
    k, changed = 0, DEGREE * n
    while changed >= STOP * DEGREE * n:
        drawn = [F.xxhash64("u", "w", F.lit(k)), F.col("w")]
        near = _top(graph.select("u", "w"), "u", drawn, SAMPLED)
        back = _top(near.select(F.col("w").alias("u"), F.col("u").alias("w")), "u", drawn, SAMPLED)
        both = near.unionByName(back).select(F.col("u").alias("v"), F.col("w").alias("u")).distinct()
        worst = graph.groupBy("u").agg(F.when(F.count("*") >= DEGREE, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
        known = nodes.join(worst, nodes["node"] == worst["u"], "left").select(
            F.col("node").alias("u"), "unit", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst"))
        groups = max(1, n // GROUP)
        joined = both.join(known, "u").withColumn("g", F.pmod(F.xxhash64("v"), F.lit(groups)))
        fresh = joined.groupBy("g").applyInPandas(_local_join, "u bigint, w bigint, sim float")
        merged = graph.withColumn("old", F.lit(1)).unionByName(fresh.where("u <> w").withColumn("old", F.lit(0)))
        merged = merged.groupBy("u", "w").agg(F.max("sim").alias("sim"), F.max("old").alias("old"))
        graph = cut(_top(merged, "u", best_first, DEGREE))
        changed = graph.where("old = 0").count()
        graph, k = graph.drop("old"), k + 1
    return graph, sets[0]


def _entries(pivots: list[tuple[int, bytes]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, p = np.array([i for i, _ in pivots]), matrix([v for _, v in pivots])
        k = min(ENTRIES, len(ids))
        for batch in batches:
            if batch.num_rows:
                s = matrix(batch.column(1).to_pylist()) @ p.T
                best = np.argpartition(-s, k - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column(0).to_numpy(), k)), pa.array(ids[best].ravel()),
                     pa.array(np.take_along_axis(s, best, 1).ravel())], ["q", "node", "sim"])

    return run


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            q, node, a, b = batch.columns
            sim = np.einsum("ij,ij->i", matrix(a.to_pylist()), matrix(b.to_pylist()))
            yield pa.RecordBatch.from_arrays([q, node, pa.array(sim)], ["q", "node", "sim"])


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, pivots: list[tuple[int, bytes]],
           own: DataFrame | None = None) -> DataFrame:
    """(q, node, sim): the beam of each query (q, unit). ``own`` (q, node): nodes known to be near a query, as entries."""
    # of a node that very many hold near, the nearest of them: its list goes to every beam that reaches it
    back = _top(graph.select(F.col("w").alias("u"), F.col("u").alias("w"), "sim"), "u", [F.col("sim").desc(), F.col("w")], BACK)
    links = cut(graph.select("u", "w").union(back.select("u", "w")).distinct())
    units = nodes.select("node", F.col("unit").alias("b"))
    asked = queries.select("q", F.col("unit").alias("a"))

    def judged(pairs: DataFrame) -> DataFrame:
        return (pairs.join(units, "node").join(asked, "q").select("q", "node", "a", "b")
                .mapInArrow(_similar, "q bigint, node bigint, sim float"))

    start = queries.select("q", "unit").mapInArrow(_entries(pivots), "q bigint, node bigint, sim float")
    if own is not None:
        start = start.unionByName(judged(own.select("q", "node")))
    order = [F.col("sim").desc(), F.col("node")]
    start = start.groupBy("q", "node").agg(F.max("sim").alias("sim"))
    beam = cut(_top(start, "q", order, BEAM).withColumn("done", F.lit(False)))
    while True:
        ahead = beam.where("not done").select("q", F.col("node").alias("u"))
        if not ahead.limit(1).count():
            return beam.select("q", "node", "sim")
        seen = beam.select("q", "node")
        fresh = ahead.join(links, "u").select("q", F.col("w").alias("node")).distinct().join(seen, ["q", "node"], "left_anti")
        grown = beam.select("q", "node", "sim", F.lit(True).alias("done")).unionByName(
            judged(fresh).withColumn("done", F.lit(False)))
        beam = cut(_top(grown, "q", order, BEAM))


def nearest(rows: DataFrame, is_query: Column, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for each row of (id, vec) that ``is_query`` holds for."""
    rows = cut(rows)
    classes = rows.groupBy("vec").agg(F.min("id").alias("node"))
    classes = cut(classes)
    members = rows.join(classes, "vec").select("id", "node")
    members = cut(members)
    nodes = cut(classes.select("node", "vec").mapInArrow(_unit, "node bigint, unit binary"))
    graph, pivots = build_graph(nodes)
    asked = members.where(is_query).select(F.col("id").alias("q"), F.col("node").alias("own"))
    # equal queries are searched for once, by their node
    once = asked.select(F.col("own").alias("node")).distinct().join(nodes, "node").select(F.col("node").alias("q"), "unit")
    if not pivots:
        empty = rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
        return empty.where(F.lit(False))
    beam = cut(search(once, nodes, graph, pivots, once.select("q", F.col("q").alias("node"))))
    exact = classes.select(scaled(F.col("vec")).alias("vec"), "node")
    left, right = exact.toDF("va", "q"), exact.toDF("vb", "node")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    score = dot("va", "vb") / (F.sqrt(dot("va", "va")) * F.sqrt(dot("vb", "vb")))
    scored = beam.join(left, "q").join(right, "node").select("q", "node", score.alias("score"))
    scored = _top(scored, "q", [F.col("score").desc(), F.col("node")], BEAM)
    few = _top(members.select("node", F.col("id").alias("vec_id")).distinct(), "node", [F.col("vec_id")], k + 1)
    pairs = asked.withColumnRenamed("own", "n").join(scored.withColumnRenamed("q", "n"), "n").join(few, "node")
    pairs = pairs.where("q <> vec_id").groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id")))
    return (pairs.withColumn("rank", rank).where(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), "rank", "vec_id", "score"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(vectors(table(spark, sf_dir, "embeddings")), F.col("id") % 50 == 0)
