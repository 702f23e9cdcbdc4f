"""Cells of near vectors that grow in number with the vectors: large cells are split by pivots of their own.

A cell of more than ``block`` vectors draws up to ``FAN`` pivots among its own members, one of each of as many hash classes
(an aggregate with a map-side part, so no cell is gathered to draw them), and each member goes to the nearest. Members meet the
pivots in chunks of the cell of about ``CHUNK`` blocks. This goes on with the cells that are still too large, until none is or the
largest one no longer shrinks (members that their unit vectors hardly tell apart). Nothing but the largest size comes to
the driver.

Defined results: every row comes back once; an empty table stays empty; a cell of at most ``block`` vectors is left as it is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.llm.common import cut

#: Pivots of a cell in one split, and blocks of vectors that meet them in one task.
FAN = 256
CHUNK = 8
#: A split that leaves the largest cell above this share of its size is the last.
SHRINK = 0.9


def matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float16).reshape(len(units), -1).astype(np.float32)


def _nearest(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    if not len(members):
        return members.assign(draw=0)[["node", "unit", "cell", "draw"]]
    pivots = pivots.sort_values("draw")
    near = (matrix(list(members["unit"])) @ matrix(list(pivots["unit"])).T).argmax(axis=1)
    return members.assign(draw=pivots["draw"].to_numpy()[near])[["node", "unit", "cell", "draw"]]


def _split(rows: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    large = sizes.where(F.col("size") > block).select(
        "cell", F.least(F.ceil(2 * F.col("size") / block), F.lit(FAN)).cast("long").alias("parts"),
        F.ceil(F.col("size") / (CHUNK * block)).cast("long").alias("chunks"))
    members = rows.join(large, "cell")
    members = cut(members.withColumn("draw", F.pmod(F.xxhash64("cell", "node"), F.col("parts")))
                  .withColumn("chunk", F.pmod(F.xxhash64("node", "cell"), F.col("chunks"))))
    pivots = members.groupBy("cell", "chunks", "draw").agg(F.min_by("unit", "node").alias("unit"))
    pivots = pivots.select("cell", "draw", "unit", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    near = (members.select("cell", "chunk", "node", "unit").groupBy("cell", "chunk").cogroup(pivots.groupBy("cell", "chunk"))
            .applyInPandas(_nearest, "node bigint, unit binary, cell bigint, draw bigint"))
    near = near.select("node", "unit", F.xxhash64("cell", "draw").alias("cell"))
    return rows.join(large, "cell", "left_anti").select("node", "unit", "cell").unionByName(near)


def split_cells(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` (node, unit, cell) with other cells where these hold more than ``block`` rows."""
    largest = None
    while True:
        sizes = cut(rows.groupBy("cell").agg(F.count("*").alias("size")))
        top = sizes.agg(F.max("size")).first()[0]
        if top is None or top <= block or (largest is not None and top > SHRINK * largest):
            return rows
        largest, rows = top, cut(_split(rows, sizes, block))
