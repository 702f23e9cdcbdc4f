"""Cells of the neighbour graph's start: split by their own pivots, every row kept, recall with few first pivots."""

import numpy as np
from pyspark.sql import functions as F

from touchcredit.llm import cells, neighbours


def unit_rows(spark, x, cell=None):
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float16)
    return spark.createDataFrame([(i, bytearray(v.tobytes()), 0 if cell is None else int(cell[i])) for i, v in enumerate(x)],
                                 "node bigint, unit binary, cell bigint")


def clustered(n, clusters, seed=5, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return centres[rng.integers(0, clusters, n)] + 0.2 * rng.normal(size=(n, dim))


def test_large_cells_are_split_and_every_row_stays(spark):
    x = clustered(1500, 40)
    cell = np.where(np.arange(1500) < 1400, 1, 2)
    got = cells.split_cells(unit_rows(spark, x, cell), 100).select("node", "cell").collect()
    assert sorted(r.node for r in got) == list(range(1500))
    sizes = {}
    for r in got:
        sizes[r.cell] = sizes.get(r.cell, 0) + 1
    assert max(sizes.values()) <= 100
    assert {r.cell for r in got if r.node >= 1400} == {2}  # small enough: as it was


def test_members_that_cannot_be_told_apart_end_the_splits(spark):
    x = np.ones((500, 8))
    got = cells.split_cells(unit_rows(spark, x), 50)
    assert got.count() == 500 and got.select("node").distinct().count() == 500


def test_empty_table_has_no_cells(spark):
    assert cells.split_cells(unit_rows(spark, np.ones((1, 8))).where(F.lit(False)), 50).count() == 0


def test_recall_with_few_first_pivots(spark, monkeypatch):
    """Two pivots at most and small blocks, as at a size where the limit on pivots bites."""
    monkeypatch.setattr(neighbours, "PIVOTS", 2)
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    x = clustered(2000, 50, seed=9)
    rows = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(neighbours.vectors(rows), F.col("id") % 50 == 0).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    right = 0
    for q in range(0, 2000, 50):
        s = unit @ unit[q]
        s[q] = -2
        right += len(set(np.argsort(-s)[:5]) & {r.vec_id for r in got if r.query_id == q})
    assert right / (40 * 5) >= 0.95
