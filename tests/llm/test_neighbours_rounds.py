"""NN-descent from a poor start: it goes on until few neighbours change, however many rounds that takes."""

import numpy as np

from touchcredit.llm import neighbours


def recall_from_poor_start(spark, module, monkeypatch):
    # blocks dealt out by hash, as for a table far larger than its pivots can tell apart
    monkeypatch.setattr(module, "BLOCK", 10)
    monkeypatch.setattr(module, "PIVOTS", 1)
    x = np.random.default_rng(1).normal(size=(3000, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "node long, vec array<double>")
    graph, _ = module.build_graph(module.cut(rows.mapInArrow(module._unit, "node bigint, unit binary")))
    found = {}
    for r in graph.collect():
        found.setdefault(r.u, set()).add(r.w)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    best = np.argsort(-s, axis=1)[:, :5]
    return np.mean([w in found.get(u, ()) for u in range(len(x)) for w in best[u].tolist()])


def test_rounds_until_few_change(spark, monkeypatch):
    assert recall_from_poor_start(spark, neighbours, monkeypatch) >= 0.998
