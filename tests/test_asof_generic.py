"""The generic as-of operator on its own: nearest point at/before or
at/after each probe, any key, ties by payload order."""

import random

from pyspark.sql import functions as F

from touchcredit.operators.asof import asof_match


def test_asof_match_matches_brute_force(spark):
    rnd = random.Random(7)
    pts = [(rnd.choice("xyz"), rnd.randrange(0, 200), rnd.randrange(0, 5)) for _ in range(150)]
    prb = [(i, rnd.choice("xyzw"), rnd.randrange(-10, 210), rnd.random() < 0.5) for i in range(80)]
    p = spark.createDataFrame(pts, "k string, t bigint, v bigint")
    q = spark.createDataFrame(prb, "id int, k string, at bigint, fwd boolean")
    for chunk in (1, 13, 1000):
        got = asof_match(p, q, key="k", time="t", payload=F.struct("t", "v"),
                         probe_time=F.col("at"), forward=F.col("fwd"), chunk_us=chunk).collect()
        got = {r.id: (None if r._match is None else (r._match.t, r._match.v)) for r in got}
        for i, k, at, fwd in prb:
            cand = [(t, v) for kk, t, v in pts if kk == k and (t >= at if fwd else t <= at)]
            want = (min(cand) if fwd else max(cand)) if cand else None
            assert got[i] == want, (chunk, i)
