"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced in full with a ``noop`` write (every row and column
computed, nothing collected). Each query runs once untimed (JVM JIT and
code generation warm-up), then ``BENCH_REPS`` timed runs (default 3); the
best run is reported, the cold run too. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "channel_daily",
    "channel_daily_hot_user",
    "attribution_first_click_30d",
    "attribution_last_click_7d",
    "stg_events",
    "stream_union_marts",
    "stream_replay_counts",
    "model_disagreement",
    "trend_14",
    "dq_orphan_rate",
    "dq_summary",
    "stream_attribution",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from touchcredit.plans import catalogue
    from touchcredit.session import local_session

    n = int(cpus) if cpus.isdigit() else 8
    spark = local_session(cpus, shuffle_partitions=max(4, n))
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="touchcredit-bench-"))
    qs = catalogue.queries()
    names = [q for q in (sys.argv[1:] or HEADLINE) if q in qs]

    reps = int(os.environ.get("BENCH_REPS", "3"))

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            cold[name] = round(run(name), 3)
            times[name] = round(min(run(name) for _ in range(max(1, reps))), 3)
        except Exception as e:  # noqa: BLE001 - report and keep measuring the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    spark.stop()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold_queries": cold,
        "mode": f"warm, best of {max(1, reps)} after one untimed run",
        "sf": sf,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
