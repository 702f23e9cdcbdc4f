"""Exact as-of match without pair fan-out.

For every probe row find, among the point rows with the same key, the
greatest payload with ``time <= probe_time`` (backward) or the least payload
with ``time >= probe_time`` (forward). Payload is a struct whose first field
is the time, so struct order = time order, then the tie keys.

Plan (no shuffle carries pairs):

0. points collapse per ``(key, time)`` (max and min payload) with a
   map-side partial aggregate: copies and ties never pile up in one task.
   Probes must already be unique per (key, time, direction).
1. points and probes are unioned and hash-partitioned by ``(key, chunk)``,
   ``chunk = floor(time / chunk_us)``. Within a chunk, a running max (time asc)
   and a running min (time desc) over ``RANGE UNBOUNDED PRECEDING`` give the
   local answer; RANGE includes peers, so equal times count (inclusive
   ends).
2. A per-``(key, chunk)`` summary (max and min payload, partial aggregate)
   is windowed by key in chunk order: the carry is the best payload of all earlier chunks
   (backward) or of all later chunks (forward). One row per active
   ``(key, chunk)``, so a key's history is never gathered in one task.
   With minutes a key has at most 1,440 summary rows a day of history, however many points it has. Where chunks are
   wider (they are split into minutes) or a finer width is given, chunks have two widths: rows are windowed by the fine one, summaries within the coarse one, and
   the sums of those by key; so a burst inside one chunk is split without a list of hot keys.
3. Probes meet their carry with an equi-join on ``(key, chunk)``; the
   summary side is unique per key, so the join cannot fan out.

Cost is one sort of the data per direction, independent of how many points
fall inside any interval. ``chunk_us`` bounds the rows a single window task
sees for one key (a hot key spreads over its chunks); results do not depend
on it. Rows with a NULL key are dropped first: a window would group NULL
keys together while an equi-join never matches them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MINUTE_US = 60_000_000
_KEY, _T, _CH, _M, _P = "_k", "_t", "_chunk", "_m", "_p"


def _floor_div(t: Column, width: int) -> Column:
    """Exact ``floor(t / width)``: ``t - pmod(t, width)`` is an exact
    multiple of ``width``, so the quotient is exact for |t| < 2^53 micros
    (about 285 years around 1970), negative times included."""
    if width <= 0:
        raise ValueError("chunk width must be positive")
    w = F.lit(int(width))
    return ((t - F.pmod(t, w)) / w).cast("bigint")


def _chunk(t: Column, chunk_us: int) -> Column:
    """Chunk index ``floor(t / chunk_us)``."""
    return _floor_div(t, chunk_us)


def fine_width(chunk_us: int, fine_us: int | None = None) -> int:
    """Width of the chunks that windows run over. Unless given, it is a minute for chunks that are some minutes
    wide, and the chunk itself otherwise."""
    if fine_us is None:
        return MINUTE_US if chunk_us > MINUTE_US and chunk_us % MINUTE_US == 0 else chunk_us
    if chunk_us % int(fine_us):
        raise ValueError("chunk_us must be a multiple of fine_us")
    return int(fine_us)


def asof_match(points: DataFrame, probes: DataFrame, *, key: str, time: str,
               payload: Column, probe_time: Column, forward: Column,
               chunk_us: int) -> DataFrame:
    """Return ``probes`` (all columns) plus ``_match``: the payload struct
    of the nearest point, or NULL.

    ``points`` needs ``key`` and ``time`` (bigint) columns; ``payload`` is a
    struct over ``points`` whose first field is the time. ``probes`` needs
    ``key``; ``probe_time`` (bigint) and ``forward`` (boolean) are
    expressions over ``probes``. Probes must be unique per
    (key, probe_time, forward).
    """
    probe_cols = probes.columns
    # Copies and exact-time ties of points collapse first, with a map-side
    # partial aggregate, so no group of copies reaches one window task.
    pts = (points.where(F.col(key).isNotNull() & F.col(time).isNotNull())
           .select(F.col(key).alias(_KEY), F.col(time).cast("bigint").alias(_T),
                   payload.alias(_M))
           .groupBy(_KEY, _T).agg(F.max(_M).alias("_mx"), F.min(_M).alias("_mn")))
    prb = (probes.where(F.col(key).isNotNull())
           .select(F.col(key).alias(_KEY), probe_time.cast("bigint").alias(_T),
                   F.struct(forward.alias("__fwd"), *[F.col(c) for c in probe_cols]).alias(_P))
           .where(F.col(_T).isNotNull()))
    matched = asof_core(pts.unionByName(prb, allowMissingColumns=True), chunk_us)
    return matched.select(*[F.col(f"{_P}.{c}").alias(c) for c in probe_cols], "_match")


def asof_core(u: DataFrame, chunk_us: int, fine_us: int | None = None) -> DataFrame:
    """Steps 1–3 on a prepared union: rows ``(_k, _t, _mx, _mn, _p)`` where
    point rows carry the max/min payload at ``(_k, _t)`` (unique per pair)
    and probe rows carry ``_p`` (a struct whose first field ``__fwd`` is the
    direction). Returns the probe rows as ``(_p, _match)``."""
    fine = fine_width(int(chunk_us), fine_us)
    ratio = int(chunk_us) // fine
    u = u.select("*", _chunk(F.col(_T), fine).alias(_CH))

    local_up = Window.partitionBy(_KEY, _CH).orderBy(F.col(_T).asc()) \
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local_down = Window.partitionBy(_KEY, _CH).orderBy(F.col(_T).desc()) \
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    win = u.select("*", F.max("_mx").over(local_up).alias("_back"),
                   F.min("_mn").over(local_down).alias("_fore"))

    # One row per active (key, chunk): its best points. Partial aggregation
    # before the (small) shuffle.
    summary = u.groupBy(_KEY, _CH).agg(F.max("_mx").alias("_cmax"), F.min("_mn").alias("_cmin"))
    carry = _carry(summary, [_KEY], _CH)
    if ratio > 1:
        # chunks before this one in its hour, and the hours before
        hour = _floor_div(F.col(_CH), ratio).alias("_hour")
        summary = summary.select("*", hour)
        near = _carry(summary, [_KEY, "_hour"], _CH)
        hours = summary.groupBy(_KEY, "_hour").agg(F.max("_cmax").alias("_cmax"), F.min("_cmin").alias("_cmin"))
        far = _carry(hours, [_KEY], "_hour").select(
            _KEY, "_hour", F.col("_carry_back").alias("_far_back"), F.col("_carry_fore").alias("_far_fore"))
        carry = near.join(far, [_KEY, "_hour"], "inner").select(
            _KEY, _CH, F.greatest("_carry_back", "_far_back").alias("_carry_back"),
            F.least("_carry_fore", "_far_fore").alias("_carry_fore"))

    hits = win.where(F.col(_P).isNotNull())
    joined = hits.join(carry, [_KEY, _CH], "inner")
    match = F.when(
        F.col(f"{_P}.__fwd"),
        F.least(F.col("_fore"), F.col("_carry_fore")),
    ).otherwise(F.greatest(F.col("_back"), F.col("_carry_back")))
    return joined.select(_P, match.alias("_match"))


def _carry(summary: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The best payload of all earlier rows and of all later rows of the same keys."""
    before = Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(
        *dict.fromkeys([*keys, order]),
        F.max("_cmax").over(before.orderBy(F.col(order).asc())).alias("_carry_back"),
        F.min("_cmin").over(before.orderBy(F.col(order).desc())).alias("_carry_fore"),
    )
