"""First-click and last-click credit (J1 + W1/W2).

Semantics: a conversion at ``c`` of user ``u`` is credited to one
touchpoint of ``u`` with ``c - L <= t <= c`` (both ends inclusive, ``L`` the
lookback in exact micros). First click takes the smallest
``(t, session, channel)``, last click the largest; NULL session orders
lowest, so it wins a time tie in first click and loses it in last click.
Conversions without an eligible touchpoint get no row (see the orphan check).

Equivalent as-of form, used here: last click = the latest touchpoint at or
before ``c``, kept if it is not older than ``c - L``; first click = the
earliest touchpoint at or after ``c - L``, kept if it is not after ``c``.
Both come from one ``asof_core`` pass, so no touchpoint x conversion pairs
are ever formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchcredit import config as C
from touchcredit.functions import columns as fc
from touchcredit.operators.asof import asof_core

CREDIT_COLUMNS = [
    "conversion_id", "conversion_date", "purchase_revenue", "attributed_channel",
    "attribution_model", "touchpoint_us", "touch_session_id", "conversion_us",
]
MART_COLUMNS = ["conversion_id", "conversion_date", "purchase_revenue",
                "attributed_channel", "attribution_model"]


def credit(touch: DataFrame, conv: DataFrame, lookback_us: int,
           chunk_us: int = 60_000_000, models: tuple[str, ...] = C.MODELS,
           fine_us: int | None = None) -> DataFrame:
    """One row per credited (conversion, model).

    Touchpoints and conversions go through one partial aggregate keyed by
    ``(user, micros)``: it collapses copies and time ties of touchpoints
    and, since ``conversion_id`` is user + micros, picks the one row kept
    per conversion (largest revenue, NULL lowest, then latest date) in the
    same shuffle. Each kept conversion then becomes a last-click probe at
    ``c`` and a first-click probe at ``c - L``.

    Windows run over (user, ``chunk_us``) groups, or (user, ``fine_us``) groups where that is given.
    """
    L = int(lookback_us)
    payload = F.struct(
        F.col("touchpoint_us").alias("t"),
        F.col("ga_session_id").alias("sid"),
        F.col("channel").alias("channel"),
    )
    pick = F.struct(
        F.col("purchase_revenue").alias("purchase_revenue"),
        F.col("conversion_date").alias("conversion_date"),
        F.col("conversion_id").alias("conversion_id"),
    )
    pts = touch.select(F.col("user_pseudo_id").alias("_k"), F.col("touchpoint_us").alias("_t"),
                       payload.alias("_m"))
    cvs = conv.where(F.col("conversion_id").isNotNull()) \
        .select(F.col("user_pseudo_id").alias("_k"), F.col("conversion_us").alias("_t"), pick.alias("_c"))
    both = pts.unionByName(cvs, allowMissingColumns=True)
    return _credit_union(both, L, chunk_us, models, fine_us)


def credit_events(stg: DataFrame, lookback_us: int, chunk_us: int = 60_000_000,
                  models: tuple[str, ...] = C.MODELS,
                  fine_us: int | None = None) -> DataFrame:
    """Same as ``credit(touchpoints(stg), conversions(stg), ...)`` from a
    single pass over the staging relation: one ``event_name IN (...)``
    filter (pushed to the reader) instead of one scan per role."""
    name = F.col("event_name")
    is_touch, is_conv = name == C.TOUCH_EVENT, name == C.CONVERSION_EVENT
    payload = F.struct(
        F.col("event_timestamp").alias("t"),
        F.col("ga_session_id").alias("sid"),
        fc.channel_label("source", "medium").alias("channel"),
    )
    cid = fc.conversion_id("user_pseudo_id", "event_timestamp")
    pick = F.struct(
        F.col("purchase_revenue").alias("purchase_revenue"),
        F.col("event_date").alias("conversion_date"),
        cid.alias("conversion_id"),
    )
    both = (stg.where(name.isin(C.TOUCH_EVENT, C.CONVERSION_EVENT))
            .select(F.col("user_pseudo_id").alias("_k"), F.col("event_timestamp").alias("_t"),
                    F.when(is_touch, payload).alias("_m"),
                    F.when(is_conv & cid.isNotNull(), pick).alias("_c"))
            .where(F.col("_m").isNotNull() | F.col("_c").isNotNull()))
    return _credit_union(both, int(lookback_us), chunk_us, models, fine_us)


def _credit_union(both: DataFrame, L: int, chunk_us: int, models, fine_us) -> DataFrame:
    """Rows ``(_k, _t, _m touch payload | NULL, _c conversion pick | NULL)``
    -> credited rows."""
    for m in models:
        if m not in C.MODELS:
            raise ValueError(f"unknown model {m!r}")
    both = both.where(F.col("_k").isNotNull() & F.col("_t").isNotNull())
    grouped = (both
               .groupBy("_k", "_t")
               .agg(F.max("_m").alias("_mx"), F.min("_m").alias("_mn"), F.max("_c").alias("_c")))

    # One pass over the aggregate: each (user, micros) row yields its point
    # row and its probes (NULL entries are dropped after ``inline``).
    in_schema = both.schema  # one analysis; the aggregate keeps these types
    pay_t = in_schema["_m"].dataType
    c_t = in_schema["_c"].dataType
    probe_type = T.StructType([
        T.StructField("__fwd", T.BooleanType(), False),
        T.StructField("attribution_model", T.StringType(), False),
        T.StructField("conversion_us", T.LongType(), True),
        T.StructField("c", c_t, True),
    ])

    def probe(model: str, fwd: bool, at):
        p = F.struct(F.lit(fwd).alias("__fwd"), F.lit(model).alias("attribution_model"),
                     F.col("_t").alias("conversion_us"), F.col("_c").cast(c_t).alias("c"))
        return F.when(F.col("_c").isNotNull(), F.struct(
            at.alias("_t"), F.lit(None).cast(pay_t).alias("_mx"), F.lit(None).cast(pay_t).alias("_mn"),
            p.alias("_p")))

    kinds = []
    if C.FIRST_CLICK in models:
        kinds.append(probe(C.FIRST_CLICK, True, F.col("_t") - F.lit(L)))
    if C.LAST_CLICK in models:
        kinds.append(probe(C.LAST_CLICK, False, F.col("_t")))
    point = F.when(F.col("_mx").isNotNull(), F.struct(
        F.col("_t").alias("_t"), F.col("_mx").alias("_mx"), F.col("_mn").alias("_mn"),
        F.lit(None).cast(probe_type).alias("_p")))
    rows = grouped.select("_k", F.inline(F.array(point, *kinds))).where(F.col("_t").isNotNull())
    matched = asof_core(rows, chunk_us, fine_us)
    p, m = F.col("_p"), F.col("_match")
    c_us = p["conversion_us"]
    eligible = m.isNotNull() & F.when(p["__fwd"], m["t"] <= c_us).otherwise(m["t"] >= c_us - F.lit(L))
    return matched.where(eligible).select(
        p["c"]["conversion_id"].alias("conversion_id"),
        p["c"]["conversion_date"].alias("conversion_date"),
        p["c"]["purchase_revenue"].alias("purchase_revenue"),
        m["channel"].alias("attributed_channel"),
        p["attribution_model"].alias("attribution_model"),
        m["t"].alias("touchpoint_us"),
        m["sid"].alias("touch_session_id"),
        c_us.alias("conversion_us"),
    )


def mart(credited: DataFrame, model: str) -> DataFrame:
    """``mart_attribution_first_click`` / ``_last_click``."""
    return credited.where(F.col("attribution_model") == model).select(*MART_COLUMNS)
