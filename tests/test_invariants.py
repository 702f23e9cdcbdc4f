"""Pipeline invariants on the given tables, for several lookbacks."""

import pytest
from pyspark.sql import functions as F

from touchcredit import config as C
from touchcredit.operators import quality
from touchcredit.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("days", [1, 7, 30])
def test_credit_invariants(spark, days):
    p = catalogue.pipeline(spark, SF, lookback_days=days).with_written_credit()
    conv = p.conversions
    n_conv = conv.select("conversion_id").distinct().count()
    first, last = p.mart(C.FIRST_CLICK), p.mart(C.LAST_CLICK)
    # one row per conversion and model
    assert first.count() == first.select("conversion_id").distinct().count()
    assert last.count() == last.select("conversion_id").distinct().count()
    # both models credit the same conversions (same eligibility)
    assert first.select("conversion_id").exceptAll(last.select("conversion_id")).count() == 0
    # credited + orphans = conversions
    assert last.count() + quality.orphans(conv, last).count() == n_conv
    # revenue conserved between the models and through the daily mart
    tot = p.credited.groupBy("attribution_model").agg(F.sum("purchase_revenue").alias("r")).collect()
    r = {x.attribution_model: x.r for x in tot}
    assert abs(r[C.FIRST_CLICK] - r[C.LAST_CLICK]) < 1e-6
    daily = p.channel_daily.groupBy("attribution_model").agg(F.sum("conversions").alias("n")).collect()
    assert {x.attribution_model: x.n for x in daily} == {C.FIRST_CLICK: first.count(), C.LAST_CLICK: last.count()}


def test_longer_lookback_never_loses_credit(spark):
    ids = {}
    for days in (1, 7, 30):
        p = catalogue.pipeline(spark, SF, lookback_days=days)
        ids[days] = {r.conversion_id for r in p.mart(C.LAST_CLICK).select("conversion_id").collect()}
    assert ids[1] <= ids[7] <= ids[30]
