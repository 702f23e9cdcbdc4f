"""Property: as-of credit equals the literal pairwise definition for any
small history (hypothesis shrinks a failing case to a minimal one)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import CONV_SCHEMA, TOUCH_SCHEMA, conv_row
from test_asof_random import brute_force
from touchcredit.operators.credit import credit

USERS = st.sampled_from(["a", "b", None])
TIMES = st.integers(min_value=0, max_value=40)
touch_st = st.tuples(USERS, st.one_of(st.none(), st.integers(0, 3)), TIMES, st.sampled_from(["A", "B", "C"]))
conv_st = st.tuples(USERS, TIMES, st.one_of(st.none(), st.sampled_from([1.0, 2.0])))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(touches=st.lists(touch_st, max_size=25), convs=st.lists(conv_st, min_size=1, max_size=10),
       lookback=st.integers(0, 15), chunk=st.integers(1, 20))
def test_credit_matches_definition(spark, touches, convs, lookback, chunk):
    conv_rows = [conv_row(u, t, revenue=r) for u, t, r in convs]
    expect = brute_force(touches, conv_rows, lookback)
    t = spark.createDataFrame(touches, TOUCH_SCHEMA)
    c = spark.createDataFrame(conv_rows, CONV_SCHEMA)
    got = {(r.conversion_id, r.attribution_model): (r.attributed_channel, r.purchase_revenue)
           for r in credit(t, c, lookback, chunk_us=chunk).collect()}
    assert got == expect
