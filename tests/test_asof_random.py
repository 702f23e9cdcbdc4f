"""As-of credit equals the literal pairwise definition on random data with
many ties, NULL sessions, NULL users, copies and exact boundaries."""

import random

import pytest

from conftest import CONV_SCHEMA, DAY, TOUCH_SCHEMA, conv_row
from touchcredit import config as C
from touchcredit.operators.credit import credit


def brute_force(touches, convs, L):
    """Pairs + pick: the literal definition, in plain Python."""
    best_rev = {}
    for cid, user, date, us, rev in convs:
        if cid is None:
            continue
        key = (-1e300 if rev is None else rev, date)
        if cid not in best_rev or key > best_rev[cid][0]:
            best_rev[cid] = (key, (cid, user, date, us, rev))
    out = {}
    for cid, (_, (_, user, _, c, rev)) in best_rev.items():
        el = [t for t in touches if t[0] is not None and t[0] == user and c - L <= t[2] <= c]
        if not el:
            continue

        def k(t):
            return (t[2], -1 if t[1] is None else 0, t[1] if t[1] is not None else 0, t[3])
        out[(cid, C.FIRST_CLICK)] = (min(el, key=k)[3], rev)
        out[(cid, C.LAST_CLICK)] = (max(el, key=k)[3], rev)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    users = ["a", "b", "c", None]
    base = 1_700_000_000_000_000
    grid = [base + i * DAY // 4 for i in range(60)]  # coarse grid -> many ties
    touches = []
    for _ in range(300):
        u = rnd.choice(users)
        t = rnd.choice(grid) + rnd.choice([0, 0, 1, -1])
        sid = rnd.choice([None, 1, 2, 3, 4])
        touches.append((u, sid, t, rnd.choice(["A", "B", "C"])))
    touches += touches[:20]  # copies
    convs = []
    for _ in range(130):
        u = rnd.choice(users)
        c = rnd.choice(grid) + rnd.choice([0, 0, 1])
        convs.append(conv_row(u, c, revenue=rnd.choice([None, 1.0, 2.5])))
    # exact boundaries
    convs.append(conv_row("a", touches[0][2] + 7 * DAY) if touches[0][0] == "a" else conv_row("a", base))
    L = 7 * DAY
    expect = brute_force(touches, convs, L)
    t = spark.createDataFrame(touches, TOUCH_SCHEMA)
    c = spark.createDataFrame(convs, CONV_SCHEMA)
    for chunk in (DAY // 24, DAY, 30 * DAY):
        got = {(r.conversion_id, r.attribution_model): (r.attributed_channel, r.purchase_revenue)
               for r in credit(t, c, L, chunk_us=chunk).collect()}
        assert got == expect, f"chunk={chunk}"
    assert len(expect) > 20


@pytest.mark.parametrize("seed", [4, 5])
def test_split_hot_chunks_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = 1_700_000_000_000_000
    hour = 3_600_000_000
    # one burst user with many rows inside a few hours, plus normal users
    touches = [("hot", rnd.choice([None, 1, 2]), base + rnd.randrange(0, 3 * hour, 1_000_000), rnd.choice("AB"))
               for _ in range(400)]
    touches += [(rnd.choice("xy"), 1, base + rnd.randrange(-DAY, DAY), rnd.choice("CD")) for _ in range(50)]
    convs = [conv_row("hot", base + rnd.randrange(0, 3 * hour, 1_000_000)) for _ in range(60)]
    convs += [conv_row(rnd.choice("xy"), base + rnd.randrange(-DAY, DAY)) for _ in range(20)]
    L = 2 * hour
    expect = brute_force(touches, convs, L)
    t = spark.createDataFrame(touches, TOUCH_SCHEMA)
    c = spark.createDataFrame(convs, CONV_SCHEMA)
    got = {(r.conversion_id, r.attribution_model): (r.attributed_channel, r.purchase_revenue)
           for r in credit(t, c, L, chunk_us=hour).collect()}
    assert got == expect
    finer = {(r.conversion_id, r.attribution_model): (r.attributed_channel, r.purchase_revenue)
             for r in credit(t, c, L, chunk_us=hour, fine_us=1_000_000).collect()}
    assert finer == expect


def test_one_hour_with_most_rows_is_windowed_by_minutes(spark):
    """The largest window group of the default path holds a minute's rows, not the hour's."""
    from touchcredit.operators.asof import fine_width

    hour, base = 3_600_000_000, 1_700_000_400_000_000 // 3_600_000_000 * 3_600_000_000
    touches = [("hot", 1, base + i * 900_000, "AB"[i % 2]) for i in range(4000)]
    touches += [("x", 1, base + i * 3_000_000, "C") for i in range(200)]
    convs = [conv_row("hot", base + i * 60_000_000 + 7) for i in range(60)]
    t, c = spark.createDataFrame(touches, TOUCH_SCHEMA), spark.createDataFrame(convs, CONV_SCHEMA)
    got = {(r.conversion_id, r.attribution_model): (r.attributed_channel, r.purchase_revenue)
           for r in credit(t, c, hour, chunk_us=hour).collect()}
    assert got == brute_force(touches, convs, hour)
    fine = fine_width(hour)
    sizes = t.groupBy("user_pseudo_id", (t.touchpoint_us - t.touchpoint_us % fine).alias("f")).count()
    assert sizes.agg({"count": "max"}).first()[0] <= 4000 // 60 + 1
