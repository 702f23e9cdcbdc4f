"""Every catalogue query equals its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as ent
from touchcredit.plans import catalogue, oracle

SF = "/root/testdata/sf0.001"
TABLES = ["events"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


NAMES = sorted(n for n in oracle.oracle_sql() if not n.startswith("stream_attribution"))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = ent.queries()[name](spark, SF).toPandas()
    want = con.execute(ent.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_query_has_an_oracle():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())


def test_report_sections(spark):
    rows = ent.queries()["report_bundle"](spark, SF).collect()
    of = {name: [r for r in rows if r.section == name] for name in {r.section for r in rows}}
    assert set(of) == {"meta", "totals", "channel_breakdown", "channel_daily", "trend", "live_events"}
    tot = {r.attribution_model: r for r in of["totals"]}
    assert set(tot) == {"first_click", "last_click"} == {r.attribution_model for r in of["channel_breakdown"]}
    assert len(of["live_events"]) == 20 and len(of["trend"]) == 14 and len(of["meta"]) == 1
    assert tot["first_click"].revenue == tot["last_click"].revenue
    for section in ("channel_breakdown", "channel_daily"):
        for model, total in tot.items():
            assert sum(r.conversions for r in of[section] if r.attribution_model == model) == total.conversions


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert set(df.columns) == {"attribution_model", "conversion_date", "attributed_channel", "conversions", "revenue"}
    assert df.count() > 0
