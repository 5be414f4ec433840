"""Stored day aggregates and late sales: everything ends as a full rebuild."""

import datetime as dt
import os
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from bazaar.plans import models as m
from bazaar.plans import partials as pt
from bazaar.plans.pipeline import Warehouse, read_models
from bazaar.plans.registry_kept import ORACLE, QUERIES
from bazaar.sources import folders as fs
from tests.test_loads import day, models_now, page, refreshed, rows
from tests.test_pipeline import record
from tools.oracle_check import TABLES, rows_key, type_diffs

SF = "/root/testdata/sf0.001"
FCT = ("item_name string, is_commodity boolean, ask_count bigint, units_sold bigint, market_date date, "
       "total_estimated_trade_volume_usd decimal(38,9), bid_ask_spread_pct decimal(38,9)")


def fact(spark, *points):
    return spark.createDataFrame([(i, c, a, u, dt.date(2026, 1, d), v and Decimal(v), s and Decimal(s))
                                  for i, c, a, u, d, v, s in points], FCT)


POINTS = [("A", True, 3, 1, 1, "2.5", "0.1"), ("B", True, None, 2, 1, "1.000000001", None), ("C", None, 0, 0, 1, "0", None),
          (None, False, 7, 4, 1, None, "0.3"), ("A", True, 3, 1, 2, "1", "0.100000003"), ("B", True, 1, 0, 2, "1", "0.2"),
          ("D", True, 1, 0, 2, "1", "0.2"), ("E", False, None, 0, 3, "12345678901234567890.5", "12345678901234567890.1")]


def test_reports_of_partials_are_those_of_the_rows(spark):
    f = fact(spark, *POINTS)
    p = pt.day_partials(f)
    for a, b in ((pt.rpt_market_metrics_daily(p), m.rpt_market_metrics_daily(f)),
                 (pt.rpt_commodity_velocity_daily(p), m.rpt_commodity_velocity_daily(f))):
        assert a.dtypes == b.dtypes
        assert rows(a) == rows(b)


def test_partials_merge_and_are_corrected_by_difference(spark):
    f = fact(spark, *POINTS)
    whole = rows(pt.day_partials(f))
    half = f.where("item_name = 'A'"), f.where("item_name <=> 'A' = false")
    assert rows(pt.merge(*map(pt.day_partials, half))) == whole
    # a row changes its group, one goes, one comes; the only row of a group and of a day leave nothing behind
    new = [("A", True, 3, 1, 1, "2.5", "0.1"), ("B", None, 9, 2, 1, "1.000000001", None), (None, False, 7, 5, 1, "3", "0.3"),
           *POINTS[4:7], ("F", True, 2, 2, 4, "5", None)]
    before = fact(spark, POINTS[1], POINTS[2], POINTS[3], POINTS[7])
    after = fact(spark, new[1], new[2], new[-1])
    assert rows(pt.corrected(pt.day_partials(f), before, after)) == rows(pt.day_partials(fact(spark, *new)))
    assert rows(pt.corrected(pt.day_partials(f), f, f.limit(0))) == []
    assert rows(pt.day_partials(f.limit(0))) == [] == rows(pt.rpt_market_metrics_daily(pt.day_partials(f.limit(0))))


def test_late_sales_change_their_days_only(spark, tmp_dir, monkeypatch):
    wh = Warehouse(tmp_dir)
    for k in (1, 2, 3):
        day(spark, wh, k, record("A"), record("B", text="$0.10"), pages=[page((f"Jan 0{k}", 2, k * 10))])
    files = {d: sorted(os.listdir(wh.path(f"fct_market_daily/market_date=2026-01-0{d}"))) for d in (1, 2, 3)}
    # B's sales of day 1 come on day 4, with some of an item that is not listed and of a day without listings
    late = [page(("Jan 01", 3, 7), ("Jan 04", 3, 1), name="B"), page(("Jan 02", 1, 1), name="Z")]

    def crash(*a, **k):
        raise RuntimeError("lost")
    moves, real = [], fs.move

    def stop_after_one(spark, old, new):
        if "/_change/" in old:
            moves.append(old)
            if len(moves) == 2:
                crash()
        real(spark, old, new)
    with monkeypatch.context() as p:  # the change is whole, its folders are moved in part
        p.setattr(fs, "move", stop_after_one)
        with pytest.raises(RuntimeError):
            day(spark, wh, 4, record("A"), record("B"), pages=late, late_sales=True)
    assert len(moves) == 2 and fs.exists(spark, wh.path("_change"))
    day(spark, wh, 5, record("A"), record("B"), pages=[], late_sales=True)
    assert not fs.exists(spark, wh.path("_change"))
    assert models_now(spark, wh) == refreshed(spark, wh)
    now = {d: sorted(os.listdir(wh.path(f"fct_market_daily/market_date=2026-01-0{d}"))) for d in (1, 2)}
    assert now[2] == files[2] and now[1] != files[1]
    assert rows(spark.read.parquet(wh.path("day_partials")).select(*sorted(pt.NUMBERS), "is_commodity", "market_date")) == rows(
        pt.day_partials(read_models(spark, wh)["fct_market_daily"]).select(*sorted(pt.NUMBERS), "is_commodity", "market_date"))


def test_late_sales_stay_out_unless_asked_for(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    day(spark, wh, 1, record("A"), pages=[])
    day(spark, wh, 2, record("A"), pages=[])
    before = rows(spark.read.parquet(wh.path("rpt_market_metrics_daily")).where("market_date = '2026-01-01'"))
    day(spark, wh, 3, record("A"), pages=[page(("Jan 01", 3, 7))])
    assert rows(spark.read.parquet(wh.path("rpt_market_metrics_daily")).where("market_date = '2026-01-01'")) == before


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_kept_queries_match_a_full_rebuild(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLE[name])
    assert type_diffs(df.schema, cur.description) == []
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key([d[0] for d in cur.description], cur.fetchall())


def test_the_late_correction_really_changes_days(spark):
    raw_rows = QUERIES["late_sales_market"](spark, SF)
    assert raw_rows.where(F.dayofweek("market_date").isin(1, 7) & (F.col("total_units_sold") > 0)).count() > 0
