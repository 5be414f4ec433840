import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bazaar import schemas
from bazaar.plans import models as m


def items(spark, rows):
    """rows: (name, day, load, asks, cents, bid_text, commodity, row_id)"""
    data = []
    for name, day, load, asks, cents, bid, commodity, rid in rows:
        ts = dt.datetime.combine(day, dt.time(12)) if day else None
        data.append((asks, cents, None, bid, ts, "7", None, 1, "red", "Rifle", name, commodity, "Group", "G1",
                     load, rid))
    return spark.createDataFrame(data, schemas.ITEMS_RAW)


def history(spark, rows):
    """rows: (name, day, price, volume, load, row_id)"""
    data = [(n, dt.datetime.combine(d, dt.time()), Decimal(str(p)), v, load, rid) for n, d, p, v, load, rid in rows]
    return spark.createDataFrame(data, schemas.ITEM_PRICE_HISTORY_RAW)


D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_dedup_newest_load_then_most_asks(spark):
    raw = items(spark, [
        ("A", D1, "0002", 5, 100, "$0.90", 1, "r1"),
        ("A", D1, "0001", 9, 100, "$0.90", 1, "r2"),   # older load loses despite more asks
        ("B", D1, "0001", 3, 100, "$0.90", 1, "r3"),
        ("B", D1, "0001", 7, 100, "$0.90", 1, "r4"),   # same load: more asks wins
    ])
    got = {r.item_name: r._dlt_id for r in m.stg_items(raw).collect()}
    assert got == {"A": "r1", "B": "r4"}


def test_history_dedup_newest_load(spark):
    h = history(spark, [("A", D1, 1.0, 1, "0001", "x"), ("A", D1, 2.0, 2, "0002", "y")])
    rows = m.stg_item_price_history(h).collect()
    assert len(rows) == 1 and rows[0].units_sold == 2


def test_fact_edges_zero_ask_zero_bid_no_history(spark):
    raw = items(spark, [
        ("A", D1, "0001", 0, 200, "$1.00", 1, "a"),     # zero asks -> turnover NULL
        ("B", D1, "0001", 4, 200, "$0.00", 0, "b"),     # zero bid -> spread NULL
        ("C", D1, "0001", 4, 200, "", None, "c"),       # empty bid text -> NULL bid, NULL commodity
        ("D", D2, "0001", 4, 200, "$1.50", 1, "d"),     # no history that day
    ])
    h = history(spark, [("A", D1, 2.0, 3, "0001", "h1"), ("B", D1, 1.0, 2, "0001", "h3"),
                        ("D", D1, 1.0, 2, "0001", "h4")])
    fct = m.fct_market_daily(m.stg_items(raw), m.int_item_price_history_daily(m.stg_item_price_history(h)))
    r = {x.item_name: x for x in fct.collect()}
    assert r["A"].turnover_rate is None and r["A"].units_sold == 3
    assert r["A"].total_estimated_trade_volume_usd == Decimal("6.000000000")
    assert r["B"].bid_ask_spread_pct is None and r["B"].bid_ask_ratio == Decimal("0E-9")
    assert r["C"].bid_price_usd is None and r["C"].bid_ask_spread_pct is None
    assert r["D"].units_sold == 0 and r["D"].total_estimated_trade_volume_usd == Decimal("0E-9")
    assert r["D"].avg_median_sale_price_usd is None
    assert r["B"].bid_ask_spread_pct is None
    # averages skip NULL spreads
    rpt = m.rpt_market_metrics_daily(fct, floor=None).where(F.col("market_date") == D1).first()
    assert rpt.avg_bid_ask_spread_pct == Decimal("1.000000000")  # only A: (2.00 - 1.00) / 1.00
    assert rpt.total_active_supply == 8 and rpt.total_units_sold == 5


def test_daily_history_avg_is_unweighted(spark):
    h = history(spark, [("A", D1, 1.0, 10, "1", "x"), ("A", dt.date(2024, 1, 1), 3.0, 1, "1", "y")])
    # two points on one day only survive dedup when their timestamps differ
    h = h.withColumn("date", F.when(F.col("_dlt_id") == "y", F.col("date") + F.expr("INTERVAL 1 HOUR"))
                     .otherwise(F.col("date")))
    r = m.int_item_price_history_daily(m.stg_item_price_history(h)).first()
    assert r.units_sold == 11 and r.avg_median_sale_price_usd == Decimal("2.000000000")
    assert r.total_estimated_trade_volume_usd == Decimal("13.000000000")


def test_null_item_never_joins_and_is_absent_from_latest(spark):
    raw = items(spark, [(None, D1, "1", 1, 100, "$1.00", 1, "n"), ("A", D1, "1", 1, 100, "$1.00", 1, "a")])
    h = history(spark, [("A", D1, 1.0, 1, "1", "x")])
    fct = m.fct_market_daily(m.stg_items(raw), m.int_item_price_history_daily(m.stg_item_price_history(h)))
    rows = {x.item_name: x for x in fct.collect()}
    assert rows[None].units_sold == 0
    latest = m.rpt_item_metrics_latest(fct, floor=None).collect()
    assert [x.item_name for x in latest] == ["A"]


def test_null_commodity_is_its_own_group(spark):
    raw = items(spark, [("A", D1, "1", 1, 100, "$1.00", None, "a"), ("B", D1, "1", 1, 100, "$1.00", 0, "b"),
                        ("C", D1, "1", 1, 100, "$1.00", 1, "c")])
    fct = m.fct_market_daily(m.stg_items(raw), m.int_item_price_history_daily(
        m.stg_item_price_history(history(spark, []))))
    groups = {r.is_commodity for r in m.rpt_commodity_velocity_daily(fct, floor=None).collect()}
    assert groups == {None, False, True}


def test_latest_keeps_ties_and_matches_selfjoin(spark):
    raw = items(spark, [("A", D1, "1", 1, 100, "$1.00", 1, "a"), ("A", D2, "1", 2, 100, "$1.00", 1, "b"),
                        ("B", D1, "1", 1, 100, "$1.00", 1, "c")])
    fct = m.fct_market_daily(m.stg_items(raw), m.int_item_price_history_daily(
        m.stg_item_price_history(history(spark, []))))
    tied = fct.unionByName(fct.where(F.col("item_name") == "B"))  # B twice on its latest day
    a = sorted(map(tuple, m.rpt_item_metrics_latest(tied, floor=None).collect()), key=str)
    b = sorted(map(tuple, m.rpt_item_metrics_latest_selfjoin(tied, floor=None).collect()), key=str)
    assert a == b and len(a) == 3


def test_report_floor_and_contracts(spark):
    raw = items(spark, [("A", dt.date(1999, 12, 31), "1", 1, 100, "$1.00", 1, "a"),
                        ("A", dt.date(2000, 1, 1), "1", 1, 100, "$1.00", 1, "b")])
    fct = m.fct_market_daily(m.stg_items(raw), m.int_item_price_history_daily(
        m.stg_item_price_history(history(spark, []))))
    rpt = m.rpt_market_metrics_daily(fct)
    assert [r.market_date for r in rpt.collect()] == [dt.date(2000, 1, 1)]
    from bazaar.operators.quality import check_contract
    check_contract(rpt, schemas.RPT_MARKET_METRICS_DAILY)
    check_contract(m.rpt_commodity_velocity_daily(fct), schemas.RPT_COMMODITY_VELOCITY_DAILY)
    check_contract(m.rpt_item_metrics_latest(fct), schemas.RPT_ITEM_METRICS_LATEST)


def test_dim_item_and_upsert(spark):
    raw = items(spark, [("A", D1, "1", 1, 100, "$1.00", 1, "a"), ("A", D2, "1", 1, 100, "$1.00", 0, "b")])
    stg = m.stg_items(raw)
    full = m.dim_item(stg).collect()
    assert len(full) == 1 and full[0].snapshot_date == D2 and full[0].is_commodity is False
    old = m.dim_item(stg.where(F.col("snapshot_date") == D1))
    up = m.dim_item_upsert(old, stg, D1).collect()
    assert [tuple(r) for r in up] == [tuple(r) for r in full]
