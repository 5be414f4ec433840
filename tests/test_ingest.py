import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bazaar import schemas
from bazaar.operators import ingest as ig


def pages(spark, rows):
    return spark.createDataFrame(rows, schemas.HISTORY_PAGE)


def body(points: str) -> str:
    return f"<html><script>var line1={points};var line2=[];</script></html>"


GOOD = '[["Nov 04 2024 01: +0",1.5,"4"],["Nov 05 2024 01: +0","2.25","1"]]'


def test_good_page_yields_typed_records(spark):
    ex = ig.extract_price_history(pages(spark, [("A", 200, body(GOOD))]))
    rows = sorted(ex.records.collect(), key=lambda r: r.date)
    assert [(r.date, r.price, r.volume) for r in rows] == [
        (dt.datetime(2024, 11, 4), Decimal("1.500000000"), 4), (dt.datetime(2024, 11, 5), Decimal("2.250000000"), 1)]
    assert ex.errors.count() == 0
    assert ex.records.schema == schemas.PRICE_RECORD or [f.name for f in ex.records.schema] == [
        "market_hash_name", "date", "price", "volume"]


def test_bad_pages_yield_nothing_and_one_error_each(spark):
    df = pages(spark, [
        ("bad_date", 200, body('[["Xyz 05 2024 01: +0","1.5","4"]]')),
        ("short", 200, body('[["Nov 05 2024 01: +0","1.5"]]')),
        ("null_point", 200, body('[null]')),
        ("null_price", 200, body('[["Nov 05 2024 01: +0",null,"4"]]')),
        ("bad_volume", 200, body('[["Nov 05 2024 01: +0","1.5","4.5"]]')),
        ("truncated", 200, '<script>var line1=[["Nov 05 2024 01: +0","1.5","4"];</script>'),
        ("object", 200, body('{"a": 1}')),
        ("no_match", 200, "<html>nothing here</html>"),
        ("empty", 200, body("[]")),
        ("ok", 200, body(GOOD)),
    ])
    ex = ig.extract_price_history(df)
    errs = {r.market_hash_name: r.reason for r in ex.errors.collect()}
    assert errs == {"bad_date": "bad_point", "short": "bad_point", "null_point": "bad_point",
                    "null_price": "bad_point", "bad_volume": "bad_point", "truncated": "bad_json",
                    "object": "bad_json"}
    assert {r.market_hash_name for r in ex.records.collect()} == {"ok"}


def test_status_outcomes(spark):
    df = pages(spark, [("a", 200, body(GOOD)), ("b", 429, body(GOOD)), ("c", 403, body(GOOD)),
                       ("d", 404, body(GOOD)), ("e", 500, body(GOOD)), ("", 200, body(GOOD)), (None, 200, body(GOOD))])
    ex = ig.extract_price_history(df)
    assert {r.market_hash_name for r in ex.records.collect()} == {"a"}
    got = {(r.outcome, r.severity): r.pages for r in ig.outcome_counts(ex.outcomes).collect()}
    assert got == {("ok", "info"): 1, ("rate_limited", "error"): 1, ("forbidden", "error"): 1,
                   ("not_found", "warning"): 1, ("failed", "error"): 1}


def test_mark_drops_last_seen_day_keeps_next(spark):
    df = pages(spark, [("A", 200, body(GOOD)), ("B", 200, body(GOOD))])
    state = spark.createDataFrame([("A", dt.date(2024, 11, 4)), ("B", dt.date(2024, 11, 5))], schemas.ITEM_STATE)
    ex = ig.extract_price_history(df, state)
    assert [(r.market_hash_name, r.date.day) for r in ex.records.collect()] == [("A", 5)]
    new = {r.market_hash_name: r.last_seen for r in ig.advance_state(state, ex.records).collect()}
    assert new == {"A": dt.date(2024, 11, 5), "B": dt.date(2024, 11, 5)}


def test_take_while_vs_filter_on_unsorted_series(spark):
    pts = '[["Nov 03 2024",1,"1"],["Nov 01 2024",1,"1"],["Nov 05 2024",1,"1"]]'
    df = pages(spark, [("A", 200, body(pts))])
    state = spark.createDataFrame([("A", dt.date(2024, 11, 2))], schemas.ITEM_STATE)
    tw = ig.extract_price_history(df, state, mode="take_while").records
    fl = ig.extract_price_history(df, state, mode="filter").records
    assert sorted(r.date.day for r in tw.collect()) == [5]
    assert sorted(r.date.day for r in fl.collect()) == [3, 5]


def test_bad_points_older_than_the_stop_are_not_examined(spark):
    pts = '[["garbage"],["Nov 01 2024",1,"1"],["Nov 05 2024",1,"1"]]'
    state = spark.createDataFrame([("A", dt.date(2024, 11, 2))], schemas.ITEM_STATE)
    ex = ig.extract_price_history(pages(spark, [("A", 200, body(pts))]), state)
    assert ex.errors.count() == 0 and [r.date.day for r in ex.records.collect()] == [5]


def test_error_isolation_is_per_key(spark):
    df = pages(spark, [("A", 200, body(GOOD)), ("A", 200, body('[["bad",1,"1"]]')), ("B", 200, body(GOOD))])
    ex = ig.extract_price_history(df)
    assert {r.market_hash_name for r in ex.records.collect()} == {"B"}
    ex2 = ig.extract_price_history(df, isolate="page")
    assert sorted(r.market_hash_name for r in ex2.records.collect()) == ["A", "A", "B", "B"]


def test_hour_grain_keeps_points_of_one_day(spark):
    pts = '[["Nov 05 2024 01: +0",1,"1"],["Nov 05 2024 02: +0",2,"1"]]'
    ex = ig.extract_price_history(pages(spark, [("A", 200, body(pts))]), grain="hour")
    assert sorted(r.date.hour for r in ex.records.collect()) == [1, 2]
    ex_day = ig.extract_price_history(pages(spark, [("A", 200, body(pts))]))
    assert {r.date for r in ex_day.records.collect()} == {dt.datetime(2024, 11, 5)}


def test_listing_records_prune_flatten_stamp(spark):
    rec = ('{"total_count":1,"results":[{"name":"x","hash_name":"x","app_icon":"i","app_name":"n",'
           '"sell_listings":3,"sell_price":150,"sell_price_text":"$1.50","sale_price_text":"$1.40",'
           '"asset_description":{"name":"x","market_name":"x","appid":7,"icon_url":"u","classid":"12",'
           '"tradable":1,"type":"Rifle","market_hash_name":"x","commodity":0}},'
           '{"sell_listings":1,"asset_description":null}]}')
    pages_df = spark.createDataFrame([(rec,)], "body string")
    recs = ig.parse_results_pages(pages_df)
    ts = dt.datetime(2026, 1, 1, 6)
    flat = ig.flatten_struct(ig.prune_redundant(ig.stamp_snapshot(recs, ts)))
    cols = flat.columns
    for gone in ("name", "hash_name", "app_icon", "app_name", "asset_description__name",
                 "asset_description__market_name", "asset_description__appid", "asset_description__icon_url"):
        assert gone not in cols
    rows = flat.collect()
    assert rows[0].asset_description__classid == "12" and rows[0].snapshot_timestamp == ts
    assert rows[1].asset_description__market_hash_name is None  # NULL struct -> NULL leaves
    keyed = ig.guard_missing_key(flat, "asset_description__market_hash_name")
    assert keyed.count() == 1
    meta = ig.add_load_metadata(keyed, "0001", ["asset_description__market_hash_name"]).first()
    assert meta._dlt_load_id == "0001" and len(meta._dlt_id) == 64


def test_prune_is_noop_when_fields_absent(spark):
    df = spark.createDataFrame([(1,)], "sell_listings bigint")
    assert ig.prune_redundant(df).columns == ["sell_listings"]


def test_series_regex_first_match_only(spark):
    df = spark.createDataFrame([("var line1=[1];var line1=[2];",), ("none",)], "b string")
    assert [r[0] for r in df.select(ig.extract_series_text("b")).collect()] == ["[1]", None]
    assert df.select(F.lit(1)).count() == 2


def test_hour_grain_mark_keeps_the_instant(spark):
    from bazaar.plans.incremental import state_from_data
    pts = '[["Nov 05 2024 01: +0",1,"1"],["Nov 05 2024 02: +0",2,"1"]]'
    first = ig.extract_price_history(pages(spark, [("A", 200, body(pts))]), grain="hour").records
    state = ig.advance_state(None, first, as_type=schemas.state_schema("hour")["last_seen"].dataType)
    assert state.first().last_seen == dt.datetime(2024, 11, 5, 2)
    assert state_from_data(first, grain="hour").first().last_seen == dt.datetime(2024, 11, 5, 2)
    pts2 = pts[:-1] + ',["Nov 05 2024 03: +0",3,"1"]]'
    again = ig.extract_price_history(pages(spark, [("A", 200, body(pts2))]), state, grain="hour").records
    assert [r.date.hour for r in again.collect()] == [3]
