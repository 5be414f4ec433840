import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bazaar.functions import scalar as fx


def test_currency_text_edges(spark):
    df = spark.createDataFrame([("",), ("1.2.3",), ("$1,234.56",), (None,), ("-$3.50",), ("1.234,56€",)], "t string")
    got = [r[0] for r in df.select(fx.currency_text_to_usd("t")).collect()]
    assert got == [None, None, Decimal("1234.560000000"), None, Decimal("3.500000000"), Decimal("1.234560000")]


def test_safe_cast_class_id(spark):
    df = spark.createDataFrame([("abc",), ("12.5",), ("42",), (None,)], "c string")
    assert [r[0] for r in df.select(fx.safe_cast("c", "bigint")).collect()] == [None, None, 42, None]


def test_cents_to_usd_and_bool(spark):
    df = spark.createDataFrame([(12345, 1), (0, 0), (None, None)], "cents bigint, flag bigint")
    rows = df.select(fx.cents_to_usd("cents").alias("usd"), fx.int_to_bool("flag").alias("b")).collect()
    assert [r.usd for r in rows] == [Decimal("123.450000000"), Decimal("0E-9"), None]
    assert [r.b for r in rows] == [True, False, None]


def test_safe_divide_and_kpis(spark):
    df = spark.createDataFrame([(Decimal("10"), Decimal("8"), 4, 2), (Decimal("10"), Decimal("0"), 0, 0),
                                (Decimal("10"), None, 5, None)],
                               "ask decimal(38,9), bid decimal(38,9), asks bigint, units bigint")
    rows = df.select(fx.bid_ask_spread("ask", "bid").alias("spread"), fx.turnover_rate("units", "asks").alias("t"),
                     fx.bid_ask_ratio("bid", "ask").alias("r")).collect()
    assert rows[0].spread == Decimal("0.250000000") and rows[0].t == 0.5 and rows[0].r == Decimal("0.800000000")
    assert rows[1].spread is None and rows[1].t is None and rows[1].r == Decimal("0E-9")
    assert rows[2].spread is None and rows[2].t == 0.0 and rows[2].r is None


def test_case_label_null_goes_to_else(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    got = [r[0] for r in df.select(fx.case_label("c", "Commodities", "Non-Commodities")).collect()]
    assert got == ["Commodities", "Non-Commodities", "Non-Commodities"]


def test_display_formats(spark):
    df = spark.createDataFrame([(1.5, 3), (None, None)], "x double, n bigint")
    rows = df.select(fx.display_money("x").alias("m"), fx.display_fixed("x", 2).alias("f"),
                     fx.display_count("n").alias("c"), fx.kpi_number("x", 1).alias("k")).collect()
    assert (rows[0].m, rows[0].f, rows[0].c, rows[0].k) == ("$1.50", "1.50", "3", "1.5")
    assert (rows[1].m, rows[1].f, rows[1].c, rows[1].k) == ("N/A", "N/A", "N/A", "0.0")


def test_date_sub_days_with_as_of(spark):
    df = spark.range(1).select(fx.date_sub_days(dt.date(2024, 3, 1), 1).alias("d"))
    assert df.first().d == dt.date(2024, 2, 29)


def test_ts_to_date_is_utc(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 30),)], "t timestamp")
    assert df.select(fx.ts_to_date("t")).first()[0] == dt.date(2024, 1, 1)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_money_product_keeps_scale(spark):
    df = spark.createDataFrame([(3, Decimal("0.123456789"))], "u bigint, p decimal(38,9)")
    assert df.select(F.sum(fx.money_product("u", "p"))).first()[0] == Decimal("0.370370367")


def test_sizing_scales_partitions_with_input():
    from bazaar.session import sizing
    small, big = sizing(10 * 1024 ** 2, cores=8), sizing(100 * 1024 ** 4, cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) > 400_000
    assert small["spark.sql.files.maxPartitionBytes"] == big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)


def test_money_over_the_whole_range(spark):
    """No NULL and no abort at a billion, a trillion, and beyond 15 digits."""
    df = spark.createDataFrame([(10 ** 9, "$1,000,000,000.00"), (10 ** 12 + 1, "$1000000000000.01"),
                                (2 ** 63 - 1, "$12345678901234567890123456789.5"), (0, "$0"), (None, None)],
                               "cents bigint, text string")
    m = df.select(fx.cents_to_usd("cents").alias("ask"), fx.currency_text_to_usd("text").alias("bid"))
    got = m.select("ask", "bid", fx.bid_ask_spread("ask", "bid").alias("s"), fx.bid_ask_ratio("bid", "ask").alias("r"),
                   fx.money_product(F.lit(3), "ask").alias("p")).collect()
    assert [r.ask for r in got[:3]] == [Decimal("10000000.000000000"), Decimal("10000000000.010000000"),
                                        Decimal("92233720368547758.070000000")]
    assert got[1].bid == Decimal("1000000000000.010000000") and got[2].bid == Decimal("12345678901234567890123456789.5")
    assert got[0].s == Decimal("-0.990000000") and got[0].r == Decimal("100.000000000")
    assert got[1].p == Decimal("30000000000.030000000")
    assert abs(got[2].r - Decimal("133852214938.0")) < 10 ** 9 and abs(got[2].s + 1) < Decimal("0.001")
    assert got[3].s is None and got[3].r is None and got[4].s is None


def test_page_prices_over_the_whole_range(spark):
    from bazaar.operators import ingest as ig
    df = spark.createDataFrame([("1000000000",), ("1000000000000.25",), ("x",)], "t string")
    assert [r[0] for r in df.select(ig.parse_point_price("t")).collect()] == [
        Decimal("1000000000"), Decimal("1000000000000.25"), None]


def test_report_decimals_equal_the_oracle_exactly(spark):
    """The registered queries round to 6 places; here the models' decimals are compared as decimals.

    The other engine averages in doubles, so an average that ends in half a unit may differ in the last place.
    """
    import duckdb
    from bazaar.plans import registry as R
    from bazaar.plans.oracle import with_models
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, build in (("rpt_market_metrics_daily", R.rpt_market), ("rpt_commodity_velocity_daily", R.rpt_commodity),
                        ("rpt_item_metrics_latest", R.rpt_latest)):
        df = build(spark, sf)
        money = [f.name for f in df.schema.fields if f.dataType.simpleString() == "decimal(38,9)"]
        keys = [c for c in ("item_name", "is_commodity", "market_date") if c in df.columns]
        assert len(money) >= 2
        cols = ", ".join(keys + money)
        want = con.execute(with_models(f"SELECT {cols} FROM {name}", name)).fetchall()
        got = [tuple(r) for r in df.select(*keys, *money).collect()]
        got, want = sorted(got, key=repr), sorted(want, key=repr)
        assert len(got) == len(want)
        for a, b in zip(got, want):
            for c, x, y in zip(keys + money, a, b):
                assert x == y or (c.startswith("avg_") and abs(x - y) <= Decimal("0.000000001")), (c, a, b)
