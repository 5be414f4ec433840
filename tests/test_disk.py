"""What a job holds on disk at once: shuffles and scratch tables go when they are done with; rows move narrow."""

import datetime as dt
import glob
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaar import schemas, session
from bazaar.plans import incremental as inc
from bazaar.plans import models as m
from bazaar.plans import pipeline, registry, registry_ops
from bazaar.session import FREE_SHUFFLES, materialize, shuffles_freed
from bazaar.sources import fixtures, loads, sinks

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2026, 1, 1, 6)


def plan(df, kind: str = "optimizedPlan") -> str:
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.fixture
def scratch(tmp_dir, monkeypatch):
    """Scratch tables go to a folder of the test's own; lists those of some names."""
    made = []

    def place(spark, name):
        made.append(name)
        return f"{tmp_dir}/scratch/{name}-{len(made)}"
    monkeypatch.setattr(session, "scratch_path", place)

    def left(*names):
        assert set(names) <= set(made)
        return [f for name in names for f in glob.glob(f"{tmp_dir}/scratch/{name}-*")]
    return left


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def gone(spark, before: set[str]) -> bool:
    """Whether the shuffle files made since `before` are deleted, which Spark does in the background."""
    for _ in range(100):
        if shuffle_files(spark) <= before:
            return True
        time.sleep(0.1)
    return False


def test_a_write_leaves_no_shuffle_files(spark, tmp_dir):
    df = spark.range(2000).groupBy((F.col("id") % 97).alias("k")).agg(F.sum("id").alias("s"))
    before = shuffle_files(spark)
    materialize(df, "test-disk")
    sinks.write_table(df, f"{tmp_dir}/u", ["k"], ["s"], dynamic=False)
    assert gone(spark, before)
    assert df.count() == spark.read.parquet(f"{tmp_dir}/u").count() == 97  # the frame is still good


def test_the_sessions_own_setting_comes_back(spark):
    old = spark.conf.get(FREE_SHUFFLES, None)
    try:
        spark.conf.set(FREE_SHUFFLES, "false")
        with shuffles_freed(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
        assert spark.conf.get(FREE_SHUFFLES) == "false"
    finally:
        spark.conf.unset(FREE_SHUFFLES) if old is None else spark.conf.set(FREE_SHUFFLES, old)


def test_derived_columns_are_worked_out_after_the_move(spark, tmp_dir, monkeypatch):
    seen = []
    kept = sinks.layout

    def noted(*a, **b):
        seen.append(kept(*a, **b))
        return seen[-1]
    monkeypatch.setattr(sinks, "layout", noted)
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (2, None)], "d int, x string")
    sinks.write_table(df, f"{tmp_dir}/t", ["d"], ["x"], dynamic=False,
                      finish=lambda rows: rows.withColumn("y", F.sha2("x", 256)))
    assert seen[0].columns == ["d", "x"]
    got = spark.read.schema("d int, x string, y string").parquet(f"{tmp_dir}/t").select("d", "x", "y")
    want = df.withColumn("y", F.sha2("x", 256))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_an_ingest_run_keeps_no_scratch_table_and_moves_no_row_ids(spark, tmp_dir, scratch, monkeypatch):
    seen = []

    def noted(df, path, *a, **b):
        seen.append((path, plan(sinks.layout(df, *a[:2])), b.get("finish")))
        return sinks.write_table(df, path, *a, **b)
    monkeypatch.setattr(loads, "write_table", noted)

    wh = pipeline.Warehouse(f"{tmp_dir}/wh")
    listing = fixtures.listing_pages(spark, SF).where("page_no < 50")
    history = fixtures.history_pages(spark, SF).drop("month").where("market_hash_name < 'ITEM-12'")
    pipeline.run_ingest(spark, wh, listing, history, DAY, "0001")
    assert glob.glob(f"{tmp_dir}/wh/items_raw/*") and not scratch("load-items", "judged-pages")
    for table in ("/items_raw/", "/item_price_history_raw/"):
        plans = [p for path, p, _ in seen if table in path]
        assert plans and not any("sha2(" in p or "_dlt_id" in p for p in plans)
    got = inc.read_loads(spark, wh.path("items_raw"), schemas.ITEMS_RAW).drop("load_id")
    want = pipeline.load_items(listing, DAY, "0001")
    assert got.columns == want.columns and want.count() > 0
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    points = inc.read_loads(spark, wh.path("item_price_history_raw"), schemas.ITEM_PRICE_HISTORY_RAW).collect()
    assert points and len({p._dlt_id for p in points}) == len(points) and {p._dlt_load_id for p in points} == {"0001"}


def test_pages_are_made_of_what_the_tables_hold(spark, tmp_dir):
    """Lines that come twice, two parts of one key, null values and a missing order."""
    line = dict(l_orderkey=7, l_partkey=1, l_suppkey=3, l_linenumber=1, l_quantity=2.0, l_extendedprice=1234.5,
                l_discount=0.1, l_returnflag="R", l_shipdate=dt.datetime(2001, 5, 6))
    other = dict(line, l_linenumber=2, l_partkey=2, l_extendedprice=None)
    spark.createDataFrame(
        [line, line, other, dict(line, l_suppkey=None), dict(line, l_orderkey=None), dict(line, l_partkey=None)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp",
    ).write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(1, "red ring", "B1", "LARGE", 3), (1, "old ring", "B2", "SMALL", None), (2, None, "B3", "T", 4)],
                          "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
                          ).write.parquet(f"{tmp_dir}/part.parquet")
    raw = fixtures.items_raw(spark, tmp_dir)
    pages = {r.page_no: r.body for r in fixtures.listing_pages(spark, tmp_dir).collect()}
    assert set(pages) == {8, None}
    lines = raw.select((F.col("_dlt_load_id").cast("bigint") + 1).alias("page_no"),
                       F.struct("_dlt_id", *fixtures.RECORD_VALUES).alias("line"))
    whole = lines.groupBy("page_no").agg(F.array_sort(F.collect_list("line")).alias("rows")).select(
        "page_no", F.to_json(F.struct(F.size("rows").cast("bigint").alias("total_count"), F.transform(
            "rows", lambda x: fixtures._record(lambda name: x[name])).alias("results"))).alias("body"))
    assert {r.page_no: r.body for r in whole.collect()} == pages
    body = fixtures.history_pages(spark, tmp_dir).where("market_hash_name = 'ITEM-1'").collect()
    assert {r.body for r in body} == {'var line1=[["May 06 2001 01: +0","1234.500000000","2"]];'} and len(body) == 2


def test_narrowed_rows_come_back_to_the_last_digit(spark, tmp_dir, scratch):
    big, least = Decimal("12345678901234567890123456789.123456789"), Decimal("0.000000001")
    edge = Decimal("999999999.999999999")
    rows = [(1, edge, Decimal("-1.5"), "a"), (2, edge + least, None, "b"), (3, None, None, None), (4, -big, least, "d"),
            (5, None, big, "e"), (6, Decimal("0"), -edge, "f")]
    df = spark.createDataFrame(rows, "k int, a decimal(38,9), b decimal(38,9), c string").withColumn(
        "s", F.col("k").cast("decimal(10,2)"))
    moved, whole = sinks.narrowed(df)
    assert {f.name: f.dataType.simpleString() for f in moved.schema if f.name in "abs"} == {
        "a": "decimal(18,9)", "b": "decimal(18,9)", "s": "decimal(10,2)"}
    assert {r.k for r in moved.where("__wide IS NOT NULL").collect()} == {2, 4, 5}
    back = whole(moved)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    assert sorted(back.collect()) == sorted(df.collect())
    keyed, same = sinks.narrowed(df.select("k", "a"), ["a"])
    assert keyed.columns == ["k", "a"] and same(keyed) is keyed
    sinks.write_table(df, f"{tmp_dir}/t", ["k"], ["c"], dynamic=False, staged="test-staged")
    assert not scratch("test-staged")
    got = spark.read.parquet(f"{tmp_dir}/t").select(*df.columns)
    assert got.schema == df.schema and sorted(got.collect()) == sorted(df.collect())


def _written(monkeypatch, columns: list) -> None:
    """Notes the columns of the rows that `write_table` lays out, and what it is asked to stage."""
    kept = sinks.layout

    def noted(df, *a, **b):
        columns.append((df.columns, plan(df)))
        return kept(df, *a, **b)
    monkeypatch.setattr(sinks, "layout", noted)


def test_the_fact_moves_narrow_and_is_made_once(spark, scratch, monkeypatch):
    seen, shuffles = [], shuffle_files(spark)
    _written(monkeypatch, seen)
    path = registry_ops._fct_table(spark, SF)
    (columns, made), = seen
    assert not {"bid_ask_spread_pct", "turnover_rate", "bid_ask_ratio", "_dlt_id"} & set(columns)
    assert "Window" not in made and "Join" not in made  # the layout's two looks are at written rows
    assert gone(spark, shuffles)
    assert not scratch("fct-rows")
    whole = registry.fct(spark, SF)
    got = spark.read.parquet(path).select(*whole.columns)
    assert whole.columns == m.FCT_COLUMNS and [f.dataType for f in got.schema] == [f.dataType for f in whole.schema]
    assert got.exceptAll(whole).count() == whole.exceptAll(got).count() == 0


def test_listings_without_row_ids_are_the_same_rows(spark):
    raw = fixtures.items_raw(spark, SF).limit(300)
    name = "asset_description__market_hash_name"
    alike = raw.unionByName(raw.withColumn("_dlt_id", F.concat("_dlt_id", F.lit("-2")))).unionByName(
        raw.withColumn("_dlt_id", F.lit(None).cast("string"))).unionByName(
        raw.where(f"{name} < 'ITEM-15'").withColumn("asset_description__classid", F.lit("9"))).unionByName(
        raw.limit(3).withColumn(name, F.lit(None).cast("string")))
    for rows in (alike, alike.withColumn("sell_price", F.col("sell_price").cast("string"))):
        want, got = m.stg_items(rows).drop("_dlt_id"), m.stg_items(rows, row_ids=False)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert "_dlt_id" not in plan(m.stg_items(alike, row_ids=False)).split("Window", 1)[1].split("\n", 1)[0]


def test_a_bounded_read_finds_all_its_rows_and_nothing_else_is_kept(spark):
    shuffles = shuffle_files(spark)
    df = registry.QUERIES["require_partition_filter"](spark, SF)
    assert gone(spark, shuffles)  # the write's shuffles do not wait for the read
    want = registry.present(registry.fct(spark, SF).where("market_date >= DATE '1999-01-01'"))
    assert df.exceptAll(want).count() == want.exceptAll(df).count() == 0 and want.count() > 0


def test_an_incremental_run_reads_the_sales_of_its_days(spark):
    stg, dl = registry.listings(spark, SF), registry.daily(spark, SF)
    since = registry_ops.SPLIT_DAY
    sales = [ln for ln in plan(m.fct_joined(stg, dl, since)).splitlines() if "l_returnflag" in ln and "Filter" in ln]
    assert sales and all(">= 1998-06-01" in ln for ln in sales)
    got, want = m.fct_market_daily(stg, dl, since), m.fct_market_daily(stg, dl).where("market_date >= DATE '1998-06-01'")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and want.count() > 0


def test_both_runs_of_the_fact_move_narrow_and_keep_nothing(spark, scratch, monkeypatch):
    seen, shuffles = [], shuffle_files(spark)
    _written(monkeypatch, seen)
    df = registry.QUERIES["filter_incremental_hwm"](spark, SF)
    assert len(seen) == 2 and gone(spark, shuffles)
    for columns, made in seen:
        assert not {"bid_ask_spread_pct", "turnover_rate", "bid_ask_ratio", "_dlt_id"} & set(columns)
        assert "Window" not in made and "Join" not in made
    assert not scratch("fct-rows")
    want = registry.QUERIES["fct_market_daily"](spark, SF)
    assert df.exceptAll(want).count() == want.exceptAll(df).count() == 0
