"""Loads that stop, come late or come again: the models end as a full refresh of what is loaded."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from bazaar import schemas
from bazaar.operators import quality as qa
from bazaar.plans import incremental as inc
from bazaar.plans import models as m
from bazaar.plans import pipeline as pl
from bazaar.plans.pipeline import Warehouse, read_models, run_daily, run_ingest, run_models
from bazaar.sources import folders as fs
from bazaar.sources import loads
from tests.test_pipeline import history, listing, record

DAYS = [dt.datetime(2026, 1, d, 6) for d in range(1, 6)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def page(*points, name="A", status=200):
    """points: (month name and day, price, units)"""
    body = ",".join(f'["{day} 2026 01: +0","{price}","{units}"]' for day, price, units in points)
    return name, status, f"var line1=[{body}];"


def models_now(spark, wh):
    return {k: rows(v.select(*sorted(v.columns))) for k, v in read_models(spark, wh).items()}


def refreshed(spark, wh):
    """The models, worked out anew from the raw tables."""
    ledger = wh.ledger(spark)
    items = loads.read_finished(spark, wh.path("items_raw"), schemas.ITEMS_RAW, ledger).drop("load_id")
    hist = loads.read_finished(spark, wh.path("item_price_history_raw"), schemas.ITEM_PRICE_HISTORY_RAW, ledger).drop("load_id")
    stg = m.stg_items(items).where("snapshot_date is not null")
    daily = m.int_item_price_history_daily(m.stg_item_price_history(hist))
    fct = m.fct_market_daily(stg, daily)
    made = {"int_item_price_history_daily": daily, "dim_item": m.dim_item(stg), "fct_market_daily": fct,
            "rpt_market_metrics_daily": m.rpt_market_metrics_daily(fct),
            "rpt_commodity_velocity_daily": m.rpt_commodity_velocity_daily(fct),
            "rpt_item_metrics_latest": m.rpt_item_metrics_latest(fct)}
    return {k: rows(v.select(*sorted(v.columns))) for k, v in made.items()}


def day(spark, wh, k, *records, pages=(), load_id=None, **more):
    return run_daily(spark, wh, listing(spark, *records), history(spark, *pages), DAYS[k - 1], load_id or f"000{k}",
                     as_of=DAYS[k - 1].date(), **more)


def test_stopped_and_crashed_loads_are_modelled_by_the_next_run(spark, tmp_dir, monkeypatch):
    wh = Warehouse(tmp_dir)
    day(spark, wh, 1, record("A"), pages=[page(("Jan 01", 2, 10))])
    with pytest.raises(qa.BuildFailed, match="load failed"):  # a gate
        day(spark, wh, 2, record("A"), record("N"), pages=[page(("Jan 01", 2, 10), ("Jan 02", 2, 20)), ("B", 429, "")],
            max_failed_pages=0)
    assert wh.ledger(spark).pending() == ["0002"]

    def crash(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as p:  # between ingest and models
        p.setattr(pl, "run_models", crash)
        with pytest.raises(RuntimeError):
            day(spark, wh, 3, record("A"), pages=[page(("Jan 02", 2, 20), ("Jan 03", 2, 30))])
    with monkeypatch.context() as p:  # among the models
        p.setattr(m, "rpt_market_metrics_daily", crash)
        with pytest.raises(RuntimeError):
            day(spark, wh, 4, record("A"), pages=[page(("Jan 03", 2, 30), ("Jan 04", 2, 40))])
    assert wh.ledger(spark).pending() == ["0002", "0003", "0004"]
    with pytest.raises(qa.BuildFailed, match="data test"):  # a data test; the models are written
        day(spark, wh, 5, record("A", text=""), pages=[page(("Jan 04", 2, 40), ("Jan 05", 2, 50))])
    assert wh.ledger(spark).pending() == [] and run_models(spark, wh) == {}
    got = models_now(spark, wh)
    assert got == refreshed(spark, wh)
    units = {r.market_date.day: r.units_sold for r in spark.read.parquet(wh.path("fct_market_daily")).where("item_name = 'A'").collect()}
    assert units == {1: 10, 2: 20, 3: 30, 4: 40, 5: 50}
    assert {r.item_name for r in read_models(spark, wh)["dim_item"].collect()} == {"A", "N"}
    run_models(spark, wh, full=True)
    assert models_now(spark, wh) == got


def test_failed_pages_alone_do_not_stop_the_day(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    out = day(spark, wh, 1, record("A"), pages=[page(("Jan 01", 2, 10)), ("B", 429, ""), ("C", 500, "")])
    assert out["tests"].count() == 19 and wh.ledger(spark).pending() == []
    entry = {r.stage: r.failed_pages for r in wh.ledger(spark).table().collect()}
    assert entry == {"extracted": 2, "modelled": None}


def test_a_replay_replaces_its_load(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    bad = ("C", 200, "var line1=[{;];")
    day(spark, wh, 1, record("A"), pages=[page(("Jan 01", 2, 10))])
    day(spark, wh, 2, record("A"), record("Gone"), pages=[page(("Jan 01", 2, 10), ("Jan 02", 2, 20), ("Feb 02", 3, 5)),
                                                          page(("Jan 02", 1, 1), name="Gone"), bad])
    errors = inc.read_loads(spark, wh.path("_errors"), schemas.PAGE_ERROR)
    assert errors.count() == 1
    # fewer months, another run day, no errors, an item less
    day(spark, wh, 3, record("A", price=170), pages=[page(("Jan 01", 2, 10), ("Jan 02", 2, 21))], load_id="0002")
    assert rows(inc.read_loads(spark, wh.path("item_price_history_raw"), schemas.ITEM_PRICE_HISTORY_RAW).select(
        "load_id", F.month("date"), "volume")) == [("0001", 1, 10), ("0002", 1, 21)]
    assert os.listdir(wh.path("items_raw/load_id=0002")) and not any(
        "2026-01-02" in x for x in os.listdir(wh.path("items_raw/load_id=0002")))
    assert inc.read_loads(spark, wh.path("_errors"), schemas.PAGE_ERROR).count() == 0
    assert models_now(spark, wh) == refreshed(spark, wh)
    assert {r.market_date.day for r in spark.read.parquet(wh.path("fct_market_daily")).collect()} == {1, 3}
    # no row at all
    none = spark.createDataFrame([], "page_no bigint, body string")
    run_ingest(spark, wh, none, spark.createDataFrame([], schemas.HISTORY_PAGE), DAYS[2], "0002")
    run_models(spark, wh)
    assert inc.read_loads(spark, wh.path("items_raw"), schemas.ITEMS_RAW).select("load_id").distinct().count() == 1
    assert models_now(spark, wh) == refreshed(spark, wh)
    assert not fs.children(spark, wh.path("items_raw/_retired"))


def test_late_and_same_day_loads_merge_as_a_full_refresh(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    day(spark, wh, 3, record("A", classid="99"), record("B"), pages=[page(("Jan 03", 2, 3))])
    day(spark, wh, 1, record("A"), record("C"), pages=[page(("Jan 01", 2, 1), name="C")], load_id="0004")  # late
    day(spark, wh, 3, record("A", classid="12"), pages=[page(("Jan 03", 2, 8), ("Jan 03", 2, 9), name="B")], load_id="0005")
    got = models_now(spark, wh)
    assert got == refreshed(spark, wh)
    assert {r.item_name: r.class_id for r in read_models(spark, wh)["dim_item"].collect()} == {"A": 12, "B": 12, "C": 12}


def test_the_dev_limit_keeps_pending_loads_whole(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    pages = [page(("Jan 01", 2, 10)), page(("Jan 01", 2, 7), name="B")]
    two = listing(spark, record("A")).unionByName(listing(spark, record("B"), page=2))
    with pytest.raises(qa.BuildFailed):
        run_daily(spark, wh, two, history(spark, *pages, ("A", 500, "")), DAYS[0], "0001", dev_page_limit=1, max_failed_pages=0)
    run_daily(spark, wh, two, history(spark, *pages), DAYS[1], "0002", as_of=DAYS[1].date())
    assert models_now(spark, wh) == refreshed(spark, wh)
    assert rows(read_models(spark, wh)["int_item_price_history_daily"].select("item_name", "units_sold")) == [("A", 10), ("B", 7)]


def test_cut_short_swaps_are_settled(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    df = spark.createDataFrame([(1, DAYS[0])], "v bigint, at timestamp")
    loads.publish_load(df, raw, "1", "at")
    os.rename(f"{raw}/load_id=1", f"{tmp_dir}/away")
    os.makedirs(f"{raw}/_attempt", exist_ok=True)
    os.rename(f"{tmp_dir}/away", f"{raw}/_attempt/load_id=1")  # a crash between the two moves
    os.makedirs(f"{raw}/_attempt/load_id=2/_temporary")        # and one before the job's end
    loads.settle(spark, raw)
    assert sorted(os.listdir(raw)) == ["load_id=1"] and spark.read.parquet(raw).count() == 1
    table = f"{tmp_dir}/t"
    fs.swap_table(spark, table, lambda out: df.write.parquet(out))
    os.rename(table, f"{tmp_dir}/_old_t")
    fs.settle_table(spark, table)
    assert spark.read.parquet(table).count() == 1
    df.unionByName(df).write.parquet(f"{tmp_dir}/_next_t")
    os.rename(table, f"{tmp_dir}/_old_t")
    fs.settle_table(spark, table)
    assert spark.read.parquet(table).count() == 2 and not os.path.exists(f"{tmp_dir}/_old_t")
    with pytest.raises(OSError):
        fs.move(spark, raw, table)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merges_read_the_touched_partitions_only(spark, tmp_dir):
    schema = "k string, at timestamp, _dlt_load_id string, month date"

    def frame(*points):
        return spark.createDataFrame([(k, dt.datetime(2026, mo, 1), x, dt.date(2026, mo, 1)) for k, mo, x in points], schema)
    first = frame(("A", 1, "1"), ("A", 2, "1"), ("B", 2, "3"), ("A", 3, "1"))
    asked = []

    def raw(dates):
        asked.append(dates)
        return first
    target, keys, order = f"{tmp_dir}/t", ["k", "at"], ["_dlt_load_id"]
    assert inc.materialize_newest(spark, target, raw, None, keys, order, "month")["mode"] == "full"
    names = {d: set(os.listdir(f"{target}/month=2026-0{d}-01")) for d in (1, 2, 3)}
    late = frame(("A", 2, "2"), ("B", 2, "2"), ("C", 2, "2"))  # an older load for B than the one kept
    info = inc.materialize_newest(spark, target, raw, late, keys, order, "month")
    assert info["partitions"] == [dt.date(2026, 2, 1)] and asked == [None]
    assert rows(spark.read.parquet(target).select("k", F.month("at"), "_dlt_load_id")) == [
        ("A", 1, "1"), ("A", 2, "2"), ("A", 3, "1"), ("B", 2, "3"), ("C", 2, "2")]
    assert all(set(os.listdir(f"{target}/month=2026-0{d}-01")) == names[d] for d in (1, 3))
    inc.materialize_newest(spark, target, raw, late.limit(0), keys, order, "month", stale=[dt.date(2026, 2, 1)])
    assert asked == [None, [dt.date(2026, 2, 1)]] and spark.read.parquet(target).count() == 4
    plan = plan_of(spark.read.parquet(target).where(inc.in_partitions("month", [dt.date(2026, 2, 1)])))
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [(month" in plan


def test_raw_reads_are_pruned_by_derived_partitions(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    run_ingest(spark, wh, listing(spark, record("A")), history(spark, page(("Jan 01", 2, 1), ("Feb 01", 2, 1))), DAYS[0], "0001")
    for name, schema, column, date in (("item_price_history_raw", schemas.ITEM_PRICE_HISTORY_RAW, "_month", dt.date(2026, 2, 1)),
                                       ("items_raw", schemas.ITEMS_RAW, "_day", DAYS[0].date())):
        df = loads.read_finished(spark, wh.path(name), schema, wh.ledger(spark), only=["0001"], within=(column, [date]))
        assert f"PartitionFilters: [" in plan_of(df) and f"({column}#" in plan_of(df).split("PartitionFilters")[1].split("]")[0]
        assert df.count() == 1


def test_untouched_buckets_keep_their_files(spark, tmp_dir):
    target = f"{tmp_dir}/dim"
    whole = spark.range(2000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.lit(1).alias("v"))
    inc.materialize_buckets(spark, target, whole, None, "k", buckets=16)
    before = {b: sorted(os.listdir(f"{target}/{b}")) for b in os.listdir(target) if b.startswith("key_bucket=")}
    fresh = spark.createDataFrame([("k5", 2), ("new", 3)], "k string, v int")
    info = inc.materialize_buckets(spark, target, whole, fresh, "k",
                                   lambda old, new: old.join(new, "k", "left_anti").unionByName(new), buckets=16)
    after = {b: sorted(os.listdir(f"{target}/{b}")) for b in os.listdir(target) if b.startswith("key_bucket=")}
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2 and changed == {f"key_bucket={b}" for b in info["buckets"]} and len(after) == 16
    got = spark.read.parquet(target)
    assert got.count() == 2001 and got.where("v > 1").count() == 2
