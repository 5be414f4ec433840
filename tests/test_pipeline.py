import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaar import schemas
from bazaar.operators import quality as qa
from bazaar.plans import incremental as inc
from bazaar.plans import models as m
from bazaar.plans.pipeline import Warehouse, read_models, run_daily
from bazaar.sources import fixtures
from bazaar.sources.sinks import (EmptyExportError, ShardSchemaError, export_parquet, guard_nonempty_export,
                                  merge_parquet_shards, read_export)

SF = "/root/testdata/sf0.001"
CUT = dt.date(1998, 6, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def snapshot(spark, wh):
    return {k: rows(v) for k, v in read_models(spark, wh).items()}


@pytest.fixture(scope="module")
def daily_run(spark):
    import tempfile
    wh = Warehouse(tempfile.mkdtemp(prefix="bazaar-wh-"))
    lp = fixtures.listing_pages(spark, SF)
    hp = fixtures.history_pages(spark, SF)
    early = hp.where(F.col("month") < F.lit(str(CUT)).cast("date")).drop("month")
    late = hp.where(F.col("month") >= F.lit(str(CUT)).cast("date")).drop("month")
    r1 = run_daily(spark, wh, lp, early, dt.datetime(2026, 1, 1, 6), "0001", export_root=wh.path("exports"),
                   max_failed_pages=None)
    r2 = run_daily(spark, wh, lp, late, dt.datetime(2026, 1, 2, 6), "0002", export_root=wh.path("exports"),
                   max_failed_pages=None)
    return wh, r1, r2, late, lp


def test_incremental_equals_full_refresh(spark, daily_run):
    wh = daily_run[0]
    items_raw = inc.read_loads(spark, wh.path("items_raw"), schemas.ITEMS_RAW).drop("load_id")
    hist = inc.read_loads(spark, wh.path("item_price_history_raw"), schemas.ITEM_PRICE_HISTORY_RAW).drop("load_id")
    stg, h = m.stg_items(items_raw), m.stg_item_price_history(hist)
    daily = m.int_item_price_history_daily(h)
    fct = m.fct_market_daily(stg, daily)
    got = read_models(spark, wh)
    assert rows(got["int_item_price_history_daily"]) == rows(daily)
    assert rows(got["fct_market_daily"].select(*m.FCT_COLUMNS)) == rows(fct)
    assert rows(got["rpt_market_metrics_daily"].select(*schemas.RPT_MARKET_METRICS_DAILY.fieldNames())) == rows(
        m.rpt_market_metrics_daily(fct))
    assert rows(got["rpt_item_metrics_latest"]) == rows(m.rpt_item_metrics_latest(fct))
    assert got["fct_market_daily"].select("market_date").distinct().count() == 2


def test_history_loaded_once_and_marks_advance(spark, daily_run):
    wh = daily_run[0]
    hist = inc.read_loads(spark, wh.path("item_price_history_raw"), schemas.ITEM_PRICE_HISTORY_RAW)
    assert hist.groupBy("market_hash_name", "date").count().where("count > 1").count() == 0
    expected = m.stg_item_price_history(fixtures.item_price_history_raw(spark, SF))
    sizes = fixtures.table(spark, SF, "part").select(
        F.concat(F.lit("ITEM-"), F.col("p_partkey").cast("string")).alias("item_name"), "p_size")
    good = expected.join(sizes, "item_name").where(~F.col("p_size").isin(45, 46, 47, 48, 49, 50))
    assert hist.count() == good.count()
    st = inc.read_state(spark, wh.path("_state"))
    assert st.count() == good.select("item_name").distinct().count()


def test_replay_of_a_load_changes_nothing(spark, daily_run):
    wh, _, _, late, lp = daily_run
    before = snapshot(spark, wh)
    raw_before = rows(inc.read_loads(spark, wh.path("item_price_history_raw"), schemas.ITEM_PRICE_HISTORY_RAW))
    run_daily(spark, wh, lp, late, dt.datetime(2026, 1, 2, 6), "0002", max_failed_pages=None)
    assert snapshot(spark, wh) == before
    assert rows(inc.read_loads(spark, wh.path("item_price_history_raw"), schemas.ITEM_PRICE_HISTORY_RAW)) == raw_before


def test_data_tests_pass_and_exports_exist(spark, daily_run):
    wh, r1, r2 = daily_run[0], daily_run[1], daily_run[2]
    res = r2["tests"]
    assert res.count() == 19
    assert res.where("failures > 0").count() == 0
    for name in ("rpt_market_metrics_daily", "rpt_commodity_velocity_daily", "rpt_item_metrics_latest"):
        df = read_export(spark, wh.path(f"exports/{name}"))
        qa.check_contract(df, schemas.REPORT_CONTRACTS[name], name)
    # damaged pages were isolated, not fatal (read fresh: a replay rewrote the partition)
    errors = spark.read.parquet(wh.path("_errors"))
    assert errors.count() > 0 and r2["ingest"]["outcomes"].count() == 5


def test_partition_guard(spark, daily_run):
    wh = daily_run[0]
    with pytest.raises(inc.PartitionFilterRequired):
        inc.read_guarded(spark, wh.path("fct_market_daily"), "market_date")
    df = inc.read_guarded(spark, wh.path("fct_market_daily"), "market_date", lower=dt.date(2026, 1, 2))
    assert "PartitionFilters: [isnotnull(market_date" in df._jdf.queryExecution().executedPlan().toString() or \
        df.select("market_date").distinct().count() == 1


def test_month_recompute_fixes_partial_months(spark, tmp_dir):
    """A later load adding old history of a new item (and mid-month days) must not lose rows."""
    raw = fixtures.item_price_history_raw(spark, SF)
    late = (F.col("date") >= F.lit("1998-06-15").cast("timestamp")) | (F.col("market_hash_name") == "ITEM-1")
    target = f"{tmp_dir}/int"
    inc.materialize_monthly(spark, target, raw.where(~late), None)
    new = m.stg_item_price_history_projected(raw.where(late))
    assert inc.materialize_monthly(spark, target, raw, new)["mode"] == "incremental"
    got = spark.read.parquet(target).drop("price_month")
    assert rows(got) == rows(m.int_item_price_history_daily(m.stg_item_price_history(raw)))
    nothing = m.stg_item_price_history_projected(raw.limit(0))
    assert inc.materialize_monthly(spark, target, raw, nothing)["months"] == []


def test_full_rebuild_drops_stale_months(spark, tmp_dir):
    def raw(day):
        return spark.createDataFrame([("A", dt.datetime(2024, day, 5), None, 1, "1", "x")],
                                     schemas.ITEM_PRICE_HISTORY_RAW)
    inc.materialize_monthly(spark, f"{tmp_dir}/int", raw(1), None)
    inc.materialize_monthly(spark, f"{tmp_dir}/int", raw(5), None)
    assert [r.price_date for r in spark.read.parquet(f"{tmp_dir}/int").collect()] == [dt.date(2024, 5, 5)]


def test_export_guards(spark, tmp_dir):
    with pytest.raises(EmptyExportError):
        guard_nonempty_export(spark, f"{tmp_dir}/nothing")
    a = spark.createDataFrame([(1, "x")], "a bigint, b string")
    b = spark.createDataFrame([(2, "y", 3.0)], "a bigint, b string, c double")
    a.write.parquet(f"{tmp_dir}/exp/t")
    b.write.mode("append").parquet(f"{tmp_dir}/exp/t")
    with pytest.raises(ShardSchemaError):
        read_export(spark, f"{tmp_dir}/exp/t")
    for other in (b, a.drop("b"), a.withColumn("a", F.col("a").cast("int"))):  # more, fewer, other types beside an export
        out = export_parquet(a, f"{tmp_dir}/noted", "t")
        assert rows(read_export(spark, out)) == [(1, "x")]
        other.write.mode("append").parquet(out)
        with pytest.raises(ShardSchemaError):
            read_export(spark, out)
    assert "content" not in read_export(spark, export_parquet(a, f"{tmp_dir}/noted", "t"))._jdf.queryExecution().toString()
    export_parquet(spark.range(10).repartition(3), f"{tmp_dir}/ok", "r")
    merge_parquet_shards(spark, f"{tmp_dir}/ok/r", f"{tmp_dir}/ok/merged")
    assert len(guard_nonempty_export(spark, f"{tmp_dir}/ok/merged")) == 1
    assert spark.read.parquet(f"{tmp_dir}/ok/merged").count() == 10


def test_state_recovered_from_data_after_lost_commit(spark, tmp_dir):
    recs = spark.createDataFrame([("A", dt.datetime(2024, 1, 3), None, 1, "0002"),
                                  ("A", dt.datetime(2024, 1, 1), None, 1, "0001")],
                                 inc.with_load_id(schemas.PRICE_RECORD))
    recs.write.partitionBy("load_id").parquet(f"{tmp_dir}/data")
    data = inc.read_loads(spark, f"{tmp_dir}/data", schemas.PRICE_RECORD)
    inc.commit_state(data.where("load_id = '0001'").groupBy("market_hash_name").agg(
        F.max(F.to_date("date")).alias("last_seen")), f"{tmp_dir}/state", "0001")
    # load 0002's data exists but its state was never committed -> derive from data
    st = inc.read_state(spark, f"{tmp_dir}/state", data)
    assert st.first().last_seen == dt.date(2024, 1, 3)
    # a replay of 0002 starts from 0001's state
    st2 = inc.read_state(spark, f"{tmp_dir}/state", data, before_load_id="0002")
    assert st2.first().last_seen == dt.date(2024, 1, 1)


def test_quality_gate_raises(spark):
    df = spark.createDataFrame([("A", None), ("A", dt.date(2024, 1, 1))], "item_name string, market_date date")
    res = qa.run_tests({"rpt_item_metrics_latest": df}, as_of=dt.date(2024, 1, 1))
    got = {(r.test, r.column_name): r.failures for r in res.collect()}
    assert got == {("not_null", "item_name"): 0, ("not_null", "market_date"): 1, ("unique", "item_name"): 1}
    with pytest.raises(qa.BuildFailed):
        qa.gate_build(res)
    with pytest.raises(qa.ContractError):
        qa.check_contract(df, schemas.RPT_ITEM_METRICS_LATEST)


def test_table_mark_from_listing(spark, tmp_dir):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 2, 3), 2)], "market_date date, v int")
    df.write.partitionBy("market_date").parquet(f"{tmp_dir}/t")
    assert inc.partition_values(spark, f"{tmp_dir}/t", "market_date") != []
    assert inc.table_mark(spark, f"{tmp_dir}/t", "market_date") == dt.date(2024, 2, 3)
    assert inc.table_mark(spark, f"{tmp_dir}/missing", "market_date") is None
    spark.createDataFrame([("a b/c", 1)], "k string, v int").write.partitionBy("k").parquet(f"{tmp_dir}/esc")
    assert inc.partition_values(spark, f"{tmp_dir}/esc", "k") == ["a b/c"]


def test_half_written_state_does_not_count(spark, tmp_dir):
    import os
    recs = spark.createDataFrame([("A", dt.datetime(2024, 1, 3), None, 1, "0001")],
                                 inc.with_load_id(schemas.PRICE_RECORD))
    recs.write.partitionBy("load_id").parquet(f"{tmp_dir}/data")
    os.makedirs(f"{tmp_dir}/state/load_id=0001/_temporary")
    data = inc.read_loads(spark, f"{tmp_dir}/data", schemas.PRICE_RECORD)
    st = inc.read_state(spark, f"{tmp_dir}/state", data, before_load_id="0002", data_path=f"{tmp_dir}/data")
    assert [(r.market_hash_name, r.last_seen) for r in st.collect()] == [("A", dt.date(2024, 1, 3))]
    assert inc.read_state(spark, f"{tmp_dir}/state") is None


def listing(spark, *records, page=1):
    import json
    return spark.createDataFrame([(page, json.dumps({"total_count": len(records), "results": list(records)}))],
                                 "page_no bigint, body string")


def record(name, price=150, classid="12", text="$1.40"):
    return {"sell_listings": 3, "sell_price": price, "sale_price_text": text, "asset_description": {
        "classid": classid, "tradable": 1, "type": "Rifle", "market_hash_name": name, "commodity": 0}}


def history(spark, *pages):
    return spark.createDataFrame(list(pages), schemas.HISTORY_PAGE)


DAY1, DAY2 = dt.datetime(2026, 1, 1, 6), dt.datetime(2026, 1, 2, 6)


def test_every_listing_record_is_loaded_with_an_id_of_its_own(spark):
    from bazaar.plans.pipeline import load_items
    got = load_items(listing(spark, record("A"), record(None), record("A"), record("")), DAY1, "0001").collect()
    assert len(got) == 4 and len({r._dlt_id for r in got}) == 4
    two = load_items(listing(spark, record("A")).unionByName(listing(spark, record("B"), page=2))
                     .unionByName(listing(spark, record("C"), page=3)), DAY1, "0001", dev_page_limit=2)
    assert {r.asset_description__market_hash_name for r in two.collect()} == {"A", "B"}


def test_dedup_does_not_follow_the_input_order(spark):
    from bazaar.plans.pipeline import load_items
    twins = [record("A", classid="12"), record("A", classid="99")]
    kept = {m.stg_items(load_items(listing(spark, *order), DAY1, "0001")).first().class_id
            for order in (twins, twins[::-1])}
    assert kept == {99}


def test_first_run_without_history_builds_a_fact_with_zero_sales(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    out = run_daily(spark, wh, listing(spark, record("A")), history(spark, ("A", 404, "gone")), DAY1, "0001",
                    as_of=DAY1.date(), export_root=wh.path("exports"))
    fact = spark.read.parquet(wh.path("fct_market_daily")).collect()
    assert [(r.item_name, r.units_sold) for r in fact] == [("A", 0)]
    assert set(out["exports"]) == {"rpt_market_metrics_daily", "rpt_commodity_velocity_daily", "rpt_item_metrics_latest"}


def test_gates_stop_the_run(spark, tmp_dir):
    import os
    wh = Warehouse(f"{tmp_dir}/a")
    for bound in ({"max_failed_pages": 0}, {"max_failed_share": 0.4}):
        with pytest.raises(qa.BuildFailed, match="load failed"):
            run_daily(spark, wh, listing(spark, record("A")), history(spark, ("A", 429, ""), ("B", 404, "")), DAY1,
                      "0001", export_root=wh.path("exports"), **bound)
    assert not os.path.exists(wh.path("fct_market_daily")) and not os.path.exists(wh.path("exports"))
    assert wh.ledger(spark).pending() == ["0001"]
    wh = Warehouse(f"{tmp_dir}/b")
    with pytest.raises(qa.BuildFailed, match="bid_price_usd"):
        run_daily(spark, wh, listing(spark, record("A", text="")), history(spark, ("A", 404, "")), DAY1, "0001",
                  export_root=wh.path("exports"), as_of=DAY1.date())
    assert not os.path.exists(wh.path("exports"))
    wh = Warehouse(f"{tmp_dir}/c")
    with pytest.raises(qa.BuildFailed, match="item_name"):
        run_daily(spark, wh, listing(spark, record(None)), history(spark, ("A", 404, "")), DAY1, "0001",
                  as_of=DAY1.date())


def test_lookback_reaches_the_reports(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    late = 'var line1=[["Jan 01 2026 01: +0","2","7"]];'
    run_daily(spark, wh, listing(spark, record("A")), history(spark, ("A", 404, "")), DAY1, "0001", as_of=DAY1.date())
    run_daily(spark, wh, listing(spark, record("A")), history(spark, ("A", 200, late)), DAY2, "0002",
              as_of=DAY2.date(), lookback_days=1)
    units = {r.market_date: r.total_units_sold for r in spark.read.parquet(wh.path("rpt_market_metrics_daily")).collect()}
    assert units == {DAY1.date(): 7, DAY2.date(): 0}


def test_quarantine_keeps_each_row_in_its_load(spark, tmp_dir):
    from bazaar.plans.pipeline import load_items, run_models
    from bazaar.sources import loads
    wh = Warehouse(tmp_dir)
    items = load_items(listing(spark, record("A"), record("B"), record("B", classid="13")), DAY1, "0001")
    undated = F.when(F.col("asset_description__market_hash_name") == "A", F.col("snapshot_timestamp"))
    items = items.withColumn("snapshot_timestamp", undated)
    more = load_items(listing(spark, record("A")), DAY2, "0002")
    none = spark.createDataFrame([], schemas.ITEM_PRICE_HISTORY_RAW)
    for load_id, rows_ in (("0001", items), ("0002", more)):
        loads.publish_load(rows_, wh.path("items_raw"), load_id, "snapshot_timestamp")
        loads.publish_load(none, wh.path("item_price_history_raw"), load_id, "date", by="month")
        wh.ledger(spark).mark(load_id, loads.EXTRACTED)
        run_models(spark, wh)
    bad = spark.read.parquet(wh.path("_quarantine/stg_items"))
    assert [(r.item_name, r.class_id) for r in bad.orderBy("class_id").collect()] == [("B", 12), ("B", 13)]
    assert spark.read.parquet(wh.path("fct_market_daily")).count() == 2


def test_raw_tables_have_the_declared_layout(spark, daily_run):
    import os
    wh = daily_run[0]
    assert sorted(os.listdir(wh.path("items_raw/load_id=0001")))[-1:] == ["_day=2026-01-01"]
    held = [x for x in os.listdir(wh.path("item_price_history_raw/load_id=0001")) if "SUCCESS" not in x]
    assert held and all(x.startswith("_month=") for x in held)


def test_contract_sees_order_and_extra_columns(spark):
    name, contract = "rpt_market_metrics_daily", schemas.REPORT_CONTRACTS["rpt_market_metrics_daily"]
    df = spark.createDataFrame([], contract)
    qa.check_contract(df, contract, name)
    stored = df.select(*[c for c in df.columns if c != "market_date"], "market_date")
    assert qa.check_contract(stored, contract, name, ["market_date"]).columns == contract.fieldNames()
    for wrong in (stored, df.withColumn("x", F.lit(1)), df.drop("market_date")):
        with pytest.raises(qa.ContractError):
            qa.check_contract(wrong, contract, name)


def test_type_drift_raises(spark):
    from bazaar.sources.raw import SchemaDriftError, conform
    base = spark.createDataFrame([], schemas.ITEMS_RAW)
    conform(base.withColumn("sell_price", F.col("sell_price").cast("int")), schemas.ITEMS_RAW)
    for c, t in (("sell_price", "double"), ("sell_price", "string"), ("sale_price_text", "bigint")):
        with pytest.raises(SchemaDriftError, match=c):
            conform(base.withColumn(c, F.col(c).cast(t)), schemas.ITEMS_RAW)


def test_merge_writes_the_files_asked_for(spark, tmp_dir):
    for n in (1, 30):
        export_parquet(spark.range(n * 10).repartition(6), f"{tmp_dir}/{n}", "r")
        merge_parquet_shards(spark, f"{tmp_dir}/{n}/r", f"{tmp_dir}/{n}/one")
        assert len(guard_nonempty_export(spark, f"{tmp_dir}/{n}/one")) == 1
    merge_parquet_shards(spark, f"{tmp_dir}/30/r", f"{tmp_dir}/30/two", files=2)
    assert len(guard_nonempty_export(spark, f"{tmp_dir}/30/two")) == 2


def test_one_pass_tests_equal_separate_ones(spark):
    df = spark.createDataFrame([("A", None), ("A", 1), ("B", 2), (None, 3), (None, None)], "item_name string, x int")
    t = qa.TableTests("t", not_null=["item_name", "x"], unique=["item_name"])
    want = qa.not_null_failures(df, "t", ["item_name", "x"]).unionByName(qa.unique_failures(df, "t", "item_name"))
    assert rows(qa.table_failures(df, t)) == rows(want)
    assert rows(qa.table_failures(df.limit(0), t)) == [("t", "not_null", "item_name", 0), ("t", "not_null", "x", 0),
                                                       ("t", "unique", "item_name", 0)]
