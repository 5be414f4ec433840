"""Physical-plan properties the scale design relies on (AQE and auto-broadcast off so the
static plan is inspected, as on a cluster where both sides are large)."""

import re

import pytest
from pyspark.sql import functions as F

from bazaar.plans import dashboard as dash
from bazaar.plans import registry as R
from bazaar.sources.sinks import layout

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def static_plans(spark):
    keys = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_join_reuses_child_partitioning(static_plans):
    p = plan(R.fct(static_plans, SF))
    lines = p.splitlines()
    # exchanges keyed by item: the dedup windows (items, history) and the daily aggregate -- none for the join
    keyed = [ln for ln in lines if "Exchange hashpartitioning(item_name" in ln]
    assert len(keyed) == 3, keyed
    assert any("SortMergeJoin" in ln and "LeftOuter" in ln for ln in lines)
    smj = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln and "LeftOuter" in ln)
    first_below = [ln for ln in lines[smj + 1:] if "Exchange" in ln or "Window " in ln or "HashAggregate" in ln]
    assert "Exchange" not in first_below[0]  # a window / aggregate sits between the join and any exchange


def test_partial_top1_before_every_dedup_shuffle(static_plans):
    lines = plan(R.fct(static_plans, SF)).splitlines()
    for i, ln in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\(item_name#\d+, (snapshot_date|priced_at)", ln):
            assert "WindowGroupLimit" in lines[i + 1] and "Partial" in lines[i + 1], lines[i + 1]


def test_latest_report_one_shuffle_on_item_with_partial_rank(static_plans):
    p = plan(R.rpt_latest(static_plans, SF))
    assert re.search(r"WindowGroupLimit \[item_name#\d+\], \[market_date#\d+ DESC NULLS LAST\], rank", p)
    assert "Partial" in p


def test_report_floor_reaches_the_scan(static_plans):
    p = plan(R.rpt_market(static_plans, SF))
    scans = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "l_shipdate" in ln and "l_discount" in ln]
    assert scans and all("GreaterThanOrEqual(l_shipdate" in s for s in scans), scans


def test_date_parameter_is_a_broadcast_semi_join(static_plans):
    d = R.rpt_market(static_plans, SF)
    p = plan(dash.q_commodity_metrics(R.rpt_commodity(static_plans, SF), dash.latest_market_date(d)))
    assert re.search(r"BroadcastHashJoin \[market_date#\d+\], \[market_date#\d+\], LeftSemi", p)


def test_write_layout_splits_hot_keys(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("d"), (F.col("id") % 7).alias("k"), "id")
    p = plan(layout(df, ["d"], ["k"]))
    assert "rangepartitioning(d#" in p and "xxhash64(" in p
    assert "REPARTITION_BY_NUM" not in p  # the number of ranges is left to adaptive execution


def test_extraction_has_no_window_and_reads_the_archive_once(spark, tmp_dir):
    from bazaar import schemas
    from bazaar.operators import ingest as ig
    spark.createDataFrame([("A", 200, 'var line1=[["Nov 04 2024",1.5,"4"]];')], schemas.HISTORY_PAGE).write.parquet(
        f"{tmp_dir}/pages")
    ex = ig.extract_price_history(spark.read.parquet(f"{tmp_dir}/pages"))
    for df in (ex.records, ex.errors, ex.outcomes):
        p = plan(df)
        assert "Window" not in p and f"{tmp_dir}/pages" not in p and "judged-pages" in p


def test_month_bound_reaches_the_scan(spark, tmp_dir):
    import datetime as dt

    from bazaar import schemas
    from bazaar.plans import incremental as inc
    spark.createDataFrame([], schemas.ITEM_PRICE_HISTORY_RAW).write.parquet(f"{tmp_dir}/raw")
    raw = spark.read.schema(schemas.ITEM_PRICE_HISTORY_RAW).parquet(f"{tmp_dir}/raw")
    months = [dt.date(2024, 11, 1), dt.date(2024, 12, 1), dt.date(2025, 3, 1)]
    p = plan(raw.where(inc.in_months(months, "date")))
    assert "GreaterThanOrEqual(date,2024-11-01" in p and "LessThan(date,2025-01-01" in p
    assert "date#" in p and "2025-03-01 00:00:00) AND" in p and "2025-04-01 00:00:00" in p


def test_commodity_queries_build_the_fact_once(static_plans):
    for name in ("q_commodity_metrics", "q_commodity_breakdown"):
        p = plan(R.QUERIES[name](static_plans, SF))
        assert "Window" not in p and "lineitem" not in p and "dashboard-fct" in p


def test_fixture_tables_are_read_as_they_are(spark):
    from bazaar.sources import fixtures
    assert "Exchange" not in plan(fixtures.table(spark, SF, "lineitem"))
