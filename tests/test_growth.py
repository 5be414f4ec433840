"""What keeps shuffled, spilled and written bytes in step with the input: one pass of each costly step."""

import datetime as dt
import re

from pyspark.sql import functions as F

from bazaar.operators import ingest as ig
from bazaar.operators import search
from bazaar.plans import models as m
from bazaar.plans import partials as pt
from bazaar.plans import pipeline
from bazaar.plans import registry as R
from bazaar.plans.registry import QUERIES
from bazaar.sources import sinks
from bazaar.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan(df, kind: str = "executedPlan") -> str:
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_pages_are_parsed_once(spark):
    p = plan(ig.parse_results_pages(fixtures.listing_pages(spark, SF)), "optimizedPlan")
    assert len(re.findall(r"from_json\(", p)) == 1, p
    placed = ig.parse_results_pages(fixtures.listing_pages(spark, SF), place=("__page", "__pos"))
    assert len(re.findall(r"from_json\(", plan(placed, "optimizedPlan"))) == 1
    points = QUERIES["explode_series"](spark, SF)
    assert len(re.findall(r"from_json\(", plan(points, "optimizedPlan"))) == 1


def test_lines_meet_by_page_before_they_are_collected(spark):
    lines = plan(fixtures.listing_pages(spark, SF)).splitlines()
    at = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning(page_no" in ln)
    assert not any("partial_collect_list" in ln for ln in lines[at + 1:])
    assert not any("Market" in ln for ln in lines[at:])  # what every record repeats is added later


def test_explode_once_keeps_null_items_and_drops_empty_arrays(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None), (4, ["b"])], "k int, xs array<string>")
    got = ig.explode_once(df, "xs", "x").orderBy("k", "__at").collect()
    assert [tuple(r) for r in got] == [(1, 0, "a"), (1, 1, None), (4, 0, "b")]


def test_a_sort_by_name_parses_no_page_twice(spark):
    df = QUERIES["order_by_name"](spark, SF)
    assert "from_json" not in plan(df, "optimizedPlan")
    names = [(r.market_hash_name, r.sell_price) for r in df.collect()]
    assert names == sorted(names) and len(names) == fixtures.items_raw(spark, SF).count()


def test_pages_hold_the_records_in_line_order(spark):
    page = fixtures.listing_pages(spark, SF).orderBy("page_no").limit(20)
    got = ig.parse_results_pages(page, place=("__page", "__pos")).select(
        "__page", "__pos", "name", "app_name", "asset_description.name", "asset_description.classid").collect()
    raw = fixtures.items_raw(spark, SF).withColumn("page", (F.col("_dlt_load_id").cast("bigint") + 1).cast("string"))
    want = {}
    for r in raw.orderBy("_dlt_id").collect():
        want.setdefault(r.page, []).append((r.asset_description__market_hash_name, r.asset_description__classid))
    assert len({r[0] for r in got}) == 20
    for r in got:
        assert (r[2], r[5]) in want[r[0]] and r[3] == "Market" and r[4] == r[2]
    assert all(len([r for r in got if r[0] == k]) == len(want[k]) for k in {r[0] for r in got})


def test_dollars_are_worked_out_for_the_rows_kept(spark):
    raw = fixtures.items_raw(spark, SF)
    stg = m.stg_items(raw)
    assert stg.columns == m.stg_items_projected(raw).columns
    below = plan(stg, "optimizedPlan").split("WindowGroupLimit" if "WindowGroupLimit" in plan(stg, "optimizedPlan") else "Window ")[-1]
    assert "AS ask_price_usd" not in below and "AS bid_price_usd" in below
    # the same rows whatever type the cents come in
    texts = m.stg_items(raw.withColumn("sell_price", F.col("sell_price").cast("string")))
    assert texts.exceptAll(stg).count() == stg.exceptAll(texts).count() == 0


def test_the_dashboard_writes_the_columns_its_reports_read(spark):
    f = R.written_fct(spark, SF)
    assert set(f.columns) == {"is_commodity", "market_date", *pt.MEASURES}
    whole = m.rpt_commodity_velocity_daily(R.fct(spark, SF))
    assert m.rpt_commodity_velocity_daily(f).exceptAll(whole).count() == 0


def _laid_out(monkeypatch, *modules) -> list:
    """The optimized plans that `write_table` is given."""
    seen = []

    def noted(df, *a, **b):
        seen.append(plan(df, "optimizedPlan"))
        return sinks.write_table(df, *a, **b)
    for mod in modules:
        monkeypatch.setattr(mod, "write_table", noted)
    return seen


def test_an_index_works_its_rows_out_once(spark, tmp_dir, monkeypatch):
    seen = _laid_out(monkeypatch, search)
    rows = spark.createDataFrame([("A", "red ring"), ("B", None), (None, "bolt")], "item_name string, t string")
    search.build_search_index(rows.distinct(), f"{tmp_dir}/index")
    assert len(seen) == 3 and not any("Aggregate" in p or "regexp" in p for p in seen)
    assert {r.item_name for r in search.search_indexed(spark, f"{tmp_dir}/index", "ri").collect()} == {"A"}


def test_a_load_parses_its_pages_once(spark, tmp_dir, monkeypatch):
    from bazaar.sources import loads
    seen = _laid_out(monkeypatch, loads)
    wh = pipeline.Warehouse(f"{tmp_dir}/wh")
    pipeline.run_ingest(spark, wh, fixtures.listing_pages(spark, SF).where("page_no < 50"),
                        fixtures.history_pages(spark, SF).drop("month").limit(20), dt.datetime(2026, 1, 1), "0001")
    assert seen and not any("from_json" in p for p in seen)
