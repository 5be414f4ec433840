"""The daily run: ingest archived pages -> raw tables -> models -> tests -> exports.

Builders call each other as functions; only the tables the warehouse
materialises are written (raw appends, the month-partitioned daily history, the
day-partitioned fact and reports, the latest-item table, the dimension).
Downstream models read the written tables back with a literal partition bound,
which also cuts the lineage at each materialisation.

A load is published as a unit and entered in a ledger; the models take every load that is extracted and not
yet modelled, so nothing that a stopped run has loaded is lost (`bazaar.sources.loads`). The staged tables
keep the newest row per key and merge what a load brings; tables are written aside and swapped in.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar import schemas
from bazaar.operators import ingest as ig
from bazaar.operators import quality as qa
from bazaar.operators import search
from bazaar.plans import incremental as inc
from bazaar.plans import models as m
from bazaar.plans import partials as pt
from bazaar.session import materialize_at
from bazaar.sources import folders as fs
from bazaar.sources import loads
from bazaar.sources import raw as src
from bazaar.sources.loads import Ledger, publish_load
from bazaar.sources.sinks import export_parquet, write_table

REPORTS = ("rpt_market_metrics_daily", "rpt_commodity_velocity_daily", "rpt_item_metrics_latest")


@dataclass
class Warehouse:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.path("_ledger"))


# --- extract / load -------------------------------------------------------------------

def load_items(listing_pages: DataFrame, run_ts: _dt.datetime, load_id: str, body: str = "body",
               dev_page_limit: int | None = None) -> DataFrame:
    """API result pages -> items_raw rows (stamped, pruned, flattened, keyed).

    Every listing record is loaded, also one without an item name: the not_null tests are there to show it.
    `_dlt_id` is unique: it hashes the load, the page and the record's position in the page.
    `dev_page_limit` takes the pages numbered 1 to the limit, before any is parsed.
    """
    if dev_page_limit is not None:
        listing_pages = ig.first_pages(listing_pages, dev_page_limit)
    return keyed_items(parsed_items(listing_pages, run_ts, body), load_id)


def parsed_items(listing_pages: DataFrame, run_ts: _dt.datetime, body: str = "body") -> DataFrame:
    """API result pages -> records with their place, `__page` and `__pos` (stamped, pruned, flattened)."""
    recs = ig.parse_results_pages(listing_pages, body, place=("__page", "__pos"))
    return ig.flatten_struct(ig.prune_redundant(ig.stamp_snapshot(recs, run_ts)))


def keyed_items(records: DataFrame, load_id: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records with their place -> items_raw rows, and the columns to keep."""
    rows = ig.add_load_metadata(records, load_id, ["__page", "__pos"])
    return src.conform(rows, schemas.ITEMS_RAW, "items_raw", keep)


def keyed_history(records: DataFrame, load_id: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Price records -> item_price_history_raw rows, and the columns to keep."""
    rows = ig.add_load_metadata(records, load_id, ["market_hash_name", "date"])
    return src.conform(rows, schemas.ITEM_PRICE_HISTORY_RAW, "item_price_history_raw", keep)


def run_ingest(spark: SparkSession, wh: Warehouse, listing_pages: DataFrame, history_pages: DataFrame,
               run_ts: _dt.datetime, load_id: str, grain: str = "day", max_failed_pages: int | None = None,
               dev_page_limit: int | None = None, max_failed_share: float | None = None) -> dict:
    """One batch into two sinks: the listing records, and the price history of the fetched pages.

    Each table of the load replaces what an earlier attempt left, whole; then the per-item state is committed, and the
    ledger says that the load is extracted. Failed pages are logged and their items skipped. More than
    `max_failed_pages` of them, or than their `max_failed_share` (None: any), stop the run here; the load
    stays pending, and the next run models it.
    """
    ledger = wh.ledger(spark)
    for name in ("items_raw", "item_price_history_raw", "_errors"):
        loads.settle(spark, wh.path(name))
    ledger.reopen(load_id)
    if dev_page_limit is not None:
        listing_pages = ig.first_pages(listing_pages, dev_page_limit)
    # written as they come first: laying them out takes two looks, and the pages are to be parsed once. The row ids,
    # half of a row's bytes on disk, are added where the rows are written
    items, items_path = materialize_at(parsed_items(listing_pages, run_ts), "load-items", "zstd")
    publish_load(items, wh.path("items_raw"), load_id, "snapshot_timestamp",
                 cluster_by=("asset_description__market_hash_name",),
                 finish=lambda rows: keyed_items(rows, load_id, keep=("_day",)))
    fs.delete(spark, items_path)
    if dev_page_limit is not None:  # the history of the listed items only
        listed = inc.read_loads(spark, wh.path("items_raw"), schemas.ITEMS_RAW).where(F.col("load_id") == load_id)
        names = listed.select(F.col("asset_description__market_hash_name").alias("market_hash_name")).distinct()
        history_pages = history_pages.join(names, "market_hash_name", "left_semi")
    hist_path = wh.path("item_price_history_raw")
    prior = inc.read_loads(spark, hist_path, schemas.ITEM_PRICE_HISTORY_RAW) if inc.path_exists(spark, hist_path) \
        else None
    state = inc.read_state(spark, wh.path("_state"), prior, before_load_id=load_id, grain=grain,
                           data_path=hist_path)
    ex = ig.extract_price_history(history_pages, state, grain=grain)
    publish_load(ex.records, hist_path, load_id, "date", by="month", cluster_by=("market_hash_name", "date"),
                 finish=lambda rows: keyed_history(rows, load_id, keep=("_month",)))
    written = inc.read_loads(spark, hist_path, schemas.ITEM_PRICE_HISTORY_RAW).where(F.col("load_id") == load_id)
    mark_type = schemas.state_schema(grain)["last_seen"].dataType
    inc.commit_state(ig.advance_state(state, written, as_type=mark_type), wh.path("_state"), load_id)
    # failed pages go to an errors table, by load
    publish_load(ex.errors, wh.path("_errors"), load_id)
    loads.forget_retired(spark, wh.path("_errors"), [load_id])
    errors = inc.read_loads(spark, wh.path("_errors"), schemas.PAGE_ERROR).where(F.col("load_id") == load_id)
    # one row per outcome class: bounded, safe to bring to the driver for the gate
    counts = ig.outcome_counts(ex.outcomes)
    counts = spark.createDataFrame(counts.collect(), counts.schema)
    fs.delete(spark, ex.pages_path)
    ledger.mark(load_id, loads.EXTRACTED, run_ts, qa.failed_pages(counts))
    qa.gate_load(counts, max_failed_pages, max_failed_share=max_failed_share)
    return {"outcomes": counts, "errors": errors}


# --- transform ------------------------------------------------------------------------

def run_models(spark: SparkSession, wh: Warehouse, lookback_days: int = 0, full: bool = False,
               late_sales: bool = False) -> dict:
    """Build every model from the raw tables; incremental where the targets exist.

    Taken are all loads that are extracted and not yet modelled; at the end the ledger says that they are. Without
    any, nothing is done. `full` rebuilds everything from all extracted loads. `lookback_days` widens the
    fact and, with it, the reports. `late_sales` also brings sales of still earlier days into the fact and the reports, by
    difference (`bazaar.plans.partials`); without it they stay out until a full build, as in the reference. Listing rows without a snapshot date are quarantined, each in the load that
    brought it, and kept out of the fact, so full and incremental runs agree (SURVEY D8).
    """
    ledger = wh.ledger(spark)
    pending = ledger.reached(loads.EXTRACTED) if full else ledger.pending()
    if not pending:
        return {}
    items_path, hist_path = wh.path("items_raw"), wh.path("item_price_history_raw")
    for name in ("dim_item", "rpt_item_metrics_latest"):
        fs.settle_table(spark, wh.path(name))
    pt.finish_change(spark, wh.root.rstrip("/"))

    def items(**bounds):
        return m.stg_items_projected(loads.read_finished(spark, items_path, schemas.ITEMS_RAW, ledger, **bounds))

    def history(**bounds):
        rows = loads.read_finished(spark, hist_path, schemas.ITEM_PRICE_HISTORY_RAW, ledger, **bounds)
        return m.stg_item_price_history_projected(rows).withColumn("price_month", F.trunc(F.to_date("priced_at"), "MM"))

    # rows of attempts that were replaced since they were modelled: what they shaped is built again
    gone_items = None if full else loads.retired(spark, items_path, schemas.ITEMS_RAW, pending)
    gone_history = None if full else loads.retired(spark, hist_path, schemas.ITEM_PRICE_HISTORY_RAW, pending)
    for load_id in pending:
        publish_load(items(only=[load_id]).where(F.col("snapshot_date").isNull()), wh.path("_quarantine/stg_items"), load_id)
    loads.forget_retired(spark, wh.path("_quarantine/stg_items"), pending)

    # the staged tables: newest row per key, merged by the days and months that the loads touch
    days, months = loads.days_of(spark, items_path, pending), loads.days_of(spark, hist_path, pending, "_month")
    fresh_items, fresh_history = items(only=pending), history(only=pending)
    info = {"stg_items": inc.materialize_newest(
        spark, wh.path("stg_items"), lambda d: items(within=d and ("_day", d)), None if full else fresh_items,
        ["item_name", "snapshot_date"], m.STG_ITEMS_ORDER, "snapshot_date", cluster_by=["item_name"],
        stale=days if gone_items is not None else ())}
    info["stg_item_price_history"] = inc.materialize_newest(
        spark, wh.path("stg_item_price_history"), lambda d: history(within=d and ("_month", d)),
        None if full else fresh_history, ["item_name", "priced_at"], m.STG_HISTORY_ORDER, "price_month",
        tiebreak=None, cluster_by=["item_name"], stale=months if gone_history is not None else ())
    stg = spark.read.schema(fresh_items.schema).parquet(wh.path("stg_items"))
    kept = spark.read.schema(fresh_history.schema).parquet(wh.path("stg_item_price_history"))

    touched = fresh_history.drop("price_month")
    if gone_history is not None:
        touched = touched.unionByName(m.stg_item_price_history_projected(gone_history))
    daily_path = wh.path("int_item_price_history_daily")
    info["int_item_price_history_daily"] = inc.materialize_monthly(
        spark, daily_path, None, None if full else touched, kept=kept)
    daily_schema = m.int_item_price_history_daily(touched).schema.add("price_month", "date")

    def daily(since):
        d = spark.read.schema(daily_schema).parquet(daily_path)
        if since is not None:
            d = d.where(F.col("price_month") >= F.trunc(F.lit(str(since)).cast("date"), "MM"))
            d = d.where(F.col("price_date") >= F.lit(str(since)).cast("date"))
        return d.drop("price_month")

    reach_back = min(days, default=None)

    def by_day(name, build, cluster_by=(), **how):
        if full:
            fs.swap_table(spark, wh.path(name), lambda out: write_table(build(None), out, ["market_date"], cluster_by,
                                                                        dynamic=False, **how))
            return {"mode": "full", "since": None}
        return inc.materialize_incremental(spark, wh.path(name), build, "market_date", cluster_by, lookback_days, reach_back,
                                           **how)

    info["fct_market_daily"] = by_day("fct_market_daily", lambda since: m.fct_joined(stg, daily(since), since),
                                      ["item_name"], finish=m.fct_measured, staged="fct-rows")
    fct_schema = m.fct_market_daily(stg, daily(None)).schema

    def fct_from(since):
        return inc.read_guarded(spark, wh.path("fct_market_daily"), "market_date", lower=since or m.REPORT_FLOOR,
                                schema=fct_schema)

    info["rpt_market_metrics_daily"] = by_day(
        "rpt_market_metrics_daily", lambda since: m.rpt_market_metrics_daily(fct_from(since), since))
    info["rpt_commodity_velocity_daily"] = by_day(
        "rpt_commodity_velocity_daily", lambda since: m.rpt_commodity_velocity_daily(fct_from(since), since),
        ["is_commodity"])
    info["day_partials"] = by_day("day_partials", lambda since: pt.day_partials(fct_from(since)), ["is_commodity"])
    since = info["fct_market_daily"]["since"]
    if late_sales and since is not None:
        keys = touched.select("item_name", F.to_date("priced_at").alias("day"))
        info["late_sales"] = pt.correct_late_sales(
            spark, wh.root.rstrip("/"), spark.read.schema(fct_schema).parquet(wh.path("fct_market_daily")),
            spark.read.schema(daily_schema).parquet(daily_path), keys, since)
    fs.swap_table(spark, wh.path("rpt_item_metrics_latest"), lambda out: write_table(
        m.rpt_item_metrics_latest(fct_from(None)), out,
        cluster_by=["item_name", "item_type", "bucket_group_name"], dynamic=False))
    if full or gone_items is not None:
        info["dim_item"] = inc.materialize_buckets(spark, wh.path("dim_item"), m.dim_item(stg), None, "item_name")
    else:
        # the days of the loads as merged, so that of a day's rows the same one counts as in a full refresh
        fresh = m.dim_item(stg.where(inc.in_partitions("snapshot_date", days)))
        info["dim_item"] = inc.materialize_buckets(
            spark, wh.path("dim_item"), m.dim_item(stg), fresh, "item_name",
            lambda current, rows: m.dim_item_upsert(
                current.where(~inc.in_partitions("snapshot_date", days)), rows, None))
    for load_id in pending:
        ledger.mark(load_id, loads.MODELLED)
    for path in (items_path, hist_path):
        loads.forget_retired(spark, path, pending)
    return info


def read_models(spark: SparkSession, wh: Warehouse) -> dict[str, DataFrame]:
    out = {}
    for name in ("int_item_price_history_daily", "dim_item", "fct_market_daily") + REPORTS:
        if name == "int_item_price_history_daily":  # may hold no row, hence no file to read a schema from
            declared = m.int_item_price_history_daily(m.stg_item_price_history(
                spark.createDataFrame([], schemas.ITEM_PRICE_HISTORY_RAW))).schema
            out[name] = spark.read.schema(declared).parquet(wh.path(name)).drop("price_month")
        elif name == "dim_item":
            out[name] = spark.read.parquet(wh.path(name)).select(*m.DIM_COLUMNS)
        else:
            out[name] = spark.read.parquet(wh.path(name))
    return out


def run_tests(spark: SparkSession, wh: Warehouse, as_of: _dt.date | None = None, gate: bool = True) -> DataFrame:
    """The declared data tests on the written models; one row per test (19 rows)."""
    results = qa.run_tests(read_models(spark, wh), as_of=as_of)
    results = spark.createDataFrame(results.collect(), results.schema)
    if gate:
        qa.gate_build(results)
    return results


def index_latest(spark: SparkSession, wh: Warehouse) -> None:
    """Build the explorer's search index of the latest report, once after each run that changes it."""
    search.build_search_index(spark.read.parquet(wh.path("rpt_item_metrics_latest")).select(*m.RPT_LATEST_COLUMNS),
                              wh.path("search_index"))


def search_latest(spark: SparkSession, wh: Warehouse, query: str) -> DataFrame:
    return search.search_indexed(spark, wh.path("search_index"), query)


#: The partition columns of the written reports.
REPORT_PARTITIONS = {"rpt_market_metrics_daily": ("market_date",), "rpt_commodity_velocity_daily": ("market_date",)}


def run_exports(spark: SparkSession, wh: Warehouse, export_root: str) -> dict[str, str]:
    """Post-build: each report -> `<export_root>/<name>/` after its contract check."""
    out = {}
    for name in REPORTS:
        df = qa.check_contract(spark.read.parquet(wh.path(name)), schemas.REPORT_CONTRACTS[name], name,
                               REPORT_PARTITIONS.get(name, ()))
        out[name] = export_parquet(df, export_root, name)
    return out


def run_daily(spark: SparkSession, wh: Warehouse, listing_pages: DataFrame, history_pages: DataFrame,
              run_ts: _dt.datetime, load_id: str, export_root: str | None = None, grain: str = "day",
              as_of: _dt.date | None = None, max_failed_pages: int | None = None, lookback_days: int = 0,
              dev_page_limit: int | None = None, gate: bool = True, max_failed_share: float | None = None,
              late_sales: bool = False) -> dict:
    """Extract/load, gate, transform, test, export — one daily batch.

    The models take this load and all that earlier runs have left pending. Failed pages do not stop the run unless
    `max_failed_pages` or `max_failed_share` say so; a failed data test stops it before the exports
    (`gate=False` lets it pass).
    """
    ingest = run_ingest(spark, wh, listing_pages, history_pages, run_ts, load_id, grain, max_failed_pages,
                        dev_page_limit, max_failed_share)
    info = run_models(spark, wh, lookback_days, late_sales=late_sales)
    results = run_tests(spark, wh, as_of=as_of, gate=gate)
    exports = run_exports(spark, wh, export_root) if export_root else {}
    return {"ingest": ingest, "models": info, "tests": results, "exports": exports}
