"""The eight models: staging -> intermediate -> dimension / fact -> reports.

Each builder is a pure `DataFrame -> DataFrame` function, so "views" and
"ephemeral" models are simply lazy plans that Catalyst inlines; only the
incremental writer (`bazaar.plans.incremental`) materialises anything.
Incremental branches take their bound as a Python value resolved beforehand,
so the bound is a literal and prunes partitions at the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions import scalar as fx
from bazaar.operators.dedup import by_width, keep_first, keep_top_ties
from bazaar.schemas import MONEY

EPOCH = _dt.date(1970, 1, 1)
REPORT_FLOOR = _dt.date(2000, 1, 1)   # full-refresh floor of the reports


# --- staging ------------------------------------------------------------------------

def stg_items_projected(items_raw: DataFrame) -> DataFrame:
    """Rename + cast of the raw listing snapshot (15 columns)."""
    r = F.col
    return items_raw.select(
        r("asset_description__market_hash_name").cast("string").alias("item_name"),
        fx.safe_cast("asset_description__classid", "bigint").alias("class_id"),
        r("asset_description__market_bucket_group_id").cast("string").alias("bucket_group_id"),
        r("asset_description__type").cast("string").alias("item_type"),
        r("asset_description__name_color").cast("string").alias("name_color"),
        r("asset_description__market_bucket_group_name").cast("string").alias("bucket_group_name"),
        fx.int_to_bool("asset_description__tradable").alias("is_tradable"),
        fx.int_to_bool("asset_description__commodity").alias("is_commodity"),
        fx.safe_cast("sell_listings", "bigint").alias("ask_count"),
        fx.safe_cast("sell_price", "bigint").alias("ask_price_cents"),
        fx.cents_to_usd("sell_price").alias("ask_price_usd"),
        fx.currency_text_to_usd("sale_price_text").alias("bid_price_usd"),
        fx.safe_cast("snapshot_timestamp", "date").alias("snapshot_date"),
        r("_dlt_id").cast("string").alias("_dlt_id"),
        r("_dlt_load_id").cast("string").alias("_dlt_load_id"),
    )


# After (load desc, ask_count desc) the content decides, and the row id last: of two records of
# one item in one load the same one is kept, whatever the order they arrive in.
STG_ITEMS_ORDER = ["_dlt_load_id", "ask_count", "ask_price_cents", "bid_price_usd", "class_id", "bucket_group_id",
                   "bucket_group_name", "item_type", "name_color", "is_tradable", "is_commodity", "_dlt_id"]


def stg_items(items_raw: DataFrame, row_ids: bool = True) -> DataFrame:
    """One row per (item_name, snapshot_date): newest load, then most asks, then a total order.

    With prices in whole cents, as declared, the dollars say nothing that the cents do not; they are worked out for
    the rows kept, so that narrower rows are sorted and moved. For the same reason `row_ids=False` leaves `_dlt_id` out,
    which is then last in the order: it chooses among rows that are alike in every other column.
    """
    rows = stg_items_projected(items_raw)
    whole_cents = isinstance(items_raw.schema["sell_price"].dataType, T.LongType)
    moved = rows.drop("ask_price_usd") if whole_cents else rows
    order = STG_ITEMS_ORDER
    if whole_cents and not row_ids:
        moved, order = moved.drop("_dlt_id"), [c for c in order if c != "_dlt_id"]
    kept = keep_first(by_width(moved), ["item_name", "snapshot_date"], order, tiebreak="rest")
    if whole_cents:
        kept = kept.withColumn("ask_price_usd", fx.cents_to_usd("ask_price_cents"))
    return kept.select(*[c for c in rows.columns if row_ids or c != "_dlt_id"])


def stg_item_price_history_projected(history_raw: DataFrame) -> DataFrame:
    r = F.col
    return history_raw.select(
        r("_dlt_id").cast("string").alias("_dlt_id"),
        r("_dlt_load_id").cast("string").alias("_dlt_load_id"),
        r("market_hash_name").cast("string").alias("item_name"),
        r("price").cast(MONEY).alias("median_sale_price_usd"),
        r("volume").cast("bigint").alias("units_sold"),
        r("date").cast("timestamp").alias("priced_at"),
    )


STG_HISTORY_ORDER = ["_dlt_load_id", "_dlt_id", "units_sold", "median_sale_price_usd"]


def stg_item_price_history(history_raw: DataFrame) -> DataFrame:
    """One row per (item_name, priced_at), newest load wins."""
    return keep_first(stg_item_price_history_projected(history_raw), ["item_name", "priced_at"],
                      STG_HISTORY_ORDER, tiebreak=None)


# --- intermediate -------------------------------------------------------------------

def daily_history_agg(stg_history: DataFrame) -> DataFrame:
    """Daily grain: units, units x median price, unweighted mean of median prices.

    Partial aggregation runs before the shuffle, so a hot item-day is combined
    map-side.
    """
    return (stg_history
            .groupBy(F.col("item_name"), fx.ts_to_date("priced_at").alias("price_date"))
            .agg(F.sum("units_sold").alias("units_sold"),
                 fx.money(F.sum(fx.money_product("units_sold", "median_sale_price_usd")))
                 .alias("total_estimated_trade_volume_usd"),
                 fx.money(F.avg(F.col("median_sale_price_usd"))).alias("avg_median_sale_price_usd")))


def int_item_price_history_daily(stg_history: DataFrame, since: _dt.date | None = None) -> DataFrame:
    """Daily aggregate of the price history.

    `since`: the warehouse's incremental bound (date(priced_at) >= since). The incremental writer bounds the
    raw history by months and keys instead (`bazaar.plans.incremental`; README, D1/D11).
    """
    h = stg_history
    if since is not None:
        h = h.where(fx.ts_to_date("priced_at") >= fx.as_date(since))
    return daily_history_agg(h)


# --- marts --------------------------------------------------------------------------

DIM_COLUMNS = ["item_name", "class_id", "bucket_group_id", "bucket_group_name", "item_type", "name_color",
               "is_tradable", "is_commodity", "snapshot_date"]


def dim_item(stg: DataFrame, since: _dt.date | None = None) -> DataFrame:
    """Type-1 dimension: the newest snapshot per item (deterministic on ties)."""
    s = stg.select(*DIM_COLUMNS)
    if since is not None:
        s = s.where(F.col("snapshot_date") >= fx.as_date(since))
    return keep_first(s, ["item_name"], ["snapshot_date"], tiebreak="rest")


def dim_item_upsert(current: DataFrame, stg: DataFrame, since: _dt.date | None) -> DataFrame:
    """Keyed upsert: old dimension rows plus new candidates, newest per item wins."""
    fresh = stg.select(*DIM_COLUMNS)
    if since is not None:
        fresh = fresh.where(F.col("snapshot_date") >= fx.as_date(since))
    return keep_first(current.select(*DIM_COLUMNS).unionByName(fresh), ["item_name"], ["snapshot_date"],
                      tiebreak="rest")


FCT_COLUMNS = ["item_name", "is_commodity", "item_type", "bucket_group_name", "ask_count", "ask_price_usd",
               "bid_price_usd", "units_sold", "total_estimated_trade_volume_usd", "avg_median_sale_price_usd",
               "bid_ask_spread_pct", "turnover_rate", "bid_ask_ratio", "market_date"]


#: What the fact holds, but for the KPIs, which follow from it.
FCT_BASE = ["item_name", "is_commodity", "item_type", "bucket_group_name", "ask_count", "ask_price_usd",
            "bid_price_usd", "units_sold", "total_estimated_trade_volume_usd", "avg_median_sale_price_usd", "market_date"]


def fct_market_daily(stg: DataFrame, daily: DataFrame, since: _dt.date | None = None) -> DataFrame:
    """Daily fact: snapshot LEFT JOIN daily history on (item, day) + three KPIs."""
    return fct_measured(fct_joined(stg, daily, since))


def fct_measured(rows: DataFrame) -> DataFrame:
    """The fact's rows with their three KPIs, each worked out from its own row: writers of the fact move the rows first."""
    return rows.select(
        *FCT_BASE[:-1],
        fx.bid_ask_spread("ask_price_usd", "bid_price_usd").alias("bid_ask_spread_pct"),
        fx.turnover_rate("units_sold", "ask_count").alias("turnover_rate"),
        fx.bid_ask_ratio("bid_price_usd", "ask_price_usd").alias("bid_ask_ratio"),
        "market_date",
    )


def fct_joined(stg: DataFrame, daily: DataFrame, since: _dt.date | None = None) -> DataFrame:
    """The fact ahead of its KPIs: snapshot LEFT JOIN daily history on (item, day), of the days from `since` on.

    Both sides are unique per key (dedup / group by), so the join never fans out.
    The left side comes out of the dedup window hash-partitioned by
    (item_name, snapshot_date) and the right side out of the aggregate by
    (item_name, price_date): a sort-merge join on those keys adds no exchange.
    NULL keys never match, as in SQL.
    """
    s = stg
    if since is not None:
        s = s.where(F.col("snapshot_date") >= fx.as_date(since))
        daily = daily.where(F.col("price_date") >= fx.as_date(since))  # earlier days would find no snapshot
    s = s.alias("s")
    h = daily.alias("h")
    j = s.join(h, (F.col("s.item_name") == F.col("h.item_name")) & (F.col("s.snapshot_date") == F.col("h.price_date")),
               "left")
    units = F.coalesce(F.col("h.units_sold"), F.lit(0)).cast("bigint")
    return j.select(
        F.col("s.item_name").alias("item_name"),
        F.col("s.is_commodity").alias("is_commodity"),
        F.col("s.item_type").alias("item_type"),
        F.col("s.bucket_group_name").alias("bucket_group_name"),
        F.col("s.ask_count").alias("ask_count"),
        F.col("s.ask_price_usd").alias("ask_price_usd"),
        F.col("s.bid_price_usd").alias("bid_price_usd"),
        units.alias("units_sold"),
        fx.money(F.coalesce(F.col("h.total_estimated_trade_volume_usd"), F.lit(0).cast(MONEY)))
        .alias("total_estimated_trade_volume_usd"),
        F.col("h.avg_median_sale_price_usd").alias("avg_median_sale_price_usd"),
        F.col("s.snapshot_date").alias("market_date"),
    )


# --- reports ------------------------------------------------------------------------

def _report_scope(fct: DataFrame, since: _dt.date | None, floor: _dt.date | None) -> DataFrame:
    f = fct
    if since is not None:   # incremental branch
        f = f.where((F.col("market_date") >= fx.as_date(since)) & (F.col("market_date") >= fx.as_date(EPOCH)))
    elif floor is not None:  # full refresh
        f = f.where(F.col("market_date") >= fx.as_date(floor))
    return f


def _market_aggs(turnover_name: str):
    return [
        fx.money(F.sum("total_estimated_trade_volume_usd")).alias("total_estimated_trade_volume_usd"),
        F.sum("ask_count").alias("total_active_supply"),
        F.sum("units_sold").alias("total_units_sold"),
        fx.safe_divide(F.sum("units_sold"), F.sum("ask_count")).alias(turnover_name),
        fx.money(F.avg(F.col("bid_ask_spread_pct"))).alias("avg_bid_ask_spread_pct"),
    ]


def rpt_market_metrics_daily(fct: DataFrame, since: _dt.date | None = None,
                             floor: _dt.date | None = REPORT_FLOOR) -> DataFrame:
    """Market-wide daily totals; turnover is a ratio of sums; avg skips NULL spreads."""
    return _report_scope(fct, since, floor).groupBy("market_date").agg(*_market_aggs("market_turnover_rate"))


def rpt_commodity_velocity_daily(fct: DataFrame, since: _dt.date | None = None,
                                 floor: _dt.date | None = REPORT_FLOOR) -> DataFrame:
    """Same per (is_commodity, day); a NULL commodity flag is its own group."""
    return (_report_scope(fct, since, floor).groupBy("is_commodity", "market_date")
            .agg(*_market_aggs("group_turnover_rate")))


RPT_LATEST_COLUMNS = ["item_name", "item_type", "bucket_group_name", "is_commodity", "ask_count", "ask_price_usd",
                      "bid_price_usd", "units_sold", "total_estimated_trade_volume_usd", "bid_ask_spread_pct",
                      "turnover_rate", "bid_ask_ratio", "market_date"]


def rpt_item_metrics_latest(fct: DataFrame, floor: _dt.date | None = REPORT_FLOOR) -> DataFrame:
    """Each item's rows on its latest market date (ties kept, NULL names dropped).

    Written as rank() = 1 instead of the self-join to max(date): one shuffle on
    item_name with a partial top-1 before it.
    """
    f = fct if floor is None else fct.where(F.col("market_date") >= fx.as_date(floor))
    f = f.where(F.col("item_name").isNotNull() & F.col("market_date").isNotNull())
    return keep_top_ties(f.select(*RPT_LATEST_COLUMNS), ["item_name"], ["market_date"])


def rpt_item_metrics_latest_selfjoin(fct: DataFrame, floor: _dt.date | None = REPORT_FLOOR) -> DataFrame:
    """Literal form: inner join to per-item max(market_date)."""
    f = fct if floor is None else fct.where(F.col("market_date") >= fx.as_date(floor))
    latest = f.groupBy("item_name").agg(F.max("market_date").alias("max_market_date")).alias("m")
    return (f.alias("f").join(latest, (F.col("f.item_name") == F.col("m.item_name"))
                              & (F.col("f.market_date") == F.col("m.max_market_date")), "inner")
            .select(*[F.col(f"f.{c}").alias(c) for c in RPT_LATEST_COLUMNS]))
