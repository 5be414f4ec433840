"""Declared schemas of the raw, staging and reporting tables.

Money is stored as DECIMAL(38,9) (a warehouse NUMERIC). Arithmetic is done in
DECIMAL(24,9), 15 integer digits, so that Spark's precision rules leave products their
9 decimals and quotients at least 13; what does not fit goes through doubles (see
`bazaar.functions.scalar`).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 9)      # stored money / ratio type
WORK = T.DecimalType(24, 9)       # arithmetic type for money
WHOLE = T.DecimalType(13, 0)      # integer counts inside decimal products
CENTS = T.DecimalType(29, 9)      # cents before the division by 100; holds every BIGINT

# --- API result page (before flattening) --------------------------------------------
ASSET_DESCRIPTION = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("market_name", T.StringType()),
    T.StructField("appid", T.LongType()),
    T.StructField("icon_url", T.StringType()),
    T.StructField("classid", T.StringType()),
    T.StructField("background_color", T.StringType()),
    T.StructField("tradable", T.LongType()),
    T.StructField("name_color", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("market_hash_name", T.StringType()),
    T.StructField("commodity", T.LongType()),
    T.StructField("market_bucket_group_name", T.StringType()),
    T.StructField("market_bucket_group_id", T.StringType()),
])

LISTING_RESULT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("hash_name", T.StringType()),
    T.StructField("app_icon", T.StringType()),
    T.StructField("app_name", T.StringType()),
    T.StructField("sell_listings", T.LongType()),
    T.StructField("sell_price", T.LongType()),
    T.StructField("sell_price_text", T.StringType()),
    T.StructField("sale_price_text", T.StringType()),
    T.StructField("asset_description", ASSET_DESCRIPTION),
])

RESULTS_PAGE = T.StructType([
    T.StructField("total_count", T.LongType()),
    T.StructField("results", T.ArrayType(LISTING_RESULT)),
])

# Fetched listing page: one per item, body holds the embedded series.
HISTORY_PAGE = T.StructType([
    T.StructField("market_hash_name", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("body", T.StringType()),
])

# A page that yielded no rows.
PAGE_ERROR = T.StructType([
    T.StructField("market_hash_name", T.StringType()),
    T.StructField("reason", T.StringType()),
])

# --- raw tables ---------------------------------------------------------------------
ITEMS_RAW = T.StructType([
    T.StructField("sell_listings", T.LongType()),
    T.StructField("sell_price", T.LongType()),
    T.StructField("sell_price_text", T.StringType()),
    T.StructField("sale_price_text", T.StringType()),
    T.StructField("snapshot_timestamp", T.TimestampType()),
    T.StructField("asset_description__classid", T.StringType()),
    T.StructField("asset_description__background_color", T.StringType()),
    T.StructField("asset_description__tradable", T.LongType()),
    T.StructField("asset_description__name_color", T.StringType()),
    T.StructField("asset_description__type", T.StringType()),
    T.StructField("asset_description__market_hash_name", T.StringType()),
    T.StructField("asset_description__commodity", T.LongType()),
    T.StructField("asset_description__market_bucket_group_name", T.StringType()),
    T.StructField("asset_description__market_bucket_group_id", T.StringType()),
    T.StructField("_dlt_load_id", T.StringType()),
    T.StructField("_dlt_id", T.StringType()),
])

ITEM_PRICE_HISTORY_RAW = T.StructType([
    T.StructField("market_hash_name", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("price", MONEY),
    T.StructField("volume", T.LongType()),
    T.StructField("_dlt_load_id", T.StringType()),
    T.StructField("_dlt_id", T.StringType()),
])

# Typed record emitted by the series extractor.
PRICE_RECORD = T.StructType([
    T.StructField("market_hash_name", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("price", MONEY),
    T.StructField("volume", T.LongType()),
])

# Per-key high-water mark: a day (day grain) or an instant (hour grain).
ITEM_STATE = T.StructType([
    T.StructField("market_hash_name", T.StringType()),
    T.StructField("last_seen", T.DateType()),
])
ITEM_STATE_HOURLY = T.StructType([
    T.StructField("market_hash_name", T.StringType()),
    T.StructField("last_seen", T.TimestampType()),
])


def state_schema(grain: str = "day") -> T.StructType:
    return ITEM_STATE_HOURLY if grain == "hour" else ITEM_STATE


# --- report contracts (declared column types of the three reports) ------------------
RPT_COMMODITY_VELOCITY_DAILY = T.StructType([
    T.StructField("is_commodity", T.BooleanType()),
    T.StructField("market_date", T.DateType()),
    T.StructField("total_estimated_trade_volume_usd", MONEY),
    T.StructField("total_active_supply", T.LongType()),
    T.StructField("total_units_sold", T.LongType()),
    T.StructField("group_turnover_rate", T.DoubleType()),
    T.StructField("avg_bid_ask_spread_pct", MONEY),
])

RPT_ITEM_METRICS_LATEST = T.StructType([
    T.StructField("item_name", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("bucket_group_name", T.StringType()),
    T.StructField("is_commodity", T.BooleanType()),
    T.StructField("ask_count", T.LongType()),
    T.StructField("ask_price_usd", MONEY),
    T.StructField("bid_price_usd", MONEY),
    T.StructField("units_sold", T.LongType()),
    T.StructField("total_estimated_trade_volume_usd", MONEY),
    T.StructField("bid_ask_spread_pct", MONEY),
    T.StructField("turnover_rate", T.DoubleType()),
    T.StructField("bid_ask_ratio", MONEY),
    T.StructField("market_date", T.DateType()),
])

RPT_MARKET_METRICS_DAILY = T.StructType([
    T.StructField("market_date", T.DateType()),
    T.StructField("total_estimated_trade_volume_usd", MONEY),
    T.StructField("total_active_supply", T.LongType()),
    T.StructField("total_units_sold", T.LongType()),
    T.StructField("market_turnover_rate", T.DoubleType()),
    T.StructField("avg_bid_ask_spread_pct", MONEY),
])

REPORT_CONTRACTS = {
    "rpt_commodity_velocity_daily": RPT_COMMODITY_VELOCITY_DAILY,
    "rpt_item_metrics_latest": RPT_ITEM_METRICS_LATEST,
    "rpt_market_metrics_daily": RPT_MARKET_METRICS_DAILY,
}
