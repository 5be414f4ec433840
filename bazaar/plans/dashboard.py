"""The dashboard's five queries over the exported reports.

The latest-day parameter of the commodity views is not pulled to the driver: the
one-row top-1 result is joined back (a one-row broadcast, bounded by LIMIT 1), so
each query stays one plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions import scalar as fx
from bazaar.operators.reshape import unpivot

COMMODITY_LABELS = ("Commodities", "Non-Commodities")

# Display labels of the unpivoted measures, as the dashboard shows them.
COMMODITY_MEASURES = {
    "total_active_supply": "Total Active Supply",
    "total_units_sold": "Total Units Sold",
    "trade_volume_usd": "Trade Volume (USD)",
}
BUCKET_MEASURES = {
    "trade_volume_usd": "Trade Volume (USD)",
    "units_sold": "Total Units Sold",
    "avg_bid_ask_spread_pct": "Avg Bid Ask Spread",
    "avg_turnover_rate": "Avg Turnover Rate",
}


def q_current_market_metrics(rpt_market: DataFrame) -> DataFrame:
    """Latest day's KPI row, money as double, rates in percent (top-1, no full sort)."""
    return (rpt_market.orderBy(F.col("market_date").desc()).limit(1)
            .select("market_date",
                    fx.to_double("total_estimated_trade_volume_usd").alias("total_estimated_trade_volume_usd"),
                    "total_active_supply", "total_units_sold",
                    (F.col("market_turnover_rate") * 100).alias("market_turnover_rate"),
                    fx.scale_pct("avg_bid_ask_spread_pct").alias("avg_bid_ask_spread_pct")))


def latest_market_date(rpt_market: DataFrame) -> DataFrame:
    """One-row frame (market_date) chosen by the KPI query."""
    return q_current_market_metrics(rpt_market).select("market_date")


def _on_date(df: DataFrame, date_param: DataFrame | object) -> DataFrame:
    if isinstance(date_param, DataFrame):
        # a single row, and no more than that
        return df.join(F.broadcast(date_param.select(F.col("market_date")).limit(1)), "market_date", "left_semi")
    return df.where(F.col("market_date") == fx.as_date(date_param))


def q_commodity_metrics(rpt_commodity: DataFrame, date_param) -> DataFrame:
    return _on_date(rpt_commodity, date_param).select(
        "is_commodity", "market_date",
        fx.to_double("total_estimated_trade_volume_usd").alias("total_estimated_trade_volume_usd"),
        "total_active_supply", "total_units_sold", "group_turnover_rate",
        fx.to_double("avg_bid_ask_spread_pct").alias("avg_bid_ask_spread_pct"))


def q_commodity_breakdown(rpt_commodity: DataFrame, date_param) -> DataFrame:
    prepared = _on_date(rpt_commodity, date_param).select(
        fx.case_label("is_commodity", *COMMODITY_LABELS).alias("category"),
        fx.to_double("total_active_supply").alias("total_active_supply"),
        fx.to_double("total_units_sold").alias("total_units_sold"),
        fx.to_double("total_estimated_trade_volume_usd").alias("trade_volume_usd"))
    return unpivot(prepared, ["category"], COMMODITY_MEASURES)


def q_item_metrics(rpt_latest: DataFrame) -> DataFrame:
    d = fx.to_double
    return rpt_latest.select(
        "item_name", "item_type", "bucket_group_name", "ask_count",
        d("ask_price_usd").alias("ask_price_usd"), d("bid_price_usd").alias("bid_price_usd"), "units_sold",
        d("total_estimated_trade_volume_usd").alias("total_estimated_trade_volume_usd"),
        d("bid_ask_spread_pct").alias("bid_ask_spread_pct"), "turnover_rate",
        d("bid_ask_ratio").alias("bid_ask_ratio"), "is_commodity", "market_date")


def bucket_breakdown_wide(rpt_latest: DataFrame) -> DataFrame:
    """Per bucket group: 2 sums, 2 plain means (mean of per-item turnover rates)."""
    return rpt_latest.groupBy(F.col("bucket_group_name").alias("category")).agg(
        F.sum("total_estimated_trade_volume_usd").alias("trade_volume_usd"),
        F.sum("units_sold").alias("units_sold"),
        F.avg("bid_ask_spread_pct").alias("avg_bid_ask_spread_pct"),
        F.avg("turnover_rate").alias("avg_turnover_rate"))


def q_breakdown_by_bucket(rpt_latest: DataFrame) -> DataFrame:
    return unpivot(bucket_breakdown_wide(rpt_latest), ["category"], BUCKET_MEASURES)
