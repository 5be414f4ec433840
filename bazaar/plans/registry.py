"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder reads the driver tables under `sf_dir` through the fixture adapter,
so its work grows with the tables. Results pass through `present()`: integers as
BIGINT and every other number rounded to 6 decimals in plain double arithmetic,
the same casts the oracle SQL ends with (DuckDB and Spark type decimal arithmetic
differently, and their round() functions break exact ties differently).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.plans import dashboard as dash
from bazaar.plans import models as m
from bazaar.plans.oracle import normalize_rounding, presented, with_models
from bazaar.plans.partials import MEASURES
from bazaar.session import configure, materialize
from bazaar.sources import fixtures

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def round6(c):
    """floor(x * 1e6 + 0.5) / 1e6 on doubles (identical IEEE steps in both engines)."""
    return F.floor(c.cast("double") * F.lit(1000000.0) + F.lit(0.5)).cast("double") / F.lit(1000000.0)


def present(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            out.append(c.cast("bigint").alias(f.name))
        elif isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            out.append(round6(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def kinds(spec: str) -> dict[str, str]:
    """'a:i b:n c' -> {'a': 'i', 'b': 'n', 'c': ''}."""
    out = {}
    for tok in spec.split():
        name, _, kind = tok.partition(":")
        out[name] = kind
    return out


def register(name: str, oracle: str | None = None, queries: dict = QUERIES, oracles: dict = ORACLE):
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return present(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        queries[name] = run
        if oracle is not None:
            oracles[name] = normalize_rounding(oracle)
        return run
    return deco


# ---- shared lazy builders ----------------------------------------------------------

def stg_items(spark, d):
    return m.stg_items(fixtures.items_raw(spark, d))


def stg_history(spark, d):
    return m.stg_item_price_history(fixtures.item_price_history_raw(spark, d))


def daily(spark, d):
    return m.int_item_price_history_daily(stg_history(spark, d))


def listings(spark, d):
    """The staged listings without row ids: what the fact is made of."""
    return m.stg_items(fixtures.items_raw(spark, d), row_ids=False)


def fct(spark, d):
    return m.fct_market_daily(listings(spark, d), daily(spark, d))


def rpt_market(spark, d):
    return m.rpt_market_metrics_daily(fct(spark, d))


def rpt_commodity(spark, d):
    return m.rpt_commodity_velocity_daily(fct(spark, d))


def rpt_latest(spark, d):
    return m.rpt_item_metrics_latest(fct(spark, d))


# ---- column kinds of the models (for the oracle's presentation casts) --------------
K_STG_ITEMS = kinds("item_name class_id:i bucket_group_id item_type name_color bucket_group_name is_tradable "
                    "is_commodity ask_count:i ask_price_cents:i ask_price_usd:n bid_price_usd:n snapshot_date "
                    "_dlt_id _dlt_load_id")
K_STG_HISTORY = kinds("_dlt_id _dlt_load_id item_name median_sale_price_usd:n units_sold:i priced_at")
K_DAILY = kinds("item_name price_date units_sold:i total_estimated_trade_volume_usd:n avg_median_sale_price_usd:n")
K_DIM = kinds("item_name class_id:i bucket_group_id bucket_group_name item_type name_color is_tradable "
              "is_commodity snapshot_date")
K_FCT = kinds("item_name is_commodity item_type bucket_group_name ask_count:i ask_price_usd:n bid_price_usd:n "
              "units_sold:i total_estimated_trade_volume_usd:n avg_median_sale_price_usd:n bid_ask_spread_pct:n "
              "turnover_rate:n bid_ask_ratio:n market_date")
K_RPT_MARKET = kinds("market_date total_estimated_trade_volume_usd:n total_active_supply:i total_units_sold:i "
                     "market_turnover_rate:n avg_bid_ask_spread_pct:n")
K_RPT_COMMODITY = kinds("is_commodity market_date total_estimated_trade_volume_usd:n total_active_supply:i "
                        "total_units_sold:i group_turnover_rate:n avg_bid_ask_spread_pct:n")
K_RPT_LATEST = kinds("item_name item_type bucket_group_name is_commodity ask_count:i ask_price_usd:n "
                     "bid_price_usd:n units_sold:i total_estimated_trade_volume_usd:n bid_ask_spread_pct:n "
                     "turnover_rate:n bid_ask_ratio:n market_date")


def model_oracle(name: str, k: dict[str, str]) -> str:
    return with_models(presented(k, name), name)


# ---- §2.8 end-to-end models -------------------------------------------------------

@register("stg_items", model_oracle("stg_items", K_STG_ITEMS))
def q_stg_items(spark, d):
    """Staging listing snapshot: project + keyed dedup."""
    return stg_items(spark, d)


@register("stg_item_price_history", model_oracle("stg_item_price_history", K_STG_HISTORY))
def q_stg_item_price_history(spark, d):
    """Staging sale history: project + keyed dedup."""
    return stg_history(spark, d)


@register("int_item_price_history_daily", model_oracle("int_item_price_history_daily", K_DAILY))
def q_int_item_price_history_daily(spark, d):
    """Daily grain of the sale history."""
    return daily(spark, d)


@register("dim_item", model_oracle("dim_item", K_DIM))
def q_dim_item(spark, d):
    """Newest attributes per item."""
    return m.dim_item(stg_items(spark, d))


@register("fct_market_daily", model_oracle("fct_market_daily", K_FCT))
def q_fct_market_daily(spark, d):
    """Daily fact with bid-ask spread, turnover rate and bid-ask ratio."""
    return fct(spark, d)


@register("rpt_market_metrics_daily", model_oracle("rpt_market_metrics_daily", K_RPT_MARKET))
def q_rpt_market_metrics_daily(spark, d):
    """Market-wide daily report (the flagship query)."""
    return rpt_market(spark, d)


@register("rpt_commodity_velocity_daily", model_oracle("rpt_commodity_velocity_daily", K_RPT_COMMODITY))
def q_rpt_commodity_velocity_daily(spark, d):
    """Daily report per commodity flag."""
    return rpt_commodity(spark, d)


@register("rpt_item_metrics_latest", model_oracle("rpt_item_metrics_latest", K_RPT_LATEST))
def q_rpt_item_metrics_latest(spark, d):
    """Latest metrics per item."""
    return rpt_latest(spark, d)


# ---- §2.8 dashboard queries --------------------------------------------------------

# The expected results are stated over the fact, apart from the report models: each measure by itself, joined or
# stacked, on the newest day of the fact.
_NEWEST = "(SELECT max(market_date) FROM fct_market_daily WHERE market_date >= DATE '2000-01-01')"


def _by(keys: str) -> str:
    """Sums of the newest day of the fact by `keys`."""
    return f"""
SELECT {keys}, max(market_date) AS day, sum(total_estimated_trade_volume_usd)::DOUBLE AS volume,
       sum(ask_count)::BIGINT AS supply, sum(units_sold)::BIGINT AS units,
       avg(bid_ask_spread_pct)::DECIMAL(38,9)::DOUBLE AS spread
FROM fct_market_daily WHERE market_date = {_NEWEST} GROUP BY {keys}"""


_Q_CURRENT_SQL = """
SELECT day AS market_date, volume AS total_estimated_trade_volume_usd, supply AS total_active_supply,
       units AS total_units_sold, CASE WHEN supply <> 0 THEN 100 * (units / supply) END AS market_turnover_rate,
       100 * spread AS avg_bid_ask_spread_pct
FROM newest"""

K_Q_CURRENT = kinds("market_date total_estimated_trade_volume_usd:n total_active_supply:i total_units_sold:i "
                    "market_turnover_rate:n avg_bid_ask_spread_pct:n")


@register("q_current_market_metrics",
          with_models(presented(K_Q_CURRENT, "q"), "fct_market_daily",
                      extra={"newest": _by("market_date"), "q": _Q_CURRENT_SQL}))
def q_current_market_metrics(spark, d):
    """Dashboard KPI row of the latest day."""
    return dash.q_current_market_metrics(rpt_market(spark, d))


_Q_COMMODITY_SQL = """
SELECT is_commodity, day AS market_date, volume AS total_estimated_trade_volume_usd, supply AS total_active_supply,
       units AS total_units_sold, CASE WHEN supply <> 0 THEN units / supply END AS group_turnover_rate,
       spread AS avg_bid_ask_spread_pct
FROM newest"""

K_Q_COMMODITY = kinds("is_commodity market_date total_estimated_trade_volume_usd:n total_active_supply:i "
                      "total_units_sold:i group_turnover_rate:n avg_bid_ask_spread_pct:n")


def written_fct(spark, d):
    """The fact as the dashboard's reports find it: written once, read by all of them; the columns that they read."""
    return materialize(fct(spark, d).select("is_commodity", "market_date", *MEASURES), "dashboard-fct", "zstd")


@register("q_commodity_metrics", with_models(presented(K_Q_COMMODITY, "q"), "fct_market_daily",
                                             extra={"newest": _by("is_commodity"), "q": _Q_COMMODITY_SQL}))
def q_commodity_metrics(spark, d):
    """Commodity split of the latest day."""
    f = written_fct(spark, d)
    return dash.q_commodity_metrics(m.rpt_commodity_velocity_daily(f),
                                    dash.latest_market_date(m.rpt_market_metrics_daily(f)))


def stacked(source: str, keys: str, measures: dict[str, str]) -> str:
    """One branch per measure: SQL that lists (keys, label, number) wherever the number is known."""
    return "\nUNION ALL\n".join(
        f"SELECT {keys}, '{label}' AS metric_type, {x}::DOUBLE AS value FROM {source} WHERE {x} IS NOT NULL"
        for x, label in measures.items())


_LABEL = "if(coalesce(is_commodity, false), 'Commodities', 'Non-Commodities') AS category"
_GROUP_MEASURES = {"supply": "Total Active Supply", "units": "Total Units Sold", "volume": "Trade Volume (USD)"}


@register("q_commodity_breakdown",
          with_models(presented(kinds("category metric_type value:n"), "q"), "fct_market_daily",
                      extra={"newest": _by("is_commodity"), "q": stacked("newest", _LABEL, _GROUP_MEASURES)}))
def q_commodity_breakdown(spark, d):
    """Latest-day commodity composition, unpivoted to (category, metric_type, value)."""
    f = written_fct(spark, d)
    return dash.q_commodity_breakdown(m.rpt_commodity_velocity_daily(f),
                                      dash.latest_market_date(m.rpt_market_metrics_daily(f)))


# Each item's rows of its newest day, found by anti-join: no later row of the item exists.
_ITEM_NEWEST_SQL = """
SELECT * FROM fct_market_daily a
WHERE a.market_date >= DATE '2000-01-01' AND NOT EXISTS (
  SELECT 1 FROM fct_market_daily b WHERE b.item_name = a.item_name AND b.market_date > a.market_date)
  AND a.item_name IS NOT NULL"""

K_Q_ITEMS = kinds("item_name item_type bucket_group_name ask_count:i ask_price_usd:n bid_price_usd:n units_sold:i "
                  "total_estimated_trade_volume_usd:n bid_ask_spread_pct:n turnover_rate:n bid_ask_ratio:n "
                  "is_commodity market_date")


@register("q_item_metrics",
          with_models(presented(K_Q_ITEMS, "q"), "fct_market_daily", extra={"q": _ITEM_NEWEST_SQL}))
def q_item_metrics(spark, d):
    """Item explorer table."""
    return dash.q_item_metrics(rpt_latest(spark, d))


_BUCKET_SQL = """
SELECT bucket_group_name, sum(total_estimated_trade_volume_usd) AS volume, sum(units_sold) AS units,
       sum(bid_ask_spread_pct)::DOUBLE / nullif(count(bid_ask_spread_pct), 0) AS spread,
       sum(turnover_rate) / nullif(count(turnover_rate), 0) AS turnover
FROM items GROUP BY bucket_group_name"""
BUCKET_ORACLE = with_models(
    presented(kinds("category metric_type value:n"), "q"), "fct_market_daily",
    extra={"items": _ITEM_NEWEST_SQL, "buckets": _BUCKET_SQL,
           "q": stacked("buckets", "bucket_group_name AS category", {
               "volume": "Trade Volume (USD)", "units": "Total Units Sold", "spread": "Avg Bid Ask Spread",
               "turnover": "Avg Turnover Rate"})})


@register("q_breakdown_by_bucket", BUCKET_ORACLE)
def q_breakdown_by_bucket(spark, d):
    """Bucket-group breakdown, unpivoted."""
    return dash.q_breakdown_by_bucket(rpt_latest(spark, d))

from bazaar.plans import registry_ops as _ops  # noqa: E402,F401  (registers the per-operator queries)
