"""DuckDB SQL that states the expected result of every registered query.

The text mirrors the models model-by-model as CTEs over the pre-registered driver
tables. DuckDB typing differs from Spark's (decimal division and avg are DOUBLE,
`x/0` is inf, regexp_replace needs 'g'), so each NUMERIC value is cast back to
DECIMAL(38,9) at the same points as the Spark code, and every query ends with the
same presentation casts as `present()` on the Spark side: integers BIGINT, other
numbers rounded to 6 decimals as `floor(x * 1e6 + 0.5) / 1e6` in double arithmetic.
The engines' own round() functions disagree on exact half-way values, the IEEE
expression above gives bit-identical results in both.
"""

from __future__ import annotations

# ---- adapter: driver tables -> raw market tables ------------------------------------
RAW = {
    "items_raw": """
SELECT
  cast(l.l_quantity AS BIGINT) AS sell_listings,
  cast(round(l.l_extendedprice * 100) AS BIGINT) AS sell_price,
  concat('$', format('{:,.2f}', cast(cast(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE))) AS sell_price_text,
  concat('$', format('{:,.2f}', cast(cast(cast(l.l_extendedprice AS DECIMAL(18,2))
        * (cast(1 AS DECIMAL(4,2)) - cast(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DOUBLE))) AS sale_price_text,
  cast(l.l_shipdate AS TIMESTAMP) AS snapshot_timestamp,
  cast(l.l_suppkey AS VARCHAR) AS asset_description__classid,
  cast(NULL AS VARCHAR) AS asset_description__background_color,
  cast(l.l_linenumber % 2 AS BIGINT) AS asset_description__tradable,
  p.p_name AS asset_description__name_color,
  p.p_type AS asset_description__type,
  concat('ITEM-', cast(l.l_partkey AS VARCHAR)) AS asset_description__market_hash_name,
  cast(p.p_size % 2 AS BIGINT) AS asset_description__commodity,
  p.p_brand AS asset_description__market_bucket_group_name,
  p.p_brand AS asset_description__market_bucket_group_id,
  lpad(cast(l.l_orderkey AS VARCHAR), 12, '0') AS _dlt_load_id,
  concat_ws('-', lpad(cast(l.l_orderkey AS VARCHAR), 12, '0'), lpad(cast(l.l_linenumber AS VARCHAR), 4, '0'),
            lpad(cast(l.l_suppkey AS VARCHAR), 10, '0')) AS _dlt_id
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "item_price_history_raw": """
SELECT
  concat('ITEM-', cast(l_partkey AS VARCHAR)) AS market_hash_name,
  cast(l_shipdate AS TIMESTAMP) AS date,
  cast(l_extendedprice AS DECIMAL(38,9)) AS price,
  cast(l_quantity AS BIGINT) AS volume,
  lpad(cast(l_orderkey AS VARCHAR), 12, '0') AS _dlt_load_id,
  concat_ws('-', lpad(cast(l_orderkey AS VARCHAR), 12, '0'), lpad(cast(l_linenumber AS VARCHAR), 4, '0'),
            lpad(cast(l_suppkey AS VARCHAR), 10, '0')) AS _dlt_id
FROM lineitem WHERE l_returnflag <> 'N'""",
}

# ---- models ---------------------------------------------------------------------------
MODELS = {
    "stg_items_projected": """
SELECT
  cast(asset_description__market_hash_name AS VARCHAR) AS item_name,
  try_cast(asset_description__classid AS BIGINT) AS class_id,
  cast(asset_description__market_bucket_group_id AS VARCHAR) AS bucket_group_id,
  cast(asset_description__type AS VARCHAR) AS item_type,
  cast(asset_description__name_color AS VARCHAR) AS name_color,
  cast(asset_description__market_bucket_group_name AS VARCHAR) AS bucket_group_name,
  cast(asset_description__tradable AS BOOLEAN) AS is_tradable,
  cast(asset_description__commodity AS BOOLEAN) AS is_commodity,
  try_cast(sell_listings AS BIGINT) AS ask_count,
  try_cast(sell_price AS BIGINT) AS ask_price_cents,
  cast(try_cast(sell_price AS DECIMAL(29,9)) / 100 AS DECIMAL(38,9)) AS ask_price_usd,
  try_cast(regexp_replace(sale_price_text, '[^0-9.]', '', 'g') AS DECIMAL(38,9)) AS bid_price_usd,
  try_cast(snapshot_timestamp AS DATE) AS snapshot_date,
  cast(_dlt_id AS VARCHAR) AS _dlt_id,
  cast(_dlt_load_id AS VARCHAR) AS _dlt_load_id
FROM items_raw""",
    "stg_items": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY item_name, snapshot_date
    ORDER BY _dlt_load_id DESC NULLS LAST, ask_count DESC NULLS LAST, ask_price_cents DESC NULLS LAST,
             bid_price_usd DESC NULLS LAST, class_id DESC NULLS LAST, bucket_group_id DESC NULLS LAST,
             bucket_group_name DESC NULLS LAST, item_type DESC NULLS LAST, name_color DESC NULLS LAST,
             is_tradable DESC NULLS LAST, is_commodity DESC NULLS LAST, _dlt_id DESC NULLS LAST) AS rn
  FROM stg_items_projected) WHERE rn = 1""",
    "stg_item_price_history_projected": """
SELECT
  cast(_dlt_id AS VARCHAR) AS _dlt_id,
  cast(_dlt_load_id AS VARCHAR) AS _dlt_load_id,
  cast(market_hash_name AS VARCHAR) AS item_name,
  cast(price AS DECIMAL(38,9)) AS median_sale_price_usd,
  cast(volume AS BIGINT) AS units_sold,
  cast(date AS TIMESTAMP) AS priced_at
FROM item_price_history_raw""",
    "stg_item_price_history": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY item_name, priced_at
    ORDER BY _dlt_load_id DESC NULLS LAST, _dlt_id DESC NULLS LAST, units_sold DESC NULLS LAST,
             median_sale_price_usd DESC NULLS LAST) AS rn
  FROM stg_item_price_history_projected) WHERE rn = 1""",
    "int_item_price_history_daily": """
SELECT
  item_name,
  cast(priced_at AS DATE) AS price_date,
  cast(sum(units_sold) AS BIGINT) AS units_sold,
  cast(sum(cast(units_sold AS DECIMAL(13,0)) * cast(median_sale_price_usd AS DECIMAL(24,9))) AS DECIMAL(38,9))
    AS total_estimated_trade_volume_usd,
  cast(avg(median_sale_price_usd) AS DECIMAL(38,9)) AS avg_median_sale_price_usd
FROM stg_item_price_history
GROUP BY 1, 2""",
    "dim_item": """
SELECT * EXCLUDE (rn) FROM (
  SELECT item_name, class_id, bucket_group_id, bucket_group_name, item_type, name_color, is_tradable,
         is_commodity, snapshot_date,
         row_number() OVER (PARTITION BY item_name ORDER BY snapshot_date DESC NULLS LAST,
           class_id DESC NULLS LAST, bucket_group_id DESC NULLS LAST, bucket_group_name DESC NULLS LAST,
           item_type DESC NULLS LAST, name_color DESC NULLS LAST, is_tradable DESC NULLS LAST,
           is_commodity DESC NULLS LAST) AS rn
  FROM stg_items) WHERE rn = 1""",
    "fct_market_daily": """
SELECT
  s.item_name,
  s.is_commodity,
  s.item_type,
  s.bucket_group_name,
  s.ask_count,
  s.ask_price_usd,
  s.bid_price_usd,
  cast(coalesce(h.units_sold, 0) AS BIGINT) AS units_sold,
  cast(coalesce(h.total_estimated_trade_volume_usd, 0) AS DECIMAL(38,9)) AS total_estimated_trade_volume_usd,
  h.avg_median_sale_price_usd,
  cast((cast(s.ask_price_usd AS DECIMAL(24,9)) - cast(s.bid_price_usd AS DECIMAL(24,9)))
       / nullif(cast(s.bid_price_usd AS DECIMAL(24,9)), 0) AS DECIMAL(38,9)) AS bid_ask_spread_pct,
  cast(coalesce(h.units_sold, 0) AS BIGINT) / nullif(s.ask_count, 0) AS turnover_rate,
  cast(cast(s.bid_price_usd AS DECIMAL(24,9)) / nullif(cast(s.ask_price_usd AS DECIMAL(24,9)), 0)
       AS DECIMAL(38,9)) AS bid_ask_ratio,
  s.snapshot_date AS market_date
FROM stg_items s
LEFT JOIN int_item_price_history_daily h
  ON s.item_name = h.item_name AND s.snapshot_date = h.price_date""",
    "rpt_market_metrics_daily": """
SELECT
  market_date,
  cast(sum(total_estimated_trade_volume_usd) AS DECIMAL(38,9)) AS total_estimated_trade_volume_usd,
  cast(sum(ask_count) AS BIGINT) AS total_active_supply,
  cast(sum(units_sold) AS BIGINT) AS total_units_sold,
  cast(sum(units_sold) AS BIGINT) / nullif(cast(sum(ask_count) AS BIGINT), 0) AS market_turnover_rate,
  cast(avg(bid_ask_spread_pct) AS DECIMAL(38,9)) AS avg_bid_ask_spread_pct
FROM fct_market_daily
WHERE market_date >= DATE '2000-01-01'
GROUP BY 1""",
    "rpt_commodity_velocity_daily": """
SELECT
  is_commodity,
  market_date,
  cast(sum(total_estimated_trade_volume_usd) AS DECIMAL(38,9)) AS total_estimated_trade_volume_usd,
  cast(sum(ask_count) AS BIGINT) AS total_active_supply,
  cast(sum(units_sold) AS BIGINT) AS total_units_sold,
  cast(sum(units_sold) AS BIGINT) / nullif(cast(sum(ask_count) AS BIGINT), 0) AS group_turnover_rate,
  cast(avg(bid_ask_spread_pct) AS DECIMAL(38,9)) AS avg_bid_ask_spread_pct
FROM fct_market_daily
WHERE market_date >= DATE '2000-01-01'
GROUP BY 1, 2""",
    "rpt_item_metrics_latest": """
SELECT f.item_name, f.item_type, f.bucket_group_name, f.is_commodity, f.ask_count, f.ask_price_usd,
       f.bid_price_usd, f.units_sold, f.total_estimated_trade_volume_usd, f.bid_ask_spread_pct,
       f.turnover_rate, f.bid_ask_ratio, f.market_date
FROM (SELECT * FROM fct_market_daily WHERE market_date >= DATE '2000-01-01') f
JOIN (SELECT item_name, max(market_date) AS max_market_date FROM fct_market_daily
      WHERE market_date >= DATE '2000-01-01' GROUP BY 1) m
  ON f.item_name = m.item_name AND f.market_date = m.max_market_date""",
}

# dependency order of the CTEs above
_ORDER = ["items_raw", "item_price_history_raw", "stg_items_projected", "stg_items",
          "stg_item_price_history_projected", "stg_item_price_history", "int_item_price_history_daily",
          "dim_item", "fct_market_daily", "rpt_market_metrics_daily", "rpt_commodity_velocity_daily",
          "rpt_item_metrics_latest"]

_DEPS = {
    "items_raw": [], "item_price_history_raw": [],
    "stg_items_projected": ["items_raw"], "stg_items": ["stg_items_projected"],
    "stg_item_price_history_projected": ["item_price_history_raw"],
    "stg_item_price_history": ["stg_item_price_history_projected"],
    "int_item_price_history_daily": ["stg_item_price_history"],
    "dim_item": ["stg_items"],
    "fct_market_daily": ["stg_items", "int_item_price_history_daily"],
    "rpt_market_metrics_daily": ["fct_market_daily"],
    "rpt_commodity_velocity_daily": ["fct_market_daily"],
    "rpt_item_metrics_latest": ["fct_market_daily"],
}

CTE_SQL = {**RAW, **MODELS}


def _closure(names) -> list[str]:
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in need:
            continue
        need.add(n)
        stack.extend(_DEPS.get(n, []))
    return [n for n in _ORDER if n in need]


def with_models(final_sql: str, *uses: str, extra: dict[str, str] | None = None) -> str:
    """Prefix `final_sql` with the CTEs of the named models (and their inputs).

    `extra` adds more CTEs (name -> SQL) after the model CTEs, in the given order.
    """
    parts = [f"{n} AS ({CTE_SQL[n]}\n)" for n in _closure(uses)]
    for n, sql in (extra or {}).items():
        parts.append(f"{n} AS ({sql}\n)")
    if not parts:
        return final_sql
    return "WITH " + ",\n".join(parts) + "\n" + final_sql


def presented(cols_sql: dict[str, str], source: str) -> str:
    """SELECT with the presentation casts: kind 'i' BIGINT, 'n' rounded double, else as is."""
    sel = []
    for name, kind in cols_sql.items():
        if kind == "i":
            sel.append(f"cast({name} AS BIGINT) AS {name}")
        elif kind == "n":
            sel.append(f"{round6(name)} AS {name}")
        else:
            sel.append(name)
    return f"SELECT {', '.join(sel)} FROM {source}"


def round6(expr: str) -> str:
    """6-decimal rounding written the same way as `bazaar.plans.registry.round6`."""
    return f"floor(cast({expr} AS DOUBLE) * 1000000 + 0.5) / 1000000"


def normalize_rounding(sql: str) -> str:
    """Rewrite every `round(<expr>, 6)` of an oracle text into `round6(<expr>)`."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = normalize_rounding(sql[j + 6:k])
        head, sep, digits = inner.rpartition(",")
        if sep and digits.strip() == "6":
            out.append(sql[i:j] + round6(head.strip()))
        else:
            out.append(sql[i:j] + "round(" + inner + ")")
        i = k + 1
