"""Per-operator queries of SURVEY §2.1-§2.7 and §2.9-§2.10 (thin slices, one key each).

Each reads the driver tables through the adapter (or frames Spark derives from
them: archived pages, written tables) and runs over the whole tables. Operators
that write (sinks, incremental materialisation, exports, the stream) write to a
fresh folder under the session's shared checkpoint folder and return the frame
read back.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from bazaar.functions import scalar as fx
from bazaar.operators import ingest as ig
from bazaar.operators import quality as qa
from bazaar.operators.reshape import share_of_total, unpivot
from bazaar.operators.search import apply_selection, current_selection, search_filter, search_pattern
from bazaar.plans import dashboard as dash
from bazaar.plans import incremental as inc
from bazaar.plans import models as m
from bazaar.plans.oracle import presented, with_models
from bazaar.plans.registry import (_GROUP_MEASURES, _LABEL, BUCKET_ORACLE, K_DAILY, K_DIM, K_FCT, K_RPT_COMMODITY, K_RPT_LATEST, K_RPT_MARKET,
                                   K_STG_HISTORY, daily, fct, kinds, listings, register, rpt_commodity, rpt_latest,
                                   rpt_market, stacked, stg_history, stg_items)
from bazaar import schemas
from bazaar.schemas import REPORT_CONTRACTS
from bazaar.session import materialize, scratch_path
from bazaar.sources import fixtures
from bazaar.sources.sinks import (export_parquet, guard_nonempty_export, layout, merge_parquet_shards,
                                  read_export, write_append, write_table)

RUN_TS = _dt.datetime(2026, 1, 1, 6, 0, 0)
LOAD_ID = "000000000001"
SPLIT_DAY = _dt.date(1998, 6, 1)      # first incremental batch starts here


def M(final: str, *uses: str, extra: dict | None = None) -> str:
    return with_models(final, *uses, extra=extra)


# ---- oracle CTEs shared by the page operators ------------------------------------------
PAGE_CTES = {
    "part_size": "SELECT concat('ITEM-', cast(p_partkey AS VARCHAR)) AS item_name, p_size FROM part",
    "hist_points": """
SELECT h.item_name AS market_hash_name, h.priced_at AS date,
       h.median_sale_price_usd AS price, h.units_sold AS volume, ps.p_size,
       cast(date_trunc('month', cast(h.priced_at AS DATE)) AS DATE) AS month,
       CASE ps.p_size WHEN 47 THEN 500 WHEN 48 THEN 403 WHEN 49 THEN 429 WHEN 50 THEN 404 ELSE 200 END AS status
FROM stg_item_price_history h LEFT JOIN part_size ps ON h.item_name = ps.item_name""",
    "hist_pages": """
SELECT market_hash_name, month, any_value(p_size) AS p_size, any_value(status) AS status, count(*) AS n_points
FROM hist_points GROUP BY 1, 2""",
    "good_points": """
SELECT market_hash_name, date, price, volume FROM hist_points
WHERE status = 200 AND (p_size IS NULL OR p_size NOT IN (45, 46))""",
    "prev_state": """
SELECT item_name AS market_hash_name, max(cast(priced_at AS DATE)) AS last_seen
FROM stg_item_price_history WHERE priced_at < TIMESTAMP '1998-01-01 00:00:00' GROUP BY 1""",
    "new_points": """
SELECT g.* FROM good_points g LEFT JOIN prev_state s ON g.market_hash_name = s.market_hash_name
WHERE g.date > cast(coalesce(s.last_seen, DATE '1970-01-01') AS TIMESTAMP)""",
}
K_POINT = kinds("market_hash_name date price:n volume:i")

# The archived page of an item and month, written out: points by date, then the damage of two part sizes.
PAGE_CTES["hist_bodies"] = """
SELECT market_hash_name, month, status, CASE p_size
    WHEN 46 THEN 'var line1=[{' || substr(pts, 2) || '];'
    WHEN 45 THEN 'var line1=[' || pts || ',["not a date","1","1"]];'
    ELSE 'var line1=[' || pts || '];' END AS body
FROM (SELECT market_hash_name, month, any_value(status) AS status, any_value(p_size) AS p_size,
             string_agg('["' || strftime(date, '%b %d %Y') || ' 01: +0","' || cast(price AS VARCHAR) || '","'
                        || cast(volume AS VARCHAR) || '"]', ',' ORDER BY date) AS pts
      FROM hist_points GROUP BY 1, 2)"""


def P(final: str, *ctes: str, uses: tuple = ()) -> str:
    """Oracle over the page CTEs (which sit on the staged history)."""
    order = list(PAGE_CTES)
    need = set(ctes)
    deps = {"hist_points": ["part_size"], "hist_pages": ["hist_points"], "good_points": ["hist_points"],
            "hist_bodies": ["hist_points"],
            "new_points": ["good_points", "prev_state"]}
    stack = list(ctes)
    while stack:
        n = stack.pop()
        for d in deps.get(n, []):
            if d not in need:
                need.add(d)
                stack.append(d)
    return M(final, "stg_item_price_history", *uses, extra={k: PAGE_CTES[k] for k in order if k in need})


def _pages(spark, d):
    return fixtures.history_pages(spark, d).drop("month").unionByName(
        fixtures.web_pages(spark, d).drop("month"))


def _fresh(spark: SparkSession, name: str, writer) -> str:
    """A folder of its own under the shared checkpoint folder, written now."""
    path = scratch_path(spark, name)
    writer(path)
    return path


K_ITEMS_RAW = kinds("sell_listings:i sell_price:i sell_price_text sale_price_text snapshot_timestamp "
                    "asset_description__classid asset_description__background_color asset_description__tradable:i "
                    "asset_description__name_color asset_description__type asset_description__market_hash_name "
                    "asset_description__commodity:i asset_description__market_bucket_group_name "
                    "asset_description__market_bucket_group_id _dlt_load_id _dlt_id")
RECORD_COLS = [c for c in K_ITEMS_RAW if c not in ("snapshot_timestamp", "_dlt_load_id", "_dlt_id")]


def _records(spark, d):
    return ig.parse_results_pages(fixtures.listing_pages(spark, d))


# =====================================================================================
# §2.1 scans, sources, sinks, materialisations
# =====================================================================================

@register("scan_items_pages", M(
    "SELECT asset_description__market_hash_name AS market_hash_name, sell_listings, sell_price, sell_price_text, "
    "sale_price_text FROM items_raw", "items_raw"))
def q_scan_items_pages(spark, d):
    """API result pages (JSON) -> one row per listing record."""
    r = _records(spark, d)
    return r.select(F.col("asset_description.market_hash_name").alias("market_hash_name"), "sell_listings",
                    "sell_price", "sell_price_text", "sale_price_text")


_ALL_BODIES = """
SELECT market_hash_name, cast(status AS BIGINT) AS status, body FROM hist_bodies UNION ALL
SELECT concat('PAGE-', cast(page_id AS VARCHAR)), cast(200 AS BIGINT), html FROM pages"""


@register("scan_history_pages", P(_ALL_BODIES, "hist_bodies"))
def q_scan_history_pages(spark, d):
    """Fetched listing pages (key, status, body) from the archive."""
    return _pages(spark, d).select("market_hash_name", "status", "body")


@register("source_raw_tables", M(presented(K_ITEMS_RAW, "items_raw"), "items_raw"))
def q_source_raw_tables(spark, d):
    """Declared source read: explicit schema, fails on a missing column."""
    path = _fresh(spark, "items_raw_src", lambda p: fixtures.items_raw(spark, d).write.parquet(p))
    from bazaar.sources.raw import read_items_raw
    return read_items_raw(spark, path)


@register("sink_append", M(presented(K_ITEMS_RAW, "items_raw"), "items_raw"))
def q_sink_append(spark, d):
    """Append-only load in two batches, read back whole (no dedup)."""
    def write(p):
        raw = fixtures.items_raw(spark, d).withColumn("snapshot_month", F.trunc(F.to_date("snapshot_timestamp"), "MM"))
        before = F.col("snapshot_timestamp") < F.lit(str(SPLIT_DAY)).cast("timestamp")
        write_append(layout(raw.where(before), ["snapshot_month"]), p, ["snapshot_month"])
        write_append(layout(raw.where(~before), ["snapshot_month"]), p, ["snapshot_month"])
    path = _fresh(spark, "sink_append", write)
    return spark.read.parquet(path).drop("snapshot_month")


@register("sink_partition_cluster", M(presented(K_FCT, "fct_market_daily"), "fct_market_daily"))
def q_sink_partition_cluster(spark, d):
    """Fact written partitioned by day and clustered by item; a bounded read prunes partitions."""
    path = _fct_table(spark, d)
    return inc.read_guarded(spark, path, "market_date", lower=inc.EPOCH).select(*m.FCT_COLUMNS)


def _fct_table(spark, d):
    return _fresh(spark, "fct_market_daily", lambda p: write_table(
        m.fct_joined(listings(spark, d), daily(spark, d)), p, ["market_date"], ["item_name"], mode="overwrite",
        dynamic=False, finish=m.fct_measured, staged="fct-rows"))


@register("mat_view", M(presented(K_STG_HISTORY, "stg_item_price_history"), "stg_item_price_history"))
def q_mat_view(spark, d):
    """A staging model as a view: recomputed on read."""
    stg_history(spark, d).createOrReplaceTempView("stg_item_price_history_v")
    return spark.sql("SELECT * FROM stg_item_price_history_v")


@register("mat_ephemeral", M(presented(K_DAILY, "int_item_price_history_daily"), "int_item_price_history_daily"))
def q_mat_ephemeral(spark, d):
    """An ephemeral model: inlined into its consumer as a CTE, nothing stored."""
    stg_history(spark, d).createOrReplaceTempView("stg_item_price_history_e")
    return spark.sql("""
        WITH int_item_price_history_daily AS (
          SELECT item_name, to_date(priced_at) AS price_date, sum(units_sold) AS units_sold,
                 cast(sum(cast(units_sold AS decimal(13,0)) * cast(median_sale_price_usd AS decimal(24,9)))
                      AS decimal(38,9)) AS total_estimated_trade_volume_usd,
                 cast(avg(median_sale_price_usd) AS decimal(38,9)) AS avg_median_sale_price_usd
          FROM stg_item_price_history_e GROUP BY 1, 2)
        SELECT * FROM int_item_price_history_daily""")


@register("mat_table", M(presented(K_RPT_LATEST, "rpt_item_metrics_latest"), "rpt_item_metrics_latest"))
def q_mat_table(spark, d):
    """Full rebuild of a table (overwrite), clustered by item, type and bucket."""
    path = _fresh(spark, "rpt_item_metrics_latest", lambda p: write_table(
        rpt_latest(spark, d), p, cluster_by=["item_name", "item_type", "bucket_group_name"], dynamic=False))
    return spark.read.parquet(path)


@register("mat_incremental_overwrite", M(presented(K_DAILY, "int_item_price_history_daily"),
                                         "int_item_price_history_daily"))
def q_mat_incremental_overwrite(spark, d):
    """Month-partitioned daily history built in two loads; the second recomputes the days it
    touches and merges them into their months. The result equals a full refresh."""
    def write(p):
        hist_raw = fixtures.item_price_history_raw(spark, d)
        cut = F.col("date") < F.lit(str(SPLIT_DAY)).cast("timestamp")
        inc.materialize_monthly(spark, p, hist_raw.where(cut), None)
        new = m.stg_item_price_history_projected(hist_raw.where(~cut))
        inc.materialize_monthly(spark, p, hist_raw, new)
    path = _fresh(spark, "int_incremental", write)
    return spark.read.parquet(path).drop("price_month")


@register("export_parquet", M(presented(K_RPT_MARKET, "rpt_market_metrics_daily"), "rpt_market_metrics_daily"))
def q_export_parquet(spark, d):
    """Report exported as Parquet (overwrite), read back."""
    root = _fresh(spark, "exports", lambda p: export_parquet(rpt_market(spark, d), p, "rpt_market_metrics_daily"))
    return read_export(spark, f"{root}/rpt_market_metrics_daily")


@register("merge_parquet_shards", M(presented(K_RPT_COMMODITY, "rpt_commodity_velocity_daily"),
                                    "rpt_commodity_velocity_daily"))
def q_merge_parquet_shards(spark, d):
    """Shards of one export merged into a single Parquet file."""
    def write(p):
        export_parquet(rpt_commodity(spark, d).repartition(4), p, "rpt_commodity_velocity_daily")
        merge_parquet_shards(spark, f"{p}/rpt_commodity_velocity_daily", f"{p}/merged")
    root = _fresh(spark, "merge", write)
    return spark.read.parquet(f"{root}/merged")


@register("guard_empty_export", M(presented(K_RPT_LATEST, "rpt_item_metrics_latest"), "rpt_item_metrics_latest"))
def q_guard_empty_export(spark, d):
    """An export is read only when shards exist (an empty folder raises)."""
    root = _fresh(spark, "exports_latest", lambda p: export_parquet(rpt_latest(spark, d), p,
                                                                      "rpt_item_metrics_latest"))
    guard_nonempty_export(spark, f"{root}/rpt_item_metrics_latest")
    return read_export(spark, f"{root}/rpt_item_metrics_latest")


@register("require_partition_filter", M(
    presented(K_FCT, "fct_market_daily") + " WHERE market_date >= DATE '1999-01-01'", "fct_market_daily"))
def q_require_partition_filter(spark, d):
    """Fact read through the guard: a lower bound is mandatory and prunes partitions."""
    return inc.read_guarded(spark, _fct_table(spark, d), "market_date", lower=_dt.date(1999, 1, 1)).select(
        *m.FCT_COLUMNS)


_PLACED = """
SELECT *, cast(_dlt_load_id AS BIGINT) + 1 AS page_no, row_number() OVER (PARTITION BY _dlt_load_id ORDER BY
    _dlt_id, asset_description__market_hash_name, sell_listings, sell_price, sell_price_text, sale_price_text,
    asset_description__classid, asset_description__tradable, asset_description__name_color,
    asset_description__type, asset_description__commodity, asset_description__market_bucket_group_name) - 1 AS pos
FROM items_raw"""
_PLACE_ID = "sha256(concat_ws(chr(1), '000000000001', cast(page_no AS VARCHAR), cast(pos AS VARCHAR)))"
_DEV_SQL = f"""
SELECT * EXCLUDE (page_no, pos) REPLACE (TIMESTAMP '2026-01-01 06:00:00' AS snapshot_timestamp,
                                         '000000000001' AS _dlt_load_id, {_PLACE_ID} AS _dlt_id)
FROM placed WHERE page_no <= 10"""


@register("limit_pages_dev", M(_DEV_SQL, "items_raw", extra={"placed": _PLACED}))
def q_limit_pages_dev(spark, d):
    """Non-prod run: only the listing pages numbered 1 to 10 are read and loaded."""
    from bazaar.plans.pipeline import load_items
    return load_items(fixtures.listing_pages(spark, d), RUN_TS, LOAD_ID, dev_page_limit=10)


@register("fan_out_two_sinks", P("""
SELECT 'items_raw' AS sink, asset_description__market_hash_name AS market_hash_name,
       count(*) AS rows_written, sum(sell_price)::DOUBLE AS amount FROM items_raw GROUP BY 2 UNION ALL
SELECT 'item_price_history_raw', market_hash_name, count(*), sum(price)::DOUBLE FROM good_points GROUP BY 2""",
    "good_points", uses=("items_raw",)))
def q_fan_out_two_sinks(spark, d):
    """One ingest run writes the item table and the price history; both are read back."""
    from bazaar.plans.pipeline import Warehouse, run_ingest
    wh = Warehouse(scratch_path(spark, "fan-out"))
    run_ingest(spark, wh, fixtures.listing_pages(spark, d), fixtures.history_pages(spark, d).drop("month"), RUN_TS,
               LOAD_ID, max_failed_pages=None)
    items = inc.read_loads(spark, wh.path("items_raw"), schemas.ITEMS_RAW).select(
        F.lit("items_raw").alias("sink"), F.col("asset_description__market_hash_name").alias("market_hash_name"),
        F.col("sell_price").cast(schemas.MONEY).alias("x"))
    points = inc.read_loads(spark, wh.path("item_price_history_raw"), schemas.ITEM_PRICE_HISTORY_RAW).select(
        F.lit("item_price_history_raw").alias("sink"), "market_hash_name", F.col("price").alias("x"))
    return items.unionByName(points).groupBy("sink", "market_hash_name").agg(
        F.count(F.lit(1)).alias("rows_written"), F.sum("x").cast("double").alias("amount"))


# =====================================================================================
# §2.2 record-level ingest transforms
# =====================================================================================

@register("stamp_snapshot", M(
    "SELECT asset_description__market_hash_name AS market_hash_name, "
    "TIMESTAMP '2026-01-01 06:00:00' AS snapshot_timestamp FROM items_raw", "items_raw"))
def q_stamp_snapshot(spark, d):
    """One batch-wide run timestamp on every record."""
    r = ig.stamp_snapshot(_records(spark, d), RUN_TS)
    return r.select(F.col("asset_description.market_hash_name").alias("market_hash_name"), "snapshot_timestamp")


@register("prune_redundant", M(presented({c: K_ITEMS_RAW[c] for c in RECORD_COLS}, "items_raw"), "items_raw"))
def q_prune_redundant(spark, d):
    """Duplicated and constant fields dropped, nested ones included, then flattened."""
    return ig.flatten_struct(ig.prune_redundant(_records(spark, d)))


_FLAT_FULL = ("SELECT asset_description__market_hash_name AS name, asset_description__market_hash_name AS hash_name, "
              "'icon' AS app_icon, 'Market' AS app_name, sell_listings, sell_price, sell_price_text, sale_price_text, "
              "asset_description__market_hash_name AS asset_description__name, "
              "asset_description__market_hash_name AS asset_description__market_name, "
              "cast(1 AS BIGINT) AS asset_description__appid, 'icon' AS asset_description__icon_url, "
              "asset_description__classid, asset_description__background_color, asset_description__tradable, "
              "asset_description__name_color, asset_description__type, asset_description__market_hash_name, "
              "asset_description__commodity, asset_description__market_bucket_group_name, "
              "asset_description__market_bucket_group_id FROM items_raw")


@register("flatten_struct", M(_FLAT_FULL, "items_raw"))
def q_flatten_struct(spark, d):
    """Nested record -> parent__child columns (before pruning)."""
    return ig.flatten_struct(_records(spark, d))


@register("load_metadata", M(
    f"SELECT asset_description__market_hash_name AS market_hash_name, '000000000001' AS _dlt_load_id, "
    f"{_PLACE_ID} AS _dlt_id FROM placed", "items_raw", extra={"placed": _PLACED}))
def q_load_metadata(spark, d):
    """Batch load id and a row id that no other record of the load has."""
    recs = ig.parse_results_pages(fixtures.listing_pages(spark, d), place=("__page", "__pos"))
    out = ig.add_load_metadata(ig.flatten_struct(ig.prune_redundant(recs)), LOAD_ID, ["__page", "__pos"])
    return out.select(F.col("asset_description__market_hash_name").alias("market_hash_name"), "_dlt_load_id",
                      "_dlt_id")


@register("guard_missing_key", M(
    "SELECT asset_description__market_hash_name AS market_hash_name FROM items_raw "
    "WHERE coalesce(asset_description__market_hash_name, '') <> ''", "items_raw"))
def q_guard_missing_key(spark, d):
    """Records without a key yield nothing."""
    flat = ig.flatten_struct(_records(spark, d))
    return ig.guard_missing_key(flat, "asset_description__market_hash_name").select(
        F.col("asset_description__market_hash_name").alias("market_hash_name"))


@register("page_outcome", P("""
SELECT outcome, severity, count(*) AS pages FROM (
  SELECT CASE status WHEN 200 THEN 'ok' WHEN 429 THEN 'rate_limited' WHEN 403 THEN 'forbidden'
                     WHEN 404 THEN 'not_found' ELSE 'failed' END AS outcome,
         CASE WHEN status = 200 THEN 'info' WHEN status = 404 THEN 'warning' ELSE 'error' END AS severity
  FROM (SELECT status FROM hist_pages UNION ALL SELECT 200 FROM pages)) GROUP BY 1, 2""", "hist_pages"))
def q_page_outcome(spark, d):
    """Fetch outcome per page (200 / 429 / 403 / 404 / other), counted."""
    return ig.outcome_counts(ig.extract_price_history(_pages(spark, d)).outcomes)


@register("extract_series_text", P(
    "SELECT market_hash_name, nullif(regexp_extract(body, 'var line1=([^;]+);', 1), '') AS series "
    f"FROM ({_ALL_BODIES})", "hist_bodies"))
def q_extract_series_text(spark, d):
    """First match of the embedded series variable, or NULL."""
    return _pages(spark, d).select("market_hash_name", ig.extract_series_text("body").alias("series"))


@register("parse_series_json", P("""
SELECT market_hash_name, CASE WHEN p_size = 46 THEN NULL WHEN p_size = 45 THEN n_points + 1 ELSE n_points END
  AS n_points FROM hist_pages""", "hist_pages"))
def q_parse_series_json(spark, d):
    """Series text -> array of points; text that is not JSON gives NULL."""
    pts = fixtures.history_pages(spark, d).select(
        "market_hash_name", ig.parse_series_json(ig.extract_series_text("body")).alias("p"))
    return pts.select("market_hash_name", F.when(F.col("p").isNull(), F.lit(None)).otherwise(F.size("p"))
                      .cast("bigint").alias("n_points"))


def _all_points(spark, d):
    pages = fixtures.history_pages(spark, d)
    pts = ig.explode_once(pages.select("market_hash_name", ig.parse_series_json(ig.extract_series_text("body"))
                                       .alias("pts")), "pts", "p")
    return pts.select("market_hash_name",
                      ig.parse_point_date(F.get("p", 0)).alias("date"),
                      ig.parse_point_price(F.get("p", 1)).alias("price"),
                      ig.parse_point_volume(F.get("p", 2)).alias("volume"))


_ALL_POINTS_SQL = """
SELECT market_hash_name, date, price, volume FROM hist_points WHERE p_size IS NULL OR p_size <> 46
UNION ALL
SELECT market_hash_name, NULL, cast(1 AS DECIMAL(38,9)), 1 FROM hist_pages WHERE p_size = 45"""


@register("explode_series", P(presented(K_POINT, f"({_ALL_POINTS_SQL})"), "hist_points", "hist_pages"))
def q_explode_series(spark, d):
    """Every point of every parseable page as a row (flat-map)."""
    return _all_points(spark, d)


@register("parse_point_date", P(f"SELECT market_hash_name, date FROM ({_ALL_POINTS_SQL})", "hist_points",
                                "hist_pages"))
def q_parse_point_date(spark, d):
    """Day of the point's date text ('Nov 05 2024 ...'); NULL when it does not parse."""
    return _all_points(spark, d).select("market_hash_name", "date")


@register("parse_point_numbers", P(presented(kinds("market_hash_name price:n volume:i"),
                                             f"({_ALL_POINTS_SQL})"), "hist_points", "hist_pages"))
def q_parse_point_numbers(spark, d):
    """Price and volume of each point (text -> DECIMAL / BIGINT)."""
    return _all_points(spark, d).select("market_hash_name", "price", "volume")


@register("item_error_isolation", P("""
SELECT market_hash_name, CASE WHEN p_size = 46 THEN 'bad_json' ELSE 'bad_point' END AS reason
FROM hist_pages WHERE status = 200 AND p_size IN (45, 46)""", "hist_pages"))
def q_item_error_isolation(spark, d):
    """Pages with bad JSON or a bad reached point: one error row each, no records."""
    return ig.extract_price_history(_pages(spark, d), fixtures.history_state(spark, d)).errors


@register("hwm_filter", P(presented(K_POINT, "new_points"), "new_points"))
def q_hwm_filter(spark, d):
    """Per-item mark: only points strictly after the last seen day (filter form)."""
    ex = ig.extract_price_history(_pages(spark, d), fixtures.history_state(spark, d), mode="filter")
    return ex.records


@register("tail_take_while", P(presented(K_POINT, "new_points"), "new_points"))
def q_tail_take_while(spark, d):
    """Per-item mark: scan from the newest point, stop at the first seen one."""
    ex = ig.extract_price_history(_pages(spark, d), fixtures.history_state(spark, d), mode="take_while")
    return ex.records


@register("hwm_advance", P("""
SELECT market_hash_name, max(last_seen) AS last_seen FROM (
  SELECT market_hash_name, last_seen FROM prev_state
  UNION ALL SELECT market_hash_name, max(cast(date AS DATE)) FROM new_points GROUP BY 1) GROUP BY 1""",
                           "new_points", "prev_state"))
def q_hwm_advance(spark, d):
    """New mark per item = max emitted day, merged with the previous state."""
    state = fixtures.history_state(spark, d)
    ex = ig.extract_price_history(_pages(spark, d), state)
    return ig.advance_state(state, ex.records)


@register("typed_projection", P(presented(K_POINT, "good_points"), "good_points"))
def q_typed_projection(spark, d):
    """Typed price records (market_hash_name, date, price, volume) of a first load."""
    return ig.extract_price_history(_pages(spark, d)).records


# =====================================================================================
# §2.3 projections, casts, scalar functions
# =====================================================================================

K_STG_PROJ = kinds("item_name class_id:i bucket_group_id item_type name_color bucket_group_name is_tradable "
                   "is_commodity ask_count:i ask_price_cents:i ask_price_usd:n bid_price_usd:n snapshot_date "
                   "_dlt_id _dlt_load_id")


@register("stg_items_project", M(presented(K_STG_PROJ, "stg_items_projected"), "stg_items_projected"))
def q_stg_items_project(spark, d):
    """Rename + cast of the raw snapshot (before dedup)."""
    return m.stg_items_projected(fixtures.items_raw(spark, d))


@register("stg_history_project", M(presented(K_STG_HISTORY, "stg_item_price_history_projected"),
                                   "stg_item_price_history_projected"))
def q_stg_history_project(spark, d):
    """Rename + cast of the raw history (before dedup)."""
    return m.stg_item_price_history_projected(fixtures.item_price_history_raw(spark, d))


@register("fn_cast", M("""
SELECT cast(_dlt_id AS VARCHAR) AS row_id, cast(sell_listings AS BIGINT) AS asks,
       cast(asset_description__tradable AS BOOLEAN) AS tradable, cast(snapshot_timestamp AS TIMESTAMP) AS ts,
       round(cast(cast(sell_price AS DECIMAL(38,9)) AS DOUBLE), 6) AS price_numeric FROM items_raw""", "items_raw"))
def q_fn_cast(spark, d):
    """Strict casts (a bad value fails the query)."""
    r = fixtures.items_raw(spark, d)
    return r.select(fx.strict_cast("_dlt_id", "string").alias("row_id"),
                    fx.strict_cast("sell_listings", "bigint").alias("asks"),
                    fx.strict_cast("asset_description__tradable", "boolean").alias("tradable"),
                    fx.strict_cast("snapshot_timestamp", "timestamp").alias("ts"),
                    fx.strict_cast("sell_price", "decimal(38,9)").alias("price_numeric"))


@register("fn_safe_cast", M("""
SELECT try_cast(asset_description__classid AS BIGINT) AS class_id,
       try_cast(asset_description__name_color AS BIGINT) AS color_as_int,
       round(try_cast(sale_price_text AS DECIMAL(38,9)), 6) AS text_as_numeric,
       try_cast(snapshot_timestamp AS DATE) AS snapshot_date FROM items_raw""", "items_raw"))
def q_fn_safe_cast(spark, d):
    """Safe casts: NULL instead of an error."""
    r = fixtures.items_raw(spark, d)
    return r.select(fx.safe_cast("asset_description__classid", "bigint").alias("class_id"),
                    fx.safe_cast("asset_description__name_color", "bigint").alias("color_as_int"),
                    fx.safe_cast("sale_price_text", "decimal(38,9)").alias("text_as_numeric"),
                    fx.safe_cast("snapshot_timestamp", "date").alias("snapshot_date"))


@register("fn_int_to_bool", M(
    "SELECT asset_description__tradable AS tradable, asset_description__commodity AS commodity, "
    "cast(asset_description__tradable AS BOOLEAN) AS is_tradable, "
    "cast(asset_description__commodity AS BOOLEAN) AS is_commodity FROM items_raw", "items_raw"))
def q_fn_int_to_bool(spark, d):
    r = fixtures.items_raw(spark, d)
    return r.select(F.col("asset_description__tradable").alias("tradable"),
                    F.col("asset_description__commodity").alias("commodity"),
                    fx.int_to_bool("asset_description__tradable").alias("is_tradable"),
                    fx.int_to_bool("asset_description__commodity").alias("is_commodity"))


@register("fn_cents_to_usd", M(
    "SELECT sell_price, round(cast(cast(try_cast(sell_price AS DECIMAL(18,9)) / 100 AS DECIMAL(38,9)) AS DOUBLE), 6)"
    " AS ask_price_usd FROM items_raw", "items_raw"))
def q_fn_cents_to_usd(spark, d):
    r = fixtures.items_raw(spark, d)
    return r.select("sell_price", fx.cents_to_usd("sell_price").alias("ask_price_usd"))


@register("fn_currency_text", M(
    "SELECT sale_price_text, round(cast(try_cast(regexp_replace(sale_price_text, '[^0-9.]', '', 'g') "
    "AS DECIMAL(38,9)) AS DOUBLE), 6) AS bid_price_usd FROM items_raw", "items_raw"))
def q_fn_currency_text(spark, d):
    """'$1,234.56' -> 1234.56 (non-digits dropped, then a safe cast)."""
    r = fixtures.items_raw(spark, d)
    return r.select("sale_price_text", fx.currency_text_to_usd("sale_price_text").alias("bid_price_usd"))


@register("fn_ts_to_date", M(
    "SELECT snapshot_timestamp, cast(snapshot_timestamp AS DATE) AS snapshot_date FROM items_raw", "items_raw"))
def q_fn_ts_to_date(spark, d):
    r = fixtures.items_raw(spark, d)
    return r.select("snapshot_timestamp", fx.ts_to_date("snapshot_timestamp").alias("snapshot_date"))


@register("fn_coalesce", M("""
SELECT s.item_name, s.snapshot_date AS market_date, cast(coalesce(h.units_sold, 0) AS BIGINT) AS units_sold,
       round(cast(coalesce(h.total_estimated_trade_volume_usd, 0) AS DOUBLE), 6) AS total_estimated_trade_volume_usd
FROM stg_items s LEFT JOIN int_item_price_history_daily h
  ON s.item_name = h.item_name AND s.snapshot_date = h.price_date""", "stg_items", "int_item_price_history_daily"))
def q_fn_coalesce(spark, d):
    """Missing sales default to 0."""
    return fct(spark, d).select("item_name", "market_date", "units_sold", "total_estimated_trade_volume_usd")


@register("fn_safe_divide", M("""
SELECT market_date, round(cast(sum(units_sold) AS BIGINT) / nullif(cast(sum(ask_count) AS BIGINT), 0), 6) AS ratio,
       round(sum(units_sold) / nullif(0, 0), 6) AS by_zero
FROM fct_market_daily GROUP BY 1""", "fct_market_daily"))
def q_fn_safe_divide(spark, d):
    """NULL on a zero divisor."""
    return fct(spark, d).groupBy("market_date").agg(
        fx.safe_divide(F.sum("units_sold"), F.sum("ask_count")).alias("ratio"),
        fx.safe_divide(F.sum("units_sold"), F.lit(0)).cast("double").alias("by_zero"))


def _kpi_sql(expr: str, name: str) -> str:
    return M(f"SELECT item_name, market_date, round(cast({expr} AS DOUBLE), 6) AS {name} FROM fct_market_daily",
             "fct_market_daily")


@register("kpi_bid_ask_spread", _kpi_sql("bid_ask_spread_pct", "bid_ask_spread_pct"))
def q_kpi_bid_ask_spread(spark, d):
    """(ask - bid) / bid."""
    return fct(spark, d).select("item_name", "market_date", "bid_ask_spread_pct")


@register("kpi_turnover_rate", _kpi_sql("turnover_rate", "turnover_rate"))
def q_kpi_turnover_rate(spark, d):
    """units sold / asks."""
    return fct(spark, d).select("item_name", "market_date", "turnover_rate")


@register("kpi_bid_ask_ratio", _kpi_sql("bid_ask_ratio", "bid_ask_ratio"))
def q_kpi_bid_ask_ratio(spark, d):
    """bid / ask."""
    return fct(spark, d).select("item_name", "market_date", "bid_ask_ratio")


@register("fn_case_label", M(
    "SELECT is_commodity, market_date, CASE WHEN is_commodity THEN 'Commodities' ELSE 'Non-Commodities' END "
    "AS category FROM rpt_commodity_velocity_daily", "rpt_commodity_velocity_daily"))
def q_fn_case_label(spark, d):
    return rpt_commodity(spark, d).select("is_commodity", "market_date",
                                          fx.case_label("is_commodity", *dash.COMMODITY_LABELS).alias("category"))


@register("fn_scale_pct", M(
    "SELECT market_date, round(market_turnover_rate * 100, 6) AS market_turnover_rate, "
    "round(cast(avg_bid_ask_spread_pct AS DOUBLE) * 100, 6) AS avg_bid_ask_spread_pct "
    "FROM rpt_market_metrics_daily", "rpt_market_metrics_daily"))
def q_fn_scale_pct(spark, d):
    r = rpt_market(spark, d)
    return r.select("market_date", fx.scale_pct("market_turnover_rate").alias("market_turnover_rate"),
                    fx.scale_pct("avg_bid_ask_spread_pct").alias("avg_bid_ask_spread_pct"))


@register("fn_to_double", M(
    "SELECT item_name, round(cast(ask_price_usd AS DOUBLE), 6) AS ask_price_usd, "
    "round(cast(bid_ask_ratio AS DOUBLE), 6) AS bid_ask_ratio FROM rpt_item_metrics_latest",
    "rpt_item_metrics_latest"))
def q_fn_to_double(spark, d):
    r = rpt_latest(spark, d)
    return r.select("item_name", fx.to_double("ask_price_usd").alias("ask_price_usd"),
                    fx.to_double("bid_ask_ratio").alias("bid_ask_ratio"))


@register("fn_display_format", M("""
SELECT item_name,
  CASE WHEN ask_price_usd IS NULL THEN 'N/A' ELSE printf('$%.2f', cast(ask_price_usd AS DOUBLE)) END AS ask_display,
  CASE WHEN bid_price_usd IS NULL THEN 'N/A' ELSE printf('$%.2f', cast(bid_price_usd AS DOUBLE)) END AS bid_display,
  CASE WHEN total_estimated_trade_volume_usd IS NULL THEN 'N/A'
       ELSE printf('$%.2f', cast(total_estimated_trade_volume_usd AS DOUBLE)) END AS volume_display,
  CASE WHEN ask_count IS NULL THEN 'N/A' ELSE cast(ask_count AS VARCHAR) END AS asks_display,
  format('{:,.2f}', cast(coalesce(ask_price_usd, 0) AS DOUBLE)) AS ask_card
FROM rpt_item_metrics_latest""", "rpt_item_metrics_latest"))
def q_fn_display_format(spark, d):
    """NULL -> 'N/A', money '$x.xx', counts as text; KPI card with separators."""
    r = rpt_latest(spark, d)
    return r.select("item_name", fx.display_money("ask_price_usd").alias("ask_display"),
                    fx.display_money("bid_price_usd").alias("bid_display"),
                    fx.display_money("total_estimated_trade_volume_usd").alias("volume_display"),
                    fx.display_count("ask_count").alias("asks_display"),
                    fx.kpi_number("ask_price_usd", 2).alias("ask_card"))


def _as_of(spark, d) -> _dt.date:
    """The data's own 'today': the newest market day (one scalar)."""
    return fct(spark, d).agg(F.max("market_date")).first()[0]


@register("fn_date_sub_today", M(
    "SELECT item_name, market_date FROM fct_market_daily "
    "WHERE market_date >= (SELECT max(market_date) FROM fct_market_daily) - INTERVAL 1 DAY", "fct_market_daily"))
def q_fn_date_sub_today(spark, d):
    """Rows of the last day: market_date >= as_of - 1 day."""
    as_of = _as_of(spark, d)
    return fct(spark, d).where(F.col("market_date") >= fx.date_sub_days(as_of, 1)).select("item_name",
                                                                                        "market_date")


# =====================================================================================
# §2.4 filters
# =====================================================================================

@register("filter_incremental_hwm", M(presented(K_FCT, "fct_market_daily"), "fct_market_daily"))
def q_filter_incremental_hwm(spark, d):
    """Fact built in two runs: the second recomputes days >= the table's max day only."""
    def write(p):
        stg = listings(spark, d)
        dl = daily(spark, d)
        split = F.lit(str(SPLIT_DAY)).cast("date")
        first, first_dl = stg.where(F.col("snapshot_date") < split), dl.where(F.col("price_date") < split)
        for s, h in ((first, first_dl), (stg, dl)):
            inc.materialize_incremental(spark, p, lambda since, s=s, h=h: m.fct_joined(s, h, since), "market_date",
                                        ["item_name"], finish=m.fct_measured, staged="fct-rows")
    path = _fresh(spark, "fct_incremental", write)
    return spark.read.parquet(path).select(*m.FCT_COLUMNS)


@register("filter_full_refresh_floor", M(
    "SELECT item_name, market_date, ask_count FROM fct_market_daily WHERE market_date >= DATE '2000-01-01'",
    "fct_market_daily"))
def q_filter_full_refresh_floor(spark, d):
    return fct(spark, d).where(F.col("market_date") >= fx.as_date(m.REPORT_FLOOR)).select(
        "item_name", "market_date", "ask_count")


@register("filter_param_date", M(
    "SELECT item_name, market_date, ask_count FROM fct_market_daily "
    "WHERE market_date = (SELECT max(market_date) FROM rpt_market_metrics_daily)",
    "fct_market_daily", "rpt_market_metrics_daily"))
def q_filter_param_date(spark, d):
    """Equality on a date chosen by another query (a one-row broadcast semi-join)."""
    param = dash.latest_market_date(rpt_market(spark, d))
    return fct(spark, d).join(F.broadcast(param), "market_date", "left_semi").select(
        "item_name", "market_date", "ask_count")


SEARCH_QUERY = "item-1 brand#1"
_SEARCH_SQL = {"turnover_rate": "cast(turnover_rate AS DECIMAL(38,9))"}


def _search_sql() -> str:
    text = "concat_ws(chr(10), " + ", ".join(
        f"coalesce(cast({_SEARCH_SQL.get(c, c)} AS VARCHAR), '')" for c in m.RPT_LATEST_COLUMNS) + ")"
    # RE2 is Unicode-aware without a flag and rejects Java's `u`
    conds = " AND ".join(f"regexp_matches({text}, '{search_pattern(t).replace('(?iu)', '(?i)')}')"
                         for t in SEARCH_QUERY.split())
    return M(presented(K_RPT_LATEST, "q"), "rpt_item_metrics_latest",
             extra={"q": f"SELECT * FROM rpt_item_metrics_latest WHERE {conds}"})


@register("filter_search", _search_sql())
def q_filter_search(spark, d):
    """Every term must start a word in some of the 13 columns, case-insensitive."""
    return search_filter(rpt_latest(spark, d), SEARCH_QUERY)


# =====================================================================================
# §2.5 joins
# =====================================================================================

@register("join_left_composite", M("""
SELECT s.item_name, s.snapshot_date, cast(h.units_sold AS BIGINT) AS units_sold,
       round(cast(h.avg_median_sale_price_usd AS DOUBLE), 6) AS avg_median_sale_price_usd
FROM stg_items s LEFT JOIN int_item_price_history_daily h
  ON s.item_name = h.item_name AND s.snapshot_date = h.price_date""", "stg_items", "int_item_price_history_daily"))
def q_join_left_composite(spark, d):
    """Snapshot LEFT JOIN daily history on (item, day)."""
    s, h = stg_items(spark, d).alias("s"), daily(spark, d).alias("h")
    j = s.join(h, (F.col("s.item_name") == F.col("h.item_name")) & (F.col("s.snapshot_date") == F.col("h.price_date")),
               "left")
    return j.select("s.item_name", "s.snapshot_date", "h.units_sold", "h.avg_median_sale_price_usd")


@register("join_inner_latest", M(presented(K_RPT_LATEST, "rpt_item_metrics_latest"), "rpt_item_metrics_latest"))
def q_join_inner_latest(spark, d):
    """Literal form: inner join of the fact to its per-item max day."""
    return m.rpt_item_metrics_latest_selfjoin(fct(spark, d))


_CHANGES_SQL = """
SELECT concat('ITEM-', cast(l_partkey AS VARCHAR)) AS item_name, l_orderkey AS seq,
       CASE WHEN l_returnflag = 'R' THEN 'remove' ELSE 'add' END AS action FROM lineitem"""


def _changes(spark, d):
    li = fixtures.table(spark, d, "lineitem")
    return li.select(F.concat(F.lit("ITEM-"), F.col("l_partkey").cast("string")).alias("item_name"),
                     F.col("l_orderkey").alias("seq"),
                     F.when(F.col("l_returnflag") == "R", "remove").otherwise("add").alias("action"))


@register("join_semi_selection", M("""
SELECT r.item_name, r.market_date FROM rpt_item_metrics_latest r
WHERE r.item_name IN (
  SELECT item_name FROM (SELECT item_name, action, row_number() OVER (PARTITION BY item_name
                           ORDER BY seq DESC, action DESC) AS rn FROM changes) WHERE rn = 1 AND action = 'add')""",
                                   "rpt_item_metrics_latest", extra={"changes": _CHANGES_SQL}))
def q_join_semi_selection(spark, d):
    """Rows of the selected items; the selection is the last add/remove change per item."""
    sel = current_selection(_changes(spark, d).withColumn("seq", F.struct("seq", "action")))
    return apply_selection(rpt_latest(spark, d), sel).select("item_name", "market_date")


# =====================================================================================
# §2.6 aggregations
# =====================================================================================

@register("agg_daily_history", M(presented(K_DAILY, "int_item_price_history_daily"), "int_item_price_history_daily"))
def q_agg_daily_history(spark, d):
    return m.daily_history_agg(stg_history(spark, d))


@register("agg_sum_product", M(
    "SELECT item_name, round(cast(cast(sum(cast(units_sold AS DECIMAL(18,0)) * cast(median_sale_price_usd AS "
    "DECIMAL(18,9))) AS DECIMAL(38,9)) AS DOUBLE), 6) AS trade_volume_usd FROM stg_item_price_history GROUP BY 1",
    "stg_item_price_history"))
def q_agg_sum_product(spark, d):
    """sum(units x median price) without losing decimal scale."""
    return stg_history(spark, d).groupBy("item_name").agg(
        fx.money(F.sum(fx.money_product("units_sold", "median_sale_price_usd"))).alias("trade_volume_usd"))


_K_AGG = "total_estimated_trade_volume_usd:n total_active_supply:i total_units_sold:i {t}:n avg_bid_ask_spread_pct:n"


@register("agg_market_daily", M(presented(kinds("market_date " + _K_AGG.format(t="market_turnover_rate")), "a"),
                                "fct_market_daily", extra={"a": """
SELECT market_date, cast(sum(total_estimated_trade_volume_usd) AS DECIMAL(38,9)) AS total_estimated_trade_volume_usd,
  sum(ask_count) AS total_active_supply, sum(units_sold) AS total_units_sold,
  cast(sum(units_sold) AS BIGINT) / nullif(cast(sum(ask_count) AS BIGINT), 0) AS market_turnover_rate,
  cast(avg(bid_ask_spread_pct) AS DECIMAL(38,9)) AS avg_bid_ask_spread_pct FROM fct_market_daily GROUP BY 1"""}))
def q_agg_market_daily(spark, d):
    """Daily market aggregate over every day (no floor)."""
    return m.rpt_market_metrics_daily(fct(spark, d), floor=None)


@register("agg_commodity_daily", M(presented(kinds("is_commodity market_date " + _K_AGG.format(
    t="group_turnover_rate")), "a"), "fct_market_daily", extra={"a": """
SELECT is_commodity, market_date,
  cast(sum(total_estimated_trade_volume_usd) AS DECIMAL(38,9)) AS total_estimated_trade_volume_usd,
  sum(ask_count) AS total_active_supply, sum(units_sold) AS total_units_sold,
  cast(sum(units_sold) AS BIGINT) / nullif(cast(sum(ask_count) AS BIGINT), 0) AS group_turnover_rate,
  cast(avg(bid_ask_spread_pct) AS DECIMAL(38,9)) AS avg_bid_ask_spread_pct FROM fct_market_daily GROUP BY 1, 2"""}))
def q_agg_commodity_daily(spark, d):
    """Per (commodity flag, day) over every day; a NULL flag is its own group."""
    return m.rpt_commodity_velocity_daily(fct(spark, d), floor=None)


@register("agg_ratio_of_sums", M(
    "SELECT bucket_group_name, round(cast(sum(units_sold) AS BIGINT) / nullif(cast(sum(ask_count) AS BIGINT), 0), 6)"
    " AS turnover FROM fct_market_daily GROUP BY 1", "fct_market_daily"))
def q_agg_ratio_of_sums(spark, d):
    """Ratio of sums (not mean of ratios)."""
    return fct(spark, d).groupBy("bucket_group_name").agg(
        fx.safe_divide(F.sum("units_sold"), F.sum("ask_count")).alias("turnover"))


@register("agg_avg_skip_null", M(
    "SELECT item_type, round(cast(cast(avg(bid_ask_spread_pct) AS DECIMAL(38,9)) AS DOUBLE), 6) AS avg_spread, "
    "round(avg(CASE WHEN units_sold > 0 THEN turnover_rate END), 6) AS avg_turnover_with_sales "
    "FROM fct_market_daily GROUP BY 1", "fct_market_daily"))
def q_agg_avg_skip_null(spark, d):
    """avg() ignores NULLs."""
    return fct(spark, d).groupBy("item_type").agg(
        fx.money(F.avg("bid_ask_spread_pct")).alias("avg_spread"),
        F.avg(F.when(F.col("units_sold") > 0, F.col("turnover_rate"))).alias("avg_turnover_with_sales"))


@register("agg_max_per_key", M("SELECT item_name, max(market_date) AS max_market_date FROM fct_market_daily "
                               "GROUP BY 1", "fct_market_daily"))
def q_agg_max_per_key(spark, d):
    return fct(spark, d).groupBy("item_name").agg(F.max("market_date").alias("max_market_date"))


@register("agg_scalar_max", M(
    "SELECT coalesce(max(price_date), DATE '1970-01-01') AS mark FROM int_item_price_history_daily",
    "int_item_price_history_daily"))
def q_agg_scalar_max(spark, d):
    """The table-level mark: coalesce(max(date), 1970-01-01)."""
    return daily(spark, d).agg(F.coalesce(F.max("price_date"), fx.as_date(m.EPOCH)).alias("mark"))


@register("agg_bucket_breakdown", M(
    "SELECT bucket_group_name AS category, round(cast(sum(total_estimated_trade_volume_usd) AS DOUBLE), 6) "
    "AS trade_volume_usd, cast(sum(units_sold) AS BIGINT) AS units_sold, "
    "round(cast(avg(bid_ask_spread_pct) AS DOUBLE), 6) AS avg_bid_ask_spread_pct, "
    "round(avg(turnover_rate), 6) AS avg_turnover_rate FROM rpt_item_metrics_latest GROUP BY 1",
    "rpt_item_metrics_latest"))
def q_agg_bucket_breakdown(spark, d):
    """Per bucket group: 2 sums, 2 means (turnover: mean of ratios)."""
    return dash.bucket_breakdown_wide(rpt_latest(spark, d))


@register("agg_group_by_ordinal", M(
    "SELECT item_name, cast(priced_at AS DATE) AS price_date, cast(sum(units_sold) AS BIGINT) AS units_sold "
    "FROM stg_item_price_history GROUP BY 1, 2", "stg_item_price_history"))
def q_agg_group_by_ordinal(spark, d):
    """GROUP BY 1, 2 in Spark SQL."""
    stg_history(spark, d).createOrReplaceTempView("stg_item_price_history_o")
    return spark.sql("SELECT item_name, to_date(priced_at) AS price_date, sum(units_sold) AS units_sold "
                     "FROM stg_item_price_history_o GROUP BY 1, 2")


# =====================================================================================
# §2.7 window, sort, top-k, set ops, reshaping
# =====================================================================================

@register("dedup_items", M("SELECT item_name, snapshot_date, _dlt_id FROM stg_items", "stg_items"))
def q_dedup_items(spark, d):
    """One row per (item, day): newest load, then most asks, then a total order."""
    return stg_items(spark, d).select("item_name", "snapshot_date", "_dlt_id")


@register("dedup_history", M("SELECT item_name, priced_at, _dlt_id FROM stg_item_price_history",
                             "stg_item_price_history"))
def q_dedup_history(spark, d):
    """One row per (item, timestamp): newest load wins."""
    return stg_history(spark, d).select("item_name", "priced_at", "_dlt_id")


@register("latest_dim_item", M("SELECT item_name, snapshot_date FROM dim_item", "dim_item"))
def q_latest_dim_item(spark, d):
    """Newest snapshot per item."""
    return m.dim_item(stg_items(spark, d)).select("item_name", "snapshot_date")


@register("dim_incremental", M(presented(K_DIM, "dim_item"), "dim_item"))
def q_dim_incremental(spark, d):
    """Dimension kept by keyed upsert: old rows + candidates since the old max day."""
    stg = stg_items(spark, d)
    cut = F.col("snapshot_date") < F.lit(str(SPLIT_DAY)).cast("date")
    path = _fresh(spark, "dim_first", lambda p: m.dim_item(stg.where(cut)).write.parquet(p))
    current = spark.read.parquet(path)
    since = current.agg(F.max("snapshot_date")).first()[0]
    return m.dim_item_upsert(current, stg, since)


@register("qualify_filter", M(presented(K_DIM, "dim_item"), "dim_item"))
def q_qualify_filter(spark, d):
    """Filter on a window result, written in Spark SQL (a subquery stands in for QUALIFY)."""
    stg_items(spark, d).createOrReplaceTempView("stg_items_q")
    return spark.sql("""
        SELECT item_name, class_id, bucket_group_id, bucket_group_name, item_type, name_color, is_tradable,
               is_commodity, snapshot_date FROM (
          SELECT *, row_number() OVER (PARTITION BY item_name ORDER BY snapshot_date DESC NULLS LAST,
            class_id DESC NULLS LAST, bucket_group_id DESC NULLS LAST, bucket_group_name DESC NULLS LAST,
            item_type DESC NULLS LAST, name_color DESC NULLS LAST, is_tradable DESC NULLS LAST,
            is_commodity DESC NULLS LAST) AS rn
          FROM stg_items_q) WHERE rn = 1""")


@register("topk_latest_day", M(
    "SELECT market_date, total_units_sold FROM rpt_market_metrics_daily ORDER BY market_date DESC LIMIT 1",
    "rpt_market_metrics_daily"))
def q_topk_latest_day(spark, d):
    """ORDER BY day DESC LIMIT 1 (a top-k, no full sort)."""
    return rpt_market(spark, d).orderBy(F.col("market_date").desc()).limit(1).select("market_date",
                                                                                     "total_units_sold")


@register("order_by_name", M(
    "SELECT asset_description__market_hash_name AS market_hash_name, sell_price FROM items_raw "
    "ORDER BY market_hash_name", "items_raw"))
def q_order_by_name(spark, d):
    """Records in name order, ascending (range-partitioned sort).

    Ties are ordered by the remaining columns, which also lets the range partitioner
    split one very frequent name over several tasks.
    """
    r = _records(spark, d)
    named = r.select(F.col("asset_description.market_hash_name").alias("market_hash_name"), "sell_price")
    # a sort looks at its input twice, for the ranges and for the rows: the pages are parsed once
    return materialize(named, "named").orderBy("market_hash_name", "sell_price")


@register("concat_tables", M(presented(K_RPT_MARKET, "rpt_market_metrics_daily"), "rpt_market_metrics_daily"))
def q_concat_tables(spark, d):
    """Union-all of the shards of one export (same schema), as one read of all files."""
    root = _fresh(spark, "shards", lambda p: export_parquet(rpt_market(spark, d).repartition(4), p, "rpt_market"))
    return read_export(spark, f"{root}/rpt_market")


_GROUP_DAYS = """
SELECT market_date, is_commodity, sum(ask_count) AS supply, sum(units_sold) AS units,
       sum(total_estimated_trade_volume_usd) AS volume
FROM fct_market_daily WHERE market_date >= DATE '2000-01-01' GROUP BY ALL"""
_GROUP_STACK = stacked("group_days", f"market_date, {_LABEL}", _GROUP_MEASURES)


def _unpivot_all(spark, d):
    prepared = rpt_commodity(spark, d).select(
        "market_date", fx.case_label("is_commodity", *dash.COMMODITY_LABELS).alias("category"),
        fx.to_double("total_active_supply").alias("total_active_supply"),
        fx.to_double("total_units_sold").alias("total_units_sold"),
        fx.to_double("total_estimated_trade_volume_usd").alias("trade_volume_usd"))
    return unpivot(prepared, ["market_date", "category"], dash.COMMODITY_MEASURES)


@register("unpivot_commodity", M(presented(kinds("market_date category metric_type value:n"), "u"),
                                 "fct_market_daily", extra={"group_days": _GROUP_DAYS, "u": _GROUP_STACK}))
def q_unpivot_commodity(spark, d):
    """Wide -> long for every day; NULL measures are dropped."""
    return _unpivot_all(spark, d)


@register("unpivot_bucket", BUCKET_ORACLE)
def q_unpivot_bucket(spark, d):
    """4 measures of mixed types, cast to double, then unpivoted."""
    return dash.q_breakdown_by_bucket(rpt_latest(spark, d))


@register("share_of_total", M(presented(kinds("market_date category metric_type value:n share:n"), "s"),
                              "fct_market_daily", extra={"group_days": _GROUP_DAYS, "u": _GROUP_STACK, "s": """
SELECT market_date, category, metric_type, value,
  value / nullif(sum(value) OVER (PARTITION BY market_date, metric_type), 0) AS share FROM u"""}))
def q_share_of_total(spark, d):
    """Stacked bars normalised to 100 %: value / total of the same metric and day."""
    return share_of_total(_unpivot_all(spark, d), "value", ["market_date", "metric_type"])


# =====================================================================================
# §2.9 incremental / streaming
# =====================================================================================

@register("stream_ingest_available_now", P(presented(K_POINT, "good_points"), "good_points"))
def q_stream_ingest_available_now(spark, d):
    """Pages arrive as files in two drops; an availableNow file stream extracts each
    micro-batch against the marks in the sink (excluding its own batch) and writes it
    partitioned by batch id, so a replay replaces its own output."""
    from bazaar.streaming.ingest_stream import run_available_now

    def write(p):
        pages = fixtures.history_pages(spark, d)
        src = f"{p}/pages"
        early = F.col("month") < F.lit(str(SPLIT_DAY)).cast("date")
        pages.where(early).drop("month").write.mode("append").parquet(src)
        run_available_now(spark, src, f"{p}/sink", f"{p}/chk")
        pages.where(~early).drop("month").write.mode("append").parquet(src)
        run_available_now(spark, src, f"{p}/sink", f"{p}/chk")
    root = _fresh(spark, "stream", write)
    return spark.read.parquet(f"{root}/sink").select("market_hash_name", "date", "price", "volume")


@register("incremental_state_commit", P(
    "SELECT market_hash_name, max(cast(date AS DATE)) AS last_seen FROM good_points GROUP BY 1", "good_points"))
def q_incremental_state_commit(spark, d):
    """Data first, then the state of that load; a lost state is re-derived from the data."""
    def write(p):
        ex = ig.extract_price_history(fixtures.history_pages(spark, d).drop("month"))
        # what a load that crashed while committing leaves: a folder that must not count
        ex.records.limit(0).write.parquet(f"{p}/state/load_id=000000000000/_temporary")
        ex.records.withColumn("load_id", F.lit(LOAD_ID)).write.partitionBy("load_id").parquet(f"{p}/data")
        data = inc.read_loads(spark, f"{p}/data", schemas.PRICE_RECORD)
        inc.commit_state(ig.advance_state(None, data.where(F.col("load_id") == LOAD_ID)), f"{p}/state", LOAD_ID)
    root = _fresh(spark, "state_commit", write)
    return inc.read_state(spark, f"{root}/state", inc.read_loads(spark, f"{root}/data", schemas.PRICE_RECORD))


# =====================================================================================
# §2.10 data quality
# =====================================================================================

_FCT_NN = ["item_name", "ask_count", "ask_price_usd", "bid_price_usd", "units_sold",
           "total_estimated_trade_volume_usd", "market_date"]


def _nn_sql(model: str, cols, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, 'not_null' AS test, '{c}' AS column_name, "
        f"cast(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {model}{w}" for c in cols)


def _uq_sql(model: str, col: str, where: str = "") -> str:
    w = f" AND {where}" if where else ""
    return (f"SELECT '{model}' AS model, 'unique' AS test, '{col}' AS column_name, cast(count(*) AS BIGINT) "
            f"AS failures FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL{w} GROUP BY 1 HAVING count(*) > 1)")


@register("test_not_null", M(_nn_sql("fct_market_daily", _FCT_NN + ["avg_median_sale_price_usd"]),
                             "fct_market_daily"))
def q_test_not_null(spark, d):
    """NULL counts of many columns in one pass (avg price is legitimately NULL)."""
    return qa.not_null_failures(fct(spark, d), "fct_market_daily", _FCT_NN + ["avg_median_sale_price_usd"])


@register("test_unique", M(_uq_sql("rpt_item_metrics_latest", "item_name") + " UNION ALL " +
                           _uq_sql("fct_market_daily", "item_name"), "rpt_item_metrics_latest", "fct_market_daily"))
def q_test_unique(spark, d):
    """Values occurring twice (0 on the latest report, many on the daily fact)."""
    return qa.unique_failures(rpt_latest(spark, d), "rpt_item_metrics_latest", "item_name").unionByName(
        qa.unique_failures(fct(spark, d), "fct_market_daily", "item_name"))


_SCOPE = "market_date >= (SELECT max(market_date) FROM fct_market_daily) - INTERVAL 1 DAY"


@register("test_where_scope", M(_nn_sql("fct_market_daily", _FCT_NN + ["avg_median_sale_price_usd"], _SCOPE),
                                "fct_market_daily"))
def q_test_where_scope(spark, d):
    """Tests restricted to the last day (market_date >= as_of - 1)."""
    return qa.not_null_failures(fct(spark, d), "fct_market_daily", _FCT_NN + ["avg_median_sale_price_usd"],
                                where=qa.recent_scope("market_date", _as_of(spark, d), 1))


def _gate_sql() -> str:
    parts = []
    for t in qa.DECLARED_TESTS:
        where = _SCOPE if t.scope == "recent" else ""
        if t.not_null:
            parts.append(_nn_sql(t.model, t.not_null, where))
        for c in t.unique:
            parts.append(_uq_sql(t.model, c, where))
    return M(" UNION ALL ".join(parts), *[t.model for t in qa.DECLARED_TESTS])


@register("gate_build", _gate_sql())
def q_gate_build(spark, d):
    """All 19 declared tests (16 not_null, 3 unique) on built models, as a build runs
    them; the gate raises on any failure. The models are built once and written to the
    shared checkpoint folder (lineage cut), so the test branches read them instead of
    recomputing them."""
    # of the staged listings, what the dimension and the fact take from them
    stg = stg_items(spark, d).select(*m.DIM_COLUMNS, "ask_count", "ask_price_usd", "bid_price_usd")
    stg = materialize(stg, "gate-stg", "zstd")
    dl = materialize(daily(spark, d), "gate-daily", "zstd")
    f = materialize(m.fct_market_daily(stg, dl), "gate-fct", "zstd")
    tables = {"int_item_price_history_daily": dl, "dim_item": m.dim_item(stg), "fct_market_daily": f,
              # each table is tested in one pass, so none of these is computed twice
              "rpt_commodity_velocity_daily": m.rpt_commodity_velocity_daily(f),
              "rpt_item_metrics_latest": m.rpt_item_metrics_latest(f),
              "rpt_market_metrics_daily": m.rpt_market_metrics_daily(f)}
    results = qa.run_tests(tables, as_of=f.agg(F.max("market_date")).first()[0])
    results = spark.createDataFrame(results.collect(), results.schema)  # 19 rows, one per test
    qa.gate_build(results)
    return results


@register("gate_load", P("""
SELECT cast(count(*) FILTER (WHERE status NOT IN (200, 404)) AS BIGINT) AS failed_pages,
       cast(count(*) AS BIGINT) AS pages, count(*) FILTER (WHERE status NOT IN (200, 404)) > 0 AS tripped
FROM hist_pages""", "hist_pages"))
def q_gate_load(spark, d):
    """The load gate at its default threshold, and the page counts it looks at."""
    counts = ig.outcome_counts(ig.extract_price_history(fixtures.history_pages(spark, d).drop("month")).outcomes)
    counts = spark.createDataFrame(counts.collect(), counts.schema)  # one row per outcome
    try:
        qa.gate_load(counts)
        tripped = False
    except qa.BuildFailed:
        tripped = True
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("outcome").isin("rate_limited", "forbidden", "failed"), F.col("pages"))),
                   F.lit(0)).cast("bigint").alias("failed_pages"),
        F.sum("pages").cast("bigint").alias("pages"), F.lit(tripped).alias("tripped"))


@register("report_schema_contract", M(
    "SELECT 'rpt_market_metrics_daily' AS report, count(*) AS rows_checked, cast(0 AS BIGINT) AS contract_mismatches "
    "FROM rpt_market_metrics_daily UNION ALL "
    "SELECT 'rpt_commodity_velocity_daily', count(*), 0 FROM rpt_commodity_velocity_daily UNION ALL "
    "SELECT 'rpt_item_metrics_latest', count(*), 0 FROM rpt_item_metrics_latest",
    "rpt_market_metrics_daily", "rpt_commodity_velocity_daily", "rpt_item_metrics_latest"))
def q_report_schema_contract(spark, d):
    """Declared column types of the reports checked before export."""
    out = []
    for name, df in (("rpt_market_metrics_daily", rpt_market(spark, d)),
                     ("rpt_commodity_velocity_daily", rpt_commodity(spark, d)),
                     ("rpt_item_metrics_latest", rpt_latest(spark, d))):
        qa.check_contract(df, REPORT_CONTRACTS[name], name)
        out.append(df.agg(F.count(F.lit(1)).alias("rows_checked")).select(
            F.lit(name).alias("report"), "rows_checked",
            F.lit(len(qa.contract_diff(df, REPORT_CONTRACTS[name]))).cast("bigint").alias("contract_mismatches")))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res
