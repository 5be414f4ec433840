"""Adapter: the driver's TPC-H-like tables standing in for the raw market tables.

`lineitem JOIN part` plays the daily listing snapshot (one row per listed item),
lineitem rows with a return flag other than 'N' play the sale history. The mapping
is fixed so that the DuckDB oracle can express the very same rows (see
`bazaar.plans.oracle`). Everything is a projection over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar import schemas
from bazaar.sources.raw import conform


#: Session setting of benches on one machine: deal the rows of each table to so many partitions, as the
#: small files have one row group and would be read by one task. Unset, tables are read as they are.
SPREAD = "spark.bazaar.fixtures.spread"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    spread = spark.conf.get(SPREAD, None)
    return df.repartition(int(spread)) if spread else df


def _load_id(orderkey: F.Column) -> F.Column:
    # fixed width so that text order is load order
    return F.lpad(orderkey.cast("string"), 12, "0")


def _row_id(load_id: F.Column, linenumber: F.Column, suppkey: F.Column) -> F.Column:
    # load id, line number and supplier: carries the tie-break order through staging
    return F.concat_ws("-", load_id, F.lpad(linenumber.cast("string"), 4, "0"), F.lpad(suppkey.cast("string"), 10, "0"))


def _money_text(c: F.Column) -> F.Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each lineitem beside its part."""
    l = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return l.join(p, l["l_partkey"] == p["p_partkey"], "inner")


def _values(v) -> dict[str, F.Column]:
    """What a listing says of a line and its part, whose columns are `v(name)`."""
    ext2 = v("l_extendedprice").cast("decimal(18,2)")
    sale = (ext2 * (F.lit(1).cast("decimal(4,2)") - v("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")
    return {
        "sell_listings": v("l_quantity").cast("bigint"),
        "sell_price": F.round(v("l_extendedprice") * 100).cast("bigint"),
        "sell_price_text": _money_text(ext2),
        "sale_price_text": _money_text(sale),
        "asset_description__classid": v("l_suppkey").cast("string"),
        "asset_description__background_color": F.lit(None).cast("string"),
        "asset_description__tradable": (v("l_linenumber") % 2).cast("bigint"),
        "asset_description__name_color": v("p_name"),
        "asset_description__type": v("p_type"),
        "asset_description__market_hash_name": F.concat(F.lit("ITEM-"), v("l_partkey").cast("string")),
        "asset_description__commodity": (v("p_size") % 2).cast("bigint"),
        "asset_description__market_bucket_group_name": v("p_brand"),
        "asset_description__market_bucket_group_id": v("p_brand"),
    }


def items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw listing row per lineitem, attributes from its part."""
    load_id = _load_id(F.col("l_orderkey"))
    out = _lines(spark, sf_dir).select(
        *[c.alias(name) for name, c in _values(F.col).items()],
        F.col("l_shipdate").cast("timestamp").alias("snapshot_timestamp"),
        load_id.alias("_dlt_load_id"),
        _row_id(load_id, F.col("l_linenumber"), F.col("l_suppkey")).alias("_dlt_id"),
    )
    return conform(out, schemas.ITEMS_RAW, "items_raw")


def item_price_history_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale history: every returned lineitem is a (day, median price, volume) point."""
    l = table(spark, sf_dir, "lineitem")
    out = l.where(F.col("l_returnflag") != "N").select(
        F.concat(F.lit("ITEM-"), F.col("l_partkey").cast("string")).alias("market_hash_name"),
        F.col("l_shipdate").cast("timestamp").alias("date"),
        F.col("l_extendedprice").cast(schemas.MONEY).alias("price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        _load_id(l["l_orderkey"]).alias("_dlt_load_id"),
        _row_id(_load_id(l["l_orderkey"]), l["l_linenumber"], l["l_suppkey"]).alias("_dlt_id"),
    )
    return conform(out, schemas.ITEM_PRICE_HISTORY_RAW, "item_price_history_raw")


# --- archived pages derived from the same tables -------------------------------------------

# Fixed fixture mapping: fetch status of an item's listing page by part size; two sizes
# get damaged pages (a body that is not JSON, or a newest point without a valid date).
STATUS_BY_SIZE = {47: 500, 48: 403, 49: 429, 50: 404}
BAD_JSON_SIZE = 46
BAD_POINT_SIZE = 45
FAKE_POINT = '["not a date","1","1"]'


#: What a listing record holds, each value once; its other fields repeat the name or are fixed.
RECORD_VALUES = ("asset_description__market_hash_name", "sell_listings", "sell_price", "sell_price_text",
                 "sale_price_text", "asset_description__classid", "asset_description__background_color",
                 "asset_description__tradable", "asset_description__name_color", "asset_description__type",
                 "asset_description__commodity", "asset_description__market_bucket_group_name",
                 "asset_description__market_bucket_group_id")


def _record(v) -> F.Column:
    """The API record of the values `v(name)`, with the redundant fields present."""
    def asset(name: str) -> F.Column:
        return v(f"asset_description__{name}").alias(name)

    name = v("asset_description__market_hash_name")
    description = F.struct(
        name.alias("name"), name.alias("market_name"), F.lit(1).cast("bigint").alias("appid"),
        F.lit("icon").alias("icon_url"),
        *[asset(x) for x in ("classid", "background_color", "tradable", "name_color", "type", "market_hash_name",
                             "commodity", "market_bucket_group_name", "market_bucket_group_id")])
    return F.struct(name.alias("name"), name.alias("hash_name"), F.lit("icon").alias("app_icon"),
                    F.lit("Market").alias("app_name"),
                    *[v(x).alias(x) for x in ("sell_listings", "sell_price", "sell_price_text", "sale_price_text")],
                    description.alias("asset_description"))


#: What a page's lines are made from, beside the order that the page stands for.
LINE_VALUES = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "p_name",
               "p_brand", "p_type", "p_size")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived API result pages (page_no from 1, body JSON): the lines of one order are one page.

    Lines meet by page as the tables have them, before they are collected: their texts and what a record repeats are made
    where the page is written, and no task sorts its input by page ahead of the shuffle. The values are in the
    record's order, so that lines of one id sort as their records would.
    """
    page = (_load_id(F.col("l_orderkey")).cast("bigint") + 1).alias("page_no")
    lines = _lines(spark, sf_dir).select(page, *LINE_VALUES).repartition("page_no")
    load_id = _load_id(F.col("page_no") - 1)

    def row(x) -> F.Column:
        values = _values(lambda name: x[name])
        return F.struct(_row_id(load_id, x["l_linenumber"], x["l_suppkey"]).alias("_dlt_id"),
                        *[values[name].alias(name) for name in RECORD_VALUES])

    pages = lines.groupBy("page_no").agg(F.collect_list(F.struct(*LINE_VALUES)).alias("lines"))
    pages = pages.select("page_no", F.array_sort(F.transform("lines", row)).alias("rows"))
    results = F.transform("rows", lambda x: _record(lambda name: x[name]))
    return pages.select("page_no", F.to_json(F.struct(F.size("rows").cast("bigint").alias("total_count"),
                                                      results.alias("results"))).alias("body"))


def history_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages (market_hash_name, status, body) with the embedded daily series.

    One page per item and month holds that month's deduplicated daily points sorted
    by date (at most 31), as `var line1=[["Nov 05 2024 01: +0","1.5","4"],...];`.
    """
    from bazaar.plans.models import stg_item_price_history  # the deduplicated series
    h = stg_item_price_history(item_price_history_raw(spark, sf_dir))
    # an item's points, one per instant, meet once: its months are collected and find its part where they lie; the
    # points become texts where the page is written
    points = h.select("item_name", "priced_at", "median_sale_price_usd", "units_sold").repartition("item_name")
    per_month = (points.groupBy("item_name", F.trunc(F.to_date("priced_at"), "MM").alias("month"))
                 .agg(F.array_sort(F.collect_list(F.struct("priced_at", "median_sale_price_usd", "units_sold")))
                      .alias("pts")))
    texts = F.transform("pts", lambda x: F.array(
        F.concat(F.date_format(x["priced_at"], "MMM dd yyyy"), F.lit(" 01: +0")),
        x["median_sale_price_usd"].cast("string"), x["units_sold"].cast("string")))
    body = F.concat(F.lit("var line1="), F.to_json(texts), F.lit(";"))
    part = table(spark, sf_dir, "part").select(
        F.concat(F.lit("ITEM-"), F.col("p_partkey").cast("string")).alias("item_name"), "p_size")
    pm = per_month.select("item_name", "month", body.alias("body")).join(part, "item_name", "left")
    status = F.lit(200)
    for size, code in STATUS_BY_SIZE.items():
        status = F.when(F.col("p_size") == size, F.lit(code)).otherwise(status)
    damaged = (F.when(F.col("p_size") == BAD_JSON_SIZE, F.regexp_replace("body", r"^var line1=\[\[", "var line1=[{"))
               .when(F.col("p_size") == BAD_POINT_SIZE,
                     F.regexp_replace("body", r"\]\];$", "]," + FAKE_POINT.replace("\\", "\\\\") + "];"))
               .otherwise(F.col("body")))
    return pm.select(F.col("item_name").alias("market_hash_name"), status.cast("int").alias("status"),
                     damaged.alias("body"), F.col("month"))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web pages as fetched pages without a series (the no-match path)."""
    p = table(spark, sf_dir, "pages")
    return p.select(F.concat(F.lit("PAGE-"), F.col("page_id").cast("string")).alias("market_hash_name"),
                    F.lit(200).cast("int").alias("status"), F.col("html").alias("body"),
                    F.lit(None).cast("date").alias("month"))


# A previous run is taken to have loaded every point before this day.
PREVIOUS_RUN_CUTOFF = "1998-01-01"


def history_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-item mark left by the previous run: the last day it loaded."""
    from bazaar.plans.models import stg_item_price_history
    h = stg_item_price_history(item_price_history_raw(spark, sf_dir))
    return (h.where(F.col("priced_at") < F.lit(PREVIOUS_RUN_CUTOFF).cast("timestamp"))
            .groupBy(F.col("item_name").alias("market_hash_name"))
            .agg(F.max(F.to_date("priced_at")).alias("last_seen")))
