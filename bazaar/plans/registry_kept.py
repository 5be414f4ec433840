"""Queries over kept structures (stored aggregates, a search index), each held to the SQL of a full rebuild.

They stand beside the inventory's queries: the results are those of an inventory query, worked out the
kept way.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from bazaar.operators.search import build_search_index, search_indexed
from bazaar.plans import models as m
from bazaar.plans import partials as pt
from bazaar.plans import registry as base
from bazaar.plans.registry import K_RPT_COMMODITY, K_RPT_MARKET, model_oracle
from bazaar.plans.registry_ops import SEARCH_QUERY
from bazaar.session import materialize, scratch_path
from bazaar.sources import fixtures

QUERIES: dict[str, base.Builder] = {}
ORACLE: dict[str, str] = {}
register = partial(base.register, queries=QUERIES, oracles=ORACLE)


def _after_late_weekends(spark, d):
    """Day aggregates of a fact whose weekend sales came late, corrected by difference."""
    raw = fixtures.item_price_history_raw(spark, d)
    late = F.dayofweek("date").isin(1, 7)
    early = m.int_item_price_history_daily(m.stg_item_price_history(raw.where(~late)))
    fct = materialize(m.fct_market_daily(base.stg_items(spark, d), early), "early-fct", "zstd")
    fct = fct.where(F.col("market_date") >= F.lit(str(m.REPORT_FLOOR)).cast("date"))
    points = m.stg_item_price_history(raw.where(late))
    keys = points.select("item_name", F.to_date("priced_at").alias("day")).distinct()
    changed = pt.changed_rows(fct, m.int_item_price_history_daily(points), keys)
    read = ("is_commodity", "market_date", *pt.MEASURES)   # of a changed row, by its day's aggregates
    changed = materialize(changed.select(*[F.struct(*[f"{side}.{c}" for c in read]).alias(side)
                                           for side in ("before", "after")]), "late-rows", "zstd")
    return pt.corrected(pt.day_partials(fct), changed.select("before.*"), changed.select("after.*"))


@register("late_sales_market", model_oracle("rpt_market_metrics_daily", K_RPT_MARKET))
def q_late_sales_market(spark, d):
    """The daily market report from stored aggregates, after late sales."""
    return pt.rpt_market_metrics_daily(_after_late_weekends(spark, d))


@register("late_sales_commodity", model_oracle("rpt_commodity_velocity_daily", K_RPT_COMMODITY))
def q_late_sales_commodity(spark, d):
    """The same by commodity flag."""
    return pt.rpt_commodity_velocity_daily(_after_late_weekends(spark, d))


@register("search_by_index", base.ORACLE["filter_search"])
def q_search_by_index(spark, d):
    """The search of `filter_search` by a word-start index of the report."""
    path = scratch_path(spark, "search-index")
    build_search_index(base.rpt_latest(spark, d), path)
    return search_indexed(spark, path, SEARCH_QUERY)
