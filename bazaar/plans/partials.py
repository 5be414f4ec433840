"""Stored day aggregates of the fact: sums and counts that merge and are corrected by difference.

One row per day and commodity flag holds, for each measure, its sum and the number of values in it. Sums
and counts of disjoint rows add up, and those of rows that change are taken off and added anew, so a
report of a day follows a change of some of its rows without the day's other rows being aggregated again. All
sums are exact (BIGINT, DECIMAL), hence so is the difference; a mean is divided when it is read.

Late sales (points of days before those that a load rebuilds) change fact rows of old days.
`correct_late_sales` writes everything that follows from them aside, as one change, and moves it in;
a change that was cut short is finished by the next run.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions import scalar as fx
from bazaar.plans import incremental as inc
from bazaar.plans import models as m
from bazaar.schemas import WORK
from bazaar.session import materialize
from bazaar.sources import folders as fs
from bazaar.sources.sinks import write_table

MEASURES = ("total_estimated_trade_volume_usd", "ask_count", "units_sold", "bid_ask_spread_pct")
NUMBERS = ("n_rows",) + tuple(f"{p}_{c}" for c in MEASURES for p in ("sum", "n"))
#: What late sales can change of a fact row.
SALES = ("units_sold", "total_estimated_trade_volume_usd", "avg_median_sale_price_usd")


# --- aggregates -----------------------------------------------------------------------

def day_partials(fct: DataFrame, by: Sequence[str] = ("is_commodity",)) -> DataFrame:
    """Sums (0 without values), counts of values and rows, per `by` and day. NULL is a group of its own."""
    parts = [F.count(F.lit(1)).alias("n_rows")]
    for c in MEASURES:
        parts += [F.coalesce(F.sum(c), F.lit(0)).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}")]
    return fct.groupBy(*by, "market_date").agg(*parts)


def merge(*partials: DataFrame) -> DataFrame:
    """Add partial aggregates up by group; a group that has lost all its rows goes."""
    rows = reduce(DataFrame.unionByName, partials)
    groups = [c for c in rows.columns if c not in NUMBERS]
    return rows.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in NUMBERS]).where(F.col("n_rows") != 0)


def negative(partials: DataFrame) -> DataFrame:
    return partials.select(*[(-F.col(c)).alias(c) if c in NUMBERS else F.col(c) for c in partials.columns])


def corrected(partials: DataFrame, before: DataFrame, after: DataFrame, by: Sequence[str] = ("is_commodity",)) -> DataFrame:
    """The aggregates once the rows `before`, which are in them, have become `after`."""
    return merge(partials, negative(day_partials(before, by)), day_partials(after, by))


def _total(c: str) -> Column:
    return F.when(F.sum(f"n_{c}") > 0, F.sum(f"sum_{c}"))


def _mean(c: str) -> Column:
    """As avg() of the rows: 13 decimals, then those of money; wide sums are divided as they are."""
    total, n = F.sum(f"sum_{c}"), F.sum(f"n_{c}")
    exact = fx.safe_divide(fx.safe_cast(total, WORK), n).cast(T.DecimalType(38, 13))
    return F.coalesce(fx.money(exact), fx.money(fx.safe_divide(total, n)))


def _report(partials: DataFrame, groups: Sequence[str], turnover_name: str) -> DataFrame:
    return partials.groupBy(*groups).agg(
        fx.money(_total("total_estimated_trade_volume_usd")).alias("total_estimated_trade_volume_usd"),
        _total("ask_count").alias("total_active_supply"),
        _total("units_sold").alias("total_units_sold"),
        fx.safe_divide(_total("units_sold"), _total("ask_count")).alias(turnover_name),
        _mean("bid_ask_spread_pct").alias("avg_bid_ask_spread_pct"))


def rpt_market_metrics_daily(partials: DataFrame) -> DataFrame:
    return _report(partials, ["market_date"], "market_turnover_rate")


def rpt_commodity_velocity_daily(partials: DataFrame) -> DataFrame:
    return _report(partials, ["is_commodity", "market_date"], "group_turnover_rate")


# --- late sales -----------------------------------------------------------------------

def changed_rows(fct: DataFrame, daily: DataFrame, keys: DataFrame) -> DataFrame:
    """The fact rows of some (item_name, day) keys whose sales are no longer those of `daily`: structs `before`, `after`.

    A key without a fact row changes nothing. Of the fact, only what the model takes from the listing is
    used again; the rest is worked out by the model itself.
    """
    listed = fct.join(keys, (fct["item_name"] == keys["item_name"]) & (fct["market_date"] == keys["day"]), "left_semi")
    after = m.fct_market_daily(listed.withColumnRenamed("market_date", "snapshot_date"), daily).alias("a")
    pairs = listed.alias("b").join(after, (F.col("a.item_name") == F.col("b.item_name"))
                                   & (F.col("a.market_date") == F.col("b.market_date")))
    same = reduce(Column.__and__, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in SALES])
    return pairs.where(~same).select(
        *[F.struct(*[F.col(f"{side}.{c}").alias(c) for c in m.FCT_COLUMNS]).alias(name)
          for side, name in (("b", "before"), ("a", "after"))])


def finish_change(spark: SparkSession, root: str, column: str = "market_date") -> None:
    """Move in a change that is written as a whole (`_change`); drop one that is not (`_change_next`).

    Each day folder takes the place of the table's. What has been moved is gone from the change, so a run
    that was cut short, also between dropping the old folder and moving the new, goes on where it stopped.
    """
    fs.delete(spark, f"{root}/_change_next")
    for name in fs.children(spark, f"{root}/_change"):
        for day in inc.partition_values(spark, f"{root}/_change/{name}", column):
            fs.delete(spark, f"{root}/{name}/{column}={day}")
            fs.move(spark, f"{root}/_change/{name}/{column}={day}", f"{root}/{name}/{column}={day}")
    fs.delete(spark, f"{root}/_change")


def correct_late_sales(spark: SparkSession, root: str, fct: DataFrame, daily: DataFrame, keys: DataFrame,
                       before: _dt.date) -> dict:
    """Bring the sales of `keys` (item_name, day) on days earlier than `before` into the fact, its day
    aggregates (`day_partials`) and the two daily reports under `root`.

    Only days that hold a row which really changes are written. Their aggregates are corrected by difference: of the
    fact's rows, just the changed ones are aggregated.
    """
    keys = materialize(keys.where(F.col("day") < fx.as_date(before)).distinct(), "late-keys")
    days = sorted(r[0] for r in keys.select("day").distinct().collect())  # at most one per day of data
    if not days:
        return {"days": []}
    rows = fct.where(inc.in_partitions("market_date", days))
    months = sorted({d.replace(day=1) for d in days})
    changed = materialize(changed_rows(rows, daily.where(inc.in_partitions("price_month", months)), keys), "late-rows")
    days = sorted(r[0] for r in changed.select("after.market_date").distinct().collect())
    if not days:
        return {"days": []}
    old, new = changed.select("before.*"), changed.select("after.*")
    rest = rows.where(inc.in_partitions("market_date", days)).join(new, ["item_name", "market_date"], "left_anti")
    # rows without an item name match no key and stay
    whole_days = rest.select(*m.FCT_COLUMNS).unionByName(new)
    stored = set(inc.partition_values(spark, f"{root}/day_partials", "market_date"))
    kept = [d for d in days if d.isoformat() in stored]   # days that the reports hold
    in_reports = inc.in_partitions("market_date", kept)
    partials = spark.read.schema(day_partials(fct).schema).parquet(f"{root}/day_partials").where(in_reports)
    partials = materialize(corrected(partials, old.where(in_reports), new.where(in_reports)), "late-partials")
    aside = f"{root}/_change_next"
    fs.delete(spark, aside)
    for name, df, cluster in (("fct_market_daily", whole_days, ["item_name"]), ("day_partials", partials, ["is_commodity"]),
                              ("rpt_market_metrics_daily", rpt_market_metrics_daily(partials), []),
                              ("rpt_commodity_velocity_daily", rpt_commodity_velocity_daily(partials), ["is_commodity"])):
        write_table(df, f"{aside}/{name}", ["market_date"], cluster, dynamic=False)
    fs.move(spark, aside, f"{root}/_change")
    finish_change(spark, root)
    return {"days": days}
