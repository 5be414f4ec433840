"""Data tests (not_null, unique, scoped tests), build gates and schema contracts.

A test is a query that returns the failing rows' count. All not_null checks of a
table run in one pass (one aggregate with a conditional count per column); a
unique check is a group-by with partial aggregation, so a hot value is counted
map-side. Results are a small frame: one row per test.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.scalar import date_sub_days

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("test", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("failures", T.LongType()),
])


def recent_scope(column: str = "market_date", as_of=None, days: int = 1) -> Column:
    """`column >= DATE_SUB(as_of, INTERVAL days DAY)`; as_of None means current_date()."""
    return F.col(column) >= date_sub_days(as_of, days)


def not_null_failures(df: DataFrame, model: str, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """One row per column: how many rows have NULL there (all columns in one pass)."""
    scoped = df if where is None else df.where(where)
    counts = scoped.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit("not_null").alias("test"), F.lit(c).alias("column_name"),
                 F.col(c).cast("bigint").alias("failures")) for c in columns])).alias("r")).select("r.*")


def unique_failures(df: DataFrame, model: str, column: str, where: Column | None = None) -> DataFrame:
    """Number of non-null values that occur more than once."""
    scoped = df if where is None else df.where(where)
    dup = (scoped.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
           .agg(F.count(F.lit(1)).cast("bigint").alias("failures")))
    return dup.select(F.lit(model).alias("model"), F.lit("unique").alias("test"), F.lit(column).alias("column_name"),
                      F.col("failures"))


@dataclass
class TableTests:
    model: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    scope: str | None = None   # "recent": only rows of the last day (market_date >= as_of - 1)
    scope_column: str = "market_date"
    extra: dict = field(default_factory=dict)


# The declared data tests (19: 16 not_null, 3 unique), by model.
DECLARED_TESTS = [
    TableTests("int_item_price_history_daily", not_null=["item_name", "price_date"]),
    TableTests("dim_item", not_null=["item_name", "snapshot_date"], unique=["item_name"]),
    TableTests("fct_market_daily", not_null=["item_name", "ask_count", "ask_price_usd", "bid_price_usd", "units_sold",
                                             "total_estimated_trade_volume_usd", "market_date"], scope="recent"),
    TableTests("rpt_commodity_velocity_daily", not_null=["is_commodity", "market_date"]),
    TableTests("rpt_item_metrics_latest", not_null=["item_name", "market_date"], unique=["item_name"]),
    TableTests("rpt_market_metrics_daily", not_null=["market_date"], unique=["market_date"]),
]


def table_failures(df: DataFrame, t: TableTests, where: Column | None = None) -> DataFrame:
    """All tests of one table from one read of it.

    With unique tests, the rows are counted by each of those values (partial aggregation first), the null counts
    riding along, so that neither test reads the table again.
    """
    scoped = df if where is None else df.where(where)
    if len(t.unique) != 1:
        parts = [not_null_failures(df, t.model, t.not_null, where)] if t.not_null else []
        return reduce(DataFrame.unionByName, parts + [unique_failures(df, t.model, c, where) for c in t.unique])
    value = t.unique[0]
    nulls = [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"__n{i}") for i, c in enumerate(t.not_null)]
    per = scoped.groupBy(F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__rows"), *nulls)
    one = per.agg(F.count(F.when(F.col("__v").isNotNull() & (F.col("__rows") > 1), F.lit(1))).alias("__dup"),
                  *[F.coalesce(F.sum(f"__n{i}"), F.lit(0)).alias(f"__n{i}") for i in range(len(t.not_null))])
    rows = [("not_null", c, f"__n{i}") for i, c in enumerate(t.not_null)] + [("unique", value, "__dup")]
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(t.model).alias("model"), F.lit(test).alias("test"), F.lit(c).alias("column_name"),
                 F.col(at).cast("bigint").alias("failures")) for test, c, at in rows])).alias("r")).select("r.*")


def run_tests(tables: Mapping[str, DataFrame], tests: Sequence[TableTests] = DECLARED_TESTS,
              as_of: _dt.date | None = None) -> DataFrame:
    """Union of all test results (model, test, column_name, failures), one pass per table."""
    parts = []
    for t in tests:
        if t.model in tables and (t.not_null or t.unique):
            where = recent_scope(t.scope_column, as_of, 1) if t.scope == "recent" else None
            parts.append(table_failures(tables[t.model], t, where))
    if not parts:
        raise ValueError("no tests selected")
    return reduce(DataFrame.unionByName, parts)


class BuildFailed(RuntimeError):
    """At least one data test failed (or the load gate tripped)."""


def gate_build(results: DataFrame) -> None:
    """Fail the run when any test has failures. The results frame is one row per test."""
    failed = [r.asDict() for r in results.where(F.col("failures") > 0).collect()]
    if failed:
        raise BuildFailed(f"{len(failed)} data test(s) failed: {failed}")


#: Outcomes of a page that could not be loaded; a missing page (404) is none.
FAILED_OUTCOMES = ("rate_limited", "forbidden", "failed")


def failed_pages(outcome_counts: DataFrame, failed_outcomes: Sequence[str] = FAILED_OUTCOMES) -> int:
    return (outcome_counts.where(F.col("outcome").isin(*failed_outcomes))
            .agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0])


def gate_load(outcome_counts: DataFrame, max_failed_pages: int | None = 0,
              failed_outcomes: Sequence[str] = FAILED_OUTCOMES, max_failed_share: float | None = None) -> None:
    """Stop before the transforms when the load reported more failed pages, or a larger share of them, than allowed
    (None: any)."""
    n = failed_pages(outcome_counts, failed_outcomes)
    pages = outcome_counts.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    if (max_failed_pages is not None and n > max_failed_pages) or (
            max_failed_share is not None and n > max_failed_share * pages):
        raise BuildFailed(f"load failed for {n} page(s) of {pages}")


class ContractError(ValueError):
    """A report's columns or types differ from its declared contract."""


def check_contract(df: DataFrame, contract: T.StructType, name: str = "report",
                   partitioned_by: Sequence[str] = ()) -> DataFrame:
    """Raise when the columns (order, names, types) differ from the contract; extra columns differ too.

    A table read back from partitions has its partition columns last; `partitioned_by` names those, and the frame
    returned has the contract's order.
    """
    want = [f for f in contract.fields if f.name not in partitioned_by]
    want += [contract[c] for c in partitioned_by]
    if [(f.name, f.dataType) for f in df.schema.fields] != [(f.name, f.dataType) for f in want]:
        raise ContractError(f"{name}: schema {df.schema.simpleString()} != contract {contract.simpleString()}")
    return df.select(*contract.fieldNames()) if partitioned_by else df


def contract_diff(df: DataFrame, contract: T.StructType) -> list[tuple[str, str, str]]:
    """(column, actual type, declared type) for every mismatch; missing side is ''."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in contract.fields}
    out = []
    for c in list(want) + [c for c in have if c not in want]:
        if have.get(c, "") != want.get(c, ""):
            out.append((c, have.get(c, ""), want.get(c, "")))
    return out

