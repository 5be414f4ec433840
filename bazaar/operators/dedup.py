"""Keyed top-1 selection (the QUALIFY row_number() = 1 pattern).

Spark 4 plans `row_number() = 1` / `rank() = 1` directly on top of a window as a
WindowGroupLimit, and inserts a *partial* limit before the shuffle: every map task
keeps at most one row (ties for rank) per key, so a key holding a third of all rows
still ships only one row per map task. No self-join, no collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.scalar import col_of


def _desc(c) -> Column:
    return c if isinstance(c, Column) else F.col(c).desc_nulls_last()


def by_width(df: DataFrame) -> DataFrame:
    """The columns in an order in which moved rows compress best: fixed widths, then texts, then wide decimals."""
    def width(f: T.StructField) -> int:
        return 1 if isinstance(f.dataType, T.StringType) else 2 if isinstance(f.dataType, T.DecimalType) else 0
    return df.select(*[F.col(f"`{f.name}`") for f in sorted(df.schema.fields, key=width)])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence, tiebreak: Sequence[str] | str | None = "rest",
               rank_col: str = "__rn") -> DataFrame:
    """One row per `keys`, the first by `order` (strings mean DESC NULLS LAST).

    `tiebreak="rest"` appends every other column DESC so the choice among tied rows
    is deterministic (the warehouse left it arbitrary). Pass a list to choose the
    tie-break columns, or None to keep the bare order.
    """
    order_cols = [_desc(c) for c in order]
    if tiebreak == "rest":
        used = set(keys) | {c for c in order if isinstance(c, str)}
        order_cols += [F.col(c).desc_nulls_last() for c in df.columns if c not in used]
    elif tiebreak:
        order_cols += [_desc(c) for c in tiebreak]
    w = Window.partitionBy(*[col_of(k) for k in keys]).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def keep_top_ties(df: DataFrame, keys: Sequence[str], order: Sequence, rank_col: str = "__rk") -> DataFrame:
    """All rows tied for first place per key (rank() = 1)."""
    w = Window.partitionBy(*[col_of(k) for k in keys]).orderBy(*[_desc(c) for c in order])
    return df.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) == 1).drop(rank_col)
