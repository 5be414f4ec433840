"""Wide-to-long reshaping and share-of-total."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.session import materialize


def unpivot(df: DataFrame, ids: Sequence[str], measures: Mapping[str, str], name: str = "metric_type",
            value: str = "value", keep_nulls: bool = False, as_type: T.DataType = T.DoubleType()) -> DataFrame:
    """Wide to long: one row per (id row, measure) with `measures` = {column: label}.

    Measures are cast to one type first. SQL UNPIVOT drops NULL values by default,
    DataFrame.unpivot keeps them; `keep_nulls=False` gives the SQL behaviour.
    A narrow per-row expansion (Expand), no shuffle.
    """
    staged = df.select(*[F.col(i) for i in ids],
                       *[F.col(c).cast(as_type).alias(label) for c, label in measures.items()])
    long = staged.unpivot(list(ids), list(measures.values()), name, value)
    if not keep_nulls:
        long = long.where(F.col(value).isNotNull())
    return long


def share_of_total(df: DataFrame, value: str, within: Sequence[str], out: str = "share") -> DataFrame:
    """value / sum(value) over rows with the same `within` key (stacked bars to 100 %),
    via a pre-aggregated total joined back.

    The input is written once and read for the totals and for the join, so whatever it takes to make it is done
    once. The totals are aggregated map-side (one row per key and task), and the join back is one
    of two plain sides: Spark broadcasts the totals while they are small, and splits a hot key otherwise.
    """
    df = materialize(df, "share-rows")
    totals = df.groupBy(*within).agg(F.sum(F.col(value)).alias("__total"))
    # the join is null-safe on the group keys so a NULL group gets its own total
    t = totals.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(within)], "__total")
    cond = None
    for i, c in enumerate(within):
        e = df[c].eqNullSafe(F.col(f"__k{i}"))
        cond = e if cond is None else cond & e
    joined = df.join(t, cond, "left")
    return (joined.withColumn(out, F.try_divide(F.col(value), F.col("__total")))
            .drop("__total", *[f"__k{i}" for i in range(len(within))]))
