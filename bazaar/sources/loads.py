"""Loads as units: a ledger of the stage each has reached, and attempts that replace each other whole.

A load writes every table aside and swaps its folder `load_id=<id>` in, also when the attempt has no rows; nothing of
an earlier attempt stays. The folder that is replaced is kept under `_retired`, out of the readers' sight, until the
load is modelled again: its keys tell which rows of the models the first attempt had shaped.

The ledger holds one small row per load and stage, each in a folder of its own that counts once its job has ended.
`extracted` is written after the load's data and marks, `modelled` after the models; a load between the two is
pending, whatever stopped it (a gate, a crash), and the next run models all pending loads.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.plans.incremental import partition_values, read_loads
from bazaar.sources import folders as fs
from bazaar.sources.sinks import write_table

EXTRACTED, MODELLED = "extracted", "modelled"


class Ledger:
    """Which loads have reached which stage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _place(self, stage: str, load_id: str) -> str:
        return f"{self.root}/stage={stage}/load_id={load_id}"

    def reached(self, stage: str) -> list[str]:
        """Loads that have reached a stage, from the folder listing (no job)."""
        return sorted(partition_values(self.spark, f"{self.root}/stage={stage}", "load_id", complete=True))

    def mark(self, load_id: str, stage: str, run_ts: _dt.datetime | None = None, failed_pages: int | None = None) -> None:
        row = self.spark.createDataFrame([(run_ts, failed_pages)], "run_ts timestamp, failed_pages bigint")
        row.coalesce(1).write.mode("overwrite").parquet(self._place(stage, load_id))

    def reopen(self, load_id: str) -> None:
        """Before a load is written anew: it has reached nothing."""
        for stage in (MODELLED, EXTRACTED):
            fs.delete(self.spark, self._place(stage, load_id))

    def pending(self) -> list[str]:
        """Loads whose data are complete and not yet in the models, oldest first."""
        done = set(self.reached(MODELLED))
        return [x for x in self.reached(EXTRACTED) if x not in done]

    def unfinished(self, path: str) -> list[str]:
        """Loads with a folder in a raw table whose extraction has not ended."""
        done = set(self.reached(EXTRACTED))
        return [x for x in partition_values(self.spark, path, "load_id") if x not in done]

    def table(self) -> DataFrame:
        """(load_id, stage, run_ts, failed_pages), one row per load and stage."""
        schema = "run_ts timestamp, failed_pages bigint, stage string, load_id string"
        return self.spark.read.schema(schema).parquet(self.root)


def settle(spark: SparkSession, path: str) -> None:
    """Finish swaps that a crash cut short: an attempt that is written whole takes its free place."""
    for name in fs.children(spark, f"{path}/_attempt"):
        if fs.finished(spark, f"{path}/_attempt/{name}") and not fs.exists(spark, f"{path}/{name}"):
            fs.move(spark, f"{path}/_attempt/{name}", f"{path}/{name}")
    fs.delete(spark, f"{path}/_attempt")


def publish_load(df: DataFrame, path: str, load_id: str, stamp: str | None = None, by: str = "day",
                 cluster_by: tuple[str, ...] = (), finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write one load's rows as a unit, partitioned by the day or month of `stamp` and clustered.

    Whatever an earlier attempt left is set aside as a whole, also when `df` is empty. `finish` is that of `write_table`.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    attempt, place = f"{path}/_attempt/load_id={load_id}", f"{path}/load_id={load_id}"
    parts = []
    if stamp is not None:
        df = df.withColumn(f"_{by}", F.to_date(stamp) if by == "day" else F.trunc(F.to_date(stamp), "MM"))
        parts = [f"_{by}"]
    write_table(df, attempt, parts, cluster_by, mode="overwrite", dynamic=False, finish=finish)
    if fs.exists(spark, place):
        kept = f"{path}/_retired/load_id={load_id}"
        fs.move(spark, place, f"{kept}/attempt={len(fs.children(spark, kept))}")
    fs.move(spark, attempt, place)


def retired(spark: SparkSession, path: str, schema: T.StructType, load_ids: Sequence[str]) -> DataFrame | None:
    """The rows of replaced attempts of these loads; None where there are none."""
    kept = [f"{path}/_retired/load_id={x}" for x in load_ids if fs.exists(spark, f"{path}/_retired/load_id={x}")]
    return spark.read.schema(schema).parquet(*kept) if kept else None


def forget_retired(spark: SparkSession, path: str, load_ids: Sequence[str]) -> None:
    for x in load_ids:
        fs.delete(spark, f"{path}/_retired/load_id={x}")


def read_finished(spark: SparkSession, path: str, schema: T.StructType, ledger: Ledger,
                  only: Sequence[str] | None = None, within: tuple[str, Sequence[_dt.date]] | None = None) -> DataFrame:
    """A raw table without the loads whose extraction has not ended, with their load ids.

    `only` names loads, `within` the days or months (`_day`, `_month`) to read; both prune the partitions.
    """
    rows, out = read_loads(spark, path, schema, within=within), ledger.unfinished(path)
    if only is not None:
        rows = rows.where(F.col("load_id").isin(list(only)))
    return rows.where(~F.col("load_id").isin(out)) if out else rows


def days_of(spark: SparkSession, path: str, load_ids: Sequence[str], column: str = "_day") -> list[_dt.date]:
    """The days or months that loads hold, replaced attempts included, from the folder listing."""
    out = set()
    for x in load_ids:
        tries = [f"{path}/load_id={x}", *(f"{path}/_retired/load_id={x}/{a}"
                                          for a in fs.children(spark, f"{path}/_retired/load_id={x}"))]
        out |= {_dt.date.fromisoformat(v) for t in tries for v in partition_values(spark, t, column)}
    return sorted(out)
