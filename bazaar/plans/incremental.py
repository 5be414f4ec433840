"""Incremental materialisation: marks, insert-overwrite of partitions, state commit.

* The table-level mark (`max(partition column)` of the target) is resolved once
  before the build and passed as a literal, so the source scans prune partitions.
* Day-partitioned models recompute days >= mark (inclusive: the newest day is
  rebuilt, so a re-run is idempotent). The result is written aside and its partitions are swapped in; a
  recomputed day without rows loses its partition.
* The staged tables hold the newest row per key. A load merges into the partitions that it touches; the raw
  tables are ranked again for replaced attempts only, and for their partitions only.
* The month-partitioned daily history recomputes the (item, day) keys of the new load
  from the raw points of the months it touches, and merges them with those months'
  other rows, so a month is never overwritten with a partial recompute and late
  history of new items is aggregated (README, D1/D11). The months are a literal
  bound below the deduplication: other months are not scanned.
* Per-key marks of the extractor are committed after the data, and can always be
  re-derived from the data (max date per key), so a crash between the two writes
  loses nothing. A state counts only when its job has marked it complete.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar import schemas
from bazaar.operators.dedup import keep_first
from bazaar.session import materialize
from bazaar.sources import folders as fs
from bazaar.sources.sinks import write_table

EPOCH = _dt.date(1970, 1, 1)


class PartitionFilterRequired(ValueError):
    """A read of a guarded table without a bound on its partition column."""


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def partition_values(spark: SparkSession, path: str, column: str, complete: bool = False) -> list[str]:
    """Values of a top-level partition column, read from the directory names only.

    `complete`: only folders written by a job of their own that has ended (they hold `_SUCCESS`).
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix) and name != prefix + "__HIVE_DEFAULT_PARTITION__":
            if complete and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                continue
            # partition paths escape special characters as %XX (and nothing else)
            out.append(re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m.group(1), 16)), name[len(prefix):]))
    return out


def table_mark(spark: SparkSession, path: str, column: str) -> _dt.date | None:
    """max(column) of a materialised table; None when the table does not exist or is empty.

    For a partition column the answer comes from the directory listing (no job, no
    file footers), which stays cheap however many files a partition holds.
    """
    if not path_exists(spark, path):
        return None
    values = partition_values(spark, path, column)
    if values:
        return _dt.date.fromisoformat(max(values)[:10])
    return spark.read.parquet(path).agg(F.max(column)).first()[0]


def incremental_since(mark: _dt.date | None, lookback_days: int = 0) -> _dt.date:
    """coalesce(mark, 1970-01-01) - lookback (inclusive lower bound)."""
    base = mark or EPOCH
    return base - _dt.timedelta(days=int(lookback_days))


def require_bound(df: DataFrame, path: str, column: str) -> DataFrame:
    """Refuse a query whose plan scans the table at `path` without a partition filter on `column`.

    What counts is what reaches the scan, however the query is written: a bound behind a projection, an aggregate by
    day or a view passes, one on another column, or one that other rows get around by OR, does not. "Is not
    null" is no bound.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    table = jvm.org.apache.hadoop.fs.Path(path)
    table = table.getFileSystem(conf).makeQualified(table).toString().rstrip("/")
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() != "FileSourceScanExec":
            continue
        roots = leaf.relation().location().rootPaths()
        roots = [roots.apply(i).toString() for i in range(roots.size())]
        if not any(r == table or r.startswith(f"{table}/") for r in roots):
            continue
        filters = leaf.partitionFilters()
        bound = False
        for f in (filters.apply(i) for i in range(filters.size())):
            names = f.references().toSeq()
            names = {names.apply(i).name() for i in range(names.size())}
            bound = bound or (column in names and f.getClass().getSimpleName() != "IsNotNull")
        if not bound:
            raise PartitionFilterRequired(f"reading {path} requires a filter on {column}")
    return df


def read_guarded(spark: SparkSession, path: str, column: str, lower=None, upper=None,
                 required: bool = True, schema: T.StructType | None = None,
                 build: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Read a partitioned table, or the query that `build` makes of it; refuse an unbounded read when `required`.

    Accepts the bounds used by the reports, `column >= lower` and optionally
    `column <= upper`; both literals, so the scan prunes partitions. Whatever bounds the read, the plan must show
    it (`require_bound`).
    """
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if lower is not None:
        df = df.where(F.col(column) >= F.lit(str(lower)).cast("date"))
    if upper is not None:
        df = df.where(F.col(column) <= F.lit(str(upper)).cast("date"))
    if build is not None:
        df = build(df)
    return require_bound(df, path, column) if required else df


def publish_partitions(df: DataFrame, target: str, partition_col: str, recomputed: Callable[[_dt.date], bool],
                       cluster_by: Sequence[str] = (), **how) -> list[_dt.date]:
    """Replace the date partitions that `recomputed` names by the rows of `df`, written aside first.

    `df` may read the target. A recomputed partition without rows goes. Each partition is swapped on its own:
    a crash in between is mended by running again. `how` goes to `write_table`.
    """
    spark, aside = df.sparkSession, f"{target.rstrip('/')}/_next"
    fs.delete(spark, aside)
    write_table(df, aside, [partition_col], cluster_by, mode="overwrite", dynamic=False, **how)
    fresh = partition_values(spark, aside, partition_col)
    for day in partition_values(spark, target, partition_col):
        if day in fresh or recomputed(_dt.date.fromisoformat(day)):
            fs.delete(spark, f"{target}/{partition_col}={day}")
    for day in fresh:
        fs.move(spark, f"{aside}/{partition_col}={day}", f"{target}/{partition_col}={day}")
    fs.delete(spark, aside)
    return sorted(_dt.date.fromisoformat(d) for d in fresh)


def materialize_incremental(spark: SparkSession, target: str, build: Callable[[_dt.date | None], DataFrame],
                            partition_col: str, cluster_by: Sequence[str] = (), lookback_days: int = 0,
                            reach_back: _dt.date | None = None, **how) -> dict:
    """Build and write a day-partitioned model.

    First run (no target): `build(None)` is the full refresh, written whole.
    Later runs: `build(since)` with since = coalesce(max(partition_col), 1970-01-01)
    - lookback, or `reach_back` where that is earlier (the first day of loads that come late); the days from there on are
    replaced. `how` goes to `write_table`.
    """
    mark = table_mark(spark, target, partition_col)
    if mark is None:
        fs.swap_table(spark, target, lambda out: write_table(build(None), out, [partition_col], cluster_by, dynamic=False,
                                                             **how))
        return {"mode": "full", "since": None}
    since = incremental_since(mark, lookback_days)
    if reach_back is not None:
        since = min(since, reach_back)
    publish_partitions(build(since), target, partition_col, lambda day: day >= since, cluster_by, **how)
    return {"mode": "incremental", "since": since}


def in_partitions(column: str, days: Sequence[_dt.date]) -> Column:
    """Literal dates, so that the scan prunes partitions."""
    return F.col(column).isin([F.lit(str(d)).cast("date") for d in days]) if days else F.lit(False)


def materialize_newest(spark: SparkSession, target: str, raw: Callable[[Sequence[_dt.date] | None], DataFrame],
                       fresh: DataFrame | None, keys: Sequence[str], order: Sequence[str], partition_col: str,
                       tiebreak: str | None = "rest", cluster_by: Sequence[str] = (),
                       stale: Sequence[_dt.date] = ()) -> dict:
    """Keep a table of the newest row per key, in date partitions that the key decides.

    `raw(dates)` reads all rows of some partitions (None: of all), `fresh` holds those not merged yet (None, or no
    target: everything is ranked). A load's rows meet the kept rows of the partitions that they fall into, and nothing
    else is read. The partitions in `stale` are those of rows that are gone; they alone are ranked again from
    `raw`. Rows without a value in `partition_col` are not kept. Merging equals ranking all rows, in whatever order
    loads arrive, since the first of a key among all rows is the first among the kept one and the new ones.
    """
    dated = F.col(partition_col).isNotNull()
    if fresh is None or table_mark(spark, target, partition_col) is None:
        newest = keep_first(raw(None).where(dated), keys, order, tiebreak=tiebreak)
        fs.swap_table(spark, target, lambda out: write_table(newest, out, [partition_col], cluster_by, dynamic=False))
        return {"mode": "full", "partitions": None}
    fresh = fresh.where(dated)
    touched = sorted(r[0] for r in fresh.select(partition_col).distinct().collect())  # dates, one per day or month
    merged = [d for d in touched if d not in set(stale)]
    if not merged and not stale:
        return {"mode": "incremental", "partitions": []}
    kept = spark.read.schema(fresh.schema).parquet(target).where(in_partitions(partition_col, merged))
    rows = kept.select(*fresh.columns).unionByName(fresh.where(in_partitions(partition_col, merged)))
    if stale:
        rows = rows.unionByName(raw(stale).where(in_partitions(partition_col, stale)))
    again = {*merged, *stale}
    publish_partitions(keep_first(rows, keys, order, tiebreak=tiebreak), target, partition_col, again.__contains__, cluster_by)
    return {"mode": "incremental", "partitions": sorted(again)}


def touched_months(new_history: DataFrame, ts_col: str = "priced_at") -> list[_dt.date]:
    """Months (first days) that a batch of history rows falls into: at most 12 per year of data."""
    month = F.trunc(F.to_date(F.col(ts_col)), "MM").alias("month")
    return sorted(r["month"] for r in new_history.select(month).distinct().collect() if r["month"] is not None)


def in_months(months: Sequence[_dt.date], ts_col: str) -> Column:
    """Literal bounds on a timestamp, one range per run of consecutive months; they reach the scan."""
    def after(m: _dt.date) -> _dt.date:
        return _dt.date(m.year + m.month // 12, m.month % 12 + 1, 1)

    runs: list[list[_dt.date]] = []
    for m in sorted(months):
        if runs and runs[-1][1] == m:
            runs[-1][1] = after(m)
        else:
            runs.append([m, after(m)])
    out = F.lit(False)
    for lo, hi in runs:
        out = out | ((F.col(ts_col) >= F.lit(str(lo)).cast("timestamp")) & (F.col(ts_col) < F.lit(str(hi)).cast("timestamp")))
    return out


#: Buckets of a dimension: a constant of the stored table, sized for some hundred million keys at 100 MB a bucket.
DIM_BUCKETS = 64


def materialize_buckets(spark: SparkSession, target: str, whole: DataFrame, fresh: DataFrame | None, key: str,
                        upsert: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
                        buckets: int = DIM_BUCKETS) -> dict:
    """Keep a keyed table partitioned by a hash bucket of its key, column `key_bucket`.

    `fresh` None (or no target): `whole` replaces the table. Otherwise `upsert(current, fresh)` is worked out
    for the buckets that `fresh` falls into; the files of the others stay as they are. Each bucket is written aside and
    swapped in.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    if fresh is None or not path_exists(spark, target):
        fs.swap_table(spark, target, lambda out: write_table(whole.withColumn("key_bucket", bucket), out, ["key_bucket"], [key],
                                                             dynamic=False))
        return {"mode": "full", "buckets": None}
    fresh = materialize(fresh.withColumn("key_bucket", bucket), "fresh-keys")
    touched = sorted(r[0] for r in fresh.select("key_bucket").distinct().collect())  # at most `buckets` numbers
    if not touched:
        return {"mode": "incremental", "buckets": []}
    current = spark.read.schema(fresh.schema).parquet(target).where(F.col("key_bucket").isin(touched))
    merged = upsert(current.drop("key_bucket"), fresh.drop("key_bucket")).withColumn("key_bucket", bucket)
    aside = f"{target.rstrip('/')}/_next"
    fs.delete(spark, aside)
    write_table(merged, aside, ["key_bucket"], [key], mode="overwrite", dynamic=False)
    for b in partition_values(spark, aside, "key_bucket"):
        fs.delete(spark, f"{target}/key_bucket={b}")
        fs.move(spark, f"{aside}/key_bucket={b}", f"{target}/key_bucket={b}")
    fs.delete(spark, aside)
    return {"mode": "incremental", "buckets": touched}


def materialize_monthly(spark: SparkSession, target: str, history_raw: DataFrame, new_history: DataFrame | None,
                        cluster_by: Sequence[str] = ("item_name",), kept: DataFrame | None = None) -> dict:
    """The daily history model, partitioned by month, from the raw history.

    `new_history` None (or no target yet): a full refresh, which replaces the whole table. Otherwise the
    (item, day) keys of `new_history` (staged rows of the new loads and of replaced attempts) are recomputed from the
    points of their months, merged with the target's other rows of those months, and these partitions are replaced.
    The points come from `kept`, the staged table of the newest row per key with its `price_month`, where it is given, and
    from the raw history otherwise.
    """
    from bazaar.plans.models import int_item_price_history_daily, stg_item_price_history

    if kept is not None:
        every = kept.drop("price_month")
    else:
        every = stg_item_price_history(history_raw)
    exists = table_mark(spark, target, "price_month") is not None
    if not exists or new_history is None:
        out = int_item_price_history_daily(every)
        out = out.withColumn("price_month", F.trunc("price_date", "MM"))
        fs.swap_table(spark, target, lambda aside: write_table(out, aside, ["price_month"], cluster_by, dynamic=False))
        return {"mode": "full", "months": None}
    months = touched_months(new_history)
    if not months:
        return {"mode": "incremental", "months": []}
    keys = new_history.select(F.col("item_name").alias("__item"), F.to_date("priced_at").alias("__day")).distinct()
    keys = materialize(keys, "touched-keys")

    def is_key(item: str, day: Column) -> Column:
        return F.col(item).eqNullSafe(F.col("__item")) & (day == F.col("__day"))

    if kept is not None:
        points = kept.where(in_partitions("price_month", months)).drop("price_month").join(
            keys, is_key("item_name", F.to_date("priced_at")), "left_semi")
    else:
        # the bound is on the raw column and below the deduplication, whose key (item, instant) lies within a month
        points = stg_item_price_history(history_raw.where(in_months(months, "date")).join(
            keys, is_key("market_hash_name", F.to_date("date")), "left_semi"))
    fresh = int_item_price_history_daily(points)
    fresh = fresh.withColumn("price_month", F.trunc("price_date", "MM"))
    old = spark.read.schema(fresh.schema).parquet(target).where(in_partitions("price_month", months))
    old = old.join(keys, is_key("item_name", F.col("price_date")), "left_anti")
    publish_partitions(old.unionByName(fresh), target, "price_month", set(months).__contains__, cluster_by)
    return {"mode": "incremental", "months": months}


# --- per-key extraction state ---------------------------------------------------------

def with_load_id(schema: T.StructType, part_col: str = "load_id") -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(part_col, T.StringType())])


def read_loads(spark: SparkSession, path: str, schema: T.StructType, part_col: str = "load_id",
               within: tuple[str, Sequence[_dt.date]] | None = None) -> DataFrame:
    """Read a table partitioned by load id (and maybe more); the id stays text (no type
    inference), so fixed-width ids keep their order. `within` = (`_day` or `_month`, dates) reads those partitions only."""
    full = with_load_id(schema, part_col)
    if within is None:
        return spark.read.schema(full).parquet(path).select(*schema.fieldNames(), part_col)
    rows = spark.read.schema(T.StructType([*full.fields, T.StructField(within[0], T.DateType())])).parquet(path)
    return rows.where(in_partitions(*within)).select(*schema.fieldNames(), part_col)


def state_from_data(history: DataFrame, key: str = "market_hash_name", ts_col: str = "date",
                    grain: str = "day") -> DataFrame:
    """Recovery: the mark of each key is the newest day (hour grain: instant) in the loaded data."""
    newest = F.max(F.col(ts_col))
    return history.groupBy(F.col(key)).agg((newest if grain == "hour" else F.to_date(newest)).alias("last_seen"))


#: Committed states that stay; older ones are dropped after a commit.
KEEP_STATES = 3


def commit_state(state: DataFrame, state_root: str, load_id: str, part_col: str = "load_id",
                 keep: int = KEEP_STATES) -> str:
    """Write the state of one load after its data, as a job of its own: its folder, named by the load, is complete
    once it holds `_SUCCESS`. Then drop all but the newest `keep` states (of ids up to this load's)."""
    spark = state.sparkSession
    root = state_root.rstrip("/")
    out = f"{root}/{part_col}={load_id}"
    state.write.mode("overwrite").parquet(out)
    done = partition_values(spark, root, part_col, complete=True)
    older = sorted((v for v in done if _order(v) <= _order(load_id)), key=_order)[:-keep]
    jvm = spark.sparkContext._jvm
    for v in older:
        p = jvm.org.apache.hadoop.fs.Path(f"{root}/{part_col}={v}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return out


def _order(load_id) -> tuple:
    """Numbers (batch ids) by value, other ids as text."""
    v = str(load_id)
    return (0, int(v), "") if v.isdigit() and str(int(v)) == v else (1, 0, v)


def state_at(spark: SparkSession, state_root: str, load_id: str, grain: str, part_col: str = "load_id") -> DataFrame:
    return spark.read.schema(schemas.state_schema(grain)).parquet(f"{state_root.rstrip('/')}/{part_col}={load_id}")


def read_state(spark: SparkSession, state_root: str, data: DataFrame | None = None,
               before_load_id: str | None = None, key: str = "market_hash_name",
               grain: str = "day", data_path: str | None = None) -> DataFrame | None:
    """The per-key marks a load must start from: the newest state committed by an
    *earlier* load (so a replayed load sees exactly what its first run saw). A folder
    whose job did not end does not count.

    If the data holds a newer earlier load than the newest state (a crash between
    the data write and the state write), the marks are derived from that data.
    `data` must carry the `load_id` partition column. Which loads exist is read from
    the folder listing (state always; data when `data_path` is given), not by a job.
    """
    def earlier(ids):
        return [i for i in ids if before_load_id is None or i < before_load_id]

    prior = None
    if data is not None:
        prior = data if before_load_id is None else data.where(F.col("load_id") < F.lit(before_load_id))
    state_ids = earlier(partition_values(spark, state_root, "load_id", complete=True))
    latest = max(state_ids) if state_ids else None
    if data_path is not None:
        data_ids = earlier(partition_values(spark, data_path, "load_id"))
        data_latest = max(data_ids) if data_ids else None
    else:
        data_latest = prior.agg(F.max("load_id")).first()[0] if prior is not None else None
    if latest is not None and (data_latest is None or latest >= data_latest):
        return state_at(spark, state_root, latest, grain)
    if data_latest is not None and prior is not None:
        return state_from_data(prior, key, grain=grain)
    return None
