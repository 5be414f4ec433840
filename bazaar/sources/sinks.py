"""Sinks: append, partitioned + clustered writes, report exports, shard merge."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.session import materialize_at, shuffles_freed
from bazaar.sources.folders import delete as _delete
from bazaar.sources.folders import exists as _exists

# Rows per output file; keeps files of a hot partition bounded.
MAX_RECORDS_PER_FILE = 5_000_000
#: The folder of an export that says what was exported.
EXPORTED = "_exported"


class EmptyExportError(RuntimeError):
    """An export folder holds no Parquet shard."""


class ShardSchemaError(ValueError):
    """Parquet shards of one export disagree on their schema."""


def _number(df: DataFrame, column: str) -> Column:
    """A column as a double that keeps its order; texts by their first six bytes."""
    c = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        c = F.conv(head, 16, 10)
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.BooleanType):
        c = c.cast("int")
    return c.cast("double")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """A key that orders rows along a space-filling curve over several columns.

    Each column is cut at 2**bits - 1 of its quantiles, from one aggregation over all rows (of few values, some cuts
    are equal and cell numbers are left out); the bits of the cells' numbers are dealt in turn, so that neighbours on
    the curve are near in every column. Equal numbers share a cell: texts alike in their first six bytes are not told
    apart. Nulls are in cell 0, with the smallest values.
    """
    if not 0 < bits * len(columns) < 64:
        raise ValueError("the key of a space-filling order has 1 to 63 bits")
    shares = [k / 2 ** bits for k in range(1, 2 ** bits)]
    cuts = df.agg(*[F.percentile_approx(_number(df, c), shares, 10_000).alias(f"c{i}")
                    for i, c in enumerate(columns)]).first()

    def cell_of(column: str, at: Sequence[float] | None) -> Column:
        number = _number(df, column)
        passed = F.filter(F.array(*[F.lit(x) for x in at or ()]).cast("array<double>"), lambda x: x < number)
        return F.when(number.isNotNull(), F.size(passed)).otherwise(0)

    key = F.lit(0).cast("bigint")
    cells = [cell_of(c, at) for c, at in zip(columns, cuts)]
    for bit in reversed(range(bits)):
        for cell in cells:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(cell, bit).bitwiseAND(F.lit(1)).cast("bigint"))
    return key


def layout(df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
           interleave: bool = False) -> DataFrame:
    """Shape a frame for a partitioned, clustered write.

    Range-partitioning on (partition columns, cluster columns) sends each task a
    contiguous key range: a task writes few table partitions, and one hot table
    partition (a day holding a third of the rows) is split over many tasks by its
    cluster key instead of landing in one. Sorting inside the task clusters the
    rows, so Parquet min/max statistics skip row groups on the cluster key. The number
    of ranges is left open, so that adaptive execution fits it to the size written.

    That order skips by its first cluster column; `interleave` orders by a space-filling curve over all of them, at the
    cost of one aggregation beforehand, and skips by each.
    """
    keys = list(partition_by) + list(cluster_by)
    if not keys:
        return df
    # a deterministic row hash as the last range key lets the range partitioner split
    # even a single hot (partition, cluster) value over several tasks; being a pure
    # function of the row, a retried task sends every row to the same place
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    if interleave and len(cluster_by) > 1:
        made = df.withColumn("__curve", interleaved(df, cluster_by))
        return (made.repartitionByRange(*[F.col(k) for k in partition_by], F.col("__curve"), spread)
                .sortWithinPartitions(*partition_by, "__curve", *cluster_by).drop("__curve"))
    return (df.repartitionByRange(*[F.col(k) for k in keys], spread)
              .sortWithinPartitions(*keys))


#: The digits of a decimal that moves as one 8-byte number.
NARROW = 18


def narrowed(df: DataFrame, keys: Sequence[str] = ()) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """A frame that moves in fewer bytes, and what makes the rows of it again, to the last digit.

    A wide decimal takes 24 bytes of a moved row, whose values rarely need more than 8. Those that fit move as decimals of
    18 digits and the same scale; a row that has one that does not fit carries its wide decimals beside them. `keys`
    stay as they are.
    """
    wide = [f for f in df.schema.fields if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > NARROW
            and f.dataType.scale <= NARROW and f.name not in keys]
    if not wide:
        return df, lambda rows: rows
    names = {f.name for f in wide}
    short = {f.name: F.col(f"`{f.name}`").try_cast(T.DecimalType(NARROW, f.dataType.scale)) for f in wide}
    too_wide = [F.col(f"`{f.name}`").isNotNull() & short[f.name].isNull() for f in wide]
    moved = df.select(*[short[c].alias(c) if c in names else F.col(f"`{c}`") for c in df.columns],
                      F.when(reduce(Column.__or__, too_wide), F.struct(*[F.col(f"`{f.name}`") for f in wide]))
                      .alias("__wide"))

    def whole(rows: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in wide}
        return rows.select(*[
            F.when(F.col("__wide").isNotNull(), F.col("__wide")[c]).otherwise(F.col(f"`{c}`").cast(types[c])).alias(c)
            if c in types else F.col(f"`{c}`") for c in df.columns])
    return moved, whole


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Append-only load (no dedup): the raw tables."""
    w = df.write.mode("append").format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
                mode: str = "overwrite", dynamic: bool = True, interleave: bool = False,
                finish: Callable[[DataFrame], DataFrame] | None = None, staged: str | None = None) -> None:
    """Materialise a model. With partitions and `dynamic`, only the partitions present
    in `df` are replaced (insert-overwrite); otherwise the table is rebuilt.

    `finish` makes the table's rows of those of `df`, each by itself, once they lie where they are written: columns
    that follow from others need not be moved. It keeps the partition columns. `staged` names a scratch table of the
    rows as they come, for rows that take shuffles to make: these are made once, though a layout takes two looks, and
    gone from disk when the rows move."""
    spark, scratch = df.sparkSession, None
    if staged is not None:
        df, scratch = materialize_at(df, staged, "zstd")
    moved, whole = narrowed(df, [*partition_by, *cluster_by])
    shaped = whole(layout(moved, partition_by, cluster_by, interleave))
    if finish is not None:
        shaped = finish(shaped)
    w = shaped.write.mode(mode).format("parquet").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    w = w.option("compression", "zstd")   # decimals and row ids take much less than by the default
    if partition_by:
        w = w.partitionBy(*partition_by)
        w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    with shuffles_freed(spark):
        w.save(path)
    if scratch is not None:
        _delete(spark, scratch)


def export_parquet(df: DataFrame, root: str, name: str) -> str:
    """Post-build export of a report: SELECT * to `<root>/<name>/`, overwrite.

    Beside the shards, out of the readers' sight, stands what was exported: the schema and the shards' names.
    """
    out = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(out)
    spark = df.sparkSession
    shards = [(df.schema.json(), f.rsplit("/", 1)[1]) for f in _parquet_files(spark, out)]
    spark.createDataFrame(shards, "columns string, shard string").coalesce(1).write.parquet(f"{out}/{EXPORTED}")
    return out


def _parquet_files(spark: SparkSession, folder: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    return [s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().endswith(".parquet")]


def guard_nonempty_export(spark: SparkSession, folder: str) -> list[str]:
    """Fail instead of publishing an empty table when no shard exists.

    Only the folder listing is read (driver-side metadata, never data).
    """
    files = _parquet_files(spark, folder)
    if not files:
        raise EmptyExportError(f"no parquet files found in {folder}")
    return files


def read_export(spark: SparkSession, folder: str) -> DataFrame:
    """All shards of an export as one frame, after the empty and schema checks.

    Shards must share one schema, as a plain concatenation requires. What `export_parquet` noted vouches for its own
    shards; only files that it did not write are looked at, each by Spark's own reader, which reads their
    footers alone. No file is read whole.
    """
    files = guard_nonempty_export(spark, folder)
    noted = []
    if _exists(spark, f"{folder}/{EXPORTED}"):
        noted = spark.read.schema("columns string, shard string").parquet(f"{folder}/{EXPORTED}").collect()
    own = {r.shard for r in noted}
    want = T.StructType.fromJson(json.loads(noted[0].columns)) if noted else spark.read.parquet(files[0]).schema
    for f in files:
        if f.rsplit("/", 1)[1] not in own:
            got = spark.read.parquet(f).schema
            if [(c.name, c.dataType) for c in got] != [(c.name, c.dataType) for c in want]:
                raise ShardSchemaError(f"shard {f} has {got.simpleString()}, the export has {want.simpleString()}")
    return spark.read.schema(want).parquet(folder)


def merge_parquet_shards(spark: SparkSession, folder: str, out: str, files: int = 1) -> str:
    """Concatenate the shards of one export into `files` Parquet files (one, as the dashboard loads it).

    A narrow coalesce: the one task streams the shards and holds none of them. Callers with an export
    too large for one writer name more files; nothing depends on the size of the data.
    """
    read_export(spark, folder).coalesce(int(files)).write.mode("overwrite").parquet(out)
    return out
