"""Tables laid out along a space-filling curve over several cluster columns."""

import glob
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bazaar.sources.sinks import interleaved, layout, write_table


def groups_holding(path, column, value):
    """Row groups whose statistics do not rule the value out, of all row groups."""
    held = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            held += stats.min <= value <= stats.max
    return held, total


@pytest.fixture
def items(spark):
    return spark.range(20_000).select(
        F.concat(F.lit("i"), F.lpad((F.col("id") * 7919 % 1000).cast("string"), 4, "0")).alias("item"),
        F.concat(F.lit("t"), F.lpad((F.col("id") * 31 % 97).cast("string"), 2, "0")).alias("type"),
        (F.col("id") * 17 % 89).alias("bucket"), F.col("id"))


def test_every_cluster_column_skips(items, tmp_dir):
    keys = ["item", "type", "bucket"]
    held = {}
    for name, on in (("plain", False), ("curve", True)):
        path = f"{tmp_dir}/{name}"
        shaped = layout(items, (), keys, interleave=on)
        assert shaped.columns == items.columns
        shaped.write.option("maxRecordsPerFile", 250).parquet(path)
        held[name] = [groups_holding(path, c, v) for c, v in (("item", "i0500"), ("type", "t50"), ("bucket", 44))]
    for (plain, all_plain), (curve, total) in list(zip(held["plain"], held["curve"]))[1:]:
        assert plain > 0.9 * all_plain and curve < 0.6 * total
    assert held["curve"][0][0] < 0.6 * held["curve"][0][1]


def test_written_rows_are_the_same_with_nulls_and_a_hot_value(spark, items, tmp_dir):
    hot = items.withColumn("type", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 != 0, F.col("type")))
    hot = hot.withColumn("day", (F.col("id") % 2).cast("int")).withColumn("none", F.lit(None).cast("double"))
    write_table(hot, f"{tmp_dir}/t", ["day"], ["type", "none", "item"], interleave=True)
    back = spark.read.parquet(f"{tmp_dir}/t").select(hot.columns)
    assert Counter(back.collect()) == Counter(hot.collect())
    nothing = hot.limit(0)
    write_table(nothing, f"{tmp_dir}/e", (), ["type", "item"], interleave=True)
    assert spark.read.schema(nothing.schema).parquet(f"{tmp_dir}/e").count() == 0


def test_curve_keeps_quadrants_together_and_bounds_its_bits(spark):
    grid = spark.range(16).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y"))
    rows = grid.withColumn("k", interleaved(grid, ["x", "y"], bits=2)).orderBy("k", "x", "y").collect()
    assert len({r["k"] for r in rows}) == 16
    assert {(r["x"] // 2, r["y"] // 2) for r in rows[:4]} in ({(0, 0)}, {(0, 0), (0, 1)}, {(0, 0), (1, 0)})
    with pytest.raises(ValueError):
        interleaved(grid, ["x"] * 8, bits=8)
