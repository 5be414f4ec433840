"""The word-start index finds what the scan finds; the guard reads the plan."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaar.operators import search as se
from bazaar.plans import incremental as inc
from bazaar.plans.pipeline import Warehouse, index_latest, search_latest
from bazaar.plans.registry import rpt_latest
from bazaar.sources.sinks import write_table

SF = "/root/testdata/sf0.001"
ROWS = [("AK-47 | Red\tLine", "Rifle", 1.5, Decimal("12.340000000"), True), ("ak-47 | red line", None, None, None, None),
        ("Straße Äpfel-Korb", "äpfel", 0.0, None, False), ("Kelvin ſtone", "İstanbul ıx", None, None, None),
        ("x" * 20_000 + " tail", "a.b*c", None, None, None), ("", "", None, None, None), (None, "no name (x)", None, None, None),
        ("Red-Line", "pre-red", 12.0, Decimal("0.1"), True), ("\U0001f600smile red", "2024-01-02", 100.25, None, None),
        ("AK-47 | Red\tLine", "Rifle", 1.5, Decimal("12.340000000"), True)]
TERMS = ["a", "AK", "ak-47", "red", "r", "line", "|", "47", "7", "-47", "Äpf", "ä", "korb", "straße", "STRASSE", "k", "kel", "Kelvin", "s",
         "ston", "i", "ist", "ix", "a.b*c", "b*", "(x)", "x", "xxxx", "tail", "340", "12.34", "1.500", "00", "true", "\U0001f600", "smile",
         "2024-01", "01-02", "zzz", "red-line", "red line", "ak red", "RED rifle 12", "r l 4 |", "", "  "]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_index_finds_the_rows_of_the_scan(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, "item_name string, kind string, rate double, price decimal(38,9), flag boolean")
    se.build_search_index(df, f"{tmp_dir}/ix")
    for t in TERMS:
        got = se.search_indexed(spark, f"{tmp_dir}/ix", t)
        assert got.columns == df.columns and rows(got) == rows(se.search_filter(df, t)), t
    se.build_search_index(df.limit(0), f"{tmp_dir}/ix")  # takes the old one's place
    assert rows(se.search_indexed(spark, f"{tmp_dir}/ix", "red")) == []


def test_index_of_the_report(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    rpt_latest(spark, SF).write.parquet(wh.path("rpt_item_metrics_latest"))
    index_latest(spark, wh)
    report = spark.read.parquet(wh.path("rpt_item_metrics_latest"))
    for t in ("item-1", "brand#1 item-2", "5", "true 199", "nothing"):
        assert rows(search_latest(spark, wh, t)) == rows(se.search_filter(report, t))
    assert search_latest(spark, wh, "item-1").count() > 0
    # the probe reads two columns, by a filter on the start that reaches the file
    found = plan(se.search_candidates(spark, wh.path("search_index"), ["item-1", "b"]))
    assert "ReadSchema: struct<_hash:bigint,start:string>" in found
    assert "Or(EqualTo(start,ite),StringStartsWith(start,b))" in found


def test_unbounded_reads_fail_however_they_are_written(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.range(40).select(F.col("id").alias("v"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 4).cast("int"))
                                .alias("market_date"), F.col("id").cast("string").alias("item_name"))
    write_table(df, path, ["market_date"])
    cut = F.lit("2026-01-03").cast("date")

    def read(build=None, **more):
        return inc.read_guarded(spark, path, "market_date", build=build, **more)
    day = F.col("market_date")
    other = spark.createDataFrame([("1", dt.date(2026, 1, 2))], "item_name string, d date")
    bad = [None, lambda t: t.where("v > 3"), lambda t: t.where(day.isNotNull()), lambda t: t.where((day >= cut) | (F.col("v") > 3)),
           lambda t: t.groupBy("item_name").agg(F.max("market_date").alias("market_date")).where(day >= cut),
           lambda t: t.join(other, "item_name"), lambda t: t.where(day >= cut).unionByName(t), lambda t: t.limit(3).where(day >= cut)]
    for b in bad:
        with pytest.raises(inc.PartitionFilterRequired):
            read(b)
    good = [lambda t: t.where(day == cut), lambda t: t.select("v", day.alias("d")).where(F.col("d") >= cut),
            lambda t: t.groupBy("market_date").count().where(day >= cut), lambda t: t.where((day >= cut) & (F.col("v") > 3)),
            lambda t: t.where(day >= cut).unionByName(t.where(day < cut))]
    assert [read(b).count() for b in good] == [10, 20, 2, 18, 40]
    assert read(lower=dt.date(2026, 1, 3)).count() == 20 and read(required=False).count() == 40
    # other tables need no bound
    inc.require_bound(df, path, "market_date")
    assert inc.require_bound(other, path, "market_date").columns == ["item_name", "d"]
