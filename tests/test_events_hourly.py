"""Hour grain on the driver's `events` table, checked against a pandas brute force.

Each user is an item; per (user, hour) the series point is (hour, max value, event count).
Pages hold one user-month, the mark is the last hour seen by a previous run.
"""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from bazaar import schemas
from bazaar.operators import ingest as ig

SF = "/root/testdata/sf0.01"
CUT = dt.datetime(2024, 1, 3)


def hourly_points(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    return (ev.withColumn("hour", F.date_trunc("hour", F.col("ts").cast("timestamp")))
            .groupBy(F.concat(F.lit("USER-"), F.col("user_id").cast("string")).alias("key"), "hour")
            .agg(F.max("value").alias("price"), F.count(F.lit(1)).alias("volume")))


def pages_from(points):
    pt = F.array(F.concat(F.date_format("hour", "MMM dd yyyy HH"), F.lit(": +0")),
                 F.col("price").cast("decimal(18,9)").cast("string"), F.col("volume").cast("string"))
    per = points.groupBy("key", F.trunc(F.to_date("hour"), "MM").alias("m")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("hour").alias("t"), pt.alias("p")))).alias("pts"))
    body = F.concat(F.lit("var line1="), F.to_json(F.transform("pts", lambda x: x["p"])), F.lit(";"))
    return per.select(F.col("key").alias("market_hash_name"), F.lit(200).alias("status"), body.alias("body"))


def test_hour_grain_extraction_matches_brute_force(spark):
    points = hourly_points(spark)
    state = (points.where(F.col("hour") < F.lit(CUT)).groupBy(F.col("key").alias("market_hash_name"))
             .agg(F.max("hour").alias("last_seen")))
    ex = ig.extract_price_history(pages_from(points), state, grain="hour")
    got = sorted((r.market_hash_name, r.date, float(r.price), r.volume) for r in ex.records.collect())

    ev = pd.read_parquet(f"{SF}/events.parquet")
    ev["hour"] = ev["ts"].dt.floor("h")
    ev["key"] = "USER-" + ev["user_id"].astype(str)
    agg = ev.groupby(["key", "hour"]).agg(price=("value", "max"), volume=("value", "size")).reset_index()
    marks = agg[agg["hour"] < CUT].groupby("key")["hour"].max()
    agg["mark"] = agg["key"].map(marks)
    new = agg[agg["mark"].isna() | (agg["hour"] > agg["mark"])]
    want = sorted((k, h.to_pydatetime(), round(float(p), 9), int(v))
                  for k, h, p, v in zip(new["key"], new["hour"], new["price"], new["volume"]))
    assert len(got) == len(want) > 0
    assert [(k, h, round(p, 6), v) for k, h, p, v in got] == [(k, h, round(p, 6), v) for k, h, p, v in want]
    assert ex.errors.count() == 0
    assert {r.market_hash_name for r in ig.advance_state(
        state, ex.records, as_type=schemas.state_schema("hour")["last_seen"].dataType).collect()} >= \
        {k for k, *_ in got}
