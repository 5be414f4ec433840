import datetime as dt

from pyspark.sql import functions as F

from bazaar import schemas
from bazaar.streaming.ingest_stream import make_batch_writer, read_sink, run_available_now


def body(points):
    return f"var line1={points};"


def test_available_now_two_drops_and_replay(spark, tmp_dir):
    src, sink, chk = f"{tmp_dir}/pages", f"{tmp_dir}/sink", f"{tmp_dir}/chk"
    drop1 = spark.createDataFrame([("A", 200, body('[["Nov 01 2024",1,"1"],["Nov 02 2024",2,"2"]]')),
                                   ("B", 404, body('[["Nov 01 2024",1,"1"]]'))], schemas.HISTORY_PAGE)
    drop1.write.mode("append").parquet(src)
    run_available_now(spark, src, sink, chk)
    # the same page again plus one newer point: only the new point is loaded
    drop2 = spark.createDataFrame([("A", 200, body('[["Nov 01 2024",1,"1"],["Nov 02 2024",2,"2"],'
                                                   '["Nov 03 2024",3,"3"]]'))], schemas.HISTORY_PAGE)
    drop2.write.mode("append").parquet(src)
    run_available_now(spark, src, sink, chk)
    out = spark.read.parquet(sink)
    assert sorted((r.market_hash_name, r.date.day) for r in out.collect()) == [("A", 1), ("A", 2), ("A", 3)]
    # nothing new: a third trigger is a no-op
    run_available_now(spark, src, sink, chk)
    assert spark.read.parquet(sink).count() == 3
    # replaying batch 1 (as after a failure) replaces its own output, never duplicates
    write = make_batch_writer(sink, f"{sink}_state")
    write(drop2, 1)
    again = spark.read.parquet(sink)
    assert again.count() == 3
    assert again.where(F.col("batch_id") == 1).count() == 1
    assert again.agg(F.max("date")).first()[0] == dt.datetime(2024, 11, 3)


def test_first_batch_without_records_and_kept_errors(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    write = make_batch_writer(sink, f"{sink}_state")
    write(spark.createDataFrame([("A", 429, "busy"), ("B", 200, "var line1=[[1];")], schemas.HISTORY_PAGE), 0)
    assert read_sink(spark, sink).count() == 0
    good = body('[["Nov 01 2024",1,"1"]]')
    write(spark.createDataFrame([("A", 200, good), ("C", 200, body('[["bad",1,"1"]]'))], schemas.HISTORY_PAGE), 1)
    assert [(r.market_hash_name, r.batch_id) for r in read_sink(spark, sink).collect()] == [("A", 1)]
    errors = spark.read.parquet(f"{sink}_errors")
    assert sorted((r.batch_id, r.market_hash_name, r.reason) for r in errors.collect()) == [
        (0, "B", "bad_json"), (1, "C", "bad_point")]
    outcomes = spark.read.parquet(f"{sink}_outcomes")
    assert sorted((r.batch_id, r.market_hash_name, r.outcome) for r in outcomes.collect()) == [
        (0, "A", "rate_limited"), (0, "B", "ok"), (1, "A", "ok"), (1, "C", "ok")]


def test_half_written_stream_state_does_not_count(spark, tmp_dir):
    import os
    sink = f"{tmp_dir}/sink"
    write = make_batch_writer(sink, f"{sink}_state")
    page = spark.createDataFrame([("A", 200, body('[["Nov 01 2024",1,"1"]]'))], schemas.HISTORY_PAGE)
    write(page, 0)
    for f in os.listdir(f"{sink}_state/batch_id=0"):
        os.remove(f"{sink}_state/batch_id=0/{f}")
    os.makedirs(f"{sink}_state/batch_id=0/_temporary")
    write(page, 1)  # the marks come from the data, so nothing is loaded again
    assert read_sink(spark, sink).count() == 1


def test_old_states_are_dropped(spark, tmp_dir):
    import os
    sink = f"{tmp_dir}/sink"
    write = make_batch_writer(sink, f"{sink}_state")
    for i in range(12):
        write(spark.createDataFrame([("A", 200, body(f'[["Nov {i + 1:02d} 2024",1,"1"]]'))], schemas.HISTORY_PAGE), i)
    assert sorted(os.listdir(f"{sink}_state")) == ["batch_id=10", "batch_id=11", "batch_id=9"]
    assert read_sink(spark, sink).count() == 12
