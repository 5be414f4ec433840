"""Incremental ingest as a Structured Streaming file stream.

Archived listing pages land as Parquet files in a folder. An `availableNow`
stream picks up only the files it has not seen (the file source's own log in the
checkpoint), and `foreachBatch` runs the same extractor as the batch path:

* the per-item marks come from the state committed by the previous micro-batch
  (state folders are keyed by batch id and count only when complete; a missing state is
  re-derived from the data written by earlier batches, never from the current one);
* the records are written to the batch's own folder, which is replaced whole, so a
  replayed micro-batch (after a failure) replaces its own output instead of
  appending twice, also when it has fewer rows or none; the errors and page outcomes of a batch are kept beside it in the same way
  (`<sink>_errors`, `<sink>_outcomes`); then the state of that batch is committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar import schemas
from bazaar.operators import ingest as ig
from bazaar.plans.incremental import commit_state, partition_values, state_at, state_from_data

PAGE_SCHEMA = schemas.HISTORY_PAGE


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """The records with their batch id; none while no batch has written one."""
    return spark.read.schema(T.StructType([*schemas.PRICE_RECORD.fields, T.StructField("batch_id", T.LongType())])
                             ).parquet(sink)


def _state_before(spark: SparkSession, sink: str, state_root: str, batch_id: int,
                  grain: str = "day") -> DataFrame | None:
    """Marks committed by the newest earlier batch; derived from the sink's earlier
    batches when that state is missing. Batch ids come from the folder listings."""
    states = [int(v) for v in partition_values(spark, state_root, "batch_id", complete=True) if int(v) < batch_id]
    datas = [int(v) for v in partition_values(spark, sink, "batch_id") if int(v) < batch_id]
    if states and (not datas or max(states) >= max(datas)):
        return state_at(spark, state_root, str(max(states)), grain, "batch_id")
    if datas:
        return state_from_data(read_sink(spark, sink).where(F.col("batch_id") < batch_id), grain=grain)
    return None


def make_batch_writer(sink: str, state_root: str, grain: str = "day"):
    def keep(df: DataFrame, path: str, batch_id: int) -> None:
        # the batch's folder is replaced whole, also when a replay has no row for it
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    def write_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        state = _state_before(spark, sink, state_root, batch_id, grain)
        ex = ig.extract_price_history(df, state, grain=grain)
        keep(ex.records, sink, batch_id)
        keep(ex.errors, f"{sink}_errors", batch_id)
        keep(ex.outcomes, f"{sink}_outcomes", batch_id)
        written = read_sink(spark, sink).where(F.col("batch_id") == batch_id)
        new_state = ig.advance_state(state, written, as_type=schemas.state_schema(grain)["last_seen"].dataType)
        commit_state(new_state, state_root, str(batch_id), "batch_id")
    return write_batch


def run_available_now(spark: SparkSession, pages_dir: str, sink: str, checkpoint: str, grain: str = "day",
                      max_files_per_trigger: int | None = None) -> None:
    """Process every page file not yet seen, then stop."""
    reader = spark.readStream.schema(PAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.parquet(pages_dir)
    q = (stream.writeStream.foreachBatch(make_batch_writer(sink, f"{sink}_state", grain))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
