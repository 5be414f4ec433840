"""Session helpers: the few settings every job relies on.

The library never creates a session behind the caller's back; `get_spark` is for
scripts, benches and tests. Jobs call `configure(spark)` which only sets what the
semantics need (UTC dates) and never overrides cluster-level choices.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the results depend on. Dates are the UTC date of an instant.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that only affect the physical plan; applied when building a session.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "bazaar", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf.update(REQUIRED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sizing(input_bytes: int, target_partition_bytes: int = 256 * 1024 ** 2, cores: int | None = None) -> dict:
    """Shuffle / scan settings for an input of `input_bytes`.

    The initial shuffle partition count is chosen so a partition holds about
    `target_partition_bytes` even before AQE coalesces (AQE can merge small
    partitions but never splits a partition that is too large for executor
    memory), and never fewer than 2x the cores. Scan splits are as large as the target.
    """
    parts = max(int(input_bytes // target_partition_bytes) + 1, 2 * (cores or 1))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.files.maxPartitionBytes": str(int(target_partition_bytes)),
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and staging tables.

    On a cluster this is `spark.checkpoint.dir`, set by whoever runs the cluster,
    and it must be a shared file system. Only when it is unset (local tests) a
    private folder under the system temp dir is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is invisible to other executors and lost with them
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="bazaar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark's setting by which what a query has shuffled is deleted when the query ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """For writes, whose shuffles nobody reads again: their files go as each write ends, instead of whenever the
    driver next collects its garbage, so that a job of several writes holds those of one at a time. The session's own
    setting comes back afterwards."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def materialize_at(df, name: str, codec: str | None = None):
    """As `materialize`; returns the frame and its folder, for callers who delete it once they have read it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path), path


def materialize(df, name: str, codec: str | None = None):
    """Cut the lineage of `df`: write it once as Parquet under the shared checkpoint
    folder and return the frame read back (computed once, unlike an RDD checkpoint of
    an unpersisted frame, and readable by any executor after a loss). `codec` names the
    files' compression (None: the session's); wide frames take less disk by `zstd`."""
    return materialize_at(df, name, codec)[0]
