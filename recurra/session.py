"""Session helpers: a tuned local session for tests/bench, and checkpoint-dir lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator relies on; applied to a session we build, and
# (the SQL ones) to a session the caller hands us.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# For a session that does not set them: reduce tasks of 16 MB of shuffled bytes. A task that sorts
# or groups rows holds 20 to 35 times that (shuffled rows are compressed), in several sorts.
TASK_CONF = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "recurra", warehouse: str | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)
    for k, v in TASK_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint dir the cluster names in spark.checkpoint.dir.

    Only when the setting is absent (local tests) do we point it at a fresh
    scratch directory; on a cluster the configured shared folder is used as is.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/DBFS); "
                           "a driver-local scratch folder is not visible to executors")
    path = tempfile.mkdtemp(prefix="recurra-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def freeze(df):
    """Checkpoint ``df`` (eagerly) into the shared checkpoint folder.

    Callers freeze the output of a shuffle (a range exchange), so the second pass
    Spark makes to write the files re-reads shuffle blocks only, not the upstream
    pipeline; persisting first was measured slower and is not done.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, total_cores: int, *, target_partition_mb: int = 256,
                 max_initial_partitions: int | None = None) -> dict[str, str]:
    """Shuffle / scan sizing for a cluster run over ``input_bytes`` of Parquet.

    * scan splits of ``target_partition_mb`` keep each task's decoded batch well
      inside executor memory while keeping the task count reasonable at 100 TB;
    * the initial shuffle partition count is sized from the input so no reducer
      starts with more than ~``target_partition_mb`` of data (never fewer than 3
      waves of the cluster's cores); AQE then coalesces small partitions and splits
      skewed ones (a partition 5x the median and over 2x the target);
    * broadcast stays size-checked by Spark (static stats and AQE runtime sizes).
    """
    mb = 1024 * 1024
    initial = max(3 * total_cores, -(-input_bytes // (target_partition_mb * mb)))
    if max_initial_partitions is not None:      # a caller's own limit; reducers then grow
        initial = min(initial, max_initial_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * target_partition_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }
