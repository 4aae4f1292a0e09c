"""Session helpers.

Jobs never build their own session in library code; ``build_session`` exists
for tests, ``bench.py`` and command-line use. ``checkpoint_dir`` resolves the
shared folder used to cut lineage (ALS iterations, split inputs, stream state).
"""

from __future__ import annotations

import gc
import math
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes that a slot may hold of one step's exchanges; beyond, steps that can run in groups do.
EXCHANGE_BYTES_PER_SLOT = 512 << 20

# Settings that every job relies on. Timestamps in the inputs are
# TIMESTAMP_NTZ and our epoch arithmetic is zone-free, but results that are
# shown as dates are pinned to UTC as well.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A table bucketed by one join column joins on two without being shuffled.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "reelspark", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster the master and partition count come from spark-submit; pass
    them only for local runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session.

    Order: an already-set context checkpoint dir; ``spark.checkpoint.dir``
    from the session configuration; a fresh temporary folder only when the
    master is local (tests). On a cluster without the setting we refuse,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="reelspark-ckpt-")
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set: give the job a shared folder "
        "(HDFS/S3/...) so lineage can be cut reliably")


def free_exchanges(spark: SparkSession) -> None:
    """Exchanges that nothing refers to go with the driver's garbage, that of
    its Python side first: a handle there keeps the steps of its data."""
    gc.collect()
    system = spark.sparkContext._jvm.System
    system.nanoTime()  # a call takes the dropped handles along
    system.gc()


def exchange_bound(spark: SparkSession) -> int:
    """Bytes of exchanges that one step may hold on disk."""
    return int(EXCHANGE_BYTES_PER_SLOT * max(1, spark.sparkContext.defaultParallelism))


def group_count(spark: SparkSession, size: int) -> int:
    return max(1, math.ceil(size / exchange_bound(spark)))


def written(rows: DataFrame) -> DataFrame:
    """``rows`` read back from a folder of the shared one, without the exchanges that made them."""
    spark = rows.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/rows-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    free_exchanges(spark)
    return spark.read.parquet(folder)


def in_groups(rows: DataFrame, key: str, size: int, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run(rows)``, whose exchanges take about ``size`` bytes in all and which
    treats every ``key`` by itself. Beyond ``EXCHANGE_BYTES_PER_SLOT`` it runs
    group by group of keys: the rows are written once and each group's result
    too, and a group's exchanges are freed before the next but one."""
    spark = rows.sparkSession
    groups = group_count(spark, size)
    if groups == 1:
        return run(rows)
    kept = written(rows)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/groups-{uuid.uuid4().hex}"
    for g in range(groups):
        run(kept.where(F.pmod(F.xxhash64(key, F.lit("group")), F.lit(groups)) == g)).write.mode("append").parquet(folder)
        free_exchanges(spark)
    return spark.read.parquet(folder)


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster run, sized from the input volume.

    Shuffles start with enough partitions that each holds about
    ``target_partition_bytes`` of the largest input (e.g. 100 TB -> ~400k),
    never fewer than 3 per core; AQE then coalesces small ones and splits
    skewed ones, so partitions stay within executor memory instead of
    spilling. File splits match the target size; broadcast stays bounded by
    a fixed measured-size threshold.
    """
    initial = max(3 * cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
