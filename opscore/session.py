"""Session helpers.

Library code never creates a session; it takes the caller's.  These helpers
exist for tests, the bench and local runs.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "opscore", work_dir: str | None = None) -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off).

    ``work_dir`` becomes the session's ``spark.checkpoint.dir``; without it the
    launch configuration decides, and none need be named.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("OPSCORE_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if work_dir is not None:
        builder = builder.config("spark.checkpoint.dir", work_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one set on the context, else the one the
    session was launched with.  Raises where neither is named; a folder that only one
    machine can see is never chosen in its place."""
    chosen = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not chosen:
        raise ValueError("name a folder that all executors share: launch with spark.checkpoint.dir, "
                         "or call SparkContext.setCheckpointDir")
    return chosen


_MB = 1 << 20


def scale_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256,
               broadcast_mb: int = 64) -> dict[str, str]:
    """Session settings sized to the data, for a cluster run.

    * file splits of ``target_partition_mb`` for large inputs (fewer, fuller
      scan tasks), 128 MB below 1 TB;
    * enough shuffle partitions that each holds about one target partition
      of input (never fewer than 2 per core); AQE coalesces the small ones;
    * AQE skew handling: a partition over 4x the median and over
      2 x target is split, so one hot key cannot hold a reducer;
    * AQE may broadcast a join side measured below ``broadcast_mb`` at run
      time (size checked, otherwise it stays a shuffle join).

    Example: 100 TB over 1000 executors x 8 cores -> 256 MB splits and
    416,000 shuffle partitions (409,600 rounded up to whole waves of 8,000).
    """
    big = input_bytes >= (1 << 40)
    split = target_partition_mb * _MB if big else 128 * _MB
    parts = max(2 * total_cores, -(-input_bytes // (target_partition_mb * _MB)))
    parts = -(-parts // total_cores) * total_cores
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mb * _MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes":
            str(2 * target_partition_mb * _MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_mb * _MB),
        "spark.sql.autoBroadcastJoinThreshold": str(10 * _MB),
    }
