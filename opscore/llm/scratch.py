"""Shared working folder: intermediate tables that cut lineage.

The folder is the one the session names in ``spark.checkpoint.dir``; every
executor and the driver can reach it, so a table written there survives a lost
executor.  Only a local session without that setting gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []
_LOCAL: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder of this session; raises on a cluster that names none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault(sc.applicationId, "file://" + tempfile.mkdtemp(prefix="opscore-llm-"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again.

    The driver then collects garbage: Spark deletes the shuffle files of jobs that nothing
    refers to any more, which the written table makes superfluous.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/opscore-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _MADE.append(path)
    spark.sparkContext._jvm.System.gc()
    found = spark.read.schema(df.schema).parquet(path)
    found.opscore_path = path
    return found


def drop(table: DataFrame) -> None:
    """Delete a table that ``stored`` returned and nothing will read again."""
    _MADE.remove(table.opscore_path)
    delete(table.sparkSession, table.opscore_path)


def delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete what ``stored`` wrote in this process; results that read it must be done."""
    while _MADE:
        delete(spark, _MADE.pop())
