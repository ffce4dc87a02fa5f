"""Where intermediate tables are written, and how large a broadcast may be.

`stage` writes a DataFrame as parquet and reads it back. It cuts lineage, lets
several later jobs read only the columns they need, gives Catalyst real file
sizes (so it broadcasts a side only when that side is under
``spark.sql.autoBroadcastJoinThreshold``), and survives the loss of executors
because the folder is shared storage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_root: str | None = None


def workspace_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a temp folder only for local[*] runs."""
    global _local_root
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="wardlight-")
    return _local_root


def stage_path(spark: SparkSession, label: str = "stage") -> str:
    app = spark.sparkContext.applicationId
    return f"{workspace_root(spark)}/wardlight/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_parallel(spark: SparkSession, *jobs: Callable) -> list:
    """Runs independent Spark jobs from their own threads, so one fills the gaps of another."""
    with ThreadPool(len(jobs)) as pool:
        return pool.map(lambda job: job(), [inheritable_thread_target(spark)(job) for job in jobs])


def cores_of_an_executor(spark: SparkSession) -> int:
    context = spark.sparkContext
    return context.defaultParallelism if context.master.startswith("local[") else int(context.getConf().get("spark.executor.cores", "1"))


def discard_stages(spark: SparkSession) -> None:
    """Delete everything this application staged (call when its results are stored)."""
    folder = f"{workspace_root(spark)}/wardlight/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
