"""Shared scratch space for results that must outlive an executor."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which every executor and the driver must reach.

    Where driver and executors are one process the session's warehouse will do;
    on a cluster it may be a folder of the driver alone, so there it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


# the running jobs of this thread or task, innermost last
_jobs: ContextVar[tuple[str, ...]] = ContextVar("jobs", default=())


def scratch_folder(spark: SparkSession) -> str:
    """Where the running job, or else the application, keeps its scratch tables."""
    return "/".join([shared_folder(spark), "lapsewise", spark.sparkContext.applicationId, *_jobs.get()])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one scratch table."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """A job leaves no scratch table behind, whether it succeeds or not."""
    token = _jobs.set((*_jobs.get(), uuid.uuid4().hex))
    try:
        yield
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _jobs.reset(token)


def durable(df: DataFrame, name: str, key: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: columnar, prunable, no lineage behind it.

    With a unique ``key`` the rows are spread evenly over many files in a fixed
    order. Model fits then use every core and give the same result every time
    on a cluster of the same size.
    """
    spark = df.sparkSession
    if key is not None:
        # by a hash of the key: Spark would drop a plain repartition after a join on it
        df = df.repartition(n_tasks(spark), F.xxhash64(key)).sortWithinPartitions(key)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_tasks(spark: SparkSession) -> int:
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, spark.sparkContext.defaultParallelism)
