"""Sessions, and the folder that a cluster shares."""

from __future__ import annotations

import re
import resource
import tempfile
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: Settings that every stage wants: adaptive plans, Arrow batches of few rows, since a row may hold a recording.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(app: str = "chorale", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Leaves the folder that the cluster names; sets a temporary one only on one machine where there is none."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="chorale-"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def worker_count(cpus: int, available_gb: float, gb_per_worker: float, share: float = 0.8) -> int:
    """Tasks that fit side by side in a machine's cores and memory; at least one."""
    return max(1, int(min(cpus * share, available_gb / gb_per_worker)))


def worker_memory(df: DataFrame) -> DataFrame:
    """(partition, peak_mb) of the Python workers that read the partitions of ``df``, for the sizing of tasks."""

    def run(batches):
        for batch in batches:
            del batch
        peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
        yield pa.RecordBatch.from_pydict({"partition": pa.array([TaskContext.get().partitionId()], pa.int32()), "peak_mb": pa.array([peak])})

    return df.mapInArrow(run, "partition int, peak_mb double")
