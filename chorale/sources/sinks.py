"""Sinks: Parquet by split, replacement of a table that is being read, manifests with a content fingerprint."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from chorale.operators.flatten import fingerprint


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def move(spark: SparkSession, source: str, target: str, backup: bool = False) -> None:
    """Renames ``source`` to ``target``. What is there goes, or stays as ``target-backup``."""
    fs, to = _fs(spark, target)
    if fs.exists(to):
        if backup:
            _, old = _fs(spark, f"{target}-backup")
            fs.delete(old, True)
            fs.rename(to, old)
        else:
            fs.delete(to, True)
    _, come = _fs(spark, source)
    if not fs.rename(come, to):
        raise OSError(f"{source} could not be renamed to {target}")


def write(df: DataFrame, path: str, split: str | None = None, rows_per_file: int | None = None) -> None:
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(split) if split else writer).parquet(path)


def replace(df: DataFrame, path: str, backup: bool = True, split: str | None = None) -> None:
    """Writes beside ``path`` first, so that ``df`` may read from it, and then renames."""
    temporary = f"{path}-{uuid.uuid4().hex}"
    write(df, temporary, split)
    move(df.sparkSession, temporary, path, backup)


def manifest(df: DataFrame, columns: list[str], **more) -> dict:
    """Rows, columns, types and the fingerprint of ``columns``; more entries as given."""
    found = fingerprint(df, *columns).first()
    return {
        "fingerprint": found["fingerprint"], "num_rows": found["num_rows"], "columns": df.columns,
        "features": dict(df.dtypes), "datetime": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), **more,
    }


def write_manifest(spark: SparkSession, path: str, entries: dict) -> None:
    fs, where = _fs(spark, path)
    out = fs.create(where, True)
    out.write(bytearray(json.dumps(entries, indent=1, sort_keys=True).encode()))
    out.close()


def publish(df: DataFrame, root: str, subset: str, balanced: bool = False, split: str = "split") -> str:
    """The dataset as partitioned Parquet under a name of its own; the path that was written."""
    path = f"{root}/{subset}{'_balanced' if balanced else ''}"
    replace(df, path, backup=False, split=split)
    return path
