"""Shared Spark helpers: durable intermediate tables and column names that cannot clash."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Byte values that separate words and are stripped from lines.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only where the session leaves it unset on one machine (tests) a temporary
    folder is made and set for the session; on a cluster that is an error.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="chorale-")
        context.setCheckpointDir(found)
    return found


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended before the interpreter
        pass


#: Arrow data that a Python worker gets at once, at most: several copies of a batch live on both sides.
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's bound on Arrow batches; rows of long texts fill the default one many times over.

    It stays lowered: the plans that are returned run later, and read the setting then."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(key).strip().lower()).groups()
    if int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


class Scratch:
    """Written intermediate tables of one query, in a folder of its own under the shared folder.

    A written table cuts lineage: it survives lost executors and is never
    recomputed. The folders are deleted when the interpreter ends, because the
    lazy result of a query still reads them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = os.path.join(shared_dir(spark), f"chorale-{uuid.uuid4().hex}")
        self.names: set[str] = set()
        small_batches(spark)
        atexit.register(_forget, spark, self.path)

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        target = f"{self.path}/{name}"
        frame.write.option("compression", "zstd").parquet(target)
        self.names.add(name)
        return self.spark.read.schema(frame.schema).parquet(target)

    def drop(self, name: str) -> None:
        _forget(self.spark, f"{self.path}/{name}")
        self.names.discard(name)

    def keep(self, *names: str) -> None:
        """Drops all tables but these."""
        for name in self.names - set(names):
            self.drop(name)


def has(frame: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in frame.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing; there are {frame.columns}")


def spare(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``frame`` is called so."""
    taken, out = {c.lower() for c in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_id(text: Column) -> Column:
    """Tells apart rows that share a doc_id but not their text."""
    return F.xxhash64(text, F.octet_length(text))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows that are broadcast at most, about 100 MB as a hashed relation of two longs, and bytes of their strings.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20


def broadcast_if_small(keys: DataFrame) -> DataFrame:
    """``keys`` (a few columns), marked for broadcast if their rows and the bytes of their strings are counted to be few
    enough; larger ones are left to a shuffled join."""
    wide = [F.coalesce(F.octet_length(col(f.name)), F.lit(0)) for f in keys.schema.fields if f.dataType.typeName() in ("string", "binary")]
    size = F.sum(reduce(Column.__add__, wide).cast("long")) if wide else F.lit(0)
    rows, size = keys.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(keys) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else keys
