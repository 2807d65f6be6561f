"""Sharding: contiguous shards of near equal bytes from global prefix sums.

The order is (id, crc, size). Rows are dealt to range partitions once, as 28-byte
rows without their text. Per-partition totals (one row a partition) give each
partition the bytes before it; a running sum inside the partition then places
every row, and cuts at equal targets give the shards. No step gathers more than
one row per partition and shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import col, has, shared_dir, small_batches

N_SHARDS = 16
LAW = "bytes"


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = rows = 0
    for batch in batches:
        total += int(np.sum(batch.column("size").to_numpy()))
        rows += batch.num_rows
    yield pa.RecordBatch.from_pydict(
        {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "bytes": pa.array([total], pa.int64()), "rows": pa.array([rows], pa.int64())}
    )


def _cutter(before: dict[int, int], total: int, n_shards: int, first_rows: dict[tuple[int, int], int] | None):
    """A function over the batches of a partition: counts by shard, or with ``first_rows`` the placed rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        done, seen = before.get(part, 0), {}
        for batch in batches:
            size = batch.column("size").to_numpy()
            start = done + np.cumsum(size) - size
            # the middle of a row decides, so that a cut falls on the nearer edge of the row it meets
            shard = np.minimum((2 * start + size) * n_shards // max(2 * total, 1), n_shards - 1)
            done += int(size.sum())
            if first_rows is None:
                for s, n in zip(*np.unique(shard, return_counts=True), strict=True):
                    seen[int(s)] = seen.get(int(s), 0) + int(n)
                continue
            slot = np.empty(len(size), np.int64)
            for s in np.unique(shard):
                own = np.flatnonzero(shard == s)
                at = seen.get(int(s), 0)
                slot[own] = first_rows[part, int(s)] + at + np.arange(len(own))
                seen[int(s)] = at + len(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("size"), batch.column("crc"), pa.array(shard, pa.int32()), pa.array(slot, pa.int64())],
                ["id", "size", "crc", "shard", "slot"],
            )
        if first_rows is None and seen:
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part] * len(seen), pa.int32()), "shard": pa.array(list(seen), pa.int32()), "rows": pa.array(list(seen.values()), pa.int64())}
            )

    return cut


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = N_SHARDS) -> DataFrame:
    """One row per row of ``docs``: its id, size, text_crc32, law, shard, slot, grown_shard (null under this law).

    Size is the UTF-8 bytes of the text plus 1. Shard k holds the rows whose
    middle lies in the k-th of ``n_shards`` equal spans of all bytes, so sizes
    differ from the target by less than a row at each end.

    - Null text: no bytes, size 1, crc32 0. Null ids come first in the order.
    - Repeated rows and ties: each row is placed once; equal rows are interchangeable.
    - A row larger than a target takes a shard by itself; shards it spans stay empty.
    - Texts of any length are read whole, and stay where they are read.
    - Empty table: empty result. Other columns of ``docs`` are not carried, whatever they are called.
    """
    has(docs, id_col, text_col)
    spark = docs.sparkSession
    shared_dir(spark)
    small_batches(spark)
    body = F.encode(F.coalesce(col(text_col), F.lit("")), "UTF-8")
    sized = docs.select(
        col(id_col).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("crc")
    ).checkpoint()
    placed = sized.repartitionByRange("id", "crc", "size").sortWithinPartitions("id", "crc", "size").checkpoint()

    totals = {r["part"]: (r["bytes"], r["rows"]) for r in placed.mapInArrow(_totals, "part int, bytes long, rows long").collect()}
    before, total = {}, 0
    for part in sorted(totals):
        before[part] = total
        total += totals[part][0]
    counts = placed.mapInArrow(_cutter(before, total, n_shards, None), "part int, shard int, rows long").collect()
    first_rows, so_far = {}, {}
    for part, shard, rows in sorted(tuple(r) for r in counts):
        first_rows[part, shard] = so_far.get(shard, 0)
        so_far[shard] = first_rows[part, shard] + rows
    id_type = placed.schema["id"].dataType.simpleString()
    out = placed.mapInArrow(
        _cutter(before, total, n_shards, first_rows), f"id {id_type}, size long, crc long, shard int, slot long"
    )
    return out.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
