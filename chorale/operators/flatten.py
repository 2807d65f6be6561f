"""Lists of members in order, and tables by content."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def members(df: DataFrame, keys: list[str], order: list[str], columns: list[str], prefix: str) -> DataFrame:
    """Per key one list ``prefix_column`` for each column, all in the order of ``order``."""
    rows = F.array_sort(F.collect_list(F.struct(*order, *(F.col(c).alias(f"_{c}") for c in columns)))).alias("_rows")
    grouped = df.groupBy(*keys).agg(rows)

    def values(column: str) -> Column:
        return F.transform("_rows", lambda r: r[f"_{column}"]).alias(f"{prefix}_{column}")

    return grouped.select(*keys, *map(values, columns))


def elementwise_sum(df: DataFrame, keys: list[str], signal: str, digits: int) -> DataFrame:
    """Per key the sum of the signals, sample by sample; a shorter signal counts as 0 after its end, a null sample as 0.

    Signals move whole and are added up as they come, in order of their keys: a key holds one sum in memory."""
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, head = None, np.zeros(0), None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*head, pa.array([np.round(total, digits) + 0.0])], [*keys, signal])

        for batch in batches:
            found = zip(*(batch.column(k).to_pylist() for k in keys), strict=True)
            samples = batch.column(len(keys))
            for i, own in enumerate(found):
                if own != now:
                    if head is not None:
                        yield row()
                    now, total, head = own, np.zeros(0), [batch.column(k).slice(i, 1) for k in keys]
                x = samples[i].values.fill_null(0.0).to_numpy(zero_copy_only=False) if samples[i].is_valid else np.zeros(0)
                if len(x) > len(total):
                    total = np.pad(total, (0, len(x) - len(total)))
                total[: len(x)] += x
        if head is not None:
            yield row()

    rows = df.select(*keys, F.col(signal).cast("array<double>").alias(signal))
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, f"{kinds}, `{signal}` array<double>")


#: A prime of 61 bits, modulo which row hashes are added.
FINGERPRINT_MODULUS = (1 << 61) - 1


def fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """One row: the number of rows and a sum of 60-bit row hashes, whatever the order or partitioning. Each value is
    written with its length, so that no two different rows are hashed from the same string."""

    def written(column: str) -> Column:
        text = F.col(column).cast("string")
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("null"))

    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *map(written, columns)).cast("binary")), 1, 15), 16, 10).cast("decimal(20,0)")
    total = F.coalesce(F.sum(digest), F.lit(0).cast("decimal(30,0)")) % F.lit(FINGERPRINT_MODULUS).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("num_rows"), total.cast("bigint").alias("fingerprint"))
