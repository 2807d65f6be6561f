"""The event operators over streams: micro-batches, tumbling, sliding and session windows with late data bounded by a watermark.

A session window closes a gap of the timeout itself, while ``operators.events.merge_gaps`` still merges it; the batch
operator is the reference for exact boundaries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def read(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def counts(events: DataFrame, at: str, key: str, length: str, hop: str | None = None, late: str = "1 hour") -> DataFrame:
    """Events, mean and largest value of each key and window; tumbling without a hop."""
    window = F.window(at, length, hop) if hop else F.window(at, length)
    out = events.withWatermark(at, late).groupBy(window.alias("w"), key)
    return out.agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.max("value").alias("most")).select(
        key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "mean", "most"
    )


def sessions(events: DataFrame, at: str, key: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Runs of events of a key with less than ``gap`` between neighbours."""
    out = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), key)
    return out.agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def totals(events: DataFrame, key: str, value: str) -> DataFrame:
    """Keyed state: after each micro-batch the number and sum of the values of each key that it touched, over all so far."""
    kind = events.schema[key].dataType.simpleString()

    def run(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for part in parts:
            values = part[value].dropna()
            n, total = n + len(values), total + float(values.sum())
        state.update((n, total))
        yield pd.DataFrame({key: [keys[0]], "n": [n], "total": [total]})

    return events.select(key, value).groupBy(key).applyInPandasWithState(
        run, f"{key} {kind}, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout
    )


def kept_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> None:
    """Runs the stream over what is there and leaves its last complete result as a table."""

    def write(df: DataFrame, _: int) -> None:
        df.write.mode("overwrite").parquet(path)

    stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def in_batches(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs ``work`` on every micro-batch of what is there, then ends."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
