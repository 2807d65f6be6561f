"""Events over time: gaps and islands, longest events, overlaps between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.functions.times import micros
from chorale.session import ensure_checkpoint_dir


def merge_gaps(df: DataFrame, keys: list[str], start: str, end: str, gap_s: float, least_s: float = 0.0, order: list[str] | None = None) -> DataFrame:
    """Events of a key, in order of start, whose gap to the one before is at most ``gap_s`` as one event; those of
    ``least_s`` at least stay. The gap is to the end of the event before, not to the latest end.

    Rows are range-partitioned by key and time, so a key's events may lie in many partitions. Each run of a key in a
    partition is marked on its own; one row per run carries the last end and the number of gaps over to the next run.
    """
    ensure_checkpoint_dir(df.sparkSession)
    by = [start, *(order or [])]
    placed = (
        df.select(*dict.fromkeys([*keys, *by, end]))
        .repartitionByRange(*keys, *by)
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    run, runs = ["_part", *keys], Window.partitionBy(*keys).orderBy("_part")
    inside = Window.partitionBy(*run).orderBy(*by)
    ends = placed.groupBy(*run).agg(F.max(F.struct(*by, F.col(end).alias("_end")))["_end"].alias("_last"))
    known = ends.select(*(F.col(c).alias(f"_r{c}") for c in run), F.lag("_last").over(runs).alias("_before"))

    def to_run(frame: DataFrame, summary: DataFrame) -> DataFrame:
        same = F.lit(True)
        for c in run:
            same = same & F.col(c).eqNullSafe(F.col(f"_r{c}"))
        return frame.join(summary, same).drop(*(f"_r{c}" for c in run))

    previous = F.coalesce(F.lag(end).over(inside), F.col("_before"))
    gap = (micros(F.col(start)) - micros(previous)) / 1e6
    marked = to_run(placed, known).withColumn("_new", F.coalesce((gap > gap_s).cast("int"), F.lit(0)))
    local = marked.withColumn("_island", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    counts = local.groupBy(*run).agg(F.max("_island").alias("_n"))
    offsets = counts.select(*(F.col(c).alias(f"_r{c}") for c in run), (F.sum("_n").over(runs) - F.col("_n")).alias("_offset"))
    island = to_run(local, offsets).withColumn("_island", F.col("_island") + F.col("_offset"))
    last = F.max(F.struct(*by, F.col(end).alias("_end")))
    merged = island.groupBy(*keys, "_island").agg(F.min(start).alias("start"), last["_end"].alias("end"), F.count(F.lit(1)).alias("n"))
    return merged.where(micros(F.col("end")) - micros(F.col("start")) >= least_s * 1e6).drop("_island")


def longest(df: DataFrame, keys: list[str], start: str, end: str, order: list[str], columns: list[str]) -> DataFrame:
    """Per key the first of the longest events."""
    size = micros(F.col(end)) - micros(F.col(start))
    best = F.min(F.struct((-size).alias("_len"), *order, *[c for c in columns if c not in order])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"_best.{c}").alias(c) for c in columns), (-F.col("_best._len") / 1e6).alias("duration_s"))


def overlap_semi(left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, bucket_s: int) -> DataFrame:
    """Rows of ``left`` whose [start, end) meets one of ``right`` of the same keys.

    Both sides go to the time buckets that they touch, so the join has an equality on key and bucket
    and compares only neighbours, however many events a key has."""

    def buckets(df: DataFrame, *columns) -> DataFrame:
        first, last = (F.floor(micros(F.col(c)) / (bucket_s * 1_000_000)) for c in (start, end))
        return df.select(*columns, F.explode(F.sequence(first, last)).alias("_bucket"))

    r = buckets(right, *(F.col(k).alias(f"_r_{k}") for k in keys), F.col(start).alias("_r_start"), F.col(end).alias("_r_end"))
    own = buckets(left, "*")
    on = (F.col("_bucket") == F.col("_r_bucket")) & (F.col(end) > F.col("_r_start")) & (F.col(start) < F.col("_r_end"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return own.join(r.withColumnRenamed("_bucket", "_r_bucket"), on, "left_semi").drop("_bucket").distinct()
