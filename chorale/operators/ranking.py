"""Ranks over whole tables and large groups without gathering them in one task.

Rows are range-partitioned by group and order, so a partition holds a contiguous run of ranks.
Counts per partition and group, a few rows each, give the rank that each run starts from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.session import ensure_checkpoint_dir


def ranked(df: DataFrame, groups: list[Column], order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its rank (from 1) in each group by ``order``, and ``<name>_count``, the rows of its group.

    The order must be total for a reproducible result. Only narrow frames should be ranked:
    the rows are checkpointed once, which also makes the partitions stable.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [f"_g{i}" for i in range(len(groups))]
    by = [f"_o{i}" for i in range(len(order))]
    wide = df.select("*", *(g.alias(k) for g, k in zip(groups, keys, strict=True)), *(o.alias(k) for o, k in zip(order, by, strict=True)))
    sortable = [*keys, *by]
    placed = (
        wide.repartitionByRange(*sortable)
        .sortWithinPartitions(*sortable)
        .withColumn("_at", F.monotonically_increasing_id())
        .drop(*by)
        .checkpoint()
        .withColumn("_part", F.shiftright("_at", 33))
    )
    runs = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part") if keys else Window.partitionBy(F.lit(0)).orderBy("_part")
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    starts = runs.select(
        F.col("_part").alias("_run"), *(F.col(k).alias(f"{k}_run") for k in keys), "_first",
        (F.sum("_n").over(earlier) - F.col("_n")).alias("_before"), F.sum("_n").over(whole).alias(f"{name}_count"),
    )
    same = F.col("_part") == F.col("_run")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_run"))
    return placed.join(starts, same).select(
        *(placed[f"`{c}`"] for c in df.columns),
        (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name),
        F.col(f"{name}_count"),
    )
