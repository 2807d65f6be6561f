"""Detections: confidence filters, dominant and most confident labels, validated sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.functions.times import micros


def dominant_label(df: DataFrame, keys: list[str], label: str, order: list[str], least_share: float) -> DataFrame:
    """Per key the most frequent label, of equal ones that met first by ``order``; n, total and whether its share
    reaches ``least_share``. Keys without rows have none."""
    counted = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("_first"))
    total = F.sum("n").over(Window.partitionBy(*keys)).alias("total")
    ranked = Window.partitionBy(*keys).orderBy(F.desc("n"), "_first")
    best = counted.select(*keys, label, "n", total, F.row_number().over(ranked).alias("_rank")).where("_rank = 1")
    return best.drop("_rank").withColumn("is_dominant", F.col("n") / F.col("total") >= least_share)


def most_confident(df: DataFrame, keys: list[str], confidence: str, order: list[str], columns: list[str]) -> DataFrame:
    """Per key the row of the largest confidence, of equal ones the first by ``order``; null confidences don't count."""
    best = F.min(F.struct((-F.col(confidence)).alias("_c"), *order, *[c for c in columns if c not in order])).alias("_best")
    return df.where(F.col(confidence).isNotNull()).groupBy(*keys).agg(best).select(*keys, *(F.col(f"_best.{c}").alias(c) for c in columns))


def first_per_label(df: DataFrame, keys: list[str], label: str, order: list[Column]) -> DataFrame:
    """Per key and label the first row by ``order``. Sources of a recording in their order: the first wins;
    by detections descending and then source: the one of most detections wins."""
    cols = df.columns
    least = df.groupBy(*keys, label).agg(F.min(F.struct(*(o.alias(f"_o{i}") for i, o in enumerate(order)), F.struct(*cols).alias("_row"))).alias("_best"))
    return least.select(*(F.col(f"_best._row.`{c}`").alias(c) for c in cols))


def only_target_in_window(events: DataFrame, keys: list[str], start: str, end: str, name: str, confidence: str, hours: int, threshold: float, order: list[str]) -> DataFrame:
    """Per key and window of ``hours`` that an event meets: the name of the first event, the events, and whether none of
    another name reaches the threshold."""
    step = hours * 3600
    first, last = (F.floor(micros(F.col(c)) / F.lit(step * 1_000_000)) for c in (start, end))
    touching = (micros(F.col(end)) % (step * 1_000_000) == 0) & (last > first)
    windows = F.explode(F.sequence(first, F.when(touching, last - 1).otherwise(last)))
    placed = events.select("*", windows.alias("window"))
    target = F.min(F.struct(*order, name))
    by = placed.groupBy(*keys, "window", name).agg(
        F.count(F.lit(1)).alias("_n"), F.max(confidence).alias("_most"), target.alias("_first")
    )
    found = by.groupBy(*keys, "window").agg(
        F.sum("_n").alias("n"), F.min("_first").alias("_target"),
        F.collect_list(F.struct(F.col(name).alias("name"), F.col("_most").alias("most"))).alias("_names"),
    )
    others = F.forall("_names", lambda o: (o["name"] == F.col(f"_target.{name}")) | (o["most"] < threshold))
    return found.select(*keys, (F.col("window") * step).alias("window_start_s"), F.col(f"_target.{name}").alias("target"), "n", others.alias("only_target"))


def validated_sources(sources: DataFrame, names: DataFrame, confidence: float, least_share: float, match: str = "any", duplicate: str = "first") -> DataFrame:
    """Sources whose confident detections are dominated by a name of their recording's codes, one per recording and name.

    sources: recording_id, source_idx, codes array, detections array<struct<name, confidence, ...>>;
    names: code, name (normalised). match: the ``first`` code only, or ``any``. duplicate: of sources with the same
    name the ``first`` or that of ``most_detections`` stays."""
    confident = F.filter("detections", lambda d: d["confidence"] > confidence)
    long = sources.select("recording_id", "source_idx", F.posexplode(confident).alias("_pos", "_d")).select(
        "recording_id", "source_idx", "_pos", F.col("_d.name").alias("name")
    )
    best = dominant_label(long, ["recording_id", "source_idx"], "name", ["_pos"], least_share).where("is_dominant")
    codes = F.slice("codes", 1, 1) if match == "first" else F.col("codes")
    allowed = sources.select("recording_id", "source_idx", F.explode(codes).alias("code")).join(names, "code")
    valid = best.join(allowed, ["recording_id", "source_idx", "name"])
    order = [F.col("source_idx")] if duplicate == "first" else [-F.col("n"), F.col("source_idx")]
    kept = first_per_label(valid, ["recording_id"], "name", order)
    return kept.select("recording_id", "source_idx", "name", "code", "n", "total")
