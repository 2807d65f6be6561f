"""Half-open intervals inside a row: arrays of struct<start, end, ...>. Touching ends do not overlap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_end > b_start) & (a_start < b_end)


def any_overlap(start: Column, end: Column, events: Column) -> Column:
    """Whether an event meets [start, end); null or empty events: false."""
    found = F.exists(events, lambda e: overlaps(start, end, e["start"], e["end"]))
    return F.coalesce(found, F.lit(False))


def clip(start: Column, end: Column, bounds: Column) -> Column:
    """The bounds that meet [start, end), cut to it and counted from its start; further fields stay."""
    return F.transform(
        F.filter(bounds, lambda b: overlaps(start, end, b["start"], b["end"])),
        lambda b: F.struct(
            (F.greatest(b["start"], start) - start).alias("start"), (F.least(b["end"], end) - start).alias("end")
        ),
    )


def shifted_inside(bounds: Column, shift: Column, length: Column) -> Column:
    """Whether a bound still meets [0, length) after the shift."""
    return F.coalesce(F.exists(bounds, lambda b: overlaps(F.lit(0.0), length, b["start"] + shift, b["end"] + shift)), F.lit(False))


def only_target(detections: Column, target: Column, start: Column, end: Column, threshold: float = 0.0) -> Column:
    """Whether a detection meets [start, end) and none of another name that does reaches the threshold."""
    met = F.filter(detections, lambda d: overlaps(start, end, d["start"], d["end"]))
    return (F.size(met) > 0) & F.forall(met, lambda d: (d["confidence"] < threshold) | (d["name"] == target))


def merge_gaps(events: Column, gap: Column) -> Column:
    """Neighbours in the array's order whose gap to the event before is at most ``gap`` as one; ends are not compared
    with earlier ones, so a nested interval ends its group where it ends itself."""
    empty = F.filter(events, lambda e: F.lit(False))
    return F.aggregate(
        events,
        empty,
        lambda out, e: F.when(
            (F.size(out) > 0) & (e["start"] - F.element_at(out, -1)["end"] <= gap),
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(F.struct(F.element_at(out, -1)["start"].alias("start"), e["end"].alias("end"))),
            ),
        ).otherwise(F.concat(out, F.array(e))),
    )


def longest(events: Column) -> Column:
    """The first of the longest; null without events."""
    ranked = F.transform(events, lambda e, i: F.struct((e["end"] - e["start"]).alias("len"), (-i).alias("at"), e.alias("event")))
    return F.array_max(ranked)["event"]
