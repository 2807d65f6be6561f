"""Signals as arrays of samples in Column expressions. Arithmetic is in double; sinks narrow to float."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once, where ``f`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), f), 1)


def doubles(x: Column) -> Column:
    return x.cast("array<double>")


def duration_s(n: Column, rate: Column) -> Column:
    """Null for a rate of 0."""
    return F.try_divide(n.cast("double"), rate.cast("double"))


def lasts(n: Column, rate: int, seconds: float) -> Column:
    """Whether ``n`` samples last so long, as a comparison of the column alone, which a scan can take over."""
    return n >= F.lit(math.ceil(seconds * rate)).cast("bigint")


def num_samples(seconds: Column, rate: Column) -> Column:
    return seconds * rate


def gain_of(dbfs: Column) -> Column:
    return F.pow(F.lit(10.0), dbfs / 20.0)


def dbfs_of(gain: Column) -> Column:
    """Raises for a gain that is not positive."""
    checked = F.when(F.assert_true(gain > 0, "a gain must be positive").isNull(), gain)
    return 20.0 * F.log10(checked)


def sum_of_squares(x: Column) -> Column:
    return F.aggregate(doubles(x), F.lit(0.0), lambda s, v: s + v * v)


def rms(x: Column) -> Column:
    """Null for an empty signal."""
    return F.sqrt(F.try_divide(sum_of_squares(x), F.size(x).cast("double")))


def rms_in_bounds(x: Column, bounds: Column, rate: int) -> Column:
    """Over the samples of all bounds (start floored, end ceiled, both clamped), counted once for each bound
    that holds them; without bounds over the whole signal."""
    n = F.size(x)
    cut = F.flatten(
        F.transform(
            bounds,
            lambda b: F.slice(
                x,
                F.greatest(F.floor(b["start"] * rate), F.lit(0)).cast("int") + 1,
                F.greatest(
                    F.least(F.ceil(b["end"] * rate).cast("int"), n) - F.greatest(F.floor(b["start"] * rate), F.lit(0)).cast("int"), F.lit(0)
                ),
            ),
        )
    )
    return F.when(F.coalesce(F.size(bounds), F.lit(0)) == 0, rms(x)).otherwise(rms(cut))


def peak(x: Column) -> Column:
    return F.greatest(F.abs(F.array_max(doubles(x))), F.abs(F.array_min(doubles(x))))


def scale(x: Column, gain: Column) -> Column:
    return F.transform(doubles(x), lambda v: v * gain)


def peak_normalize(x: Column) -> Column:
    """Divided by the peak only where that is over 1."""
    return F.when(peak(x) > 1, scale(x, 1 / peak(x))).otherwise(doubles(x))


def level_gain(target_dbfs: Column, level: Column) -> Column:
    """The gain that brings a signal of RMS ``level`` to ``target_dbfs``; null for silence."""
    return F.try_divide(gain_of(target_dbfs), F.when(level > 0, level))


def pad_or_trim(x: Column, n: int) -> Column:
    """The first ``n`` samples, with zeros after the end of a shorter signal."""
    return F.concat(F.slice(doubles(x), 1, n), F.array_repeat(F.lit(0.0), F.greatest(F.lit(n) - F.size(x), F.lit(0))))


def tumbling(x: Column, n: int, least_tail: int | None = None) -> Column:
    """array<struct<segment, start, end, samples>> of ``n`` samples each. A shorter tail goes, or with
    ``least_tail`` stays, padded with zeros, if it has so many samples; its end is that of the signal."""
    size = F.size(x)
    starts = F.when(size > 0, F.sequence(F.lit(0), size - 1, F.lit(n))).otherwise(F.array().cast("array<int>"))
    cut = F.transform(
        starts,
        lambda s, i: F.struct(
            i.alias("segment"), s.alias("start"), F.least(s + n, size).alias("end"), pad_or_trim(F.slice(x, s + 1, n), n).alias("samples")
        ),
    )
    least = n if least_tail is None else least_tail
    return F.filter(cut, lambda c: c["end"] - c["start"] >= least)


def moving_average(x: Column, n: int) -> Column:
    """Means over ``n`` samples of the zero-padded signal, as long as the signal (an even window looks back one more).
    A signal shorter than the window has ``n`` means."""

    def means(v: Column) -> Column:
        size = F.size(v)
        least = F.least(size, F.lit(n))
        ahead = least - 1 - F.shiftright(least, 1)

        def mean(i: Column) -> Column:
            first = F.greatest(i + ahead - n + 1, F.lit(0))
            held = F.slice(v, first + 1, F.greatest(F.least(i + ahead + 1, size) - first, F.lit(0)))
            return F.aggregate(held, F.lit(0.0), lambda s, u: s + u) / n

        return F.transform(F.sequence(F.lit(0), F.greatest(size, F.lit(n)) - 1), mean)

    return bind(doubles(x), means)


def islands(mask: Column) -> Column:
    """array<struct<start, end>> of the runs of true: first index, and the index after the run but the last one at most."""

    def runs(m: Column) -> Column:
        n = F.size(m)

        def held(i: Column) -> Column:
            return F.coalesce(F.when((i >= 0) & (i < n), F.get(m, i)), F.lit(False))

        at = F.sequence(F.lit(0), n)
        starts = F.filter(at, lambda i: held(i) & ~held(i - 1))
        ends = F.transform(F.filter(at, lambda i: ~held(i) & held(i - 1)), lambda i: F.least(i, n - 1))
        return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), e.alias("end")))

    return bind(mask, runs)


def loudest_window(x: Column, n: int, hop: int) -> Column:
    """struct<energy, start> of the window of the largest energy, the first of equal ones; a shorter signal is one window."""

    def best(v: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(v) - n, F.lit(0)), F.lit(hop)),
            lambda s: F.struct(F.round(sum_of_squares(F.slice(v, s + 1, n)), 9).alias("energy"), (-s).alias("back")),
        )
        return bind(F.array_max(windows), lambda w: F.struct(w["energy"].alias("energy"), (-w["back"]).alias("start")))

    return bind(doubles(x), best)


def shift(x: Column, by: Column) -> Column:
    """Moved later (by > 0) or earlier, with zeros in the gap and the same length."""
    n = F.size(x)
    late = F.least(F.greatest(by, F.lit(0)), n)
    early = F.least(F.greatest(-by, F.lit(0)), n)
    return F.concat(
        F.array_repeat(F.lit(0.0), late), F.slice(doubles(x), early + 1, n - late - early), F.array_repeat(F.lit(0.0), early)
    )


def silence_outside(x: Column, events: Column, rate: int) -> Column:
    """Zero but for samples with an index in [start * rate, end * rate) of an event."""
    return F.transform(
        doubles(x),
        lambda v, i: F.when(F.exists(events, lambda e: (i >= e["start"] * rate) & (i < e["end"] * rate)), v).otherwise(0.0),
    )


def area_of_interest(n: Column, start: Column, end: Column, most: int) -> Column:
    """struct<start, end> in samples of at most ``most``: around a labelled event, from its start, up to its end,
    or from 0, by what is known; never outside the signal."""
    low = (
        F.when(n <= most, 0)
        .when(start.isNull() & end.isNull(), 0)
        .when(start.isNull(), F.greatest(end - most, F.lit(0)))
        .when(end.isNull() | (end - start >= most), start)
        .otherwise(F.greatest(start - F.floor((most - (end - start)) / 2), F.lit(0)))
    ).cast("int")
    high = F.when(n <= most, n).when(start.isNull() & end.isNotNull(), F.least(F.greatest(end, F.lit(most)), n)).otherwise(F.least(low + most, n))
    return F.struct(low.alias("start"), high.cast("int").alias("end"))
