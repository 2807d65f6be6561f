"""Signal operators over DataFrames by Arrow batches: envelopes, events, masks, resampling, encoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from chorale.functions import codec, dsp


def map_signals(df: DataFrame, key: str, signal: str, fields: str, work: Callable[[np.ndarray], tuple]) -> DataFrame:
    """Key and the fields that ``work`` makes of each signal; a null signal is an empty one."""
    names = [f.strip().split(" ")[0] for f in fields.split(";")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            made = [work(np.asarray([] if x is None else x, float)) for x in part[signal]]
            yield pd.DataFrame({key: part[key]} | {n: [m[i] for m in made] for i, n in enumerate(names)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, signal).mapInPandas(run, f"{key} {kind}, {fields.replace(';', ',')}")


def envelope(df: DataFrame, key: str, signal: str, size: int, hop: int) -> DataFrame:
    return map_signals(df, key, signal, "n_frames int; envelope array<double>", lambda x: (len(e := dsp.rms_envelope(x, size, hop)), e.tolist()))


def event_bounds(df: DataFrame, key: str, signal: str, rate: int, settings: dsp.EventSettings) -> DataFrame:
    def work(x: np.ndarray) -> tuple:
        return ([{"start": a, "end": b} for a, b in dsp.detect_events(x, rate, settings)],)

    return map_signals(df, key, signal, "events array<struct<start:double,end:double>>", work)


def bandpass(df: DataFrame, key: str, signal: str, rate: int, events: dsp.EventSettings, mask: dsp.MaskSettings) -> DataFrame:
    def work(x: np.ndarray) -> tuple:
        y, bounds = dsp.bandpass_mask(x, rate, dsp.detect_events(x, rate, events), mask)
        return y.tolist(), [list(b) for b in bounds]

    return map_signals(df, key, signal, "masked array<double>; bounds array<array<double>>", work)


def resampled(df: DataFrame, key: str, signal: str, rate: int, to: int) -> DataFrame:
    return map_signals(df, key, signal, "resampled array<double>", lambda x: (dsp.resample(x, rate, to).tolist(),))


def encoded(df: DataFrame, key: str, signal: str, rate: int, container: str = "WAV") -> DataFrame:
    """A null or empty signal has null bytes."""
    return map_signals(df, key, signal, "bytes binary", lambda x: (codec.encode(x, rate, container) if len(x) else None,))
