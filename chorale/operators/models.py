"""Pluggable models: separators (one signal to several) and detectors (a signal to labelled intervals).

A model is made once per Python worker by its factory; factories must be importable on the executors. A trained network
joins by a class of this form, whose file must be readable there too::

    class Network:
        rate = 22_050

        def __init__(self, path):
            self.session = onnxruntime.InferenceSession(path)

        def separate(self, x):
            (sources,) = self.session.run(None, {"mixture": x[None, None].astype("float32")})
            return list(sources[0])

    models.separate(recordings, "recording_id", "samples", 44_100, functools.partial(Network, "/shared/model.onnx"))

Signals are resampled to the model's ``rate`` before it sees them. A detector gives (name, confidence, start s, end s).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from chorale.functions import dsp


class Separator(Protocol):
    rate: int

    def separate(self, x: np.ndarray) -> list[np.ndarray]: ...


class Detector(Protocol):
    rate: int

    def detect(self, x: np.ndarray) -> list[tuple[str, float, float, float]]:
        """(name, confidence, start s, end s) of each detection."""


class BandSplitter:
    """A deterministic separator: the signal's spectrum cut into equal bands."""

    def __init__(self, rate: int = 16, sources: int = 4):
        self.rate, self.sources = rate, sources

    def separate(self, x: np.ndarray) -> list[np.ndarray]:
        spectrum = np.fft.rfft(x)
        cuts = np.linspace(0, len(spectrum), self.sources + 1).astype(int)
        out = []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            part = np.zeros_like(spectrum)
            part[i:j] = spectrum[i:j]
            out.append(np.fft.irfft(part, len(x)) if len(x) else x)
        return out


class LevelDetector:
    """A deterministic detector: events by level, named by the loudest quarter of the spectrum."""

    NAMES = ("low", "mid_low", "mid_high", "high")

    def __init__(self, rate: int = 16, settings: dsp.EventSettings = dsp.EventSettings(250, 62.5, 125, 0.5, 100, 50)):
        self.rate, self.settings = rate, settings

    def detect(self, x: np.ndarray) -> list[tuple[str, float, float, float]]:
        out = []
        for start, end in dsp.detect_events(x, self.rate, self.settings):
            power = np.abs(np.fft.rfft(x[int(start * self.rate) : max(int(np.ceil(end * self.rate)), int(start * self.rate) + 1)])) ** 2
            quarters = [float(q.sum()) for q in np.array_split(power, 4)]
            total = sum(quarters) or 1.0
            best = int(np.argmax(quarters))
            out.append((self.NAMES[best], quarters[best] / total, start, end))
        return out


@cache
def _model(factory: Callable):
    return factory()


def _signal(x, rate: int, to: int) -> np.ndarray:
    return dsp.resample(np.asarray([] if x is None else x, float), rate, to)


def separate(df: DataFrame, key: str, signal: str, rate: int, factory: Callable[[], Separator]) -> DataFrame:
    """One row per key and source: key, source_idx, signal, at the model's rate."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(factory)
        for part in parts:
            rows = [(k, i, s.astype(np.float32)) for k, x in zip(part[key], part[signal], strict=True) for i, s in enumerate(model.separate(_signal(x, rate, model.rate)))]
            yield pd.DataFrame(rows, columns=[key, "source_idx", "signal"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, signal).mapInPandas(run, f"{key} {kind}, source_idx int, signal array<float>")


def detect(df: DataFrame, keys: list[str], signal: str, rate: int, factory: Callable[[], Detector], least: float = 0.2) -> DataFrame:
    """Keys and ``detections`` of at least the confidence ``least``, in order of start."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(factory)
        for part in parts:
            found = []
            for x in part[signal]:
                got = [d for d in model.detect(_signal(x, rate, model.rate)) if d[1] >= least]
                found.append([dict(zip(("name", "confidence", "start", "end"), d, strict=True)) for d in got])
            yield part[keys].assign(detections=found)

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, signal).mapInPandas(run, f"{kinds}, detections array<struct<name:string,confidence:double,start:double,end:double>>")
