"""Signal processing in numpy, for Arrow batches: what Column expressions can't express.

Conventions: frames are centred and zero-padded, windows are periodic Hann, smoothing reflects at the ends.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def frames(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Rows of ``size`` samples, centred on multiples of ``hop``."""
    padded = np.pad(x, size // 2)
    if len(padded) < size:
        padded = np.pad(padded, (0, size - len(padded)))
    return np.lib.stride_tricks.sliding_window_view(padded, size)[::hop]


def rms_envelope(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    return np.sqrt((frames(np.asarray(x, float), size, hop) ** 2).mean(axis=1))


def moving_average(x: np.ndarray, n: int) -> np.ndarray:
    return np.convolve(x, np.ones(n) / n, mode="same") if len(x) else x


@dataclass(frozen=True)
class EventSettings:
    frame_ms: float = 20
    hop_ms: float = 5
    smooth_ms: float = 25
    threshold_ratio: float = 0.1
    min_gap_ms: float = 20
    min_call_ms: float = 10


def detect_events(x: np.ndarray, rate: int, s: EventSettings = EventSettings()) -> list[tuple[float, float]]:
    """(onset, offset) in seconds of the stretches whose smoothed level is over a share of the largest."""
    hop, size = max(1, int(s.hop_ms / 1000 * rate)), max(1, int(s.frame_ms / 1000 * rate))
    if not len(x):
        return []
    level = moving_average(rms_envelope(x, size, hop), int(s.smooth_ms / s.hop_ms) or 1)
    loud = level > s.threshold_ratio * level.max()
    edge = np.diff(loud.astype(np.int8), prepend=0, append=0)
    times = np.arange(len(level)) * hop / rate
    onsets = times[np.flatnonzero(edge == 1)]
    offsets = times[np.minimum(np.flatnonzero(edge == -1), len(level) - 1)]
    merged: list[list[float]] = []
    for on, off in zip(onsets.tolist(), offsets.tolist(), strict=True):
        if merged and on - merged[-1][1] <= s.min_gap_ms / 1000:
            merged[-1][1] = off
        else:
            merged.append([on, off])
    return [(on, off) for on, off in merged if off - on >= s.min_call_ms / 1000]


def smooth_reflect(x: np.ndarray, n: int) -> np.ndarray:
    """Uniform mean over ``n`` values, the ends mirrored with the edge value repeated."""
    before = n // 2
    return np.convolve(np.pad(x, (before, n - 1 - before), mode="symmetric"), np.ones(n) / n, mode="valid")


def weighted_percentile(weights: np.ndarray, at: np.ndarray, percent: float) -> float:
    """The place below which ``percent`` of the weight lies, between places by straight lines."""
    return float(np.interp(percent / 100, np.cumsum(weights / weights.sum()), at))


def stft(x: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    window = np.hanning(n_fft + 1)[:-1]
    return np.fft.rfft(frames(x, n_fft, hop) * window, axis=1).T


def istft(spectrum: np.ndarray, n_fft: int, hop: int, length: int) -> np.ndarray:
    window = np.hanning(n_fft + 1)[:-1]
    parts = np.fft.irfft(spectrum.T, n_fft, axis=1) * window
    out, norm = np.zeros(n_fft + hop * (len(parts) - 1)), np.zeros(n_fft + hop * (len(parts) - 1))
    for i, part in enumerate(parts):
        out[i * hop : i * hop + n_fft] += part
        norm[i * hop : i * hop + n_fft] += window**2
    body = np.where(norm > 1e-10, out / np.maximum(norm, 1e-10), 0.0)[n_fft // 2 :]
    return np.pad(body, (0, max(0, length - len(body))))[:length]


@dataclass(frozen=True)
class MaskSettings:
    n_fft: int = 1024
    collapse: str = "max"
    smooth_bins: int = 5
    low_percent: float = 2
    high_percent: float = 98
    edge_bins: int = 5


def bandpass_mask(x: np.ndarray, rate: int, events: list[tuple[float, float]], s: MaskSettings = MaskSettings()) -> tuple[np.ndarray, list[tuple[float, float, float, float]]]:
    """The signal inside the events and inside each event's band, and (start, end, low Hz, high Hz) of each.

    The band holds the energy between two percentiles of the event's collapsed spectrum; its edges fall off
    linearly over ``edge_bins`` bins. Frames outside all events are silent; events without energy have no band.
    """
    hop = s.n_fft // 4
    x = np.asarray(x, float)
    if not len(x):
        return x, []
    spectrum = stft(x, s.n_fft, hop)
    power, hz = np.abs(spectrum), np.fft.rfftfreq(s.n_fft, 1 / rate)
    mask, bounds = np.zeros(power.shape), []
    collapse = {"max": np.max, "median": np.median, "mean": np.mean}[s.collapse]
    for start, end in events:
        first = max(0, int(np.floor(start * rate / hop)))
        last = min(power.shape[1], int(np.ceil(end * rate / hop)))
        if first >= last:
            continue
        shape = smooth_reflect(collapse(power[:, first:last], axis=1), s.smooth_bins)
        if shape.sum() <= 0:
            continue
        low, high = (weighted_percentile(shape, hz, p) for p in (s.low_percent, s.high_percent))
        bounds.append((float(start), float(end), low, high))
        lo, hi = (min(int(np.searchsorted(hz, f)), len(hz) - 1) for f in (low, high))
        bins = np.arange(len(hz))
        outside = np.maximum(np.maximum(lo - bins, bins - hi), 0)
        column = np.maximum(1 - outside / (s.edge_bins + 1), 0)
        mask[:, first:last] = np.maximum(mask[:, first:last], column[:, None])
    return istft(spectrum * mask, s.n_fft, hop, len(x)), bounds


def resample(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Band-limited, by the spectrum; ceil(n * to / rate) samples."""
    x = np.asarray(x, float)
    if rate == to or not len(x):
        return x
    n = int(np.ceil(len(x) * to / rate))
    spectrum = np.fft.rfft(x)
    bins = n // 2 + 1
    kept = np.zeros(bins, complex)
    kept[: min(bins, len(spectrum))] = spectrum[:bins]
    return np.fft.irfft(kept, n) * (n / len(x))


def mono(x: np.ndarray) -> np.ndarray:
    """The mean of the channels of shape (channels, samples)."""
    return x if x.ndim == 1 else x.mean(axis=0)


def loudest_region(x: np.ndarray, n: int, hop: int) -> tuple[int, int]:
    """First and end sample of the ``n`` samples of most energy on a grid of ``hop``; the first of equal ones."""
    if len(x) <= n:
        return 0, len(x)
    total = np.concatenate([[0.0], np.cumsum(np.asarray(x, float) ** 2)])
    starts = np.arange(0, len(x) - n + 1, hop)
    best = int(starts[np.argmax(total[starts + n] - total[starts])])
    return best, best + n
