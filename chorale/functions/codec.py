"""Encoding of samples. WAV and FLAC need no library; other containers, such as OGG, are registered by name."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable

import numpy as np

from chorale.functions import flac


def _wav(x: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.round(x * 32767).astype("<i2").tobytes())
    return out.getvalue()


def _flac(x: np.ndarray, rate: int) -> bytes:
    return flac.encode(np.round(x * 32767).astype(np.int16), rate)


ENCODERS: dict[str, Callable[[np.ndarray, int], bytes]] = {"WAV": _wav, "FLAC": _flac}


def encode(samples: np.ndarray, rate: int, container: str = "WAV", normalize: bool = True) -> bytes:
    """Samples are divided by their peak where it is over 1, then clipped. No samples or no rate: ValueError."""
    x = np.asarray(samples, float)
    if not len(x) or rate <= 0:
        raise ValueError("nothing to encode")
    if container not in ENCODERS:
        raise ValueError(f"no encoder for {container}; there are {sorted(ENCODERS)}")
    peak = float(np.abs(x).max())
    if normalize and peak > 1:
        x = x / peak
    return ENCODERS[container](np.clip(x, -1, 1), int(rate))


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    with wave.open(io.BytesIO(data)) as f:
        x = np.frombuffer(f.readframes(f.getnframes()), "<i2").astype(float) / 32767
        return x.reshape(-1, f.getnchannels()).mean(axis=1), f.getframerate()


def _decode_flac(data: bytes) -> tuple[np.ndarray, int]:
    x, rate = flac.decode(data)
    return x.mean(axis=1), rate


#: By the first four bytes of a file.
DECODERS: dict[bytes, Callable[[bytes], tuple[np.ndarray, int]]] = {b"RIFF": decode_wav, b"fLaC": _decode_flac}


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """Samples of one channel (the mean of several) and their rate. No decoder: ValueError."""
    found = DECODERS.get(bytes(data[:4]))
    if found is None:
        raise ValueError(f"no decoder for a file that begins with {bytes(data[:4])!r}")
    return found(data)
