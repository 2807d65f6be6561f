"""Signal processing: numpy kernels and Column expressions on small made signals."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chorale.functions import codec, dsp, flac, intervals, names, signal

RATE = 22_050


def tone(hz: float, seconds: float, rate: int = RATE) -> np.ndarray:
    return np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)


def column(spark, **values):
    return spark.range(1).select(*(F.expr(v).alias(k) for k, v in values.items()))


def one(df, expression):
    return df.select(expression.alias("r")).first()["r"]


def test_bursts_are_found_and_near_ones_merge():
    x = np.concatenate([np.zeros(RATE), tone(2000, 0.3), np.zeros(int(0.01 * RATE)), tone(2000, 0.3), np.zeros(RATE), tone(2000, 0.2), np.zeros(RATE)])
    events = dsp.detect_events(x, RATE)
    assert len(events) == 2
    assert events[0] == pytest.approx((1.0, 1.61), abs=0.03)
    assert events[1] == pytest.approx((2.61, 2.81), abs=0.03)
    assert dsp.detect_events(np.zeros(RATE), RATE) == []
    assert dsp.detect_events(np.zeros(0), RATE) == []


def test_mask_keeps_the_band_of_its_event():
    x = np.concatenate([tone(1000, 0.5), np.zeros(RATE // 2), tone(6000, 0.5)])
    y, bounds = dsp.bandpass_mask(x, RATE, [(0.1, 0.4)])  # inside the tone: its ends are broadband
    assert len(y) == len(x)
    assert bounds[0][2] < 1000 < bounds[0][3] < 2000
    assert np.abs(y[RATE // 5 : RATE // 4]).max() > 0.8
    assert np.abs(y[-RATE // 4 :]).max() < 1e-6
    assert dsp.bandpass_mask(np.zeros(4000), RATE, [(0.0, 0.1)])[1] == []


def test_stft_and_back():
    x = tone(440, 0.3) * np.linspace(0, 1, int(0.3 * RATE))
    assert np.allclose(dsp.istft(dsp.stft(x, 1024, 256), 1024, 256, len(x)), x, atol=1e-9)


def test_resample_keeps_a_tone():
    y = dsp.resample(tone(100, 1.0, 1000), 1000, 4000)
    assert len(y) == 4000
    assert np.allclose(y, tone(100, 1.0, 4000), atol=1e-6)


def test_loudest_region_prefers_the_first():
    x = np.zeros(100)
    x[[20, 70]] = 1
    assert dsp.loudest_region(x, 10, 5) == (15, 25)
    assert dsp.loudest_region(x[:5], 10, 5) == (0, 5)


def test_wav_round_trip():
    x = tone(440, 0.05) * 2
    y, rate = codec.decode_wav(codec.encode(x, 8000))
    assert rate == 8000
    assert np.allclose(y, x / np.abs(x).max(), atol=1e-4)
    with pytest.raises(ValueError):
        codec.encode(np.zeros(0), 8000)


@pytest.mark.parametrize("n", [1, 2, 5, 4096, 4097, 9000])
def test_flac_round_trip(n):
    rng = np.random.default_rng(n)
    tone = np.sin(np.arange(n) / 9) * 20_000
    for x in (rng.integers(-(1 << 15), 1 << 15, n), tone, np.full(n, -3), np.cumsum(rng.integers(-4, 5, n))):
        x = x.astype(np.int16)
        got, rate = flac.decode(flac.encode(x, 22_050))
        assert rate == 22_050
        assert (np.round(got[:, 0] * 32767).astype(int) == x).all()
    assert len(flac.encode(tone.astype(np.int16), 22_050)) < 2 * n + 100


def test_damaged_and_unknown_files_raise():
    data = bytearray(codec.encode(np.sin(np.arange(5000) / 7), 8000, "FLAC"))
    data[len(data) // 2] ^= 0x10
    with pytest.raises((ValueError, IndexError)):
        codec.decode(bytes(data))
    with pytest.raises(ValueError):
        codec.decode(b"OggS" + bytes(20))


def test_frame_numbers_are_coded_like_characters():
    for n in (0, 127, 128, 2047, 2048, 65_535, 65_536, 0x10FFFF):
        assert flac._number(n) == chr(n).encode()
    assert [len(flac._number(n)) for n in ((1 << 26) - 1, (1 << 31) - 1, (1 << 36) - 1)] == [5, 6, 7]


@given(st.lists(st.floats(-1, 1, width=32), max_size=40), st.integers(1, 9))
def test_moving_average_is_numpy_same(x, n):
    if x:
        assert np.allclose(dsp.moving_average(np.array(x), n), np.convolve(x, np.ones(n) / n, "same"))


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9])
@pytest.mark.parametrize("size", [1, 3, 8])
def test_moving_average_column(spark, n, size):
    values = [float(i * i % 7) for i in range(size)]
    df = column(spark, x=f"array({','.join(f'{v}D' for v in values)})")
    assert one(df, signal.moving_average(F.col("x"), n)) == pytest.approx(np.convolve(values, np.ones(n) / n, "same").tolist())


def test_tumbling_tails(spark):
    df = column(spark, x="transform(sequence(1, 11), v -> double(v))", empty="cast(array() as array<double>)")
    whole = one(df, signal.tumbling(F.col("x"), 4))
    assert [r["samples"] for r in whole] == [[1, 2, 3, 4], [5, 6, 7, 8]]
    padded = one(df, signal.tumbling(F.col("x"), 4, 3))
    assert padded[-1]["samples"] == [9, 10, 11, 0]
    assert padded[-1]["end"] == 11
    assert one(df, signal.tumbling(F.col("empty"), 4, 1)) == []


def test_levels(spark):
    df = column(spark, x="array(0.5D, -0.5D, 0.5D, -0.5D)", zero="array(0D, 0D)")
    assert one(df, signal.rms(F.col("x"))) == pytest.approx(0.5)
    gain = signal.level_gain(F.lit(-6.0), signal.rms(F.col("x")))
    assert one(df, signal.rms(signal.scale(F.col("x"), gain))) == pytest.approx(10 ** (-6 / 20))
    assert one(df, signal.level_gain(F.lit(-6.0), signal.rms(F.col("zero")))) is None


def test_intervals(spark):
    df = column(spark, e="array(named_struct('start', 1D, 'end', 2D), named_struct('start', 3D, 'end', 5D))", n="cast(null as array<struct<start:double,end:double>>)")
    assert one(df, intervals.any_overlap(F.lit(2.0), F.lit(3.0), F.col("e"))) is False
    assert one(df, intervals.any_overlap(F.lit(1.9), F.lit(3.0), F.col("e"))) is True
    assert one(df, intervals.any_overlap(F.lit(0.0), F.lit(9.0), F.col("n"))) is False
    cut = one(df, intervals.clip(F.lit(1.5), F.lit(4.0), F.col("e")))
    assert [(c["start"], c["end"]) for c in cut] == [(0, 0.5), (1.5, 2.5)]
    merged = one(df, intervals.merge_gaps(F.col("e"), F.lit(1.0)))
    assert [(m["start"], m["end"]) for m in merged] == [(1, 5)]


def test_names(spark):
    df = column(spark, p="'a/b/my.song.ogg'", n="'\t Great  Tit '")
    assert one(df, names.stem(F.col("p"))) == "my.song"
    assert one(df, names.normalize_name(F.col("n"))) == "great__tit"
