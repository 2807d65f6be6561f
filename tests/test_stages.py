"""The dataset pipeline end to end with deterministic models, sources and sinks, and streams."""

from __future__ import annotations

import json
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from chorale.config import Balance, Config, Mix, Segmentation, Separation
from chorale.functions import codec, dsp
from chorale.operators import models, sampling
from chorale.plans import stages
from chorale.schemas import MIXTURES
from chorale.sources import readers, sinks
from chorale.streaming import events as streams

RATE = 64
CONFIG = Config(
    separation=Separation(max_duration_s=30),
    segmentation=Segmentation(segment_length_s=2.0, min_tail_s=0.5),
    mix=Mix(max_polyphony=2, replications=2, batch_rows=10, test_share=0.2, validation_share=0.2),
)
EVENTS = dsp.EventSettings(frame_ms=125, hop_ms=31.25, smooth_ms=93.75, threshold_ratio=0.2, min_gap_ms=100, min_call_ms=50)
MASK = dsp.MaskSettings(n_fft=32, smooth_bins=3, edge_bins=1)


# factories must be importable on the executors, where this module is not
two_sources = partial(models.BandSplitter, RATE, 2)
detector = partial(models.LevelDetector, RATE, EVENTS)


def recordings(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(40):
        t = np.arange(6 * RATE) / RATE
        x = np.sin(2 * np.pi * (5 + i % 20) * t) * (np.sin(2 * np.pi * 0.5 * t) > 0) + rng.normal(size=len(t)) * 0.001
        rows.append((f"r{i}", f"path/to/file{i % 12}.ogg", x.astype(float).tolist(), [i % 4, (i + 1) % 4, 2], None if i % 2 else 1.0, None))
    return spark.createDataFrame(rows, "recording_id string, filepath string, samples array<float>, codes array<int>, start_time double, end_time double")


def test_pipeline(spark):
    species = spark.createDataFrame(
        [("HSN", i, f"code{i}", n, f"{n}_sci") for i, n in enumerate(models.LevelDetector.NAMES)],
        "subset string, birdset_code int, ebird_code string, common_name string, scientific_name string",
    )
    rec = stages.truncate(recordings(spark), RATE, CONFIG).cache()
    apart = stages.separate(rec, RATE, two_sources)
    assert apart.count() == 80
    analysed = stages.analyse(apart, RATE, detector, CONFIG)
    found = stages.segments(rec, analysed, species, RATE, CONFIG, EVENTS, MASK).cache()
    rows = found.collect()
    assert rows
    assert all(len(r["samples"]) == 2 * RATE for r in rows)
    assert all(0 <= b[0] <= b[1] <= 2.0 for r in rows for b in r["time_freq_bounds"])
    assert len({r["segment_id"] for r in rows}) == len(rows)
    noise = spark.createDataFrame([(f"n{i}", np.random.default_rng(i).normal(size=2 * RATE + i).tolist()) for i in range(9)], "noise_id string, samples array<double>")
    made = stages.mixtures(found, noise, RATE, CONFIG).cache()
    mixed = made.collect()
    assert mixed
    assert len({m["id"] for m in mixed}) == len(mixed)
    for m in mixed:
        assert len(set(m["raw_files_original_file"])) == m["polyphony_degree"] == len(m["gain"]) == len(m["shifted_bounds"])
        assert len(m["mixed"]) == 2 * RATE
    out = stages.encoded(made, RATE)
    assert [(f.name, f.dataType) for f in out.schema.fields[:-1]] == [(f.name, f.dataType) for f in MIXTURES.fields]
    row = out.first()
    samples, rate = codec.decode_wav(row["audio"]["bytes"])
    assert (len(samples), rate, row["audio"]["path"]) == (2 * RATE, RATE, f"{row['id']}.wav")


@pytest.mark.parametrize("method", ["undersample", "oversample", "controlled_oversample"])
def test_mixtures_balance_by_the_method(spark, monkeypatch, method):
    rows = [(f"s{i}", f"f{i}", 0 if i == 0 else 1 + (i % 3 == 0), [0.5] * RATE, [[0.0, 1.0]]) for i in range(40)]
    found = spark.createDataFrame(rows, "segment_id string, original_file string, birdset_code int, samples array<double>, time_freq_bounds array<array<double>>")
    noise = spark.createDataFrame([(f"n{i}", [0.1] * RATE) for i in range(3)], "noise_id string, samples array<double>")
    seen = []
    split = sampling.split
    monkeypatch.setattr(sampling, "split", lambda df, *a: seen.append(df) or split(df, *a))
    config = Config(segmentation=Segmentation(segment_length_s=1.0), mix=CONFIG.mix, balance=Balance(enabled=True, method=method, max_per_file=1, min_per_class=10))
    assert stages.mixtures(found, noise, RATE, config).count() > 0
    n = 13 if method == "undersample" else 26
    assert dict(seen[0].groupBy("birdset_code").count().collect()) == {1: n, 2: n}
    assert seen[0].select("copy_id").distinct().count() == 2 * n


def test_noise_and_test(spark):
    rows = [(f"s{i}", None if i % 2 else i, [] if i % 2 else [i], None) for i in range(20)]
    df = spark.createDataFrame(rows, "recording_id string, ebird_code bigint, ebird_code_multilabel array<bigint>, ebird_code_secondary array<string>")
    noise, test = stages.noise_and_test(df, CONFIG)
    assert (noise.count(), test.count()) == (5, 15)


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "codes.json").write_text(json.dumps({"id2label": {"0": "aaa", "1": "bbb"}, "label2id": {}}))
    codes = readers.code_map(spark, str(tmp_path / "codes.json"), "X").collect()
    assert sorted((r["birdset_code"], r["ebird_code"]) for r in codes) == [(0, "aaa"), (1, "bbb")]
    (tmp_path / "tax.csv").write_text("SPECIES_CODE,PRIMARY_COM_NAME,SCI_NAME\nAAA,Great Tit,Parus major\naaa,Other,Other\n")
    assert readers.taxonomy(spark, str(tmp_path / "tax.csv")).where("position = 1").count() == 1
    df = spark.range(30).withColumn("split", F.when(F.col("id") < 20, "train").otherwise("test"))
    sinks.publish(df, str(tmp_path), "HSN")
    assert {k: v.count() for k, v in readers.valid_splits(spark, f"{tmp_path}/HSN").items()} == {"train": 20, "test": 10}
    path = f"{tmp_path}/t"
    sinks.write(df, path)
    sinks.replace(readers.table(spark, path).where("id < 3"), path)
    assert readers.table(spark, path).count() == 3
    assert readers.table(spark, f"{path}-backup").count() == 30
    a, b = (sinks.manifest(d, ["id"]) for d in (df, df.repartition(5)))
    assert a["fingerprint"] == b["fingerprint"]
    sinks.write_manifest(spark, f"{tmp_path}/m.json", a)
    assert json.loads((tmp_path / "m.json").read_text())["num_rows"] == 30
    (tmp_path / "a.wav").write_bytes(codec.encode(np.sin(np.arange(800) / 5), 800))
    got = readers.wav_files(spark, str(tmp_path / "a.wav"), 400).first()
    assert got["n_samples"] == 400
    (tmp_path / "b.flac").write_bytes(codec.encode(np.sin(np.arange(800) / 5), 800, "FLAC"))
    found = readers.audio_files(spark, str(tmp_path), 400).collect()
    assert sorted(r["filepath"][-4:] for r in found) == [".wav", "flac"]
    assert np.abs(np.array(found[0]["samples"]) - np.array(found[1]["samples"])).max() < 1e-4


def test_keyed_state_counts_over_batches(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(k, float(i + k)) for k in (1, 2, 2)], "k long, value double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = streams.read(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, 1)
    seen = []
    out = streams.totals(stream, "k", "value").writeStream.outputMode("update").foreachBatch(lambda df, i: seen.append({r["k"]: (r["n"], r["total"]) for r in df.collect()}))
    out.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert [s[2][0] for s in seen] == [2, 4, 6]
    assert seen[-1] == {1: (3, 6.0), 2: (6, 18.0)}


def test_streams(spark, tmp_path):
    spark.sql("SELECT id % 3 AS user_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id) * 7, 0) AS ts, double(id) AS value FROM range(100)").selectExpr(
        "user_id", "cast(ts as timestamp) as ts", "value"
    ).repartition(4).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    got = []
    stream = streams.read(spark, f"{tmp_path}/in", schema)
    streams.in_batches(stream, lambda df, i: got.append(df.count()), f"{tmp_path}/c1").awaitTermination()
    assert sum(got) == 100
    out = streams.counts(streams.read(spark, f"{tmp_path}/in", schema, 10), "ts", "user_id", "1 hour")
    out.writeStream.format("memory").queryName("counted").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("counted").agg(F.sum("n")).first()[0] == 100
    out = streams.sessions(streams.read(spark, f"{tmp_path}/in", schema, 10), "ts", "user_id", "20 minutes")
    out.writeStream.format("memory").queryName("sessions").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c3").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("sessions").agg(F.sum("n")).first()[0] == 100


def test_command_line(spark, tmp_path):
    from chorale import cli

    recordings(spark).write.parquet(f"{tmp_path}/raw")
    common = ["--rate", str(RATE)]
    cli.main(["ingest", "--input", f"{tmp_path}/raw", "--output", f"{tmp_path}/in", *common])
    assert json.loads((tmp_path / "in.manifest.json").read_text())["num_rows"] == 40
    cli.main(["separate", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/apart", "--model", "chorale.operators.models:BandSplitter", *common])
    assert spark.read.parquet(f"{tmp_path}/apart").count() == 160
    with pytest.raises(SystemExit):
        cli.main(["mix", "--input", "x", "--output", "y"])
