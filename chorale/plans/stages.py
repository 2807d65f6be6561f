"""The dataset pipeline as pure stages, DataFrame to DataFrame; the caller decides what is written.

recordings -> separated -> analysed -> segments -> mixtures. Long arrays travel through a stage once:
filters, splits, balancing and assignment read scalar columns only, and arrays are joined back by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.config import Config
from chorale.functions import codec, dsp, intervals, names, signal
from chorale.operators import detections, mixing, models, noise, sampling
from chorale.schemas import MIXTURES, require


def noise_and_test(soundscapes: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """Half of the soundscapes without any bird as noise, the rest as test."""
    require(soundscapes, "recording_id", "ebird_code", "ebird_code_multilabel", "ebird_code_secondary")
    empty = sampling.no_label(F.col("ebird_code"), F.col("ebird_code_multilabel"), F.col("ebird_code_secondary"))
    return sampling.noise_and_test(soundscapes, empty, "recording_id", config.seed)


def truncate(recordings: DataFrame, rate: int, config: Config) -> DataFrame:
    """``samples`` cut to the longest duration: around the label's times if there are any, else where most energy is."""
    most = int(config.separation.max_duration_s * rate)
    start, end = (F.round(F.col(c) * rate).cast("int") for c in ("start_time", "end_time"))
    area = signal.area_of_interest(F.size("samples"), start, end, most)
    loud = signal.loudest_window(F.col("samples"), most, rate)["start"]
    labelled = F.col("start_time").isNotNull() | F.col("end_time").isNotNull()
    cut = F.when(labelled, F.slice("samples", area["start"] + 1, area["end"] - area["start"])).otherwise(F.slice("samples", loud + 1, most))
    return recordings.withColumn("samples", F.when(F.size("samples") <= most, F.col("samples")).otherwise(cut))


def separate(recordings: DataFrame, rate: int, factory: Callable[[], models.Separator]) -> DataFrame:
    """(recording_id, source_idx, signal)."""
    return models.separate(recordings.select("recording_id", "samples"), "recording_id", "samples", rate, factory)


def analyse(sources: DataFrame, rate: int, factory: Callable[[], models.Detector], config: Config) -> DataFrame:
    """Sources with ``detections``; names normalised."""
    found = models.detect(sources, ["recording_id", "source_idx"], "signal", rate, factory, config.analysis.min_confidence)
    tidy = F.transform(
        "detections",
        lambda d: F.struct(names.normalize_name(d["name"]).alias("name"), d["confidence"].alias("confidence"), d["start"].alias("start"), d["end"].alias("end")),
    )
    return sources.join(found.withColumn("detections", tidy), ["recording_id", "source_idx"])


def _mask(rate: int, events: dsp.EventSettings, mask: dsp.MaskSettings):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for x in part["signal"]:
                found = dsp.detect_events(x, rate, events)
                y, bounds = dsp.bandpass_mask(x, rate, found, mask)
                out.append((y.astype("float32"), [dict(zip(("start", "end"), e, strict=True)) for e in found], [dict(zip(("start", "end", "f_low", "f_high"), b, strict=True)) for b in bounds]))
            yield part.drop(columns="signal").assign(masked=[o[0] for o in out], events=[o[1] for o in out], bounds=[o[2] for o in out])

    return run


def windows(masked: DataFrame, rate: int, n: int, least_tail: int, threshold: float = 0.0) -> DataFrame:
    """Of rows (..., masked, detections, name, events, bounds): the tumbling windows of ``n`` samples that meet an event and
    hold no detection of another name, with ``c`` (segment, start, end, samples) and ``time_freq_bounds`` from the
    window's start."""
    cols = [c for c in masked.columns if c not in ("masked", "events", "bounds")]
    cut = masked.select(*cols, "events", "bounds", F.explode(signal.tumbling(F.col("masked"), n, least_tail)).alias("c"))
    start, end = F.col("c.start") / F.lit(float(rate)), F.col("c.end") / F.lit(float(rate))
    alone = intervals.only_target(F.col("detections"), F.col("name"), start, end, threshold)
    relative = F.transform(
        F.filter("bounds", lambda b: intervals.overlaps(start, end, b["start"], b["end"])),
        lambda b: F.array(F.greatest(b["start"], start) - start, F.least(b["end"], end) - start, b["f_low"], b["f_high"]).cast("array<float>"),
    )
    return cut.where(intervals.any_overlap(start, end, F.col("events")) & alone).select(*cols, "c", relative.alias("time_freq_bounds"))


def segments(
    recordings: DataFrame, analysed: DataFrame, species: DataFrame, rate: int, config: Config,
    events: dsp.EventSettings = dsp.EventSettings(), mask: dsp.MaskSettings = dsp.MaskSettings(),
) -> DataFrame:
    """Segments with one species: of validated sources, masked to their calls, the tumbling windows that hold an event
    and no detection of another species.

    recordings: recording_id, filepath, codes; analysed: recording_id, source_idx, signal, detections;
    species: subset, birdset_code, ebird_code, common_name, scientific_name (normalised)."""
    s = config.segmentation
    by_code = species.select(F.col("birdset_code").alias("code"), F.col("common_name").alias("name"))
    valid = detections.validated_sources(
        analysed.join(recordings.select("recording_id", "codes"), "recording_id"), by_code, s.confidence, s.dominance, s.label_match, s.duplicate_source
    )
    sound = analysed.join(valid.select("recording_id", "source_idx", "name", "code"), ["recording_id", "source_idx"])
    kinds = "recording_id {0}, source_idx int, detections array<struct<name:string,confidence:double,start:double,end:double>>, name string, code {1}".format(
        sound.schema["recording_id"].dataType.simpleString(), sound.schema["code"].dataType.simpleString()
    )
    cols = ["recording_id", "source_idx", "detections", "name", "code"]
    masked = sound.select(*cols, "signal").mapInPandas(
        _mask(rate, events, mask),
        f"{kinds}, masked array<float>, events array<struct<start:double,end:double>>, bounds array<struct<start:double,end:double,f_low:double,f_high:double>>",
    )
    kept = windows(masked, rate, int(s.segment_length_s * rate), int(s.min_tail_s * rate))
    of = recordings.select("recording_id", names.basename(F.col("filepath")).alias("original_file"))
    named = kept.join(of, "recording_id").join(F.broadcast(species), F.col("code") == F.col("birdset_code"))
    return named.select(
        F.concat_ws("-", "recording_id", "source_idx", "c.segment").alias("segment_id"),
        F.col("c.samples").cast("array<float>").alias("samples"), F.lit(rate).cast("long").alias("sampling_rate"),
        "time_freq_bounds", F.col("birdset_code").cast("long").alias("birdset_code"), "ebird_code",
        "scientific_name", "common_name", F.col("subset").alias("original_birdset_subset"), "original_file",
    )


def mixtures(segments_: DataFrame, noise_: DataFrame, rate: int, config: Config) -> DataFrame:
    """split, id, labels, files and what ``mixing.render`` gives. segments: see ``segments``; noise: noise_id,
    samples, at ``rate``. Segments and noise shorter than a segment's length are left out before they take a place."""
    mix, n = config.mix, int(config.segmentation.segment_length_s * rate)
    segments_ = segments_.where(F.size("samples") >= n)
    meta = segments_.select("segment_id", "original_file", "birdset_code")
    if config.balance.enabled:
        b = config.balance
        drawn = sampling.balance(meta, "segment_id", "birdset_code", "original_file", config.seed, b.method, b.max_per_file, b.min_per_class)
        # copies of a segment are rows of their own, shuffled apart from each other
        copy = F.when(F.col("draw") == 0, F.col("segment_id")).otherwise(F.concat_ws("#", "segment_id", "draw"))
        chosen = drawn.withColumn("copy_id", copy).drop("draw")
    else:
        chosen = meta.withColumn("copy_id", F.col("segment_id"))
    split = sampling.split(chosen, "copy_id", mix.test_share, mix.validation_share)
    rows = noise.window_rows(mix.batch_rows, mix.max_polyphony)
    pool = noise.enlarge(noise_.where(F.size("samples") >= n).select("noise_id"), "noise_id", rows, config.seed)
    size = pool.agg(F.max("n_noise")).first()[0]
    parts = []
    for name in ("train", "validation", "test"):
        copies = sampling.replicate(split.where(F.col("split") == name).drop("split"), "copy_id", mix.replications, config.seed)
        batched = copies.withColumn("batch_idx", F.floor(F.col("position") / mix.batch_rows)).withColumn("split", F.lit(name))
        parts.append(batched)
    batched = parts[0].unionByName(parts[1]).unionByName(parts[2])
    placed = mixing.assign(batched, "segment_id", "original_file", ["split", "batch_idx"], "position", config.seed, mix)
    sound = placed.join(segments_.select("segment_id", F.col("samples").alias("signal"), F.col("time_freq_bounds").alias("bounds")), "segment_id")
    paired = sound.withColumn("noise_idx", noise.noise_index(F.col("batch_idx"), F.col("mix_idx"), F.lit(size), rows))
    background = pool.select("noise_idx", "noise_id").join(noise_.select("noise_id", F.col("samples").alias("noise")), "noise_id")
    whole = paired.join(background, "noise_idx")
    keys = ["split", "batch_idx"]
    made = mixing.render(whole, keys, n, rate, config.seed, mix.max_shift_ratio)
    made = made.withColumn("noise_idx", noise.noise_index(F.col("batch_idx"), F.col("mix_idx"), F.lit(size), rows))
    made = made.join(pool.select("noise_idx", F.col("noise_id").alias("noise_file")), "noise_idx").drop("noise_idx")
    lists = (
        placed.join(segments_.select("segment_id", "original_file", "birdset_code"), "segment_id")
        .groupBy(*keys, "mix_idx")
        .agg(F.array_sort(F.collect_list(F.struct("place", "birdset_code", "original_file"))).alias("m"))
    )
    return made.join(lists, [*keys, "mix_idx"]).select(
        F.concat_ws("-", *keys, "mix_idx").alias("id"), "split", F.col("degree").alias("polyphony_degree"),
        F.array_sort(F.array_distinct(F.transform("m", lambda r: r["birdset_code"].cast("int")))).alias("birdset_code_multilabel"),
        F.transform("m", lambda r: r["original_file"]).alias("raw_files_original_file"),
        *(c for c in made.columns if c not in (*keys, "mix_idx", "degree")),
    )


def encoded(mixed: DataFrame, rate: int, container: str = "WAV") -> DataFrame:
    """Mixtures with encoded audio, in the columns and types of ``schemas.MIXTURES``, and their split."""

    @F.pandas_udf("binary")
    def encode(signals: pd.Series) -> pd.Series:
        return signals.map(lambda x: codec.encode(x, rate, container))

    def audio(column: str, suffix: str) -> Column:
        path = F.concat("id", F.lit(f"{suffix}.{container.lower()}"))
        return F.struct(encode(column).alias("bytes"), path.alias("path"))

    unit = F.when(F.col("noise_rms") > 0, 1 / F.col("noise_rms"))
    columns = {
        "id": F.col("id"), "audio": audio("mixed", ""), "no_noise_audio": audio("clean", "-no-noise"),
        "polyphony_degree": F.col("polyphony_degree"), "birdset_code_multilabel": F.col("birdset_code_multilabel"),
        "noise_file": F.col("noise_file"), "noise_orig_rms": F.col("noise_rms"), "noise_dBFS": F.col("noise_dbfs"),
        "noise_norm_gain": unit, "noise_gain": F.col("noise_gain"), "mix_orig_rms": F.col("mix_rms"),
        "mix_dBFS": F.col("mix_dbfs"), "mix_gain": F.col("mix_gain"), "raw_files_event_rms": F.col("event_rms"),
        "raw_files_norm_gain": F.col("norm_gain"), "raw_files_relative_dBFS": F.col("relative_dbfs"),
        "raw_files_gain": F.col("gain"), "shifted_time_freq_bounds": F.col("shifted_bounds"),
    }
    return mixed.select(*(columns[f.name].cast(f.dataType).alias(f.name) for f in MIXTURES.fields), "split")
