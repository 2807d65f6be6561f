"""Registered queries: each operator over whole tables of the driver.

``embeddings`` stand for signals (64 samples at a nominal 16 Hz), ``events`` for detections, ``documents`` for
segments (lang: species, source: file), ``nation`` and ``region`` for code map and taxonomy, ``labels`` for
annotations of some documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.config import Config, Mix, Separation
from chorale.functions import dsp, hashing, intervals, names, signal, times
from chorale.operators import audio, detections, events, flatten, lookup, mixing, models, noise, sampling
from chorale import schemas, session
from chorale.plans import stages
from chorale.plans.oracles import ORACLE_SQL
from chorale.sources import readers, sinks
from chorale.streaming import events as streams

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict = {}
RATE, SEED = 16, 42
#: Line numbers repeat inside an order, so that their order needs more columns to be total.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
#: At 16 Hz frames must be longer than at audio rates.
SLOW_EVENTS = dsp.EventSettings(frame_ms=250, hop_ms=62.5, smooth_ms=125, threshold_ratio=0.5, min_gap_ms=100, min_call_ms=50)
SLOW_MASK = dsp.MaskSettings(n_fft=16, smooth_bins=3, edge_bins=1)


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.table(spark, f"{sf_dir}/{name}.parquet")


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intervals of one hour."""
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts", (F.col("ts") + F.expr("interval 1 hour")).alias("te"))


def signals(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("x"), *more)


def rounded(x: Column, digits: int = 6) -> Column:
    return F.transform(x, lambda v: F.round(v, digits) + 0.0)


# labels, lookups and filters


@query
def dominant_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    confident = table(spark, sf_dir, "events").where(F.col("value") > 20)
    return detections.dominant_label(confident, ["user_id"], "event_type", ["ts", "event_id"], 0.1)


@query
def most_confident_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections.most_confident(table(spark, sf_dir, "events"), ["user_id"], "value", ["ts", "event_id"], ["event_id", "event_type", "value"])


@query
def no_label_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.select("doc_id", "lang", "source").join(labels.select("doc_id"), "doc_id", "left_anti")


@query
def no_label_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 3 != 0, F.col("p_size")).alias("code"),
        F.when(F.col("p_size") % 5 != 0, F.when(F.col("p_size") % 2 == 0, F.array().cast("array<int>")).otherwise(F.array("p_size"))).alias("codes"),
        F.when(F.col("p_partkey") % 7 == 0, F.col("p_name")).alias("secondary"),
    )
    return parts.where(sampling.no_label(F.col("code"), F.col("codes"), F.col("secondary"))).select("p_partkey")


@query
def half_sample_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    plain = docs.select("doc_id").join(labels.select("doc_id"), "doc_id", "left_anti")
    out = sampling.half_sample(plain, "doc_id", SEED)
    return out.select("doc_id", F.when(F.col("sampled"), "noise").otherwise("test").alias("part"))


@query
def key_blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(~F.col("o_orderkey").isin(1, 7, 1757)).select("o_orderkey", "o_custkey")


@query
def duration_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(signal.lasts(F.col("n_chars"), RATE, 100))
    return docs.select("doc_id", signal.duration_s(F.col("n_chars"), F.lit(RATE)).alias("duration_s"))


@query
def code_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    codes = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"))
    return lookup.lookup(customers, F.broadcast(codes), F.col("c_nationkey").cast("string") == F.col("code")).select("c_custkey", "code", "name")


@query
def taxonomy_ci_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes are the last digit of nation names in lower case; several nations of a region share one."""
    code = F.concat(F.lit("n_"), F.substring("n_name", -1, 1))
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    taxonomy = nations.join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.upper(code).alias("SPECIES_CODE"), F.col("r_name").alias("PRIMARY_COM_NAME"), F.concat("n_name", F.lit(" "), "r_name").alias("SCI_NAME"), "n_nationkey"
    )
    codes = nations.select(F.lit("HSN").alias("subset"), F.col("n_nationkey").alias("birdset_code"), code.alias("ebird_code"))
    return lookup.code_names(codes, taxonomy, ["n_nationkey"]).select("birdset_code", "ebird_code", "common_name", "scientific_name")


def _membership(spark: SparkSession, sf_dir: str, match: str) -> DataFrame:
    """Codes of an order: part keys modulo 25 in order of the lines; detected: the nation of the customer key modulo 25."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER, (F.col("l_partkey") % 25).alias("code"))
    codes = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*LINE_ORDER, "code"))).alias("rows"))
    nations = table(spark, sf_dir, "nation")
    as_map = nations.agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("bigint"), "n_name"))).alias("names"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("NATION_"), F.col("o_custkey") % 25).alias("detected"))
    joined = orders.join(codes, F.col("o_orderkey") == F.col("l_orderkey")).join(F.broadcast(as_map))
    held = F.transform("rows", lambda r: r["code"])
    return joined.select("o_orderkey", "detected", lookup.membership(held, F.col("names"), F.col("detected"), match).alias("valid"))


@query
def label_membership_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _membership(spark, sf_dir, "first")


@query
def label_membership_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _membership(spark, sf_dir, "any")


@query
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.initcap("p_name"), F.lit("\n"))
    return table(spark, sf_dir, "part").select("p_partkey", names.normalize_name(padded).alias("name"))


@query
def basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", names.basename(url).alias("base"), names.stem(url).alias("stem"),
        names.output_path(F.lit("out/"), url, F.col("page_id").cast("string")).alias("path"),
    )


@query
def label_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", names.label(F.col("p_type"), F.col("p_brand")).alias("label"))


# intervals and windows over events


@query
def interval_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_events = timed(spark, sf_dir)
    clicks, errors = (all_events.where(F.col("event_type") == t) for t in ("click", "error"))
    return events.overlap_semi(clicks, errors, ["user_id"], "ts", "te", 3600).select("event_id", "user_id")


@query
def interval_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event against the hours that it meets, in seconds from the hour."""
    start, end = (times.micros(F.col(c)) / 1e6 for c in ("ts", "te"))
    day = F.floor(start / 86400) * 86400
    rel = timed(spark, sf_dir).select("event_id", (start - day).alias("s"), (end - day).alias("e"))
    bounds = F.array(F.struct(F.col("s").alias("start"), F.col("e").alias("end")))
    hours = F.explode(F.sequence(F.floor(F.col("s") / 3600), F.floor(F.col("e") / 3600)))
    binned = rel.select("event_id", hours.alias("hour"), bounds.alias("bounds"))
    low = F.col("hour") * 3600.0
    clipped = binned.select("event_id", "hour", F.explode(intervals.clip(low, low + 3600.0, F.col("bounds"))).alias("b"))
    return clipped.select("event_id", "hour", F.round("b.start", 3).alias("rel_start"), F.round("b.end", 3).alias("rel_end"))


@query
def only_target_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections.only_target_in_window(timed(spark, sf_dir), ["user_id"], "ts", "te", "event_type", "value", 12, 20.0, ["ts", "event_id"])


@query
def only_target_in_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an order as detections: name, confidence and days of the interval."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(
            *LINE_ORDER, F.col("l_returnflag").alias("name"), F.col("l_discount").alias("confidence"),
            (F.col("l_quantity") - 10).alias("start"), F.col("l_quantity").alias("end"),
        ))).alias("d")
    )
    target = F.col("d")[0]["name"]
    return lines.select("l_orderkey", intervals.only_target(F.col("d"), target, F.lit(5.0), F.lit(25.0), 0.02).alias("only_target"))


@query
def shift_in_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.minute("ts").cast("double") * 60
    by = (hashing.draw(SEED, F.lit(7201), F.col("event_id")) - 3600).cast("double")
    bounds = F.array(F.struct(F.col("start"), (F.col("start") + 300.0).alias("end")))
    moved = table(spark, sf_dir, "events").select("event_id", start.alias("start"), by.alias("shift"))
    return moved.select("event_id", "shift", intervals.shifted_inside(bounds, F.col("shift"), F.lit(3600.0)).alias("inside"))


@query
def dedupe_first_per_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return detections.first_per_label(cols, ["user_id"], "event_type", [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query
def gap_merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = events.merge_gaps(timed(spark, sf_dir), ["user_id"], "ts", "te", 6 * 3600, 3600, ["event_id"])
    return out.select("user_id", times.micros(F.col("start")).alias("start_us"), times.micros(F.col("end")).alias("end_us"), "n")


@query
def merge_gaps_in_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an order as intervals in order of the line number."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(*LINE_ORDER, (F.col("l_quantity") - 10).alias("start"), F.col("l_quantity").alias("end")))).alias("d")
    )
    spans = F.transform("d", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    merged = lines.select("l_orderkey", intervals.merge_gaps(spans, F.lit(0.0)).alias("m"))
    best = intervals.longest(F.col("m"))
    return merged.select("l_orderkey", F.size("m").alias("n"), best["start"].alias("longest_start"), best["end"].alias("longest_end"))


@query
def longest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event lasts as many seconds as its value."""
    lasting = timed(spark, sf_dir).withColumn("te", times.after(F.col("ts"), F.col("value")))
    return events.longest(lasting, ["user_id"], "ts", "te", ["ts", "event_id"], ["event_id"])


# classes, samples, splits


@query
def species_counts_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, removed = sampling.frequent_classes(table(spark, sf_dir, "documents"), "source", 50)
    return kept.withColumn("removed", F.lit(False)).unionByName(removed.withColumn("removed", F.lit(True)))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source")


@query
def balance_under(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.undersample(_documents(spark, sf_dir), "doc_id", "lang", SEED).select("doc_id", "lang")


@query
def balance_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.oversample(_documents(spark, sf_dir), "doc_id", "lang", SEED).select("lang", "draw", "doc_id")


@query
def balance_controlled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.capped_sample(_documents(spark, sf_dir), "doc_id", "lang", "source", SEED, 6, 100).select("lang", "draw", "doc_id")


@query
def split_80_10_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split(_documents(spark, sf_dir), "doc_id", 0.1, 0.1).select("doc_id", "split")


@query
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sampling.split(_documents(spark, sf_dir), "doc_id", 0.1, 0.1)
    return out.rollup("split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").cast("long").alias("n_files"))


@query
def split_overlap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_overlap(sampling.split(_documents(spark, sf_dir), "doc_id", 0.1, 0.1), "source")


@query
def split_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_by_file(_documents(spark, sf_dir), "source", SEED, 0.1, 0.1).select("doc_id", "split")


@query
def replicate_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.replicate(_documents(spark, sf_dir).select("doc_id"), "doc_id", 5, SEED)


@query
def batch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.batches(_documents(spark, sf_dir).select("doc_id"), [F.col("doc_id")], 100)


@query
def noise_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = Mix()
    rows = noise.window_rows(mix.batch_rows, mix.max_polyphony)
    batched = sampling.batches(_documents(spark, sf_dir).select("doc_id"), [F.col("doc_id")], mix.batch_rows)
    mixes = batched.select("batch_idx").distinct().select("batch_idx", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("mix_idx"))
    pool = noise.enlarge(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id", rows, SEED)
    sized = mixes.join(F.broadcast(pool.agg(F.max("n_noise").alias("n_noise"))))
    indexed = sized.withColumn("noise_idx", noise.noise_index(F.col("batch_idx"), F.col("mix_idx"), F.col("n_noise"), rows))
    return indexed.drop("n_noise").join(pool.drop("n_noise"), "noise_idx").select("batch_idx", "mix_idx", "noise_idx", "vec_id")


@query
def flatten_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return flatten.members(lines, ["l_orderkey"], list(LINE_ORDER), ["l_partkey", "l_quantity", "l_returnflag"], "raw_files")


@query
def dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.fingerprint(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


# signals in Column expressions


@query
def clip_rms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).select("vec_id", F.round(signal.rms(F.col("x")), 6).alias("rms"))


@query
def rms_with_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bounds that overlap, from the row's label; label 0 has none."""
    t = F.col("label") / 8.0
    two = F.array(*(F.struct((t + s).alias("start"), (t + e).alias("end")) for s, e in ((0.1, 1.3), (1.0, 1.9))))
    bounds = F.when(F.col("label") > 0, two).otherwise(F.slice(two, 1, 0))
    return signals(spark, sf_dir, "label").select("vec_id", F.round(signal.rms_in_bounds(F.col("x"), bounds, RATE), 6).alias("rms"))


@query
def peak_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    loud = signals(spark, sf_dir).select("vec_id", signal.scale(F.col("x"), F.lit(4.0)).alias("x"))
    return loud.select("vec_id", F.round(signal.peak(F.col("x")), 6).alias("peak"), rounded(signal.peak_normalize(F.col("x"))).alias("samples"))


@query
def dbfs_gain_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    gain = signal.gain_of(F.col("value") / 10 - 30)
    return table(spark, sf_dir, "events").select("event_id", F.round(gain, 6).alias("gain"), F.round(signal.dbfs_of(gain), 6).alias("dbfs"))


@query
def normalize_dbfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    gain = signal.level_gain(F.lit(-12.0), signal.rms(F.col("x")))
    out = signals(spark, sf_dir).select("vec_id", "x", gain.alias("g"))
    return out.select("vec_id", F.round("g", 6).alias("gain"), rounded(signal.scale(F.col("x"), F.col("g")), 5).alias("samples"))


@query
def pad_or_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To 48 samples, of signals cut to 32, 40, ... by label."""
    cut = F.slice("x", 1, F.col("label") * 8 + 8)
    return signals(spark, sf_dir, "label").select("vec_id", rounded(signal.pad_or_trim(cut, 48)).alias("samples"))


@query
def tumbling_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of 20 samples; the tail of 4 stays, padded, from 4 on."""
    cut = F.explode(signal.tumbling(F.col("x"), 20, 4)).alias("c")
    return signals(spark, sf_dir).select("vec_id", cut).select("vec_id", "c.segment", "c.start", "c.end", rounded(F.col("c.samples")).alias("samples"))


@query
def sliding_energy_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = signal.loudest_window(F.col("x"), RATE, RATE // 4)
    return signals(spark, sf_dir).select("vec_id", best.alias("b")).select("vec_id", "b.start", F.round("b.energy", 6).alias("energy"))


@query
def moving_average_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).select("vec_id", rounded(signal.moving_average(F.col("x"), 5)).alias("samples"))


@query
def threshold_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    loud = signals(spark, sf_dir).select("vec_id", "x", F.array_max("x").cast("double").alias("top"))
    mask = F.transform("x", lambda v: v.cast("double") > 0.1 * F.col("top"))
    out = loud.select("vec_id", F.posexplode(signal.islands(mask)).alias("island", "i"))
    return out.select("vec_id", "island", "i.start", "i.end")


@query
def time_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By up to 12 samples in either direction."""
    by = (hashing.draw(SEED, F.lit(25), F.col("vec_id")) - 12).cast("int")
    out = signals(spark, sf_dir).select("vec_id", "x", by.alias("moved"))
    return out.select("vec_id", "moved", rounded(signal.shift(F.col("x"), F.col("moved"))).alias("samples"))


@query
def silence_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    events_ = F.array(F.struct(F.lit(0.5).alias("start"), F.lit(1.0).alias("end")), F.struct((F.col("label") / 4.0).alias("start"), F.lit(3.0).alias("end")))
    return signals(spark, sf_dir, "label").select("vec_id", rounded(signal.silence_outside(F.col("x"), events_, RATE)).alias("samples"))


@query
def area_of_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 32 of 64 samples around an event of which start, end or both are known."""
    start = F.when(F.col("label") % 3 != 0, F.col("label") * 5)
    end = F.when(F.col("label") % 4 != 0, F.col("label") * 5 + 20)
    area = signal.area_of_interest(F.size("x"), start, end, 32)
    return signals(spark, sf_dir, "label").select("vec_id", area.alias("a")).select("vec_id", "a.start", "a.end")


@query
def elementwise_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.elementwise_sum(signals(spark, sf_dir, "label"), ["label"], "x", 4)


# signal processing, models and mixtures: checked by tests, not by SQL


@query
def event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.envelope(signals(spark, sf_dir), "vec_id", "x", 4, 1).select("vec_id", "n_frames", rounded(F.col("envelope")).alias("envelope"))


@query
def event_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audio.event_bounds(signals(spark, sf_dir), "vec_id", "x", RATE, SLOW_EVENTS)
    return found.select("vec_id", F.posexplode("events").alias("event", "e")).select("vec_id", "event", "e.start", "e.end")


@query
def stft_bandpass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.bandpass(signals(spark, sf_dir), "vec_id", "x", RATE, SLOW_EVENTS, SLOW_MASK)


@query
def resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.resampled(signals(spark, sf_dir), "vec_id", "x", RATE, 24).select("vec_id", rounded(F.col("resampled")).alias("resampled"))


@query
def encode_wav(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audio.encoded(signals(spark, sf_dir), "vec_id", "x", RATE)
    return found.select("vec_id", F.octet_length("bytes").alias("n_bytes"), F.sha2(F.lower(F.hex("bytes")), 256).alias("hex_sha256"))


@query
def fake_separate(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = models.separate(signals(spark, sf_dir), "vec_id", "x", RATE, models.BandSplitter)
    return apart.select("vec_id", "source_idx", rounded(signal.doubles(F.col("signal")), 5).alias("signal"))


@query
def fake_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = models.separate(signals(spark, sf_dir), "vec_id", "x", RATE, models.BandSplitter)
    return models.detect(apart, ["vec_id", "source_idx"], "signal", RATE, models.LevelDetector)


@query
def validated_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings are users, their sources the events by id modulo 4, detections the events with their value as confidence.
    Codes number the event types in order; a recording has two."""
    all_events = table(spark, sf_dir, "events")
    detection = F.struct("ts", "event_id", F.col("event_type").alias("name"), F.col("value").alias("confidence"))
    sources = all_events.groupBy(F.col("user_id").alias("recording_id"), (F.col("event_id") % 4).alias("source_idx")).agg(F.array_sort(F.collect_list(detection)).alias("detections"))
    sources = sources.withColumn("codes", F.array(F.col("recording_id") % 5, (F.col("recording_id") + 2) % 5))
    types = all_events.agg(F.array_sort(F.collect_set("event_type")).alias("types"))  # a few names
    names_ = types.select(F.posexplode("types").alias("code", "name")).select(F.col("code").cast("bigint").alias("code"), "name")
    return detections.validated_sources(sources, names_, 20.0, 0.3, "any", "most_detections")


@query
def segment_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 1 s that meet an event and no detection of another name; the signal stands for its masked form."""
    t = F.col("label") / 4.0
    span = lambda s, e: (s.alias("start"), e.alias("end"))
    found = F.array(
        F.struct(F.lit("target").alias("name"), F.lit(0.9).alias("confidence"), *span(F.lit(0.25), F.lit(3.5))),
        F.struct(F.when(F.col("label") % 2 == 0, "target").otherwise("other").alias("name"), F.lit(0.5).alias("confidence"), *span(t, t + 0.5)),
    )
    events_ = F.array(F.struct(*span(F.lit(0.5), F.lit(1.0))), F.struct(*span(t, t + 1.25)))
    bounds = F.transform(events_, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), F.lit(1.0).alias("f_low"), F.lit(4.0).alias("f_high")))
    masked = signals(spark, sf_dir, "label").select(
        "vec_id", F.col("x").alias("masked"), found.alias("detections"), F.lit("target").alias("name"), events_.alias("events"), bounds.alias("bounds")
    )
    out = stages.windows(masked, RATE, RATE, RATE // 4)
    flat = F.flatten(F.transform("time_freq_bounds", lambda b: b.cast("array<double>")))
    return out.select("vec_id", "c.segment", "c.start", "c.end", rounded(F.col("c.samples")).alias("samples"), flat.alias("bounds"))


@query
def truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To 2 s around the labelled times, or where most energy is."""
    recordings = signals(spark, sf_dir, "label").select(
        "vec_id", F.col("x").alias("samples"), F.when(F.col("label") % 3 == 1, F.col("label") / 4.0).alias("start_time"),
        F.when(F.col("label") % 4 == 1, F.col("label") / 4.0 + 0.5).alias("end_time"),
    )
    out = stages.truncate(recordings, RATE, Config(separation=Separation(max_duration_s=2.0)))
    return out.select("vec_id", rounded(signal.doubles(F.col("samples"))).alias("samples"))


@query
def long_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of at least 32 samples, of those cut to 8, 16, ... by label."""
    cut = signals(spark, sf_dir, "label").select("vec_id", F.slice("x", 1, F.col("label") * 8 + 8).alias("x"))
    return cut.where(F.size("x") >= signal.num_samples(F.lit(2), F.lit(RATE))).select("vec_id", F.size("x").alias("n"))


@query
def mono_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two halves of a signal as channels, their mean as single precision."""
    out = audio.map_signals(signals(spark, sf_dir), "vec_id", "x", "mono array<float>", lambda x: (dsp.mono(x.reshape(2, -1)).astype("float32"),))
    return out.select("vec_id", F.transform("mono", lambda v: v.cast("double")).alias("mono"))


@query
def smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audio.map_signals(signals(spark, sf_dir), "vec_id", "x", "smooth array<double>", lambda x: (dsp.smooth_reflect(x, 5),))
    return out.select("vec_id", rounded(F.col("smooth")).alias("smooth"))


@query
def weighted_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places between which 90 % of a signal's absolute values lie."""

    def work(x):
        weights, at = abs(x), [i / 4 for i in range(len(x))]
        return tuple(dsp.weighted_percentile(weights, at, p) for p in (5, 95))

    out = audio.map_signals(signals(spark, sf_dir), "vec_id", "x", "low double; high double", work)
    return out.select("vec_id", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query
def same_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    padded = F.concat(F.lit(" "), F.initcap("p_name"), F.lit(" "))
    other = F.when(F.col("p_size") % 3 == 0, F.lit(None)).when(F.col("p_size") % 3 == 1, F.col("p_type")).otherwise(F.col("p_brand"))
    return parts.select("p_partkey", lookup.same_species(F.col("p_name"), F.col("p_type"), padded, other).alias("same"))


@query
def removed_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources balanced to the smallest that has 60 rows or more, and the classes removed."""
    kept, removed = sampling.balance_and_removed(_documents(spark, sf_dir), "doc_id", "source", "lang", SEED, "undersample", None, 60)
    sizes = kept.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("removed", F.lit(False))
    return sizes.unionByName(removed.withColumn("removed", F.lit(True)))


@query
def noise_and_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("known"))
    marked = docs.join(labels, "doc_id", "left")
    noise_, test = sampling.noise_and_test(marked, F.col("known").isNull(), "doc_id", SEED)
    return noise_.select("doc_id", F.lit("noise").alias("part")).unionByName(test.select("doc_id", F.lit("test").alias("part")))


# schemas, sources and sinks


@query
def flattened_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = schemas.flattened("raw_files", schemas.SEGMENTS).fields
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)], "position int, name string, type string")


@query
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit is the feature here."""
    orders = schemas.require(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")
    return readers.limited(orders.select("o_orderkey", "o_custkey"), "o_orderkey", 100)


@query
def empty_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = "array<struct<name:string,confidence:double,start:double,end:double>>"
    out = readers.with_empty(_documents(spark, sf_dir).drop("lang"), "detections", kind)
    return out.select("doc_id", "source", F.size("detections").alias("n_detections"), F.get("detections", F.lit(0))["name"].isNull().alias("no_name"))


@query
def forced_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read with a schema that the file's columns do not all have: what is missing is null."""
    kind = schemas.StructType.fromDDL("n_nationkey int, n_name string, n_code string")
    return readers.table(spark, f"{sf_dir}/nation.parquet", kind)


@query
def split_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by split, a table beside it replaced, and read back without its empty splits."""
    path = session.shared_path(spark, "splits")
    parts = sampling.split(_documents(spark, sf_dir), "doc_id", 0.1, 0.0)
    sinks.write(parts, path, "split")
    sinks.replace(readers.table(spark, path).where("doc_id % 3 <> 0"), path, split="split")
    found = readers.valid_splits(spark, path)
    rows = [df.select("doc_id", F.lit(name).alias("split")) for name, df in found.items()]
    return rows[0].unionByName(rows[1]) if len(rows) > 1 else rows[0]


@query
def published_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.shared_path(spark, "published")
    parts = sampling.split(_documents(spark, sf_dir), "doc_id", 0.1, 0.1)
    found = sinks.manifest(readers.table(spark, sinks.publish(parts, path, "HSN", balanced=True)), ["doc_id", "lang", "split"])
    row = (found["num_rows"], found["fingerprint"], ",".join(sorted(found["columns"])), found["features"]["doc_id"])
    return spark.createDataFrame([row], "num_rows long, fingerprint long, columns string, doc_id_type string")


@query
def code_map_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes written as JSON and a taxonomy as CSV, read back and joined without regard to case."""
    path = session.shared_path(spark, "codes")
    nations = table(spark, sf_dir, "nation")
    labels = nations.agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), F.lower("n_name")))).alias("id2label"))
    labels.select(F.to_json(F.struct("id2label")).alias("value")).coalesce(1).write.text(f"{path}/json")
    named = nations.select(F.upper("n_name").alias("SPECIES_CODE"), F.concat("n_name", F.lit(" bird")).alias("PRIMARY_COM_NAME"), F.concat(F.lit("Avis "), "n_name").alias("SCI_NAME"))
    named.coalesce(1).write.option("header", True).csv(f"{path}/csv")
    return lookup.code_names(readers.code_map(spark, f"{path}/json", "HSN"), readers.taxonomy(spark, f"{path}/csv"), ["position"])


# streams: each runs over all events and leaves its result as a table


def _streamed(spark: SparkSession, sf_dir: str, make, mode: str = "complete") -> DataFrame:
    path = session.shared_path(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    stream = streams.read(spark, f"{sf_dir}/events*.parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    streams.kept_table(make(stream), f"{path}/table", f"{path}/checkpoint", mode)
    return spark.read.parquet(f"{path}/table")


def _windows(found: DataFrame, *more: str) -> DataFrame:
    return found.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n", *more)


@query
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_streamed(spark, sf_dir, lambda e: streams.counts(e, "ts", "user_id", "12 hours")), "most")


@query
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_streamed(spark, sf_dir, lambda e: streams.counts(e, "ts", "user_id", "12 hours", "6 hours")), "most")


@query
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_streamed(spark, sf_dir, lambda e: streams.sessions(e, "ts", "user_id", "6 hours")))


@query
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _streamed(spark, sf_dir, lambda e: streams.totals(e, "user_id", "value"), "update")
    return found.select("user_id", "n", F.round("total", 4).alias("total"))


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = Mix()
    split = sampling.split(_documents(spark, sf_dir), "doc_id", mix.test_share, mix.validation_share)
    batched = sampling.batches(split.select("doc_id", "source", "split"), [F.col("doc_id")], mix.batch_rows, [F.col("split")])
    return mixing.assign(batched, "doc_id", "source", ["split", "batch_idx"], "doc_id", SEED, mix)


@query
def mix_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir)


@query
def mix_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members take the signal of their id modulo the number of vectors; the noise is that of the mixture's index."""
    vectors = signals(spark, sf_dir)
    n = vectors.count()
    placed = _assigned(spark, sf_dir).withColumn("vec_id", F.col("doc_id") % n)
    sound = placed.join(vectors, "vec_id").withColumnRenamed("x", "signal").drop("vec_id")
    background = vectors.select(F.col("vec_id").alias("noise_id"), F.col("x").alias("noise"))
    paired = sound.withColumn("noise_id", (F.col("batch_idx") * 30 + F.col("mix_idx")) % n).join(background, "noise_id").drop("noise_id")
    bounds = F.array(F.array(F.lit(0.5), F.lit(2.5)))
    return mixing.render(paired.withColumn("bounds", bounds), ["split", "batch_idx"], 64, RATE, SEED, Mix().max_shift_ratio)
