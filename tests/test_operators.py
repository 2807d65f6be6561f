"""Operators on small tables: ranks, samples, validation, mixtures, configuration, schemas."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chorale import config, schemas, session
from chorale.config import Mix
from chorale.operators import detections, events, flatten, lookup, mixing, noise, sampling
from chorale.operators.ranking import ranked


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_ranks_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(200).select("id", (F.col("id") % 3).alias("g")).repartition(partitions)
    found = {r["id"]: (r["rank"], r["rank_count"]) for r in ranked(df, [F.col("g")], [-F.col("id")]).collect()}
    for g in range(3):
        own = sorted((i for i in range(200) if i % 3 == g), reverse=True)
        assert all(found[i] == (k, len(own)) for k, i in enumerate(own, 1))


def test_ranks_of_nothing(spark):
    assert ranked(spark.range(0), [], [F.col("id")]).collect() == []


@pytest.mark.parametrize("n,sizes", [(50, (40, 5, 5)), (230, (184, 23, 23)), (7, (5, 1, 1))])
def test_split_sizes(spark, n, sizes):
    found = dict(sampling.split(spark.range(n), "id", 0.1, 0.1).groupBy("split").count().collect())
    assert tuple(found.get(s, 0) for s in ("train", "validation", "test")) == sizes


def test_half_sample_is_exact_and_seeded(spark):
    a, b = ({r["id"] for r in sampling.half_sample(spark.range(101), "id", s).where("sampled").collect()} for s in (1, 1))
    c = {r["id"] for r in sampling.half_sample(spark.range(101), "id", 2).where("sampled").collect()}
    assert a == b != c
    assert len(a) == 50


def test_balance(spark):
    df = spark.range(60).select("id", F.when(F.col("id") < 10, "a").when(F.col("id") < 30, "b").otherwise("c").alias("k"))
    assert dict(sampling.undersample(df, "id", "k", 1).groupBy("k").count().collect()) == {"a": 10, "b": 10, "c": 10}
    assert dict(sampling.oversample(df, "id", "k", 1).groupBy("k").count().collect()) == {"a": 30, "b": 30, "c": 30}


@pytest.mark.parametrize("method,n", [("undersample", 60), ("oversample", 90), ("controlled_oversample", 90)])
def test_balance_by_method_without_rare_classes(spark, method, n):
    df = spark.range(151).select("id", F.when(F.col("id") < 1, "rare").when(F.col("id") < 61, "b").otherwise("c").alias("k"), (F.col("id") % 5).alias("file"))
    got = sampling.balance(df, "id", "k", "file", 1, method, 3, 50).collect()
    assert {k: sum(r["k"] == k for r in got) for k in {r["k"] for r in got}} == {"b": n, "c": n}
    if method == "controlled_oversample":
        assert {k: len({r["id"] for r in got if r["k"] == k}) <= 15 for k in "bc"} == {"b": True, "c": True}
    whole = sampling.balance(df, "id", "k", "file", 1, "controlled_oversample", None, 0).groupBy("k").count().collect()
    assert dict(whole) == {"rare": 90, "b": 90, "c": 90}
    with pytest.raises(ValueError):
        sampling.balance(df, "id", "k", "file", 1, "other", None, 0)


def test_numbers_of_a_row_are_dealt_in_runs(spark, monkeypatch):
    monkeypatch.setattr(sampling, "NUMBERS", 4)
    df = spark.createDataFrame([("a", 10), ("b", 4), ("c", 0), ("d", 1), (None, 5)], "k string, n int")
    got = sampling.numbered(df, F.col("n"), "at")
    assert got.columns == ["k", "n", "at"]
    assert sorted((r["k"] or "", r["at"]) for r in got.collect()) == sorted((k or "", i) for k, n in (("a", 10), ("b", 4), ("d", 1), (None, 5)) for i in range(n))


def test_elementwise_sum_of_unequal_lengths_and_nulls(spark):
    rows = [("a", [1.0, 2.0]), ("a", [0.5, None, 4.0]), ("a", None), ("b", []), (None, [1.0]), (None, [2.0])]
    got = flatten.elementwise_sum(spark.createDataFrame(rows, "k string, x array<double>").repartition(4), ["k"], "x", 3).collect()
    assert {r["k"]: r["x"] for r in got} == {"a": [1.5, 2.0, 4.0], "b": [], None: [3.0]}


def test_rows_that_differ_have_different_fingerprints(spark):
    one, other = (spark.createDataFrame([r], "a string, b string") for r in (("a|b", "c"), ("a", "b|c")))
    assert flatten.fingerprint(one, "a", "b").first() != flatten.fingerprint(other, "a", "b").first()
    assert flatten.fingerprint(one.limit(0), "a", "b").first()["fingerprint"] == 0


def test_removed_classes_are_named(spark):
    df = spark.createDataFrame([(i, "a" if i < 30 else "b", "f") for i in range(33)], "id long, k string, file string")
    kept, removed = sampling.balance_and_removed(df, "id", "k", "file", 1, "undersample", None, 10)
    assert {r["k"] for r in kept.collect()} == {"a"}
    assert [tuple(r) for r in removed.collect()] == [("b", 3)]


def test_worker_memory(spark):
    assert all(r["peak_mb"] > 1 for r in session.worker_memory(spark.range(10).repartition(2)).collect())


def test_no_label_tells_null_from_empty(spark):
    df = spark.createDataFrame([(1, None, [], None), (2, None, None, None), (3, 5, [], None), (4, None, [1], None)], "id int, c int, m array<int>, s string")
    assert [r["id"] for r in df.where(sampling.no_label(F.col("c"), F.col("m"), F.col("s"))).collect()] == [1]


def test_ties_go_to_the_first(spark):
    df = spark.createDataFrame([(1, "b", 0), (1, "a", 1), (1, "a", 2), (1, "b", 3)], "k int, name string, at int")
    got = detections.dominant_label(df, ["k"], "name", ["at"], 0.6).first()
    assert (got["name"], got["n"], got["is_dominant"]) == ("b", 2, False)


def test_validated_sources(spark):
    rows = [
        (1, 0, [7, 8], [("tit", 0.9), ("tit", 0.8), ("owl", 0.1)]),
        (1, 1, [7, 8], [("tit", 0.9)] * 3),
        (1, 2, [7, 8], [("owl", 0.9)]),
        (2, 0, [7], [("owl", 0.9)]),
        (3, 0, [7], []),
    ]
    sources = spark.createDataFrame(rows, "recording_id int, source_idx int, codes array<int>, detections array<struct<name:string,confidence:double>>")
    names = spark.createDataFrame([(7, "tit"), (8, "owl")], "code int, name string")

    def found(**more):
        return {(r["recording_id"], r["source_idx"]) for r in detections.validated_sources(sources, names, 0.2, 0.1, **more).collect()}

    assert found() == {(1, 0), (1, 2)}
    assert found(match="first") == {(1, 0)}
    assert found(duplicate="most_detections") == {(1, 1), (1, 2)}


def test_strict_lookup(spark):
    df, codes = spark.range(3), spark.range(2).withColumnRenamed("id", "code")
    with pytest.raises(ValueError):
        lookup.lookup(df, codes, F.col("id") == F.col("code"))
    assert lookup.lookup(df, codes, F.col("id") == F.col("code"), strict=False).count() == 2


@given(st.lists(st.integers(0, 8), max_size=60), st.integers(0, 1000))
def test_mixtures_have_distinct_files_and_full_degrees(files, seed):
    placed = mixing.assign_batch(files, seed, Mix())
    assert len({p[0] for p in placed}) == len(placed)
    for number in {p[1] for p in placed}:
        members = [p for p in placed if p[1] == number]
        assert len({files[m[0]] for m in members}) == len(members) == members[0][2]
        assert [m[3] for m in members] == list(range(len(members)))
        assert members[0][4] == 0
    assert placed == mixing.assign_batch(files, seed, Mix())


def test_cursor_repeats_nothing_before_the_end():
    c = mixing.Cursor(range(5), 3)
    assert sorted(c.pop() for _ in range(5)) == sorted(c.pop() for _ in range(5)) == list(range(5))
    with pytest.raises(IndexError):
        mixing.Cursor([], 0).pop()


def test_mix_levels():
    rng = np.random.default_rng(0)
    x = rng.normal(size=500) * 3
    a = mixing.place(x, [[0.0, 2.0]], -6.0, 100, 500, 0.0, 1)
    assert a["event_rms"] == pytest.approx(np.sqrt(np.mean(x[:200] ** 2)))
    assert mixing.level(a["signal"], [[0.0, 2.0]], 100) == pytest.approx(10 ** (-6 / 20))
    made = mixing.mix_signals([a["signal"], x], rng.normal(size=600), -12.0, -9.0)
    assert mixing.level(made["mixed"]) == pytest.approx(10 ** (-9 / 20))
    assert np.allclose(made["clean"], a["signal"] + x)
    silent = mixing.place(np.zeros(50), [], 0.0, 100, 80, 0.2, 1)
    assert len(silent["signal"]) == 80 and not silent["signal"].any()
    with pytest.raises(ValueError):
        mixing.mix_signals([np.ones(10)], np.ones(5), 0, 0)


def test_a_shift_out_of_the_mixture_is_not_made():
    x = np.arange(100.0)
    y, bounds, by = mixing.shifted(x, [[0.0, 0.01]], 100, 100, 0.5, 4)
    assert (by == 0 and bounds == [[0.0, 0.01]]) or bounds[0][0] == by / 100
    assert len(y) == 100


def test_noise_windows(spark):
    assert noise.window_rows(100, 6) == 30
    pool = noise.enlarge(spark.range(7), "id", 30, 1)
    assert pool.count() == 56
    assert {r["noise_idx"] for r in pool.collect()} == set(range(56))
    with pytest.raises(ValueError):
        noise.enlarge(spark.range(0), "id", 30, 1)


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_gaps_across_partitions(spark, partitions):
    """One key holds most events; runs of it lie in many partitions."""
    rows = [(0 if i % 5 else i % 3, i, i * 100 + (i // 7) * 250) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, id int, s int").selectExpr(
        "k", "id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, s) as ts", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, s + 90) as te"
    )
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    got = events.merge_gaps(df, ["k"], "ts", "te", 200, 0, ["id"]).groupBy("k").agg(F.count("n"), F.sum("n"), F.max("n")).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {}
    for k in {r[0] for r in rows}:
        sizes, last = [], None
        for _, _, s in sorted(r for r in rows if r[0] == k):
            if last is None or s - last > 200:
                sizes.append(0)
            sizes[-1] += 1
            last = s + 90
        want[k] = (len(sizes), sum(sizes), max(sizes))
    assert {r[0]: tuple(r[1:]) for r in got} == want


def test_small_helpers(spark):
    from chorale.session import worker_count
    from chorale.sources.readers import with_empty

    assert (worker_count(10, 64, 2), worker_count(10, 1, 2)) == (8, 1)
    df = with_empty(spark.range(1), "sources", "array<struct<a:int>>")
    assert df.first()["sources"] == [] and dict(df.dtypes)["sources"] == "array<struct<a:int>>"
    names = [F.lit(x) for x in (" Great Tit", "Parus major", "great tit", "PARUS MAJOR ")]
    assert spark.range(1).select(lookup.same_species(*names)).first()[0] is True
    assert spark.range(1).select(lookup.same_species(names[0], F.lit(None), *names[2:])).first()[0] is False


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("seed: 7\nbalance:\n  max_per_file: None\n  enabled: true\nmix:\n  mix_levels: [-3, -2]\n")
    c = config.load(str(path))
    assert (c.seed, c.balance.max_per_file, c.balance.enabled, c.mix.mix_levels) == (7, None, True, (-3, -2))
    path.write_text("sed: 7\n")
    with pytest.raises(ValueError):
        config.load(str(path))


def test_schemas(spark):
    assert schemas.flattened("raw", schemas.struct(audio=schemas.DECODED, n=schemas.LongType())).fieldNames() == ["raw_audio_array", "raw_audio_sampling_rate", "raw_n"]
    with pytest.raises(ValueError):
        schemas.require(spark.range(1), "id", "missing")
