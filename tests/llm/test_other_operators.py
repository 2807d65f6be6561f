"""Chat formatting, exact top-k search and components."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from chorale.llm import chat, mtree, queries
from chorale.llm.common import Scratch
from chorale.llm.components import components

TURNS = [
    (1, 0, "system", "be <|end|> kind"), (1, 1, "user", "hi & <b>"), (1, 2, "assistant", "&lt; <|turn|>"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (2, 0, "user", "alone"), (3, 0, "assistant", "first\nline"), (3, 0, "assistant", "first\nline"), (4, None, None, "no role"), (None, 0, "assistant", "x"),
    (5, 0, "assi<|body|>stant", "odd role"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("t", F.lit(1))
    out = chat.format_conversations(df)
    got = out.select("conv_id", chat.read_turns(F.col("segments")).alias("turns"), chat.read_targets(F.col("segments"), F.col("examples")).alias("loss")).collect()
    for r in got:
        own = sorted((t for t in TURNS if t[0] == r["conv_id"]), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [tuple(x) for x in r["turns"]] == [(t[2] or "", t[3] or "") for t in own]
        assert list(r["loss"]) == [t[3] or "" for t in own if t[2] == "assistant"]


def test_chat_examples_are_prefixes(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df)
    whole = {r["conv_id"]: "".join(r["segments"]) for r in formatted.collect()}
    rows = chat.with_strings(formatted).collect()
    assert len(rows) == sum(t[2] == "assistant" for t in TURNS)
    segments = {r["conv_id"]: r["segments"] for r in formatted.collect()}
    linear = {(r["conv_id"], r["example"]): r for r in chat.expand(formatted).collect()}
    assert len(linear) == len(rows)
    for r in rows:
        e = linear[r["conv_id"], r["example"]]
        context = "".join(segments[r["conv_id"]][: e["context"]])
        assert context + e["target"] == r["text"]
        assert (len(context) + e["loss_start"], len(context) + e["loss_end"]) == (r["loss_start"], r["loss_end"])
        assert whole[r["conv_id"]].startswith(r["text"])
        assert r["text"][r["loss_end"] :] == chat.END
        assert r["text"][: r["loss_start"]].endswith(chat.BODY)
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_chat_query_reads_its_loss_from_the_examples(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    made = []
    expand = chat.expand
    monkeypatch.setattr(chat, "expand", lambda formatted: made.append(expand(formatted)) or made[-1])
    got = {r["conv_id"]: r["loss_chars"] for r in queries.op8_chat(spark, str(tmp_path)).collect()}
    want = {c: sum(len(t[3] or "") for t in TURNS if t[0] == c and t[2] == "assistant") for c in {t[0] for t in TURNS}}
    assert got == want | {-7: 21}
    assert [m.count() for m in made] == [sum(t[2] == "assistant" for t in TURNS) + 1]


def brute(rows, k=20):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.setdefault(i, []).append([math.floor(64 * Fraction(x)) for x in v])
    out = []
    for q in sorted(i for i in ok if i % 20 == 0):
        best = []
        for c, vs in ok.items():
            scores = [sum(a * b for a, b in zip(x, y, strict=True)) for x in ok[q] for y in vs if len(x) == len(y)]
            if c != q and scores:
                best.append((-max(scores), c))
        out += [(q, n, c, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for n, (s, c) in enumerate(sorted(best)[:k], 1)]
    return out


def vectors(seed, n=700, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    rows = [(i, (centres[i % 5] + rng.normal(size=dim) * 0.2).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(300)]  # a group of copies: ties
    rows += [(2000, None), (2020, [None] * dim), (2040, [float("nan")] * dim), (2060, [float("inf")] + [0.0] * (dim - 1)), (2080, [0.0] * dim), (2100, [1.0, 2.0]), (2101, [3.0, 1.0]), (2120, []), (None, rows[1][1]), (20, rows[7][1]), (20, rows[20][1]), (2140, [1e30] * dim)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k(spark, seed, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK_ROWS", 128)
    monkeypatch.setattr(mtree, "PAGE", 16)
    monkeypatch.setattr(mtree, "CHUNK", 16)
    monkeypatch.setattr(mtree, "CELL_ROWS", 64)
    rows = vectors(seed)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("score", F.lit("x"))
    got = [tuple(r) for r in mtree.top_k(df.repartition(3)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_top_k_counts_a_repeated_id_once(spark, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK_ROWS", 128)
    monkeypatch.setattr(mtree, "PAGE", 16)
    rows = [r for r in vectors(3) if r[0] is not None and r[0] < 1000]
    best = [2 * x for x in rows[0][1]]
    rows += [(3001, best)] * 25 + [(3003, [x * (1 + i / 50) for x in best]) for i in range(30)]
    got = [tuple(r) for r in mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()]
    assert sorted(got) == sorted(brute([(i, np.float32(v).tolist()) for i, v in rows]))


def test_top_k_of_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert mtree.top_k(spark.createDataFrame([], schema)).collect() == []
    assert mtree.top_k(spark.createDataFrame([(20, [1.0])], schema)).collect() == []
    assert [tuple(r) for r in mtree.top_k(spark.createDataFrame([(20, [1.0]), (21, [-1.0])], schema)).collect()] == [(20, 1, 21, -4096)]


def test_large_components_are_exact_integers(spark):
    rows = [(i, [float(i * 1000 + 0.5), float((i * 7919) % 100_000), 12345.25]) for i in range(60)]
    got = [tuple(r) for r in mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_components_of_any_size_are_exact(spark, monkeypatch):
    """Wide vectors meet each other and all others; scores beyond a long are ranked by their true value."""
    monkeypatch.setattr(mtree, "BLOCK_ROWS", 32)
    monkeypatch.setattr(mtree, "CELL_ROWS", 16)
    rng = random.Random(5)
    sizes = (1.0, 1.0, 1.0, 2.0**20, 2.0**21, 2.0**40, 1e30, 1e300, 1.7e308)
    rows = [(i, [rng.uniform(-1, 1) * rng.choice((1.0, rng.choice(sizes))) for _ in range(rng.choice((2, 3)))]) for i in range(240)]
    rows += [(300, [1.0, 1.0]), (301, [2.0**21, 0.0]), (302, [1.0, 0.0]), (300, [5.0, 2.0**60])] + [rows[20]] * 40
    got = [tuple(r) for r in mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_order_of_scores_beyond_a_long():
    scores = [-(10**60), -(1 << 64), -(1 << 63) - 1, -(1 << 63), -(1 << 63) + 1, 0, (1 << 63) - 1, 1 << 63, (1 << 63) + 1, 1 << 70, 10**60]
    held = [(min(max(s, mtree.LEAST_LONG), mtree.MOST_LONG), mtree.ordered(s)) for s in scores]
    assert held == sorted(held) and len(set(held)) == len(held)


def test_a_query_goes_to_no_cell_that_cannot_reach_its_floor(spark, monkeypatch):
    monkeypatch.setattr(mtree, "CELL_ROWS", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 6)) * 20
    rows = [(i, (centres[i % 8] + rng.normal(size=6) * 0.01).tolist()) for i in range(400)]
    sent, send = [], mtree._send
    monkeypatch.setattr(mtree, "_send", lambda cells: sent.append(cells) or send(cells))
    got = [tuple(r) for r in mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    assert sorted(got) == sorted(brute(rows))
    (cells,) = sent
    queries = [(np.floor(64 * np.array(v)), i) for i, v in rows if i % 20 == 0]
    floors = {q: min(s for a, _, _, s in got if a == q) for _, q in queries}
    visited = [len(cells[6].wanted(v, floors[q])) for v, q in queries]
    assert max(visited) < len(cells[6].pivots) / 2


def test_chat_runs_no_python(spark, tmp_path, capsys):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    queries.op8_chat(spark, str(tmp_path)).explain("formatted")
    plan = capsys.readouterr().out
    assert "Generate" in plan
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "MapPartitions", "ExistingRDD"))


def test_chat_of_very_long_texts_and_many_turns(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", "<&" * 200_000 if i == 3 else f"t{i}") for i in range(600)]
    examples = chat.expand(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = examples.select("context", chat.unescape(F.substring("target", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))).alias("t")).collect()
    assert sorted((r["context"], r["t"]) for r in got) == [(r[1], r[3]) for r in rows if r[2] == "assistant"]


def test_chat_query_reads_every_column_from_the_examples_and_their_contexts(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    expand = chat.expand
    monkeypatch.setattr(chat, "expand", lambda formatted: expand(formatted).withColumn("before", F.lit("")))
    got = {r["conv_id"]: r for r in queries.op8_chat(spark, str(tmp_path)).collect()}
    # without its context, the last example of conversation 1 holds one turn of five; 3 has two replies; 2 has no example
    assert {c: got[c]["n_turns"] for c in (1, 2, 3, 4, -7)} == {1: 1, 2: 1, 3: 1, 4: 1, -7: 1}
    monkeypatch.undo()
    got = {r["conv_id"]: r["n_turns"] for r in queries.op8_chat(spark, str(tmp_path)).collect()}
    assert got == {1: 5, 2: 1, 3: 2, 4: 1, None: 1, 5: 1, -7: 2}


def test_chat_examples_and_what_follows_them_are_the_whole(spark):
    rows = [(1, 0, "user", "a <|turn|> & b"), (1, 1, "assistant", "&amp;"), (1, 2, "user", "<|end|>"), (1, 3, "assistant", ""), (1, 4, "user", "c"), (1, 5, "user", None), (2, 0, "user", "")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    held = {(r["conv_id"], r["example"]): r for r in chat.with_strings(formatted).unionByName(chat.unanswered(formatted)).withColumn("turns", chat.read_text(F.concat("text", "after"))).collect()}
    assert set(held) == {(1, 0), (1, 1), (2, None)}
    assert held[1, 0]["after"] is None and held[1, 0]["text"].count(chat.TURN) == 2
    assert [tuple(t) for t in held[1, 1]["turns"]] == [(r[2], r[3] or "") for r in rows[:6]]
    assert [tuple(t) for t in held[2, None]["turns"]] == [("user", "")]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(50, 60), (60, 50), (7, 7), (70, 90), (80, 90), (70, 80)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "c").collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 60: 50, 70: 70, 80: 70, 90: 70}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark), "d").collect() == []
    star = [(i, 10_000) for i in range(500)]
    assert {r["component"] for r in components(spark.createDataFrame(star, "a long, b long"), Scratch(spark), "e").collect()} == {0}
