"""The operators on texts against brute force, over a table with every awkward case."""

from __future__ import annotations

import glob
import math
import time
import zlib
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import fixtures
import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chorale.llm import bpe, line_dedup, minhash, packing, pretokens, quality, sharding, substring, toxicity
from chorale.llm.common import shared_dir

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


# quality rules


def test_quality_base(docs):
    rows, df = docs
    got = quality.quality_rules(df, BPE, PIECES)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = got.select(*names, "kept").collect()
    assert fixtures.by_str(r[:7] for r in found) == fixtures.by_str((r[0], *fixtures.base_quality(r[1])) for r in rows)
    assert not any(r["kept"] for r in found if r["base_failed"])


def test_quality_measures(docs, library):
    rows, df = docs
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = {(r["doc_id"], r["n_words"]): r for r in quality.quality_rules(df, BPE, PIECES).collect()}
    for i, t, *_ in rows[:60]:
        r, ids = found[i, len(fixtures.words(t))], library_ids(library, t)
        assert r["n_tokens"] == len(ids)
        if ids:
            share = np.unique(ids, return_counts=True)[1] / len(ids)
            assert r["chars_per_token"] == pytest.approx(len(t) / len(ids))
            assert r["token_entropy"] == pytest.approx(-(share * np.log2(share)).sum(), abs=1e-9)
        pieces = [x for w in regex.findall(pretokens.PATTERN, t or "") for x in model.encode(w.strip())]
        assert r["fallback_share"] == pytest.approx(sum(map(model.is_byte, pieces)) / max(len(pieces), 1))


def verdict(rows, r):
    """The reason by the bands of ``rows``, in plain Python."""
    band = lambda x: x["lang"] or f"script {x['script']}"
    size = lambda x: int(math.log2(max(x["n_tokens"], 1)) / 2)
    sound = [x for x in rows if not x["base_failed"]]
    same = [
        [x for x in sound if x["script"] == r["script"] and size(x) == size(r)],
        [x for x in sound if band(x) == band(r)],
        [x for x in sound if band(x) == band(r) and size(x) == size(r)],
    ]

    def blended(measure, edge, fixed):
        for level in same:
            values = sorted(float(Decimal(repr(x[measure])).quantize(Decimal("0.001"), ROUND_HALF_UP)) for x in level)
            if values:
                q = [values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75)]
                w = len(values) / (len(values) + 10)
                fixed = w * edge(q[1], (q[2] - q[0]) / 1.349) + (1 - w) * fixed
        return fixed

    def limit(measure, widths, fixed):
        return blended(measure, lambda mid, spread: mid + widths * 4.5 * max(spread, 0.01 if measure == "fallback_share" else 0.03 * mid), fixed)

    covered = r["script"] in ("Latin", "none")
    cpt, entropy, low = r["chars_per_token"], r["token_entropy"], 1.0 if covered else 0.0
    poor = entropy < blended("token_entropy", lambda mid, _: mid, 0.0)
    if r["base_failed"]:
        return "base"
    if cpt < limit("chars_per_token", -2, low) or (poor and cpt < limit("chars_per_token", -1, low)):
        return "few characters a token"
    if cpt > limit("chars_per_token", 2, 12.0) or (poor and cpt > limit("chars_per_token", 1, 12.0)):
        return "many characters a token"
    if r["fallback_share"] > limit("fallback_share", 1, 0.5 if covered else 1.0):
        return "byte fallback"
    if entropy < 3 * min(1, math.log2(max(r["n_tokens"], 1)) / 8) or entropy < limit("token_entropy", -1, 0.0):
        return "low entropy"
    return None


def test_quality_verdicts_are_those_of_the_bands(spark):
    import random

    rng = random.Random(12)
    rows = [(i, fixtures.prose(rng, rng.choice((25, 60, 300))), rng.choice(("en", "en", "de", None))) for i in range(150)]
    rows += [(200 + i, " ".join(rng.choices(text.split(" "), k=60)), lang) for lang, text in CLEAN.items() for i in range(15)]
    rows += [(400 + i, " ".join(rng.choices("слово qzxj 漢字 \u0378 aa".split(), k=80)), "en") for i in range(12)]
    rows += [(500 + i, " ".join("".join(rng.choices("xqzjkw0123#$", k=9)) for _ in range(70)), rng.choice(("en", None))) for i in range(6)]
    rows += [(600, " ".join(rng.choices(("ha", "ho", "hi"), k=40)), "en"), (601, None, None), (602, "", "en")]
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), BPE, PIECES).collect()
    want = {r["doc_id"]: verdict(got, r) for r in got}
    assert {r["doc_id"]: r["reject_reason"] for r in got} == want
    assert len(set(want.values())) >= 4
    assert all(r["kept"] == (r["reject_reason"] is None) for r in got)


def test_quality_bands_reject_the_odd_one(spark):
    import random

    rng = random.Random(5)
    rows = [(i, fixtures.prose(rng, 300), "en") for i in range(200)] + [(900, " ".join(f"слово{i}" for i in range(900)), "en")]
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), BPE, PIECES)
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    assert all(kept[i] for i in range(200))
    assert not kept[900]


CLEAN = {
    "ru": "утром над рекой стоял туман и рыбаки молча готовили лодки к выходу дети шли в школу через старый мост рынок открывался рано торговцы раскладывали яблоки хлеб мёд",
    "zh": "清晨 河面上 笼罩着 薄雾 渔民们 默默地 准备 小船 孩子们 走过 古老的 石桥 上学 市场 很早 开门 商贩 摆出 苹果 面包 蜂蜜 老人 坐在 树下 谈论 天气",
    "th": "เช้านี้ แม่น้ำ มีหมอก ชาวประมง เตรียมเรือ อย่างเงียบ เด็กๆ เดินไป โรงเรียน ข้ามสะพาน เก่าแก่ ตลาดเปิด แต่เช้า พ่อค้า วางขาย แอปเปิล ขนมปัง น้ำผึ้ง คนแก่ นั่งคุย ใต้ต้นไม้ เรื่องอากาศ",
    "am": "ጠዋት በወንዙ ላይ ጭጋግ ነበር ዓሣ አጥማጆች ጀልባዎችን በዝምታ አዘጋጁ ልጆች በአሮጌው ድልድይ ወደ ትምህርት ቤት ሄዱ ገበያው ቀደም ብሎ ተከፈተ ነጋዴዎች ፖም ዳቦ ማር አቀረቡ",
}


@pytest.mark.parametrize("many,named", [(True, True), (False, True), (True, False), (False, False)])
def test_quality_keeps_clean_texts_of_any_script(spark, many, named):
    import random

    rng = random.Random(11)
    rows = [(i, fixtures.prose(rng, 300), "en") for i in range(200)]
    for n, (lang, text) in enumerate(CLEAN.items(), 1):
        rows += [(n * 1000 + i, " ".join(rng.choices(text.split(" "), k=200)), lang if named else None) for i in range(70 if many else 20)]
    rows += [(9000, "\u0301\u0378 " * 300, "xx"), (9001, " ".join("aqzxjvkw"[i % 8] for i in range(300)), "yy")]
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), BPE, PIECES).collect()
    assert [(r["doc_id"], r["reject_reason"], r["chars_per_token"]) for r in got if not r["kept"] and r["doc_id"] < 9000] == []
    assert not any(r["kept"] for r in got if r["doc_id"] >= 9000)


def test_quality_names_scripts():
    texts = ["abc", "", "12 \U0001f600", "ab где", "где ab", "สวัสดี", "მთა", "漢字かな", "𐐀𐐁𐐂", "é", "한국어 x"]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    want = ["Latin", "none", "none", "Cyrillic", "Cyrillic", "Thai", "Georgian", "Han", "Other", "Latin", "Hangul"]
    assert quality.scripts_of(buf, offsets).tolist() == want


def test_quality_keep(docs):
    rows, df = docs
    verdicts = quality.quality_rules(df, BPE, PIECES)
    left = quality.keep(df, verdicts)
    assert left.columns == df.columns
    assert left.count() == verdicts.where("kept").count()


# line dedup


def test_line_dedup(docs):
    rows, df = docs
    got = line_dedup.line_dedup(df)
    assert got.columns == [*df.columns, "n_lines", "n_dropped", "kept_text"]
    found = got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert fixtures.by_str(found) == fixtures.by_str(fixtures.line_dedup(rows))
    assert any(r["n_dropped"] for r in found)


def test_line_dedup_writes_few_files(spark):
    rows = [(i, "\n".join(f"line {n} that many documents have and that is long enough" for n in range(300))) for i in range(6)]
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        at = f"{shared_dir(spark).removeprefix('file://').removeprefix('file:')}/chorale-*/frequent"
        made = set(glob.glob(at))
        out = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
        made = set(glob.glob(at)) - made
        assert len(made) == 1 and 1 <= len(glob.glob(f"{made.pop()}/*.parquet")) <= 4
        assert {r["doc_id"]: r["n_dropped"] for r in out.collect()} == {i: 300 * (i < 5) for i in range(6)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_line_dedup_runs_no_python(docs):
    _, df = docs
    plan = line_dedup.line_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# packing


def test_packing(docs, library):
    rows, df = docs
    got = packing.best_fit_packing(df, BPE, open_bins=4).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    once = {i: t for i, t, *_ in rows if sum(r[0] == i for r in rows) == 1 and i is not None}
    for i, t in once.items():
        own = sorted(pieces[i], key=lambda r: r["piece"])
        ids = [*library_ids(library, t), 2]
        assert [x for r in own for x in r["ids"]] == ids
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
        assert all(r["length"] == 1024 for r in own[1:])
        assert len(own) == max(1, -(-len(ids) // 1024))
    total = sum(len(library_ids(library, t)) + 1 for _, t, *_ in rows)
    assert len(bins) <= -(-total // 1024) + 2


def test_packing_of_many_partitions(spark, library):
    import random

    rng = random.Random(3)
    rows = [(i, fixtures.prose(rng, rng.randint(1, 500))) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    got = packing.best_fit_packing(df, BPE, with_ids=False)
    used, total = got.select("sequence_id").distinct().count(), got.agg(F.sum("length")).first()[0]
    assert used <= 1.03 * total / 1024 + 1


@given(st.lists(st.integers(1, 100), max_size=200), st.integers(1, 8))
def test_best_fit_never_overfills(sizes, limit):
    packer = packing.BestFit(100, limit, iter(range(10**6)))
    fill = defaultdict(int)
    for n in sizes:
        b, at = packer.add(n)
        assert at == fill[b]
        fill[b] += n
        assert fill[b] <= 100
        assert packer.count <= limit
        assert sorted(packer.open()) == sorted(set(packer.open()))


# BPE


def test_encoding_and_decoding(docs, library):
    rows, df = docs
    got = bpe.encode_decode(df, BPE).collect()
    want = [(i, library_ids(library, t)) for i, t, *_ in rows]
    assert fixtures.by_str((r["doc_id"], list(r["ids"]), r["decoded"]) for r in got) == fixtures.by_str(
        (i, ids, library.decode(ids, skip_special_tokens=False)) for i, ids in want
    )


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text("abeinorst' \n\t.,0123é<|endoftext|>", max_size=80))
def test_ids_of_any_text(text):
    library = Tokenizer.from_file(BPE)
    for tokens in (bpe.own_tokens(BPE), pretokens.library_tokens(BPE)):
        ids, _ = tokens.ids(tokens.split([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_pretokens_of_every_code_point(library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for around in ("a{0}b", " {0} 1{0}", "{0}'s{0}"):
        texts = [around.replace("{0}", chr(c)) for c in points]
        tokens = pretokens.library_tokens(BPE)
        ids, at = tokens.ids(tokens.split(texts))
        flat = [x for e in library.encode_batch_fast(texts, add_special_tokens=False) for x in e.ids]
        assert ids.tolist() == flat
        assert at[-1] == len(flat)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab1 '\n\tstrevlmd.!é", max_size=30), max_size=4))
def test_pretokens_are_the_matches_of_the_pattern(texts):
    found = pretokens.PreTokens(texts, [])
    for n, text in enumerate(texts):
        own = found.of[found.bounds[n] : found.bounds[n + 1]]
        assert [found.words[k] for k in own] == regex.findall(pretokens.PATTERN, text)


def test_decoding_of_broken_ids(library):
    own = bpe.encoder(BPE)
    ids = [library_ids(library, "é")[0], 50256, 220]
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert own.decode(ids[:1] * 2)


def test_suffix_automaton_finds_all_words():
    vocabulary = {b"a": 0, b"b": 1, b"ab": 2, b"bab": 3, b"abab": 4}
    a = bpe.suffix_automaton(vocabulary)
    at, found = 0, []
    for c in b"abab":
        at = a.targets[a.labels.find(bytes([c]), a.first[at], a.first[at + 1])]
        found.append(at)
    chain, state = set(), found[-1]
    while state > 0:
        chain |= {i for _, i in a.tokens.get(state, ())}
        state = a.link[state]
    assert chain == {1, 2, 3, 4}


# sharding


def test_sharding(docs):
    rows, df = docs
    got = sharding.shard_by_bytes(df).collect()
    sizes = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows]
    assert fixtures.by_str((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == fixtures.by_str(sizes)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    ordered = sorted(got, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert [r["shard"] for r in ordered] == sorted(r["shard"] for r in got)


def test_shards_are_near_equal(spark):
    rows = [(i, "x" * (i * 37 % 500)) for i in range(2000)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    sums = [r[1] for r in got.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sums) == 16
    assert max(sums) - min(sums) <= 1002


# near duplicates


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_near_duplicates(docs, percent):
    rows, df = docs
    got = minhash.near_duplicates(df, percent=percent).collect()
    of = fixtures.components(rows, percent)
    assert len(got) == len(rows)
    want = [(i, len(fixtures.shingles(t)), of.get(i) if i is not None else None, i is None or of[i] == i) for i, t, *_ in rows]
    assert fixtures.by_str((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == fixtures.by_str(want)


def test_chains_are_followed_to_their_end(spark):
    """Each text differs a little from the one before: only neighbours are linked, and all are one component."""
    import random

    rng = random.Random(2)
    text = fixtures.prose(rng, 150, 5000).replace("\n", "").split()
    rows = []
    for i in range(30):
        rows.append((100 - i, " ".join(text)))
        for _ in range(2):
            text[rng.randrange(len(text))] = f"new{i}{rng.random()}"
    of = fixtures.components(rows, 85)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == of
    assert len(set(of.values())) < 10


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    """Texts that are alike below the threshold, and pairs among them above it, in blocks of about two."""
    import random

    monkeypatch.setattr(minhash, "BLOCK", 600)
    rng = random.Random(4)
    base = fixtures.prose(rng, 300, 9000).replace("\n", "").split()
    rows = []
    for i in range(8):
        own = list(base)
        for k in rng.sample(range(300), 9):
            own[k] = f"own{i}x{k}"
        rows.append((2 * i, " ".join(own)))
        own[150] = f"twin{i}"
        rows.append((2 * i + 1, " ".join(own)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == fixtures.components(rows, 85)


@pytest.mark.parametrize("vocabulary", [30, 10**9])
def test_near_copies_of_one_text_around_the_threshold(spark, monkeypatch, vocabulary):
    """Links are those of brute force, whether the copies' own words are shared or not."""
    import random

    monkeypatch.setattr(minhash, "BLOCK", 2400)
    monkeypatch.setattr(minhash, "OFTEN", 40)
    monkeypatch.setattr(minhash, "RUN", 8)
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.choice((2, 3, 3, 4))):
            words[rng.randrange(150)] = f"x{rng.randrange(vocabulary)}"
        rows.append((i, " ".join(words)))
    want = fixtures.components(rows, 85)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert len(set(want.values())) > 100


def test_hub_runs(spark):
    """Pairs judged in runs of a hub are those of the texts' sets, whatever the hub's number of partners."""
    texts = ["a b c d e f g h", "a b c d e f g x", "A b c d e f g h", "q r s t u v", "", "a b c d e f g h i"]
    bodies = spark.createDataFrame([(i, len(fixtures.shingles(t)), t) for i, t in enumerate(texts)], "id long, n long, body string")
    pairs = spark.createDataFrame([(a, b, a % 2 + b % 3) for a in range(6) for b in range(6) if a != b], "a long, b long, run long")
    got = {tuple(r) for r in minhash._met(pairs, bodies, minhash._by_text(60)).collect()}
    sets = [fixtures.shingles(t) for t in texts]
    assert got == {(a, b) for a in range(6) for b in range(6) if a != b and sets[a] | sets[b] and 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b])}


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.9):
        n = 2000
        common = rng.integers(0, 2**63, int(n * share), dtype=np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 2**63, n - len(common), dtype=np.uint64)]) for _ in "ab")
        regs = minhash.registers(np.concatenate([a, b]), np.array([0, n, 2 * n]))
        true = len(common) / (2 * n - len(common))
        assert minhash.estimate(regs[:1], regs[1:], np.array([n]), np.array([n]))[0] == pytest.approx(true, abs=0.17)
        both = minhash.registers(np.concatenate([a, b]), np.array([0, 2 * n]))
        assert (both[0] == np.maximum(regs[0], regs[1])).all()


# substring dedup


@pytest.mark.parametrize("joined", [True, False])
def test_substring_dedup(docs, joined, monkeypatch):
    monkeypatch.setattr(substring, "GROUP_BYTES", 20_000)
    rows, df = docs
    got = substring.substring_dedup(df, joined=joined).collect()
    want = fixtures.removed_words(rows)
    assert fixtures.by_str((r["doc_id"], r["n_words"], r["n_removed"]) for r in got) == fixtures.by_str((i, len(w), sum(g)) for i, w, g in want)
    kept = fixtures.by_str((i, *(x for x, gone in zip(w, g, strict=True) if not gone)) for i, w, g in want)
    assert fixtures.by_str((r["doc_id"], *fixtures.words(r["kept_text"])) for r in got) == kept
    if joined:
        assert all(r["kept_text"] == " ".join(fixtures.words(r["kept_text"])) for r in got)
    else:
        untouched = {r["doc_id"]: r["kept_text"] for r in got if not r["n_removed"]}
        assert all(untouched[i] == (t or "") for i, t, *_ in rows if i in untouched and sum(r[0] == i for r in rows) == 1)


def test_substring_carries_columns(docs):
    rows, df = docs
    got = substring.substring_dedup(df)
    assert got.columns == ["doc_id", "lang", "rank", "a.b", "n_words", "n_removed", "kept_text"]
    assert fixtures.by_str(got.select("doc_id", "lang", "rank", "`a.b`").collect()) == fixtures.by_str((r[0], *r[2:]) for r in rows)


# toxicity


def labelled(spark, n=600):
    import random

    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        w = fixtures.prose(rng, 60).split()
        bad = i % 4 == 0
        if bad:
            for k in rng.sample(range(len(w)), 4):
                w[k] = rng.choice(["idiot", "M0r0n!", "brznk" + rng.choice("abcdef"), "іdіot"])
        elif i % 4 == 1:
            w[5:7] = ["soap", "scum"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    labels += [(3, None), (None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark):
    docs, labels = labelled(spark)
    lexicon = toxicity.learn(docs, labels)
    assert any("brznk".startswith(s) or s.startswith("brznk") for s in lexicon.weights)
    got = toxicity.score_texts(docs, lexicon).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    assert got.where("predicted = toxic").count() >= 0.98 * got.where("toxic is not null").count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_matches_are_those_of_a_naive_search():
    import random

    rng = random.Random(3)
    lexicon = toxicity.Lexicon({"ab": 1.0, "abc": 2.0, "b": 0.5, "ca": 4.0}, ("ab ca", "b", "ca ab b", "abc abc"))
    matcher = lexicon.matcher()
    for _ in range(200):
        folded = toxicity.fold(" ".join("".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 14))))
        found = [(i, w) for i in range(len(folded)) for s, w in lexicon.weights.items() if folded.startswith(f" {s}", i)]
        spared = [(i, i + len(p) + 1) for i in range(len(folded)) for p in lexicon.exceptions if folded.startswith(f" {p} ", i)]
        want = [(at, w) for at, w in found if not any(i <= at < j for i, j in spared)]
        assert sorted(matcher.hits(folded)) == sorted(want)


def test_matching_takes_linear_time():
    matcher = toxicity.Lexicon({"idiot": 1.0}, ("idiot proof",)).matcher()
    start = time.perf_counter()
    folded = toxicity.fold("idiot proof " * 100_000 + "idiot x " * 100_000)
    assert len(matcher.hits(folded)) == 100_000
    assert time.perf_counter() - start < 20


def test_lexicon_is_that_of_plain_counting(spark):
    docs, labels = labelled(spark)
    lexicon = toxicity.learn(docs.withColumn("toxic", F.lit("x")).withColumn("doc", F.lit(1)), labels.withColumn("label_doc", F.lit(2)))
    known = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None and r["doc_id"] is not None}
    rows = docs.select("doc_id", "text", (F.pmod(F.xxhash64("text"), F.lit(toxicity.CURVE_PART)) == 0).alias("fits")).collect()
    used = {r["text"]: known[r["doc_id"]] for r in rows if r["doc_id"] in known and not r["fits"] and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    sizes = Counter(used.values())
    count = {0: Counter(), 1: Counter()}
    for text, y in used.items():
        count[y].update({s for w in toxicity.fold(text).split() for s in toxicity.stems(w)})
    odds = {s: toxicity.log_odds(n, count[0][s], sizes[1], sizes[0]) for s, n in count[1].items()}
    good = {s for s, n in count[1].items() if n >= max(5, 0.005 * sizes[1]) and odds[s] >= 3}
    kept = {}
    for s in sorted(good, key=lambda s: (len(s), s)):
        longer = max((count[1][x] for x in good if x != s and x.startswith(s)), default=0)
        if longer < 0.9 * count[1][s] and not any(s.startswith(x) for x in kept):
            kept[s] = odds[s]
    seen = {s: (count[1][s], count[0][s]) for s in {*count[0], *count[1]}}
    kept = toxicity.with_seeds(kept, seen, sizes[1], sizes[0])
    assert lexicon.weights == pytest.approx(kept)
    assert {toxicity.fold(p).strip() for p in toxicity.EXCEPTIONS} <= set(lexicon.exceptions)


def test_toxicity_without_labels(spark, docs):
    rows, df = docs
    lexicon = toxicity.learn(df, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.score_texts(df, lexicon).collect()
    assert len(got) == len(rows)
    m = lexicon.matcher()
    assert m.score("such an 1d10t, m0rоn and l0ser") > 0.5 > m.score("an idiot proof device")


def test_held_out_is_crc32(spark):
    got = spark.range(50).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


# empty tables


def test_empty_tables(spark, empty):
    assert quality.quality_rules(empty, BPE, PIECES).collect() == []
    assert line_dedup.line_dedup(empty).collect() == []
    assert packing.best_fit_packing(empty, BPE).collect() == []
    assert bpe.encode_decode(empty, BPE).collect() == []
    assert sharding.shard_by_bytes(empty).collect() == []
    assert minhash.near_duplicates(empty).collect() == []
    assert substring.substring_dedup(empty).collect() == []
    lexicon = toxicity.learn(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_texts(empty, lexicon).collect() == []


def test_clashing_names(docs):
    """Columns called like new or internal ones, in every operator."""
    rows, plain = docs
    names = "id row text_row n key h1 h2 pos line line_doc line_text line_drops kept_text n_lines n_words n_removed grp part band class size rejected_doc dropped_row piece packer ids score"
    df = plain.select("doc_id", "text", "lang", *(F.lit("x").alias(n) for n in names.split()))
    few = ["doc_id", "n_lines", "n_dropped", "kept_text"]
    assert fixtures.by_str(line_dedup.line_dedup(df).select(few).collect()) == fixtures.by_str(fixtures.line_dedup(rows))
    got = substring.substring_dedup(df).select("doc_id", "n_words", "n_removed").collect()
    assert fixtures.by_str(got) == fixtures.by_str((i, len(w), sum(g)) for i, w, g in fixtures.removed_words(rows))
    verdicts = quality.quality_rules(df, BPE, PIECES)
    assert quality.keep(df, verdicts).columns == df.columns
    found = minhash.near_duplicates(df)
    assert minhash.keep(df, found).count() == found.where("kept").count()
    for out in (packing.best_fit_packing(df, BPE, with_ids=False).select("doc_id").distinct(), bpe.encode_decode(df, BPE).select("doc_id").distinct(), sharding.shard_by_bytes(df).select("doc_id").distinct()):
        assert out.count() == plain.select("doc_id").distinct().count()
    with pytest.raises(ValueError):
        line_dedup.line_dedup(df.drop("text"))
