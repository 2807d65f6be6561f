"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding maps homoglyphs, accents, digit substitutions and letters that look alike to one
form, and takes separators out of words. The lexicon holds word beginnings with weights,
learnt as log odds from a bounded sample of labelled rows, beside a short seed list;
phrases that hold a match but are at home in harmless texts are exceptions. The summed
weights, normalised by the length of the text, give the score through a logistic curve
fitted on texts of the sample that did not choose the lexicon. The lexicon has no bound of
its own: no stem begins another, so a word of the sample brings one at most.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import Scratch, col, has, small_batches
from chorale.llm.kernels import pieces

#: Labelled rows that the lexicon and the curve are fitted on, at most: those with the smallest
#: xxhash64 of their id. Scoring covers every text.
SAMPLE_TOXIC, SAMPLE_CLEAN = 6_000, 12_000
#: Lengths of word beginnings; documents that must hold one; its least log odds; entries at most.
STEM_CHARS = range(3, 13)
LEAST_DOCUMENTS = 5
LEAST_SHARE = 0.005
LEAST_LOG_ODDS = 3.0
#: One in so many texts of the sample fits the curve; the others choose the lexicon.
CURVE_PART = 4
#: Bytes of text whose stems are counted at once.
COUNTED_BYTES = 1 << 20
THRESHOLD = 0.3
#: The curve where labels can't give one, and the penalty on its slope where they can.
DEFAULT_CURVE = (-4.0, 3.0)
RIDGE = 0.05

#: Insults that count before any label is seen, and phrases in which they are harmless.
SEEDS = (
    "idiot", "moron", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting", "imbecile", "dumbass",
    "asshole", "bastard", "bitch", "cretin", "dimwit", "jackass", "retard", "scumbag", "shithead", "fuck",
)
SEED_WEIGHT = 3.0
EXCEPTIONS = ("idiot proof", "idiot light", "idiot board", "pathetic fallacy", "sore loser", "pond scum", "soap scum", "stupid question")

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = (
    dict(zip("авекмнорстухіѕјԁԛԝһӏгп", "abekmhopctyxisjdqwhirn", strict=True))
    | dict(zip("αβεικνορτυχηωγ", "abeikvoptuxnwy", strict=True))
    | dict(zip("ıłøđħ", "iiodh", strict=True))
)
#: Digits and signs that stand for letters. i, l, 1, ! and | fold into one.
SUBSTITUTES = dict(zip("0134578@$!|l", "oieastbasiii", strict=True))
DROPPED = frozenset(".-_*'’‘\"`´~^­​‌‍⁠﻿")


class Fold(dict):
    """For str.translate: the folded form of every code point, made when first met."""

    def __missing__(self, point: int) -> str:
        out = []
        for c in unicodedata.normalize("NFKD", chr(point)).lower():
            c = SUBSTITUTES.get(c, HOMOGLYPHS.get(c, c))
            if c in DROPPED or unicodedata.category(c) == "Mn":
                continue
            out.append(c if c.isalnum() else " ")
        self[point] = "".join(out)
        return self[point]


_FOLD = Fold()


def fold(text: str) -> str:
    """The folded words with one space before and after each run; starts and ends with a space."""
    return f" {' '.join(text.translate(_FOLD).split())} "


def stems(word: str) -> list[str]:
    return [word[:k] for k in STEM_CHARS if k <= len(word)]


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float] = DEFAULT_CURVE

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.curve = lexicon.curve
        self.automaton = ahocorasick.Automaton()
        for stem, weight in lexicon.weights.items():
            self.automaton.add_word(f" {stem}", (len(stem) + 1, weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(place of the space before the word, weight) of the matches outside exception phrases."""
        if not len(self.automaton):
            return []
        found, spared = [], []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            (spared.append((start, end)) if weight is None else found.append((start, weight)))
        if not spared:
            return found
        found.sort()
        spared.sort()
        out, n, end = [], 0, 0
        for at, weight in found:
            while n < len(spared) and spared[n][0] <= at:
                end = max(end, spared[n][1])
                n += 1
            if at >= end:
                out.append((at, weight))
        return out

    def strength(self, folded: str) -> float:
        total = sum(w for _, w in self.hits(folded))
        return math.log1p(10 * total / math.sqrt(folded.count(" ") + 20)) if total else 0.0

    def score(self, text: str) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * self.strength(fold(text))))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counts(kind: str):
    """Per batch, the toxic and clean documents that hold each stem or each phrase around a match."""

    def run(batches: Iterator[pa.RecordBatch], matcher: Matcher | None = None) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in pieces(batch, "text", COUNTED_BYTES)):
            seen = (Counter(), Counter())
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                folded = fold(text or "")
                own = {s for w in set(folded.split()) for s in stems(w)} if kind == "stems" else phrases(folded, matcher)
                seen[1 - toxic].update(own)
            keys = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_pydict(
                {"key": pa.array(keys, pa.string()), "toxic": pa.array([seen[0][k] for k in keys], pa.int64()), "clean": pa.array([seen[1][k] for k in keys], pa.int64())}
            )

    return run


def phrases(folded: str, matcher: Matcher) -> set[str]:
    """The pairs of words, with the one before and the one after, that hold a match."""
    out = set()
    for at, _ in matcher.hits(folded):
        end = folded.index(" ", at + 1)
        after = folded.find(" ", end + 1)
        before = folded.rfind(" ", 0, at) if at else -1
        if after > 0:
            out.add(folded[at + 1 : after])
        if before >= 0:
            out.add(folded[before + 1 : end])
    return out


def log_odds(t: int, c: int, toxic: int, clean: int) -> float:
    return math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))


def choose_stems(good: DataFrame) -> DataFrame:
    """Of stems (key, toxic, clean): of those inside each other, the longest that nearly as many toxic documents hold as
    the shorter. None that is left begins another."""
    key = F.col("key")
    starts = F.transform(F.sequence(F.lit(1), F.char_length(key) - 1), lambda k: key.substr(F.lit(1), k))
    longer = good.select(F.explode(starts).alias("key"), F.col("toxic").alias("n")).groupBy("key").agg(F.max("n").alias("longer"))
    last = good.join(longer, "key", "left").where(F.coalesce("longer", F.lit(0)) < 0.9 * F.col("toxic")).drop("longer")
    inside = last.select("key", F.explode(starts).alias("start")).join(last.select(key.alias("start")), "start", "left_semi")
    return last.join(inside.select("key").distinct(), "key", "left_anti")


def with_seeds(kept: dict[str, float], seen: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """The weights of the stems, and of the seeds that no stem begins and that are not at home in clean texts."""
    for seed in SEEDS:
        s = fold(seed).strip()
        t, c = seen.get(s[: STEM_CHARS[-1]], (0, 0))
        if not any(s[:k] in kept for k in range(1, len(s) + 1)) and not (c and log_odds(t, c, toxic, clean) < 1):
            kept = {k: w for k, w in kept.items() if not k.startswith(s)} | {s: SEED_WEIGHT}
    return kept


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of one variable by Newton steps, with a small penalty on the slope."""
    if not len(y) or y.min() == y.max():
        return DEFAULT_CURVE
    a, b = math.log(y.mean() / (1 - y.mean())), 1.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p) + 1e-9
        grad = np.array([(p - y).sum() + 1e-3 * a, ((p - y) * x).sum() + RIDGE * b])
        hess = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + RIDGE]])
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        a, b = a - step[0] * min(1, 2 / size), b - step[1] * min(1, 2 / size)
        if size < 1e-6:
            break
    return float(a), float(max(b, 0.1))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """The lexicon and curve from labelled rows that are not held out; ``labels`` has the id and ``toxic`` (0 or 1).

    At most SAMPLE_TOXIC and SAMPLE_CLEAN labelled ids are learnt from; copies of a text count once.

    - Null ids and null labels teach nothing; of several labels of an id the larger holds. Null or empty text: no word.
    - Texts of any length are read whole, about COUNTED_BYTES at a time. Empty tables: the seeds and a fixed curve.
    - Other columns of both tables are ignored, whatever they are called.
    """
    docs, labels = docs.select(col(id_col).alias("doc"), col(text_col).alias("text")), labels.select(col(id_col).alias("doc"), col("toxic").alias("toxic"))
    spark = docs.sparkSession
    scratch = Scratch(spark)
    usable = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc")) & F.col("doc").isNotNull())
    known = usable.groupBy(F.col("doc").alias("label_doc")).agg(F.max("toxic").cast("int").alias("toxic"))
    first = [
        known.where(F.col("toxic") == y).orderBy(F.xxhash64("label_doc"), "label_doc").limit(n)
        for y, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
    ]
    chosen = scratch.write(first[0].unionByName(first[1]), "chosen")
    # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of 12 bytes are broadcast
    sample = (
        docs.withColumnRenamed("doc", "label_doc")
        .join(F.broadcast(chosen), "label_doc")
        .groupBy("toxic", F.xxhash64("text").alias("copy"))
        .agg(F.min("text").alias("text"))  # copies of a text are no further evidence
    )
    sample = scratch.write(sample.withColumn("fits", F.pmod("copy", F.lit(CURVE_PART)) == 0), "sample")
    choosing = sample.where(~F.col("fits"))
    sizes = dict(choosing.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    schema = "key string, toxic long, clean long"

    def summed(run) -> DataFrame:
        return choosing.mapInArrow(run, schema).groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))

    seeds = [fold(s).strip()[: STEM_CHARS[-1]] for s in SEEDS]
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    is_good = (F.col("toxic") >= max(LEAST_DOCUMENTS, LEAST_SHARE * toxic)) & (odds >= LEAST_LOG_ODDS)
    found = scratch.write(summed(_counts("stems")).withColumn("good", is_good).where(F.col("good") | F.col("key").isin(seeds)), "stems")
    kept = choose_stems(found.where("good").drop("good")).collect()
    seen = found.where(F.col("key").isin(seeds)).collect()
    weights = with_seeds(
        {r["key"]: log_odds(r["toxic"], r["clean"], toxic, clean) for r in sorted(kept)},
        {r["key"]: (r["toxic"], r["clean"]) for r in seen}, toxic, clean,
    )

    spared = tuple(fold(p).strip() for p in EXCEPTIONS)
    plain = Lexicon(weights, spared)
    around = summed(lambda batches: _counts("phrases")(batches, plain.matcher()))
    harmless = around.where((F.col("clean") >= LEAST_DOCUMENTS) & (odds < 0)).select("key").collect()
    lexicon = Lexicon(weights, tuple(sorted({*spared, *(r["key"] for r in harmless)})))

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for part in (p for batch in batches for p in pieces(batch, "text")):
            x = [matcher.strength(fold(t or "")) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), part.column("toxic").cast(pa.float64()), part.column("fits")], ["x", "y", "fits"])

    rows = sample.select("text", "toxic", "fits").mapInArrow(strengths, "x double, y double, fits boolean").collect()
    fitting = [r for r in rows if r["fits"]]
    if len({r["y"] for r in fitting}) < 2:  # too few for a part of their own
        fitting = rows
    x, y = (np.array([r[c] for r in fitting], float) for c in "xy")
    scratch.keep()
    return Lexicon(lexicon.weights, lexicon.exceptions, fit_curve(x, y))


def score_texts(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD on).

    Only the text is an input of the score. Null or empty text: the score of a text without a match.
    Texts of any length are read whole, in time linear in their length and matches. Repeated rows score alike, null
    ids pass through; empty table: empty result; other columns are not carried, whatever they are called.
    """
    has(docs, id_col, text_col)
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for part in (p for batch in batches for p in pieces(batch, "text")):
            scores = [matcher.score(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

    out = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
