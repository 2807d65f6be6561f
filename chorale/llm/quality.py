"""Quality rules: tokeniser fertility.

Public vocabularies measure each text: code points per token and token entropy by a
byte-level BPE, the share of byte-fallback pieces by a sentencepiece BPE. That model gets the
pre-tokens without the white space around them: it would spell tabs and line ends in bytes,
which says nothing about a text's language.

The rejection bands come from all documents: per language and size of text, per language, and
per script and size, the quartiles of each measure give a median and a robust spread, and a text
is rejected where a measure leaves ``WIDTH`` spreads. The three bands of a text and the fixed
limits are blended by the number of documents behind each, so that no count switches a band on.
Quartiles are exact on a grid of ``GRID``: values are counted before they move, and a band has
as many rows as the grid has values there, never one per document.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import Scratch, broadcast_if_small, col, has, spare, text_id
from chorale.llm.kernels import CACHES, CHUNK_BYTES, WordHash, chunks, find_words, trim
from chorale.llm.pretokens import WordCache, library_tokens

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
#: Half width of a band in robust standard deviations, and the least deviation it counts with, as a
#: share of the median: so that many copies of one text can't shrink a band onto themselves.
WIDTH = 4.5
LEAST_SPREAD = 0.03
#: A band of n documents weighs n / (n + PRIOR_DOCUMENTS) against the next wider one.
PRIOR_DOCUMENTS = 10
#: Decimals of the values that are counted for the quartiles.
GRID = 3
#: Fixed limits, the widest band: code points per token, share of byte-fallback pieces. The lower one and the share
#: hold in ``COVERED`` scripts only: in others the vocabularies take clean text to about a token a byte.
CHARS_PER_TOKEN = (1.0, 12.0)
MOST_FALLBACK = 0.5
COVERED = ("Latin", "none")
#: Entropy in bits that a text of ``LONG_TOKENS`` tokens or more has in any language; less of a shorter one, in
#: proportion to the most that so many tokens can have.
LEAST_ENTROPY = 3.0
LONG_TOKENS = 256
#: In the order in which ties are broken; 'Other' is any other letter.
SCRIPTS = (
    "Arabic", "Armenian", "Bengali", "Cyrillic", "Devanagari", "Ethiopic", "Georgian", "Greek", "Gujarati", "Gurmukhi", "Han", "Hangul",
    "Hebrew", "Hiragana", "Kannada", "Katakana", "Khmer", "Lao", "Latin", "Malayalam", "Myanmar", "Other", "Sinhala", "Tamil", "Telugu",
    "Thai", "Tibetan",
)

_FIND_SCRIPT = regex.compile("|".join(rf"(?P<{s}>\p{{Script={s}}})" for s in SCRIPTS if s != "Other") + r"|(?P<Other>\p{L})")

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, "
    "chars_per_token double, fallback_share double, token_entropy double, script string"
)


@cache
def _script_table() -> np.ndarray:
    """The place in SCRIPTS of each code point's script, len(SCRIPTS) for none."""
    table = np.full(0x110000, len(SCRIPTS), np.uint8)
    points = "".join(map(chr, (c for c in range(0x40000) if not 0xD800 <= c < 0xE000)))
    for m in _FIND_SCRIPT.finditer(points):
        table[ord(m[0])] = SCRIPTS.index(m.lastgroup)
    return table


def scripts_of(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The commonest script among each text's letters; 'none' without a letter. Texts are UTF-8."""
    counts = np.zeros((len(offsets) - 1, len(SCRIPTS) + 1), np.int64)
    counts[:, SCRIPTS.index("Latin")] = _per_text(_ASCII_LETTER[buf], offsets)
    at = np.flatnonzero(buf >= 0xC0)
    if len(at):
        lead = buf[at].astype(np.int32)
        n = 1 + (lead >= 0xE0) + (lead >= 0xF0)
        point = lead & (0x3F >> n)
        for i in range(1, 4):
            more = buf[np.minimum(at + i, len(buf) - 1)] & 0x3F
            point = np.where(i <= n, (point << 6) | more, point)
        text = np.searchsorted(offsets, at, "right") - 1
        key = text * counts.shape[1] + _script_table()[point]
        counts += np.bincount(key, minlength=counts.size).reshape(counts.shape)
    named = counts[:, :-1]
    return np.where(named.any(axis=1), np.array(SCRIPTS)[named.argmax(axis=1)], "none")


class PieceCounts:
    """Pieces and byte-fallback pieces of pre-tokens by a sentencepiece model, as pieces + 2^32 * fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.cache = WordCache(self._count)

    def _count(self, words: list[str]) -> list[int]:
        found = self.model.encode([w.strip() for w in words], num_threads=1)
        return [len(x) + (int(self.is_byte[x].sum()) << 32) if x else 0 for x in found]

    def __call__(self, words: list[str]) -> np.ndarray:
        return np.array(self.cache(words), np.int64)


@cache
def _piece_counts(path: str) -> PieceCounts:
    return PieceCounts(path)


CACHES.append(_piece_counts.cache_clear)


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_HASH = WordHash(0x5EED)


def repeat_words(buf: np.ndarray, offsets: np.ndarray, window: int = REPEAT_WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and those of them inside a window that the text holds more than once.

    Windows are compared by 64-bit hashes, and only inside one text."""
    words = find_words(buf, offsets)
    counts = words.counts
    hashes = _HASH.windows(_HASH.words(buf, words.starts, words.ends), window)
    starts = np.flatnonzero(words.window_starts(window)[: len(hashes)])
    if not len(starts):
        return counts, np.zeros(len(counts), np.int64)
    text, hashes = words.text_of_word()[starts], hashes[starts]
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(words.starts) + 1, np.int64)
    at = starts[order[twice]]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return counts, _per_text(np.cumsum(edge[:-1]) > 0, words.first)


def _dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def measure_texts(column: pa.Array, bpe_path: str, piece_path: str) -> Iterator[list[pa.Array]]:
    """The columns of MEASURES, for one chunk of texts after the other."""
    tokens, counts = library_tokens(bpe_path), _piece_counts(piece_path)
    for i, j, buf, offsets in chunks(column, CHUNK_BYTES // 2):
        texts = [t or "" for t in column.slice(i, j - i).to_pylist()]
        n_words, n_repeat = repeat_words(buf, offsets)
        points = _per_text((buf & 0xC0) != 0x80, offsets)
        spaces = _per_text((buf == 0x20) | ((buf >= 9) & (buf <= 13)), offsets)
        found = tokens.split(texts)
        ids, at = tokens.ids(found)
        n_tokens = np.diff(at)
        key = np.repeat(np.arange(len(texts), dtype=np.int64) << 32, n_tokens) + ids
        kinds, times = np.unique(key, return_counts=True)
        plogp = np.bincount(kinds >> 32, weights=times * np.log2(times), minlength=len(texts))
        some = np.maximum(n_tokens, 1)
        pieces = _per_text(counts(found.words)[found.of], found.bounds)
        yield [
            pa.array(x)
            for x in (
                n_words.astype(np.int64), points - spaces, _per_text(_SYMBOL[buf], offsets),
                np.array([_dup_lines(t) for t in texts], np.int64), n_repeat, n_tokens,
                points / some, (pieces >> 32) / np.maximum(pieces & 0xFFFFFFFF, 1),
                np.maximum(np.log2(some) - plogp / some, 0.0),
            )
        ] + [pa.array(scripts_of(buf, offsets).tolist(), pa.string())]


def measure(docs: DataFrame, bpe_path: str, piece_path: str) -> DataFrame:
    """Of rows (id, row, lang, text): id, row, lang and the columns of MEASURES, in one pass over the texts."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, row long, lang string, {MEASURES}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for own in measure_texts(batch.column("text"), bpe_path, piece_path):
                part = batch.slice(at, len(own[0]))
                at += len(own[0])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row"), part.column("lang"), *own], [f.split()[0] for f in schema.split(", ")]
                )
        trim()

    return docs.select("id", "row", "lang", "text").mapInArrow(run, schema)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


BANDED = ("chars_per_token", "fallback_share", "token_entropy")


#: The bands of a text from the widest to the narrowest, and what documents have in common in each.
LEVELS = {"script": ("script", "class"), "lang": ("band",), "own": ("band", "class")}


def _grid(sound: DataFrame) -> DataFrame:
    """How many documents of each band, script and size class have each value of each measure."""
    values = F.array(*(F.struct(F.lit(m).alias("measure"), (F.round(F.col(m), GRID) + 0.0).alias("value")) for m in BANDED))
    rows = sound.select("band", "script", "class", F.explode(values).alias("v"))
    return rows.groupBy("band", "script", "class", "v.measure", "v.value").agg(F.count(F.lit(1)).alias("n"))


def _bands(grid: DataFrame, level: str) -> DataFrame:
    """Per key of the level: its weight, and the median and robust spread of each measure. A quartile is the least value
    that so many documents do not exceed."""
    keys = LEVELS[level]
    counts = grid.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
    of = Window.partitionBy(*keys, "measure")
    upto = F.sum("n").over(of.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumn("upto", upto).withColumn("all", F.sum("n").over(of))
    quartiles = [F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("value"))).alias(f"q{i}") for i, q in enumerate((0.25, 0.5, 0.75))]
    found = ranked.groupBy(*keys, "measure").agg(F.max("all").alias("n"), *quartiles)
    spread = F.struct(F.col("q1").alias("mid"), ((F.col("q2") - F.col("q0")) / 1.349).alias("spread"))
    weight = (F.max("n") / (F.max("n") + PRIOR_DOCUMENTS)).alias(f"{level}_weight")
    return found.groupBy(*keys).agg(weight, *(F.max(F.when(F.col("measure") == m, spread)).alias(f"{level}_{m}") for m in BANDED))


def _blended(edge: Callable[[Column], Column], fixed: Column, measure: str) -> Column:
    """The edge of a text's bands, each blended with what the wider ones give; without any the fixed limit."""
    out = fixed
    for level in LEVELS:
        weight = F.coalesce(f"{level}_weight", F.lit(0.0))
        out = weight * F.coalesce(edge(F.col(f"{level}_{measure}")), F.lit(0.0)) + (1 - weight) * out
    return out


def _limit(measure: str, widths: float, fixed: Column) -> Column:
    """The edge ``widths`` times the half width of a band from its middle."""

    def edge(band: Column) -> Column:
        least = F.lit(0.01) if measure == "fallback_share" else LEAST_SPREAD * band["mid"]
        return band["mid"] + widths * WIDTH * F.greatest(band["spread"], least)

    return _blended(edge, fixed, measure)


def quality_rules(
    docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", lang_col: str | None = "lang", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id, ``text_row`` (see ``common.text_id``), lang, the columns of
    MEASURES, ``base_failed``, ``reject_reason`` (null: none) and ``kept``.

    ``kept`` is false if ``base_failed`` (fewer than 20 words, or over 30 % of them in repeated
    8-word windows), or if a measure leaves its band:

    - chars_per_token: outside the band of its language (or script) and size class, if the text has
      less than the band's middle of token_entropy too; outside twice the band in any case (names and
      mixed languages fragment too, but into many different tokens);
    - token_entropy: under the band, or under the fixed limit of any language, which grows with the text;
    - fallback_share: over the band.

    Size classes are powers of 4 of the token count. An edge is blended from the band of the language and
    size, that of the language over all sizes, that of the script and size, and fixed limits which the
    script sets; each weighs n / (n + 10) against the wider ones, n being its documents. Documents that
    fail the base rules make no band.

    - Null or empty text: no words, so base_failed. Null language: the commonest script names the band.
    - Texts of any length are measured whole, and no other column is read or carried, whatever it is called.
    - Null ids pass through; repeated rows are measured and judged alike. Empty table: empty result.
    """
    has(docs, id_col, text_col, *([lang_col] if lang_col else []))
    scratch = Scratch(docs.sparkSession)
    lang = col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    text = F.coalesce(col(text_col), F.lit(""))
    source = docs.select(col(id_col).alias("id"), text_id(text).alias("row"), lang.alias("lang"), text.alias("text"))
    measured = (
        scratch.write(measure(source, bpe_path, piece_path), "measures")
        .withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
        .withColumn("band", F.coalesce("lang", F.concat(F.lit("script "), "script")))
        .withColumn("class", F.floor(F.log2(F.greatest("n_tokens", F.lit(1)).cast("double")) / 2).cast("int"))
    )
    sound = measured.where(~F.col("base_failed"))
    grid = scratch.write(_grid(sound), "grid")
    judged = measured
    for level, keys in LEVELS.items():  # a language's rows may be most of the table, so its bands are broadcast where their size allows it
        judged = judged.join(broadcast_if_small(scratch.write(_bands(grid, level), f"bands-{level}")), list(keys), "left")
    covered = F.col("script").isin(*COVERED)
    low, high = F.when(covered, CHARS_PER_TOKEN[0]).otherwise(0.0), F.lit(CHARS_PER_TOKEN[1])
    cpt, entropy = F.col("chars_per_token"), F.col("token_entropy")
    poor = entropy < _blended(lambda band: band["mid"], F.lit(0.0), "token_entropy")
    few = (cpt < _limit("chars_per_token", -2, low)) | (poor & (cpt < _limit("chars_per_token", -1, low)))
    many = (cpt > _limit("chars_per_token", 2, high)) | (poor & (cpt > _limit("chars_per_token", 1, high)))
    fallback = F.col("fallback_share") > _limit("fallback_share", 1, F.when(covered, MOST_FALLBACK).otherwise(1.0))
    room = F.least(F.log2(F.greatest("n_tokens", F.lit(1)).cast("double")) / math.log2(LONG_TOKENS), F.lit(1.0))
    reason = (
        F.when(F.col("base_failed"), "base")
        .when(few, "few characters a token")
        .when(many, "many characters a token")
        .when(fallback, "byte fallback")
        .when((entropy < LEAST_ENTROPY * room) | (entropy < _limit("token_entropy", -1, F.lit(0.0))), "low entropy")
    )
    return judged.select(
        F.col("id").alias(id_col), F.col("row").alias("text_row"), "lang", *(m.split()[0] for m in MEASURES.split(", ")),
        "base_failed", reason.alias("reject_reason"), reason.isNull().alias("kept"),
    )


def keep(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality_rules(docs)`` keeps, with the columns of ``docs``."""
    ident, row = spare(docs, "rejected_doc", "rejected_row")
    out = verdicts.where(~F.col("kept")).select(col(id_col).alias(ident), F.col("text_row").alias(row)).distinct()
    same = col(id_col).eqNullSafe(F.col(ident)) & (text_id(F.coalesce(col(text_col), F.lit(""))) == F.col(row))
    return docs.join(broadcast_if_small(out), same, "left_anti")
