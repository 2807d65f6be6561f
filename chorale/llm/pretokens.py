"""Byte-level BPE files of the tokenizers library: their parts, the split into pre-tokens, and cached encoding."""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Callable, Iterable
from functools import cache

import numpy as np
import regex

from chorale.llm.kernels import CACHES, mix64

#: Fixed value: the pre-token pattern of the published byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pre-tokens in each of a cache's two generations. Bounds memory, not results.
CACHE_WORDS = 120_000
#: Longer pre-tokens are encoded each time, so that the cache stays small in bytes as well.
CACHE_CHARS = 64


def byte_alphabet() -> dict[str, int]:
    """The published code for bytes: printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


#: The white space of Unicode.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _by_category() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[list(WHITE_SPACE)] = _SPACE
    return out


def _by_regex() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    points = np.array([*range(0xD800), *range(0xE000, 0x110000)])
    text = "".join(map(chr, points))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            out[points[m.start() : m.end()]] = kind
    return out


def _by_library(point: int) -> int:
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    c = chr(point)
    spans = [j - i for _, (i, j) in split(f"a{c}1")]
    if spans[0] == 2:
        return _LETTER
    if spans[1] == 2:
        return _NUMBER
    return _OTHER if split(f"{c}'s")[0][1] == (0, 2) else _SPACE


@cache
def _classes() -> np.ndarray:
    """The pattern's class of every code point. Versions of Unicode differ in what is assigned: where two
    tables do, the library that the ids must equal decides."""
    out, other = _by_category(), _by_regex()
    for point in np.flatnonzero(out != other).tolist():
        if not 0xD800 <= point < 0xE000:
            out[point] = _by_library(point)
    return out


def _contraction(after: np.ndarray) -> np.ndarray:
    """Letters of a contraction by the three code points after its apostrophe; 0: none."""
    one = np.isin(after[:, 0], [ord(c) for c in "stmd"])
    two = np.zeros(len(after), bool)
    for pair in ("re", "ve", "ll"):
        two |= (after[:, 0] == ord(pair[0])) & (after[:, 1] == ord(pair[1]))
    return np.where(one, 1, np.where(two, 2, 0))


def token_starts(points: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Where the pattern's matches start in texts that lie one after the other; borders: their starts and the end.

    Matches are runs of one class. A run of white space gives its last character away if
    a text goes on after it: a space to the next run, another character to a token of its
    own. A lone apostrophe that starts a token takes the letters of a contraction with it.
    """
    n = len(points)
    kind = _classes()[points]
    first = np.zeros(n + 1, bool)
    first[1:n] = kind[1:] != kind[:-1]
    first[borders] = True
    edge = first.copy()
    ends = np.zeros(n + 1, bool)
    ends[borders] = True
    space = kind == _SPACE
    # the last character of white space before more text of the same document
    tail = np.zeros(n, bool)
    tail[:-1] = space[:-1] & ~space[1:] & ~ends[1:n]
    first[:n] |= tail
    given = np.flatnonzero(tail & (points == 0x20))
    first[given + 1] = False
    lone = np.zeros(n, bool)
    lone[:] = (points == 0x27) & first[:n] & edge[1:]
    at = np.flatnonzero(lone)
    if len(at):
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        after = np.stack([padded[at + 1], padded[at + 2]], axis=1)
        after[:, 0][ends[at + 1]] = 0
        after[:, 1][ends[np.minimum(at + 2, n)]] = 0
        letters = _contraction(after)
        hit, letters = at[letters > 0], letters[letters > 0]
        first[hit + 1] = False
        first[hit + 1 + letters] = True
    return np.flatnonzero(first[:n])


class PreTokens:
    """The pre-tokens of a chunk of texts, each distinct one once.

    ``words`` holds the distinct ones, ``of`` the index into it of every pre-token in order, and
    ``bounds`` the range of pre-tokens of each text. They are told apart by 64-bit hashes within the chunk.
    """

    _FACTORS = np.ones(1, np.uint64)

    def __init__(self, texts: list[str], specials: list[str]):
        parts, owners = texts, None
        if specials and any(s in t for t in texts for s in specials):
            cut = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")").split
            split = [cut(t) for t in texts]
            parts = [x for own in split for x in own]
            owners = np.cumsum([0, *(len(own) for own in split)])
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        borders = np.concatenate([[0], np.cumsum(lengths)])
        text = "".join(parts)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        starts = token_starts(points, borders)
        if owners is not None:
            whole = [i for own in zip(owners[:-1], owners[1:], strict=True) for i in range(own[0] + 1, own[1], 2)]
            inside = np.zeros(len(points) + 1, bool)
            inside[starts] = True
            for i in whole:
                inside[borders[i] : borders[i + 1]] = False
                inside[borders[i]] = True
            starts = np.flatnonzero(inside[: len(points)])
        ends = np.append(starts[1:], len(points))
        self.bounds = np.searchsorted(starts, borders if owners is None else borders[owners])
        if not len(starts):
            self.words, self.of = [], np.zeros(0, np.int64)
            return
        _, at, self.of = np.unique(self._hash(points, starts, ends), return_index=True, return_inverse=True)
        self.words = [text[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]

    @classmethod
    def _hash(cls, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lens = ends - starts
        while len(cls._FACTORS) < lens.max():
            grown = np.arange(1, 2 * len(cls._FACTORS) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            cls._FACTORS = mix64(grown) | np.uint64(1)
        inside = np.arange(len(points), dtype=np.int64) - np.repeat(starts, lens)
        value = mix64(points.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * cls._FACTORS[inside]
        return mix64(np.add.reduceat(value, starts) + lens.astype(np.uint64))


def expand(values: list[bytes], of: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids one after the other, and the offsets of each text: pre-token k has the ids ``values[of[k]]``,
    as little-endian uint32 bytes."""
    if not len(of):
        return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    sizes = np.fromiter(map(len, values), np.int64, len(values)) >> 2
    flat, first = np.frombuffer(b"".join(values), "<u4").astype(np.int32), np.cumsum(sizes) - sizes
    lens = sizes[of]
    ends = np.cumsum(lens)
    at = np.arange(int(ends[-1])) + np.repeat(first[of] - ends + lens, lens)
    return flat[at], np.concatenate([[0], ends])[bounds]


class WordCache:
    """A value for each pre-token; ``make`` gives those of new ones.

    Two generations: a full young one becomes the old one, and words that are met again come
    back, so frequent words stay and the memory stays bounded.
    """

    def __init__(self, make: Callable[[list[str]], list], limit: int = CACHE_WORDS):
        self.make, self.limit = make, limit
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def __call__(self, words: list[str]) -> list:
        get, get_old = self.young.get, self.old.get
        out = [get(w) for w in words]
        again = [i for i, v in enumerate(out) if v is None]
        new = []
        for i in again:
            if (v := get_old(words[i])) is None:
                new.append(i)
            else:
                out[i] = v
        for i, v in zip(new, self.make([words[i] for i in new]) if new else (), strict=True):
            out[i] = v
        if len(self.young) + len(again) > self.limit:
            self.old, self.young = self.young, {}
        self.young.update((words[i], out[i]) for i in again if len(words[i]) <= CACHE_CHARS)
        return out


class Tokens:
    """Ids of texts by their pre-tokens; ``encode`` gives the ids of new pre-tokens, special ones included, as
    little-endian uint32 bytes: a small array for each would take twice the memory."""

    def __init__(self, specials: Iterable[str], encode: Callable[[list[str]], list[bytes]], limit: int = CACHE_WORDS):
        self.specials = sorted(specials, key=len, reverse=True)
        self.cache = WordCache(encode, limit)

    def split(self, texts: list[str]) -> PreTokens:
        return PreTokens(texts, self.specials)

    def ids(self, found: PreTokens) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and each text's offsets."""
        return expand(self.cache(found.words), found.of, found.bounds)


def read_file(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@cache
def library_tokens(path: str) -> Tokens:
    """Ids by the tokenizers library itself; one per worker process.

    New pre-tokens go to its model in the byte alphabet, one by one: its whole pipeline would
    split them again, and costs nearly twice as much.
    """
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    specials = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
    alphabet, tokenize = {b: c for c, b in byte_alphabet().items()}, tok.model.tokenize

    def encode(words: list[str]) -> list[bytes]:
        return [
            array("I", [specials[w]] if w in specials else [t.id for t in tokenize(w.encode().decode("latin-1").translate(alphabet))]).tobytes()
            for w in words
        ]

    return Tokens(specials, encode)


CACHES.append(library_tokens.cache_clear)
