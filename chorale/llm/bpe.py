"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token exactly one token can be the last of the prefix's
encoding. A suffix automaton of the vocabulary gives the tokens that end at a
position; such a token is the last one if the token before it, the known last token
of the shorter prefix, and it stay apart when encoded together. Back-pointers from
the end then give the ids, without a merge queue.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from chorale.llm.common import col, has, small_batches
from chorale.llm.kernels import CACHES, pieces
from chorale.llm.pretokens import Tokens, byte_alphabet, read_file

#: Pre-tokens in each generation of the cache; new ones cost more here than in the library.
CACHED = 250_000
#: Remembered answers of the pair test; a full memory starts afresh.
PAIRS = 500_000
NEVER = 1 << 62


@dataclass
class Automaton:
    """A suffix automaton in flat arrays. State s has the edges ``first[s]`` to ``first[s + 1]``."""

    first: array
    labels: bytes
    targets: array
    link: array
    length: array
    tokens: dict[int, list[tuple[int, int]]]


def suffix_automaton(words: dict[bytes, int]) -> Automaton:
    """Of all the words together; ``tokens`` has (length, id) of the words in each state, longest first."""
    edges: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def state(size: int, out: dict[int, int]) -> int:
        edges.append(out)
        link.append(0)
        length.append(size)
        return len(edges) - 1

    def redirect(p: int, c: int, old: int, new: int) -> None:
        while p != -1 and edges[p].get(c) == old:
            edges[p][c] = new
            p = link[p]

    def suffix_of(p: int, c: int, q: int) -> int:
        """The state for the string of ``p`` and ``c``, cut out of ``q`` where q stands for longer ones."""
        if length[q] == length[p] + 1:
            return q
        copy = state(length[p] + 1, dict(edges[q]))
        link[copy], link[q] = link[q], copy
        redirect(p, c, q, copy)
        return copy

    def add(last: int, c: int) -> int:
        if (q := edges[last].get(c)) is not None:
            return suffix_of(last, c, q)
        new, p = state(length[last] + 1, {}), last
        while p != -1 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        link[new] = 0 if p == -1 else suffix_of(p, c, edges[p][c])
        return new

    for word in words:
        at = 0
        for c in word:
            at = add(at, c)
    tokens: dict[int, list[tuple[int, int]]] = {}
    for word, ident in words.items():
        at = 0
        for c in word:
            at = edges[at][c]
        tokens.setdefault(at, []).append((len(word), ident))
    for found in tokens.values():
        found.sort(reverse=True)
    first, targets, labels = array("I", [0]), array("I"), bytearray()
    for out in edges:
        labels += bytes(out)
        targets.extend(out.values())
        first.append(len(targets))
    return Automaton(first, bytes(labels), targets, array("i", link), array("I", length), tokens)


class PairTest:
    """Whether two neighbouring tokens stay as they are when their bytes are encoded together."""

    def __init__(self, merges: dict[tuple[int, int], int]):
        self.merged = merges
        self.halves = {t: pair for pair, t in merges.items()}
        self.memory: dict[int, bool] = {}

    def __call__(self, left: int, right: int) -> bool:
        key = left << 32 | right
        if (known := self.memory.get(key)) is None:
            if len(self.memory) >= PAIRS:
                self.memory.clear()
            known = self.memory[key] = self.apart(left, right, NEVER)
        return known

    def apart(self, left: int, right: int, before: int) -> bool:
        """Takes the two tokens' merges back, latest first. A merge across the border at any moment
        would have come first if its rank is under ``before``, the rank of what was taken back last
        (a tie goes to the leftmost, so the right token's own rank still loses to the border)."""
        while True:
            if self.merged.get((left, right), NEVER) < before:
                return False
            later = left if left > right else right
            if later not in self.halves:
                # ids of bytes lie below all merges, so neither side has a merge left to take back
                return True
            if left > right:
                before, left = left, self.halves[left][1]
            else:
                before, right = right + 1, self.halves[right][0]


class BytePairEncoder:
    """Encodes pre-tokens with a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        data = read_file(path)
        model, alphabet = data["model"], byte_alphabet()
        vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ranked = [vocab[a + b] for a, b in pairs]
        if ranked != sorted(ranked) or ranked and ranked[0] < 256:
            raise ValueError("ids must follow the order of merges, after the ids of single bytes")
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items() if token not in self.specials}
        self.bytes_of |= {i: s.encode() for s, i in self.specials.items()}
        merges: dict[tuple[int, int], int] = {}
        for (a, b), t in zip(pairs, ranked, strict=True):
            merges.setdefault((vocab[a], vocab[b]), t)
        self.apart = PairTest(merges)
        # a token whose own halves would not survive until its merge is never produced
        made = {t for (a, b), t in merges.items() if self.apart.apart(a, b, t)}
        produced = {self.bytes_of[i]: i for i in [*(i for t, i in vocab.items() if len(t) == 1 and i < 256), *sorted(made)]}
        self.automaton = suffix_automaton(produced)
        self.chains: dict[int, list[tuple[int, int]]] = {}

    def ending(self, state: int) -> list[tuple[int, int]]:
        """(length, id) of the tokens among the suffixes of a state's longest string, longest first."""
        found = self.chains.get(state)
        if found is None:
            found, at, a = [], state, self.automaton
            while at > 0:
                found += a.tokens.get(at, ())
                at = a.link[at]
            self.chains[state] = found
        return found

    def encode(self, word: bytes) -> list[int]:
        a, apart, ending = self.automaton, self.apart, self.ending
        first, find, targets, link, length = a.first, a.labels.find, a.targets, a.link, a.length
        last: list[int] = []
        spans: list[int] = []
        at = size = 0
        for i, c in enumerate(word, 1):
            while (edge := find(c, first[at], first[at + 1])) < 0:
                at = link[at]
                size = length[at]
            at = targets[edge]
            size += 1
            for span, token in ending(at):
                if span <= size and (span == i or apart(last[i - span - 1], token)):
                    last.append(token)
                    spans.append(span)
                    break
        out, i = [], len(word)
        while i:
            out.append(last[i - 1])
            i -= spans[i - 1]
        return out[::-1]

    def encode_words(self, words: list[str]) -> list[bytes]:
        specials = self.specials
        return [array("I", [specials[w]] if w in specials else self.encode(w.encode())).tobytes() for w in words]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@cache
def encoder(path: str) -> BytePairEncoder:
    """One per worker process."""
    return BytePairEncoder(path)


@cache
def own_tokens(path: str) -> Tokens:
    own = encoder(path)
    return Tokens(own.specials, own.encode_words, CACHED)


CACHES.append(own_tokens.cache_clear)


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``ids`` (array<int>) and ``decoded``, the text of those ids.

    The ids equal those of the tokenizers library with add_special_tokens=False; a special token's
    string in a text is that token.

    - Null or empty text: no ids, decoded ''. Whole texts, of any length.
    - Repeated rows give repeated rows; null ids pass through; empty table: empty result.
    - Other columns of ``docs`` are not carried, whatever they are called.
    """
    has(docs, id_col, text_col)
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, decode = own_tokens(vocabulary), encoder(vocabulary).decode
        for batch in batches:
            for part in pieces(batch, "text"):
                ids, at = tokens.ids(tokens.split([t or "" for t in part.column("text").to_pylist()]))
                decoded = [decode(ids[i:j].tolist()) for i, j in zip(at[:-1], at[1:], strict=True)]
                offsets = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.array(decoded, pa.string())],
                    ["id", "ids", "decoded"],
                )

    out = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)
