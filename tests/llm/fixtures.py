"""Small tables with every awkward case, and brute-force versions of the operators in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: doc_id and text of every table here; a column of a clashing name and one of another type stand beside them.
SCHEMA = "doc_id long, text string, lang string, rank int, `a.b` string"


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    out = []
    for i in range(n):
        out.append(f"w{int(words * rng.random() ** 2)}" + ("." if i % 11 == 10 else ""))
        if i % 23 == 22:
            out.append("\n")
    return " ".join(out)


def documents(seed: int = 1, copies: int = 12) -> list[tuple]:
    """Prose, exact and near copies in a group, shared passages and lines, nulls, empty and very long texts,
    repeated rows, rows that share an id, odd white space and characters."""
    rng = random.Random(seed)
    rows, at = [], 0

    def add(text, lang="en"):
        nonlocal at
        rows.append((at, text, lang, at % 3, None if at % 2 else "x"))
        at += 1

    base, passage, line = prose(rng, 220), prose(rng, 40, 9000).replace("\n", " "), "A line that many documents share, in all of its words"
    for i in range(25):
        add(prose(rng, rng.randint(30, 300)), ["en", "de", None][i % 3])
    for i in range(copies):
        add(base)
        words = base.split(" ")
        words[rng.randrange(len(words))] = f"changed{i}"
        add(" ".join(words))
    few = prose(rng, 150)
    for i in range(3):
        add(f"{few} end{i}")
    for i in range(8):
        add(f"{prose(rng, 30)}\n  {line.upper() if i % 2 else line}\t\n{prose(rng, 25)} {passage} {prose(rng, 20)}")
    for text in (None, "", " ", "\n", "\n\n", "one", "One two THREE four", "one two three four", "é ß \U0001f600 x\x1fy\x0bz\x85", "<|endoftext|> a <|endoftext|>b", "a " * 40, "&amp; <tag> &lt;"):
        add(text)
        add(text)
    add(prose(rng, 30_000))
    add("x" * 70_000)
    rows += [rows[3], rows[3], (rows[5][0], "another text under the same id", "en", 1, None), (None, base, "en", 0, None), (None, None, None, None, None)]
    return rows


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def line_dedup(rows: list[tuple], min_chars: int = 40, min_docs: int = 5) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, kept text)."""

    def key(line: str) -> str:
        return line.strip(SPACES).translate(LOWER)

    held = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                held[key(line)].add(i)
    keeper = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text: str | None, k: int = 5) -> frozenset:
    w = words((text or "").translate(LOWER))
    if len(w) < k:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def components(rows: list[tuple], percent: int) -> dict[int, int]:
    """The least id reachable from each id over links of any of its texts."""
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def removed_words(rows: list[tuple], k: int = 13) -> list[tuple]:
    """(doc_id, words, mask of the removed ones)."""
    least: dict[tuple, int] = {}
    for i, t, *_ in rows:
        w = words(t)
        for n in range(len(w) - k + 1):
            if i is not None:
                least[tuple(w[n : n + k])] = min(i, least.get(tuple(w[n : n + k]), i))
    out = []
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for n in range(len(w) - k + 1):
            if i is not None and least[tuple(w[n : n + k])] < i:
                gone[n : n + k] = [True] * k
        out.append((i, w, gone))
    return out


def base_quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t, w = text or "", words(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = [False] * len(w)
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            cover[i : i + 8] = [True] * 8
    lines = [x for x in t.split("\n") if words(x)]
    repeat = sum(cover)
    return (
        len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat,
        len(w) < 20 or 100 * repeat > 30 * len(w),
    )


def by_str(rows) -> list:
    return sorted((tuple(r) for r in rows), key=str)
