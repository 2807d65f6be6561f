"""Substring dedup: words inside 13-word windows that a document of a smaller id holds too are removed.

Pass 1 sketches the windows of each group of texts: a count-min row, kept sparse as its touched
cells with counts capped at 2. Merged by cell range, the row overestimates the documents of every
window, and each group gets back one bit for each cell it touched. Pass 2 sends on only windows
whose cell may hold two documents, 80-bit hashes with the least id in the group, and groups them
exactly; each group gets back the least id of each. Nothing repeated is lost: a cell's count is
never below that of its windows.

One wide row of ``CELLS`` cells a window takes fewer bits here than several narrow ones of the same
error, because a sparse row costs log2 of the gaps between its cells. Its width follows the input,
its ranges are merged by different tasks, and no table is collected or broadcast.

Texts are written once, as compressed groups of about ``GROUP_BYTES`` (more for very large inputs, see
``sizes``); a group is a row, and all later passes work on whole groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chorale.llm.common import Scratch, col, has
from chorale.llm.kernels import WordHash, chunks, find_words, mix64, release

WINDOW = 13
GROUP_BYTES = 6 << 20
CELLS = 64
#: Windows that one task merges, about; bytes of text per window, to size the row before it is built.
RANGE_WINDOWS = 1 << 20
WINDOW_BYTES = 6
LEAST_RANGES = 32
#: A group sends a row to each range. So that rows grow with the windows and not with their square, each row has
#: so many windows at least: beyond (GROUP_BYTES / WINDOW_BYTES) * RANGE_WINDOWS / ROW_WINDOWS windows (about 100 GB)
#: groups and ranges both grow with the root of the input.
ROW_WINDOWS = 64
FLAGS = -1

_HASH = WordHash(0xB16B00)
_SECOND = WordHash(0x0DDBA11)


def pack(values: np.ndarray) -> bytes:
    """Compressed, the bytes of equal weight together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(data, dtype), dtype=dtype)


def sizes(total_bytes: int) -> tuple[int, int, int]:
    """Bytes of a group, bits of a cell's number and of its range's, from the bytes of all texts."""
    windows = max(1, total_bytes // WINDOW_BYTES)
    grown = max(1.0, math.sqrt(ROW_WINDOWS * windows / (GROUP_BYTES / WINDOW_BYTES * RANGE_WINDOWS)))
    parts = max(LEAST_RANGES, -(-windows // int(RANGE_WINDOWS * grown)))
    range_bits = (parts - 1).bit_length()
    cell_bits = min(max((CELLS * windows - 1).bit_length(), range_bits + 8), range_bits + 32)
    return int(GROUP_BYTES * grown), cell_bits, range_bits


def make_groups(group_bytes: int):
    """Runs of rows as one row each: number, ids, offsets and compressed text, and the other columns as Arrow data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from _grouped(batches, group_bytes)

    return run


def _grouped(batches: Iterator[pa.RecordBatch], group_bytes: int) -> Iterator[pa.RecordBatch]:
    at = TaskContext.get().partitionId() << 32
    held: list[tuple[pa.RecordBatch, bytes, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal at, held, size
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([lens for _, _, lens in held]))]).astype(np.int64)
        rest = pa.Table.from_batches([part.drop_columns(["text"]) for part, _, _ in held])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(rest)
        out = pa.RecordBatch.from_pydict(
            {
                "grp": pa.array([at], pa.int64()),
                "ids": pa.array([rest.column("id").to_pylist()], pa.list_(pa.int64())),
                "offsets": pa.array([pack(offsets)], pa.binary()),
                "body": pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join([b for _, b, _ in held]))], pa.binary()),
                "rest": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            }
        )
        at, held, size = at + 1, [], 0
        return out

    for batch in batches:
        for i, j, buf, offsets in chunks(batch.column("text")):
            if size and size + len(buf) > group_bytes:
                yield flush()
            held.append((batch.slice(i, j - i), buf.tobytes(), np.diff(offsets)))
            size += len(buf)
    if held:
        yield flush()


GROUPS = "grp long, ids array<long>, offsets binary, body binary, rest binary"


class Group:
    """A group's texts, their words and windows. ``h1``, ``text`` and ``start`` are those of the windows
    in texts with an id, in order: hash, text number and number of the first word in the group."""

    def __init__(self, row: dict):
        body = zstandard.ZstdDecompressor().decompress(row["body"])
        self.buf = np.frombuffer(body, np.uint8)
        self.offsets = unpack(row["offsets"], np.int64)
        self.ids = row["ids"]
        column = pa.Array.from_buffers(pa.large_string(), len(self.ids), [None, pa.py_buffer(self.offsets), pa.py_buffer(body)])
        parts, hashes, text, start, counts, done = [], [], [], [], [], 0
        known = np.array([i is not None for i in self.ids], bool)
        for i, j, buf, offsets in chunks(column):
            words = find_words(buf, offsets)
            hashed = _HASH.words(buf, words.starts, words.ends)
            windows = _HASH.windows(hashed, WINDOW)
            of = words.text_of_word()[: len(windows)] + i
            at = np.flatnonzero(words.window_starts(WINDOW)[: len(windows)] & known[of])
            parts.append(hashed)
            hashes.append(windows[at])
            text.append(of[at])
            start.append(at + done)
            counts.append(words.counts)
            done += len(hashed)
        none = [np.zeros(0, np.int64)]
        self.words = np.concatenate(parts or [np.zeros(0, np.uint64)])
        self.h1 = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        self.text, self.start = np.concatenate(text or none), np.concatenate(start or none)
        self.counts = np.concatenate(counts or none)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.id_of = np.array([0 if i is None else i for i in self.ids], np.int64)

    def second(self, at: np.ndarray) -> np.ndarray:
        """16 more bits of the hash of the windows ``at``."""
        out, factor = np.zeros(len(at), np.uint64), 1
        for k in range(WINDOW):
            out += mix64(self.words[self.start[at] + k]) * np.uint64(factor)
            factor = factor * _SECOND.step % (1 << 64)
        return (mix64(out) >> np.uint64(48)).astype(np.uint16)


def _cells(group: Group, cell_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells that the group touches, in order, and whether two of its texts may share a window there."""
    order = np.lexsort((group.text, group.h1))
    h, t = group.h1[order], group.text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    cells, counts = np.unique(h[new] >> np.uint64(64 - cell_bits), return_counts=True)
    return cells, counts > 1


def _split(values: np.ndarray, shift: int) -> Iterator[tuple[int, int, int]]:
    """Runs of sorted values with the same bits above ``shift``: those bits, from, to."""
    part = (values >> np.uint64(shift)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(part)], strict=True):
        yield int(part[i]), i, j


def _groups_of(batch) -> Iterator[dict]:
    for n in range(batch.num_rows):
        yield {c: batch.column(c)[n].as_py() for c in batch.schema.names}


def sketch(cell_bits: int, range_bits: int):
    inside = cell_bits - range_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for row in _groups_of(batch):
                cells, twice = _cells(Group(row), cell_bits)
                out = [
                    (row["grp"], part, pack_sorted((cells[i:j] & np.uint64((1 << inside) - 1)).astype(np.uint32)), np.packbits(twice[i:j]).tobytes())
                    for part, i, j in _split(cells, inside)
                ]
                if out:
                    g, p, c, t = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g, pa.int64()), pa.array(p, pa.int32()), pa.array(c, pa.binary()), pa.array(t, pa.binary())],
                        ["grp", "part", "cells", "twice"],
                    )

    return run


def merge(table: pa.Table) -> pa.Table:
    """Of one range of cells: for each group, one bit for each cell it sent, set where the merged count is 2 or more."""
    cells = [unpack_sorted(c, np.uint32) for c in table.column("cells").to_pylist()]
    counts = [1 + np.unpackbits(np.frombuffer(t, np.uint8), count=len(c)) for t, c in zip(table.column("twice").to_pylist(), cells, strict=True)]
    flat = np.concatenate(cells)
    kinds, of = np.unique(flat, return_inverse=True)
    many = (np.bincount(of, weights=np.concatenate(counts), minlength=len(kinds)) >= 2)[of]
    ends = np.cumsum([len(c) for c in cells])
    masks = [np.packbits(m).tobytes() for m in np.split(many, ends[:-1])]
    return pa.table({"grp": table.column("grp"), "part": table.column("part"), "payload": pa.array(masks, pa.binary())})


def _payloads(table: pa.Table) -> list[tuple[int, bytes]]:
    return sorted(zip(table.column("part").to_pylist(), table.column("payload").to_pylist(), strict=True))


def _flagged(group: Group, flags: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The flagged windows, the distinct (h1, h2) pairs among them as places in the former, and each one's pair."""
    at = np.flatnonzero(np.unpackbits(np.frombuffer(flags, np.uint8), count=len(group.h1)))
    h1, h2 = group.h1[at], group.second(at)
    order = np.lexsort((h2, h1))
    new = np.ones(len(at), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    pair = np.empty(len(at), np.int64)
    pair[order] = np.cumsum(new) - 1
    return at, order[new], pair


def candidates(cell_bits: int, range_bits: int):
    """Of a group and its masks: its flagged windows as bits (part FLAGS), and their entries by range."""
    inside = cell_bits - range_bits

    def run(groups: pa.Table, masks: pa.Table) -> pa.Table:
        out: list[tuple[int, int, bytes, bytes, bytes]] = []
        for row in _groups_of(groups):
            group = Group(row)
            cells, _ = _cells(group, cell_bits)
            found = dict(_payloads(masks))
            many = np.zeros(len(cells), bool)
            for part, i, j in _split(cells, inside):
                many[i:j] = np.unpackbits(np.frombuffer(found[part], np.uint8), count=j - i)
            flagged = many[np.searchsorted(cells, group.h1 >> np.uint64(64 - cell_bits))] if len(cells) else np.zeros(0, bool)
            flags = np.packbits(flagged).tobytes()
            out.append((row["grp"], FLAGS, flags, b"", b""))
            at, pairs, pair = _flagged(group, flags)
            least = np.full(len(pairs), np.iinfo(np.int64).max)
            np.minimum.at(least, pair, group.id_of[group.text[at]])
            h1, h2 = group.h1[at][pairs], group.second(at[pairs])
            out += [
                (row["grp"], part, pack_sorted(h1[i:j]), pack(h2[i:j]), pack(least[i:j])) for part, i, j in _split(h1, 64 - range_bits)
            ]
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["grp", "part", "payload", "second", "least"])

    return run


def exact(table: pa.Table) -> pa.Table:
    """Of one range of hashes: for each group the least id of each of its entries over all groups."""
    h1 = [unpack_sorted(x, np.uint64) for x in table.column("payload").to_pylist()]
    h2 = [unpack(x, np.uint16) for x in table.column("second").to_pylist()]
    least = np.concatenate([unpack(x, np.int64) for x in table.column("least").to_pylist()])
    ends = np.cumsum([len(x) for x in h1])
    first, second = np.concatenate(h1), np.concatenate(h2)
    order = np.lexsort((least, second, first))
    f, s = first[order], second[order]
    new = np.ones(len(f), bool)
    new[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
    best = np.empty(len(f), np.int64)
    best[order] = least[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    answers = [pack(x) for x in np.split(best, ends[:-1])]
    return pa.table({"grp": table.column("grp"), "part": table.column("part"), "payload": pa.array(answers, pa.binary())})


def _kept_text(body: bytes, starts: np.ndarray, removed: np.ndarray, joined: bool) -> bytes:
    if joined:
        return b" ".join(compress(body.split(), (~removed).tolist()))
    edge = np.flatnonzero(np.diff(removed.astype(np.int8), prepend=0, append=0))
    bounds = np.append(starts, len(body))
    out, at = [], 0
    for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        out.append(body[at : bounds[i]])
        at = int(bounds[j])
    return b"".join([*out, body[at:]])


def apply_answers(joined: bool, fields: StructType):
    """Of a group, its flags and answers: a row per text."""

    def run(groups: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        for row in _groups_of(groups):
            group = Group(row)
            got = _payloads(answers)
            at, pairs, pair = _flagged(group, got[0][1])
            least = np.concatenate([unpack(x, np.int64) for _, x in got[1:]]) if len(got) > 1 else np.zeros(0, np.int64)
            hit = at[least[pair] < group.id_of[group.text[at]]] if len(at) else at
            cover = np.zeros(len(group.words) + 1, np.int64)
            np.add.at(cover, group.start[hit], 1)
            np.add.at(cover, group.start[hit] + WINDOW, -1)
            removed = np.cumsum(cover[:-1]) > 0
            body = group.buf.tobytes()
            n_removed, kept = [], []
            for i in range(len(group.ids)):
                text = body[group.offsets[i] : group.offsets[i + 1]]
                gone = removed[group.first[i] : group.first[i + 1]]
                n = int(gone.sum())
                if n or joined:
                    starts = find_words(np.frombuffer(text, np.uint8), np.array([0, len(text)])).starts if n and not joined else gone
                    text = _kept_text(text, starts, gone, joined)
                n_removed.append(n)
                kept.append(text.decode())
            rest = pa.ipc.open_stream(row["rest"]).read_all().drop_columns(["id"])
            for name, values, kind in (("n_words", group.counts, pa.int64()), ("n_removed", n_removed, pa.int64()), ("kept_text", kept, pa.string())):
                rest = rest.append_column(name, pa.array(values, kind))
            out.append(rest)
        return pa.concat_tables(out) if out else _empty(fields)

    return run


def _empty(fields: StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields).empty_table()


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", joined: bool = False) -> DataFrame:
    """``docs`` with its columns but the text, and three more, which replace columns of those names:
    ``n_words``, ``n_removed`` and ``kept_text``, the text without the removed words and the white space
    after them, or with ``joined`` its kept words joined by one space.

    A word goes if a window of 13 consecutive words covers it whose words also follow each other in a
    document of a smaller id. Windows are judged on the input, not on what is left.

    - Ids are integers. Texts of a null id lose nothing and make others lose nothing.
    - Null or empty text, or fewer than 13 words: nothing is removed; null gives ''.
    - Rows that share an id are no smaller document for each other. Empty table: empty result.
    - A text of any length is read whole; one longer than a group's bytes is a group of its own.
    - Other columns pass through, whatever they are called.
    """
    has(docs, id_col, text_col)
    scratch = Scratch(docs.sparkSession)
    new = ("n_words", "n_removed", "kept_text")
    carried = [(f"c{i}", f) for i, f in enumerate(docs.schema.fields) if f.name != text_col and f.name.lower() not in new]
    source = docs.select(
        *(col(f.name).alias(c) for c, f in carried),
        col(id_col).cast("long").alias("id"),
        F.coalesce(col(text_col), F.lit("")).alias("text"),
    )
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    group_bytes, cell_bits, range_bits = sizes(total)
    groups = scratch.write(source.mapInArrow(make_groups(group_bytes), GROUPS), "groups")
    sketched = groups.mapInArrow(sketch(cell_bits, range_bits), "grp long, part int, cells binary, twice binary")
    masks = sketched.groupBy("part").applyInArrow(merge, "grp long, part int, payload binary")
    rows = "grp long, part int, payload binary, second binary, least binary"
    found = scratch.write(
        groups.groupBy("grp").cogroup(masks.groupBy("grp")).applyInArrow(candidates(cell_bits, range_bits), rows), "candidates"
    )
    least = found.where(F.col("part") != FLAGS).groupBy("part").applyInArrow(exact, "grp long, part int, payload binary")
    flags = found.where(F.col("part") == FLAGS).select("grp", "part", "payload")
    fields = StructType(
        [StructField(c, f.dataType) for c, f in carried]
        + [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())]
    )
    out = groups.groupBy("grp").cogroup(flags.unionByName(least).groupBy("grp")).applyInArrow(apply_answers(joined, fields), fields)
    return out.select(*(F.col(c).alias(f.name) for c, f in carried), "n_words", "n_removed", "kept_text")
