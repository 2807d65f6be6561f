"""Best-fit packing of token sequences.

Tokens are counted where the texts are read; only rows of about 60 bytes a piece leave
that scan. Each partition packs its pieces as they come with bounded-space online
best-fit. Bins still open at a partition's end are taken apart and packed again, longest
pieces first, in rounds, each over the leftovers of ``FAN_IN`` packers, until one packer is
left. A packer hands at most ``OPEN_BINS`` bins on, the emptiest, so a round's input is bounded.

The rounds depart from the method in one thing: all their bins may stay open, FAN_IN * OPEN_BINS
at most, which is as many as they took apart. Their pieces are known, so they come longest first,
and closing the fullest bins before the short pieces come would waste what these fill.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import Scratch, col, has
from chorale.llm.kernels import pieces, trim
from chorale.llm.pretokens import library_tokens

CAPACITY = 1024
END_OF_TEXT = 2
OPEN_BINS = 1024
FAN_IN = 16


class BestFit:
    """Bounded-space online best-fit.

    ``free`` is a bitset: bit f is set while an open bin has f tokens free. The tightest bin for
    n tokens is the lowest set bit from n on. With more than ``limit`` bins open, the fullest closes.
    """

    def __init__(self, capacity: int, limit: int, numbers: Iterator[int]):
        self.capacity, self.limit, self.numbers = capacity, limit, numbers
        self.free = 0
        self.bins: dict[int, list[int]] = {}
        self.count = 0

    def add(self, n: int) -> tuple[int, int]:
        """The bin and the place in it for a piece of ``n`` tokens."""
        fitting = self.free >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            own = self._take(room)
        else:
            room, own = self.capacity, next(self.numbers)
        if room > n:
            self.bins.setdefault(room - n, []).append(own)
            self.free |= 1 << (room - n)
            self.count += 1
            if self.count > self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
        return own, self.capacity - room

    def _take(self, room: int) -> int:
        same = self.bins[room]
        own = same.pop()
        if not same:
            del self.bins[room]
            self.free &= ~(1 << room)
        self.count -= 1
        return own

    def open(self) -> list[int]:
        """The open bins, the emptiest first."""
        return [b for room in sorted(self.bins, reverse=True) for b in self.bins[room]]


def _numbers(round_: int, group: int) -> Iterator[int]:
    """Numbers that no other round or group gives."""
    at = round_ << 56 | group << 30
    while True:
        yield at
        at += 1


_END = np.array([END_OF_TEXT], "<u4").tobytes()


def _cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first, which takes the rest."""
    head = n % capacity or min(n, capacity)
    return [(0, head), *((at, capacity) for at in range(head, n, capacity))]


def tokenize_and_pack(docs: DataFrame, vocabulary: str, capacity: int, open_bins: int, with_ids: bool) -> DataFrame:
    """The pieces of every text with the bins of the first round; ``packer`` is -1 where the bin has closed."""
    kind = docs.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, packer long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = library_tokens(vocabulary)
        part = TaskContext.get().partitionId()
        packer = BestFit(capacity, open_bins, _numbers(0, part))
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for chunk in pieces(batch, "text"):
                flat, offsets = tokens.ids(tokens.split([t or "" for t in chunk.column("text").to_pylist()]))
                ids = flat.astype("<u4").tobytes()
                row, at, first, length, crc, bin_, place, own = [], [], [], [], [], [], [], []
                for i, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    own_ids = ids[4 * low : 4 * high] + _END
                    for k, (start, n) in enumerate(_cut(high - low + 1, capacity)):
                        body = own_ids[4 * start : 4 * (start + n)]
                        b, p = packer.add(n)
                        row.append(i)
                        at.append(k)
                        first.append(start)
                        length.append(n)
                        crc.append(zlib.crc32(body))
                        bin_.append(b)
                        place.append(p)
                        if with_ids:
                            own.append(np.frombuffer(body, "<u4").astype(np.int32))
                arrays = [
                    chunk.column("doc").take(pa.array(row, pa.int32())), pa.array(at, pa.int32()), pa.array(first, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(bin_, pa.int64()), pa.array(place, pa.int64()),
                ]
                if with_ids:
                    arrays.append(pa.array(own, pa.list_(pa.int32())))
                held.append(pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))]))
        still = pa.array(packer.open(), pa.int64())
        for rows in held:
            is_open = pa.compute.is_in(rows.column(5), value_set=still)
            where = pa.compute.if_else(is_open, pa.scalar(part, pa.int64()), pa.scalar(-1, pa.int64()))
            columns = [*rows.columns[:7], where, *rows.columns[7:]]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])
        trim()

    return docs.mapInArrow(run, schema)


def _repack(round_: int, last: bool, capacity: int, open_bins: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["packer"].iloc[0]) // FAN_IN
        # no more bins than the round took apart can be open here, so the longest pieces may come first
        packer = BestFit(capacity, FAN_IN * open_bins, _numbers(round_, group))
        rows = rows.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True], kind="stable")
        placed = [packer.add(int(n)) for n in rows["length"]]
        still = set() if last else set(packer.open()[:open_bins])
        return rows.assign(
            sequence_id=[b for b, _ in placed], offset=[p for _, p in placed], packer=[group if b in still else -1 for b, _ in placed]
        )

    return run


def best_fit_packing(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, open_bins: int = OPEN_BINS, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32, sequence_id, offset and, with ``with_ids``, ids.

    A document is its ids by the tokenizers library and an end token. Only documents longer than
    ``capacity`` are cut, into full pieces after a first one that takes the remainder. Pieces of a
    sequence stand next to each other from offset 0 and no sequence exceeds ``capacity``.

    - Null or empty text: the end token alone. Repeated rows and null ids are documents of their own.
    - Texts of any length are read whole. Empty table: empty result. Other columns of ``docs`` are not carried, whatever
      they are called.
    """
    has(docs, id_col, text_col)
    scratch = Scratch(docs.sparkSession)
    source = docs.select(col(id_col).alias("doc"), col(text_col).alias("text"))
    rows = scratch.write(tokenize_and_pack(source, vocabulary, capacity, open_bins, with_ids), "round-0")
    done, packers, round_ = [rows.where("packer < 0")], rows.agg(F.max("packer")).first()[0], 0
    while packers is not None and packers >= 0:
        round_ += 1
        packers //= FAN_IN
        regrouped = rows.where("packer >= 0").groupBy(F.floor(F.col("packer") / FAN_IN).alias("group"))
        rows = scratch.write(regrouped.applyInPandas(_repack(round_, packers == 0, capacity, open_bins), rows.schema), f"round-{round_}")
        done.append(rows.where("packer < 0"))
        packers = packers if packers else -1
    return reduce(DataFrame.unionByName, done).drop("packer").withColumnRenamed("doc", id_col)
