"""Near-duplicate documents by SetSketch registers over word shingles.

A register is the least of the hashed shingles as an exponential variable, kept as a
truncated integer on an exponential scale: sketches merge by the larger register, and
equal registers are as likely as the sets are similar. Bands of registers name buckets;
registers that are larger, smaller and equal give the Jaccard similarity of a pair by
maximum likelihood; what may reach the threshold is verified on the full sets.

Copies are one class from the start (equal sets), so a group of copies is one node. Links
are then found in three steps, of which none emits the pairs of a group:

1. In a bucket each class meets the bucket's hub, its least class.
2. Where a bucket still holds several components, an exact bound decides who can have a link
   at all. A shingle that only one component holds is that component's own: a set of n
   shingles, u of them its own, shares n - u at most with any other component, and together
   with a set of v own ones has n + v at least. Near copies that are not linked fail this
   bound by the words that they do not share. Classes that pass meet a second hub, the one
   with the fewest own shingles.
3. What is still apart and still within the bound is compared pair by pair inside tasks, in
   blocks of a bounded size. The bucket's commonest component stands in its own blocks only;
   the others, which the bound has left, meet these. Only links that join components come out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import Scratch, broadcast_if_small, col, has, spare, text_id
from chorale.llm.components import components
from chorale.llm.kernels import WordHash, chunks, find_words, mix64, release, text_buffer

SHINGLE_WORDS = 5
REGISTERS = 128
BAND_ROWS = 5
BANDS = REGISTERS // BAND_ROWS
#: The scale: registers are powers of BASE of the minima, RATE keeps those of tiny sets above 0.
BASE, RATE = 1.001, 20.0
#: A pair goes on to verification unless its estimate is so many standard deviations too low.
SIGMAS = 5.0
#: Shingles of a block in step 3; partners that a hub meets at once, about.
BLOCK = 400_000
RUN = 512
#: Pairs whose sketches are compared at once; bytes of text, and shingles held by more than OFTEN pairs, that two
#: blocks compare at once.
COMPARED = 2048
HELD_BYTES = 4 << 20
COLUMNS, OFTEN = 1 << 12, 256

_WORDS = WordHash(0xA11CE, lower_ascii=True)
_rng = np.random.Generator(np.random.PCG64(20))
_FACTORS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes one after the other, and each text's range.

    A text of fewer than ``k`` words has its whole sequence as its one shingle, without words none."""
    words = find_words(buf, offsets)
    hashed = _WORDS.words(buf, words.starts, words.ends)
    hashes = _WORDS.windows(hashed, k)
    inside = words.window_starts(k)[: len(hashes)]
    text, values = words.text_of_word()[: len(hashes)][inside], hashes[inside]
    few = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(few):
        whole = []
        for i in few.tolist():
            own = hashed[words.first[i] : words.first[i + 1]]
            whole.append(_WORDS.windows(own, len(own))[0] + np.uint64(len(own)))
        text, values = np.concatenate([text, few]), np.concatenate([values, mix64(np.array(whole, np.uint64))])
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], np.searchsorted(text[new], np.arange(len(offsets)))


def registers(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sketch of each non-empty set: uint16 of shape (sets, REGISTERS)."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), REGISTERS), np.uint16)
    for i in range(REGISTERS):
        least = np.minimum.reduceat(values * _FACTORS[i] + _SHIFTS[i], starts)
        uniform = (least.astype(np.float64) + 1.0) / 2.0**64
        exponential = np.maximum(-np.log1p(-np.minimum(uniform, 1 - 1e-16)), 1e-300) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, 65535)
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each sketch."""
    used = sketches[:, : BANDS * BAND_ROWS].reshape(len(sketches), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(BAND_ROWS):
        key = mix64(key + used[:, :, i] + np.uint64(1))
    return key


_GRID = np.linspace(0.0, 1.0, 201)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of pairs of sketches, given both sizes, by joint maximum likelihood."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = _GRID[None, :] * np.minimum(u / v, v / u)

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = chance(u - v * j), chance(v - u * j)
    tiny = 1e-12
    like = more * np.log(up + tiny) + less * np.log(down + tiny) + equal * np.log(np.maximum(1 - up - down, 0) + tiny)
    return np.take_along_axis(j, like.argmax(axis=1)[:, None], axis=1)[:, 0]


def may_reach(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Sizes allow the threshold exactly; estimates by a margin of SIGMAS."""
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    t = percent / 100
    return sizes & (estimate(a, b, n_a.astype(float), n_b.astype(float)) >= t - SIGMAS * np.sqrt(t * (1 - t) / a.shape[1]))


def sketch(docs: DataFrame) -> DataFrame:
    """Of rows (id, row, text): id, row, n_shingles, set keys k1 and k2, sketch and bands (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for i, j, buf, offsets in chunks(batch.column("text")):
                values, bounds = shingle_sets(buf, offsets)
                n = np.diff(bounds)
                some = n > 0
                keys = [np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)]
                packed: list = [None] * len(n)
                bands: list = [None] * len(n)
                if some.any():
                    starts = bounds[:-1][some]
                    for key, seed in zip(keys, (0x1234567, 0x89ABCDE), strict=True):
                        key[some] = np.add.reduceat(mix64(values + np.uint64(seed)), starts)
                    own = registers(values, bounds)
                    for at, sk, bk in zip(np.flatnonzero(some).tolist(), own, band_keys(own).view(np.int64), strict=True):
                        packed[at], bands[at] = sk.tobytes(), bk
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("row"), pa.array(n.astype(np.int64)), pa.array(keys[0].view(np.int64)),
                        pa.array(keys[1].view(np.int64)), pa.array(packed, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["id", "row", "n", "k1", "k2", "sketch", "bands"],
                )

    return docs.mapInArrow(run, "id long, row long, n long, k1 long, k2 long, sketch binary, bands array<long>")


def _registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _by_sketch(percent: int):
    """Of runs of rows (a, run, b, n, body) led by the hub's row (b null): the pairs (a, b) that may reach the threshold
    by their sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        led, led_n = np.zeros((1, REGISTERS), np.uint16), np.zeros(1, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, COMPARED):
                batch = whole.slice(at, COMPARED)
                regs = np.concatenate([led, _registers_of(batch.column("body"))])
                n = np.concatenate([led_n, batch.column("n").to_numpy()])
                is_hub = np.concatenate([[True], batch.column("b").is_null().to_numpy(zero_copy_only=False)])
                hub = np.maximum.accumulate(np.where(is_hub, np.arange(len(n)), 0))
                rows = np.flatnonzero(~is_hub)
                good = rows[may_reach(regs[hub[rows]], regs[rows], n[hub[rows]], n[rows], percent)]
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(good - 1)) for c in "ab"], ["a", "b"])
                led, led_n = regs[hub[-1]][None].copy(), n[hub[-1]][None].copy()

    return run


def _shared(hub: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of each set's sorted values the sorted ``hub`` holds."""
    if not len(hub):
        return np.zeros(len(bounds) - 1, np.int64)
    found = hub[np.minimum(np.searchsorted(hub, values), len(hub) - 1)] == values
    total = np.concatenate([[0], np.cumsum(found)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _by_text(percent: int):
    """As ``_by_sketch``, on the full sets of the texts: the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        led = np.zeros(0, np.uint64)
        for batch in batches:
            is_hub = batch.column("b").is_null().to_numpy(zero_copy_only=False)
            for i, j, buf, offsets in chunks(batch.column("body")):
                values, bounds = shingle_sets(buf, offsets)
                edges = np.flatnonzero(is_hub[i:j]).tolist()
                good = []
                for first, end in zip([-1, *edges], [*edges, j - i], strict=True):
                    if first >= 0:
                        led = values[bounds[first] : bounds[first + 1]].copy()
                    own = bounds[first + 1 : end + 1]
                    shared = _shared(led, values[own[0] : own[-1]], own - own[0])
                    union = len(led) + np.diff(own) - shared
                    good.append(first + 1 + np.flatnonzero((100 * shared >= percent * union) & (union > 0)))
                rows = pa.array(i + np.concatenate(good))
                yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in "ab"], ["a", "b"])

    return run


def _met(pairs: DataFrame, bodies: DataFrame, judge) -> DataFrame:
    """The pairs (a, b) of ``pairs`` (a, b, run) that ``judge`` lets pass; ``bodies`` has (id, n, body). A hub's body
    moves once a run, and its runs are dealt by themselves, so that no hub's partners are one task."""
    partners = pairs.join(bodies, pairs["b"] == bodies["id"]).select("a", "run", "b", "n", "body")
    hubs = pairs.select("a", "run").distinct()
    hubs = hubs.join(bodies, hubs["a"] == bodies["id"]).select("a", "run", F.lit(None).cast("long").alias("b"), "n", "body")
    rows = partners.unionByName(hubs).repartition("a", "run")
    return rows.sortWithinPartitions("a", "run", F.col("b").asc_nulls_first()).mapInArrow(judge, "a long, b long")


def _dealt(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b, run) of (a, b, size of a bucket that holds both): a hub has a run for about RUN of its partners."""
    runs = F.ceil(F.max("size") / RUN)
    return pairs.groupBy("a", "b").agg(runs.alias("runs")).select("a", "b", F.pmod(F.xxhash64("b"), "runs").alias("run"))


def _shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, rep, comp) of rows (rep, comp, text)."""
    release()
    for batch in batches:
        for i, j, buf, offsets in chunks(batch.column("text")):
            values, bounds = shingle_sets(buf, offsets)
            of = pa.array(i + np.repeat(np.arange(j - i), np.diff(bounds)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), batch.column("rep").take(of), batch.column("comp").take(of)], ["shingle", "rep", "comp"]
            )


def _own_shingles(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Of rows (rep, comp): rep and how many of its shingles no other component of ``classes`` holds, where there are any."""
    rows = classes.join(texts, classes["rep"] == texts["id"]).select("rep", "comp", "text")
    shingles = rows.mapInArrow(_shingles_of, "shingle long, rep long, comp long")
    held = shingles.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    own = held.where("low = high").select("shingle")
    return shingles.select("shingle", "rep").join(own, "shingle").groupBy("rep").agg(F.count(F.lit(1)).alias("own"))


def _several(members: DataFrame) -> DataFrame:
    """The rows (key, comp, ...) of the buckets that hold several components."""
    keys = members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    return members.join(keys, "key", "left_semi")


def _within_bound(members: DataFrame, percent: int) -> DataFrame:
    """Of rows (key, rep, comp, n, own, ...) those that can be linked with another component of their bucket."""
    least = _several(members).groupBy("key").agg(F.min("own").alias("least"))
    passed = members.join(least, "key").where(100 * (F.col("n") - F.col("own")) >= percent * (F.col("n") + F.col("least")))
    return _several(passed.drop("least"))  # the bound may have left one component


def _lifted(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) of nodes as links of their components in ``labels`` (node, component)."""
    for end in "ab":
        of = labels.select(F.col("node").alias(end), F.col("component").alias("lifted"))
        links = links.join(of, end, "left").withColumn(end, F.coalesce("lifted", end)).drop("lifted")
    return links


def _relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``comp`` replaced by its component in ``labels`` (node, component), where it has one."""
    merged = labels.select(F.col("node").alias("comp"), "component")
    return rows.join(merged, "comp", "left").withColumn("comp", F.coalesce("component", "comp")).drop("component")


def _in_blocks(rest: DataFrame) -> DataFrame:
    """Rows (key, rep, comp, n, ...) with ``slot``, ``i`` and ``j``: their block, and the pair of blocks that a task compares.
    A bucket's commonest component has blocks of its own, which meet the others' blocks but not each other."""
    counts = rest.groupBy("key", "comp").agg(F.sum("n").alias("size"))
    most = counts.groupBy("key").agg(F.max(F.struct("size", "comp")).alias("most"), F.sum("size").alias("all"))
    blocks = [F.ceil(x / BLOCK).cast("int") for x in (F.col("all") - F.col("most.size"), F.col("most.size"))]
    others, own = most.select("key", F.col("most.comp").alias("main"), blocks[0].alias("others"), blocks[1].alias("mains")), F.xxhash64("rep")
    is_main = F.col("comp") == F.col("main")
    slot = F.when(is_main, F.col("others") + F.pmod(own, F.col("mains"))).otherwise(F.pmod(own, F.col("others"))).cast("int")
    last = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    placed = rest.join(others, "key").withColumn("slot", slot).withColumn("met", F.explode(F.sequence(F.lit(0), last)))
    return placed.withColumn("i", F.least("slot", "met")).withColumn("j", F.greatest("slot", "met")).drop("main", "others", "mains", "met")


def _intersections(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``one`` (values, bounds) shares with each of ``other``."""
    out = np.zeros((len(one[1]) - 1, len(other[1]) - 1), np.float32)
    both = np.intersect1d(one[0], other[0])
    if not len(both):
        return out.astype(np.int64)
    sides = []  # the (set, place in both) of each side's shared shingles, by place
    for values, bounds in (one, other):
        place = np.minimum(np.searchsorted(both, values), len(both) - 1)
        hit = np.flatnonzero(both[place] == values)
        row, place = np.searchsorted(bounds, hit, "right") - 1, place[hit]
        order = np.argsort(place, kind="stable")
        sides.append((row[order], place[order], np.bincount(place, minlength=len(both))))
    times = sides[0][2] * sides[1][2]
    # shingles of many sets as columns of a product, the others pair by pair
    often = np.flatnonzero(times > OFTEN)
    for at in range(0, len(often), COLUMNS):
        own = often[at : at + COLUMNS]
        column = np.full(len(both), -1)
        column[own] = np.arange(len(own))
        filled = []
        for (row, place, _), n in zip(sides, out.shape, strict=True):
            side = np.zeros((n, len(own)), np.float32)
            held = column[place] >= 0
            side[row[held], column[place[held]]] = 1
            filled.append(side)
        out += filled[0] @ filled[1].T
    rare = np.flatnonzero(times <= OFTEN)
    starts = [np.cumsum(counts) - counts for _, _, counts in sides]
    total = times[rare]
    of = np.repeat(rare, total)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(total) - total, total)
    width = sides[1][2][of]
    np.add.at(out, (sides[0][0][starts[0][of] + inside // width], sides[1][0][starts[1][of] + inside % width]), 1)
    return out.astype(np.int64)


def _block_links(percent: int):
    """Links between components inside one pair of blocks of one bucket."""

    def run(table: pa.Table) -> pa.Table:
        slot = table.column("slot").to_numpy()
        n, own, comp = (table.column(c).to_numpy() for c in ("n", "own", "comp"))
        texts = table.column("text").combine_chunks()
        sides = []
        for block in (table.column(c)[0].as_py() for c in ("i", "j")):
            rows = np.flatnonzero(slot == block)
            sides.append([rows[i:j] for i, j, _, _ in chunks(texts.take(pa.array(rows)), HELD_BYTES)])
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        def sets_of(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return shingle_sets(*text_buffer(texts.take(pa.array(rows))))

        links = []
        for at, x in enumerate(sides[0]):
            first = sets_of(x)
            for y in sides[1][at:] if same else sides[1]:
                shared = _intersections(first, sets_of(y))
                good = (comp[x][:, None] != comp[y]) & (100 * shared >= percent * (n[x][:, None] + n[y] - shared))
                for i in np.flatnonzero(good.any(axis=1)).tolist():
                    for c in np.unique(comp[y][good[i]]).tolist():
                        low, high = sorted((find(int(comp[x][i])), find(c)))
                        if low != high:
                            root[high] = low
                            links.append((low, high))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: the id, ``text_row`` (see ``common.text_id``), ``n_shingles``,
    ``component_id`` and ``kept``.

    Documents are linked if 100 * shared >= ``percent`` * all of their distinct 5-word shingles, A-Z in
    lower case; component_id is the least id reachable over links, itself included. ``kept``: it is its own.

    - Ids are integers. A null id is linked with nothing; its component_id is null and it is kept.
    - Null or empty texts, and texts without words, have no shingle and are linked with nothing.
    - Rows that share an id are one document with the links of all its texts.
    - Texts of any length are read whole; a text longer than a block's shingles is compared in a block of its own.
    - Empty table: empty result. Other columns are not carried, whatever they are called.
    """
    has(docs, id_col, text_col)
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(col(text_col), F.lit(""))
    source = docs.select(col(id_col).cast("long").alias("id"), text_id(text).alias("row"), text.alias("text"))
    sketches = scratch.write(sketch(source), "sketches")
    linked = sketches.where((F.col("n") > 0) & F.col("id").isNotNull())
    first = F.min(F.struct("id", "row", "n", "sketch", "bands")).alias("first")
    classes = scratch.write(
        linked.groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("copies")).select(
            "k1", "k2", "copies", F.col("first.id").alias("rep"), F.col("first.row").alias("rep_row"), "first.n", "first.sketch", "first.bands"
        ),
        "classes",
    )
    banded = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = scratch.write(
        banded.groupBy("key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets"
    )
    members = scratch.write(banded.drop("band").join(buckets, "key"), "members")
    wanted = members.groupBy("rep").agg(F.max("size").alias("size"))
    known = scratch.write(classes.select("rep", "rep_row", "n", "sketch").join(wanted, "rep"), "known")
    small = broadcast_if_small(known.select(F.col("rep").alias("id"), F.col("rep_row").alias("row"), "n"))
    texts = scratch.write(source.join(small, ["id", "row"]).dropDuplicates(["id", "row"]).select("id", "n", "text"), "texts")
    sketched = known.select(F.col("rep").alias("id"), "n", F.col("sketch").alias("body"))

    def linked_pairs(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b, size) that are linked."""
        promising = scratch.write(_met(_dealt(pairs), sketched, _by_sketch(percent)), f"{name}-pairs")
        again = _dealt(promising.join(pairs, ["a", "b"]))
        return scratch.write(_met(again, texts.withColumnRenamed("text", "body"), _by_text(percent)), f"{name}-links")

    first = linked_pairs(members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"), "size"), "first")
    found = scratch.write(components(first, scratch, "stars"), "components")

    # a bucket's hub has met all others
    apart = _relabelled(members.where("rep <> hub").drop("hub", "size").withColumn("comp", F.col("rep")), found)
    apart = scratch.write(_several(apart).join(known.select("rep", "n"), "rep"), "apart")
    own = scratch.write(_own_shingles(apart.select("rep", "comp").distinct(), texts), "own")
    bounded = scratch.write(_within_bound(apart.join(own, "rep", "left").fillna(0, ["own"]), percent), "bounded")
    hubs = bounded.groupBy("key").agg(F.min(F.struct("own", "rep", "comp")).alias("hub"), F.count(F.lit(1)).alias("size"))
    met = bounded.join(hubs, "key")
    second = linked_pairs(met.where("comp <> hub.comp").select(F.col("hub.rep").alias("a"), F.col("rep").alias("b"), "size"), "second")
    merged = scratch.write(components(_lifted(second, found), scratch, "second-stars"), "second-components")

    rest = _relabelled(met.where("rep <> hub.rep").drop("hub", "size"), merged)
    rest = scratch.write(_within_bound(rest, percent), "rest")
    compared = _in_blocks(rest).join(texts.select(F.col("id").alias("rep"), "text"), "rep")
    third = scratch.write(compared.groupBy("key", "i", "j").applyInArrow(_block_links(percent), "a long, b long"), "third-links")
    last = scratch.write(components(third, scratch, "third-stars"), "third-components")

    labels = classes.where("copies > 1").select("rep")
    for labelled in (found, merged, last):
        labels = labels.unionByName(labelled.select(F.col("node").alias("rep")))
    labels = labels.distinct().withColumn("comp", F.col("rep"))
    for labelled in (found, merged, last):
        labels = _relabelled(labels, labelled)
    by_key = scratch.write(
        classes.select("k1", "k2", "rep").join(labels, "rep").select("k1", "k2", F.col("comp").alias("component")), "labels"
    )
    scratch.keep("sketches", "labels")
    out = sketches.select("id", "row", "n", "k1", "k2").join(by_key, ["k1", "k2"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id")))
    return out.select(
        F.col("id").alias(id_col), F.col("row").alias("text_row"), F.col("n").alias("n_shingles"),
        component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"),
    )


def keep(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates(docs)`` keeps, with the columns of ``docs``; of repeated
    rows of a kept document all stay."""
    ident, row = spare(docs, "dropped_doc", "dropped_row")
    out = found.where(~F.col("kept")).select(col(id_col).alias(ident), F.col("text_row").alias(row)).distinct()
    same = col(id_col).cast("long").eqNullSafe(F.col(ident)) & (text_id(F.coalesce(col(text_col), F.lit(""))) == F.col(row))
    return docs.join(broadcast_if_small(out), same, "left_anti")
