"""Exact top-k by inner product with M-trees.

Vectors become points of one Euclidean space by one more coordinate, sqrt(M^2 - |x|^2) with
the largest norm M, and 0 for a query: then the nearest points are those of the largest inner
product. Points go to the nearest of a bounded set of pivots; the points of a pivot, salted
into blocks of a bounded size, are bulk-loaded into one M-tree a block: pages of entries with
a pivot, a covering radius and the distance to the parent's pivot.

A best-first search takes pages in order of their least possible distance. The stored distances
spare the distances of entries that the triangle inequality excludes already. Each query
searches its own block first; its k-th score there, with the radii of the pivots' cells, decides
which other cells it is sent to at all, and bounds the search in their blocks.

Vectors with a component too large for exact sums of machine numbers ("wide") lie in blocks of
their own, which are scanned: bounds of the rounding error choose the rows whose products are then
computed in integers of any size.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import Scratch, broadcast_if_small, col, has

K = 20
QUERY_EVERY = 20
SCALE = 64
#: Bounds of the pivots of all lengths of vectors together, of their components, and of the sample they are taken from.
PIVOTS, PIVOT_NUMBERS, SAMPLE = 512, 1 << 20, 8192
#: Rows of a block and of a page, children of a page, and rows for each pivot.
BLOCK_ROWS, PAGE, FANOUT, CELL_ROWS = 4096, 256, 16, 2048
#: Queries that meet a block at once.
CHUNK = 2048
#: A vector with a scaled component from here on is wide.
WIDE = 1 << 26
#: Scores are integers, computed bounds are not.
SLACK = 0.01
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


@dataclass
class Page:
    """An inner page has children; a leaf has rows, from ``rows[0]`` to before ``rows[1]`` once its tree is
    ordered. ``apart`` are the entries' distances to the page's pivot."""

    pivots: np.ndarray | None
    radius: np.ndarray | None
    apart: np.ndarray
    children: list[Page] | None
    rows: np.ndarray | tuple[int, int] | None


def _distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - pivot) ** 2).sum(axis=1))


def farthest_first(points: np.ndarray, n: int) -> list[int]:
    """Positions of up to ``n`` distinct points, each the farthest from those before it."""
    chosen, nearest = [0], _distances(points, points[0])
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(points, points[chosen[-1]]))
    return chosen


def load(points: np.ndarray, rows: np.ndarray, pivot: np.ndarray) -> Page:
    """The page over ``rows`` of ``points``, and all pages below it."""
    own = points[rows]
    if len(rows) <= PAGE:
        return Page(None, None, _distances(own, pivot), None, rows)
    at = farthest_first(own, min(FANOUT, -(-len(rows) // PAGE)))
    if len(at) == 1:  # copies of one point: equal pages around it
        groups = np.array_split(np.arange(len(rows)), min(FANOUT, -(-len(rows) // PAGE)))
        centres = own[[0] * len(groups)]
    else:
        centres = own[at]
        nearest = np.stack([_distances(own, c) for c in centres]).argmin(axis=0)
        groups = [np.flatnonzero(nearest == i) for i in range(len(centres))]
    radius = np.array([_distances(own[g], c).max() for g, c in zip(groups, centres, strict=True)])
    children = [load(points, rows[g], c) for g, c in zip(groups, centres, strict=True)]
    return Page(centres, radius, _distances(centres, pivot), children, None)


def leaves(page: Page) -> Iterator[Page]:
    if page.rows is not None:
        yield page
    for child in page.children or ():
        yield from leaves(child)


class Tree:
    """The M-tree of one block of integer vectors, which are kept in the order of its leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: float):
        self.top = top
        exact = vectors.astype(np.float64)
        rest = np.sqrt(np.maximum(top - (exact**2).sum(axis=1), 0.0))
        points = np.hstack([exact, rest[:, None]])
        self.pivot = points[0]
        self.radius = float(_distances(points, self.pivot).max())
        self.root = load(points, np.arange(len(ids)), self.pivot)
        order, at = [], 0
        for leaf in leaves(self.root):
            order.append(leaf.rows)
            leaf.rows = (at, at + len(leaf.rows))
            at = leaf.rows[1]
        order = np.concatenate(order)
        self.ids, self.vectors, exact = ids[order], vectors[order], exact[order]
        # a sum of products below 2^53 is exact in a double
        small = exact.size == 0 or float(np.abs(exact).max()) ** 2 * vectors.shape[1] < 2**52
        self.exact = exact if small else self.vectors.astype(np.int64)

    def search(self, own: int, query: np.ndarray, floor: float, k: int) -> list[tuple[int, int]]:
        """(score, -id) of the k best ids but ``own``, each with the best score of its rows, of a score of ``floor`` at least."""
        q = np.append(query.astype(np.float64), 0.0)
        q_int = query.astype(self.exact.dtype)
        reach = float((q**2).sum()) + self.top
        best: list[tuple[int, int]] = []
        held: dict[int, int] = {}  # the scores in best, by id: rows that share an id take one place

        def worst() -> float:
            return max(floor, best[0][0]) if len(best) == k else floor

        def far() -> float:
            """The distance beyond which no row can count."""
            return np.sqrt(max(reach - 2 * (worst() - SLACK), 0.0)) if worst() > -np.inf else np.inf

        start = float(np.sqrt(((q - self.pivot) ** 2).sum()))
        heap = [(max(0.0, start - self.radius), 0, start, self.root)]
        serial = 0
        while heap:
            least, _, centre, page = heapq.heappop(heap)
            limit = far()
            if least > limit:
                break
            near = np.abs(centre - page.apart)
            if page.rows is not None:
                start, end = page.rows
                found = np.flatnonzero(near <= limit)
                own_rows = self.exact[start:end] if len(found) == end - start else self.exact[start + found]
                scores = own_rows @ q_int
                for i in np.flatnonzero(scores >= worst()).tolist():
                    ident = int(self.ids[start + found[i]])
                    entry = (int(scores[i]), -ident)
                    if ident == own or entry[0] < worst():
                        continue
                    if ident in held:
                        if entry[0] <= held[ident]:
                            continue
                        best.remove((held[ident], -ident))
                        best.append(entry)
                        heapq.heapify(best)
                    elif len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        del held[-heapq.heapreplace(best, entry)[1]]
                    else:
                        continue
                    held[ident] = entry[0]
                continue
            some = np.flatnonzero(near - page.radius <= limit)
            gaps = _distances(page.pivots[some], q)
            for i, gap in zip(some.tolist(), gaps.tolist(), strict=True):
                bound = max(0.0, gap - float(page.radius[i]))
                if bound <= limit:
                    serial += 1
                    heapq.heappush(heap, (bound, serial, gap, page.children[i]))
        return best


def _integers(vector: np.ndarray) -> list[int]:
    """floor(64 * x) of each component, of any size; vectors of integers are scaled already."""
    if vector.dtype.kind == "i":
        return vector.tolist()
    return [math.floor(SCALE * x) if abs(x) < 2.0**1000 else SCALE * int(x) for x in vector.tolist()]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The scaled components over one power of 2 that brings all to 1 at most; exact but for what is 2^-1000 of the largest."""
    if vectors.dtype.kind == "i":
        whole = vectors.astype(np.float64)
    else:
        small = np.abs(vectors) < 2.0**52
        whole = np.where(small, np.floor(SCALE * np.where(small, vectors, 0.0)) / SCALE, vectors)
    top = float(np.abs(whole).max(initial=0.0))
    return np.ldexp(whole, -math.frexp(top)[1]) if top else whole


def scan(ids: np.ndarray, vectors: np.ndarray, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(score, -id) of the k best ids but ``own``, exact for components of any size."""
    rows = np.flatnonzero(ids != own)
    if not len(rows):
        return []
    body, q = _scaled(vectors)[rows], _scaled(query[None])[0]
    near = body @ q
    error = (np.abs(body) @ np.abs(q)) * (len(q) + 2) * 2.0**-51 + len(q) * 2.0**-900
    kinds, of = np.unique(ids[rows], return_inverse=True)
    least = np.full(len(kinds), -np.inf)
    np.maximum.at(least, of, near - error)
    floor = np.partition(least, -k)[-k] if len(kinds) > k else -np.inf
    q_int = _integers(query)
    best: dict[int, int] = {}
    for i in rows[near + error >= floor].tolist():
        score = sum(x * y for x, y in zip(_integers(vectors[i]), q_int, strict=True))
        ident = int(ids[i])
        best[ident] = max(score, best.get(ident, score))
    return sorted(((score, -ident) for ident, score in best.items()), reverse=True)[:k]


@dataclass
class Flat:
    """A block of wide vectors."""

    ids: np.ndarray
    vectors: np.ndarray

    def search(self, own: int, query: np.ndarray, floor: float, k: int) -> list[tuple[int, int]]:
        return scan(self.ids, self.vectors, own, query, k)


def ordered(score: int) -> bytes:
    """For scores outside of a long: bytes in the order of the scores. Empty for all others."""
    if LEAST_LONG < score <= MOST_LONG:
        return b""
    size = (abs(score).bit_length() + 7) // 8
    body = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return body if score > 0 else bytes(255 - x for x in body)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int, kind) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), dim).astype(kind)


def _lifted(v: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(top - (v**2).sum(axis=1), 0.0))[:, None]])


@dataclass
class Cells:
    """The pivots of one length of vectors, the largest squared norm, and once known each cell's radius."""

    pivots: np.ndarray
    top: float
    radius: np.ndarray | None = None

    def wanted(self, query: np.ndarray, floor: float) -> np.ndarray:
        """The cells that may hold a row of a score of ``floor`` at least."""
        q = np.append(query.astype(np.float64), 0.0)
        least = np.maximum(_distances(self.pivots, q) * (1 - 1e-9) - self.radius * (1 + 1e-9) - 1e-6, 0.0)
        reach = float((q**2).sum()) + self.top
        return np.flatnonzero((self.radius >= 0) & ((reach * (1 + 1e-9) - least**2) / 2 + SLACK >= floor))


def _assign(cells: dict[int, Cells]):
    """Adds the nearest pivot's number and distance to vectors that have pivots; 0 to all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, wide = batch.column("dim").to_numpy(), batch.column("wide").to_numpy(zero_copy_only=False)
            cell, gap = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for d in np.unique(dims[~wide]).tolist():
                if d in cells:
                    of = np.flatnonzero((dims == d) & ~wide)
                    v = _lifted(_matrix(batch.column("v").take(pa.array(of)), d, np.float64), cells[d].top)
                    # |v|^2 is the same for all pivots of a row
                    near = ((cells[d].pivots ** 2).sum(axis=1) - 2 * v @ cells[d].pivots.T).argmin(axis=1)
                    cell[of], gap[of] = near, np.sqrt(((v - cells[d].pivots[near]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(gap)], [*batch.schema.names, "cell", "gap"])

    return run


QUERY = "id long, dim int, wide boolean, v array<int>, w array<double>, floor double"
BLOCK = "dim int, wide boolean, cell int, salt long"


def _build(every: int, k: int):
    """A block's tree, and its queries with their k-th score inside the block (-inf: fewer rows, or wide)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending")])
        dim, wide = table.column("dim")[0].as_py(), table.column("wide")[0].as_py()
        ids = table.column("vec_id").to_numpy()
        vectors = _matrix(table.column("w" if wide else "v"), dim, np.float64 if wide else np.int32)
        tree = Flat(ids, vectors) if wide else Tree(ids, vectors, float(table.column("top")[0].as_py()))
        rows = []
        for i in np.flatnonzero(tree.ids % every == 0).tolist():
            own, vector = int(tree.ids[i]), tree.vectors[i]
            found = [] if wide else tree.search(own, vector, -np.inf, k)
            floor = float(np.nextafter(float(min(found)[0]), -np.inf)) if len(found) == k else -np.inf
            rows.append({"id": own, "dim": dim, "wide": wide, "v": None if wide else vector.tolist(), "w": vector.tolist() if wide else None, "floor": floor})
        kinds = [("id", pa.int64()), ("dim", pa.int32()), ("wide", pa.bool_()), ("v", pa.list_(pa.int32())), ("w", pa.list_(pa.float64())), ("floor", pa.float64())]
        names = ["dim", "wide", "cell", "salt"]
        return pa.table(
            {c: table.column(c).slice(0, 1) for c in names}
            | {"tree": pa.array([pickle.dumps(tree)], pa.binary()), "queries": pa.array([rows], pa.list_(pa.struct(kinds)))}
        )

    return run


def _send(cells: dict[int, Cells]):
    """Of queries: the cells of vectors that are not wide to which each must go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cell = [], []
            columns = [batch.column(c).to_pylist() for c in ("dim", "wide", "v", "floor")]
            for i, (dim, wide, v, floor) in enumerate(zip(*columns, strict=True)):
                if dim in cells:
                    own = np.flatnonzero(cells[dim].radius >= 0) if wide else cells[dim].wanted(np.array(v), floor)
                    cell += own.tolist()
                    row += [i] * len(own)
                else:
                    cell.append(0)
                    row.append(i)
            out = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cell, pa.int32())], [*out.schema.names, "cell"])

    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                tree = pickle.loads(batch.column("tree")[n].as_py())
                out: list[tuple[int, int, int]] = []
                for q in batch.column("asked")[n].as_py():
                    if q["wide"]:
                        found = scan(tree.ids, tree.vectors, q["id"], np.array(q["w"], np.float64), k)
                    else:
                        found = tree.search(q["id"], np.array(q["v"], np.int32), q["floor"], k)
                    out += [(q["id"], -minus, score) for score, minus in found]
                if out:
                    query, ident, score = zip(*out, strict=True)
                    held = [min(max(s, LEAST_LONG), MOST_LONG) for s in score]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query, pa.int64()), pa.array(ident, pa.int64()), pa.array(held, pa.int64()), pa.array(map(ordered, score), pa.binary())],
                        ["query_id", "vec_id", "score", "beyond"],
                    )

    return run


def _vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, dim, wide, and the scaled components ``v`` or, of wide vectors, the components ``w``. Equal rows are one."""
    x = F.transform(col(vector_col), lambda x: x.cast("double"))
    read = vectors.select(col(id_col).cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null")
    sound = read.where(~F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    wide = F.exists("x", lambda x: F.abs(x) >= WIDE / SCALE)
    scaled = F.when(~F.col("wide"), F.transform("x", lambda x: F.floor(F.when(F.abs(x) < WIDE / SCALE, SCALE * x)).cast("int")))
    return (
        sound.withColumn("wide", wide)
        .select("vec_id", F.size("x").alias("dim"), "wide", scaled.alias("v"), F.when(F.col("wide"), F.col("x")).alias("w"))
        .distinct()
    )


def _pivots(rows: DataFrame, lengths: DataFrame) -> dict[int, Cells]:
    """Pivots of the lengths with most vectors, PIVOTS in all at most, from SAMPLE rows."""
    large = lengths.where(~F.col("wide") & (F.col("n") > CELL_ROWS) & (F.col("dim") > 0)).orderBy(F.desc("n"), "dim").limit(PIVOTS // 2).collect()
    total = sum(r["n"] for r in large)
    if not large:
        return {}
    parts = 1 << 30
    shares = [(r["dim"], min(parts, parts * SAMPLE // total + 1)) for r in large]
    chosen = rows.where(~F.col("wide")).join(F.broadcast(rows.sparkSession.createDataFrame(shares, "dim int, below long")), "dim")
    sample: dict[int, list] = {}
    for r in chosen.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)) < F.col("below")).select("dim", "v").limit(2 * SAMPLE).collect():
        sample.setdefault(r["dim"], []).append(r["v"])
    out = {}
    for r in large:
        dim, top = r["dim"], float(r["top"])
        wanted = min(r["n"] // CELL_ROWS, PIVOTS * r["n"] // total, PIVOT_NUMBERS // (dim + 1))
        if wanted > 1 and len(sample.get(dim, ())) > 1:
            v = _lifted(np.array(sorted(sample[dim]), np.float64), top)
            out[dim] = Cells(v[farthest_first(v, wanted)], top)
    return out


def top_k(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = QUERY_EVERY
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each row whose id is divisible by ``every``, the ``k``
    other rows of the largest integer inner product of floor(64 * x), ties to the smaller id; all if there are fewer.

    - Null ids, and vectors that are null or hold a null or non-finite component, take no part.
    - Components of any size are exact; a score that leaves the range of a long is given as the nearest long, and
      still ranked by its true value.
    - Only vectors of one length meet. Vectors of length 0 score 0 with each other.
    - Rows that share an id count as one row, with the best of their scores; none is its own neighbour.
    - Empty table: empty result. Other columns are not carried, whatever they are called.
    """
    has(vectors, id_col, vector_col)
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.write(_vectors(vectors, id_col, vector_col), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    lengths = scratch.write(rows.groupBy("dim", "wide").agg(F.max(norm).alias("top"), F.count(F.lit(1)).alias("n")), "lengths")
    cells = _pivots(rows, lengths)
    schema = "vec_id long, dim int, wide boolean, v array<int>, w array<double>, cell int, gap double"
    assigned = scratch.write(rows.select("vec_id", "dim", "wide", "v", "w").mapInArrow(_assign(cells), schema), "assigned")
    salts = F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("salts")
    places = scratch.write(assigned.groupBy("dim", "wide", "cell").agg(salts, F.max("gap").alias("radius")), "places")
    for dim, own in cells.items():
        own.radius = np.full(len(own.pivots), -1.0)
    known = places.where(~F.col("wide") & F.col("dim").isin(list(cells)))  # PIVOTS rows at most
    for r in known.select("dim", "cell", "radius").collect():
        cells[r["dim"]].radius[r["cell"]] = r["radius"]
    small = broadcast_if_small(places.select("dim", "wide", "cell", "salts"))
    tops = broadcast_if_small(lengths.select("dim", "wide", "top"))
    blocks = scratch.write(
        assigned.drop("gap")
        .join(small, ["dim", "wide", "cell"])
        .join(tops, ["dim", "wide"])
        .withColumn("salt", F.pmod(F.xxhash64("vec_id", "v", "w"), F.col("salts")))
        .groupBy("dim", "wide", "cell", "salt")
        .applyInArrow(_build(every, k), f"{BLOCK}, tree binary, queries array<struct<{QUERY.replace(' ', ':').replace(',:', ',')}>>"),
        "blocks",
    )
    scratch.drop("assigned")
    asked = scratch.write(blocks.select(F.explode("queries").alias("q")).select("q.*"), "queries")
    chunks = max(1, -(-asked.count() // CHUNK))
    sent = asked.mapInArrow(_send(cells), f"{QUERY}, cell int").withColumn("to_wide", F.lit(False))
    # every query also goes to the wide vectors of its length, where there are any
    sent = sent.unionByName(asked.withColumn("cell", F.lit(0)).withColumn("to_wide", F.lit(True)))
    sent = sent.join(small.select("dim", F.col("wide").alias("to_wide"), "cell"), ["dim", "to_wide", "cell"], "left_semi")
    question = F.struct("id", "wide", "v", "w", "floor")
    grouped = sent.groupBy("dim", "to_wide", "cell", F.pmod(F.xxhash64("id", "v", "w"), F.lit(chunks)).alias("chunk")).agg(F.collect_list(question).alias("asked"))
    grouped = grouped.withColumnRenamed("to_wide", "wide").join(small, ["dim", "wide", "cell"])
    pairs = grouped.select("dim", "wide", "cell", "asked", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    found = blocks.drop("queries").join(pairs.hint("shuffle_hash"), ["dim", "wide", "cell", "salt"]).select("tree", "asked")
    scored = found.mapInArrow(_search(k), "query_id long, vec_id long, score long, beyond binary")
    best = scored.groupBy("query_id", "vec_id").agg(F.max(F.struct("score", "beyond")).alias("best"))
    order = Window.partitionBy("query_id").orderBy(F.desc("best"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    scratch.keep("blocks", "places", "queries")
    return ranked.select("query_id", "rank", "vec_id", F.col("best.score").alias("score"))
