"""Near copies among vectors: all pairs of at least a given cosine, by PCA-ordered tiled comparison.

Equal vectors are one class. Unit vectors are taken relative to their mean ``m`` and turned
to principal axes, the widest first. For two unit vectors, ``cos - 1 = <x, y> - |x|^2/2 -
|y|^2/2`` with ``x, y`` the turned ones, and after the leading dimensions the rest of
``<x, y>`` is at most the product of the norms of the two suffixes. So the product of a tile
by a tile is added up a few dimensions at a time; a tile stops when no pair of it can reach
the threshold any more, and goes on with single pairs once few are left. What remains is
compared on the vectors given, in double precision.

Tiles are compact: a k-d tree over the leading axes, fitted on a sample of bounded size,
deals every vector to a group of bounded size (a cell too full is dealt on by a hash), and
each group is cut into tiles the same way. Two groups whose cells lie too far apart never
meet; two tiles whose balls lie too far apart are not multiplied; two tiles whose balls lie so
close that every pair must be near are linked as they stand. All of this loses no pair.

Every other pair of groups is one task, which returns counts of links and a spanning forest
of them, not the pairs. Without any structure in the vectors all groups meet: the work then
grows with the square of the number of different vectors, and the rows moved with their
number times that of the groups.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.session import stage
from llm.components import components

THRESHOLD = 0.9
#: Components of a group's vectors, in bytes of double precision; a task holds two groups.
GROUP_BYTES = 32 << 20
#: Groups of a small table, so that there is work for all cores.
LEAST_GROUPS, LEAST_ROWS = 8, 1024
TILE_ROWS = 512
#: Vectors that the axes and cells are fitted on. They decide on speed only.
SAMPLE_ROWS = 1 << 14
#: Leading axes that cells are cut along, and dimensions of the first step; each step doubles them.
CELL_AXES = 16
FIRST_STEP = 16
#: A tile goes on with single pairs when fewer of its pairs than one in so many are left.
SPARSE = 16
#: Margin for the rounding of 32-bit sums; pairs are judged in double precision.
SLACK = 1e-4
_AT_ONCE = 1 << 16
#: Copies of a tile for other groups that a task holds at a time.
COPIES_AT_ONCE = 16
TILE = "tile_group long, vectors binary, turned binary, nodes binary, copies binary"


@dataclass
class Axes:
    """Mean and principal axes of unit vectors; ``cells`` are the k-d cells' bounds along the leading axes."""

    mean: np.ndarray
    turn: np.ndarray
    cuts: list
    low: np.ndarray
    high: np.ndarray

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        return (unit - self.mean) @ self.turn


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Scaled by their largest component, so that lengths neither vanish nor overflow."""
    return vectors / np.abs(vectors).max(axis=1)[:, None]


def group_rows(dimensions: int) -> int:
    return max(GROUP_BYTES // (8 * dimensions), TILE_ROWS)


def steps(dimensions: int) -> list[int]:
    """The dimensions that are added up after each step."""
    out, at = [], 0
    while at < dimensions:
        at = min(at + (FIRST_STEP << len(out)), dimensions)
        out.append(at)
    return out


def split(points: np.ndarray, rows: np.ndarray, limit: int, low: np.ndarray, high: np.ndarray, cuts: list | None = None) -> Iterator[tuple]:
    """Cells of a k-d tree with at most ``limit`` points, each cut at the median of its widest axis.

    Yields (rows, low, high, key); ``cuts`` gets the tree as nested [axis, value, left, right].
    Points that are equal along all axes stay together.
    """
    some = points[rows]
    spread = some.max(axis=0) - some.min(axis=0) if len(rows) else np.zeros(points.shape[1])
    axis = int(spread.argmax()) if len(spread) else 0
    if len(rows) <= limit or spread[axis] <= 0:
        yield rows, low, high, cuts
        return
    values = some[:, axis]
    value = float(np.median(values))
    left = values < value
    if not left.any():
        value = float(values[values > value].min())
        left = values < value
    lower, upper = high.copy(), low.copy()
    lower[axis] = upper[axis] = value
    ways: tuple = (None, None) if cuts is None else ([], [])
    if cuts is not None:
        cuts.extend([axis, value, *ways])
    yield from split(points, rows[left], limit, low, lower, ways[0])
    yield from split(points, rows[~left], limit, upper, high, ways[1])


def fit(sample: np.ndarray, rows: int) -> Axes:
    """Axes and cells for that many vectors."""
    unit = sample / np.linalg.norm(sample, axis=1)[:, None]
    mean = unit.mean(axis=0)
    _, turn = np.linalg.eigh((unit - mean).T @ (unit - mean))
    turn = np.ascontiguousarray(turn[:, ::-1])
    leading = ((unit - mean) @ turn)[:, :CELL_AXES]
    groups = max(-(-rows // group_rows(sample.shape[1])), min(LEAST_GROUPS, -(-rows // LEAST_ROWS)))
    ends = np.full(leading.shape[1], np.inf)
    cuts: list = []
    cells = list(split(leading, np.arange(len(sample)), -(-len(sample) // groups), -ends, ends, cuts))
    for number, (*_, key) in enumerate(cells):
        key.append(number)
    return Axes(mean, turn, cuts, np.stack([c[1] for c in cells]), np.stack([c[2] for c in cells]))


def cell_of(points: np.ndarray, cuts: list) -> np.ndarray:
    """The number of each point's cell."""
    out = np.zeros(len(points), dtype=np.int64)
    todo = [(np.arange(len(points)), cuts)]
    while todo:
        rows, at = todo.pop()
        if len(at) == 1:
            out[rows] = at[0]
            continue
        axis, value, left, right = at
        below = points[rows, axis] < value
        todo += [(rows[below], left), (rows[~below], right)]
    return out


def reach(threshold: float) -> float:
    """The distance of unit vectors with that cosine."""
    return float(np.sqrt(max(2 - 2 * threshold, 0)))


def in_reach(axes: Axes, cell: int, threshold: float) -> np.ndarray:
    """The cells that vectors of a cell can have a near one in."""
    gap = np.maximum(np.maximum(axes.low - axes.high[cell], axes.low[cell] - axes.high), 0)
    return np.flatnonzero((gap**2).sum(axis=1) <= (reach(threshold) + SLACK) ** 2)


class Joined:
    """Sets of numbers joined by links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        at = self.parent[nodes]
        while not np.array_equal(up := self.parent[at], at):
            at = up
        self.parent[nodes] = at
        return at

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        p, q = self.roots(a), self.roots(b)
        apart = p != q
        if not apart.any():
            return
        pairs = np.unique(p[apart] * len(self.parent) + q[apart])
        for x, y in zip((pairs // len(self.parent)).tolist(), (pairs % len(self.parent)).tolist()):
            while (up := int(self.parent[x])) != x:
                x = up
            while (up := int(self.parent[y])) != y:
                y = up
            self.parent[max(x, y)] = min(x, y)


@dataclass
class Tile:
    """``whole`` is half the square of the norms, ``rest`` the norms of the suffixes after each step."""

    start: int
    vectors: np.ndarray
    turned: np.ndarray
    copies: np.ndarray
    centre: np.ndarray
    radius: float
    whole: np.ndarray
    rest: list[np.ndarray]

    @classmethod
    def of(cls, start: int, vectors: np.ndarray, turned: np.ndarray, copies: np.ndarray) -> Tile:
        centre = turned.mean(axis=0, dtype=np.float64)
        radius = float(np.sqrt(((turned - centre) ** 2).sum(axis=1).max()))
        squares = turned.astype(np.float64) ** 2
        rest = [np.sqrt(squares[:, upto:].sum(axis=1)).astype(np.float32) for upto in steps(turned.shape[1])]
        return cls(start, vectors, turned, copies, centre, radius, (squares.sum(axis=1) / 2).astype(np.float32), rest)


def near_pairs(a: Tile, b: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The places in the two tiles of all pairs with at least that cosine."""
    dimensions = a.turned.shape[1]
    least = np.float32(threshold - 1 - SLACK)
    product = np.zeros((len(a.turned), len(b.turned)), dtype=np.float32)
    done, rows, columns = 0, None, None
    for step, upto in enumerate(steps(dimensions)):
        if rows is None:
            product += a.turned[:, done:upto] @ b.turned[:, done:upto].T
            ones = np.ones_like(a.whole), np.ones_like(b.whole)
            bound = np.stack([a.rest[step], -a.whole, ones[0]], axis=1) @ np.stack([b.rest[step], ones[1], -b.whole])
            bound += product
            open_pairs = bound >= least
            left = int(np.count_nonzero(open_pairs))
            if not left:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if left * SPARSE < product.size or upto == dimensions:
                rows, columns = np.nonzero(open_pairs)
                sums = product[rows, columns]
        else:
            sums = sums + np.einsum("ij,ij->i", a.turned[rows, done:upto], b.turned[columns, done:upto])
            open_pairs = sums + a.rest[step][rows] * b.rest[step][columns] - a.whole[rows] - b.whole[columns] >= least
            rows, columns, sums = rows[open_pairs], columns[open_pairs], sums[open_pairs]
        done = upto
    # only what rounding could decide is left to compare
    near = sums - a.whole[rows] - b.whole[columns] >= least + 2 * SLACK
    unsure = np.flatnonzero(~near)
    for low in range(0, len(unsure), _AT_ONCE):
        some = unsure[low : low + _AT_ONCE]
        near[some] = cosines(a.vectors[rows[some]].astype(np.float64), b.vectors[columns[some]].astype(np.float64)) >= threshold
    return rows[near], columns[near]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of the rows, in double precision."""
    x, y = unit_rows(x), unit_rows(y)
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def compare(left: list[Tile], right: list[Tile] | None, links: np.ndarray, joined: Joined, threshold: float) -> None:
    """Count the links between two groups' tiles, or within one group's, and join what they link."""
    far = reach(threshold) + SLACK
    close = reach(threshold) - SLACK
    others = left if right is None else right
    centres, radii = np.stack([t.centre for t in others]), np.array([t.radius for t in others])
    for n, a in enumerate(left):
        distance = np.sqrt(((centres - a.centre) ** 2).sum(axis=1))
        meets = np.flatnonzero(distance - radii - a.radius <= far)
        for m in meets[meets >= n].tolist() if right is None else meets.tolist():
            b = others[m]
            own, its = a.start + np.arange(len(a.copies)), b.start + np.arange(len(b.copies))
            if distance[m] + radii[m] + a.radius <= close:
                links[own] += b.copies.sum() - (a.copies if a is b else 0)
                if a is not b:
                    links[its] += a.copies.sum()
                joined.link(own, np.full(len(own), its[0]))
                joined.link(its, np.full(len(its), own[0]))
                continue
            i, j = near_pairs(a, b, threshold)
            if a is b:
                i, j = i[i < j], j[i < j]
            links[own] += np.bincount(i, weights=b.copies[j], minlength=len(own)).astype(np.int64)
            links[its] += np.bincount(j, weights=a.copies[i], minlength=len(its)).astype(np.int64)
            joined.link(own[i], its[j])


def vectors_of(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, dimensions)


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """All rows with a number, the classes of equal vectors (node, copies, low, embedding), and the dimensions.

    ``usable`` rows have a vec_id and a vector of the most frequent size that is finite and not zero.
    """
    if vectors.schema["embedding"].dataType.simpleString() != "array<float>":
        vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    value = F.col("embedding")
    fit_for = (
        value.isNotNull()
        & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(value, lambda x: x != 0)
        & F.col("vec_id").isNotNull()
    )
    rows = stage(vectors.select("vec_id", "embedding").withColumn("row", F.monotonically_increasing_id()).withColumn("usable", F.coalesce(fit_for, F.lit(False))), "vectors")
    common = rows.where("usable").groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dimensions = int(common.n) if common else 0
    rows = rows.withColumn("usable", F.col("usable") & (F.size("embedding") == dimensions))
    classes = rows.where("usable").groupBy("embedding").agg(F.min("row").alias("node"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    return rows, stage(classes, "different-vectors"), dimensions


def fitted(classes: DataFrame, dimensions: int, sample_rows: int) -> Axes:
    """Axes and cells from a sample that holds ``sample_rows`` vectors at most."""
    count = classes.count()
    share = min(1.0, 0.9 * sample_rows / max(count, 1))
    some = classes if share == 1.0 else classes.where(F.abs(F.xxhash64("node") % 1_000_003) < int(share * 1_000_003))
    table = some.select("embedding").limit(sample_rows).toArrow()
    flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return fit(unit_rows(flat.reshape(-1, dimensions).astype(np.float64)), count)


def tiles(classes: DataFrame, axes: Axes, dimensions: int) -> DataFrame:
    """The vectors in tiles of their groups; a cell that got more than a group's rows is dealt on by a hash."""

    def deal(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                turned = axes.turned(unit_rows(vectors_of(batch, dimensions).astype(np.float64)))
                cell = cell_of(turned[:, :CELL_AXES], axes.cuts)
                rows = pa.array([x.tobytes() for x in turned.astype("<f4")], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("copies"), batch.column("embedding"), pa.array(cell), rows], ["node", "copies", "embedding", "cell", "turned"])

    kind = classes.schema["embedding"].dataType.simpleString()
    dealt = classes.select("node", "copies", "embedding").mapInArrow(deal, f"node long, copies long, embedding {kind}, cell long, turned binary")
    dealt = stage(dealt, "turned-vectors")
    # one row a cell; numbers below 2**24 say which part of a cell
    full = dealt.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(group_rows(dimensions))).alias("parts"))
    parted = dealt.join(full, "cell").withColumn("tile_group", F.col("cell") * (1 << 24) + F.pmod(F.xxhash64("node"), F.col("parts")))

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("node")
        turned = np.frombuffer(b"".join(table.column("turned").to_pylist()), "<f4").reshape(table.num_rows, dimensions)
        batch = table.to_batches()[0]
        own = vectors_of(batch, dimensions)
        nodes, copies = (table.column(c).to_numpy().astype(np.int64) for c in ("node", "copies"))
        ends = np.full(min(CELL_AXES, dimensions), np.inf)
        cells: list[list] = [[] for _ in range(5)]
        for rows, *_ in split(turned[:, :CELL_AXES], np.arange(len(turned)), TILE_ROWS, -ends, ends):
            for low in range(0, len(rows), TILE_ROWS):
                some = rows[low : low + TILE_ROWS]
                for at, x in zip(cells, (key[0].as_py(), own[some].tobytes(), turned[some].tobytes(), nodes[some].tobytes(), copies[some].tobytes())):
                    at.append(x)
        names = ["tile_group", "vectors", "turned", "nodes", "copies"]
        return pa.table([pa.array(x, pa.binary() if k else pa.int64()) for k, x in enumerate(cells)], names)

    return stage(parted.select("tile_group", "node", "copies", "embedding", "turned").groupBy("tile_group").applyInArrow(cut, TILE), "tiles")


def links_of(classes: DataFrame, dimensions: int, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Links between classes of vectors: (node, links, root). ``links`` counts rows of other classes.

    Each task that compared two groups gives a row for each of their nodes that has links; ``root``
    is a node it is joined with, the first of its part of the task's forest.
    """
    axes = fitted(classes, dimensions, sample_rows)
    made = tiles(classes, axes, dimensions)
    # one number a group
    groups = np.array(sorted(r.tile_group for r in made.select("tile_group").distinct().collect()), dtype=np.int64)
    kind = {"array<float>": np.float32, "array<double>": np.float64}[classes.schema["embedding"].dataType.simpleString()]

    def meet(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.column("tile_group")[row].as_py()
                others = groups[np.isin(groups >> 24, in_reach(axes, own >> 24, threshold))]
                tile = [batch.column(c).slice(row, 1) for c in batch.schema.names]
                for low in range(0, len(others), COPIES_AT_ONCE):
                    some = others[low : low + COPIES_AT_ONCE]
                    again = pa.array(np.zeros(len(some), dtype=np.int64))
                    values = [pa.array(np.minimum(some, own)), pa.array(np.maximum(some, own)), *[c.take(again) for c in tile]]
                    yield pa.RecordBatch.from_arrays(values, ["first", "second", *batch.schema.names])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        first, second = (k.as_py() for k in key)
        sides: dict[int, list[Tile]] = {first: [], second: []}
        nodes, start = [], 0
        for row in range(table.num_rows):
            vectors, turned, ids, copies = (table.column(c)[row].as_py() for c in ("vectors", "turned", "nodes", "copies"))
            ids = np.frombuffer(ids, np.int64)
            tile = Tile.of(start, np.frombuffer(vectors, kind).reshape(len(ids), -1), np.frombuffer(turned, "<f4").reshape(len(ids), -1), np.frombuffer(copies, np.int64))
            sides[table.column("tile_group")[row].as_py()].append(tile)
            nodes.append(ids)
            start += len(ids)
        ids = np.concatenate(nodes)
        links, joined = np.zeros(len(ids), np.int64), Joined(len(ids))
        if sides[first] and sides[second]:
            compare(sides[first], None if first == second else sides[second], links, joined, threshold)
        linked = np.flatnonzero(links)
        return pa.table({"node": ids[linked], "links": links[linked], "root": ids[joined.roots(linked)] if len(linked) else ids[:0]})

    met = made.mapInArrow(meet, f"first long, second long, {TILE}")
    return stage(met.groupBy("first", "second").applyInArrow(run, "node long, links long, root long"), "vector-links")


def near_copies(vectors: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Links are pairs of rows with a cosine of at least ``threshold``, which must be above 0;
    n_links counts the other rows linked directly, component_id is the smallest vec_id
    reachable (its own at most), and kept says that this is the row's own. Rows without a
    vec_id, and vectors that are null or zero, hold a null or a value that is not finite, or have
    another than the most frequent size, link with nothing; without a vec_id, component_id is
    null and the row kept. Repeated rows are vectors each for itself and link with one another.
    An empty table gives no rows.
    """
    spark: SparkSession = vectors.sparkSession
    rows, classes, dimensions = distinct_vectors(vectors)
    if dimensions:
        found = links_of(classes, dimensions, threshold, sample_rows)
    else:
        found = spark.createDataFrame([], "node long, links long, root long")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    # the smallest vec_id of a component lies in a class, not always in the one with the first row
    placed = classes.select("node", "copies", "low").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stage(placed.join(counts, "node", "left"), "placed-vectors")
    lowest = placed.groupBy("root").agg(F.min("low").alias("component"))
    about = placed.join(lowest, "root").select("node", F.col("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    about = stage(classes.select("node", "embedding").join(about, "node").where("n_links > 0").select("embedding", "component", "n_links"), "linked-vectors")
    sought = rows.where("usable").select("vec_id", "embedding").join(about, "embedding", "left")
    others = rows.where("NOT usable").select("vec_id", F.lit(None).cast("long").alias("component"), F.lit(0).cast("long").alias("n_links"))
    joined = sought.select("vec_id", "component", "n_links").unionByName(others)
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
