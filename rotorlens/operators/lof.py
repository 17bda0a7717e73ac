"""Exact nearest neighbours and the local outlier factor (Breunig et al. 2000) on Spark.

Equal points are folded into one with a multiplicity first, so copies of one record never form a large group. The
distinct points are split into cells around pivots drawn from the data (the pivot partitioning of Lu, Shen, Chen, Ooi
2012). Cells that lie side by side make a part of bounded size, and parts go to the tasks one after another: points stay
where they are and are never copied per cell they look into. A point meets its own cell first, which bounds how far its
neighbours can be, then those other cells the triangle inequality cannot rule out. Only the k best of a part within that
bound are stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlens.operators.iforest import matrix
from rotorlens.operators.sampling import hash_sample
from rotorlens.session import discard, materialise

NEIGHBOURS = 20
CELL_ROWS = 4096
#: Points that look into cells together.
BLOCK_ROWS = 2048
MAX_PIVOTS = 4096
#: Numbers of the points of a part: 8 bytes each, sent to the tasks.
PART_NUMBERS = 8_000_000
#: Points of a task; those of a cell are side by side.
TASK_ROWS = 20_000
#: Candidates that a block of points may hold before only the k best are kept.
CANDIDATES = 2_000_000
DENSITY_EPS = 1e-10
_FOUND = "dists array<double>, vids array<string>, weights array<long>"


def distinct_points(df: DataFrame, x: str = "x", record_id: str = "record_id") -> DataFrame:
    """One row per distinct point: smallest id, the point, number of copies."""
    return df.groupBy(F.col(x).alias("x")).agg(F.min(record_id).alias("vid"), F.count("*").alias("weight"))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # Column by column: no cancellation as with the expanded square, and no 3-d temporary.
    square = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        square += (a[:, d, None] - b[None, :, d]) ** 2
    return np.sqrt(square)


def _assign(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Nearest pivot of each point and the distance to it."""

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("x"))
            cell, reach = np.empty(len(x), np.int32), np.empty(len(x))
            for start in range(0, len(x), 1024):
                d = _distances(x[start:start + 1024], pivots)
                cell[start:start + 1024] = d.argmin(axis=1)
                reach[start:start + 1024] = d.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vid"), b.column("x"), b.column("weight"), pa.array(cell), pa.array(reach)],
                names=["vid", "x", "weight", "cell", "reach"])

    return points.select("vid", "x", "weight").mapInArrow(
        batch, "vid string, x array<double>, weight long, cell int, reach double")


def _side_by_side(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which neighbours in space tend to be neighbours: halves along the widest column."""
    order, pending = [], [np.arange(len(pivots))]
    while pending:
        rows = pending.pop()
        if len(rows) > 1:
            widest = np.ptp(pivots[rows], axis=0).argmax()
            rows = rows[np.argsort(pivots[rows, widest], kind="stable")]
            pending += [rows[len(rows) // 2:], rows[:len(rows) // 2]]
        else:
            order += rows.tolist()
    return pivots[order]


def _open_cells(to_pivots: np.ndarray, own: np.ndarray, apart: np.ndarray, radius: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """[point, cell]: whether points of the cell may lie within the point's ``limit``; ``own`` is the distance to the own
    pivot, ``apart`` that between the pivots.

    A cell is out of reach if its ball is, or the plane half way between its pivot and the own one, behind which all its
    points are: a few far points make the ball of a cell large, but don't move the plane.
    """
    slack = 1e-9 * (1.0 + radius)  # rounding must not exclude a cell
    open_cells = to_pivots - radius - slack <= limit[:, None]
    square, own = to_pivots ** 2, own[:, None] ** 2
    with np.errstate(invalid="ignore", over="ignore"):
        open_cells &= ~(square - own > 2 * apart * (limit[:, None] + 1e-9) + 1e-9 * (square + own))
    open_cells[:, ~np.isfinite(radius)] = False
    return open_cells


@dataclass(frozen=True)
class _Part:
    """Points of some cells, cell by cell, with what rules cells out. ``names`` are the ids in order, ``codes`` the points'
    places among them. Cells are counted from ``first``; a large cell may be in several parts."""

    first: int
    starts: np.ndarray  # of the cells, and the end
    points: np.ndarray
    names: np.ndarray
    codes: np.ndarray
    weights: np.ndarray
    pivots: np.ndarray  # of the cells
    radius: np.ndarray
    between: np.ndarray  # distances of all pivots to those of the cells

    def plain(self) -> tuple:
        return tuple(getattr(self, f.name) for f in fields(self))


def _collected(points: DataFrame, first: int, after: int, pivots: np.ndarray, radius: np.ndarray) -> _Part:
    table = points.select("vid", "x", "weight", "cell").toArrow().combine_chunks()  # of a fixed size
    cell = table.column(3).to_numpy()
    order = np.argsort(cell, kind="stable")
    x = matrix(table.column(1).chunk(0)) if table.num_rows else np.empty((0, pivots.shape[1]))
    names, codes = np.unique(table.column(0).to_numpy().astype(str), return_inverse=True)
    mine = slice(first, after)
    return _Part(first, np.searchsorted(cell[order], np.arange(first, after + 1)), x[order], names, codes[order],
                 table.column(2).to_numpy()[order], pivots[mine], radius[mine], _distances(pivots, pivots[mine]))


class _Best:
    """The k nearest of a block of points so far; equal distances are ordered by id."""

    def __init__(self, codes: np.ndarray, k: int, bound: np.ndarray):
        self.codes, self.k, self.bound = codes, k, bound.copy()
        self.held, self.waiting = (np.zeros(0, int), np.zeros(0, int), np.zeros(0)), []

    def add(self, row: np.ndarray, point: np.ndarray, dist: np.ndarray) -> None:
        near = dist <= self.bound[row]
        self.waiting.append((row[near], point[near], dist[near]))
        if sum(len(w[0]) for w in self.waiting) > CANDIDATES:
            self.settle()

    def settle(self) -> None:
        row, point, dist = (np.concatenate(c) for c in zip(self.held, *self.waiting))
        order = np.lexsort((self.codes[point], dist, row))
        row, point, dist = row[order], point[order], dist[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep, last = rank < self.k, rank == self.k - 1
        self.bound[row[last]] = np.minimum(self.bound[row[last]], dist[last])
        self.held, self.waiting = (row[keep], point[keep], dist[keep]), []


def _look(part: _Part, k: int, x: np.ndarray, codes: np.ndarray, cell: np.ndarray, reach: np.ndarray, bound: np.ndarray, pivots: np.ndarray,
          home: bool) -> _Best:
    """The k nearest points of a part to each of a block of points, as far as they lie within ``bound``. ``home``: the
    points belong to the part themselves and look into their own cell first."""
    best = _Best(part.codes, k, bound)

    def compare(rows: np.ndarray, c: int, own: bool) -> None:
        a, b = int(part.starts[c]), int(part.starts[c + 1])
        if a == b:
            return
        there, number = part.points[a:b], part.codes[a:b]
        near = there - part.pivots[c]
        sizes = (near * near).sum(axis=1)
        largest = np.max(sizes, where=np.isfinite(sizes), initial=0.0)
        right = np.column_stack((-2 * near, np.ones(len(near)), sizes)).T
        for at in range(0, len(rows), 256):
            row = rows[at:at + 256]
            mine = x[row] - part.pivots[c]
            size = (mine * mine).sum(axis=1)
            square = np.column_stack((mine, size, np.ones(len(mine)))) @ right  # rounded: only to choose candidates
            rounding = 1e-11 * (size + largest)
            square[codes[row][:, None] == number[None, :]] = np.inf  # a point is no neighbour of itself
            limit = best.bound[row] ** 2
            if own and k < square.shape[1]:
                limit = np.minimum(limit, np.partition(square, k - 1, axis=1)[:, k - 1] + rounding)
            r, p = np.nonzero(square <= (limit * (1 + 1e-9) + rounding)[:, None])
            keep = np.isfinite(square[r, p])
            r, p = row[r[keep]], p[keep]
            total = np.zeros(len(r))
            for d in range(x.shape[1]):  # column by column: no cancellation
                total += (x[r, d] - there[p, d]) ** 2
            best.add(r, a + p, np.sqrt(total))

    if home:
        for c in np.unique(cell).tolist():
            compare(np.flatnonzero(cell == c), c - part.first, True)
        best.settle()
        lost = np.flatnonzero(~np.isfinite(best.bound))
        if len(lost) and len(pivots) > k:  # pivots are points as well: the k-th other one
            best.bound[lost] = np.partition(_distances(x[lost], pivots), k, axis=1)[:, k]
    to_pivots = _distances(x, part.pivots)
    open_cells = _open_cells(to_pivots, reach, part.between[cell], part.radius, best.bound)
    if home:
        open_cells[np.arange(len(x)), cell - part.first] = False
    for c in np.argsort(np.where(open_cells, to_pivots, np.inf).min(axis=0, initial=np.inf), kind="stable").tolist():
        rows = np.flatnonzero(open_cells[:, c])
        if len(rows):
            compare(rows, c, False)
    best.settle()
    return best


def _searched(queries: DataFrame, part: _Part, pivots: np.ndarray, k: int, block_rows: int, home: bool, carry: list[str]) -> DataFrame:
    """What points find in a part: ``vid`` and the columns of ``carry``, the new ``bound`` for points at home, and
    neighbours. Other points that find nothing are left out. Stored."""
    shared = queries.sparkSession.sparkContext.broadcast((part.plain(), pivots))  # of a fixed size
    names = ["vid", *carry, "bound", "dists", "vids", "weights"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, every = shared.value
        there = _Part(*plain)
        for whole in batches:
            for start in range(0, whole.num_rows, block_rows):
                b = whole.slice(start, block_rows)
                x, cell = matrix(b.column("x")), b.column("cell").to_numpy(zero_copy_only=False)
                called = b.column("vid").to_numpy(zero_copy_only=False).astype(str)
                code = np.searchsorted(there.names, called)
                code = np.where(there.names.take(code, mode="clip") == called, code, -1) if len(there.names) else np.full(len(called), -1)
                best = _look(there, k, x, code, cell, b.column("reach").to_numpy(zero_copy_only=False),
                             b.column("bound").to_numpy(zero_copy_only=False), every, home)
                row, point, dist = best.held
                found = np.bincount(row, minlength=len(x))
                chosen = np.arange(len(x)) if home else np.flatnonzero(found)
                ends = pa.array(np.concatenate(([0], np.cumsum(found[chosen]))).astype(np.int32))
                taken = pa.array(chosen)
                yield pa.RecordBatch.from_arrays([
                    *[b.column(c).take(taken) for c in ("vid", *carry)], pa.array(best.bound[chosen]),
                    pa.ListArray.from_arrays(ends, pa.array(dist)),
                    pa.ListArray.from_arrays(ends, pa.array(there.names[there.codes[point]].astype(object), pa.string())),
                    pa.ListArray.from_arrays(ends, pa.array(there.weights[point]))], names=names)

    kinds = {"x": "array<double>", "cell": "int", "reach": "double", "home": "int"}
    schema = ", ".join(["vid string", *[f"{c} {kinds[c]}" for c in carry], "bound double", _FOUND])
    out = materialise(queries.select("vid", "x", "cell", "reach", "bound", *[c for c in carry if c == "home"]).mapInArrow(search, schema), "near")
    shared.destroy()
    return out


def _merge(partials: DataFrame, k: int) -> DataFrame:
    """The k nearest per point over all blocks, as ``neighbours array<struct<dist, vid, weight>>``."""
    zipped = partials.select("vid", F.transform(
        F.arrays_zip("dists", "vids", "weights"),
        lambda n: F.struct(n["dists"].alias("dist"), n["vids"].alias("vid"), n["weights"].alias("weight"))).alias("_n"))
    return zipped.groupBy("vid").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("_n"))), 1, k).alias("neighbours"))


def _cut(neighbours: Column, own: Column, k: int) -> Column:
    """Neighbours up to a total weight of k; the copies of the point itself come first, at distance 0."""
    copies = F.struct(F.lit(0.0).alias("dist"), F.col("vid").alias("vid"), (own - 1).alias("weight"))
    every = F.concat(F.when(own > 1, F.array(copies)).otherwise(F.array().cast(
        "array<struct<dist:double,vid:string,weight:bigint>>")), neighbours)
    start = F.struct(F.lit(0).cast("bigint").alias("total"),
                     F.array().cast("array<struct<dist:double,vid:string,weight:bigint>>").alias("kept"))

    def add(acc: Column, n: Column) -> Column:
        taken = F.least(n["weight"], F.lit(k).cast("bigint") - acc["total"])
        entry = F.struct(n["dist"].alias("dist"), n["vid"].alias("vid"), taken.alias("weight"))
        return F.when(taken > 0, F.struct((acc["total"] + taken).alias("total"),
                                          F.concat(acc["kept"], F.array(entry)).alias("kept"))).otherwise(acc)

    return F.aggregate(every, start, add, lambda acc: acc["kept"])


def _parts(counts: dict[int, int], cells: int, most: int) -> list[tuple[int, int, int, int]]:
    """(first cell, cell after the last, share, shares) of parts of at most about ``most`` points: cells side by side, or a
    share of one large cell."""
    out, first, held = [], 0, 0
    for c in range(cells):
        n = counts.get(c, 0)
        if held and held + n > most:
            out.append((first, c, 0, 1))
            first, held = c, 0
        if n > most:  # nothing is held
            shares = -(-n // most)
            out += [(first, c + 1, s, shares) for s in range(shares)]
            first = c + 1
            continue
        held += n
    return out + ([(first, cells, 0, 1)] if held else [])


def exact_neighbours(points: DataFrame, k: int = NEIGHBOURS, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS,
                     seed: int = 42, numbers: int = PART_NUMBERS) -> DataFrame:
    """Nearest neighbours of distinct points (``vid, x, weight``) up to a total weight of ``k``. Stored.

    Returns ``vid, weight, neighbours array<struct<dist, vid, weight>>``.
    """
    rows = points.count()
    cores = points.sparkSession.sparkContext.defaultParallelism
    n_pivots = int(min(MAX_PIVOTS, max(1, -(-rows // cell_rows))))
    # At most MAX_PIVOTS points reach the driver.
    pivots = np.array([r["x"] for r in hash_sample(points.select("vid", "x"), n_pivots, "vid", seed).collect()])
    pivots = _side_by_side(pivots) if rows else np.empty((1, 0))
    tasks = max(2 * cores, -(-rows // TASK_ROWS))
    placed = materialise(_assign(points, pivots).repartitionByRange(tasks, "cell", F.xxhash64("vid")).sortWithinPartitions("cell"), "cells")
    sums = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("radius")).collect()  # a row per cell
    counts, radius = {r["cell"]: r["n"] for r in sums}, np.full(n_pivots, -np.inf)
    for r in sums:
        radius[r["cell"]] = r["radius"]
    parts = _parts(counts, n_pivots, max(1, numbers // max(pivots.shape[1], 1)))
    carry = ["x", "cell", "reach", "home"] if len(parts) > 1 else []
    found = []
    for number, (first, after, share, shares) in enumerate(parts):
        here = _within(placed, first, after, share, shares).withColumns({"bound": F.lit(float("inf")), "home": F.lit(number)})
        part = _collected(here, first, after, pivots, radius)
        found.append(_searched(here, part, pivots, k, block_rows, True, carry))
    own = found[0] if found else None
    for more in found[1:]:
        own = own.unionByName(more)
    if own is None:
        own = points.select("vid").withColumns({n: F.lit(None).cast(t) for n, t in (f.split(" ") for f in _FOUND.split(", "))})
    if len(parts) > 1:
        reaching = {r["cell"]: r["far"] for r in own.groupBy("cell").agg(F.max(F.col("bound")).alias("far")).collect()}
        far = np.array([reaching.get(c, -np.inf) for c in range(n_pivots)]) + radius
        for number, (first, after, share, shares) in enumerate(parts):
            # Cells none of whose points can reach a cell of the part aren't read.
            gaps = _distances(pivots, pivots[first:after]) - radius[None, first:after]
            near = np.flatnonzero(gaps.min(axis=1) - 1e-6 * (1 + np.abs(radius[first:after]).max()) <= far).tolist()
            others = own.where((F.col("home") != number) & F.col("cell").isin(near))
            part = _collected(_within(placed, first, after, share, shares), first, after, pivots, radius)
            found.append(_searched(others, part, pivots, k, block_rows, False, []))
    partial = own.select("vid", "dists", "vids", "weights")
    for more in found[len(parts):]:
        partial = partial.unionByName(more.select("vid", "dists", "vids", "weights"))
    joined = points.select("vid", "weight").join(_merge(partial, k), "vid", "left")
    none = F.coalesce("neighbours", F.array().cast("array<struct<dist:double,vid:string,weight:bigint>>"))
    out = materialise(joined.select("vid", "weight", _cut(none, F.col("weight"), k).alias("neighbours")), "neighbours")
    discard(placed, *found)
    return out


def _within(placed: DataFrame, first: int, after: int, share: int, shares: int) -> DataFrame:
    rows = placed.where(F.col("cell").between(first, after - 1))
    return rows if shares == 1 else rows.where(F.pmod(F.xxhash64("vid"), F.lit(shares)) == share)


def _visits(placed: DataFrame, pivots: np.ndarray, radius: np.ndarray, k: int) -> DataFrame:
    """The other cells each point has to look into: those its neighbour bound may reach (``_open_cells``).

    The bound is the k-th distance within the own cell or, as pivots are points as well, to the k-th other pivot.
    """
    between = _distances(pivots, pivots)  # of at most MAX_PIVOTS points

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, cell = matrix(b.column("x")), b.column("cell").to_numpy(zero_copy_only=False)
            bound = pd.to_numeric(b.column("bound").to_pandas()).fillna(np.inf).to_numpy(float)
            to_pivots = _distances(x, pivots)
            if len(pivots) > k:
                bound = np.minimum(bound, np.partition(to_pivots, k, axis=1)[:, k])
            own = np.take_along_axis(to_pivots, cell[:, None].astype(int), axis=1)[:, 0]
            open_cells = _open_cells(to_pivots, own, between[cell], radius, bound)
            open_cells[np.arange(len(x)), cell] = False
            row, target = np.nonzero(open_cells)
            yield pa.RecordBatch.from_arrays(
                [b.column("vid").take(pa.array(row)), b.column("x").take(pa.array(row)), pa.array(target.astype(np.int32))],
                names=["vid", "x", "cell"])

    return placed.select("vid", "x", "cell", "bound").mapInArrow(batch, "vid string, x array<double>, cell int")


def local_outlier_factor(
    df: DataFrame, k: int = NEIGHBOURS, x: str = "x", record_id: str = "record_id", cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``record_id, lof`` for every record; about 1 inside, larger for outliers."""
    points = materialise(distinct_points(df, x, record_id), "points")
    near = exact_neighbours(points, k, cell_rows, block_rows)
    reach = near.select("vid", F.element_at("neighbours", -1)["dist"].alias("k_distance"))
    edges = near.select("vid", F.explode("neighbours").alias("n")).select(
        "vid", F.col("n.dist").alias("dist"), F.col("n.vid").alias("other"), F.col("n.weight").alias("w"))

    def of_other(values: DataFrame, column: str) -> DataFrame:
        return edges.join(values.select(F.col("vid").alias("other"), column), "other")

    total = F.sum("w")
    density = of_other(reach, "k_distance").groupBy("vid").agg(
        (1.0 / (F.sum(F.greatest("k_distance", "dist") * F.col("w")) / total + F.lit(DENSITY_EPS))).alias("density"))
    density = materialise(density, "density")
    around = of_other(density, "density").groupBy("vid").agg((F.sum(F.col("density") * F.col("w")) / total).alias("_near"))
    factor = around.join(density, "vid").select("vid", (F.col("_near") / F.col("density")).alias("lof"))
    by_point = points.select("vid", F.col("x").alias("_px")).join(factor, "vid").drop("vid")
    return df.join(by_point, df[x] == by_point["_px"]).select(record_id, "lof")
