"""Approximate nearest neighbours: an NN-descent graph built by Spark joins, searched greedily.

Equal vectors are folded into one node that remembers its smallest ids. A first graph comes from cells of random
hyperplanes (several independent tables; a cell with more nodes than ``CELL`` is cut by hash). Every round then joins
each node with its neighbours and those that have it as neighbour, compares these with each other (neighbours of
neighbours), and keeps the nearest ``DEGREE`` per node, until few edges are new. A node's part in a round is bounded by
``MEMBERS`` draws, as the method has it, so hubs don't grow. Queries walk the graph from a few fixed entries (and from
their own node, if they are indexed): all unexpanded nodes of a beam are expanded by one join a round.

Recall against brute force is measured in the tests and given in the README.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rotorlens.llm.common import parts_for, stored

DEGREE = 20
MEMBERS = 40
CELL = 2000
TABLES = 6
ROUNDS = 4
#: The rounds end when fewer than this share of the edges is new.
LEAST_NEW = 0.01
BEAM = 256
ENTRIES = 32
STEPS = 40


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id, vec: ids with a vector that is not null or zero and has only finite components.

    An id of several rows counts once, with the smallest of its vectors. Vectors of another length than most take no part.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("vec"))
    good = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", finite) & F.exists(
        "vec", lambda x: x != 0))
    size = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size("vec") == (size.n if size else 0)).groupBy("id").agg(F.min("vec").alias("vec"))


def fold(rows: DataFrame, copies: int) -> DataFrame:
    """node (smallest id), vec, ids (the ``copies`` smallest): one row per distinct vector."""
    first = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    kept = rows.select("id", "vec", first.alias("_n")).where(F.col("_n") <= copies)  # limited before the shuffle, too
    return kept.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.col("ids")[0].alias("node"), "vec", "ids")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))


def _nearest(table: pd.DataFrame, degree: int) -> pd.DataFrame:
    """The ``degree`` nearest of every node, each pair once."""
    table = table.sort_values(["node", "nbr", "d"], kind="stable").drop_duplicates(["node", "nbr"])
    table = table.sort_values(["node", "d", "nbr"], kind="stable")
    return table[table.groupby("node").cumcount() < degree]


def first_graph(nodes: DataFrame, count: int, degree: int = DEGREE, cell: int = CELL, tables: int = TABLES) -> DataFrame:
    """node, nbr, d (squared) from cells of random hyperplanes through the origin."""
    planes = max(0, math.ceil(math.log2(max(1, count) / cell)))

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = _matrix(batch["vec"])
            for k in range(tables if planes else 1):
                normals = np.random.default_rng(1000 + k).standard_normal((points.shape[1], planes))
                code = ((points @ normals > 0) @ (1 << np.arange(planes))) if planes else np.zeros(len(points), np.int64)
                yield batch.assign(table=k, cell=code.astype(np.int64))

    placed = stored(nodes.select("node", "vec").mapInPandas(
        cells, f"node long, vec {nodes.schema['vec'].dataType.simpleString()}, table int, cell long"), "cells")
    sizes = placed.groupBy("table", "cell").agg(F.ceil(F.count("*") / (3 * cell)).cast("int").alias("blocks"))
    cut = placed.join(sizes.where("blocks > 1"), ["table", "cell"], "left").select(
        "table", "cell", F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).alias("block"), "node", "vec")

    def inside(rows: pd.DataFrame) -> pd.DataFrame:
        ids, points = rows["node"].to_numpy(np.int64), _matrix(rows["vec"])
        norm = (points ** 2).sum(1)
        d = np.maximum(norm[:, None] + norm[None] - 2 * points @ points.T, 0)
        np.fill_diagonal(d, np.inf)
        k = min(degree, len(ids) - 1)
        best = np.argpartition(d, k - 1, axis=1)[:, :k] if k else np.zeros((len(ids), 0), np.int64)
        return pd.DataFrame({"node": np.repeat(ids, k), "nbr": ids[best].ravel(),
                             "d": np.take_along_axis(d, best, 1).ravel()})

    found = cut.repartition(parts_for(cut), "table", "cell", "block").groupBy("table", "cell", "block").applyInPandas(
        inside, "node long, nbr long, d double")
    return _keep(found.withColumn("new", F.lit(True)), degree)


def _keep(edges: DataFrame, degree: int) -> DataFrame:
    once = edges.groupBy("node", "nbr").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("d", "nbr"))
    return once.select("*", rank.alias("_r")).where(F.col("_r") <= degree).drop("_r")


def descend(nodes: DataFrame, graph: DataFrame, count: int, number: int, degree: int = DEGREE,
            members: int = MEMBERS) -> DataFrame:
    """One round: neighbours of neighbours are compared, and every node keeps its nearest."""
    both = graph.select(F.col("node").alias("u"), F.col("nbr").alias("v"), "new", F.lit(True).alias("own")).unionByName(
        graph.select(F.col("nbr").alias("u"), F.col("node").alias("v"), "new", F.lit(False).alias("own")))
    # A node's own neighbours all meet; of those that have it as neighbour, new ones are drawn first.
    draw = F.row_number().over(Window.partitionBy("u").orderBy(
        F.desc("own"), F.desc("new"), F.xxhash64("u", "v", F.lit(number)), "v"))
    drawn = stored(both.groupBy("u", "v").agg(F.max("new").alias("new"), F.max("own").alias("own")).select(
        "*", draw.alias("_r")).where(F.col("_r") <= members).drop("_r"), "drawn")
    met = drawn.select(F.col("u").alias("nbr"), F.col("v").alias("node"), F.lit(True).alias("met"))
    kept = graph.join(met, ["node", "nbr"], "left").select(
        "node", "nbr", "d", (F.col("new") & F.col("met").isNull()).alias("new"))
    worst = graph.groupBy("node").agg(F.when(F.count("*") >= degree, F.max("d")).alias("worst"))
    described = nodes.select("node", "vec").join(worst, "node", "left")
    joined = drawn.join(described, F.col("v") == F.col("node")).drop("node")
    buckets = max(parts_for(nodes), -(-count // 1000))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("u", kind="stable")
        u, v, new = rows["u"].to_numpy(), rows["v"].to_numpy(), rows["new"].to_numpy(bool)
        worst_of = rows["worst"].fillna(np.inf).to_numpy(float)
        points = _matrix(rows["vec"])
        starts = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(u)])))
        found = []
        for at in range(0, len(starts), 256):
            first, size = starts[at:at + 256], sizes[at:at + 256]
            slot = np.arange(size.max())
            there = slot < size[:, None]
            index = np.where(there, first[:, None] + slot, first[:, None])
            a = points[index]
            norm = (a ** 2).sum(2)
            d = np.maximum(norm[:, :, None] + norm[:, None, :] - 2 * a @ a.transpose(0, 2, 1), 0)
            good = there[:, :, None] & there[:, None, :] & (slot[:, None] != slot) & (d < worst_of[index][:, :, None]) & (
                new[index][:, :, None] | new[index][:, None, :])
            g, i, j = np.nonzero(good)
            found.append(pd.DataFrame({"node": v[index[g, i]], "nbr": v[index[g, j]], "d": d[g, i, j]}))
        return _nearest(pd.concat(found), degree)

    candidates = joined.groupBy(F.pmod(F.xxhash64("u"), F.lit(buckets)).alias("bucket")).applyInPandas(
        lambda rows: compare(rows), "node long, nbr long, d double")
    return _keep(kept.unionByName(candidates.withColumn("new", F.lit(True))), degree)


def build_graph(nodes: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """node, nbr: the neighbour graph of folded vectors, both ways, the nearest ``2 * degree`` per node."""
    count = nodes.count()
    graph = stored(first_graph(nodes, count, degree), "graph")
    for number in range(rounds):
        graph = stored(descend(nodes, graph, count, number, degree), "graph")
        if graph.where("new").count() < LEAST_NEW * count * degree:
            break
    both = graph.select("node", "nbr", "d").unionByName(graph.select(
        F.col("nbr").alias("node"), F.col("node").alias("nbr"), "d")).withColumn("new", F.lit(False))
    return stored(_keep(both, 2 * degree).select("node", "nbr"), "graph")


def _distance(a: Column, b: Column) -> Column:
    """Euclidean distance in double precision, by Arrow batches."""

    def of(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(np.sqrt(((_matrix(x) - _matrix(y)) ** 2).sum(1)) if len(x) else [], dtype=float)

    return F.pandas_udf(of, "double")(a, b)


def search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = BEAM, entries: int = ENTRIES,
           steps: int = STEPS) -> DataFrame:
    """query_id, node, d: the ``beam`` nearest nodes found per query. ``queries``: query_id, vec, own (a node or null)."""
    asked = stored(queries.select("query_id", F.col("vec").alias("asked"), "own"), "asked")
    points = nodes.select("node", "vec")
    doors = [r.node for r in nodes.select("node").orderBy(F.xxhash64("node")).limit(entries).collect()]

    def measured(pairs: DataFrame) -> DataFrame:
        return pairs.join(points, "node").join(asked.select("query_id", "asked"), "query_id").select(
            "query_id", "node", _distance(F.col("vec"), F.col("asked")).alias("d"))

    start = asked.select("query_id", F.explode(F.array_distinct(F.array_compact(F.array(
        *[F.lit(x).cast("long") for x in doors], F.col("own").cast("long"))))).alias("node"))
    held = stored(measured(start).withColumn("open", F.lit(True)), "beam")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "node"))
    for _ in range(steps):
        reached = held.where("open").join(graph, "node").select("query_id", F.col("nbr").alias("node")).distinct()
        fresh = reached.join(held.select("query_id", "node"), ["query_id", "node"], "left_anti")
        merged = held.withColumn("open", F.lit(False)).unionByName(measured(fresh).withColumn("open", F.lit(True)))
        held = stored(merged.select("*", rank.alias("_r")).where(F.col("_r") <= beam).drop("_r"), "beam")
        if held.where("open").limit(1).count() == 0:
            break
    return held.select("query_id", "node", "d")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
            degree: int = DEGREE, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row for which ``is_query`` (on ``id``) holds,
    among all rows but itself, nearest first, ties to smaller ids.

    Null, zero or non-finite vectors and null ids take no part. Equal vectors are all candidates. Fewer candidates than
    ``k``: all of them. Empty table: no rows. Columns not named here are ignored.
    """
    rows = stored(usable(vectors, vec_id, embedding), "vectors")
    nodes = stored(fold(rows, k + 1), "nodes")
    graph = build_graph(nodes, degree)
    asked = rows.where(is_query).select(F.col("id").alias("query_id"), "vec").join(
        nodes.select("vec", F.col("node").alias("own")), "vec", "left")
    found = search(nodes, graph, asked, max(beam, 2 * k))
    each = found.join(nodes.select("node", F.explode("ids").alias("vec_id")), "node").where(
        F.col("vec_id") != F.col("query_id"))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))
    return each.select("query_id", order.alias("rank"), "vec_id", F.col("d").alias("score")).where(F.col("rank") <= k)
