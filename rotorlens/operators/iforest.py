"""Isolation forest (Liu, Ting, Zhou 2008) on Spark.

Sampling, tree building and scoring are distributed; only the finished trees (at most 511 nodes each) reach the
driver. Nothing is drawn at run time: MD5 digests of the seed, the tree and the record id decide the sub-samples, and
those of the seed, the tree and the node decide its feature and its cut. So a different partitioning, or plain SQL,
gives the same forest.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlens.operators.quantiles import exact_quantiles
from rotorlens.session import busy_partitions, materialise

TREES = 100
SUB_SAMPLE = 256
POOL_FACTOR = 4
_NODE_SCHEMA = ("tree int, node int, feature int, split double, left int, right int, path double")


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    m = n[big]
    out[big] = 2.0 * (np.log(m - 1.0) + np.euler_gamma) - 2.0 * (m - 1.0) / m
    return out


def node_draw(name: str, node: int) -> tuple[int, float]:
    """A number that picks the feature and one in [0, 1) that places the cut of a node; the root is 1."""
    digest = hashlib.md5(f"{name}:{node}".encode()).hexdigest()
    return int(digest[13:21], 16), int(digest[:13], 16) / 2.0 ** 52


def grow_tree(x: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """One random tree as parallel node arrays. Leaves point at themselves and carry the path length.

    A node takes one of the features that vary in it; all cuts between their smallest and largest value are equally
    likely. ``name`` names the tree.
    """
    limit = math.ceil(math.log2(max(len(x), 2)))
    feature, split, left, right, depth, size = [], [], [], [], [], []

    def add(d: int, n: int) -> int:
        node = len(feature)
        for column, value in ((feature, 0), (split, np.inf), (left, node), (right, node), (depth, d), (size, n)):
            column.append(value)
        return node

    pending = [(add(0, len(x)), 1, np.arange(len(x)))]
    while pending:
        node, number, rows = pending.pop()
        if depth[node] >= limit or len(rows) < 2:
            continue
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        candidates = np.flatnonzero(high > low)
        if not len(candidates):
            continue
        pick, place = node_draw(name, number)
        f = int(candidates[pick % len(candidates)])
        cut = float(low[f] + place * (high[f] - low[f]))
        goes_left = x[rows, f] <= cut
        if goes_left.all():  # the draw hit the maximum
            continue
        feature[node], split[node] = f, cut
        left[node] = add(depth[node] + 1, int(goes_left.sum()))
        right[node] = add(depth[node] + 1, int((~goes_left).sum()))
        pending += [(right[node], 2 * number + 1, rows[~goes_left]), (left[node], 2 * number, rows[goes_left])]
    return {
        "feature": np.array(feature, np.int32), "split": np.array(split), "left": np.array(left, np.int32),
        "right": np.array(right, np.int32), "path": np.array(depth, float) + average_path(np.array(size)),
    }


@dataclass(frozen=True)
class Trees:
    """All trees of a forest, flattened: child indexes point into the same arrays."""

    roots: np.ndarray
    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray

    @staticmethod
    def pack(trees: list[dict[str, np.ndarray]]) -> Trees:
        starts = np.cumsum([0] + [len(t["feature"]) for t in trees[:-1]]).astype(np.int32)
        join = {c: np.concatenate([t[c] for t in trees]) for c in ("feature", "split", "path")}
        child = {c: np.concatenate([t[c] + s for t, s in zip(trees, starts)]).astype(np.int32)
                 for c in ("left", "right")}
        return Trees(starts, join["feature"], join["split"], child["left"], child["right"], join["path"])

    def score(self, x: np.ndarray, sub_sample: int, chunk: int = 2048) -> np.ndarray:
        """-2 ** (-mean path / c(sub-sample)) per row; lower is more anomalous."""
        norm = max(float(average_path(np.array([sub_sample]))[0]), 1e-12)
        levels = math.ceil(math.log2(max(sub_sample, 2)))
        ends = [*self.roots[1:].tolist(), len(self.feature)]
        trees = []
        for root, end in zip(self.roots.tolist(), ends):
            children = np.stack([self.right[root:end], self.left[root:end]], axis=1).ravel().astype(np.int64) - root
            trees.append((self.feature[root:end].astype(np.int64), self.split[root:end], children, self.path[root:end]))
        out = np.empty(len(x))
        for start in range(0, len(x), chunk):
            part = np.ascontiguousarray(x[start:start + chunk])
            flat, first = part.ravel(), np.arange(len(part)) * part.shape[1]
            paths = np.empty((len(part), len(trees)))
            for t, (feature, split, children, path) in enumerate(trees):  # a tree at a time stays in the cache
                node = np.zeros(len(part), np.int64)
                for _ in range(levels):
                    goes_left = flat.take(first + feature.take(node)) <= split.take(node)
                    node = children.take(2 * node + goes_left)
                paths[:, t] = path.take(node)
            out[start:start + chunk] = -np.exp2(-paths.mean(axis=1) / norm)
        return out


@dataclass(frozen=True)
class IsolationForest:
    trees: Trees
    sub_sample: int
    threshold: float
    contamination: float

    def score_column(self, x: Column) -> Column:
        """Score of an array column, as an Arrow-batched function."""
        trees, sub_sample = self.trees, self.sub_sample

        @F.arrow_udf("double")
        def forest_score(column: pa.Array) -> pa.Array:
            return pa.array(trees.score(matrix(column), sub_sample))

        # Declared non-deterministic only to keep filters on the score above it: pushed down, the predicate would run
        # the function a second time, over a copy of every expression its input is made of.
        return forest_score.asNondeterministic()(x)

    def score(self, df: DataFrame, x: str = "x", name: str = "anomaly_score") -> DataFrame:
        return df.withColumn(name, self.score_column(F.col(x)))

    def predict(self, df: DataFrame, x: str = "x") -> DataFrame:
        """Score, and ``is_anomaly`` for scores below the threshold of the training rows."""
        return self.score(df, x).withColumn("is_anomaly", F.col("anomaly_score") < F.lit(self.threshold))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        t = self.trees
        tree = np.searchsorted(t.roots, np.arange(len(t.feature)), side="right") - 1
        nodes = pd.DataFrame({"tree": tree, "node": np.arange(len(t.feature)), "feature": t.feature, "split": t.split,
                              "left": t.left, "right": t.right, "path": t.path})
        return spark.createDataFrame(nodes, _NODE_SCHEMA).withColumns({
            "sub_sample": F.lit(self.sub_sample), "threshold": F.lit(self.threshold),
            "contamination": F.lit(self.contamination)})

    @staticmethod
    def from_frame(df: DataFrame) -> IsolationForest:
        nodes = df.toPandas().sort_values(["tree", "node"])  # at most 511 nodes per tree
        roots = nodes.groupby("tree")["node"].min().to_numpy(np.int32)
        trees = Trees(roots, nodes["feature"].to_numpy(np.int32), nodes["split"].to_numpy(),
                      nodes["left"].to_numpy(np.int32), nodes["right"].to_numpy(np.int32), nodes["path"].to_numpy())
        first = nodes.iloc[0]
        return IsolationForest(trees, int(first["sub_sample"]), float(first["threshold"]),
                               float(first["contamination"]))


def matrix(column: pa.Array) -> np.ndarray:
    """Arrow list column of equal-length lists to a 2-d array without per-row objects."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def unit_hash(*columns: Column) -> Column:
    """Hash of the columns as a number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(2 ** 53))


def _digits(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13)


def unit_digest(*parts: Column) -> Column:
    """The first 52 bits of the MD5 of the parts, joined by colons, as a number in [0, 1)."""
    return F.conv(_digits(*parts), 16, 10).cast("double") / F.lit(2.0 ** 52)


def digest_below(limit: float, *parts: Column) -> Column:
    """Whether ``unit_digest`` of the parts is less than ``limit``; compared as digits, which need no conversion."""
    number = math.ceil(limit * 2.0 ** 52)  # exact: the limit is scaled by a power of two
    if not 0 <= number < 1 << 52:
        return F.lit(number > 0)
    return _digits(*parts) < F.lit(f"{number:013x}")


def digests(prefix: str, names: list[str | None]) -> np.ndarray:
    """``unit_digest`` of a prefix and each of the names; without a name, of the prefix alone."""
    begun, found = hashlib.md5(f"{prefix}:".encode()), []
    alone = hashlib.md5(prefix.encode()).digest()[:8]
    for name in names:
        if name is None:
            found.append(alone)
            continue
        one = begun.copy()
        one.update(name.encode())
        found.append(one.digest()[:8])
    return (np.frombuffer(b"".join(found), ">u8") >> np.uint64(12)).astype(float) / 2.0 ** 52


def tree_samples(df: DataFrame, rows: int, trees: int, sub_sample: int, record_id: str, x: str, seed: int) -> DataFrame:
    """About ``POOL_FACTOR * sub_sample`` candidate rows per tree, few enough to shuffle whatever the table's size.

    A first digest keeps a pool of the table, a second one draws candidates per tree; the tree then takes the
    ``sub_sample`` smallest digests among them. Rows that repeat an id and its values are drawn one by one, as copies
    1, 2, and so on; no more copies than a sub-sample has rows.
    """
    pool_rows = POOL_FACTOR * sub_sample * trees
    share = min(1.0, pool_rows / max(rows, 1))
    pool = df.select(F.col(record_id).alias("_id"), F.col(x).alias("x"))
    if share < 1.0:
        pool = pool.filter(digest_below(share, F.lit(seed), F.col("_id")))
    copies = pool.groupBy("_id", "x").agg(F.count("*").alias("_n")).select(
        "_id", "x", F.explode(F.sequence(F.lit(1), F.least(F.col("_n"), F.lit(sub_sample)).cast("int"))).alias("_copy"))
    cut = min(1.0, POOL_FACTOR * sub_sample / max(rows * share, 1.0))
    draw = (F.lit(seed), F.col("tree"), F.col("_id"), F.col("_copy"))
    return (copies.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
            .filter(digest_below(cut, *draw)).withColumn("draw", unit_digest(*draw)))


def isolation_forest_fit(
    df: DataFrame, contamination: float, trees: int = TREES, max_samples: int = SUB_SAMPLE, seed: int = 42,
    record_id: str = "record_id", x: str = "x", rows: int | None = None,
) -> IsolationForest:
    """Fit on an array column. The threshold is the contamination quantile of the training scores.

    A tree for which fewer candidates than a sub-sample were drawn (an id with very many copies may cause it) grows on
    those.
    """
    rows = df.count() if rows is None else rows
    sub_sample = min(max_samples, rows)
    samples = tree_samples(df, rows, trees, sub_sample, record_id, x, seed)

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        chosen = group.sort_values(["draw", "_id", "_copy"]).head(sub_sample)
        nodes = grow_tree(np.stack(chosen["x"].to_numpy()), f"{seed}:{int(key[0])}")
        return pd.DataFrame({"tree": key[0], "node": np.arange(len(nodes["feature"])), **nodes})

    # A group holds the candidates of one tree: about ``POOL_FACTOR`` sub-samples.
    placed = samples.repartition(busy_partitions(df.sparkSession), "tree")
    nodes = placed.groupBy("tree").applyInPandas(build, _NODE_SCHEMA).toPandas().sort_values(["tree", "node"])
    grown = [{c: g[c].to_numpy() for c in ("feature", "split", "left", "right", "path")}
             for _, g in nodes.groupby("tree", sort=True)]
    forest = IsolationForest(Trees.pack(grown), sub_sample, float("nan"), contamination)
    # Two passes need the scores; a stored column of doubles is cheaper than scoring twice.
    scores = materialise(forest.score(df.select(x), x).select("anomaly_score"), "scores")
    limit = exact_quantiles(scores, "anomaly_score", [contamination]).first()["quantile"]
    return IsolationForest(forest.trees, sub_sample, float(limit), contamination)


