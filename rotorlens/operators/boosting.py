"""Multinomial gradient boosting with histograms, for several models at once.

Every round fits one regression tree per class to the gradients of the softmax loss. Features are cut into bins at
quantiles. A level of all trees of a round, those of all classes and of all cross-validation folds, is one Spark job:
tasks add up the gradients by tree, node, feature and bin, the sums of all tasks meet per tree and node, and the best
split of each comes back. So five folds and the final model cost as many jobs as one model, whatever the rows. Models
know nothing of each other: where a task can hold the rows of one, each model is grown by a task of its own, which goes
through all rounds and adds up only the smaller child of every split, the other one being the rest of its parent. The
trees are the same.

Gradients are summed as fixed-point integers, so the trees depend neither on the order of rows nor on the partitioning;
only the quantiles behind the bins are approximate. The raw scores of the training rows are written to the shared folder
after every round (adding the trees of a round again in every job would cost more), in place of the ones before, so losing
executors loses one job at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlens.session import discard, materialise

BINS = 64
#: Up to so many rows, a task grows a whole model; it holds some 300 bytes a row.
TASK_ROWS = 2_000_000
#: More rows are dealt to tasks of so many, as long as there are cores for them, and of no more than the second number.
LEVEL_ROWS, MOST_LEVEL_ROWS = 5_000, 200_000
#: Rows of a stored block, and rows that a task works on at once.
BLOCK_ROWS, GATHERED = 1 << 14, 1 << 17
#: Gradients are multiples of its inverse.
UNIT = float(1 << 20)
#: Rows that are added up at once, and a row's share of a sum that also holds curvatures (a quarter of ``UNIT`` at most):
#: exact, as such a sum stays below 2 ** 53.
CHUNK = 1 << 14
ROW_SHARE = float(1 << 35)
#: Chunks whose sums may be held in that way: no more than 2 ** 16 rows.
CHUNKS = 4
ACCURACY = 10_000
_TREE_SCHEMA = "round int, class int, node int, feature int, threshold double, value double, gain double"


@dataclass(frozen=True)
class Ensemble:
    """Trees of one model as arrays [round, class, node]: node 1 is the root, 2n and 2n + 1 are the children of n."""

    classes: tuple[int, ...]
    start: np.ndarray  # raw score of each class before the first round
    feature: np.ndarray  # -1 in leaves
    threshold: np.ndarray  # larger values go right
    value: np.ndarray  # added by leaves, learning rate included
    gain: np.ndarray

    def raw(self, x: np.ndarray, chunk: int = 1024) -> np.ndarray:
        """Raw scores of the rows of ``x``, one column per class."""
        rounds, classes, nodes = self.feature.shape
        feature, threshold, value = (a.reshape(rounds * classes, nodes) for a in (self.feature, self.threshold, self.value))
        tree = np.arange(rounds * classes)[None, :]
        out = np.empty((len(x), classes))
        for at in range(0, len(x), chunk):
            part = x[at:at + chunk]
            node = np.ones((len(part), rounds * classes), np.int64)
            row = np.arange(len(part))[:, None]
            for _ in range(nodes.bit_length() - 2):
                f = feature[tree, node]
                right = part[row, np.maximum(f, 0)] > threshold[tree, node]
                node = np.where(f >= 0, 2 * node + right, node)
            out[at:at + chunk] = self.start + value[tree, node].reshape(len(part), rounds, classes).sum(axis=1)
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.raw(x))

    def probability_column(self, x: Column) -> Column:
        """Class probabilities of an array column, as an Arrow-batched function; null where ``x`` is null."""
        model, classes = self, len(self.classes)

        @F.arrow_udf("array<double>")
        def class_probabilities(column: pa.Array) -> pa.Array:
            given = column.drop_null()
            flat = given.flatten().to_numpy(zero_copy_only=False)
            p = model.probabilities(flat.reshape(len(given), -1)) if len(given) else np.zeros((0, classes))
            sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), classes, 0)
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(p.ravel()))
            return pc.if_else(column.is_valid(), lists, pa.scalar(None, lists.type))

        # Non-deterministic only for the planner: filters on the result stay above it, and it runs once per row.
        return class_probabilities.asNondeterministic()(x)

    def importances(self, features: int) -> np.ndarray:
        """Share of each feature in all reductions of squared error."""
        inner = self.feature >= 0
        gains = np.bincount(self.feature[inner], self.gain[inner], features)
        return gains / gains.sum() if gains.sum() > 0 else gains

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """All nodes in use; round -1 holds the start scores."""
        at = np.argwhere((self.feature >= 0) | (self.value != 0))
        r, c, n = at.T if len(at) else np.zeros((3, 0), int)
        nodes = pd.DataFrame({"round": r, "class": np.array(self.classes, int)[c], "node": n, "feature": self.feature[r, c, n],
                              "threshold": self.threshold[r, c, n], "value": self.value[r, c, n], "gain": self.gain[r, c, n]})
        start = pd.DataFrame({"round": -1, "class": self.classes, "node": 1, "feature": -1, "threshold": 0.0, "value": self.start, "gain": 0.0})
        depth = self.feature.shape[2].bit_length() - 2
        return spark.createDataFrame(pd.concat([start, nodes]), _TREE_SCHEMA).withColumns({
            "rounds": F.lit(self.feature.shape[0]), "depth": F.lit(depth)})

    @staticmethod
    def from_frame(df: DataFrame) -> Ensemble:
        nodes = df.toPandas()  # at most 2 ** (depth + 1) rows per class and round
        start = nodes[nodes["round"] < 0].sort_values("class")
        classes = tuple(int(c) for c in start["class"])
        shape = (int(nodes["rounds"].iloc[0]), len(classes), 2 << int(nodes["depth"].iloc[0]))
        feature, (threshold, value, gain) = np.full(shape, -1, np.int32), np.zeros((3, *shape))
        inner = nodes[nodes["round"] >= 0]
        at = (inner["round"].to_numpy(), np.searchsorted(classes, inner["class"]), inner["node"].to_numpy())
        for name, array in (("feature", feature), ("threshold", threshold), ("value", value), ("gain", gain)):
            array[at] = inner[name].to_numpy()
        return Ensemble(classes, start["value"].to_numpy(), feature, threshold, value, gain)


def softmax(raw: np.ndarray) -> np.ndarray:
    p = np.exp(raw - raw.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def bin_edges(df: DataFrame, x: str, features: int, bins: int = BINS) -> list[np.ndarray]:
    """Increasing cuts per feature at quantiles of all rows, ``bins - 1`` at most."""
    probs = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(x)[k], probs, ACCURACY).alias(f"q{k}") for k in range(features)]).first()
    return [np.unique(np.array(row[k] or [], float)) for k in range(features)]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """How many cuts lie below each value; NaN counts as below all."""
    return np.stack([np.searchsorted(e, np.where(np.isnan(c), -np.inf, c), side="left") for e, c in zip(edges, x.T)], axis=1).astype(np.uint8)


@dataclass
class _Grown:
    """Trees of a round or of several: arrays [tree, node], trees in the order of models and classes."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(trees: int, depth: int) -> _Grown:
        shape = (trees, 2 << depth)
        return _Grown(np.full(shape, -1, np.int32), np.zeros(shape, np.int32), np.zeros(shape))


def _nodes(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of every row in every tree after ``levels`` steps: an array [tree, row]."""
    n, width = bins.shape
    flat, row = bins.ravel(), np.arange(n) * width
    out = np.empty((len(feature), n), np.int64)
    for t in range(len(feature)):  # a tree at a time, so that its few nodes and one column of nodes stay in the cache
        node = np.ones(n, np.int64)
        for _ in range(levels):
            f = feature[t].take(node)
            right = flat.take(row + np.maximum(f, 0)) > cut[t].take(node)
            node = np.where(f >= 0, 2 * node + right, node)
        out[t] = node
    return out


def _filled(g: _Grown, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same trees with all leaves on the lowest level: a leaf above sends every row to the left."""
    feature, cut, value = np.maximum(g.feature, 0), np.where(g.feature >= 0, g.cut, 255), g.value.copy()
    for node in range(1, 1 << depth):
        leaf = g.feature[:, node] < 0
        value[leaf, 2 * node] = value[leaf, node]
    return feature, cut, value


def _added(bins: np.ndarray, raw: np.ndarray, kept: list[_Grown], depth: int) -> np.ndarray:
    """Raw scores with the trees of the rounds since the last written table."""
    if not kept:
        return raw
    n, width = bins.shape
    flat, row, out = bins.ravel(), np.arange(n) * width, np.array(raw.T, order="C")  # a copy, of a single row as well
    for g in kept:
        feature, cut, value = _filled(g, depth)
        for t in range(len(feature)):
            node = np.ones(n, np.int64)
            for _ in range(depth):
                right = flat.take(row + feature[t].take(node)) > cut[t].take(node)
                node += node
                node += right
            out[t] += value[t].take(node)
    return np.ascontiguousarray(out.T)


def _values(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """A column of binaries that hold ``width`` values each, as [row, value], without per-row objects."""
    if not len(column):
        return np.zeros((0, width), kind)
    first = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
    return np.frombuffer(column.buffers()[2], kind, len(column) * width, first).reshape(-1, width)


def _decoded(batch: pa.RecordBatch, features: int, trees: int) -> tuple[np.ndarray, ...]:
    return (_values(batch.column(0), np.uint8, features), batch.column(1).to_numpy(), batch.column(2).to_numpy(),
            _values(batch.column(3), np.float64, trees))


#: Tables of many rows hold them in blocks, a row of the table each: a single row costs more to read than to count.
_BLOCKS = "bins binary, y binary, fold binary, raw binary"


def _block(bins: np.ndarray, y: np.ndarray, held: np.ndarray, raw: np.ndarray) -> pa.RecordBatch:
    arrays = (np.ascontiguousarray(bins, np.uint8), y.astype(np.int32), held.astype(np.int32), np.ascontiguousarray(raw, float))
    return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], names=["bins", "y", "fold", "raw"])


def _unpacked(batch: pa.RecordBatch, features: int, trees: int) -> Iterator[tuple[np.ndarray, ...]]:
    for row in range(batch.num_rows):
        bins, y, held, raw = (batch.column(c)[row].as_buffer() for c in range(4))
        yield (np.frombuffer(bins, np.uint8).reshape(-1, features), np.frombuffer(y, np.int32), np.frombuffer(held, np.int32),
               np.frombuffer(raw).reshape(-1, trees))


def _gathered(parts: Iterable[tuple[np.ndarray, ...]], rows: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks put together to as many ``rows`` or somewhat more."""
    held: list[tuple[np.ndarray, ...]] = []
    for part in parts:
        held.append(part)
        if sum(len(h[1]) for h in held) >= rows:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held = []
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


@dataclass(frozen=True)
class _Shape:
    """Models (one per fold, and one of all rows), classes, features, bins and depth."""

    models: int
    width: int
    features: int
    bins: int
    depth: int

    @property
    def trees(self) -> int:
        return self.models * self.width

    def node_sums(self, sums: np.ndarray, k: int) -> np.ndarray:
        """[feature, bin, (rows, gradients, curvature)] of one node."""
        return np.ascontiguousarray(sums[:, k].T).reshape(self.features, self.bins, 3)


#: Of a node: tree and node, feature (-1: none), cut, gain, totals, totals left of the cut.
_Split = tuple[int, int, int, float, np.ndarray, np.ndarray]


def best_splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, gain, totals, totals on the left) of nodes from [node, feature, bin, (rows, gradients, curvature)].

    The gain is the reduction of the squared error of the gradients; the first feature and cut win a tie. Without a
    split that parts the rows and gains something, the feature is -1.
    """
    total = sums[:, 0].sum(axis=1)
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    n, m = left[..., 0], right[..., 0]
    good = (n > 0) & (m > 0)
    gap = left[..., 1] / np.where(good, n, 1) - right[..., 1] / np.where(good, m, 1)
    gain = np.where(good, n * m / np.maximum(n + m, 1) * gap * gap, 0.0).reshape(len(sums), -1)
    pick = np.arange(len(sums))
    if not gain.size:  # no node, or a single bin
        return np.full(len(sums), -1), np.zeros(len(sums), int), np.zeros(len(sums)), total, total
    at = gain.argmax(axis=1)
    won = gain[pick, at]
    some = won > 1e-6  # in squared units of the fixed-point gradients
    feature, cut = np.divmod(at, left.shape[2])
    return (np.where(some, feature, -1), np.where(some, cut, 0), np.where(some, won, 0.0), total,
            np.where(some[:, None], left[pick, feature, cut], total))


def _grow(shape: _Shape, rate: float, splits: Callable[[_Grown, int], Iterable[_Split]]) -> tuple[_Grown, np.ndarray]:
    """The trees of one round, and their gains by tree and node; ``splits`` gives those of a level."""
    grown, gain = _Grown.empty(shape.trees, shape.depth), np.zeros((shape.trees, 2 << shape.depth))

    def leaf(sums: np.ndarray) -> float:
        return rate * (shape.width - 1) / shape.width * sums[1] / sums[2] if sums[2] > 0 else 0.0

    for level in range(shape.depth):
        split = False
        for number, feature, cut, won, whole, left in splits(grown, level):
            tree, at = divmod(number, 1 << level)
            at += 1 << level
            if level == 0:
                grown.value[tree, at] = leaf(whole)
            if feature >= 0:
                split = True
                grown.feature[tree, at], grown.cut[tree, at], gain[tree, at] = feature, cut, won / UNIT ** 2
                grown.value[tree, 2 * at], grown.value[tree, 2 * at + 1] = leaf(left), leaf(whole - left)
        if not split:
            break
    return grown, gain


class _Rows:
    """Rows of one model in a task, and where they are in the trees of a round. ``start``: the raw scores by class that all
    rows begin with, or those of every row."""

    def __init__(self, shape: _Shape, bins: np.ndarray, y: np.ndarray, start: np.ndarray):
        self.shape, self.n = shape, len(y)
        self.columns = np.ascontiguousarray(bins.T)
        self.pairs = self.columns[::2].astype(np.uint16) * np.uint16(shape.bins)
        self.pairs[:shape.features // 2] += self.columns[1::2]
        self.flat, self.first = bins.ravel(), np.arange(self.n) * shape.features
        self.hits = np.eye(shape.width)[:, y]
        # A row per class: sums over a few columns would be slow.
        self.raw = np.repeat(start[:, None], self.n, axis=1) if start.ndim == 1 else np.ascontiguousarray(start.T)

    def begin(self) -> None:
        """Gradients and curvatures of a round; all rows are at the root."""
        share = np.exp(self.raw - self.raw.max(axis=0))
        share /= share.sum(axis=0)
        gap = self.hits - share
        size = np.abs(gap)
        self.gradient = np.rint(gap * UNIT)
        self.both = np.rint(size * (1 - size) * UNIT) + ROW_SHARE
        self.node = np.ones((self.shape.width, self.n), np.int64)

    def grow(self, rate: float) -> tuple[_Grown, np.ndarray]:
        """The next round."""
        self.begin()
        self.parents = np.zeros((3, 0, 0))
        grown, gain = _grow(self.shape, rate, self.splits)
        self.step(grown)
        for t in range(self.shape.width):
            self.raw[t] += grown.value[t].take(self.node[t])
        return grown, gain

    def step(self, grown: _Grown) -> None:
        """All rows of the nodes that were split last go to a child."""
        for t in range(self.shape.width):
            node, inner = self.node[t], grown.feature[t] >= 0
            number = np.arange(len(inner))
            at = np.maximum(grown.feature[t], 0).astype(np.int64).take(node)
            at += self.first
            right = self.flat.take(at) > np.where(inner, grown.cut[t], 255).astype(np.uint8).take(node)
            self.node[t] = np.where(inner, 2 * number, number).take(node) + right

    def splits(self, grown: _Grown, level: int) -> Iterator[_Split]:
        shape, nodes = self.shape, 1 << level
        out = np.zeros((3, shape.width, nodes, shape.features * shape.bins))
        if level:
            self.step(grown)
        for t in range(shape.width):
            if not level:
                self.add(out[:, t], t, None)
                continue
            at = np.maximum(self.node[t] - (nodes - 1), 0)  # 0: in a leaf above
            rows = np.bincount(at, minlength=nodes + 1)[1:].reshape(-1, 2)
            parent = np.flatnonzero(rows.any(axis=1))
            small = 2 * parent + rows.argmin(axis=1)[parent]
            slot = np.full(nodes + 1, -1)
            slot[small + 1] = np.arange(len(small))
            found = np.zeros((3, len(small), shape.features * shape.bins))
            self.add(found, t, slot.take(at))
            out[:, t, small] = found
            out[:, t, small ^ 1] = self.parents[:, t, parent] - found  # whole numbers: nothing is lost
        self.parents = out
        sums = out.reshape(3, shape.trees << level, shape.features * shape.bins)
        some = np.flatnonzero(sums[0].any(axis=1))
        best = best_splits(np.stack([shape.node_sums(sums, k) for k in some])) if len(some) else [[]] * 5
        yield from zip(some.tolist(), *best)

    def add(self, out: np.ndarray, t: int, slot: np.ndarray | None) -> None:
        """Adds the rows with a slot (0 or more; None: all rows, slot 0) to [(rows, gradients, curvature), slot, feature and bin]."""
        bins, slots, features = self.shape.bins, out.shape[1], self.shape.features
        sums = out.reshape(3, slots, features, bins)
        chosen = None if slot is None else np.flatnonzero(slot >= 0)
        count = self.n if chosen is None else len(chosen)
        # Two features at once, as long as their pairs of bins are not many beside the rows.
        paired = slots * bins * bins <= count
        columns, width = (self.pairs, bins * bins) if paired else (self.columns, bins)
        both, gradient = np.zeros((2, len(columns), slots * width))
        for a in range(0, count, CHUNK):
            if chosen is None:
                row = slice(a, a + CHUNK)
                one, two, key = self.both[t][row], self.gradient[t][row], None
            else:
                row = chosen[a:a + CHUNK]
                one, two, key = self.both[t].take(row), self.gradient[t].take(row), slot.take(row) * width
            for f, column in enumerate(columns):
                at = column[row] if key is None else key + column.take(row)
                both[f] += np.bincount(at, one, slots * width)
                gradient[f] += np.bincount(at, two, slots * width)
            if a // CHUNK % CHUNKS == CHUNKS - 1 or a + CHUNK >= count:
                rows = np.floor(both / ROW_SHARE)
                both -= rows * ROW_SHARE
                for total, part in zip(sums, (rows, gradient, both)):
                    part = part.reshape(len(columns), slots, width)
                    if not paired:
                        total += part.transpose(1, 0, 2)
                        continue
                    part = part.reshape(len(columns), slots, bins, bins)
                    total[:, ::2] += part.sum(axis=3).transpose(1, 0, 2)
                    total[:, 1::2] += part[:features // 2].sum(axis=2).transpose(1, 0, 2)
                both[:], gradient[:] = 0, 0


def _grow_in_tasks(state: DataFrame, shape: _Shape, rounds: int, rate: float, start: np.ndarray) -> tuple[list[_Grown], list[np.ndarray]]:
    """All rounds of a model in one task; as many tasks as models."""
    own = _Shape(1, shape.width, shape.features, shape.bins, shape.depth)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(batch.column(0).to_numpy(zero_copy_only=False)[0] if batch.num_rows else -1,
                  np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, shape.features),
                  batch.column(2).to_numpy()) for batch in batches]
        parts = [p for p in parts if p[0] >= 0]
        if not parts:
            return
        model = int(parts[0][0])
        rows = _Rows(own, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), start[model])
        for number in range(rounds):
            grown, gain = rows.grow(rate)
            arrays = (grown.feature, grown.cut, grown.value, gain)
            yield pa.RecordBatch.from_arrays(
                [pa.array([model], pa.int32()), pa.array([number], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]],
                names=["model", "round", "feature", "cut", "value", "gain"])

    model = F.explode(F.sequence(F.lit(0), F.lit(shape.models - 1))).alias("model")
    seen = state.select(model, "bins", "y", "fold").where("model <> fold").repartitionById(shape.models, F.col("model"))
    trees = seen.select("model", "bins", "y").mapInArrow(
        grow, "model int, round int, feature binary, cut binary, value binary, gain binary")
    # A model without rows has trees without nodes.
    done, gains = [_Grown.empty(shape.trees, shape.depth) for _ in range(rounds)], np.zeros((rounds, shape.trees, 2 << shape.depth))
    size = (shape.width, 2 << shape.depth)
    for r in trees.collect():  # a row per model and round
        g, part = done[r["round"]], slice(r["model"] * shape.width, (r["model"] + 1) * shape.width)
        g.feature[part] = np.frombuffer(r["feature"], np.int32).reshape(size)
        g.cut[part] = np.frombuffer(r["cut"], np.int32).reshape(size)
        g.value[part] = np.frombuffer(r["value"]).reshape(size)
        gains[r["round"], part] = np.frombuffer(r["gain"]).reshape(size)
    return done, list(gains)


class _Jobs:
    """The splits of a round by jobs, one per level: tasks add up the smaller child of every split."""

    def __init__(self, state: DataFrame, shape: _Shape):
        self.state, self.shape = state, shape
        self.parents, self.rows = np.zeros((3, 0, 0, 0)), np.zeros((shape.trees, 1))

    def splits(self, grown: _Grown, level: int) -> Iterator[_Split]:
        shape, nodes = self.shape, 1 << level
        rows = self.rows.reshape(shape.trees, -1, 2) if level else None
        small = np.zeros((shape.trees, nodes), bool)  # the nodes that are added up
        if level:
            tree, parent = np.nonzero(rows.any(axis=2))
            chosen = 2 * parent + rows.argmin(axis=2)[tree, parent]
            small[tree, chosen] = True
        else:
            small[:] = True
        out = np.zeros((3, shape.trees, nodes, shape.features * shape.bins))
        for number, sums in _added_up(self.state, shape, grown, level, small):
            out[:, number // nodes, number % nodes] = sums
        if level:
            out[:, tree, chosen ^ 1] = self.parents[:, tree, parent] - out[:, tree, chosen]  # whole numbers: nothing is lost
        self.parents = out
        sums = out.reshape(3, shape.trees << level, shape.features * shape.bins)
        some = np.flatnonzero(sums[0].any(axis=1))
        best = best_splits(np.stack([shape.node_sums(sums, k) for k in some])) if len(some) else [[]] * 5
        self.rows = np.zeros((shape.trees << level, 2))
        for number, feature, _, _, whole, left in zip(some.tolist(), *best):
            if feature >= 0:
                self.rows[number] = left[0], whole[0] - left[0]
        self.rows = self.rows.reshape(shape.trees, -1)
        yield from zip(some.tolist(), *best)


def _added_up(state: DataFrame, shape: _Shape, grown: _Grown, level: int, small: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(tree and node, [(rows, gradients, curvature), feature and bin]) of the nodes of a level that ``small`` tells; nodes
    without rows may be missing. One job: a row per node comes back."""
    width, nodes = shape.width, 1 << level
    own = _Shape(1, width, shape.features, shape.bins, shape.depth)
    size = (3, shape.features * shape.bins)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        blocks = (block for batch in batches for block in _unpacked(batch, shape.features, shape.trees))
        for bins, y, held, raw in _gathered(blocks, GATHERED):
            rows = _Rows(own, bins, y, raw[:, :width])
            for m in range(shape.models):
                left_out, part = np.flatnonzero(held == m), slice(m * width, (m + 1) * width)
                if not small[part].any():
                    continue
                rows.raw = np.ascontiguousarray(raw[:, part].T)
                rows.begin()
                for _ in range(level):
                    rows.step(_Grown(grown.feature[part], grown.cut[part], grown.value[part]))
                for t in range(width):
                    wanted = np.flatnonzero(small[m * width + t])
                    slot = np.full(nodes + 1, -1)  # place 0: in a leaf above
                    slot[wanted + 1] = np.arange(len(wanted))
                    found = np.zeros((3, len(wanted), size[1]))
                    at = None
                    if level or len(left_out):
                        at = slot.take(np.maximum(rows.node[t] - (nodes - 1), 0))
                        at[left_out] = -1
                    if len(wanted):
                        rows.add(found, t, at)
                    for k, node in enumerate(wanted.tolist()):
                        number = ((m * width + t) << level) + node
                        totals[number] = totals[number] + found[:, k] if number in totals else found[:, k]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([v.tobytes() for v in totals.values()], pa.binary())], names=["node", "sums"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}  # the nodes dealt to this task
        for batch in batches:
            for node, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                totals[node] = totals.get(node, 0) + np.frombuffer(sums).reshape(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([v.tobytes() for v in totals.values()], pa.binary())], names=["node", "sums"])

    # A node's sums have a fixed size, so a task for every core is enough; many more would cost more than their work.
    tasks = min(state.sparkSession.sparkContext.defaultParallelism, shape.trees << level)
    partial = state.mapInArrow(add_up, "node int, sums binary").repartition(tasks, "node")
    for r in partial.mapInArrow(meet, "node int, sums binary").collect():
        yield r["node"], np.frombuffer(r["sums"]).reshape(size)


def _tasks(rows: DataFrame, total: int) -> int:
    """Tasks of a level: one for every core where rows suffice for that, more where a task's rows would be many."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(min(cores, -(-total // LEVEL_ROWS)), -(-total // MOST_LEVEL_ROWS))


def boost(
    df: DataFrame, classes: Sequence[int], label: str, x: str, features: int, rounds: int, rate: float, depth: int,
    fold: str | None = None, folds: int = 0, bins: int = BINS, task_rows: int = TASK_ROWS,
) -> tuple[list[Ensemble], DataFrame]:
    """Models without each of the ``folds`` in turn, then one of all rows; and the rows' fold, label and, from the model
    that did not see them, prediction (null without folds). ``df`` is read a few times and should be a stored table."""
    shape = _Shape(folds + 1, len(classes), features, bins, depth)
    models, width, trees = shape.models, shape.width, shape.trees
    edges = bin_edges(df, x, features, bins)
    number = F.array_position(F.array(*[F.lit(int(c)) for c in classes]), F.col(label).cast("int")).cast("int") - 1
    rows = df.select(F.col(x).alias("x"), number.alias("y"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold")).where("y >= 0")
    counts, total = np.zeros((models, width)), 0
    for r in rows.groupBy("fold", "y").count().collect():  # a row per fold and class
        counts[[m for m in range(models) if m != r["fold"]], r["y"]] += r["count"]
        total += r["count"]
    start = np.log(np.maximum(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1), 1e-9))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = start.ravel().tobytes()
        for batch in batches:
            given = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.tobytes() for b in binned(given, edges)], pa.binary()), batch.column(1), batch.column(2),
                 pa.array([first] * batch.num_rows, pa.binary())], names=["bins", "y", "fold", "raw"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _gathered((_decoded(batch, features, trees) for batch in prepare(batches) if batch.num_rows), BLOCK_ROWS):
            yield _block(*block)

    in_tasks = total <= task_rows
    dealt = rows.repartition(_tasks(rows, total))
    state = materialise(dealt.mapInArrow(prepare, "bins binary, y int, fold int, raw binary") if in_tasks else dealt.mapInArrow(pack, _BLOCKS), "boosting")
    kept: list[_Grown] = []
    if in_tasks:
        done, gains = _grow_in_tasks(state, shape, rounds, rate, start)
        kept = done
    else:
        done, gains = [], []
        for step in range(rounds):
            grown, gain = _grow(shape, rate, _Jobs(state, shape).splits)
            done.append(grown)
            gains.append(gain)
            if step + 1 < rounds:
                before, state = state, materialise(_with_trees(state, grown, features, trees, depth), "boosting")
                discard(before)
            else:
                kept = [grown]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (_decoded(batch, features, trees) for batch in batches) if in_tasks else \
            (block for batch in batches for block in _unpacked(batch, features, trees))
        for b, y, held, raw in blocks:
            found, names = np.zeros(len(y), np.int64), np.array(classes)
            for m in np.unique(held[held >= 0]).tolist():  # a row meets only the trees of the model that did not see it
                rows, part = np.flatnonzero(held == m), slice(m * width, (m + 1) * width)
                own = [_Grown(g.feature[part], g.cut[part], g.value[part]) for g in kept]
                found[rows] = _added(b[rows], raw[rows, part], own, depth).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(held), pa.array(names[y], pa.int32()), pa.array(names[found], pa.int32(), mask=held < 0)], names=["fold", "label", "prediction"])

    judged = state.mapInArrow(judge, "fold int, label int, prediction int")
    cuts = np.full((features, bins), np.inf)
    for k, e in enumerate(edges):
        cuts[k, :len(e)] = e
    out = []
    for m in range(models):
        part = slice(m * width, (m + 1) * width)
        feature = np.stack([g.feature[part] for g in done]) if done else np.full((0, width, 2 << depth), -1, np.int32)
        cut = np.stack([g.cut[part] for g in done]) if done else feature
        value = np.stack([np.where(g.feature[part] < 0, g.value[part], 0.0) for g in done]) if done else np.zeros(feature.shape)
        out.append(Ensemble(tuple(classes), start[m], feature, np.where(feature >= 0, cuts[np.maximum(feature, 0), cut], 0.0), value,
                            np.stack([g[part] for g in gains]) if gains else np.zeros(feature.shape)))
    return out, judged


def _with_trees(state: DataFrame, grown: _Grown, features: int, trees: int, depth: int) -> DataFrame:
    """Blocks with the trees of a round added to the raw scores."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bins, y, held, raw in _unpacked(batch, features, trees):
                yield _block(bins, y, held, _added(bins, raw, [grown], depth))

    return state.mapInArrow(apply, _BLOCKS)
