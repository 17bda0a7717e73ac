"""SimHash near-duplicates, found exactly with vantage-point trees.

Fingerprints of 64 bits that differ in at most three bits differ in at most one bit in one of their halves. So each
half has a vantage-point tree with search radius 1 (``radius`` in general): on every level a vantage point taken from
the data splits the fingerprints into those within the level's median distance and those beyond it. By the triangle
inequality two halves within the radius have distances to the vantage point that differ by the radius at most, so only
fingerprints near the median ring can have partners across it. Those inside are copied to the outer shard as visitors
("boundary overlap", one-sided); all other branches are pruned. A leaf is a Spark group; it compares its residents with
all of its rows bit by bit on the whole fingerprints, so the links are exact. The levels share their vantage point
among all nodes, so that the tree takes a few dozen numbers at any depth and the depth can follow the data.

Equal fingerprints are folded first. A leaf that holds a dense group is cut into hash blocks that meet pairwise, in
tasks of bounded size. A leaf emits a spanning forest of its links, not all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlens.llm.common import parts_for, stored, with_row_key
from rotorlens.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
LEAF = 2000
BLOCK = 8000


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text as a signed 64-bit number."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [digest(joined[a:b], seed) for a, b in zip(
            starts[:len(tokens) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, fp (signed 64 bits) and the columns to keep, one row per input row, from whole texts."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle, seed) for x in texts], dtype="int64")

    return docs.select(F.col(doc_id).alias("doc_id"), F.pandas_udf(of, "long")(F.col(text)).alias("fp"), *keep)


def _half(fp: np.ndarray, tree: int) -> np.ndarray:
    return (fp.view(np.uint64) >> np.uint64(32 * tree)) & np.uint64(0xFFFFFFFF)


def vantage_points(fps: DataFrame, levels: int) -> list[tuple[list[int], list[int]]]:
    """Per tree its levels' vantage points (taken from the data in hash order) and median distances."""
    if not levels:
        return [([], []), ([], [])]
    drawn = np.array([r.fp for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(8 * levels).collect()], np.int64)
    trees = []
    for tree in (0, 1):
        points: list[int] = []
        for least in (8, 4, 1, 0):  # apart from each other where the data have such points
            for x in _half(drawn, tree).tolist():
                if len(points) < levels and all((x ^ y).bit_count() >= least for y in points):
                    points.append(x)
        trees.append(points[:levels])
    half = [F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32)]
    medians = fps.agg(*[F.percentile_approx(F.bit_count(half[t].bitwiseXOR(F.lit(p))), 0.5).alias(f"m{t}_{k}")
                        for t in (0, 1) for k, p in enumerate(trees[t])]).first()
    return [(points, [medians[f"m{t}_{k}"] for k in range(len(points))]) for t, points in enumerate(trees)]


def route(fp: np.ndarray, points: list[int], medians: list[int], tree: int, radius: int
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, leaf and whether it is a visitor there, for every leaf that a row belongs to."""
    row, leaf, visitor = np.arange(len(fp)), np.zeros(len(fp), np.int64), np.zeros(len(fp), bool)
    half = _half(fp, tree)
    for point, median in zip(points, medians):
        d = np.bitwise_count(half ^ np.uint64(point)).astype(np.int64)[row]
        outside = d > median
        near = (d > median - radius) & (d <= median + radius)
        also = near & (visitor | ~outside)  # residents inside visit the outer side; visitors visit both
        leaf = leaf * 2 + outside
        row = np.concatenate([row, row[also]])
        leaf = np.concatenate([leaf, leaf[also] ^ 1])
        visitor = np.concatenate([visitor, np.ones(int(also.sum()), bool)])
    return row, leaf, visitor


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each pointing at a root) after the edges a-b are joined."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return label
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]


def link_leaf(fp: np.ndarray, left: np.ndarray, right: np.ndarray, max_bits: int) -> np.ndarray:
    """Roots of the links between the rows marked left and those marked right."""
    label = np.arange(len(fp))
    bits, lefts, rights = fp.view(np.uint64), np.flatnonzero(left), np.flatnonzero(right)
    step = max(1, 1_000_000 // max(1, len(rights)))
    for at in range(0, len(lefts), step):
        rows = lefts[at:at + step]
        i, j = np.nonzero(np.bitwise_count(bits[rows][:, None] ^ bits[rights][None, :]) <= max_bits)
        i, j = rows[i], rights[j]
        label = merge(label, i[i != j], j[i != j])
    return label


def links(nodes: DataFrame, max_bits: int = MAX_BITS, leaf_size: int = LEAF, block: int = BLOCK) -> DataFrame:
    """a, b: edges that join exactly the nodes reachable from each other. ``nodes``: node, fp (distinct fingerprints)."""
    radius = max_bits // 2
    levels = min(40, max(0, math.ceil(math.log2(max(1, nodes.count()) / leaf_size))))
    trees = vantage_points(nodes, levels)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp, node = batch["fp"].to_numpy(np.int64), batch["node"].to_numpy(np.int64)
            for tree, (points, medians) in enumerate(trees):
                row, leaf, visitor = route(fp, points, medians, tree, radius)
                yield pd.DataFrame({"tree": tree, "leaf": leaf, "node": node[row], "fp": fp[row], "visitor": visitor})

    routed = stored(nodes.select("node", "fp").repartition(parts_for(nodes)).mapInPandas(
        spread, "tree int, leaf long, node long, fp long, visitor boolean"), "routed")
    sizes = routed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > block).select(
        "tree", "leaf", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = (routed.join(sizes, ["tree", "leaf"], "left")
           .select("*", F.coalesce(own, F.lit(0)).alias("own"))
           .select("*", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("other"))
           .select("tree", "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "fp",
                   F.when(F.col("blocks").isNull(), ~F.col("visitor")).otherwise(
                       F.col("own") <= F.col("other")).alias("left"),
                   (F.col("blocks").isNull() | (F.col("own") >= F.col("other"))).alias("right")))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        node = rows["node"].to_numpy(np.int64)
        label = link_leaf(rows["fp"].to_numpy(np.int64), rows["left"].to_numpy(bool), rows["right"].to_numpy(bool),
                          max_bits)
        tied = label != np.arange(len(label))
        return pd.DataFrame({"a": node[tied], "b": node[label[tied]]})

    return met.repartition(parts_for(met), "tree", "leaf", "i", "j").groupBy("tree", "leaf", "i", "j").applyInPandas(
        compare, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, fp, component_id (the smallest id reachable over links) and the columns to keep, one row per input row.

    Texts without words, null or empty, have fingerprint zero and are linked like any other. Rows with a null id link
    nothing; they get the component of their fingerprint, null if nobody else has it. Rows that repeat an id are
    fingerprinted each. Empty table: no rows. Columns not named here are ignored.
    """
    prints = stored(fingerprints(docs, doc_id, text, shingle, keep=keep), "fingerprints")
    nodes = stored(prints.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("node")), "prints")
    # A repeated id with two texts is one node of two fingerprints: its rows are reachable from each other by id.
    components = connected_components(links(nodes, max_bits))
    labelled = nodes.join(components, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(labelled, "fp", "left").select("doc_id", "fp", "component_id", *keep)


def fingerprint_hex(column: str = "fp"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def deduped_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group: one that has the smallest id, however often that is stored.

    Rows with a null id go where their fingerprint has a group; where it has none, one row of each fingerprint stays.
    """
    keyed = with_row_key(docs)
    found = near_duplicates(keyed.select(F.col("_row")[doc_id].alias("doc_id"), F.col("_row")[text].alias("text"), "_file", "_at"),
                            keep=("_file", "_at"), **options)
    # Counted map-side: a group with very many rows is one row per task here.
    chosen = found.where(F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))).groupBy(
        "component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("_fp")).agg(
            F.min(F.struct("_file", "_at")).alias("k")).select("k._file", "k._at")
    return keyed.join(chosen, ["_file", "_at"], "left_semi").select("_row.*")
