"""Mixing sources to target weights by balanced sampling with the cube method.

Every source has a target number of words. A document is taken floor(target / source size) times for sure and once more
with the fraction as inclusion probability. The cube method draws these last copies so that the words and the number of
documents taken stay what the probabilities promise: it moves the probabilities of three documents along the direction
that changes neither total until one of them is 0 or 1, takes in the next, and goes on ("flight"). Large sources fly in
hash blocks; what a block leaves undecided flies again with what the other blocks left. The dozen documents that a
source has left at last land on the subset whose words come nearest to what they should add up to.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rotorlens.llm.common import small, stored, text_of, with_row_key, words

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
BLOCK = 5_000
#: Documents left for the landing.
LAND = 14


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, source_docs, target. ``sizes``: source, size.

    Sources in code-point order (null last) weigh ``weights`` in turn and share the total size; none gets more than
    ``max_copies`` times its own, and the excess is shared again by weight. That is one level for all sources below
    their limit, found by ordering the sources by limit per weight. These windows run over one row per source.
    """
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs")),
                    "sources", 1)
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = totals.select("*", number.alias("k")).select("*", F.array(*map(F.lit, weights))[
        F.col("k") % len(weights)].alias("w"))
    order = Window.orderBy(F.col("source_size") / F.col("w"), "k").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    limited = weighed.select(
        "*", (max_copies * F.col("source_size")).alias("limit"),
        F.sum("source_size").over(everything).alias("all_size"), F.sum("w").over(everything).alias("all_w"),
        F.coalesce(F.sum("source_size").over(order), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("w").over(order), F.lit(0)).alias("w_before"))
    level = (F.col("all_size") - max_copies * F.col("size_before")) / (F.col("all_w") - F.col("w_before"))
    fits = limited.select("*", level.alias("level")).withColumn(
        "common", F.min(F.when(F.col("level") * F.col("w") <= F.col("limit"), F.struct(
            (F.col("source_size") / F.col("w")).alias("o"), F.col("k"), F.col("level")))).over(everything)["level"])
    return fits.select("source", "source_size", "source_docs", F.least(
        F.col("limit").cast("double"), F.col("common") * F.col("w")).alias("target"))


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator, land: int = LAND) -> np.ndarray:
    """Probabilities after the flight: all but ``land`` are 0 or 1; the sums of p and of p * size are kept."""
    p = p.astype(float).copy()
    todo = [int(k) for k in np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9))]
    left, draws = len(todo), iter(rng.random(len(todo) + 1))
    s, queue = size.astype(float).tolist(), iter(todo)
    active = list(itertools.islice(queue, 3))
    q = p.tolist()
    while left > land and len(active) == 3:
        a, b, c = active
        u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - q[k]) / x if x > 0 else -q[k] / x for k, x in zip(active, u) if x)
        down = min(q[k] / x if x > 0 else (q[k] - 1) / x for k, x in zip(active, u) if x)
        step = up if next(draws) * (up + down) < down else -down
        keep = []
        for k, x in zip(active, u):
            q[k] += step * x
            if q[k] < 1e-9 or q[k] > 1 - 1e-9:
                q[k] = float(round(q[k]))
                left -= 1
            else:
                keep.append(k)
        active = keep + list(itertools.islice(queue, 3 - len(keep)))
    return np.array(q)


def landing(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """0 or 1 for the few documents left: of all choices the one whose words come nearest to what is promised, then
    the one whose number does."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if not len(open_):
        return p
    choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    off_words = np.abs(choices @ size[open_].astype(float) - (size[open_] * p[open_]).sum())
    off_docs = np.abs(choices.sum(axis=1) - p[open_].sum())
    out = p.copy()
    out[open_] = choices[np.lexsort((off_docs, np.round(off_words, 6)))[0]]
    return out


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, copies; one row per input row, and the words taken are copies * size.

    Draws are seeded by source and block and made in hash order of the ids, so reruns agree. Null text: size 0. Null
    source: a source of its own, last in order. Rows that repeat an id, null or not, are drawn each; those of one size
    are told apart by their place in the table. Nothing but empty texts: targets 0. Empty table: no rows. Columns not
    named here are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"),
                       F.lit(0).cast("long").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    return draws(rows, weights, max_copies, block).drop("_file", "_at")


def draws(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, block: int = BLOCK) -> DataFrame:
    """What ``mix`` returns, with the key of the row. ``rows``: doc_id, source, text, _file, _at (the row's key)."""
    sized = stored(rows.select("doc_id", F.col("source").cast("string").alias("source"),
                               F.size(words(text_of("text"))).cast("long").alias("size"), "_file", "_at"), "sizes")
    targets = stored(source_targets(sized, weights, max_copies), "targets", 1)
    repeated = stored(sized.groupBy(F.col("doc_id").alias("_id"), F.col("size").alias("_size")).agg(F.count("*").alias(
        "_n")).where("_n > 1"), "repeated")
    told = sized.join(small(repeated), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("size") == F.col("_size")), "left")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # Rows of one id and size have hashes of their own, so that they spread over the blocks of a source.
    own = F.when(F.col("_n").isNull(), F.xxhash64("doc_id", "size")).otherwise(F.xxhash64("doc_id", "size", "_file", "_at"))
    joined = told.join(small(targets.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", F.floor(ratio).alias("sure"),
        (ratio - F.floor(ratio)).alias("p"), own.alias("h"),
        F.ceil(F.col("source_docs") / block).cast("int").alias("blocks"), "_file", "_at")
    fields = ("doc_id {}, source string, size long, source_size long, target double, sure long, p double, h long, blocks int, "
              "_file long, _at long")
    schema = fields.format(sized.schema["doc_id"].dataType.simpleString())

    def fly(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "doc_id", "size", "_file", "_at"], kind="stable")
        size, name = rows["size"].to_numpy(), rows["source"].iloc[0]
        last = rows["blocks"].iloc[0] <= 1
        seed = [zlib.crc32(str(name).encode("utf-8", "surrogatepass")), int(rows["_block"].iloc[0]), len(rows)]
        p = flight(size, rows["p"].to_numpy(), np.random.default_rng(seed))
        return rows.assign(p=landing(size, p) if last else p).drop(columns="_block")

    most = targets.agg(F.max("source_docs")).first()[0] or 0
    open_, parts = joined, []
    while True:
        flown = stored(open_.select("*", F.pmod("h", "blocks").alias("_block")).groupBy("source", "_block").applyInPandas(
            fly, schema), "flown")
        blocks = -(-most // block)
        if blocks <= 1:
            parts.append(flown)
            break
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        parts.append(flown.where(~undecided))
        # A block leaves LAND documents at most; a source whose blocks were one has landed and leaves none.
        most = blocks * LAND
        open_ = flown.where(undecided).withColumn("blocks", F.ceil(F.col("blocks") * LAND / block).cast("int"))
    done = parts[0]
    for part in parts[1:]:
        done = done.unionByName(part)
    return done.select("doc_id", "source", "size", "source_size", "target", "_file", "_at",
                       (F.col("sure") + F.round("p").cast("long")).alias("copies"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it: rows that repeat an id and rows with a null id, too."""
    keyed = with_row_key(docs)
    copies = draws(keyed.select(F.col("_row")[doc_id].alias("doc_id"), F.col("_row")[source].alias("source"), F.col(
        "_row")[text].alias("text"), "_file", "_at"), **options).where("copies > 0").select("_file", "_at", "copies")
    return keyed.join(copies, ["_file", "_at"]).select(
        "_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
