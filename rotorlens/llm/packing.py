"""Packing documents into sequences of a fixed capacity with patterns.

The lengths of all pieces are counted by length, a table with one row per length. Patterns of a few documents that fill
a sequence exactly are enumerated from the lengths there are; a non-negative least-squares fit of the counts says how
often each is used; the numbers are rounded down; what is left is packed best-fit, still on counts: the longest length
left is completed with the longest that fit, and the pattern found is repeated as often as the counts allow. So the
plan takes the same effort for any number of documents. Spark then numbers the pieces within each length and looks up
the sequence and the place of each number.
"""

from __future__ import annotations

import zlib
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rotorlens.llm.common import small, stored
from rotorlens.llm.tokens import END_ID, encoded, id_lists

CAPACITY = 2048
#: Pieces of one length are numbered in hash blocks of about this many.
BLOCK = 20_000
#: Places of the middle documents tried per length, in patterns of three and four.
TRIES = 8


def exact_patterns(counts: np.ndarray, capacity: int, tries: int = TRIES) -> np.ndarray:
    """Rows of four lengths (zeros: fewer documents), longest first, that sum to the capacity and occur in ``counts``."""
    there = np.flatnonzero(counts[:capacity])
    found = []
    if len(there):
        pairs = there[counts[capacity - there] > 0]
        found.append(np.stack([pairs, capacity - pairs, 0 * pairs, 0 * pairs], 1))
        for share in (np.arange(tries) + 0.5) / tries / 2:
            rest = capacity - there
            middle = there[np.minimum(np.searchsorted(there, rest * share), len(there) - 1)]
            last = rest - middle
            good = (last > 0) & (counts[np.maximum(last, 0)] > 0)
            found.append(np.stack([there, middle, last, 0 * last], 1)[good])
            second = there[np.minimum(np.searchsorted(there, np.maximum(last, 1) // 2), len(there) - 1)]
            third = last - second
            good = (third > 0) & (counts[np.maximum(third, 0)] > 0)
            found.append(np.stack([there, middle, second, third], 1)[good])
    if not found:
        return np.zeros((0, 4), np.int64)
    return np.unique(-np.sort(-np.concatenate(found), axis=1), axis=0)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: repeats of the patterns whose lengths come nearest to the counts.

    Accelerated projected gradient; the matrix is the four lengths of each pattern. The step is from its norms.
    """
    size = len(counts)
    use = patterns > 0
    weight = np.zeros(size)
    weight[1:] = 1.0
    goal = counts.astype(float)

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(patterns.ravel(), np.repeat(x, patterns.shape[1]) * use.ravel(), size) * weight

    per_length = forward(np.ones(len(patterns)))
    # Column-scaled: each pattern's step follows how crowded its lengths are.
    step = 1 / np.maximum((per_length[patterns] * use).sum(axis=1), 1e-9)
    x = np.zeros(len(patterns))
    y, t = x.copy(), 1.0
    for _ in range(rounds):
        gap = forward(y) - goal
        new = np.maximum(0, y - step * (gap[patterns] * use).sum(axis=1))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan_patterns(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths, longest first; repeats) using every count up. ``counts[n]``: pieces of length n, to the capacity."""
    left = counts.astype(np.int64).copy()
    plan = []
    if left[capacity]:
        plan.append(([capacity], int(left[capacity])))
        left[capacity] = 0
    patterns = exact_patterns(left, capacity)
    if len(patterns):
        repeats = np.floor(fit_repeats(patterns, left[:capacity + 1]) + 1e-6).astype(np.int64)
        for row, wanted in sorted(zip(patterns.tolist(), repeats.tolist()), key=lambda x: -x[1]):
            lengths = [n for n in row if n]
            times = min([wanted, *(int(left[n]) // lengths.count(n) for n in lengths)])
            if times > 0:
                plan.append((lengths, times))
                np.subtract.at(left, lengths, times)
    while len(there := np.flatnonzero(left)):
        lengths, room, used = [int(there[-1])], capacity - int(there[-1]), {int(there[-1]): 1}
        while room > 0:
            at = int(np.searchsorted(there, room, "right")) - 1
            while at >= 0 and left[there[at]] <= used.get(int(there[at]), 0):
                at -= 1
            if at < 0:
                break
            n = int(there[at])
            more = min(room // n, int(left[n]) - used.get(n, 0))
            lengths += [n] * more
            used[n] = used.get(n, 0) + more
            room -= more * n
        times = min(int(left[n]) // k for n, k in used.items())
        plan.append((lengths, times))
        for n, k in used.items():
            left[n] -= k * times
    return plan


def slots(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """length, first number, end, first sequence, documents of that length per sequence, offset of the first of them."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            per = lengths.count(n)
            start = taken.get(n, 0)
            rows.append((n, start, start + per * times, sequence, per, offset))
            taken[n] = start + per * times
            offset += per * n
        sequence += times
    return rows


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): documents cut into pieces. Only documents longer than the
    capacity are cut; all their pieces but the first are full. Null and empty texts are the end id alone."""

    def finish(keys: pa.Array, coded: list[bytes]) -> pa.RecordBatch:
        row, piece, start, crc, parts = [], [], [], [], []
        for k, ids in enumerate(coded):
            ids, at, number = memoryview(ids), 0, 0
            while at < len(ids):
                size = 4 * capacity if number else (len(ids) // 4 - 1) % capacity * 4 + 4
                row.append(k), piece.append(number), start.append(at // 4), parts.append(ids[at:at + size])
                at, number = at + size, number + 1
        crc = [zlib.crc32(x) for x in parts]
        columns = {"doc_id": keys.take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()),
                   "start": pa.array(start, pa.int64()), "length": pa.array([len(x) // 4 for x in parts], pa.int64()),
                   "ids_crc32": pa.array(crc, pa.int64())}
        if with_ids:
            columns["ids"] = id_lists(parts)
        return pa.RecordBatch.from_pydict(columns)

    return encoded(docs, tokenizer, finish, "piece int, start long, length long, ids_crc32 long" + (
        ", ids array<int>" if with_ids else ""), doc_id, text, end_id)


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32, any others) with sequence_id and offset.

    Pieces are numbered within their length in hash blocks, shifted by the counts of the blocks before, so that one
    length with most of the pieces is spread over many tasks. Equal rows are interchangeable. Empty table: no rows.
    """
    held = stored(pieces, "pieces")
    lengths = held.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in lengths:
        counts[r.length] = r.n
    plan = slots(plan_patterns(counts, capacity))
    blocks = max(1, int(-(-counts.max() // block)))
    cut = held.select("*", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)).cast("int").alias("_block"))
    sizes = cut.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    shift = sizes.select(F.col("length").alias("_l"), F.col("_block").alias("_b"), (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_block")) - F.col("_n")).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("length", "_block").orderBy("doc_id", "piece", "start", "ids_crc32"))
    numbered = cut.select("*", inside.cast("long").alias("_k"))
    numbered = numbered.join(small(stored(shift, "shifts", 1)), (F.col("length") == F.col("_l")) & (
        F.col("_block") == F.col("_b"))).select(*held.columns, (F.col("_k") + F.col("_shift") - 1).alias("_number"))
    # A few slots per pattern; patterns are bounded by the capacity (enumerated per length), whatever the data.
    places = F.broadcast(held.sparkSession.createDataFrame(
        pd.DataFrame(plan, columns=["_length", "_first", "_end", "_sequence", "_per", "_offset"], dtype="int64"),
        "_length long, _first long, _end long, _sequence long, _per long, _offset long"))
    step = F.col("_number") - F.col("_first")
    found = numbered.join(places, (F.col("length") == F.col("_length")) & (F.col("_number") >= F.col("_first")) & (
        F.col("_number") < F.col("_end")))
    return found.select(*held.columns, (F.col("_sequence") + F.floor(step / F.col("_per"))).alias("sequence_id"),
                        (F.col("_offset") + step % F.col("_per") * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
                   end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Rows that repeat an id are packed
    each; null ids too. Columns not named here are ignored."""
    return pack(token_pieces(docs, tokenizer, capacity, doc_id, text, end_id), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences, from placed pieces with their ids (``token_pieces(with_ids=True)``).
    A group holds at most ``capacity`` ids."""
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(
        "offset", "ids"))), lambda p: p["ids"])).alias("ids"))
