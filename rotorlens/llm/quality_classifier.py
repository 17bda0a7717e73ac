"""Quality classifier: a factorisation machine on hashed words, structure statistics and metadata.

Score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j). The pairs are summed in linear time, as half the
difference of the squared sum and the sum of squares of every factor. Words are hashed into a fixed number of slots;
structure statistics are shares and logarithms, each also as a coarse step, so that pairs of steps can act together.
The model is fitted on a bounded sample of labelled documents (``MAX_ROWS``) and is a fixed few hundred KB, so it
travels to every task; all documents are scored in one pass over their whole texts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlens.llm.common import stored

#: At most this many labelled rows are used to fit.
MAX_ROWS = 6000
SLOTS = 1 << 13
FACTORS = 6
#: Gradient steps of ``BATCH`` rows, whatever the number of rows.
STEPS_OF_FIT = 1200
BATCH = 64
THRESHOLD = 0.3
STEPS = 8
STATISTICS = ("symbols", "bars", "bangs", "upper", "digits", "distinct", "repeats", "line_repeats", "word_length",
              "words", "lines", "characters")


def statistics(body: bytes, tokens: list[bytes], distinct: int) -> list[float]:
    """Numbers in 0..1 that describe a text's structure (and its size, the metadata). All 0 for an empty text."""
    n = len(tokens)
    if not n:
        return [0.0] * len(STATISTICS)
    without = lambda chars: len(body) - len(body.translate(None, chars))
    lines = body.split(b"\n")
    return [
        min(1.0, without(b"#*$%&<>") / n / 2), min(1.0, without(b"|") / n * 2), min(1.0, without(b"!") / n),
        min(1.0, without(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / n / 4), min(1.0, without(b"0123456789") / n),
        distinct / n, min(1.0, sum(map(eq, tokens, tokens[1:])) / n), 1 - len(set(lines)) / len(lines),
        min(1.0, len(body) / n / 20), min(1.0, math.log1p(n) / 12), min(1.0, math.log1p(len(lines)) / 10),
        min(1.0, math.log1p(len(body)) / 14)]


class Features:
    """Feature numbers and values of a text: hashed words first, then the statistics, then their steps."""

    size = SLOTS + len(STATISTICS) * (1 + STEPS)

    def __init__(self) -> None:
        self._slot: dict[bytes, int] = {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        body = (text or "").encode("utf-8", "surrogatepass")
        tokens = body.split()
        counts = Counter(tokens)
        slot = self._slot
        if len(slot) > 500_000:
            slot.clear()
        words = []
        for token in counts:
            k = slot.get(token)
            if k is None:
                k = zlib.crc32(token) % SLOTS
                if len(token) < 64:
                    slot[token] = k
            words.append(k)
        numbers = np.array(statistics(body, tokens, len(counts)))
        steps = np.minimum((numbers * STEPS).astype(np.int64), STEPS - 1)
        kinds = np.arange(len(STATISTICS))
        hashed = np.fromiter(words, np.int64, len(words))
        weight = np.full(len(hashed), 1 / math.sqrt(max(1, len(hashed))), np.float32)
        return (np.concatenate([hashed, SLOTS + kinds, SLOTS + len(STATISTICS) + kinds * STEPS + steps]),
                np.concatenate([weight, numbers, np.full(len(kinds), 0.5)]).astype(np.float32))


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[index] * value[:, None]
        total = v.sum(axis=0)
        return float(self.bias + self.weights[index] @ value + 0.5 * (total @ total - (v * v).sum()))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, factors: int = FACTORS, steps: int = STEPS_OF_FIT,
        rate: float = 0.02, decay: float = 1e-3, batch: int = BATCH, seed: int = 7) -> Machine:
    """Adam on the logistic loss with decay. One class only: a constant score for it. No rows: 0.5 for all."""
    size = Features.size
    rng = np.random.default_rng(seed)
    share = float(np.mean(labels)) if len(labels) else 0.5
    bias = math.log((share + 1e-3) / (1 - share + 1e-3))
    if not len(labels) or share in (0.0, 1.0):
        return Machine(bias, np.zeros(size, np.float32), np.zeros((size, factors), np.float32))
    table = np.zeros((size, factors + 1))
    table[:, 1:] = rng.normal(0, 0.05, (size, factors))
    first, second = np.zeros_like(table), np.zeros_like(table)
    lengths = np.array([len(r[0]) for r in rows])
    step = 0
    while step < steps:
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            part = order[at:at + batch]
            index = np.concatenate([rows[k][0] for k in part])
            value = np.concatenate([rows[k][1] for k in part]).astype(float)
            owner = np.repeat(np.arange(len(part)), lengths[part])
            starts = np.concatenate(([0], np.cumsum(lengths[part])[:-1]))
            own = table[index]
            scaled = own * value[:, None]
            sums = np.add.reduceat(scaled, starts)
            squares = np.add.reduceat(scaled[:, 1:] ** 2, starts)
            margin = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - squares.sum(1))
            gap = (1 / (1 + np.exp(-margin)) - labels[part]) / len(part)
            pull = np.empty_like(own)
            pull[:, 0] = value
            pull[:, 1:] = value[:, None] * (sums[owner, 1:] - scaled[:, 1:])
            pull *= gap[owner][:, None]
            touched, where = np.unique(index, return_inverse=True)
            gradient = np.stack([np.bincount(where, pull[:, c], len(touched)) for c in range(factors + 1)], 1)
            gradient += decay * table[touched]
            step += 1
            first[touched] = 0.9 * first[touched] + 0.1 * gradient
            second[touched] = 0.99 * second[touched] + 0.01 * gradient ** 2
            table[touched] -= rate * (first[touched] / (1 - 0.9 ** step)) / (
                np.sqrt(second[touched] / (1 - 0.99 ** step)) + 1e-8)
            bias -= rate * float(gap.sum())
    return Machine(bias, table[:, 0].astype(np.float32), table[:, 1:].astype(np.float32))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                  max_rows: int = MAX_ROWS) -> DataFrame:
    """text, label of a sample of at most ``max_rows`` labelled documents outside the held-out fifth, in hash order.

    An id labelled more than once counts with its smallest label; null ids and labels are left out, and an id that
    several rows of ``docs`` carry is used once.
    """
    chosen = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
              .groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("int").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    texts = docs.select(F.col(doc_id).alias("_key"), F.col(text).alias("_text"))
    # The sample has ``max_rows`` pairs of numbers at most.
    return (texts.join(F.broadcast(chosen), F.col("_key") == F.col("_id")).groupBy("_id")
            .agg(F.min("_text").alias("text"), F.first("_label").alias("label")))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          max_rows: int = MAX_ROWS, **options) -> Machine:
    """Features are made by tasks; the driver gets the numbers of at most ``max_rows`` documents."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            found = [features.of(x) for x in batch["text"]]
            yield pd.DataFrame({"id": batch["_id"], "label": batch["label"],
                                "index": [i.astype("<i4").tobytes() for i, _ in found],
                                "value": [v.astype("<f4").tobytes() for _, v in found]})

    rows = training_rows(docs, labels, doc_id, text, label, max_rows)
    kind = rows.schema["_id"].dataType.simpleString()
    described = stored(rows.mapInPandas(describe, f"id {kind}, label int, index binary, value binary"), "labelled")
    held = described.toPandas().sort_values("id", kind="stable")
    sparse = [(np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(v, "<f4")) for i, v in zip(
        held["index"], held["value"])]
    return fit(sparse, held["label"].to_numpy(float), **options)


def score(docs: DataFrame, machine: Machine, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text in the column ``name``; null counts as empty."""
    # Numbers and arrays of a fixed size. Broadcasts name classes instead of carrying them, so workers would need ours.
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.factors))

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, model = Features(), Machine(*shared.value)
        for texts in batches:
            margins = np.array([model.margin(*features.of(x)) for x in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(margins, -30, 30))))

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(name, F.pandas_udf(of, "double")(F.col(text)))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
             threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per input row. Null ids: held_out is null. Empty table: no rows."""
    machine = train(docs, labels, doc_id, text, label, max_rows)
    scored = score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), machine)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted_documents(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD,
                       **options) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``."""
    machine = train(docs, labels, text=text, **options)
    rows = score(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), machine, "_text", "_score")
    return rows.where(F.col("_score") >= threshold).select("_row.*")
