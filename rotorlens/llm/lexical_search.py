"""Ranked lexical search with hashed max-sketches.

A term's impact on a document's score grows with its frequency there, and no two documents share anything else of it, so
a document is sketched by frequencies: every term names a place in each of two rows, and a place keeps the largest
frequency of the terms that fall there. A term's frequency is at most the smaller of its two places, and 0 where one of
them is empty; with the collection's size known, that gives an upper bound of its impact and, summed over the terms of a
query, of the score. Sketches hold no corpus statistics, so documents can be added without folding the others again.

A search reads the sketches once for a block of queries. Each task bounds its documents for all queries of the block,
a slice of documents at a time, and goes through them by descending bound: whole texts are split and scored exactly,
until the bound falls below the query's k-th best exact score so far. Every task hands on k documents a query at most,
and the best k of those are the result, the same as without sketches.

Null and empty texts hold no terms: they don't count as documents and are never found. Queries without terms find
nothing. Rows that repeat an id are documents of their own (equal ids: either order gives the same rows); null ids come last in ties.
Queries that repeat an item id are searched each; extra columns are not looked at.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rotorlens.llm.common import small, stored
from rotorlens.llm.hashing import word_table, words_of
from rotorlens.llm.tokens import slices

#: Bytes that part terms: ASCII without letters and digits.
BREAKS = ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
BEST = 20
#: Places in each row of a sketch per distinct term, before rounding up to a power of two.
ROOM = 2
#: A place that holds this frequency stands for all higher ones.
TOP = 255
#: Bytes of query texts that are searched in one reading of the sketches.
BLOCK_BYTES = 4 << 20
SLICE = 1 << 20
DOCS_AT_ONCE = 256


def places(digest: np.ndarray, width: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """A term's places in the two rows of a sketch of ``width`` places each."""
    mask = np.asarray(width, np.uint64) - np.uint64(1)
    return ((digest >> np.uint64(14)) & mask).astype(np.int64), ((digest >> np.uint64(39)) & mask).astype(np.int64)


def fold(texts: list[str | None], table: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, width of its sketch, and all sketches, one after another."""
    words, n = words_of(texts, table)
    digest = words.xxh64()
    # Terms of a text that agree in 50 bits are taken for one: their frequencies add up, which keeps the bound. The other
    # 14 bits number the texts.
    text_bits = np.uint64(50)
    key = np.sort((np.repeat(np.arange(len(n), dtype=np.uint64), n) << text_bits) | (digest >> np.uint64(14)))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    text = (key[first] >> text_bits).astype(np.int64)
    digest = (key[first] & np.uint64((1 << 50) - 1)) << np.uint64(14)
    distinct = np.bincount(text, minlength=len(n))
    width = 1 << np.maximum(5, np.ceil(np.log2(np.maximum(1, ROOM * distinct)))).astype(np.int64)
    base = np.concatenate(([0], np.cumsum(2 * width)))
    sketches = np.zeros(base[-1], np.uint8)
    one, two = places(digest, width[text])
    frequency = np.minimum(count, TOP).astype(np.uint8)
    np.maximum.at(sketches, base[text] + one, frequency)
    np.maximum.at(sketches, base[text] + width[text] + two, frequency)
    return n, width, sketches


def sketch_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, width, sketch, text of every document with a term. Stored: one reading of the texts."""
    table = word_table(BREAKS)
    kind = docs.schema[doc_id].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE, 1 << 14):
                texts = batch.column(1).slice(a, b - a)
                n, width, sketches = fold(texts.to_pylist(), table)
                ends = pa.array(np.concatenate(([0], np.cumsum(2 * width))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), pa.array(width),
                     pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, ends.buffers()[1], pa.py_buffer(sketches.tobytes())]), texts],
                    names=["doc_id", "n", "width", "sketch", "text"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    made = rows.mapInArrow(describe, f"doc_id {kind}, n long, width long, sketch binary, text string")
    return stored(made.where("n > 0"), "sketches", files=1 << 20)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(word_table(BREAKS)).split()


def document_frequencies(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """In how many documents each of the terms of a block of queries occurs."""
    shared = index.sparkSession.sparkContext.broadcast(terms)  # a block of query texts at most
    table = word_table(BREAKS)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, found = set(shared.value), Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(asked.intersection(text.encode("utf-8", "surrogatepass").translate(table).split()))
        yield pd.DataFrame({"term": list(found.keys()), "n": np.array(list(found.values()), np.int64)})

    sums = index.select("text").mapInPandas(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {bytes(r.term): r.n for r in sums.collect()}  # a row per term of the block


class Queries:
    """A block of queries: distinct terms with digests, and each query's terms as numbers with their weights."""

    def __init__(self, items: list[tuple[int, list[bytes]]], documents: int, frequencies: dict[bytes, int]):
        weight = lambda df: math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        known = {t: k for k, t in enumerate(t for t in frequencies)}
        self.terms = list(known)
        self.keys: list[int] = []
        self.lists: list[list[tuple[bytes, int]]] = []
        flat, weights, starts = [], [], []
        for key, terms in items:
            times = Counter(t for t in terms if t in known)
            if times:
                starts.append(len(flat))
                self.keys.append(key)
                self.lists.append([(t, weight(frequencies[t]) * c) for t, c in times.items()])
                flat += [known[t] for t in times]
                weights += [w for _, w in self.lists[-1]]
        self.flat, self.weights, self.starts = np.array(flat, np.int64), np.array(weights, float), np.array(starts, np.int64)

    def digests(self) -> np.ndarray:
        spans, _ = words_of([b" ".join(self.terms).decode("utf-8", "surrogatepass")], word_table(BREAKS))
        return spans.xxh64()

    def bounds(self, sketches: np.ndarray, lengths: np.ndarray, m: np.ndarray, digest: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, one row per document; ``sketches`` has one of the same width per row.

        All numbers are integers below 2**53, so sums of doubles are exact.
        """
        width = sketches.shape[1] // 2
        one, two = places(digest, width)
        most = np.minimum(sketches[:, one], sketches[:, width + two]).astype(float)
        np.copyto(most, lengths[:, None], where=most == TOP)
        impact = np.floor(1_000_000_000 * most / (1000 * most + 12 * m[:, None]))
        return np.add.reduceat(impact[:, self.flat] * self.weights, self.starts, axis=1)


def exact_score(found: Counter, terms: list[tuple[bytes, int]], m: int) -> int:
    total = 0
    for term, weight in terms:
        tf = found.get(term)
        if tf:
            total += weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
    return total


def _search_block(index: DataFrame, items: list[tuple[int, list[bytes]]], documents: int, terms: int, best: int) -> DataFrame:
    """item (number), doc_id, score: at most ``best`` rows a query from each task."""
    asked = sorted({t for _, x in items for t in x})
    queries = Queries(items, documents, document_frequencies(index, asked))
    kind = index.schema["doc_id"].dataType.simpleString()
    shared = index.sparkSession.sparkContext.broadcast(  # a block of query texts at most
        (queries.terms, queries.keys, queries.lists, queries.flat, queries.weights, queries.starts))
    table = word_table(BREAKS)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Queries([], 0, {})
        mine.terms, mine.keys, mine.lists, mine.flat, mine.weights, mine.starts = shared.value
        digest = mine.digests()
        tops: list[list[tuple[int, bool, object]]] = [[] for _ in mine.keys]  # best first: -score, id is null, id
        for batch in batches:
            ids, n, width = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            m = 75 + (25 * n * documents) // terms
            for w in np.unique(width).tolist():
                group = np.flatnonzero(width == w)
                for at in range(0, len(group), DOCS_AT_ONCE):
                    rows = group[at:at + DOCS_AT_ONCE]
                    sketches = np.frombuffer(b"".join(batch.column(3).take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), 2 * w)
                    bounds = mine.bounds(sketches, n[rows], m[rows], digest)
                    split: dict[int, Counter] = {}
                    for q, top in enumerate(tops):
                        limit = -top[-1][0] if len(top) == best else 1
                        hopeful = np.flatnonzero(bounds[:, q] >= limit)
                        for k in hopeful[np.argsort(-bounds[hopeful, q], kind="stable")].tolist():
                            if len(top) == best and bounds[k, q] < -top[-1][0]:
                                break
                            row = int(rows[k])
                            found = split.get(row)
                            if found is None:
                                text = batch.column(4)[row].as_py()
                                found = split[row] = Counter(text.encode("utf-8", "surrogatepass").translate(table).split())
                            score = exact_score(found, mine.lists[q], int(m[row]))
                            doc = ids[row].as_py()
                            entry = (-score, doc is None, 0 if doc is None else doc)
                            if score > 0 and (len(top) < best or entry < top[-1]):
                                bisect.insort(top, entry)
                                del top[best:]
        item = [key for key, top in zip(mine.keys, tops) for _ in top]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array([None if e[1] else e[2] for top in tops for e in top], batch_type),
             pa.array([-e[0] for top in tops for e in top], pa.int64())], names=["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(index.schema["doc_id"].dataType)
    return index.mapInArrow(search, f"item long, doc_id {kind}, score long")


def search_index(index: DataFrame, items: DataFrame, best: int = BEST, item_id: str = "item_id", text: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of each query with a score above 0.

    Queries are numbered, stored and searched in blocks of about ``block_bytes`` of text, so the driver and the tasks
    hold one block at a time.
    """
    asked = stored(items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                                F.monotonically_increasing_id().alias("item")), "queries")
    size = asked.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    total = index.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    blocks = max(1, -(-size // block_bytes))
    found = None
    for block in range(blocks if total.documents else 0):
        part = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "text").collect()  # one block
        texts = [(r.item, terms_of(r.text)) for r in sorted(part)]
        if any(terms for _, terms in texts):
            hits = stored(_search_block(index, texts, total.documents, total.terms, best), "hits", files=1 << 20)
            found = hits if found is None else found.unionByName(hits)
    kind = index.schema["doc_id"].dataType.simpleString()
    if found is None:
        found = index.sparkSession.createDataFrame([], f"item long, doc_id {kind}, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= best)
    return ranked.join(small(asked.select("item", "item_id")), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """``search_index`` over sketches made for this one search."""
    return search_index(sketch_documents(docs, doc_id, text), items, best, item_id, item_text)
