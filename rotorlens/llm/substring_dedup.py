"""Repeated passages by content-defined anchors.

A gear rolling hash runs over the words of each text (not its bytes, so white space between words doesn't count). Every
run of hashes as long as ``min_words`` leaves room for has its smallest one marked: the words that this hash remembers
are an anchor. What is marked depends on the words of the run alone, so each passage of ``min_words`` words holds an
anchor, and the same one in every document that has the passage, however short its words and however it is wrapped.
Anchors are deduplicated by digest. The windows of ``min_words`` words around an anchor that another document has are the
candidates; an exact check follows there: windows whose digest two documents share. A stretch that is put together from
shorter shared pieces does not pass.

Only digests and positions are shuffled before the exact check. Counting is combined on the map side; the joins have one
row per digest on one side, so a passage that very many documents share is split by adaptive execution.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rotorlens.llm.common import stored

#: Steps that the gear hash remembers at most, a power of two.
MEMORY = 32
#: Bytes of a chunk on average, where texts are cut by bytes.
REACH = 40
MIN_WORDS = 50
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def gear_table(seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray, gear: np.ndarray, memory: int = MEMORY) -> np.ndarray:
    """h[i] = sum of gear[data[i-k]] << k over the last ``memory`` (a power of two) places, by doubling."""
    h = gear[data]
    span = 1
    while span < memory:
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        span *= 2
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i:i+width], by doubling; shorter by width-1."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def chunk_ends(data: np.ndarray, gear: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Ends (exclusive) of the chunks of a text's bytes, the last one its length. No bound holds for a chunk's length."""
    n = len(data)
    if n <= reach:
        return np.array([n])
    h = gear_hashes(data, gear)
    least = _sliding_min(np.concatenate([np.full(reach // 2, 0xFFFFFFFF, np.uint32), h, np.full(
        reach - 1 - reach // 2, 0xFFFFFFFF, np.uint32)]), reach)
    cuts = np.flatnonzero(h == least) + 1
    return cuts if len(cuts) and cuts[-1] == n else np.append(cuts, n)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def word_hashes(body: bytes) -> np.ndarray:
    """A 64-bit hash per word; ``split`` knows the same white space as _WORD."""
    import xxhash

    return np.array(list(map(xxhash.xxh64_intdigest, body.split())), np.uint64)


def anchor_words(min_words: int) -> int:
    """Words of an anchor: a power of two, at most a third of a passage."""
    return min(MEMORY, 1 << max(0, (min_words // 3).bit_length() - 1))


def _digests(tokens: np.ndarray, width: int) -> np.ndarray:
    """Digest of the ``width`` words that begin at each word."""
    value = np.zeros(len(tokens) - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            value = value * np.uint64(0x9E3779B97F4A7C15) + tokens[k:k + len(value)]
    return value.view(np.int64)


def anchor_starts(tokens: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """First words of the anchors. Any ``min_words`` words hold one; which one depends on these words alone."""
    size = anchor_words(min_words)
    if len(tokens) < min_words:
        return np.zeros(0, np.int64)
    h = gear_hashes(np.arange(len(tokens)), (tokens >> np.uint64(32)).astype(np.uint32), size)[size - 1:]
    # The place makes equal hashes differ: the last of them is the smallest.
    placed = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), 0, -1, dtype=np.uint64)
    least = np.unique(_sliding_min(placed, min_words - size + 1))
    return np.sort(len(h) - (least & np.uint64(0xFFFFFFFF)).astype(np.int64))


def anchors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, digest, word (number of the first) of every anchor of every whole text."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            none = np.zeros(0, np.int64)
            ids, digests, words = [], [none], [none]
            for key, body in zip(batch["doc_id"], map(_bytes, batch["text"])):
                tokens = word_hashes(body)
                start = anchor_starts(tokens, min_words)
                if len(start):
                    digests.append(_digests(tokens, anchor_words(min_words))[start])
                    ids.extend([key] * len(start)), words.append(start)
            yield pd.DataFrame({"doc_id": ids, "digest": np.concatenate(digests), "word": np.concatenate(words)})

    return docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        of, f"doc_id {kind}, digest long, word long")


def candidate_anchors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, starts (array of word numbers): the anchors that another document has."""
    found = stored(anchors(docs, doc_id, text, min_words), "anchors")
    # Stored, so that both sides of the join are shuffled for it: only then can adaptive execution split a hot digest.
    shared = stored(found.groupBy("digest").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where(
        "a <> b").select("digest"), "shared-anchors")
    return found.join(shared, "digest", "left_semi").groupBy("doc_id").agg(F.collect_set("word").alias("starts"))


def _word_windows(tokens: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Word number and digest of every window of ``width`` words that holds one of the anchors."""
    last = len(tokens) - width
    if last < 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A row that repeats an id may have another text: its windows end where this text does.
    first = np.minimum(np.maximum(starts - (width - anchor_words(width)), 0), last + 1)
    steps = np.zeros(last + 2, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, np.minimum(starts, last) + 1, -1)
    rows = np.flatnonzero(np.cumsum(steps)[:-1] > 0)
    return rows, _digests(tokens, width)[rows]


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, word, digest: windows of ``min_words`` words (by number of the first) around shared anchors."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            none = np.zeros(0, np.int64)
            ids, words, digests = [], [none], [none]
            for key, body, starts in zip(batch["doc_id"], map(_bytes, batch["text"]), batch["starts"]):
                found = _word_windows(word_hashes(body), np.array(starts, np.int64), min_words)
                ids.extend([key] * len(found[0])), words.append(found[0]), digests.append(found[1])
            yield pd.DataFrame({"doc_id": ids, "word": np.concatenate(words), "digest": np.concatenate(digests)})

    starts = candidate_anchors(docs, doc_id, text, min_words)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(starts, "doc_id")
    return rows.mapInPandas(of, f"doc_id {kind}, word long, digest long")


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, first_word, n_words, first_doc_id, is_first: the maximal runs of repeated windows.

    ``first_doc_id`` is the smallest id among the documents that share a window of the run; the passage may stay there.
    Words are `[^\\x20\\x09-\\x0D]+`, case counts. Null and empty texts and null ids have no passages; rows that repeat
    an id are one document. Empty table: no rows. Extra columns are ignored.
    """
    windows = stored(repeated_windows(docs, doc_id, text, min_words), "windows")
    shared = stored(windows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where(
        "least <> most").select("digest", "least"), "shared-windows")
    held = windows.join(shared, "digest").groupBy("doc_id", "word").agg(F.min("least").alias("least"))
    order = Window.partitionBy("doc_id").orderBy("word")  # the words of one document
    marked = held.select("*", F.coalesce((F.col("word") - F.lag("word").over(order) > min_words).cast("int"), F.lit(1)).alias("_new"))
    numbered = marked.select("*", F.sum("_new").over(order).alias("_run"))
    return numbered.groupBy("doc_id", "_run").agg(
        F.min("word").alias("first_word"), (F.max("word") - F.min("word") + min_words).alias("n_words"),
        F.min("least").alias("first_doc_id")).select(
            "doc_id", "first_word", "n_words", "first_doc_id", (F.col("doc_id") == F.col("first_doc_id")).alias("is_first"))


def deduped_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every passage cut out (white space after its words included) where it is not first."""
    passages = repeated_passages(docs, doc_id, text, min_words).where(~F.col("is_first")).groupBy(
        F.col("doc_id").alias("_id")).agg(F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("_cut"))

    def cut(texts: pd.Series, runs: pd.Series) -> pd.Series:
        out = []
        for body, passage in zip(texts, runs):
            if body is None or passage is None:
                out.append(body)
                continue
            data = _bytes(body)
            spans = [m.span() for m in _WORD.finditer(data)]
            kept, at = [], 0
            for p in passage:
                first, after = p["first_word"], p["first_word"] + p["n_words"]
                kept.append(data[at:spans[first][0]])
                at = spans[after][0] if after < len(spans) else len(data)
            out.append(b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass"))
        return pd.Series(out, dtype=object)

    rows = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("_key")).join(
        passages, F.col("_key") == F.col("_id"), "left")
    new = F.when(F.col("_cut").isNull(), F.col("_row")[text]).otherwise(
        F.pandas_udf(cut, "string")(F.col("_row")[text], F.col("_cut")))
    return rows.select(F.col("_row").withField(f"`{text}`", new).alias("_row")).select("_row.*")
