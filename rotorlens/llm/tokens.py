"""Token ids of whole texts, by a public tokenizer file.

A byte-level BPE splits a text before every single space between two other characters, so the text can be cut there and
the ids of a piece can be remembered: most words recur. Texts in which a space has white space on both sides (or ends
the text after white space) are encoded whole, as are all texts if the file describes another kind of tokenizer.
"""

from __future__ import annotations

import json
import re
import string
import sys
import types
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 0
#: Pieces in each of the two generations that a worker remembers (some 200 bytes each), and their longest length in characters.
REMEMBERED = 250_000
PIECE_CHARS = 64
ENCODED_AT_ONCE = 5000


def read_tokenizer(path: str) -> str:
    """The description in the file, read where the query is written; it travels to the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def splits_at_spaces(description: str) -> bool:
    spec = json.loads(description)
    before = spec.get("pre_tokenizer") or {}
    return (before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
            and spec.get("normalizer") is None and (spec.get("model") or {}).get("type") == "BPE")


def _spelling() -> dict[int, str]:
    """Byte-level vocabularies spell each byte as a character: visible ones of Latin-1 as they are, the others, in
    order, from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


_SPELLED = _spelling()
_SPACE = _SPELLED[0x20]


class Encoder:
    """Texts to ids as bytes (little-endian, unsigned, 32 bits each), as the plain tokenizer gives them: where a text
    holds the string of an added token, its id stands for it. Such texts are encoded whole."""

    #: A space between two white-space characters, or between one and the end.
    _joined = re.compile(r" (?=\s|\Z)(?<=\s.)", re.DOTALL)

    def __init__(self, description: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(description)
        self._by_piece = splits_at_spaces(description)
        self._added = [token["content"] for token in json.loads(description).get("added_tokens") or [] if token["content"]]
        #: Ids by piece, in two generations: what the younger one misses is taken over from the older one.
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._tails: dict[str, bytes] = {}
        self._model = self._tokenizer.model

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _is_cut(self, text: str) -> bool:
        """Whether the text may be cut before every space. The parts are looked for one by one: that is a search for
        fixed text, which a pattern of them all would not be."""
        return self._by_piece and not self._joined.search(text) and not any(token in text for token in self._added)

    def _word(self, x: str) -> bytes:
        """Ids of letters after a space: one token of the splitting rule, so they go to the model at once."""
        spelled = _SPACE + x if x.isascii() else _SPACE + x.encode().decode("latin-1").translate(_SPELLED)
        return array("I", [t.id for t in self._model.tokenize(spelled)]).tobytes()

    def _tail(self, tail: str) -> bytes:
        """Ids of ASCII punctuation after letters."""
        ids = self._tails.get(tail)
        if ids is None:
            if len(self._tails) > REMEMBERED:
                self._tails.clear()
            ids = self._tails[tail] = self._encode([tail])[0]
        return ids

    def _learn(self, pieces: list[str], ids: list[bytes | None], gaps: list[int]) -> None:
        """Puts in the ids of pieces that the younger generation doesn't hold. Those short enough are remembered.

        Letters followed by ASCII punctuation are two tokens of the splitting rule, so a piece of that kind is put
        together from its letters and its punctuation.
        """
        known, older, rest = self._known, self._older.get, []
        for k in gaps:
            x = pieces[k]
            found = older(x)
            if found is None:
                head = x.rstrip(string.punctuation)
                if not head.isalpha():
                    rest.append(k)
                    continue
                found = known.get(head) or older(head) or self._word(head)
                if len(head) < len(x):
                    if len(head) <= PIECE_CHARS:
                        known[head] = found
                    found += self._tail(x[len(head):])
            ids[k] = found
            if len(x) <= PIECE_CHARS:
                known[x] = found
        for at in range(0, len(rest), ENCODED_AT_ONCE):
            part = rest[at:at + ENCODED_AT_ONCE]
            for k, found in zip(part, self._encode([" " + pieces[k] for k in part])):
                ids[k] = found
                if len(pieces[k]) <= PIECE_CHARS:
                    known[pieces[k]] = found

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text; a null text is empty."""
        if len(self._known) > REMEMBERED:
            self._older, self._known = self._known, {}
        texts = [text or "" for text in texts]
        plain = [k for k, text in enumerate(texts) if self._is_cut(text)]
        out: list[bytes] = [b""] * len(texts)
        for k, ids in zip(plain, self._by_pieces([texts[k] for k in plain])):
            out[k] = ids
        cut = set(plain)
        whole = [k for k in range(len(texts)) if k not in cut]
        for k, ids in zip(whole, self._encode([texts[k] for k in whole])):
            out[k] = ids
        return out

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that may be cut before every space. Each distinct piece is looked up once, and the ids of all
        pieces are put together as arrays."""
        if not texts:
            return []
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        first = np.zeros(len(code), bool)
        first[bounds[:-1]] = True  # no space stands before the first piece of a text
        used = np.zeros(len(coded.dictionary), bool)
        used[code[~first]] = True
        names = coded.dictionary.filter(pa.array(used)).to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self._known.get, names))
        self._learn(names, ids, [k for k, x in enumerate(ids) if x is None])
        heads = self._encode(coded.dictionary.take(pa.array(code[first])).to_pylist())
        code = (np.cumsum(used) - 1).take(code)
        code[first] = len(ids) + np.arange(len(heads))
        ids += heads
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        start = (np.cumsum(sizes) - sizes).take(code)
        size = sizes.take(code)
        ends = np.cumsum(size)
        at = np.arange(ends[-1])
        at += np.repeat(start - ends + size, size)
        flat = np.frombuffer(b"".join(ids), np.uint32).take(at).tobytes()
        stops = [0, *(4 * ends[bounds[1:] - 1]).tolist()]
        return [flat[a:b] for a, b in zip(stops, stops[1:])]


def encoder(description: str) -> Encoder:
    """This worker's encoder: tasks that reuse a Python worker go on with what it remembers."""
    held = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker")).__dict__
    if held.get("description") != description:
        held.update(description=description, encoder=Encoder(description))
    return held["encoder"]


def slices(texts: pa.Array, characters: int = 2_000_000, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about so many bytes, and at most ``rows`` texts."""
    lengths = pc.binary_length(texts).fill_null(0).to_pylist()
    start, held = 0, 0
    for k, length in enumerate(lengths):
        held += length
        if held >= characters or k + 1 - start >= rows:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def encoded(docs: DataFrame, tokenizer: str, finish: Callable[[pa.Array, list[bytes]], pa.RecordBatch], schema: str,
            doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """What ``finish`` makes of slices of ids of documents and their token ids (bytes, the end id last), in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))  # a vocabulary, a few MB
    end = array("I", [end_id]).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(shared.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts):
                coded = known.batch(texts.slice(a, b - a).to_pylist())
                yield finish(keys.slice(a, b - a), [x + end for x in coded])
        pa.default_memory_pool().release_unused()  # the worker may stay idle beside stages that need the memory

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        encode, f"doc_id {kind}, {schema}")


def id_lists(coded: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in coded]))).astype(np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(coded))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def token_table(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID
                ) -> DataFrame:
    """doc_id, ids (array of int, the end id last), one row per input row; null and empty texts: the end id alone."""

    def finish(keys: pa.Array, coded: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, id_lists(coded)], names=["doc_id", "ids"])

    return encoded(docs, tokenizer, finish, "ids array<int>", doc_id, text, end_id)
