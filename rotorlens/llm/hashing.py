"""Words of many texts as byte spans in one buffer, their XXH64 digests, and a table that interns spans, all in NumPy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_M1, _M2, _M3, _M4, _M5 = (np.uint64(x) for x in (  # the five multipliers of XXH64 (fixed values)
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_LANE = 8


def word_table(excluded: Sequence[tuple[int, int]]) -> bytes:
    """A translation of bytes: those in the ranges (both ends included) become spaces, A-Z lower case.

    Ranges lie below 0x80, so bytes of longer UTF-8 sequences stay and whole characters are kept.
    """
    table = bytearray(range(256))
    for c in range(0x41, 0x5B):
        table[c] = c + 32
    for first, last in excluded:
        for c in range(first, last + 1):
            if not 0x41 <= c <= 0x5A:
                table[c] = 0x20
    return bytes(table)


class Spans:
    """Byte spans of one buffer. The buffer is padded, so that eight bytes can be read at every place."""

    def __init__(self, body: bytes, starts: np.ndarray, lengths: np.ndarray):
        self.body, self.starts, self.lengths = body, starts, lengths
        padded = np.frombuffer(body + b"\0" * _LANE, np.uint8)
        self._wide = np.ndarray(len(body) + 1, "<u8", padded, strides=(1,))

    def __len__(self) -> int:
        return len(self.starts)

    def bytes_of(self, k: int) -> bytes:
        return self.body[self.starts[k]:self.starts[k] + self.lengths[k]]

    def lane(self, places: np.ndarray, kept: np.ndarray | int) -> np.ndarray:
        """Eight bytes at each place as a number, only the first ``kept`` (1 to 8) of them."""
        shift = (8 * (_LANE - np.asarray(kept))).astype(np.uint64)
        return (self._wide[places] << shift) >> shift

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the spans numbered ``a`` and ``b`` have the same bytes."""
        same = self.lengths[a] == self.lengths[b]
        left = np.flatnonzero(same)
        at = 0
        while len(left):
            kept = np.minimum(self.lengths[a[left]] - at, _LANE)
            good = self.lane(self.starts[a[left]] + at, kept) == self.lane(self.starts[b[left]] + at, kept)
            same[left[~good]] = False
            at += _LANE
            left = left[good & (self.lengths[a[left]] > at)]
        return same

    def xxh64(self, seed: int = 0) -> np.ndarray:
        """XXH64 of every span. Spans of 32 bytes and more, which are rare, are hashed one at a time."""
        out = np.empty(len(self), np.uint64)
        short = np.minimum(self.lengths, 32).astype(np.uint8)
        order = np.argsort(short, kind="stable")
        ends = np.cumsum(np.bincount(short, minlength=33))
        for length in range(32):
            group = order[ends[length - 1] if length else 0:ends[length]]
            if len(group):
                out[group] = self._short(self.starts[group], length, seed)
        if ends[31] < ends[32]:
            import xxhash

            for k in order[ends[31]:].tolist():
                out[k] = xxhash.xxh64_intdigest(self.bytes_of(k), seed)
        return out

    def _short(self, at: np.ndarray, length: int, seed: int) -> np.ndarray:
        h = np.full(len(at), (seed + int(_M5) + length) & (2**64 - 1), np.uint64)
        for _ in range(length // 8):
            h ^= _turn(self._wide[at] * _M2, 31) * _M1
            h = _turn(h, 27) * _M1 + _M4
            at = at + 8
        if length & 4:
            h ^= self.lane(at, 4) * _M1
            h = _turn(h, 23) * _M2 + _M3
            at = at + 4
        for _ in range(length & 3):
            h ^= self.lane(at, 1) * _M5
            h = _turn(h, 11) * _M1
            at = at + 1
        for shift, times in ((33, _M2), (29, _M3)):
            h ^= h >> np.uint64(shift)
            h *= times
        return h ^ (h >> np.uint64(32))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def words_of(texts: Sequence[str | None], table: bytes) -> tuple[Spans, np.ndarray]:
    """The words of all texts, in order, as spans of a buffer in which one space parts them; and each text's number."""
    lists = [(text or "").encode("utf-8", "surrogatepass").translate(table).split() for text in texts]
    numbers = np.fromiter(map(len, lists), np.int64, len(lists))
    body = b" ".join([b" ".join(words) for words in lists if words])
    if not body:
        return Spans(b"", np.zeros(0, np.int64), np.zeros(0, np.int64)), numbers
    ends = np.append(np.flatnonzero(np.frombuffer(body, np.uint8) == 0x20), len(body))
    starts = np.concatenate(([0], ends[:-1] + 1))
    return Spans(body, starts, ends - starts), numbers


def runs_of(words: Spans, numbers: np.ndarray, longest: int) -> tuple[Spans, np.ndarray]:
    """All runs of 1 to ``longest`` consecutive words of a text, text after text; and each text's number of runs."""
    if longest == 1:
        return words, numbers
    text = np.repeat(np.arange(len(numbers)), numbers)
    ends = words.starts + words.lengths
    starts, stops, owners = [], [], []
    for n in range(1, longest + 1):
        first = np.flatnonzero(text[:max(0, len(text) - n + 1)] == text[n - 1:])
        starts.append(words.starts[first])
        stops.append(ends[first + n - 1])
        owners.append(text[first])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    start, stop = np.concatenate(starts)[order], np.concatenate(stops)[order]
    return Spans(words.body, start, stop - start), np.bincount(owner, minlength=len(numbers))


def intern(spans: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Give equal spans one number: (the number of each span, a span that each number stands for).

    An open-addressed table of twice as many places as spans: a span goes to the place that its digest names, all spans
    at once; where bytes differ from those of the place's owner, the span moves on to the next place.
    """
    n = len(spans)
    places = 1 << max(4, (2 * n - 1).bit_length() if n else 0)
    owner = np.full(places, -1, np.int32)
    digest = spans.xxh64()
    place = (digest & np.uint64(places - 1)).astype(np.int64)
    pending = np.arange(n, dtype=np.int32)
    while len(pending):
        at = place[pending]
        free = owner[at] < 0
        owner[at[free]] = pending[free]
        held = owner[at]
        good = digest[held] == digest[pending]
        good[good] = spans.equal(held[good], pending[good])
        pending = pending[~good]
        place[pending] = (place[pending] + 1) & (places - 1)
    taken = np.flatnonzero(owner >= 0)
    number = np.empty(places, np.int32)
    number[taken] = np.arange(len(taken), dtype=np.int32)
    return number[place], owner[taken]
