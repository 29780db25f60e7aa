"""Words of a whole Arrow batch as numpy arrays: byte offsets, 64-bit hashes, window hashes.

Word hashes are polynomials over the bytes and window hashes are polynomials over word hashes,
both modulo 2**64 and mixed afterwards, so each costs a prefix sum however long it is.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
PIECE_BYTES = 4 << 20
#: Bytes, or words, that are hashed at once: the powers kept for it take 4 MB in a worker.
HASH_PIECE = 256 << 10


def _table(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


#: Words [^\x20\x09-\x0D]+.
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words of ASCII letters, digits and everything beyond ASCII.
ALPHANUMERIC = _table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another, and len + 1 offsets. A null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def pieces(array: pa.Array, max_bytes: int = PIECE_BYTES):
    """(first row, slice) of consecutive rows with about max_bytes of text, whole rows only."""
    if len(array) == 0:
        return
    _, at = text_bytes(array)
    first = 0
    while first < len(array):
        last = int(np.searchsorted(at, at[first] + max_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(array))
        yield first, array.slice(first, last - first)
        first = last


class Words(NamedTuple):
    data: np.ndarray    # bytes, lower-cased if asked for
    start: np.ndarray   # byte offset of each word
    end: np.ndarray     # exclusive
    doc: np.ndarray     # index of each text's first word; one more at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc) - 1), self.counts)

    def slice(self, a: int, b: int) -> bytes:
        """The bytes of words a to b - 1 joined by one space."""
        data = self.data.data
        return b" ".join([bytes(data[s:e]) for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist())])


def find_words(texts: pa.Array, is_word: np.ndarray = SPACED, lower: bool = False) -> Words:
    data, at = text_bytes(texts)
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.zeros(len(at), np.int64))
    inside = is_word[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(LOWER[data] if lower else data, start, end, np.searchsorted(start, at))


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of base and of its inverse modulo 2**64, at least n of each.

    Those for one piece are kept; a longer word's are made anew, so that it leaves nothing behind.
    """
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(HASH_PIECE + 1, n)
        have = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
                     for b in (np.uint64(base), np.uint64(pow(base, -1, 1 << 64))))
        if size == HASH_PIECE + 1:
            _POWERS[base] = have
    return have


def _spans(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of values[start:end] for many spans."""
    up, down = _powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=prefix[1:])
    return (prefix[end] - prefix[start]) * down[start]


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash for each word; equal words have equal hashes everywhere."""
    out = np.empty(len(words.start), np.uint64)
    first = 0
    while first < len(out):
        base = int(words.start[first])
        last = max(first + 1, int(np.searchsorted(words.end, base + HASH_PIECE, side="right")))
        start, end = words.start[first:last] - base, words.end[first:last] - base
        data = words.data[base:base + int(end[-1])].astype(np.uint64) + np.uint64(1)
        out[first:last] = mix(_spans(data, start, end, BYTE_BASE) + (end - start).astype(np.uint64))
        first = last
    return out


def window_starts(words: Words, width: int) -> np.ndarray:
    """Index of the first word of every window of width consecutive words of one text."""
    if not len(words.start):
        return np.empty(0, np.int64)
    left = np.repeat(words.doc[1:], words.counts) - np.arange(len(words.start))
    return np.flatnonzero(left >= width)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of hashes[s:s + width] for every s in starts."""
    if not len(starts):
        return np.empty(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    step = HASH_PIECE // 2
    for a in range(0, len(starts), step):
        part = starts[a:a + step]
        low = int(part[0])
        values = hashes[low:int(part[-1]) + width]
        out[a:a + step] = mix(_spans(values, part - low, part - low + width, WORD_BASE) + np.uint64(width))
    return out
