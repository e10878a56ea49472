"""Words and hashes of many texts at once: numpy over the bytes of an Arrow string column.

Nothing here loops over characters or words in Python. A batch is worked on in slices of
whole texts of about ``SLICE`` bytes, so memory stays bounded; one longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
#: Words of a shingle.
SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SMALL = np.arange(256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of the input reach all bits of the output."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


_OF_BYTE = mix(_SMALL + np.uint64(77))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words: digits, letters (in either case, as A-Z are lowered first) and all that is not ASCII.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes of words that only ASCII white space separates.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base to the powers 0 to n, and its inverse."""
    if "up" not in _POWERS or len(_POWERS["up"]) <= n:
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            p = np.full(n + 1 + n // 4, base, dtype=np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _POWERS[name] = p
    return _POWERS["up"][: n + 1], _POWERS["down"][: n + 1]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i], times the inverse base to the i, a hash of values[i:j] wherever that stands."""
    up, _ = powers(len(values))
    h = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=h[1:])
    return h


def span_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(h) - 1)
    return mix((h[end] - h[start]) * down[start])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, dtype=np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return body, at


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with about ``size`` bytes each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


class Words:
    """The words of texts i to j: hash, start and end in the slice's bytes, and the number of the text."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray, i: int, j: int, in_word: np.ndarray = _IN_WORD):
        low, high = offsets[i], offsets[j]
        self.n_texts = j - i
        self.offsets = offsets[i: j + 1] - low
        self.bytes = part = _LOWER[body[low:high]]
        n = len(part)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = in_word[part]
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        cut = self.offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        first[cut] |= inside[cut + 1]
        last[cut - 1] |= inside[cut]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.prefix = prefix_hashes(_OF_BYTE[part])
        self.hash = span_hashes(self.prefix, self.start, self.end)
        #: words of text t are first_word[t] to first_word[t + 1]
        self.first_word = np.searchsorted(self.start, self.offsets, side="left")
        self.counts = np.diff(self.first_word)
        self.text = np.repeat(np.arange(self.n_texts), self.counts)


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of the distinct shingles of a slice, ordered by both."""
    n = len(words.hash)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    end = words.first_word[1:][words.text]
    whole = np.arange(n) + size <= end
    short = (words.counts[words.text] < size) & (np.arange(n) == words.first_word[:-1][words.text])
    start = np.flatnonzero(whole | short)
    value = np.zeros(len(start), dtype=np.uint64)
    for i in range(size):
        at = start + i
        word = np.where(at < end[start], words.hash[np.minimum(at, n - 1)], np.uint64(0))
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + word)
    text = words.text[start]
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (value[1:] != value[:-1])]))
    return text[first], value[first], np.diff(np.append(first, len(text)))
