"""Elias-Fano sequences and a trie of n-grams over them, in numpy.

A monotone sequence is split into low bits, stored as they are, and high bits,
stored in unary in a bit vector; with a small directory of ones per 64-bit
word the i-th value and the successor of a value are found without decoding
the rest.  All queries take and return arrays.

A trie level holds, for all contexts in order, the words that follow them.
Pointers to each context's range are monotone; word numbers become monotone by
adding the last value of the range before (context-relative coding), so one
successor search answers whether a word follows a context.
"""

from __future__ import annotations

import json
import os
import tempfile

import numpy as np

_BYTE_RANK = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: _SELECT[b, k]: the place of the k-th one of byte b.
_SELECT = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    for _k, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _SELECT[_b, _k] = _p


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of the k-th one (from 0) of each 64-bit word."""
    counts = _BYTE_RANK[words[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8)) & np.uint64(255)]
    upto = np.cumsum(counts, axis=1, dtype=np.int64)
    byte = (upto <= k[:, None]).sum(axis=1)
    at = np.arange(len(words))
    rest = k - np.where(byte > 0, upto[at, byte - 1], 0)
    value = (words >> (byte * 8).astype(np.uint64)) & np.uint64(255)
    return byte * 8 + _SELECT[value.astype(np.int64), rest]


class EliasFano:
    """A monotone sequence of ``n`` whole numbers below ``universe``."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        places = (values >> low_bits) + np.arange(n)
        high = np.zeros((int(places[-1]) if n else 0) // 64 + 2, np.uint64)
        np.bitwise_or.at(high, places >> 6, np.uint64(1) << (places & 63).astype(np.uint64))
        packed = np.zeros(n * low_bits // 64 + 2, np.uint64)
        if low_bits and n:
            part = (values & ((1 << low_bits) - 1)).astype(np.uint64)
            bit = np.arange(n) * low_bits
            shift = (bit & 63).astype(np.uint64)
            np.bitwise_or.at(packed, bit >> 6, part << shift)
            over = (bit & 63) + low_bits > 64
            np.bitwise_or.at(packed, (bit[over] >> 6) + 1, part[over] >> (np.uint64(64) - shift[over]))
        ones = np.r_[0, np.cumsum(np.bitwise_count(high), dtype=np.int64)].astype(np.uint32)
        return cls(n, low_bits, packed, high, ones)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        bit = i * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.low[word] >> shift
        spill = np.where(shift > 0, self.low[word + 1] << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return ((value | spill) & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at ``i``."""
        word = np.searchsorted(self.ones, i, "right") - 1
        place = word * 64 + _select_in_word(self.high[word], i - self.ones[word].astype(np.int64))
        return (place - i) << self.low_bits | self._lows(i)

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        """How many values have high bits below ``h``: h-th zero less h."""
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        out = np.zeros(len(h), np.int64)
        some = h > 0
        k = h[some] - 1
        out[some] = self.n
        inside = k < zeros[-1]
        word = np.searchsorted(zeros, k[inside], "right") - 1
        place = word * 64 + _select_in_word(~self.high[word], k[inside] - zeros[word])
        out[np.flatnonzero(some)[inside]] = place - k[inside]
        return np.minimum(out, self.n)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The first place whose value is at least ``x`` (``n`` if none)."""
        high = x >> self.low_bits
        at, end = self._bucket(high), self._bucket(high + 1)
        low = x & ((1 << self.low_bits) - 1)
        while len(live := np.flatnonzero(at < end)):
            middle = (at[live] + end[live]) >> 1  # values of a bucket are in order
            less = self._lows(middle) < low[live]
            at[live[less]] = middle[less] + 1
            end[live[~less]] = middle[~less]
        return at

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high, self.ones]

    @classmethod
    def of(cls, arrays: list[np.ndarray]) -> EliasFano:
        head, low, high, ones = arrays
        return cls(int(head[0]), int(head[1]), low, high, ones)


class Level:
    """Contexts 0..m-1 and the words that follow each."""

    def __init__(self, pointers: EliasFano, words: EliasFano):
        self.pointers, self.words = pointers, words

    @classmethod
    def encode(cls, contexts: int, context: np.ndarray, word: np.ndarray) -> Level:
        """Rows in order of context and word, none twice."""
        starts = np.searchsorted(context, np.arange(contexts + 1))
        last = np.zeros(contexts, np.int64)
        full = np.flatnonzero(np.diff(starts) > 0)
        last[full] = word[starts[full + 1] - 1] + 1
        base = np.r_[0, np.cumsum(last)]
        return cls(EliasFano.encode(starts), EliasFano.encode(word + 1 + base[context]))

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The entry of ``word`` after ``context``, -1 where there is none."""
        start, end = self.pointers.access(context), self.pointers.access(context + 1)
        out = np.full(len(context), -1, np.int64)
        some = np.flatnonzero(start < end)
        if not len(some):
            return out
        s, e = start[some], end[some]
        base = np.zeros(len(some), np.int64)
        later = s > 0
        base[later] = self.words.access(s[later] - 1)
        x = word[some] + 1 + base
        at = self.words.successor(x)
        hit = at < e
        hit[hit] = self.words.access(at[hit]) == x[hit]
        out[some[hit]] = at[hit]
        return out


def dump(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays as one block of bytes, each aligned to eight."""
    head, body, at = [], [], 0
    for name, array in arrays.items():
        data = np.ascontiguousarray(array).tobytes()
        head.append([name, array.dtype.str, len(array), at])
        body.append(data + bytes(-len(data) % 8))
        at += len(body[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(body)


def mapped(data: bytes) -> dict[str, np.ndarray]:
    """The arrays of :func:`dump`, memory-mapped from a file that has no name
    any more, so that nothing is left behind."""
    file, path = tempfile.mkstemp(prefix="trie-")
    with os.fdopen(file, "wb") as out:
        out.write(data)
    memory = np.memmap(path, np.uint8, "r")
    os.unlink(path)
    size = int.from_bytes(memory[:8].tobytes(), "little")
    out = {}
    for name, kind, n, at in json.loads(memory[8 : 8 + size].tobytes()):
        start = 8 + size + at
        out[name] = memory[start : start + n * np.dtype(kind).itemsize].view(kind)
    return out
