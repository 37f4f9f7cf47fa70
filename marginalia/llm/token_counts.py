"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token starts as one symbol per byte.  Its adjacent pairs wait in a heap
ordered by (merge rank, position); the lowest is popped, the two symbols become
one in a doubly linked list, and the two new neighbouring pairs are pushed.
The count is the number of initial symbols minus the number of merges; no
identifier is ever produced.

Texts are cut at single spaces first.  A space before a non-space character
always starts a pre-token, so each piece can be counted on its own and counts
of pieces seen before come from a bounded two-generation cache.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from marginalia.llm.storage import small_batches

#: Entries of one cache generation; two generations are held.  Longer keys are
#: not held, so a generation has a bound in bytes.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 64
#: Stands for a piece that can't be counted without the piece before it.
_GLUED = 1 << 50


class _Cache(dict):
    """A dict that computes missing values and drops the older half when full."""

    def __init__(self, compute, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.entries, self.old = compute, entries, {}

    def __missing__(self, key):
        if len(key) > CACHE_CHARS:
            return self.compute(key)
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_symbols() -> dict[str, int]:
    """The printable stand-in character of every byte in byte-level files:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class HeapCounter:
    """Counts tokens of a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        ids = byte_symbols()
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (left, right) in enumerate(model["model"]["merges"]):
            self.made.append(ids.setdefault(left + right, len(ids)))
            self.rank.setdefault(ids[left] << 20 | ids[right], rank)
        special = [t["content"] for t in model["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special_texts = special
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.words = _Cache(lambda word: self.merge(list(word.encode())))
        self.pieces = _Cache(self._piece)
        self.heads = _Cache(self._chunk, 50_000)

    def merge(self, symbols: list[int]) -> int:
        """Symbols left when no adjacent pair has a rank any more."""
        n = len(symbols)
        rank, base = self.rank.get, self.made
        live = [rank(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:])]  # rank of the pair that starts here
        heap = [r << 32 | i for i, r in enumerate(live) if r >= 0]
        if not heap:
            return n
        heapify(heap)
        live.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            entry = heappop(heap)
            i, r = entry & 0xFFFFFFFF, entry >> 32
            if live[i] != r:
                continue  # one of the two has been merged since
            merges += 1
            j = after[i]
            k = after[i] = after[j]
            live[j] = -1
            made = symbols[i] = base[r]
            if k < n:
                before[k] = i
                q = live[i] = rank(made << 20 | symbols[k], -1)
                if q >= 0:
                    heappush(heap, q << 32 | i)
            else:
                live[i] = -1
            h = before[i]
            if h >= 0:
                q = live[h] = rank(symbols[h] << 20 | made, -1)
                if q >= 0:
                    heappush(heap, q << 32 | h)
        return n - merges

    def _chunk(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.split(text)))

    def _piece(self, piece: str) -> int:
        return _GLUED if not piece or piece[0].isspace() else self._chunk(" " + piece)

    def _plain(self, text: str) -> int:
        head, *pieces = text.split(" ")
        total = self.heads[head] + sum(map(self.pieces.__getitem__, pieces))
        if total < _GLUED:
            return total
        chunks = [head]
        for piece in pieces:
            if not piece or piece[0].isspace():
                chunks[-1] += " " + piece
            else:
                chunks.append(" " + piece)
        return sum(map(self._chunk, chunks))

    def count(self, text: str) -> int:
        """Tokens of ``text``; an added special token inside it counts one."""
        if self.special is None or not any(s in text for s in self.special_texts):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


_counters: dict[str, HeapCounter] = {}


def count_tokens(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", limit: int = 512) -> DataFrame:
    """Bytes and tokens of every whole text.

    Returns ``key, n_bytes, n_tokens, over_limit``, one row per input row.
    Null and empty texts have no bytes and no tokens; very long texts are
    counted whole; null keys, ties and repeated rows are returned as they come;
    other columns are never read; an empty table gives no rows.
    ``path`` names a byte-level BPE file that every executor can open.
    """
    small_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = HeapCounter(path)
        counter = _counters[path]
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [counter.count(t) for t in texts]
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                [key, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
