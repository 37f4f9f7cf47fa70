"""Best-fit packing of token sequences by exact-complement hashing.

Only lengths matter for packing, and there are at most ``capacity`` of them, so
the plan is made on one histogram of availability counts whatever the corpus
size.  Starting from the longest piece, the gap is looked up among indexed
sums of one, two and three lengths; a combination that fills it exactly is
consumed as often as the counts allow.  Where none fits, the longest piece that
fits is placed (best fit) and the rest of the gap is looked up again.

The plan is a list of runs: "pieces number a to b of length n stand at offset o
of sequences s, s + 1, ...".  Pieces are numbered within their length by a hash
salt and a rank inside the salt, so a length that a third of all pieces share
is numbered by many tasks.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm.storage import materialize, small_batches
from marginalia.llm.token_counts import byte_symbols

CAPACITY = 2048
END_ID = 0
#: Pieces that one salt of a length holds, about; at least MIN_SALTS salts.
SALT_ROWS, MIN_SALTS = 100_000, 64


class Encoder:
    """Ids of whole texts, as the ``tokenizers`` library gives them for a
    byte-level BPE file.

    The file's vocabulary is handed to the ``tiktoken`` encoder, which gives
    the same ids in a fifth of the time (the tests compare the two); texts
    that hold the string of an added token go to the library itself."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        byte = byte_symbols()
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(byte.__getitem__, token)): i for token, i in vocabulary.items() if token not in self.added}
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if any(a in text for a in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


def cut(size: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, the first shorter."""
    first = size % capacity or min(size, capacity)
    return [(0, first), *[(s, capacity) for s in range(first, size, capacity)]]


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` of every document's ids and
    one end id; a null text is empty and so a piece of length 1."""
    small_batches(docs)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                keys = batch.column(0)
                rows: tuple[list, ...] = ([], [], [], [], [])
                for i, text_ in enumerate(batch.column(1).to_pylist()):
                    ids = _encoders[path].encode(text_ or "").tobytes() + end
                    for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        for column, value in zip(rows, (i, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])), strict=True):
                            column.append(value)
                i, piece, start, length, crc = rows
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(i, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["key", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def _pair(gap: int, left: np.ndarray) -> tuple[int, ...] | None:
    """Two available lengths of sum ``gap``, the longest first."""
    a = np.arange((gap + 1) // 2, gap)
    b = gap - a
    ok = np.flatnonzero((left[a] > 0) & (left[b] > 0) & ((a != b) | (left[a] > 1)))
    return (int(a[ok[-1]]), int(b[ok[-1]])) if len(ok) else None


def _complement(gap: int, left: np.ndarray, pairs: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three available lengths of sum ``gap``; the one with the
    longest first length among those of least size.  ``pairs`` indexes sums of
    two lengths that were available when it was made."""
    if left[gap]:
        return (gap,)
    if found := _pair(gap, left):
        return found
    a = np.arange(gap - 2, 0, -1)
    a = a[(left[a] > 0) & pairs[gap - a]]
    for first in a.tolist():
        left[first] -= 1
        rest = _pair(gap - first, left)
        left[first] += 1
        if rest:
            return (first, *rest)
    return None


def _pair_sums(left: np.ndarray) -> np.ndarray:
    there = (left > 0).astype(np.float64)
    n = 2 * len(left)
    return np.rint(np.fft.irfft(np.fft.rfft(there, n) ** 2, n))[: len(left)] > 0


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) in order.

    Each entry uses up at least one length or leaves less of it than the entry
    needs, so there are a few entries per length and not per piece."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []
    pairs, stale = _pair_sums(left), 0
    longest = capacity
    while True:
        while longest and not left[longest]:
            longest -= 1
        if not longest:
            return out
        if stale >= 16:
            pairs, stale = _pair_sums(left), 0
        now = left.copy()
        content = [longest]
        now[longest] -= 1
        gap = capacity - longest
        while gap:
            if found := _complement(gap, now, pairs):
                content += found
                for length in found:
                    now[length] -= 1
                break
            fits = np.flatnonzero(now[1 : gap + 1])
            if not len(fits):
                break
            best = int(fits[-1]) + 1
            content.append(best)
            now[best] -= 1
            gap -= best
        uses: dict[int, int] = defaultdict(int)
        for length in content:
            uses[length] += 1
        times = min(int(left[length]) // n for length, n in uses.items())
        for length, n in uses.items():
            left[length] -= n * times
        stale += 1
        out.append((tuple(content), times))


def runs(planned: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first piece numbers, first sequences and offsets of runs."""
    used: dict[int, int] = defaultdict(int)
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for content, times in planned:
        offset = 0
        for length in content:
            out[length].append((used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for n, rows in out.items()}


def pack(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` per piece.

    Every document's ids and an end id are packed into sequences of at most
    ``capacity`` ids, gapless from offset 0; only longer documents are cut.
    Null and empty texts are an end id; null keys and repeated rows are packed
    each for itself; an empty table gives no rows.
    """
    made = materialize(pieces(docs, path, text=text, key=key, capacity=capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    table = made.sparkSession.sparkContext.broadcast(runs(plan(counts, capacity)))
    salts = max(MIN_SALTS, sum(counts.values()) // SALT_ROWS)
    salted = made.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row"))
    numbered = salted.withColumn("number", rank - 1).join(firsts, ["length", "salt"]).withColumn("number", F.col("number") + F.col("first"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(3).to_numpy()
            numbers = batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(lengths[order]) != 0, True]) if len(order) else [0]
            for a, z in zip(edges[:-1], edges[1:], strict=True):
                at = order[a:z]
                first, base, offsets = table.value[int(lengths[at[0]])]
                run = np.searchsorted(first, numbers[at], "right") - 1
                sequence[at] = base[run] + numbers[at] - first[run]
                offset[at] = offsets[run]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return numbered.select("key", "piece", "start", "length", "ids_crc32", "number").mapInArrow(place, schema)
