"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit majority votes over the XXH64 values of word shingles.
The anchors are the codewords of the perfect [63, 57] Hamming code over the
low 63 bits, a covering code of radius 1.  Two fingerprints at most ``t`` bits
apart have a midpoint within ``ceil(t/2)`` of both, and an anchor within 1 of
that midpoint; so replicating each fingerprint to every anchor within
``1 + ceil(t/2)`` makes any such pair meet (for t = 2: 32 anchors, or one for
a codeword).  An anchor holds at most the fingerprints of one ball, a number
fixed by the code and not by the data, because equal fingerprints are merged
first.  Per anchor only a spanning forest of the links is emitted, which keeps
connectivity and never lists all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.components import connected_components
from marginalia.llm.storage import few, free_name, materialize, small_batches

CODE_BITS = 63
SHINGLE_WORDS = 3
MAX_BITS = 2
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint; zero for a text without words."""
    found = (text or "").encode().lower().split()  # bytes: A-Z only, and x09-x0D and x20 only
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = list(map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False)))
    votes = np.zeros(64, np.int64)
    for at in range(0, len(shingles), _BLOCK):
        digests = b"".join(map(xxhash.xxh64_digest, shingles[at : at + _BLOCK], repeat(42)))
        votes += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(shingles)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS) -> DataFrame:
    """``key, fp`` with the fingerprint as a signed long; a null text is empty."""
    small_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fp bigint")


def _cosets(radius: int) -> list[np.ndarray]:
    """For each syndrome the error patterns of at most ``radius`` bits."""
    found: list[list[int]] = [[] for _ in range(CODE_BITS + 1)]
    for size in range(radius + 1):
        for places in combinations(range(1, CODE_BITS + 1), size):
            syndrome = mask = 0
            for p in places:
                syndrome ^= p
                mask |= 1 << (p - 1)
            found[syndrome].append(mask)
    return [np.array(x, np.uint64) for x in found]


_CHECKS = [np.uint64(sum(1 << (p - 1) for p in range(1, CODE_BITS + 1) if p >> k & 1)) for k in range(6)]


def anchors(fps: np.ndarray, cosets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor) for every anchor in reach."""
    low = fps & np.uint64((1 << CODE_BITS) - 1)
    syndrome = np.zeros(len(fps), np.int64)
    for k, check in enumerate(_CHECKS):
        syndrome |= (np.bitwise_count(low & check) & 1).astype(np.int64) << k
    places, points = [], []
    for s in np.unique(syndrome):
        at = np.flatnonzero(syndrome == s)
        places.append(np.repeat(at, len(cosets[s])))
        points.append((low[at, None] ^ cosets[s][None, :]).ravel())
    return np.concatenate(places), np.concatenate(points)


def forest(fps: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links within one anchor's fingerprints."""
    left, right = [], []
    rest = fps
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= max_bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                queue.extend(found)
                left.extend([int(at)] * len(found))
                right.extend(map(int, found))
    return left, right


_SMALL = 8


def _linked(points: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the anchors of rows sorted by anchor."""
    starts = np.flatnonzero(np.r_[True, points[1:] != points[:-1]])
    sizes = np.diff(np.r_[starts, len(points)])
    size = np.repeat(sizes, sizes)
    lefts, rights = [], []
    for gap in range(1, _SMALL):
        same = (points[gap:] == points[:-gap]) & (size[gap:] <= _SMALL)
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(fps[at] ^ fps[at + gap]) <= max_bits]
        lefts.append(fps[at])
        rights.append(fps[at + gap])
    for s, n in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
        left, right = forest(fps[s : s + n], max_bits)
        lefts.append(np.array(left, np.uint64))
        rights.append(np.array(right, np.uint64))
    return np.concatenate(lefts), np.concatenate(rights)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, radius: int | None = None) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fp`` that connect
    whatever is at most ``max_bits`` apart.

    ``radius`` is how far anchors are from the fingerprints replicated to them:
    at least the covering radius 1 and half the threshold; covering radius plus
    threshold, 1 + ``max_bits``, gives the same links at more anchors."""
    least = 1 + (max_bits + 1) // 2
    if radius is not None and radius < least:
        raise ValueError(f"anchors within {radius} miss pairs at {max_bits} bits")
    cosets = _cosets(radius or least)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 4096):
                part = fps[at : at + 4096]
                place, point = anchors(part, cosets)
                yield pa.RecordBatch.from_arrays([pa.array(point.view(np.int64)), pa.array(part[place].view(np.int64))], ["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, fps = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(points: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            left, right = _linked(points, fps, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["u", "v"])

        for batch in batches:
            points = np.concatenate([points, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(points) and points[0] != points[-1]:
                cut = int(np.searchsorted(points, points[-1]))  # the last anchor may go on
                yield out(points[:cut], fps[:cut])
                points, fps = points[cut:], fps[cut:]
        if len(points):
            yield out(points, fps)

    placed = distinct.select("fp").mapInArrow(replicate, "anchor bigint, fp bigint")
    return placed.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, "u bigint, v bigint").distinct()


def classes(docs: DataFrame, *, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``key, fingerprint, component_id``: one row per input row.

    ``component_id`` is the least key among all rows reachable over links of
    at most ``max_bits`` differing bits.  Null and empty texts share the
    fingerprint zero and are linked like any other; a null key is never a
    component's id unless all its keys are null.
    """
    marked = materialize(fingerprints(docs, text=text, key=key, words=words), "fingerprints")
    found = placed(marked, lambda distinct: links(distinct, max_bits), key)
    return found.select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def placed(marked: DataFrame, find: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """``marked(key, fp)`` with ``component_id`` over the links that ``find``
    gives for the distinct ``fp``."""
    distinct = materialize(marked.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
    linked = connected_components(find(distinct))
    least = linked.join(distinct, linked.node == distinct.fp).groupBy("root").agg(F.min("first").alias("least"))
    moved = linked.join(least, "root").select(F.col("node").alias("fp"), "least")
    at = distinct.join(moved, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return marked.join(at, "fp").select(key, "fp", "component_id")


def _row(docs: DataFrame) -> Column:
    """A hash of the whole row: rows of equal hash and key are the same."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def rows(docs: DataFrame, key: str, fp: Column) -> DataFrame:
    """``key, row, fp`` of each row."""
    return docs.select(F.col(key).alias("key"), _row(docs).alias("row"), fp.alias("fp"))


def keep_one(docs: DataFrame, *, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the
    least key (the least hash of the row where texts share that key), once.
    A row with a null key stays only where its whole component has none."""
    row, name = free_name(docs, "row"), free_name(docs, "simhash")
    marked = fingerprints(docs.select(F.struct(F.col(key).alias("key"), _row(docs).alias("row")).alias(row), text), text=text, key=row, words=words)
    marked = materialize(marked.select(f"{row}.key", f"{row}.row", F.col("fp").alias(name)).withColumnRenamed(name, "fp"), "fingerprints")
    return stay(docs, marked, lambda distinct: links(distinct, max_bits), key)


def stay(docs: DataFrame, marked: DataFrame, find: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """One row of ``docs`` for each component of ``marked(key, row, fp)`` over
    the links that ``find`` gives for distinct ``fp``."""
    first = F.min_by(F.struct("key", "row"), F.struct(F.col("key").isNull(), "key", "row"))
    distinct = materialize(marked.groupBy("fp").agg(first.alias("first")), "distinct")
    linked = connected_components(find(distinct))
    at = distinct.join(linked, distinct.fp == linked.node, "left").select(F.coalesce("root", "fp").alias("root"), "first")
    order = F.struct(F.col("first.key").isNull(), F.col("first.key"), F.col("first.row"))
    kept = at.groupBy("root").agg(F.min_by("first", order).alias("first"))
    kept = materialize(kept.select(F.col("first.key").alias("k"), F.col("first.row").alias("r")), "kept")
    same = marked.join(few(kept), F.col("key").eqNullSafe(F.col("k")) & (F.col("row") == F.col("r"))).groupBy("k", "r").agg(F.count("*").alias("n"))
    name, row, copies, mine = (free_name(docs, c) for c in ("kept", "row", "copies", "mine"))
    kept = materialize(same.select(F.col("k").alias(name), F.col("r").alias(row), F.col("n").alias(copies)), "kept")
    found = docs.withColumn(mine, _row(docs)).join(few(kept), F.col(key).eqNullSafe(F.col(name)) & (F.col(mine) == F.col(row)))
    if kept.where(F.col(copies) > 1).isEmpty():
        return found.select(docs.columns)
    again = found.where(F.col(copies) > 1).dropDuplicates([mine]).select(docs.columns)  # only rows that are the same
    return found.where(F.col(copies) == 1).select(docs.columns).unionByName(again)
