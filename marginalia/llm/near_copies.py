"""Near copies: texts that share 80 % or more of their five-word shingles.

Candidates come from the SimHash anchors of :mod:`marginalia.llm.simhash` over
the same shingles, which find the closest copies, and from MinHash bands (32
bands of 6 values; a pair of similarity 0.8 meets in none with a chance of
6e-5), as random shingle sets of that similarity differ in about 10 of 64
SimHash bits.  Every link is checked exactly on the shingles of both texts.

No pairs of a group are listed.  First each bucket's members are checked
against one hub, by size and signature and, where these allow it, by shingles.
A bucket whose members are then in one component is done; in the others all
members are compared with each other by blocks of bounded size, two blocks a
task: first their signatures, which leave the members that may be near one of
another component, then the shingles of these, and only links that connect
components are emitted.  So each pair that met is either checked or connected by
checked links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm import simhash
from marginalia.llm.components import connected_components
from marginalia.llm.storage import few, materialize, small_batches

SHINGLE_WORDS = 5
#: Least similarity as a fraction, so that it is compared in whole numbers.
SHARED, OF = 4, 5
BANDS, BAND_VALUES = 32, 6
#: Minima of both texts that agree at least before their shingles are compared:
#: five standard deviations under what a similarity of 0.8 gives (a pair at 0.8
#: is missed with a chance of 3e-7).
LIKELY = 126
#: Shingles of a block of texts (a text counts as :data:`LEAST_COST` at least),
#: and members of a block of signatures.
BLOCK_SHINGLES, LEAST_COST, BLOCK_MEMBERS = 200_000, 200, 1_000
_BLOCK, _CACHED = 512, 500_000
_RANDOM = np.random.default_rng(42)
_FACTORS = _RANDOM.integers(0, 1 << 64, (BANDS * BAND_VALUES, 1), np.uint64) | np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 1 << 64, (BANDS * BAND_VALUES, 1), np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes; all words of a shorter
    text are one shingle, and a text without words has none."""
    found = (text or "").encode().lower().split()
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    size = min(SHINGLE_WORDS, len(found))
    if not size:
        return hashes
    n = len(found) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = out * _STEP + hashes[i : i + n]
    return np.unique(_mixed(out))


def signature(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's bucket in each band, and the last byte of each of its minima;
    texts without shingles share theirs."""
    least = np.full(BANDS * BAND_VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _BLOCK):
        values = found[None, at : at + _BLOCK] * _FACTORS
        values += _OFFSETS
        np.minimum(least, values.min(axis=1), out=least)
    out = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_VALUES).T:
        out = _mixed(out * _STEP + column)
    return out, _mixed(least).astype(np.uint8)


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets reach the least similarity."""
    if OF * min(len(a), len(b)) < SHARED * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return OF * shared >= SHARED * (len(a) + len(b) - shared)


def _fp(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _signed(docs: DataFrame, text: str) -> DataFrame:
    """``fp, n, buckets, sig``: each distinct text's shingles and signature."""
    small_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                kinds = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
                rows = []
                for fp, value in kinds.items():
                    found = shingles(value, known)
                    points, sig = signature(found)
                    rows.append((fp, len(found), points.view(np.int64), sig.tobytes()))
                kinds_ = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds_, strict=True)], ["fp", "n", "buckets", "sig"])

    found = docs.select(_fp(text).alias("fp"), text).mapInArrow(run, "fp bigint, n bigint, buckets array<bigint>, sig binary")
    return materialize(found.dropDuplicates(["fp"]), "signatures")


def likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether sets with these signatures (a row each) and sizes may be near:
    sizes allow it, and at least :data:`LIKELY` minima agree."""
    fits = OF * np.minimum(na, nb) >= SHARED * np.maximum(na, nb)
    return fits & ((a == b).sum(axis=-1) >= LIKELY)


def _screened(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs ``u, v`` that may be near by their signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(len(batch), -1) for i in (2, 3))
                na, nb = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
                yield batch.select([0, 1]).filter(pa.array(likely(a, b, na, nb)))

    half = signed.select("fp", "sig", "n")
    one, two = (half.select(F.col("fp").alias(x), F.col("sig").alias(f"s{x}"), F.col("n").alias(f"n{x}")) for x in "uv")
    return pairs.join(one, "u").join(two, "v").select("u", "v", "su", "sv", "nu", "nv").mapInArrow(run, "u bigint, v bigint")


def _texts(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``fp, t`` of the texts in ``wanted(fp)``."""
    found = docs.select(_fp(text).alias("fp"), F.col(text).alias("t")).join(few(materialize(wanted.distinct(), "wanted")), "fp", "left_semi")
    return materialize(found.dropDuplicates(["fp"]), "compared")


def _checked(pairs: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The pairs ``u, v`` whose texts are near."""
    texts = _texts(docs, text, pairs.select(F.col("u").alias("fp")).unionByName(pairs.select(F.col("v").alias("fp"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, left = _Words(), None, None
        for batch in batches:
            linked = []
            for u, a, b in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if left is None or u != last:
                    last, left = u, shingles(a, known)
                linked.append(near(left, shingles(b, known)))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    first = texts.select(F.col("fp").alias("u"), F.col("t").alias("a"))
    second = texts.select(F.col("fp").alias("v"), F.col("t").alias("b"))
    return pairs.join(first, "u").join(second, "v").select("u", "v", "a", "b").mapInArrow(run, "u bigint, v bigint")


def _in_blocks(members: DataFrame, cost: Column, size: int, *more: str) -> DataFrame:
    """``bucket, i, j, block, fp, n, root`` and ``more``: each member in all
    pairs of blocks ``i <= j`` of its bucket that hold its own and texts of like
    size; a block's members cost ``size`` at most, or are one."""
    upto = F.sum(cost).over(Window.partitionBy("bucket").orderBy("n", "fp").rowsBetween(Window.unboundedPreceding, -1))
    cut = members.withColumn("block", F.floor(F.coalesce(upto, F.lit(0)) / size))
    ranges = cut.groupBy("bucket", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    every = ranges.groupBy("bucket").agg(F.collect_list(F.struct("block", "lo", "hi")).alias("every"))
    other = F.explode(F.expr(f"filter(every, r -> {SHARED} * greatest(r.lo, lo) <= {OF} * least(r.hi, hi))"))
    cut = cut.join(ranges, ["bucket", "block"]).join(every, "bucket").withColumn("o", other)
    return cut.select("bucket", F.least("block", "o.block").alias("i"), F.greatest("block", "o.block").alias("j"), "block", "fp", "n", "root", *more)


def partnered(sigs: np.ndarray, sizes: np.ndarray, roots: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Which members may be near one of another root, of the other block where
    there are two."""
    out = np.zeros(len(sigs), bool)
    two = len(block) > 0 and block[0] != block[-1]
    for at in range(0, len(sigs), 64):
        part = slice(at, at + 64)
        met = likely(sigs[part, None, :], sigs[None, :, :], sizes[part, None], sizes[None, :]) & (roots[part, None] != roots[None, :])
        if two:
            met &= block[part, None] != block[None, :]
        out[part] |= met.any(axis=1)
    return out


def _undecided(members: DataFrame, signed: DataFrame) -> DataFrame:
    """The members that may be near another one of their bucket."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("block", "ascending"), ("fp", "ascending")])
        sigs = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(group), -1)
        kept = partnered(sigs, *(group.column(c).to_numpy() for c in ("n", "root", "block")))
        return group.select(["bucket", "fp", "n", "root"]).filter(pa.array(kept))

    placed = _in_blocks(members.join(signed.select("fp", "sig"), "fp"), F.lit(1), BLOCK_MEMBERS, "sig")
    return placed.groupBy("bucket", "i", "j").applyInArrow(run, "bucket bigint, fp bigint, n bigint, root bigint").distinct()


def connecting(sets: list[np.ndarray], block: np.ndarray, roots: list[int]) -> list[tuple[int, int]]:
    """Near pairs of sets, of different blocks where there are two, that join
    what has not been joined before."""
    parent = {r: r for r in roots}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    sizes = np.array([len(s) for s in sets], np.int64)
    kinds, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)[np.argsort(column, kind="stable")]
    starts = np.r_[0, np.cumsum(np.bincount(column, minlength=len(kinds)))]
    ends = np.cumsum(sizes)
    two = block[0] != block[-1] if len(block) else False
    out = []
    for a in range(len(sets)):
        mine = column[ends[a] - sizes[a] : ends[a]]
        lengths = starts[mine + 1] - starts[mine]
        at = np.arange(lengths.sum()) + np.repeat(starts[mine] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) if len(mine) else np.zeros(0, np.int64)
        shared = np.bincount(owner[at], minlength=len(sets))
        close = OF * shared >= SHARED * (sizes[a] + sizes - shared)
        close[: a + 1] = False
        if two:
            close &= block != block[a]
        for b in np.flatnonzero(close).tolist():
            x, y = find(roots[a]), find(roots[b])
            if x != y:
                parent[x] = y
                out.append((a, b))
    return out


def _compared(members: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """Links ``u, v`` between members ``bucket, fp, n, root`` of a bucket."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("block", "ascending"), ("fp", "ascending")])
        known, fps = _Words(), group.column("fp").to_pylist()
        sets = [shingles(t, known) for t in group.column("t").to_pylist()]
        found = connecting(sets, group.column("block").to_numpy(), group.column("root").to_pylist())
        return pa.table({"u": pa.array([fps[a] for a, _ in found], pa.int64()), "v": pa.array([fps[b] for _, b in found], pa.int64())})

    blocks = _in_blocks(members, F.greatest("n", F.lit(LEAST_COST)), BLOCK_SHINGLES)
    placed = blocks.join(_texts(docs, text, members.select("fp")), "fp")
    return placed.groupBy("bucket", "i", "j").applyInArrow(run, "u bigint, v bigint").distinct()


def _anchored(docs: DataFrame, text: str) -> DataFrame:
    """Candidates ``u, v`` by SimHash: texts of one fingerprint, and of
    fingerprints that meet at an anchor."""
    marked = simhash.fingerprints(docs.select(_fp(text).alias("t"), text), text=text, key="t", words=SHINGLE_WORDS)
    marked = materialize(marked.dropDuplicates(["t"]), "fingerprints")
    first = materialize(marked.groupBy("fp").agg(F.min("t").alias("u")), "firsts")
    same = marked.join(first, "fp").where("t <> u").select("u", F.col("t").alias("v"))
    near_ = simhash.links(first).select(F.col("u").alias("a"), F.col("v").alias("b"))
    left, right = first.select(F.col("fp").alias("a"), "u"), first.select(F.col("fp").alias("b"), F.col("u").alias("v"))
    return same.unionByName(near_.join(left, "a").join(right, "b").select("u", "v"))


def links(docs: DataFrame, text: str = "text") -> DataFrame:
    """Checked links ``(u, v)`` between texts by their hashes, which connect
    all texts that meet in a bucket and are near."""
    whole = Window.partitionBy("bucket")
    signed = _signed(docs, text)
    members = signed.select(F.explode("buckets").alias("bucket"), "fp", "n")
    members = members.withColumn("m", F.count("*").over(whole)).where("m > 1").withColumn("hub", F.min("fp").over(whole))
    members = materialize(members.select("bucket", "fp", "n", "hub"), "members")
    pairs = members.where("fp <> hub").select(F.col("hub").alias("u"), F.col("fp").alias("v")).unionByName(_anchored(docs, text))
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    found = materialize(_checked(materialize(_screened(pairs, signed), "pairs"), docs, text), "links")
    roots = connected_components(found).select(F.col("node").alias("fp"), "root")
    rest = members.drop("hub").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rest = rest.withColumn("least", F.min("root").over(whole)).withColumn("most", F.max("root").over(whole))
    rest = rest.withColumn("m", F.count("*").over(whole)).where("least <> most and m > 2").drop("least", "most", "m")
    rest = materialize(_undecided(rest, signed), "undecided")
    return found.unionByName(_compared(rest, docs, text))


def keep_one(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near copies the row
    with the least key, as in :func:`simhash.keep_one`."""
    return simhash.stay(docs, simhash.rows(docs, key, _fp(text)), lambda distinct: links(docs, text), key)
