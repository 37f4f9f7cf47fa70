"""Language-model scores from an Elias-Fano n-gram trie in shards.

Three orders with absolute discounting.  Every word of the training texts has
its exact count; every pair and triple seen ``LEAST`` times or more in them is
an entry of the trie, so the model grows with the corpus.  A place scores

    a3(u, v, w) + b2(u, v) * (a2(v, w) + b1(v) * p1(w))

with the discounted shares ``a`` of entries (0 where there is none) and the
back-off weights ``b`` of contexts, each in one of 255 values.

Texts become blocks of bounded size; a block numbers its own words.  Three
exchanges between blocks and shards follow, each of packed arrays and not of
single rows:

* word shards (by hash) add up the blocks' counts and number the words seen
  ``LEAST`` times or more;
* n-gram shards (by the hash of a pair, so that a frequent word is spread over
  all of them) count the pairs and the triples that begin with them, build
  their part of the trie in monotone levels that are mapped into memory, and
  answer every block's pairs and triples by successor search;
* word shards add up what the pairs take from each word.

Shards and blocks grow in number and not in size with the corpus.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.elias_fano import EliasFano, Level, dump, mapped
from marginalia.llm.storage import materialize, small_batches

#: Training count from which a word, pair or triple is in the trie.
LEAST = 2
DISCOUNT = 0.75
#: A block is closed after so many text bytes or distinct words; a longer text
#: is cut into pieces of so many bytes, each led by the two words before it.
BLOCK_BYTES, BLOCK_WORDS, PIECE_BYTES = 6_000_000, 400_000, 4_000_000
#: Words of blocks in a word shard and tokens in an n-gram shard.
SHARD_WORDS, SHARD_TOKENS = 1_000_000, 700_000
_END = b" "  # no word holds a space
_PACK_TOKENS = 50_000
_TEXTS, _WORDS, _ORDER = range(3)
_COUNTS, _ANSWERS, _WEIGHTS, _TAKEN = range(4)


def held_out(key: Column, folds: int = 10) -> Column:
    """True for rows that nothing is learned from; null keys are false."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def pieces(text: str | None, size: int) -> Iterator[tuple[int, bool, list[bytes]]]:
    """A text's words at most some ``size`` bytes at a time, the end last:
    bytes, whether there are several pieces, words."""
    data = (text or "").encode().lower()
    split, at = len(data) > size, 0
    while len(data) - at > size:
        cut = at + size
        while cut < len(data) and data[cut] not in b" \t\n\v\f\r":
            cut += 1
        yield cut - at, True, data[at:cut].split()
        at = cut
    yield len(data) - at, split, [*data[at:].split(), _END]


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, whole numbers (none below zero) in as few
    bytes each as the greatest needs, all first bytes first."""
    heads, bodies = [], []
    for array in arrays:
        if array.dtype.kind != "f":
            array = array.astype(np.min_scalar_type(int(array.max())) if len(array) else np.uint8)
        array = np.ascontiguousarray(array)
        heads.append(struct.pack("<2sq", array.dtype.str[1:].encode(), len(array)))
        bodies.append(array.view(np.uint8).reshape(len(array), -1).T.tobytes() if len(array) else b"")
    return zstandard.ZstdCompressor(level=3).compress(b"".join([struct.pack("<i", len(arrays)), *heads, *bodies]))


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays of :func:`pack`, whole numbers as int64 (wrapped where they
    are hashes)."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    (n,) = struct.unpack_from("<i", raw)
    at, out = 4 + 10 * n, []
    for i in range(n):
        kind, size = struct.unpack_from("<2sq", raw, 4 + 10 * i)
        dtype = np.dtype("<" + kind.decode())
        planes = np.frombuffer(raw, np.uint8, size * dtype.itemsize, at).reshape(dtype.itemsize, size)
        array = np.ascontiguousarray(planes.T).view(dtype).reshape(size)
        at += size * dtype.itemsize
        out.append(array if array.dtype.kind == "f" else array.astype(np.int64))
    return out


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_ROWS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("shard", pa.int64()), ("body", pa.binary())])
_ROWS_DDL = "block bigint, kind int, shard bigint, body binary"


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(_ROWS, rows)] if rows else [], _ROWS)


# ---- blocks ----------------------------------------------------------------


def _numbered(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Rows of some texts (``keys, body``: for each piece whether it is held
    out, how many leading words it repeats, its text's number if that has other
    pieces and else 0, its length; and all word numbers) and of blocks (kind 1:
    hashes in order, as differences, and training counts; kind 2: the words'
    numbers in that order).  ``split``: whether a text has several pieces."""
    small_batches(docs)
    kind = docs.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pyspark.TaskContext.get().partitionId() << 24
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        counts, size = np.zeros(0, np.int64), 0
        rows: list[tuple] = []  # key, held out, repeated words, text number, ids
        tokens, texts = 0, pyspark.TaskContext.get().partitionId() << 32
        type_ = None

        def record(kind_: int, keys: pa.Array, body: bytes, total: int, split: bool) -> pa.RecordBatch:
            values = [pa.array([block], pa.int64()), pa.array([kind_], pa.int32()), keys, pa.array([body], pa.binary()), pa.array([total], pa.int64()), pa.array([split])]
            return pa.RecordBatch.from_arrays(values, ["block", "kind", "keys", "body", "n", "split"])

        def packed() -> pa.RecordBatch:
            nonlocal rows, tokens, counts
            flags = [np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3)]
            ids = np.concatenate([r[4] for r in rows])
            lengths = np.array([len(r[4]) for r in rows])
            learned = [r[4][r[2] :] for r in rows if not r[1]]
            if learned:
                more = np.bincount(np.concatenate(learned), minlength=len(number))
                more[: len(counts)] += counts
                counts = more
            keys = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), pa.array([r[0] for r in rows], type_))
            out = record(_TEXTS, keys, pack(*flags, lengths, ids), len(ids), bool(flags[2].any()))
            rows, tokens = [], 0
            return out

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal block, counts, size
            hashes = np.fromiter(map(_hash, number), np.uint64, len(number))
            padded = np.r_[counts, np.zeros(len(number) - len(counts), np.int64)]
            order, none = np.argsort(hashes), pa.nulls(1, pa.list_(type_))
            yield record(_WORDS, none, pack(np.diff(hashes[order], prepend=np.uint64(0)), padded[order]), len(number), False)
            yield record(_ORDER, none, pack(order), 0, False)
            number.clear()
            block, counts, size = block + 1, np.zeros(0, np.int64), 0

        for batch in batches:
            type_ = batch.schema.field(0).type
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                for name, held, value in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    texts += 1
                    lead = [_END]
                    for span, split, found in pieces(value, PIECE_BYTES):
                        these = lead + found
                        rows.append((name, held, len(lead), texts if split else 0, np.fromiter(map(number.__getitem__, these), np.int64, len(these))))
                        tokens += len(these)
                        size += span
                        lead = these[-2:]
                        if tokens >= _PACK_TOKENS:
                            yield packed()
                        if size >= BLOCK_BYTES or len(number) >= BLOCK_WORDS:
                            if rows:
                                yield packed()
                            yield from close()
        if rows:
            yield packed()
        if number:
            yield from close()

    rows = docs.select(F.col(key).alias("key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"block bigint, kind int, keys array<{kind}>, body binary, n bigint, split boolean")


def _starts(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where shards, which are ranges of hashes, start among ordered ones."""
    shard = (hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    return np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))


def _counted(table: DataFrame, shards: int) -> DataFrame:
    """Per block and word shard the training counts and the numbers (from 1,
    0 for none) of the block's words, in order of hash; per shard the tokens,
    words and words seen once and twice."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                apart, n = unpack(body)
                hashes = np.cumsum(apart.astype(np.uint64))
                starts = _starts(hashes, shards)
                rows = [(block, _COUNTS, s, pack(np.diff(hashes[a:b], prepend=np.uint64(0)), n[a:b])) for s, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)) if a < b]
                for at in range(0, len(rows), 256):
                    yield _batch(_ROWS, rows[at : at + 256])

    def add(chunks: pa.Table) -> pa.Table:
        shard = chunks.column("shard")[0].as_py()
        parts = [unpack(b) for b in chunks.column("body").to_pylist()]
        kinds, place = np.unique(np.concatenate([np.cumsum(p[0].astype(np.uint64)) for p in parts]), return_inverse=True)
        total = np.bincount(place, np.concatenate([p[1] for p in parts]), len(kinds)).astype(np.int64)
        number = np.zeros(len(kinds), np.int64)
        often = np.argsort(-total, kind="stable")[: np.count_nonzero(total >= LEAST)]  # small numbers for frequent words
        number[often] = np.arange(len(often)) * shards + shard + 1
        ends = np.cumsum([len(p[0]) for p in parts])
        bodies = [pack(total[x], number[x]) for x in np.split(place, ends[:-1])]
        out = _table([(b, _COUNTS, shard, body) for b, body in zip(chunks.column("block").to_pylist(), bodies, strict=True)] + [(None, None, None, None)])
        whole = len(out)
        for name, value in (("tokens", total.sum()), ("kinds", (total > 0).sum()), ("ones", (total == 1).sum()), ("twos", (total == 2).sum())):
            out = out.append_column(name, pa.array([None] * (whole - 1) + [int(value)], pa.int64()))
        return out

    chunks = table.where(F.col("kind") == _WORDS).select("block", "body").mapInArrow(deal, _ROWS_DDL)
    return chunks.repartition(shards, "shard").groupBy("shard").applyInArrow(add, _ROWS_DDL + ", tokens bigint, kinds bigint, ones bigint, twos bigint")


@dataclass
class _Block:
    """A block's texts with the counts and numbers of its words."""

    keys: pa.Array
    held: np.ndarray  # per piece
    lead: np.ndarray
    text: np.ndarray
    ends: np.ndarray  # in `words`
    words: np.ndarray  # word of each place, by number in the block
    count: np.ndarray  # per word
    number: np.ndarray  # per word, -1 for none
    order: np.ndarray  # words by hash

    @classmethod
    def of(cls, texts: pa.Table, answers: pa.Table) -> _Block:
        keys, parts, order = [], [], np.zeros(0, np.int64)
        for row, body in zip(texts.column("keys"), texts.column("body").to_pylist(), strict=True):
            if row.is_valid:
                keys.append(row.values)
                parts.append(unpack(body))
            else:
                (order,) = unpack(body)
        counts = _bodies(answers, _COUNTS)
        count, number = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        if counts:
            count[order], number[order] = (np.concatenate([c[i] for c in counts]) for i in (0, 1))
        held, lead, text, lengths, ids = (np.concatenate([p[i] for p in parts]) for i in range(5))
        return cls(pa.concat_arrays(keys), held, lead, text, np.cumsum(lengths), ids, count, number - 1, order)

    def starts(self) -> np.ndarray:
        return np.r_[0, self.ends[:-1]]

    def counted(self) -> np.ndarray:
        """Places that no piece only repeats."""
        starts, lengths = self.starts(), self.ends - self.starts()
        return np.arange(len(self.words)) - np.repeat(starts, lengths) >= np.repeat(self.lead, lengths)


def _bodies(answers: pa.Table, kind: int) -> list[list[np.ndarray]]:
    """Unpacked bodies of a kind in order of shard."""
    rows = [(s, b) for k, s, b in zip(*(answers.column(c).to_pylist() for c in ("kind", "shard", "body")), strict=True) if k == kind]
    return [unpack(b) for _, b in sorted(rows, key=lambda r: r[0])]


@dataclass
class _Grams:
    """Distinct pairs of a block in order of shard and words, the triples
    that begin with them, and the places in both of the block's words."""

    u: np.ndarray  # of pairs, as words of the block
    v: np.ndarray
    first: np.ndarray  # of triples, as pairs
    w: np.ndarray
    bounds: np.ndarray  # of shards in pairs
    pair: np.ndarray  # per place, -1 for none
    triple: np.ndarray

    @classmethod
    def of(cls, block: _Block, shards: int) -> _Grams:
        # words by their numbers, so that pairs come in order of numbers
        some = np.flatnonzero(block.number >= 0)
        by_rank = some[np.argsort(block.number[some], kind="stable")]
        rank = np.full(len(block.number), -1, np.int64)
        rank[by_rank] = np.arange(len(by_rank))
        kinds = max(len(by_rank), 1)
        at = rank[block.words]
        before = np.r_[np.int64(-1), at[:-1]]
        before[block.starts()] = -1
        places = np.flatnonzero((at >= 0) & (before >= 0))
        pairs, found = np.unique(before[places] * kinds + at[places], return_inverse=True)
        u, v = by_rank[pairs // kinds], by_rank[pairs % kinds]
        shard = _shard_of(block.number[u], block.number[v], shards)
        order = np.argsort(shard, kind="stable")
        moved = np.empty(len(order), np.int64)
        moved[order] = np.arange(len(order))
        pair = np.full(len(at), -1, np.int64)
        pair[places] = moved[found]
        ahead = np.r_[np.int64(-1), pair[:-1]]
        ahead[block.starts()] = -1
        places = np.flatnonzero((ahead >= 0) & (pair >= 0))
        triples, found = np.unique(ahead[places] * kinds + at[places], return_inverse=True)
        triple = np.full(len(at), -1, np.int64)
        triple[places] = found
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        return cls(u[order], v[order], triples // kinds, by_rank[triples % kinds], bounds, pair, triple)


def _shard_of(u: np.ndarray, v: np.ndarray, shards: int) -> np.ndarray:
    x = u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + v.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    kind = np.uint16 if shards <= 1 << 16 else np.int64  # sixteen bits are sorted by radix
    return ((x ^ (x >> np.uint64(29))) % np.uint64(shards)).astype(kind)


def _together(table: DataFrame, answers: DataFrame, blocks: int):
    """Texts and answers of each block."""
    left = table.where(F.col("kind") != _WORDS).select("block", "keys", "body").repartition(blocks, "block")
    return left.groupBy("block").cogroup(answers.repartition(blocks, "block").groupBy("block"))


def _grams(table: DataFrame, counted: DataFrame, blocks: int, shards: int) -> DataFrame:
    """Per block and n-gram shard the distinct pairs and triples with their
    training counts."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block.of(texts, answers)
        grams = _Grams.of(block, shards)
        learned = block.counted() & np.repeat(block.held == 0, block.ends - block.starts())
        n2, n3 = (np.bincount(x[learned & (x >= 0)], minlength=n) for x, n in ((grams.pair, len(grams.u)), (grams.triple, len(grams.w))))
        name = texts.column("block")[0].as_py()
        follow = np.bincount(grams.first, minlength=len(grams.u))
        upto = np.r_[0, np.cumsum(follow)]
        rows = []
        for s, (a, b) in enumerate(zip(grams.bounds[:-1], grams.bounds[1:], strict=True)):
            if a < b:
                x, y = upto[a], upto[b]
                u, v = grams.u[a:b], grams.v[a:b]
                new = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
                body = pack(
                    np.diff(block.number[u[new]], prepend=0), block.count[u[new]], np.diff(np.r_[new, b - a]),
                    block.number[v], n2[a:b], follow[a:b], block.number[grams.w[x:y]], n3[x:y],
                )
                rows.append((name, _ANSWERS, s, body))
        return _table(rows)

    return _together(table, counted.where("block is not null").select(*_ROWS.names), blocks).applyInArrow(run, _ROWS_DDL)


# ---- the trie --------------------------------------------------------------


class Codes:
    """At most 255 values that stand for all of a set of values above zero: all
    if they are few, else even quantiles for the many and even ratios for the
    outer ones; code 0 is for what is not in the set."""

    def __init__(self, values: np.ndarray):
        kinds = np.unique(values)
        if len(kinds) > 255:
            kinds = np.unique(np.r_[np.quantile(values, (np.arange(128) + 0.5) / 128), np.geomspace(kinds[0], kinds[-1], 127)])
        self.book = kinds.astype(np.float32)
        self.codes = (np.searchsorted((kinds[1:] + kinds[:-1]) / 2, values) + 1).astype(np.uint8)


class Trie:
    """A shard of the model: words ``v`` after words ``u``, words ``w`` after
    these pairs, with quantised shares and weights, over mapped arrays."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.pairs, self.triples = (Level(self._sequence(f"{n}.pointers"), self._sequence(f"{n}.words")) for n in ("pairs", "triples"))

    def _sequence(self, name: str) -> EliasFano:
        return EliasFano.of([self.arrays[f"{name}.{i}"] for i in range(4)])

    @classmethod
    def build(cls, contexts: int, context: np.ndarray, word: np.ndarray, n2: np.ndarray, of_context: np.ndarray, first: np.ndarray, after: np.ndarray, n3: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The levels, and what the pairs take from each context.  Pairs are
        in order of context and word, triples of pair and word."""
        arrays: dict[str, np.ndarray] = {}
        for name, level in (("pairs", Level.encode(contexts, context, word)), ("triples", Level.encode(len(word), first, after))):
            for part, sequence in (("pointers", level.pointers), ("words", level.words)):
                arrays |= {f"{name}.{part}.{i}": a for i, a in enumerate(sequence.arrays())}
        share2 = (n2 - DISCOUNT) / of_context[context]
        share3 = (n3 - DISCOUNT) / n2[first]
        weight = np.clip(1 - np.bincount(first, share3, len(word)), 1e-6, 1)
        for name, values in (("share2", share2), ("share3", share3), ("weight", weight)):
            coded = Codes(values)
            arrays |= {f"{name}.book": coded.book, f"{name}.codes": coded.codes}
        return dump(arrays), np.bincount(context, share2, contexts)

    def code(self, name: str, entry: np.ndarray) -> np.ndarray:
        """Codes of entries, 0 for entry -1."""
        return np.r_[self.arrays[f"{name}.codes"], np.uint8(0)][entry]

    def book(self, name: str) -> np.ndarray:
        return self.arrays[f"{name}.book"]

    def find(self, level: Level, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Entries of words after contexts, -1 for contexts of -1."""
        out = np.full(len(word), -1, np.int64)
        some = np.flatnonzero(context >= 0)
        for at in range(0, len(some), 1 << 18):
            part = some[at : at + (1 << 18)]
            out[part] = level.find(context[part], word[part])
        return out


def _answered(grams: DataFrame, word_shards: int, shards: int) -> DataFrame:
    """Per block and n-gram shard the codes of the block's pairs and triples;
    per word shard what pairs take from its words."""

    def run(chunks: pa.Table) -> pa.Table:
        chunks = chunks.sort_by("block")
        shard = chunks.column("shard")[0].as_py()
        blocks = chunks.column("block").to_pylist()
        parts = [unpack(b) for b in chunks.column("body").to_pylist()]
        del chunks
        sizes = [(len(p[3]), len(p[6])) for p in parts]

        def column(i: int) -> np.ndarray:
            out = np.concatenate([p[i] for p in parts])
            for p in parts:
                p[i] = p[i][:0]  # held once
            return out

        known, place = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
        of_context = np.zeros(len(known), np.int64)
        of_context[place] = column(1)
        u = np.repeat(place, column(2))
        v, n2, follow, w, n3 = (column(i) for i in range(3, 8))
        base = int(max(v.max(), w.max() if len(w) else 0)) + 1
        pairs, pair = np.unique(u * base + v, return_inverse=True)
        total2 = np.bincount(pair, n2, len(pairs)).astype(np.int64)
        triples, triple = np.unique(np.repeat(pair, follow) * base + w, return_inverse=True)
        total3 = np.bincount(triple, n3, len(triples)).astype(np.int64)
        del u, v, w, n2, n3, follow
        kept2, kept3 = np.flatnonzero(total2 >= LEAST), np.flatnonzero(total3 >= LEAST)
        entry = np.full(len(pairs), -1, np.int64)
        entry[kept2] = np.arange(len(kept2))
        data, taken = Trie.build(
            len(known), pairs[kept2] // base, pairs[kept2] % base, total2[kept2], of_context, entry[triples[kept3] // base], triples[kept3] % base, total3[kept3]
        )
        trie = Trie(mapped(data))
        del total2, total3, entry, kept3
        found2 = trie.find(trie.pairs, pairs // base, pairs % base)
        found3 = trie.find(trie.triples, found2[triples // base], triples % base)
        share2, weight, share3 = trie.code("share2", found2)[pair], trie.code("weight", found2)[pair], trie.code("share3", found3)[triple]
        books = [trie.book(n) for n in ("share2", "weight", "share3")]
        rows, a, x = [], 0, 0
        for block, (pairs_, triples_) in zip(blocks, sizes, strict=True):
            b, y = a + pairs_, x + triples_
            rows.append((block, _ANSWERS, shard, pack(share2[a:b], weight[a:b], share3[x:y], *books)))
            a, x = b, y
        some = np.flatnonzero(taken > 0)
        to = known[some] % word_shards
        for s in np.unique(to):
            these = some[to == s]
            rows.append((shard, _TAKEN, int(s), pack(known[these] // word_shards, taken[these])))
        return _table(rows)

    return grams.repartition(shards, "shard").groupBy("shard").applyInArrow(run, _ROWS_DDL)


def _weighted(counted: DataFrame, answered: DataFrame, shards: int) -> DataFrame:
    """Per block and word shard the codes of the back-off weights of the
    block's numbered words."""

    def run(numbers: pa.Table, taken: pa.Table) -> pa.Table:
        blocks = numbers.column("block").to_pylist()
        if not blocks:
            return _table([])
        shard = numbers.column("shard")[0].as_py()
        rows = [unpack(b) for b in taken.sort_by("block").column("body").to_pylist()]
        place = [np.flatnonzero(x[1]) for x in (unpack(b) for b in numbers.column("body").to_pylist())]
        ranks = [(unpack(b)[1][p] - 1) // shards for b, p in zip(numbers.column("body").to_pylist(), place, strict=True)]
        size = 1 + max((int(r.max()) for r in ranks if len(r)), default=0)
        total = np.zeros(size)
        for rank, part in rows:
            total[rank] += part
        coded = Codes(np.clip(1 - total, 1e-6, 1))
        return _table([(b, _WEIGHTS, shard, pack(coded.codes[r], coded.book)) for b, r in zip(blocks, ranks, strict=True)])

    left, right = counted.where("block is not null").select(*_ROWS.names), answered.where(F.col("kind") == _TAKEN)
    return left.repartition(shards, "shard").groupBy("shard").cogroup(right.repartition(shards, "shard").groupBy("shard")).applyInArrow(run, _ROWS_DDL)


# ---- scores ----------------------------------------------------------------


@dataclass(frozen=True)
class Unigrams:
    """N, V and the discount of single words."""

    tokens: int
    kinds: int
    discount: float

    def share(self, counts: np.ndarray) -> np.ndarray:
        """Unseen words have the discounted mass as one event."""
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, counts - self.discount, self.discount * self.kinds) / self.tokens

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))


def _values(codes: list[np.ndarray], books: list[np.ndarray], absent: float) -> np.ndarray:
    found = [np.r_[np.float32(absent), book][code] for code, book in zip(codes, books, strict=True)]
    return np.concatenate([*found, np.zeros(0, np.float32)])


def _places(block: _Block, grams: _Grams, answers: pa.Table, unigrams: Unigrams) -> np.ndarray:
    """The probability of each place of a block."""
    found, weights = _bodies(answers, _ANSWERS), _bodies(answers, _WEIGHTS)
    share2, weight2, share3 = (np.r_[_values([f[i] for f in found], [f[i + 3] for f in found], x), np.float32(x)] for i, x in ((0, 0), (1, 1), (2, 0)))
    weight1 = np.ones(len(block.number))
    weight1[block.order[block.number[block.order] >= 0]] = _values([w[0] for w in weights], [w[1] for w in weights], 1)
    back = np.r_[1.0, weight1[block.words[:-1]]]
    ahead = np.r_[np.int64(-1), grams.pair[:-1]]
    ahead[block.starts()] = -1
    lower = share2[grams.pair] + back * unigrams.share(block.count)[block.words]
    return share3[grams.triple] + weight2[ahead] * lower


def score(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    One row per input row; scores are log10 probabilities of the whole text
    and its end.  ``base_score`` smooths unigrams by 0.1; ``score`` is the
    trie's.  Null and empty texts are an end alone; null keys are learned from
    and scored; repeated rows are learned and scored as often as they come;
    without training texts every token scores 0 in ``score``; an empty table
    gives no rows.  Texts of any length are scored whole, in pieces where they
    are very long; other columns are never read; no tie is ever broken.
    """
    spark = docs.sparkSession
    table = materialize(_numbered(docs, text, key), "numbered")
    sums = table.agg(
        F.sum(F.when(F.col("kind") == _WORDS, F.col("n"))).alias("words"),
        F.sum(F.when(F.col("kind") == _TEXTS, F.col("n"))).alias("tokens"),
        F.count_if(F.col("kind") == _ORDER).alias("blocks"),
        F.max("split").alias("split"),
    ).first()
    word_shards, shards, blocks = 1 + (sums["words"] or 0) // SHARD_WORDS, 1 + (sums["tokens"] or 0) // SHARD_TOKENS, max(sums["blocks"], 1)
    counted = materialize(_counted(table, word_shards), "counted")
    row = counted.agg(*(F.sum(c).alias(c) for c in ("tokens", "kinds", "ones", "twos"))).first()
    discount = row["ones"] / (row["ones"] + 2 * row["twos"]) if row["ones"] and row["twos"] else 0.5
    unigrams = Unigrams(row["tokens"] or 0, row["kinds"] or 0, discount)
    answered = materialize(_answered(_grams(table, counted, blocks, shards), word_shards, shards), "answered")
    weighted = _weighted(counted, answered, word_shards)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block.of(texts, answers)
        grams = _Grams.of(block, shards)
        on, starts = block.counted(), block.starts()
        total = np.where(on, np.log10(_places(block, grams, answers, unigrams)), 0)
        plain = np.where(on, unigrams.base(block.count)[block.words], 0)
        known = on & (block.count[block.words] > 0)
        return pa.table(
            {
                key: block.keys,
                "held_out": pa.array(block.held > 0),
                "n_tokens": pa.array(np.add.reduceat(on, starts, dtype=np.int64)),
                "n_known": pa.array(np.add.reduceat(known, starts, dtype=np.int64)),
                "train_tokens": pa.array(np.full(len(starts), unigrams.tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(plain, starts)),
                "score": pa.array(np.add.reduceat(total, starts)),
                "piece of": pa.array(block.text),
            }
        )

    kind = docs.select(key).schema[0].dataType.simpleString()
    answers = counted.where("block is not null").select(*_ROWS.names).unionByName(answered.where(F.col("kind") == _ANSWERS)).unionByName(weighted)
    found = _together(table, answers, blocks).applyInArrow(
        run, f"`{key}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, `piece of` bigint"
    )
    if not sums["split"]:
        return found.drop("piece of")
    found = materialize(found, "pieces")
    same = [F.first(c).alias(c) for c in (key, "held_out")]
    added = [(F.first(c) if c == "train_tokens" else F.sum(c)).alias(c) for c in found.columns[2:-1]]
    whole = found.where("`piece of` > 0").groupBy("piece of").agg(*same, *added)
    return found.where("`piece of` = 0").drop("piece of").unionByName(whole.drop("piece of"))
