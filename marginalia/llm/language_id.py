"""Language identification with hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1 in :data:`DIMENSIONS`
dimensions, drawn from its code point.  A three-letter n-gram is the product of
its letters' vectors, the first rotated by two places, the second by one; a
document and a language are the sums of their n-grams.  A document is compared
with each language's sum by cosine.

Learning sums n-grams per language inside each task and adds up one integer
per language and dimension, so what travels does not grow with the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.native_text import text_hash
from marginalia.llm.storage import free_name, small_batches

DIMENSIONS = 1024
#: Name of texts without a letter.
UNDETERMINED = "und"
#: Cosine below which a document is in none of the learned languages; unrelated
#: profiles are within 0.03 of zero in nearly all cases.
MIN_SCORE = 0.05
#: N-gram and letter vectors held by a worker, one byte a dimension, and
#: n-grams multiplied at a time.
CACHE_NGRAMS, CACHE_LETTERS, _BLOCK_NGRAMS = 40_000, 20_000, 8_192
#: Languages that a model may have; one has :data:`DIMENSIONS` numbers.
MAX_LANGUAGES = 1_000
_BLOCK_DOCS = 64
_BLOCK_CHARS = 2_000_000


class _Space:
    """Letters, n-grams and their vectors."""

    def __init__(self) -> None:
        self.letter = np.zeros(0x110000, bool)
        self.letter[[c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]] = True
        self.letters: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((1024, DIMENSIONS), np.int8)

    def letter_vector(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) >= CACHE_LETTERS:
                self.letters.clear()
            bits = np.random.Generator(np.random.Philox(key=7_919 + code)).integers(0, 2, DIMENSIONS, np.int8)
            self.letters[code] = 2 * bits - 1
        return self.letters[code]

    def ngram_vectors(self, grams: np.ndarray) -> np.ndarray:
        """A row for each packed n-gram."""
        if len(self.rows) > CACHE_NGRAMS:
            self.clear()
        at = np.empty(len(grams), np.int64)
        for i, gram in enumerate(grams.tolist()):
            row = self.rows.get(gram)
            if row is None:
                row = self.rows[gram] = len(self.rows)
                if row == len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
                a, b, c = gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF
                self.vectors[row] = np.roll(self.letter_vector(a), 2) * np.roll(self.letter_vector(b), 1) * self.letter_vector(c)
            at[i] = row
        return self.vectors[at]

    def profile(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n-grams, text numbers, places in n-grams) over all texts; a run of
        other characters counts as one gap letter, code 0."""
        codes, owners = [], []
        for i, text in enumerate(texts):
            code = np.frombuffer(f" {text} ".lower().encode("utf-32-le"), "<u4")
            code = np.where(self.letter[code], code, 0)
            code = code[(code > 0) | np.r_[True, code[:-1] > 0]]
            if len(code) > 2:
                codes.append(code)
                owners.append(np.full(len(code), i))
        if not codes:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        code, owner = np.concatenate(codes), np.concatenate(owners)
        alphabet = np.flatnonzero(np.bincount(code))
        k = len(alphabet)
        small = np.zeros(int(alphabet[-1]) + 1, np.int64)
        small[alphabet] = np.arange(k)
        c = small[code]
        gram = (c[:-2] * k + c[1:-1]) * k + c[2:]
        one = owner[:-2] == owner[2:]
        gram, owner = gram[one], owner[:-2][one]
        if k**3 <= 1 << 24:
            there = np.zeros(k**3, bool)
            there[gram] = True
            kinds = np.flatnonzero(there)
            rank = np.empty(k**3, np.int64)
            rank[kinds] = np.arange(len(kinds))
            place = rank[gram]
        else:
            kinds, place = np.unique(gram, return_inverse=True)
        packed = alphabet[kinds // (k * k)] << 42 | alphabet[kinds // k % k] << 21 | alphabet[kinds % k]
        return packed, owner, place


_spaces: list[_Space] = []


def _space() -> _Space:
    if not _spaces:
        _spaces.append(_Space())
    return _spaces[0]


def bundled(space: _Space, grams: np.ndarray, owner: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
    """The sum of each owner's n-gram vectors, some n-grams at a time."""
    total = np.zeros((rows, DIMENSIONS), np.int64)
    if len(grams) > _BLOCK_NGRAMS:
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
    for at in range(0, len(grams), _BLOCK_NGRAMS):
        part = grams[at : at + _BLOCK_NGRAMS]
        a, z = np.searchsorted(place, (at, at + len(part))) if len(grams) > _BLOCK_NGRAMS else (0, len(place))
        counts = np.bincount(owner[a:z] * len(part) + place[a:z] - at, minlength=rows * len(part)).reshape(rows, len(part))
        # whole numbers below 2**24 are exact in single precision
        exact = np.float32 if z - a < 1 << 24 else np.float64
        total += (counts.astype(exact) @ space.ngram_vectors(part).astype(exact)).astype(np.int64)
    return total


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= _BLOCK_DOCS or size + len(text) > _BLOCK_CHARS):
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def held_out(key: Column, folds: int = 5) -> Column:
    """True for rows that nothing is learned from; null keys are false."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, *, text: str = "text", key: str = "doc_id", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order and their sums, from rows with a language that are
    not held out.  What is returned has one row of numbers per language."""
    small_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = _space(), {}
        for batch in batches:
            texts, langs = [t or "" for t in batch.column(0).to_pylist()], batch.column(1).to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs], np.int64)
            for a, z in _blocks(texts):
                grams, owner, place = space.profile(texts[a:z])
                for name, row in zip(names, bundled(space, grams, number[a:z][owner], place, len(names)), strict=True):
                    sums[name] = sums.get(name, 0) + row
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * DIMENSIONS), pa.array(range(DIMENSIONS), pa.int32()), pa.array(total)], ["lang", "place", "total"])

    known = docs.where(F.col(lang).isNotNull() & ~held_out(F.col(key))).select(text, F.col(lang).alias("lang"))
    sums = known.mapInArrow(run, "lang string, place int, total bigint").groupBy("lang", "place").agg(F.sum("total").alias("total"))
    rows = sums.limit(DIMENSIONS * MAX_LANGUAGES + 1).collect()  # DIMENSIONS numbers a language
    if len(rows) > DIMENSIONS * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted({r["lang"] for r in rows})
    out = np.zeros((len(langs), DIMENSIONS))
    place = {x: i for i, x in enumerate(langs)}
    for r in rows:
        out[place[r["lang"]], r["place"]] = r["total"]
    return langs, out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, held_out, lang_pred, score`` per row, score being the cosine with
    the closest language (0 where it is negative or nothing was learned)."""
    langs, sums = model
    units = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = _space()
        names = np.array([*langs, UNDETERMINED], object)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            best, score = np.full(len(texts), len(langs)), np.zeros(len(texts))
            for a, z in _blocks(texts) if langs else ():
                grams, owner, place = space.profile(texts[a:z])
                if not len(grams):
                    continue
                total = bundled(space, grams, owner, place, z - a).astype(np.float64)
                cosine = total @ units.T / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
                has = np.bincount(owner, minlength=z - a) > 0
                best[a:z] = np.where(has, cosine.argmax(axis=1), len(langs))
                score[a:z] = np.where(has, np.clip(cosine.max(axis=1), 0, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names[best], pa.string()), pa.array(score.round(6))], [key, "held_out", "lang_pred", "score"]
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias(key), held_out(F.col(key)).alias("held_out"), text)
    return rows.mapInArrow(run, f"`{key}` {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, *, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """Fits on ``docs`` and predicts every row.

    Null texts and texts without a letter are ``und`` with score 0; an equal
    cosine goes to the language first in order; null languages teach nothing;
    null keys and repeated rows are predicted as they come; very long texts are
    read whole, some n-grams at a time; other columns are never read; an empty
    table gives no rows.
    """
    return predict(docs, fit(docs, text=text, key=key, lang=lang), text=text, key=key)


def keep_known(docs: DataFrame, *, min_score: float = MIN_SCORE, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is found with at least ``min_score``,
    each by its own text, whatever other rows have its key."""
    row, name, other = free_name(docs, "row"), free_name(docs, "bad_key"), free_name(docs, "bad_text")
    marked = docs.select(F.struct(F.col(key).alias("key"), text_hash(F.col(text)).alias("text")).alias(row), text)
    found = predict(marked, fit(docs, text=text, key=key, lang=lang), text=text, key=row)
    rejected = found.where((F.col("lang_pred") == UNDETERMINED) | (F.col("score") < min_score))
    bad = rejected.select(F.col(f"{row}.key").alias(name), F.col(f"{row}.text").alias(other)).distinct()
    return docs.join(bad, F.col(key).eqNullSafe(F.col(name)) & (text_hash(F.col(text)) == F.col(other)), "left_anti")
