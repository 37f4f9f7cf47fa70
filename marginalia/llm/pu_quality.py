"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1, the unlabelled set is any
text; rows of quality 0 are never looked at.  A logistic model over style
statistics minimises the non-negative unbiased risk (Kiryo et al., 2017)

    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))

with the logistic loss; where the second part turns negative, the step ascends
on it instead.  The class prior pi is estimated by the best bin (Garg et al.,
2021): the least ratio, over score thresholds, of the unlabelled share above
the threshold to the positive share above it.

The fit uses bounded samples of both sets, taken by the order of a hash of the
key; every row is then scored from its whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.storage import small_batches

#: Rows of the positive and of the unlabelled sample, at most.
SAMPLE_ROWS = 8_000
#: Score from which a text is called good.
THRESHOLD = 0.3
STEPS, RATE, PENALTY = 600, 0.05, 1e-3
_CLASSES = [b"#*$%&|<>", b"!?", b".,;:", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n", b"-_/\\'\"()[]{}=+@^~`"]
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _i, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _i
N_FEATURES = 20


def features(text: str) -> list[float]:
    """Style statistics of a whole text; none depends on a label, a language
    name, a source or an id."""
    data = text.encode()
    words = data.split()
    n, size = len(words), max(len(data), 1)
    share = np.bincount(_CLASS_OF[np.frombuffer(data, np.uint8)], minlength=len(_CLASSES) + 1)[: len(_CLASSES)] / size
    many = max(n, 1)
    kinds = len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:]))
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    lines = [x for x in data.split(b"\n") if x.strip()]
    upper = share[4] * size if text.isascii() else sum(map(str.isupper, text))
    letters = sum(map(len, words))
    single = sum(1 for w in words if len(w) == 1)
    return [
        1.0,
        *np.sqrt(share).tolist(),
        np.log1p(n),
        letters / many / 5,
        kinds / many,
        same / many,
        triples / max(n - 2, 1),
        len(set(lines)) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)),
        float(np.sqrt(upper / max(len(text), 1))),
        single / many,
        float(n == 0),
        np.sqrt(sum(1 for w in words if len(w) > 20) / many),
        np.log1p(n) ** 2 / 10,
    ]


def held_out(key: Column, folds: int = 5) -> Column:
    """True for rows whose label is never used; null keys are false."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of quality 1."""
        z = ((rows - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def cuts_of(positive: np.ndarray) -> np.ndarray:
    """Score thresholds: percentiles of the positives."""
    return np.quantile(positive, np.linspace(0.02, 0.98, 97))


def best_bin(positive: np.ndarray, above: np.ndarray, total: int) -> float:
    """The estimated share of positives among ``total`` unlabelled scores, of
    which so many are ``above`` each of the positives' thresholds."""
    if not len(positive) or not total:
        return 0.5
    p = (positive[None, :] >= cuts_of(positive)[:, None]).mean(axis=1)
    u = above / total
    slack = np.sqrt(np.log(20) / 2 / len(positive)) + np.sqrt(np.log(20) / 2 / total)
    best = np.argmin((u + slack) / np.maximum(p, 1e-9))
    return float(np.clip(u[best] / p[best], 0.02, 0.98))


def _descend(p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Weights of least non-negative risk by Adam on the whole samples."""
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    soft = lambda z: np.logaddexp(0, z)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, STEPS + 1):
        zp, zu = p @ w, u @ w
        negative = soft(zu).mean() - prior * soft(zp).mean()
        gn = u.T @ sig(zu) / len(u) - prior * (p.T @ sig(zp)) / len(p)
        gp = -prior * (p.T @ sig(-zp)) / len(p)
        g = (gp + gn if negative >= 0 else -gn) + PENALTY * np.r_[0, w[1:]]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def _discriminate(p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Weights that tell positive from unlabelled rows, for the prior."""
    return _descend(p, np.concatenate([u, p]), 0.5)


#: Counts rows of :func:`features`: for each (weights, thresholds) how many of
#: all texts score at least each threshold, and how many texts there are.
Count = Callable[[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]], tuple[list[np.ndarray], int]]


def above_of(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray, asked: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """How many rows score at least each threshold."""
    out = []
    for weights, cuts in asked:
        ordered = np.sort(((rows - mean) / scale) @ weights)
        out.append(len(ordered) - np.searchsorted(ordered, cuts, "left"))
    return out


def fit_rows(positive: np.ndarray, unlabelled: np.ndarray, count: Count | None = None) -> Model:
    """A model from two samples of :func:`features` rows; the prior's shares
    are counted over all texts by ``count``, else over the sample."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.5)
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    mean[0], scale[0] = 0, 1
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    prior = 0.5
    if len(p) > 1 and len(u) > 1:  # each half of the positives is scored by weights from the other
        halves = [(p[1::2], _discriminate(p[::2], u[::2])), (p[::2], _discriminate(p[1::2], u[1::2]))]
        asked = [(w, cuts_of(half @ w)) for half, w in halves]
        above, total = count(mean, scale, asked) if count else (above_of(unlabelled, mean, scale, asked), len(unlabelled))
        prior = sum(best_bin(half @ w, n, total) for (half, w), n in zip(halves, above, strict=True)) / 2
    return Model(mean, scale, _descend(p, u, prior), prior)


def _features_of(texts: DataFrame) -> np.ndarray:
    """Features of a bounded set of texts, reduced on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([features(t or "") for t in batch.column(0).to_pylist()], pa.list_(pa.float64()))], ["f"])

    return np.array([r["f"] for r in texts.mapInArrow(run, "f array<double>").collect()]).reshape(-1, N_FEATURES)


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", quality: str = "quality") -> Model:
    """Fits on trusted positives that are not held out, and on any text.

    Of the positives the :data:`SAMPLE_ROWS` distinct keys with the least hashes
    are taken, with the text of least hash of each; of all documents the
    :data:`SAMPLE_ROWS` distinct pairs of key and text with the least hashes.
    The class prior's shares are counted over all documents."""
    small_batches(docs)
    good = labels.where((F.col(quality) == 1) & ~held_out(F.col(key)) & F.col(key).isNotNull()).select(F.col(key).alias("__good")).distinct()
    first = good.select(F.xxhash64("__good").alias("h"), "__good").orderBy("h", "__good").limit(SAMPLE_ROWS).select("__good")
    known = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(first), F.col("k") == F.col("__good"), "left_semi")
    positive = known.groupBy("k").agg(F.min_by("t", F.struct(F.xxhash64("t"), "t")).alias("t")).orderBy(F.xxhash64("k"), "k").select("t")
    rows = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("h"), F.col(text).alias("t"))
    last = rows.select("h").distinct().orderBy("h").limit(SAMPLE_ROWS).agg(F.max("h").alias("h")).first()["h"]
    if last is None:
        return fit_rows(np.empty((0, N_FEATURES)), np.empty((0, N_FEATURES)))
    taken = rows.where(F.col("h") <= F.lit(last)).dropDuplicates(["h"]).orderBy("h").select("t")

    def count(mean: np.ndarray, scale: np.ndarray, asked: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[np.ndarray], int]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                above = above_of(np.array([features(t or "") for t in batch.column(0).to_pylist()]).reshape(-1, N_FEATURES), mean, scale, asked)
                flat = np.concatenate([[len(batch)], *above]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "n"])

        sums = docs.select(text).mapInArrow(run, "i int, n bigint").groupBy("i").agg(F.sum("n").alias("n")).orderBy("i").collect()  # a row a threshold
        found = np.array([r["n"] for r in sums])
        return np.split(found[1:], np.cumsum([len(c) for _, c in asked])[:-1]), int(found[0])

    return fit_rows(_features_of(positive), _features_of(taken), count)


def score(docs: DataFrame, model: Model, *, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``key, held_out, score, predicted`` per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(t or "") for t in batch.column(2).to_pylist()]).reshape(-1, N_FEATURES)
            found = model.score(rows).round(6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= threshold).astype(np.int32))], [key, "held_out", "score", "predicted"]
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias(key), held_out(F.col(key)).alias("held_out"), text)
    return rows.mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fits on ``docs`` with ``labels`` and scores every row of ``docs``.

    Null and empty texts are scored by their (empty) statistics; without
    positives or texts every score is 0.5; labels without a text, null labels
    and repeated labels change nothing; null keys and repeated rows are scored
    as they come; of several texts of a labelled key that of least hash is
    learned from; very long texts are read whole; other columns are never read;
    an empty table gives no rows.
    """
    return score(docs, fit(docs, labels, **options), **options)
