"""Operators 5, 6 and 9: exact parts against brute force, models held out."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from marginalia.llm import language_id, ngram_lm, pu_quality
from marginalia.llm.elias_fano import EliasFano, Level, dump, mapped


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 1), (5, 3), (900, 100), (900, 10**6), (3000, 3000), (77, 2**40)])
def test_sequences(n, top):
    r = np.random.default_rng(n)
    values = np.sort(r.integers(0, top, n))
    sequence = EliasFano.encode(values)
    assert sequence.access(np.arange(n)).tolist() == values.tolist()
    asked = np.r_[r.integers(0, top + 5, 500), values[:200], values[:200] + 1]
    assert sequence.successor(asked).tolist() == np.searchsorted(values, asked).tolist()


def test_levels_round_trip():
    r = np.random.default_rng(3)
    rows = sorted({(int(a), int(b)) for a, b in zip(r.integers(0, 50, 900), r.integers(0, 80, 900), strict=True)})
    context, word = (np.array(x) for x in zip(*rows, strict=True))
    level = Level.encode(60, context, word)
    number = {p: i for i, p in enumerate(rows)}
    a, b = r.integers(0, 60, 3000), r.integers(0, 80, 3000)
    assert level.find(a, b).tolist() == [number.get((int(x), int(y)), -1) for x, y in zip(a, b, strict=True)]


def test_dump_is_mapped():
    got = mapped(dump({"a": np.arange(5), "b": np.array([1.5], np.float32), "c": np.zeros(0, np.uint8)}))
    assert got["a"].tolist() == [0, 1, 2, 3, 4] and got["b"].tolist() == [1.5] and len(got["c"]) == 0


def expected_scores(rows):
    cut = [(k, [*(t or "").encode().lower().split(), b" "]) for k, t, *_ in rows]
    held = [k is not None and zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in cut]
    counts = Counter(w for (_, ws), h in zip(cut, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (k, ws), h in zip(cut, held, strict=True):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        out.append((k, h, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 4)))
    return Counter(out)


class Plain:
    """The model by dictionaries, from its definition."""

    def __init__(self, rows):
        texts = [[b" ", *(t or "").encode().lower().split(), b" "] for k, t, *_ in rows if k is None or zlib.crc32(str(k).encode()) % 10]
        self.one = Counter(w for t in texts for w in t[1:])
        self.n = sum(self.one.values())
        grams = [Counter(g for t in texts for g in zip(*(t[i:] for i in range(k)), strict=False)) for k in (2, 3)]
        self.two, self.three = ({g: n for g, n in c.items() if n >= 2} for c in grams)
        n1, n2 = (sum(c == k for c in self.one.values()) for k in (1, 2))
        self.discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        self.after1, self.after2 = Counter(), Counter()
        for (u, _), n in self.two.items():
            self.after1[u] += (n - 0.75) / self.one[u]
        for (u, v, _), n in self.three.items():
            self.after2[u, v] += (n - 0.75) / self.two[u, v]

    def p1(self, w):
        c = self.one[w]
        return (c - self.discount if c else self.discount * len(self.one)) / self.n

    def p2(self, v, w):
        share = (self.two[v, w] - 0.75) / self.one[v] if (v, w) in self.two else 0
        return share + max(1 - self.after1[v], 1e-6) * self.p1(w)

    def p3(self, u, v, w):
        share = (self.three[u, v, w] - 0.75) / self.two[u, v] if (u, v, w) in self.three else 0
        return share + max(1 - self.after2[u, v], 1e-6) * self.p2(v, w)

    def score(self, text):
        t = [b" ", *(text or "").encode().lower().split(), b" "]
        return sum(math.log10(self.p3(t[i - 2], t[i - 1], t[i]) if i > 1 else self.p2(t[0], t[1])) for i in range(1, len(t)))


@pytest.mark.parametrize("small", [False, True])
def test_scores(docs, odd, words, monkeypatch, small):
    if small:  # many blocks, shards and pieces
        for name, value in {"BLOCK_BYTES": 3_000, "PIECE_BYTES": 700, "SHARD_WORDS": 900, "SHARD_TOKENS": 4_000, "_PACK_TOKENS": 300}.items():
            monkeypatch.setattr(ngram_lm, name, value)
    rows = [*odd, *[(100 + i, " ".join(words(i % 7, 60 + i)), "en", "a") for i in range(80)]]
    found = ngram_lm.score(docs(rows)).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found) == expected_scores(rows)
    seen = [r for r in found if r.doc_id is not None and r.doc_id >= 100 and r.held_out]
    assert seen and sum(r.score for r in seen) > sum(r.base_score for r in seen)
    model = Plain(rows)
    mine, plain = (sorted(x, key=lambda r: (r[0] is None, r[0] or 0, r[1])) for x in ([(r.doc_id, r.score, r.n_tokens) for r in found], [(k, model.score(t), 0) for k, t, *_ in rows]))
    for (k, got, n), (_, wanted, _) in zip(mine, plain, strict=True):
        assert abs(got - wanted) <= 0.01 * n + 1e-6, k  # what quantisation may add
    assert abs(sum(x[1] for x in mine) - sum(x[1] for x in plain)) < 0.002 * abs(sum(x[1] for x in plain))


def test_scores_are_exact_with_few_values(docs, words):
    rows = [(i, " ".join(words(i % 5, 40, 12)), "en", "a") for i in range(60)]
    model = Plain(rows)
    found = {r.doc_id: r.score for r in ngram_lm.score(docs(rows)).collect()}
    for k, t, *_ in rows:
        assert abs(found[k] - model.score(t)) < 1e-4
    kinds = [*model.one, b"unseen"]
    for u, v in [(kinds[0], kinds[1]), (b" ", kinds[2]), (kinds[3], kinds[3])]:
        assert abs(sum(model.p3(u, v, w) for w in kinds) - 1) < 1e-9


def test_scores_without_training(docs):
    assert ngram_lm.score(docs([])).count() == 0
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = ngram_lm.score(docs([(held, "a b", "en", "a")])).first()
    assert row.held_out and row.train_tokens == 0 and row.score == 0.0


def language(seed, letters, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(n))


LETTERS = {"xx": ["an", "er", "ti", "ou"], "yy": ["éà", "li", "ez", "ñu"], "zz": ["сто", "ова", "ни"]}


def test_languages(docs, odd):
    rows = [(i, language(i, LETTERS[lang], 40 + i % 30), lang, "s") for i, lang in enumerate(["xx", "yy", "zz"] * 60)]
    found = {r.doc_id: r for r in language_id.identify(docs(rows)).collect()}
    assert {r.held_out for r in found.values()} == {True, False}
    assert all(found[i].lang_pred == lang and 0 < found[i].score <= 1 for i, _, lang, _ in rows)
    mixed = language_id.identify(docs(odd)).collect()
    assert len(mixed) == len(odd)
    assert all(r.lang_pred == "und" and r.score == 0 for r in mixed if r.doc_id in (3, 4, 5))
    assert {r.lang_pred for r in mixed} <= {"en", "fr", "und"}
    kept = language_id.keep_known(docs(rows + [(900, "123 456", "xx", "s"), (901, None, None, None)]))
    assert kept.count() == len(rows) and kept.columns == docs(rows).columns


def test_languages_do_not_depend_on_partitions_or_labels(docs):
    rows = [(i, language(i, LETTERS[lang], 30), lang, "s") for i, lang in enumerate(["xx", "yy"] * 20)]
    one = language_id.identify(docs(rows).repartition(1)).collect()
    assert sorted(one) == sorted(language_id.identify(docs(rows).repartition(5)).collect())
    assert language_id.identify(docs([])).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs([(1, "abc", None, "s")])).collect()} == {"und"}


def junk(seed, words):
    r = random.Random(seed)
    kind = r.randint(0, 2)
    w = words(seed, 90)
    return " ".join([f"{x}###" for x in w]) if kind == 0 else " ".join(w[:4] * 25) if kind == 1 else " ".join(w).upper() + "!!"


def test_quality(spark, docs, odd, words):
    good = [(i, " ".join(words(i, 60 + i % 80)) + ".", "en", "a") for i in range(400)]
    bad = [(1000 + i, junk(i, words), "en", "a") for i in range(90)]
    labels = [(i, 1, 0) for i, *_ in good[:300]] + [(i, 0, 0) for i, *_ in bad] + [(1, 1, None), (None, 1, 0), (5000, 1, 1), (7, None, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = pu_quality.classify(docs(good + bad + odd), table).collect()
    assert len(found) == len(good) + len(bad) + len(odd)
    score = {r.doc_id: r.score for r in found if r.doc_id is not None}
    held = [i for i, *_ in good + bad if zlib.crc32(str(i).encode()) % 5 == 0]
    wins = [(score[a] > score[b]) + 0.5 * (score[a] == score[b]) for a in held if a < 1000 for b in held if b >= 1000]
    assert np.mean(wins) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_quality_uses_no_negative_labels(spark, docs, words):
    rows = docs([(i, " ".join(words(i, 60)), "en", "a") for i in range(60)])
    some = [(i, 1, 0) for i in range(30)]
    first = pu_quality.classify(rows, spark.createDataFrame(some, "doc_id long, quality int, toxic int")).collect()
    second = pu_quality.classify(rows, spark.createDataFrame(some + [(i, 0, 1) for i in range(30, 60)], "doc_id long, quality int, toxic int")).collect()
    assert sorted(first) == sorted(second)


def test_quality_without_labels_or_rows(spark, docs, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in pu_quality.classify(docs(odd), none).collect()} == {0.5}
    assert pu_quality.classify(docs([]), none).count() == 0


def test_prior_is_estimated():
    r = np.random.default_rng(0)
    positive, rest = r.normal(2, 1, 4000), np.r_[r.normal(2, 1, 2800), r.normal(-2, 1, 1200)]
    above = (rest[None, :] >= pu_quality.cuts_of(positive)[:, None]).sum(axis=1)
    assert abs(pu_quality.best_bin(positive, above, len(rest)) - 0.7) < 0.06


def plain_vectors(text):
    """The sum of a text's n-gram vectors, one n-gram at a time."""
    space, letters, total = language_id._Space(), [], np.zeros(language_id.DIMENSIONS, np.int64)
    for c in f" {text or ''} ".lower():
        code = ord(c) if c.isalpha() else 0
        if code or not letters or letters[-1]:
            letters.append(code)
    for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
        total += np.roll(space.letter_vector(a), 2) * np.roll(space.letter_vector(b), 1) * space.letter_vector(c)
    return total


def test_languages_against_plain_vectors(docs, odd, monkeypatch):
    monkeypatch.setattr(language_id, "_BLOCK_NGRAMS", 50)
    rows = [(100 + i, language(i, LETTERS[lang], 20), lang, "s") for i, lang in enumerate(["xx", "yy", "zz"] * 8)] + [r for r in odd if r[0] != 6]
    learned = {}
    for k, t, lang, _ in rows:
        if lang is not None and not (k is not None and zlib.crc32(str(k).encode()) % 5 == 0):
            learned[lang] = learned.get(lang, 0) + plain_vectors(t)
    names = sorted(learned)

    def expected(text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        v = plain_vectors(text)
        cosines = [float(v @ learned[n] / (np.linalg.norm(v) * np.linalg.norm(learned[n]))) for n in names]
        return names[int(np.argmax(cosines))], round(min(max(max(cosines), 0), 1), 4)

    got = Counter((r.doc_id, r.lang_pred, round(r.score, 4)) for r in language_id.identify(docs(rows)).collect())
    assert got == Counter((k, *expected(t)) for k, t, *_ in rows)


def test_many_letters_are_multiplied_in_blocks():
    han = "".join(chr(0x4E00 + (i * 7919) % 20_000) for i in range(30_000))
    space = language_id._Space()
    grams, owner, place = space.profile([han])
    total = language_id.bundled(space, grams, owner, place, 1)[0]
    assert len(space.rows) <= language_id.CACHE_NGRAMS + language_id._BLOCK_NGRAMS and len(space.letters) <= language_id.CACHE_LETTERS
    some = han[:200]
    grams, owner, place = space.profile([some])
    assert (language_id.bundled(space, grams, owner, place, 1)[0] == plain_vectors(some)).all() and total.any()


def test_risk_against_a_plain_minimiser():
    """The weights reach the least non-negative risk that a search with
    numeric gradients from other starts finds."""
    r = np.random.default_rng(1)
    p = np.c_[np.ones(150), r.normal(1, 1, (150, 2))]
    u = np.r_[p[:60], np.c_[np.ones(90), r.normal(-1, 1, (90, 2))]]
    prior = 0.4

    def risk(w):
        loss = lambda z: np.logaddexp(0, -z).mean()
        negative = loss(-(u @ w)) - prior * loss(-(p @ w))
        return prior * loss(p @ w) + max(0, negative) + pu_quality.PENALTY / 2 * (w[1:] ** 2).sum()

    best = np.inf
    for seed in range(4):
        w, step = np.random.default_rng(seed).normal(0, 0.5, 3), 0.5
        while step > 1e-4:
            tried = [w + step * d for d in np.r_[np.eye(3), -np.eye(3)]]
            values = [risk(t) for t in tried]
            if min(values) < risk(w) - 1e-9:
                w = tried[int(np.argmin(values))]
            else:
                step /= 2
        best = min(best, risk(w))
    assert risk(pu_quality._descend(p, u, prior)) < best + 0.01


def test_prior_counts_all_texts(spark, docs, words, monkeypatch):
    """The class prior moves with documents beyond the sample."""
    monkeypatch.setattr(pu_quality, "SAMPLE_ROWS", 40)
    good = [(i, " ".join(words(i, 60 + i % 80)) + ".", "en", "a") for i in range(120)]
    bad = [(1000 + i, junk(i, words), "en", "a") for i in range(300)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    assert pu_quality.fit(docs(good + bad), labels).prior < pu_quality.fit(docs(good), labels).prior


def test_quality_of_repeated_keys_is_settled(spark, docs, words):
    rows = [(i % 20, " ".join(words(i, 60)), "en", "a") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    one = pu_quality.classify(docs(rows).repartition(1), labels).collect()
    two = pu_quality.classify(docs(rows[::-1]).repartition(5), labels).collect()
    assert sorted(one) == sorted(two)
