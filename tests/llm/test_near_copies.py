"""Near copies against brute force over all pairs."""

from itertools import combinations

import corpus_pipeline
import numpy as np
from marginalia.llm import near_copies, simhash


def _set(text):
    found = (text or "").lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def _similar(a, b):
    a, b = _set(a), _set(b)
    return 5 * len(a & b) >= 4 * len(a | b)


def _kept(texts):
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(texts, 2):
        if _similar(texts[i], texts[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i for i in texts if find(i) == i}


def test_stage_drops_near_copies(docs, spark, words):
    texts = {}
    for g in range(20):
        base = words(g, 150)
        texts[g * 10] = " ".join(base)
        for k in range(1, 5):
            other = list(base)
            for place in range(20 * k, 20 * k + k * 2, 2):
                other[place] = f"new{k}{place}"
            texts[g * 10 + k] = " ".join(other)
        texts[g * 10 + 5] = " ".join(base[:110] + words(1000 + g, 60))  # too far
    # a chain: each near the next, its ends far apart
    chain = words(77, 200)
    for k in range(8):
        texts[900 + k] = " ".join(chain[10 * k :] + words(500, 10 * k + 1)[: 10 * k])
    table = docs([(i, t, "en", "s") for i, t in texts.items()])
    got = {r.doc_id for r in corpus_pipeline.near_copies_stage(spark, table, "").select("doc_id").collect()}
    assert got == _kept(texts)
    assert len(got) < len(texts) / 2


def test_threshold_and_odd_rows(docs, odd, words):
    base = [f"w{i}" for i in range(94)]  # 90 shingles
    at, under = base + [f"x{i}" for i in range(22)], base + [f"x{i}" for i in range(23)]
    assert _similar(" ".join(base), " ".join(at)) and not _similar(" ".join(base), " ".join(under))
    known = near_copies._Words()
    whole = near_copies.shingles(" ".join(base), known)
    assert near_copies.near(whole, near_copies.shingles(" ".join(at), known))
    assert not near_copies.near(whole, near_copies.shingles(" ".join(under), known))
    got = near_copies.keep_one(docs(odd)).select("doc_id").collect()
    # 1 stands for its repeat, for 2 and for the row without a key; 3 for all wordless texts
    assert sorted(r.doc_id for r in got) == [1, 3, 6, 7, 8, 9]


def test_rows_that_share_a_key(docs, words):
    """Different texts of one key are different rows; of equal rows one stays."""
    a, b = " ".join(words(1, 60)), " ".join(words(2, 60))
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (2, a, "en", "s"), (2, a, "en", "s"), (None, b, "en", "s"), (None, " ".join(words(3, 60)), "en", "s"), (None, None, None, None)]
    for keep in (near_copies.keep_one, simhash.keep_one):
        got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in keep(docs(rows)).collect())
        assert got == sorted([(False, 1, a), (False, 1, b), (True, 0, " ".join(words(3, 60))), (True, 0, "")])
        assert keep(docs([])).count() == 0


def test_many_blocks_against_all_pairs(docs, spark, words, monkeypatch):
    """Small blocks give the components of all pairs of a group of texts that
    are near some of the others."""
    monkeypatch.setattr(near_copies, "BLOCK_SHINGLES", 900)
    monkeypatch.setattr(near_copies, "BLOCK_MEMBERS", 5)
    base = words(5, 120)
    texts = {}
    for k in range(40):
        other = list(base)
        for place in range(k % 8, 120, 17 + k % 5):
            other[place] = f"n{k}x{place}"
        texts[k] = " ".join(other[: 120 - k % 3])
    table = docs([(i, t, "en", "s") for i, t in texts.items()])
    got = {r.doc_id for r in near_copies.keep_one(table).collect()}
    assert got == _kept(texts)


def test_connecting_against_all_pairs():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    pairs = near_copies.connecting(sets, np.zeros(30, np.int64), list(range(30)))
    root = list(range(30))

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in pairs:
        assert near_copies.near(sets[a], sets[b]) and find(a) != find(b)
        root[find(a)] = find(b)
    assert all(find(a) == find(b) for a in range(30) for b in range(a) if near_copies.near(sets[a], sets[b]))
