"""Operators 2, 3, 4 and 7 against libraries and brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from marginalia.llm import components, licenses, packing, simhash, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_counts_equal_the_library(library):
    counter = token_counts.HeapCounter(BPE)
    r = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "a", "B", "the", "é", "½", "!!", "'s", "'ll", "<|endoftext|>", "<|", "漢", "😀", "́", "​", "\x00"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    long = "abcdefghij" * 3000
    assert counter.count(long) == len(library.encode(long, add_special_tokens=False).ids)


def test_ids_equal_the_library(library):
    encoder = packing.Encoder(BPE)
    r = random.Random(6)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "".join(f"{c} {c}b1 " for c in every[i : i + 40]) for i in range(0, len(every), 40)]
    texts += ["".join(r.choice("aeionrstlh  \n.,'!") for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(chr(r.randint(0x20, 0x24F)) for _ in range(30)) for _ in range(2000)] + ["", " ", "a<|endoftext|> b", "x" * 5000]
    for text, ids in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert encoder.encode(text).tolist() == ids.ids, repr(text)


def test_counts_with_a_small_cache(library):
    counter = token_counts.HeapCounter(BPE)
    for cache in (counter.pieces, counter.words, counter.heads):
        cache.entries = 3
    for text in ["one two three four five six one two", "seven one nine ten four"] * 3:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_counts_table(docs, odd, library):
    found = token_counts.count_tokens(docs(odd), BPE).collect()
    expected = Counter()
    for key, text, *_ in odd:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected[(key, len((text or "").encode()), n, n > 512)] += 1
    assert Counter(map(tuple, found)) == expected
    assert token_counts.count_tokens(docs([]), BPE).count() == 0


def check_packing(rows, found, library, capacity):
    ids = defaultdict(list)
    for key, text, *_ in rows:
        ids[key].append(np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4"))
    expected = Counter()
    for key, many in ids.items():
        for x in many:
            first = len(x) % capacity or min(len(x), capacity)
            for piece, start in enumerate([0, *range(first, len(x), capacity)]):
                part = x[start : start + (capacity if piece else first)]
                expected[(key, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    places = defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(r.length for r in found)


def test_packing(docs, odd, words, library):
    rows = [*odd, *[(100 + i, " ".join(words(i, 40 + 37 * i % 900)), "en", "a") for i in range(120)], (300, "a  b\n\n c <|endoftext|> d", "en", "a")]
    found = packing.pack(docs(rows), BPE).collect()
    sequences, total = check_packing(rows, found, library, 2048)
    assert sequences <= -(-total // 2048) + 2
    assert packing.pack(docs([]), BPE).count() == 0


def test_packing_of_one_hot_length(docs, library):
    rows = [(i, "a", "en", "a") for i in range(3000)]
    sequences, total = check_packing(rows, packing.pack(docs(rows), BPE).collect(), library, 2048)
    assert sequences == -(-total // 2048)


def test_plan_uses_every_piece_once():
    r = random.Random(2)
    for _ in range(30):
        histogram = Counter(r.choice([r.randint(1, 64), 20, 44]) for _ in range(r.randint(1, 400)))
        used = Counter()
        for content, times in packing.plan(histogram, 64):
            assert sum(content) <= 64
            for length in content:
                used[length] += times
        assert used == histogram


def test_plan_finds_exact_complements():
    assert packing.plan({40: 2, 24: 2}, 64) == [((40, 24), 2)]
    assert packing.plan({40: 1, 14: 1, 10: 1, 23: 1}, 64)[0] == ((40, 14, 10), 1)
    assert packing.plan({40: 1, 12: 1, 7: 1, 5: 1, 22: 1}, 64)[0] == ((40, 12, 7, 5), 1)


def fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    grams = [b" ".join(w)] if len(w) < 3 else [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def check_classes(rows, found):
    fps = [fingerprint(t) for _, t, *_ in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    roots = closure(len(rows), near)
    least = {}
    for root, (key, *_) in zip(roots, rows, strict=True):
        if key is not None:
            least[root] = min(key, least.get(root, key))
    expected = Counter((key, f"{fp:016x}", least.get(root)) for (key, *_), fp, root in zip(rows, fps, roots, strict=True))
    assert Counter(map(tuple, found)) == expected


def test_classes(docs, odd, words):
    text = words(3, 400)
    rows = [*odd, *[(50 + i, " ".join(text[:i] + ["x"] + text[i:]), "en", "a") for i in range(0, 60, 3)], (40, " ".join(text), "en", "a"), (41, " ".join(text).upper(), "en", "b")]
    check_classes(rows, simhash.classes(docs(rows)).collect())
    kept = simhash.keep_one(docs(rows))
    assert kept.columns == docs(rows).columns
    found = simhash.classes(docs(rows)).collect()
    keys = [r.doc_id for r in kept.collect()]
    assert Counter(keys) == Counter({r.component_id for r in found})
    assert simhash.classes(docs([])).count() == 0
    assert simhash.keep_one(docs([])).count() == 0


def test_links_lose_no_pair(spark):
    r = random.Random(4)
    fps = set()
    for _ in range(60):
        fp = r.getrandbits(64)
        fps.add(fp)
        for _ in range(r.randint(0, 30)):
            fp ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 3)))
            fps.add(fp)
    fps = sorted(fps)
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    number = {s: i for i, s in enumerate(signed)}
    found = [(number[r.u], number[r.v]) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()]
    assert all((fps[i] ^ fps[j]).bit_count() <= 2 for i, j in found)
    assert closure(len(fps), found) == closure(len(fps), near)


def test_anchors_cover():
    r = random.Random(5)
    cosets = simhash._cosets(2)
    for _ in range(200):
        x = r.getrandbits(64)
        y = x ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 2)))
        a, b = (set(simhash.anchors(np.array([v], np.uint64), cosets)[1].tolist()) for v in (x, y))
        assert len(a) <= 32 and a & b


def test_dense_anchor_gives_a_forest():
    centre = 12345
    fps = np.array([centre, *[centre ^ 1 << b for b in range(64)]], np.uint64)
    left, _ = simhash.forest(fps, 2)
    assert len(left) == 64


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    pairs = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 240)]
    edges = spark.createDataFrame([*pairs, (None, 3), (5, 5)], "u long, v long")
    roots = closure(300, pairs)
    seen = {i for p in pairs if p[0] != p[1] for i in p}
    assert {tuple(x) for x in components.connected_components(edges).collect()} == {(i, roots[i]) for i in seen}
    assert components.connected_components(edges.where("false")).count() == 0


def test_every_template_is_found(docs, odd, words):
    filler = words(7, 200)
    rows = list(odd)
    for i, (_, text) in enumerate(licenses.TEMPLATES):
        assert licenses.collision_probability(len(licenses.words(text)) - 2) > 0.9999
        rows.append((100 + i, " ".join(filler[: 10 * i]) + " " + text.upper() + " " + " ".join(filler), "en", "a"))
    found = {r.doc_id: r for r in licenses.licensed(docs(rows)).collect() if r.doc_id is not None}
    for i, (name, _) in enumerate(licenses.TEMPLATES):
        assert name in found[100 + i].licenses.split(",") and found[100 + i].containment == 1.0
    assert all(found[k].n_licenses == 0 for k in (1, 2, 3, 4, 5, 6, 7, 8, 9))
    assert licenses.licensed(docs(odd)).count() == len(odd)
    assert licenses.licensed(docs([])).count() == 0


def test_changed_template_is_found_and_reported_once(docs, words):
    text = licenses.TEMPLATES[11][1].replace("any later version", "every later version")
    rows = [(1, " ".join(words(8, 50)) + " " + text + " " + " ".join(words(9, 50)), "en", "a")]
    row = licenses.scan(docs(rows)).first()
    assert [m.license for m in row.matches] == ["gpl-3.0"] and 0.8 <= row.matches[0].containment < 1


def test_radius_of_anchors_changes_no_class(spark):
    r = random.Random(8)
    points = [r.getrandbits(63) for _ in range(40)]
    points += [p ^ (1 << r.randrange(63)) ^ (1 << r.randrange(63)) for p in points for _ in range(3)]
    table = spark.createDataFrame([(p,) for p in sorted(set(points))], "fp long")

    def classes(radius):
        found = components.connected_components(simhash.links(table, 2, radius)).collect()
        return {(x.node, x.root) for x in found}

    assert classes(None) == classes(3) and classes(None)
    with pytest.raises(ValueError, match="miss"):
        simhash.links(table, 2, 1)
