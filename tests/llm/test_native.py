"""Operators 1, 8 and 10 against brute force and on odd rows."""

import hashlib
import re
from collections import Counter

from marginalia.llm import decontamination, quality_rules, url_filters


def base(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    seen = Counter(zip(w, w[1:], w[2:], strict=False))
    marked = {j for i in range(len(w) - 2) if seen[(w[i], w[i + 1], w[i + 2])] > 1 for j in (i, i + 1, i + 2)}
    lines, again = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            again += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(marked)


def check_rules(rows, found):
    expected = Counter((i, *base(t), base(t)[0] < 50 or 100 * base(t)[4] > 50 * base(t)[0]) for i, t, _, _ in rows)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert got == expected
    assert not any(r.kept for r in found if r.base_failed)


def test_rules_on_odd_rows(docs, odd):
    rows = [*odd, (20, "a b c a b c\nx\nx\n\n \n#$ <|>", "en", "a"), (21, "a a a a", "en", "a")]
    check_rules(rows, quality_rules.judged(docs(rows)).collect())


def test_rules_reject_outliers_only(docs, words):
    rows = [(i, " ".join(words(i, 80 + i % 50)), "en" if i % 2 else "fr", "s" + str(i % 2)) for i in range(260)]
    rows += [(1000 + i, " ".join(w + "###" for w in words(i, 100)), "en", "s1") for i in range(12)]
    rows += [(2000 + i, " ".join(words(i, 100)).upper(), "fr", "s0") for i in range(12)]
    found = quality_rules.judged(docs(rows)).collect()
    check_rules(rows, found)
    assert {r.doc_id for r in found if not r.kept} == {r[0] for r in rows if r[0] >= 1000}
    kept = quality_rules.keep_good(docs(rows))
    assert kept.count() == 260
    assert kept.columns == docs(rows).columns


def test_rules_do_not_depend_on_partitions(docs, words):
    rows = [(i, " ".join(words(i, 70 + i % 40)), "en", "s") for i in range(150)]
    one = quality_rules.judged(docs(rows).repartition(1)).collect()
    many = quality_rules.judged(docs(rows).repartition(7)).collect()
    assert sorted(one) == sorted(many)


def test_rules_empty(docs):
    assert quality_rules.judged(docs([])).count() == 0


def letters(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def contaminated(rows, items):
    windows = {}
    for item, text in items:
        w = letters(text)
        for i in range(max(1, len(w) - 9)):
            if w:
                windows.setdefault(tuple(w[i : i + 10]), set()).add(None if item is None else str(item))
    out = Counter()
    for key, text, *_ in rows:
        w, hit, found = letters(text), set(), set()
        for i in range(len(w)):
            for n in {len(k) for k in windows}:
                if len(w[i : i + n]) == n and tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        found = sorted(found - {None})
        out[(key, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit))] += 1
    return out


def test_windows(spark, docs, odd, words):
    passage = words(1, 40)
    items = [(10, " ".join(passage)), (9, "One"), (11, " ".join(passage[5:20])), (12, None), (13, "?!"), (None, " ".join(words(2, 12))), (14, "É one"), (15, "of the and")]
    rows = [*odd, (30, "x " + " ".join(passage[:25]).upper() + ". y", "en", "a"), (31, " ".join(passage[:9]), "en", "a"), (32, " ".join(words(2, 12)), "en", "a"), (33, "É, one! é one", "fr", "a")]
    rows += [(34, " ".join(passage[3:14] * 3), "en", "a")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(docs(rows), bench)
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect())
    assert got == contaminated(rows, items)


def test_windows_in_blocks(spark, docs, words, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 5)
    items = [(i, " ".join(words(i, 20))) for i in range(4)]
    rows = [(i, " ".join(words(i, 15) + words(i + 50, 9)), "en", "a") for i in range(6)]
    found = decontamination.contamination(docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(map(tuple, found.collect())) == contaminated(rows, items)


def test_windows_empty(spark, docs, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontamination.contamination(docs(odd), none).collect())
    assert decontamination.contamination(docs([]), none).count() == 0


URLS = [
    (1, "http://www.Example.com/en/a?x#y", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    (2, "https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    (3, "https://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    (4, "https://a.net/est/1", "a.net", "/est/1", None, "allow"),
    (5, "https://notcom/x", "notcom", "/x", None, "allow"),
    (6, "https://com", "com", "", None, "allow"),
    (7, "https://b.org/casino/", "b.org", "/casino/", None, "block"),
    (8, "https://b.org/x?casino", "b.org", "/x", None, "allow"),
    (9, "https://free-bets.example.org/1", "free-bets.example.org", "/1", None, "block"),
    (10, "nothing", "", "", None, "allow"),
    (11, None, "", "", None, "allow"),
    (12, "", "", "", None, "allow"),
    (None, "https://x.COM/\n", "x.com", "/\n", "com/", "allow"),
    (3, "https://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(k, u, "t", 1) for k, u, *_ in URLS], "page_id long, url string, token string, id int")
    found = url_filters.judge(pages).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found) == Counter((k, *rest) for k, _, *rest in URLS)
    assert url_filters.judge(pages.where("false")).count() == 0


def test_rule_whose_path_ends_inside_a_token(spark):
    pages = spark.createDataFrame([(1, "http://a.com/english")], "page_id long, url string")
    assert url_filters.judge(pages, [url_filters.host_rule("block", "com/en")]).first().verdict == "block"


def test_least_determinant_against_many_random_starts(spark):
    """Each group's determinant is as small as the best of fifty random starts
    concentrated in numpy, with far outliers left out."""
    import numpy as np

    r = np.random.default_rng(5)
    groups = {"g": r.multivariate_normal([1, 0.5, 0.2, 0.3, 0.1], np.diag([0.3, 0.2, 0.3, 0.4, 0.1]) ** 2 + 0.01, 240)}
    groups["h"] = np.r_[groups["g"][:120] * 0.5, r.normal(3, 0.3, (60, 5))]
    rows = [(g, *[int(round(v * 10_000)) for v in x]) for g, xs in groups.items() for x in xs]
    table = spark.createDataFrame(rows, "g string, " + ", ".join(f"x{i} long" for i in range(5)))
    found = {row.g: row for row in quality_rules.least_determinants(table).collect()}
    ridge = np.diag([s[2] ** 2 for s in quality_rules.STATISTICS])

    def fit(x):
        return x.mean(axis=0), quality_rules.CONSISTENCY * np.cov(x.T, bias=True) + ridge

    def squared(x, m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)

    for g, xs in groups.items():
        h, best = int(np.ceil(quality_rules.COVER * len(xs))), np.inf
        for _ in range(50):
            m, c = fit(xs[r.choice(len(xs), 8, replace=False)])
            for _ in range(30):
                m, c = fit(xs[np.argsort(squared(xs, m, c))[:h]])
            best = min(best, np.linalg.slogdet(c)[1])
        assert found[g].det < best + 0.15  # whole bins of distance are taken
    m = np.array([found["h"][f"m{i}"] for i in range(5)])
    assert np.abs(m - groups["g"][:120].mean(axis=0) * 0.5).max() < 0.1


def test_rows_are_judged_one_by_one(docs, words):
    """A rejected row takes no other row of its key with it."""
    good = [(i // 2, " ".join(words(i, 90)), "en", "s") for i in range(160)] + [(None, " ".join(words(500 + i, 90)), "en", "s") for i in range(5)]
    bad = [(3, "too short", "en", "s"), (None, "short", "en", "s"), (3, None, None, None)]
    kept = quality_rules.keep_good(docs(good + bad)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter((i, t) for i, t, *_ in good)


def test_small_sources_lean_on_their_language(docs, words):
    """Rows of a source with a few rows are judged like their language's."""
    rows = [(i, " ".join(words(i, 90)), "en", "big") for i in range(150)] + [(500 + i, " ".join(words(500 + i, 90)), "en", f"tiny{i}") for i in range(6)]
    odd_one = (900, " ".join(w + "###" for w in words(9, 100)), "en", "tiny1")
    found = {r.doc_id: r.kept for r in quality_rules.judged(docs([*rows, odd_one])).collect()}
    assert not found[900] and all(kept for i, kept in found.items() if i != 900)


def test_contaminated_rows_take_no_others(docs, spark, words):
    passage = " ".join(words(77, 12))
    benchmark = spark.createDataFrame([(1, passage)], "item_id int, text string")
    rows = [(5, "before " + passage + " after", "en", "s"), (5, " ".join(words(1, 30)), "en", "s"), (None, " ".join(words(2, 30)), "en", "s"), (None, passage, "en", "s"), (6, None, "en", "s")]
    kept = decontamination.keep_clean(docs(rows), benchmark).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter((rows[i][0], rows[i][1]) for i in (1, 2, 4))


def test_contamination_in_many_blocks_and_ties(docs, spark, words, monkeypatch):
    """Windows whose words are all equally rare, over several blocks."""
    text = " ".join(f"w{i}" for i in range(60))
    items = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(5 * i, 5 * i + 12))) for i in range(9)], "item_id int, text string")
    rows = [(1, text, "en", "s"), (2, text + " " + text, "en", "s"), (3, " ".join(words(1, 40)), "en", "s")]
    one = sorted(decontamination.contamination(docs(rows), items).collect())
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    assert sorted(decontamination.contamination(docs(rows), items).collect()) == one
    assert [r.n_items for r in one] == [9, 9, 0]


def test_thousands_of_rules(spark):
    """Rules as a table against every rule on every URL."""
    raw = [("block", "host", f"site{i}.example/p{i % 7}") for i in range(2500)] + [("allow", "host", "site7.example/p0/ok"), ("block", "words", "bad-word"), ("allow", "host", "///"), ("block", "host", "site9.example/p2")]
    rules = url_filters.rule_table(spark.createDataFrame(raw, "verdict string, kind string, rule string"))
    urls = [(i, f"http://{'a.' * (i % 3)}site{i * 13 % 2600}.example/p{i % 7}{'/ok' * (i % 2)}?q") for i in range(400)]
    urls += [(900, "x://site7.example/p0/ok/more"), (901, "x://site7.example/p0"), (902, None), (903, "x://other/bad-word.html"), (904, "x://other/badword"), (905, "http://" + "a" * 50_000 + "/p")]
    pages = spark.createDataFrame(urls, "page_id int, url string")

    def expected(url):
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1].lower(), found[2]) if found else ("", "")
        fits = []
        for verdict, kind, rule in raw:
            h, slash, rest = rule.partition("/")
            if kind == "host" and re.search("[0-9A-Za-z]", rule) and (host == h or host.endswith("." + h)) and path.startswith(slash + rest):
                fits.append((len(rule), rule, verdict))
        words_ = bool(re.search(r"(?:^|[^0-9A-Za-z])bad-word(?:[^0-9A-Za-z]|$)", host + path))
        return (max(fits)[1:] if fits else (None, "block" if words_ else "allow"))

    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.judge(pages, rules).collect()}
    assert got == {i: expected(u) for i, u in urls}
