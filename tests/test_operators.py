"""Operators against hand values and brute force, with negative controls."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from marginalia.operators import evaluation, joins, layout, lexicon, markup, models, reconcile, sequence, statistics, translation, windows


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect()) if columns else sorted(map(tuple, df.collect()))


def test_detection_of_a_three_unit_page(spark):
    # bvrn modem good / truth burn modern good / output burn modem bad
    units = spark.createDataFrame([("b", "bvrn", "burn", "burn", True), ("b", "modem", "modern", "modem", False), ("b", "good", "good", "bad", True)], "book string, before string, truth string, output string, detected boolean")
    got = evaluation.detection(units, "book", F.col("before") != F.col("truth"), F.col("detected")).where("book is null").first()
    assert (got.tp, got.fp, got.tn, got.fn) == (1, 1, 0, 1) and got.precision == 0.5 and got.f1 == 0.5
    fixed = evaluation.correction(units, "book").first()
    assert (fixed.changed, fixed.resolved, fixed.damaged, fixed.net) == (2, 1, 1, 0)


def test_rates_without_a_denominator_are_null(spark):
    units = spark.createDataFrame([("b", False, False)], "book string, e boolean, d boolean")
    got = evaluation.detection(units, "book", F.col("e"), F.col("d")).first()
    assert got.precision is None and got.recall is None and got.fpr == 0.0


def test_character_errors(spark):
    pages = spark.createDataFrame([("b", "bvrn modem good", "burn modern good", "burn modem bad")], "g string, before string, truth string, output string")
    got = evaluation.character_errors(pages, "g").first()
    assert (got.characters, got.edits_before, got.edits_after) == (16, 3, 5)


def test_candidate_recall(spark):
    units = spark.createDataFrame([("b", "burn", True, ["barn", "burn"]), ("b", "modern", False, ["modern"])], "g string, truth string, detected boolean, candidates array<string>")
    got = evaluation.candidate_recall(units, "g").first()
    assert (got.pool_recall, got.conditional_recall, got.recall_at_1, got.recall_at_3) == (0.5, 1.0, 0.0, 0.5)


@pytest.mark.parametrize("parts", [1, 5])
def test_review_curve(spark, parts):
    r = random.Random(3)
    data = [(i, r.random(), r.random() < 0.4) for i in range(120)]
    got = windows.review_curve(spark.createDataFrame(data, "id int, score double, error boolean").repartition(parts), "score", "id", "error", [0, 10, 500], [0, 3])
    order = [e for _, _, e in sorted(data, key=lambda x: (-x[1], x[0]))]
    for row in got.collect():
        if row.kind == "items":
            assert row.reviewed == min(row.budget, 120) and row.found == sum(order[: row.budget])
        else:
            n = max(k for k in range(121) if k - sum(order[:k]) <= row.budget)
            assert row.reviewed == n and row.found == sum(order[:n])


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_character_errors_count_accented_items(spark, tmp_path):
    from marginalia.plans import catalogue

    texts = ["Ol\u00e9 l'\u00e9t\u00e9 Oui", "plain lOl", "\u6f22\u5b57 \U0001f600 Ol", "O\u0308 ll", "no", "l\u00e0"]
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    wanted = {}
    for i, t in enumerate(texts):
        sums = wanted.setdefault(i % 4, [0, 0, 0])
        read, output = t.translate(str.maketrans("lO", "10")), t.replace("O", "0")
        for k, n in enumerate((len(t), _edits(read, t), _edits(output, t))):
            sums[k] += n
    got = catalogue.QUERIES["a7_cer"](spark, str(tmp_path)).collect()
    assert {r.g: [r.characters, r.edits_before, r.edits_after] for r in got} == wanted


def test_bootstrap_repeats_and_covers_the_mean(spark):
    data = [(f"b{i % 6}", i, float(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(data, "book string, page int, v double")
    values = {"v": (F.col("v"), F.lit(1.0)), "w": (F.col("v") / 2, F.lit(1.0)), "v - w": (F.lit(1), F.lit(1))}
    one, two = (evaluation.bootstrap(df.repartition(n), "book", "page", values).collect() for n in (1, 4))
    assert sorted(one) == sorted(two) and {r.replicates for r in one} <= set(range(980, 1001))
    found = {r.metric: r for r in one}
    assert found["v"].low < 1 / 3 < found["v"].high
    # paired: the difference of a metric and its half is the half in every draw
    assert abs(found["v - w"].low - found["w"].low) < 1e-9 and abs(found["v - w"].high - found["w"].high) < 1e-9


def test_bootstrap_needs_two_books_and_a_hundred_draws(spark):
    one = spark.createDataFrame([("b", i, float(i)) for i in range(20)], "book string, page int, v double")
    values = {"v": (F.col("v"), F.lit(1.0))}
    assert evaluation.bootstrap(one, "book", "page", values).count() == 0
    with pytest.raises(ValueError, match="hundred"):
        evaluation.bootstrap(one, "book", "page", values, replicates=99)


def test_nearest_against_brute_force(spark):
    r = random.Random(1)
    left = [(i, r.randint(0, 2), r.randint(0, 300)) for i in range(60)]
    right = [(i, r.randint(0, 2), r.randint(0, 300)) for i in range(60)]
    got = joins.nearest(spark.createDataFrame(left, "a int, k int, t int"), spark.createDataFrame(right, "b int, k int, u int"), "k", "t", "u", 7, "a", "b")
    for row in got.collect():
        near = sorted((abs(row.t - u), b) for b, k, u in right if k == row.k and abs(row.t - u) < 7)
        assert (row.gap, row.nearest_id) == (near[0] if near else (None, None))


def test_missing_numbers(spark):
    got = joins.missing_numbers(spark.createDataFrame([(1, 2), (1, 5), (1, 5), (2, 1)], "o int, n int"), "o", "n")
    assert [tuple(r) for r in got.orderBy("number").collect()] == [(1, 1, None, 2), (1, 3, 2, 5), (1, 4, 2, 5)]


def test_coverage(spark):
    base = spark.createDataFrame([(1, False), (2, True), (3, False), (4, True)], "id int, skip boolean")
    got = joins.coverage(base, spark.createDataFrame([(1,), (4,), (9,)], "id int"), "id", F.col("skip"))
    assert {r.id: r.status for r in got.collect()} == {1: "covered", 2: "excluded", 3: "missing", 4: "excluded-but-used", 9: "unknown"}


def test_checked_edits(spark):
    base = spark.createDataFrame([("p", 1, "a cat sat"), ("p", 2, "cat"), ("q", 1, "dog")], "page string, pos int, text string")
    edits = spark.createDataFrame([(1, "p", "cat", "cow", 2), (2, "p", "cow sat", "cow lay", 1), (3, "q", "cat", "x", 1), (4, "q", "dog", "fox", 1)], "seq int, page string, before string, after string, count int")
    done, report = joins.checked_edits(base, edits)
    # the second edit is counted on what the first one left
    assert rows(report, "seq", "matches", "applied") == [(1, 2, True), (2, 1, True), (3, 0, False), (4, 1, True)]
    assert rows(done) == [("p", 1, "a cow lay"), ("p", 2, "cow"), ("q", 1, "fox")]


def test_checked_edits_by_pattern(spark):
    base = spark.createDataFrame([(1, 1, "art cart $x"), (1, 2, "art"), (2, 1, "untouched")], "page int, pos int, text string")
    schema = "seq int, page int, before string, after string, count int, whole_word boolean, exact_row boolean"
    edits = spark.createDataFrame([(1, 1, "art", "a$1", 2, True, False), (2, 1, "a$1", "A\\\\", 1, False, True), (3, 1, "$x", "y", 1, False, False)], schema)
    done, report = joins.checked_edits(base, edits)
    assert rows(report, "seq", "matches") == [(1, 2), (2, 1), (3, 1)]
    assert rows(done) == [(1, 1, "a$1 cart y"), (1, 2, "A\\\\"), (2, 1, "untouched")]


def test_conflicts_and_intervals(spark):
    spans = spark.createDataFrame([(1, 0, 10), (1, 2, 3), (1, 5, 6), (1, 10, 12), (2, 0, 1)], "k int, start int, stop int")
    assert rows(joins.conflicts(spans, "k"), "start", "stop") == [(2, 3), (5, 6)]
    assert joins.within(spans, spans, "k").count() == 7
    assert joins.overlapping(spans, spans.where("start = 10"), "k").count() == 1


def test_roots_of_chains_and_cycles(spark):
    links = [(i, i - 1 if i % 3000 else None) for i in range(6000)] + [(9000, 9001), (9001, 9000), (9002, 9001), (9100, 9999)]
    got = {r.node: r.root for r in joins.roots(spark.createDataFrame(links, "n int, p int"), "n", "p").collect()}
    assert all(got[i] == i // 3000 * 3000 for i in range(6000)) and {got[i] for i in (9000, 9001, 9002, 9100)} == {None}


def test_unused_nodes_by_closure(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 6), (6, 5)], "source int, target int")
    nodes = spark.createDataFrame([(i,) for i in range(1, 8)], "node int")
    assert rows(joins.unused(nodes, nodes.where("node = 1"), edges)) == [(4,), (5,), (6,), (7,)]


def test_intervals_over_many_stretches(spark):
    r = random.Random(9)
    spans = [(i, r.randint(0, 1), a := r.randint(0, 300), a + r.randint(1, 90)) for i in range(60)]
    df = spark.createDataFrame(spans, "i int, k int, start int, stop int")
    pairs = lambda met: sorted((x.a, x.b) for x in met.select(F.col("a.i").alias("a"), F.col("b.i").alias("b")).collect())
    wanted = sorted((x[0], y[0]) for x in spans for y in spans if x[1] == y[1] and y[3] > x[2] and y[2] < x[3])
    assert pairs(joins.overlapping(df, df, "k", 16)) == wanted
    inside = sorted((x[0], y[0]) for x in spans for y in spans if x[1] == y[1] and y[2] <= x[2] and y[3] >= x[3])
    assert pairs(joins.within(df, df, "k", 16)) == inside


def test_bound_decisions(spark):
    schema = "id int, text_hash string, evidence_hash string, place double"
    held = spark.createDataFrame([(1, "a", "x", 0.1), (2, "b", "x", 0.1), (3, "b", "y", 0.1), (4, "c", "x", 0.1), (5, "c", "x", 0.2), (6, "d", "x", 0.1), (7, "d", "x", 0.1)], schema).withColumnRenamed("id", "row_id")
    asked = spark.createDataFrame([(1, "a", "old", 0.9), (2, "b", "y", 0.9), (3, "c", "x", 0.2), (4, "c", "z", 0.2), (5, "d", "x", 0.1), (6, "e", "x", 0.1)], schema).withColumnRenamed("id", "decision_id")
    got = {r.decision_id: (r.row_id, r.reason) for r in joins.bound(asked, held).collect()}
    assert got == {1: (1, "bound"), 2: (3, "bound"), 3: (5, "bound"), 4: (None, "evidence-changed"), 5: (None, "ambiguous-place"), 6: (None, "text-changed")}


def test_merge_keeps_the_first_rank(spark):
    schema = "t string, rank int, generators array<string>"
    got = joins.merged(spark.createDataFrame([("a", 1, ["x"]), ("b", 2, ["x"])], schema), spark.createDataFrame([("b", 1, ["y"]), ("c", 2, ["y"])], schema), ["t"])
    assert {r.t: (r.rank, r.generators) for r in got.collect()} == {"a": (1, ["x"]), "b": (2, ["x", "y"]), "c": (1002, ["y"])}


def test_term_stats(spark):
    tokens = spark.createDataFrame([("a", "s", 1, 0), ("a", "s", 1, 0), ("a", "t", 2, 1), ("b", "s", 1, 0)], "term string, source string, doc_id int, pos int")
    got = {r.term: r for r in statistics.term_stats(tokens).collect()}
    assert (got["a"]["count"], got["a"].chapter_df, got["a"].page_df, got["a"].block_df, got["a"].idf) == (3, 2, 2, 2, 1.0)
    assert got["b"].idf == 1.405465


def test_nearest_rank(spark):
    df = spark.createDataFrame([([3.0, 1.0, 2.0, 4.0],), ([],)], "v array<double>")
    assert [r[0] for r in df.select(statistics.nearest_rank(F.col("v"), 0.5)).collect()] == [3.0, None]


def test_theil_sen_ignores_an_outlier(spark):
    data = [(1, i, 2 * i + (500 if i == 5 else 0)) for i in range(20)]
    assert statistics.theil_sen(spark.createDataFrame(data, "g int, x int, y int"), "g", "x", "y").first().slope == 2.0


def test_theil_sen_takes_all_pairs_of_a_long_group(spark):
    r = random.Random(3)
    data = [(1, i, r.randint(0, 100) + (i * i) // 50) for i in range(260)]
    slopes = sorted((b[2] - a[2]) / (b[1] - a[1]) for a, b in combinations(data, 2))
    n = len(slopes)
    got = statistics.theil_sen(spark.createDataFrame(data, "g int, x int, y int"), "g", "x", "y").first()
    assert (got.slope, got.pairs) == (round((slopes[(n - 1) // 2] + slopes[n // 2]) / 2, 6), n)


def test_detector_order(spark):
    terms = spark.createDataFrame([("cat",), ("house",), ("zorgle",), ("house-boat",), ("house-zorgle",), ("guard",)], "term string")
    known = spark.createDataFrame([("house",), ("boat",), ("cat",)], "term string")
    got = {r.term: r.reason for r in lexicon.detect(terms, known, spark.createDataFrame([("guard",)], "term string")).collect()}
    assert got == {"cat": "short-token", "house": "dictionary-known", "zorgle": None, "house-boat": "known-hyphen-parts", "house-zorgle": None, "guard": "protected"}


def test_one_edit_pairs_lose_none(spark):
    from marginalia.functions.similarity import osa

    r = random.Random(2)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 5))) for _ in range(120)})
    df = spark.createDataFrame([(w, 1) for w in words], "term string, count int")
    got = {(x.term, x.suggestion) for x in lexicon.one_edit_pairs(df, df).collect()}
    assert got == {(a, b) for a in words for b in words if osa(a, b) == 1}


def test_forward_split_and_recent(spark):
    df = spark.createDataFrame([("s", i) for i in range(11)], "s string, p int")
    assert rows(windows.forward_split(df, "s", "p").where("seed"), "p") == [(0,), (1,), (2,)]
    turns = spark.createDataFrame([(1, i, 10) for i in range(5)], "c int, t int, n long")
    assert [r.context_rows for r in windows.recent(turns, "c", "t", F.col("n"), 25).orderBy("t").collect()] == [0, 1, 2, 2, 2]


def test_greedy_chunks(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate([5, 5, 5, 30, 2, 2])], "k int, o int, s int")
    assert [r.chunk for r in windows.greedy_chunks(df, "k", "o", F.col("s"), 10).orderBy("o").collect()] == [0, 0, 1, 2, 3, 3]
    assert [r.chunk for r in windows.greedy_chunks(df, "k", "o", F.col("s"), 100, 2).orderBy("o").collect()] == [0, 0, 1, 1, 2, 2]


def test_places_by_ranges(spark):
    r = random.Random(1)
    data = [(r.choice("ab"), r.randint(0, 500), i) for i in range(300)]
    got = windows.ranked(spark.createDataFrame(data, "k string, v int, i int"), "k", ["v", "i"], F.floor(F.col("v") / 37))
    for k in "ab":
        order = sorted((v, i) for g, v, i in data if g == k)
        assert [(x.v, x.i) for x in got.where(F.col("k") == k).orderBy("_k").collect()] == order
        assert {x._n for x in got.where(F.col("k") == k).collect()} == {len(order)}


def test_hanging_lists(spark):
    data = [(0, "text", 0.1), (1, "• one", 0.1), (2, "more", 0.15), (3, "• two", 0.1), (4, "end", 0.1), (5, "inset", 0.2), (6, "1. three", 0.1)]
    got = windows.hanging_lists(spark.createDataFrame([(1, *d) for d in data], "p int, row int, text string, x0 double"), "p", "row")
    assert [r.item for r in got.orderBy("row").collect()] == [None, 1, 1, 2, None, None, 3]


def test_neighbours_stop_at_sentence_marks(spark):
    got = windows.neighbours(spark.createDataFrame([(1, 0, "One two. Three; four")], "doc_id int, pos int, line string"))
    assert {(r.term, r.before, r.after) for r in got.collect()} == {("one", None, "two"), ("two", "one", None), ("three", None, None), ("four", None, None)}


def subsequences(values):
    best = 0
    found = []
    for n in range(len(values), 0, -1):
        found = [set(c) for c in combinations(range(len(values)), n) if all(values[a] <= values[b] for a, b in zip(c, c[1:], strict=False))]
        if found:
            best = n
            break
    return set.intersection(*found) if best else set()


def test_trusted_anchors_against_brute_force():
    r = random.Random(4)
    for _ in range(80):
        values = [r.randint(1, 6) for _ in range(r.randint(0, 8))]
        assert {i for i, ok in enumerate(sequence.trusted(values)) if ok} == subsequences(values)


def test_trusted_anchors_within_the_maximum():
    assert sequence.trusted([1, 9, 2, 0, 3], 5) == [True, False, True, False, True]
    assert sequence.trusted([2, 1], 5) == [False, False]


def test_alignment_against_brute_force():
    r = random.Random(5)
    for _ in range(120):
        nodes = [sequence.Marker((r.randint(0, 5),), r.randint(1, 5), votes=r.randint(1, 2), anchor=r.random() < 0.2, cost=r.choice([0.0, 0.5])) for _ in range(r.randint(0, 6))]

        def best(allowed, nodes=nodes):
            top = 0.0
            for n in range(1, len(allowed) + 1):
                for c in combinations(sorted(allowed, key=lambda i: (nodes[i].position, nodes[i].number)), n):
                    steps = list(zip(c, c[1:], strict=False))
                    if all(nodes[a].leads_to(nodes[b]) for a, b in steps):
                        top = max(top, sum(nodes[i].weight for i in c) + sum(2 * (nodes[a].number + 1 == nodes[b].number) for a, b in steps))
            return top

        every = list(range(len(nodes)))
        for i, (status, whole, _) in enumerate(sequence.align(nodes)):
            worth = best(every) - best([j for j in every if j != i])
            assert whole == best(every)
            assert (status == "selected") == (worth >= sequence.MARGIN)


def test_one_neighbour_does_not_decide():
    """Two places for 2 after a 1, one of them convenient."""
    nodes = [sequence.Marker((1,), 1, anchor=True), sequence.Marker((2,), 2, votes=1), sequence.Marker((2,), 5, votes=1)]
    assert [s for s, *_ in sequence.align(nodes)] == ["selected", "sequence-ambiguous", "sequence-ambiguous"]


def test_collisions_and_blockers():
    box = (0.0, 0.0, 1.0, 1.0)
    same = [sequence.Marker((1, 1, 0), 1, candidate=0, box=box), sequence.Marker((1, 2, 0), 2, candidate=1, box=(0.1, 0.0, 1.1, 1.0)), sequence.Marker((1, 2, 0), 3, candidate=1)]
    assert {s for s, *_ in sequence.align(same)} == {"source-position-conflict"}
    blocked = [sequence.Marker((1,), 4, rejection="conflicting-glyph-reads"), sequence.Marker((2,), 4), sequence.Marker((3,), 5)]
    assert [s for s, *_ in sequence.align(blocked)] == ["conflicting-glyph-reads", "competing-unverified-marker", "selected"]


def test_selection_against_all_paths():
    r = random.Random(6)
    for _ in range(120):
        options = [(c, r.randint(1, 6), r.randint(1, 2), 0.0) for c in range(r.randint(0, 4)) for _ in range(r.randint(1, 2))]
        weight = [6.0 if o[2] >= 2 else 3.0 for o in options]
        best, on = 0.0, set()
        for n in range(1, len(options) + 1):
            for c in combinations(range(len(options)), n):
                steps = list(zip(c, c[1:], strict=False))
                if all(options[a][0] < options[b][0] and options[a][1] < options[b][1] for a, b in steps):
                    score = sum(weight[i] for i in c) + sum(2 * (options[a][1] + 1 == options[b][1]) for a, b in steps)
                    if score > best:
                        best, on = score, set()
                    if score == best:
                        on |= set(c)
        only = {i for i in on if sum(options[j][0] == options[i][0] for j in on) == 1 and sum(options[j][1] == options[i][1] for j in on) == 1}
        chosen = {options[i][1] for i in only}
        got = sequence.select(options, 6)
        for i, (_, number, votes, _) in enumerate(options):
            alone = votes < 2 and not {number - 1, number + 1} & chosen
            assert (got[i] == "selected") == (i in only and not alone) and (got[i] == "recognition-needs-neighbors") == (i in only and alone)


def test_review_tiers(spark):
    def tier(*values):
        return spark.range(1).select(reconcile.tier(*map(F.lit, values))).first()[0]

    assert tier("a x", "a y", "a y", "a Y") == "three-peer-consensus"
    assert tier("a x", "a x", "a y", "a y") == "fresh-peer-consensus"
    assert tier("a x", "a y", "a y", "a z") == "other" and tier("", "a", "a", "a") == "other"


def test_rows_join_by_running_mean(spark):
    pieces = [(1, 0, 0.5, 0.100, 0.9, 0.110, "b", None), (1, 0, 0.1, 0.101, 0.4, 0.111, "a", 0.8), (1, 0, 0.1, 0.112, 0.4, 0.122, "c", 0.9), (1, 1, 0.1, 0.1, 0.2, 0.11, "d", 0.9)]
    got = layout.merge_rows(spark.createDataFrame(pieces, "page long, col int, x0 double, y0 double, x1 double, y1 double, text string, confidence double"))
    assert rows(got, "text", "confidence") == [("a b", 0.8), ("c", 0.9), ("d", 0.9)]


def test_header_variants_never_chain():
    names = [("AAAAAAAAAA", 9), ("AAAAAAAAAB", 4), ("AAAAAAAABB", 3)]
    got = layout.clustered(names)
    assert got["AAAAAAAAAB"] == "AAAAAAAAAA" and got["AAAAAAAABB"] == "AAAAAAAABB"


def test_single_misreadings_join_their_seed(spark):
    r = random.Random(8)
    names = ["".join(r.choice("ABCDEFGH") for _ in range(n)) for n in (6, 11, 19, 20, 40, 41, 90)]
    data = [("b", page, name) for name in names for page in range(3)]
    for name in names:
        for k in range(1, 8):
            other = list(name)
            for _ in range(k):
                other[r.randrange(len(other))] = r.choice(["X", "", "YZ"])
            data.append(("b", 100 + len(data), "".join(other)))
    data += [("b", 900, "ALONE AND UNLIKE"), ("c", 1, names[4][1:])]
    pages = {}
    for book, page, text in data:
        pages.setdefault((book, text), set()).add(page)
    wanted = {("b", n, s) for n, s in layout.clustered([(t, len(p)) for (b, t), p in pages.items() if b == "b"]).items() if s != n or len(pages["b", n]) > 1}
    got = layout.clustered_margins(spark.createDataFrame(data, "book string, page int, text string"), "book").collect()
    assert {(x.book, x.signature, x.seed) for x in got} == wanted and len(got) == len(wanted)
    assert sum(x.pages == 1 for x in got) > 5


def test_boxes_group():
    assert layout.group_boxes([(0, 0, 1, 1), (0, 1.02, 1, 2), (0, 3, 1, 4)]) == [(0, 0, 1, 2), (0, 3, 1, 4)]


def test_blocks_of_malformed_markup():
    got = markup.blocks_of('<div class=x><p>one <b>two<br>three<p>four <a href="u">five</a><script>no()</script><ul><li>six')
    assert [(t, text, links) for t, _, text, links in got] == [("p", "one two three", 0), ("p", "four five", 1), ("li", "six", 0)]


def test_difference_and_snapshot(spark):
    a, b = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int"), spark.createDataFrame([("x", 1), ("y", 3), ("z", 1)], "k string, v int")
    assert sorted(map(tuple, markup.difference(a, b, "k", "v").collect()), key=str) == [("y", 2, 3), ("z", None, 1)]
    assert markup.snapshot(b, ["k", "v"]).first() == markup.snapshot(b.repartition(3).orderBy("v"), ["k", "v"]).first()
    assert markup.snapshot(a, ["k", "v"]).first() != markup.snapshot(b, ["k", "v"]).first()


def test_translation_flags(spark):
    long = "This is a sentence of some length. " * 4

    def flags(source, target, lang="en"):
        return spark.range(1).select(translation.flags(F.lit(source), F.lit(target), F.lit(lang))).first()[0]

    assert flags(long, long) == []
    assert flags(long, "Short.") == ["short", "lost_sentence"]
    assert flags(long, long * 2) == ["long"]
    assert flags("a", "the cat and the dog of", "ru") == ["untranslated"]
    assert flags("a", "in on as by is are for", "ru") == []  # not among the words that count
    assert flags("a", "Mосква", "ru") == ["mixed_script"] and flags("a", "Mосква", "de") == []
    assert flags("<b>" + long + "</b>", long) == []
    assert flags("He left… “So it is.” " * 6, "Er ging und so. " * 6) == ["short", "lost_sentence"]


def test_ridge_against_numpy(spark):
    import numpy as np

    r = np.random.default_rng(3)
    x, pool = r.normal(2, 3, (90, 3)), [f"p{i % 7}" for i in range(90)]
    y = x @ [1.0, -2.0, 0.5] + 3 + r.normal(0, 0.1, 90)
    df = spark.createDataFrame([(float(b), *map(float, a), p) for a, b, p in zip(x, y, pool, strict=True)], "y double, a double, b double, c double, pool string").repartition(4)
    got = {row.feature: row for row in models.ridge(df, "y", ["a", "b", "c"], 1.0, "pool").collect()}
    w = np.array([1 / pool.count(p) for p in pool])
    design = np.column_stack([np.ones(90), (x - x.mean(axis=0)) / x.std(axis=0)])
    wanted = np.linalg.solve(design.T @ (design * w[:, None]) + np.diag([0, 1, 1, 1]), design.T @ (y * w))
    assert np.allclose([got[n].weight for n in ("intercept", "a", "b", "c")], wanted, atol=1e-6)
    assert np.allclose([got[n].scale for n in "abc"], x.std(axis=0), atol=1e-6)


def test_leave_one_out_abstains(spark):
    """A model of other books proposes only beyond every wrong training lead."""
    data = [(f"b{i % 3}", i, float(k == 0), float(k == 0) + (i % 5) / 100, 1.0) for i in range(60) for k in range(3)]
    got = models.leave_one_out(spark.createDataFrame(data, "book string, unit int, y double, f double, g double"), "book", "y", ["f", "g"], unit="unit")
    assert got.count() == 60 and all(r.proposed and r.target == 1 for r in got.collect())


def test_error_model(spark):
    pairs = spark.createDataFrame([("tbe", "the"), ("tbe", "the"), ("batb", "bath"), ("x", "x")], "observed string, target string")
    got = {(r.target, r.observed): r for r in statistics.error_model(pairs).collect()}
    assert set(got) == {("h", "b")} and (got["h", "b"]["count"], got["h", "b"].opportunities) == (2, 2)
    import math

    assert abs(got["h", "b"].cost + math.log(2.5 / 3) / math.log(1000)) < 1e-6
    assert statistics.inverse_variants("tbe", {("h", "b"): 0.2, ("t", "f"): 0.1})["the"] == 0.2


def test_repeated_edits(spark):
    cases = [("b", i, "correct", w.replace("th", "tb"), w) for i, w in enumerate(["the", "them", "bath"])] + [("b", 9, "retain", "tub", "tub"), ("c", 10, "correct", "tbe", "the")]
    got = statistics.repeated_edits(spark.createDataFrame(cases, "book string, id int, expected string, before string, after string")).collect()
    assert [(r.book, r.target, r.observed, r.members, r.exposed) for r in got] == [("b", "h", "b", 3, 1)]


def test_near_terms_against_brute_force(spark):
    from marginalia.functions.similarity import osa

    r = random.Random(7)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(2, 9))) for _ in range(90)})
    lexicon_ = sorted({"".join(r.choice("abc") for _ in range(r.randint(2, 9))) for _ in range(90)})
    got = lexicon.near_terms(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(w, 1) for w in lexicon_], "term string, frequency int"), closest=False)
    # only the first seven letters meet, as their index has it
    wanted = {(a, b): osa(a, b) for a in words for b in lexicon_ if osa(a, b) <= 2 and max(len(a), len(b)) <= 7}
    found = {(x.word, x.term): x.distance for x in got.collect()}
    assert wanted.items() <= found.items() and all(osa(a, b) == d <= 2 for (a, b), d in found.items())


def test_context_ranking_by_hand(spark):
    import math

    occ = spark.createDataFrame([("o", "s", "tbe", "in", None)], "occ_id string, source string, word string, before string, after string")
    candidates = spark.createDataFrame([("tbe", "the", 1, 100), ("tbe", "toe", 1, 100)], "word string, term string, distance int, frequency int")
    counts = spark.createDataFrame([("s", "the", 3)], "source string, term string, n int")
    pairs = spark.createDataFrame([("s", "in", "the", 2), ("s", "in", "a", 1)], "source string, left string, right string, n int")
    zipf = spark.createDataFrame([("the", 6.0), ("toe", 3.0)], "term string, zipf double")
    got = lexicon.ranked_in_context(occ, candidates, counts, pairs, zipf).orderBy("rank").collect()
    g = 0.9 * 2 / 4 + 0.1 * 10 ** (6 - 9)
    assert [r.term for r in got] == ["the", "toe"]
    assert abs(got[0].score - (math.log(100) + 0.5 * math.log1p(3) + math.log((2 + 10 * g) / 13) + 2)) < 1e-5


def test_decision_cascade(spark):
    schema = "occ_id string, word string, term string, distance int, frequency int, book_count int, confusion_supported boolean, score double, rank int"
    ranked = [("a", "w", "t", 1, 9, 2, True, 5.0, 1), ("a", "w", "u", 1, 9, 2, True, 3.0, 2), ("b", "w", "t", 1, 9, 1, True, 5.0, 1), ("c", "w", "t", 1, 9, 2, True, 5.0, 1), ("d", "w", "t", 1, 9, 2, True, 5.0, 1), ("e", "w", "t", 1, 9, 2, True, 5.0, 1), ("e", "w", "u", 1, 9, 2, True, 4.5, 2), ("f", "w", "t", 1, 9, 2, True, 5.0, 1), ("f", "w", "u", 1, 9, 2, True, 4.5, 2)]
    evidence = [("a", 1, ["t", "t"], "x", 4.0), ("b", 1, ["t", "t"], "t", 4.0), ("c", 2, ["t", "t"], "t", 4.0), ("d", 1, ["t", "w"], "t", 4.0), ("e", 1, ["t", "t"], "w", 4.0), ("f", 1, ["t", "t"], "t", 4.0)]
    got = lexicon.decided(spark.createDataFrame(ranked, schema), spark.createDataFrame(evidence, "occ_id string, row_count int, readings array<string>, embedded string, zipf double"))
    assert {r.occ_id: r.reason for r in got.collect()} == {"a": "context-and-two-crop-readings", "b": "insufficient-lexical-evidence", "c": "ambiguous-row-occurrence", "d": "crop-does-not-corroborate", "e": "weak-context-without-embedded-corroboration", "f": "context-and-two-crop-readings"}


def test_corrected_readings_follow_approved_spellings(spark):
    schema = "occ_id string, word string, term string, distance int, zipf double, known boolean, capitalised boolean, score double, own_score double, confusion_supported boolean, readings array<string>"
    rows_ = [
        ("crop", "tbe", "the", 1, 6.0, True, False, 1.0, 9.0, True, ["the", "the"]),
        ("later", "tbe", "the", 1, 6.0, True, False, 1.0, 9.0, False, ["tbe", "x"]),
        ("printed", "tbe", "the", 1, 6.0, True, False, 1.0, 9.0, False, ["tbe", "tbe"]),
        ("meaning", "unable", "able", 2, 6.0, True, False, 9.0, 1.0, True, ["able", "able"]),
        ("judged", "hat", "had", 1, 6.0, True, False, 9.0, 1.0, False, ["x", "y"]),
        ("name", "Shuma", "shame", 2, 6.0, True, True, 9.0, 1.0, True, ["x", "y"]),
    ]
    judged = spark.createDataFrame([("judged", 0.95, 0.9)], "occ_id string, meaning double, grammar double")
    got = {r.occ_id: (r.action, r.route) for r in lexicon.corrected_readings(spark.createDataFrame(rows_, schema), judged).collect()}
    assert got == {"crop": ("correct", "crop"), "later": ("correct", "approved-spelling"), "printed": ("editorial-review", "approved-spelling"), "meaning": ("review", None), "judged": ("correct", "semantic"), "name": ("review", None)}


def test_engine_benchmark_needs_three_and_a_lead(spark):
    pages = [(1, "a", "abcdefgh", 1, 0.9), (1, "b", "abcdefgh", 1, 0.9), (1, "c", "xxxxxxxx", 1, 0.9), (2, "a", "abcdefgh", 1, 0.9), (2, "b", "abcdefxx", 1, 0.9), (2, "c", "xxcdefgh", 1, 0.9), (3, "a", "ab", 1, 0.9), (3, "b", "ab", 1, 0.9)]
    got = evaluation.engine_benchmark(spark.createDataFrame(pages, "page int, engine string, text string, lines int, confidence double"))
    assert {(r.page, r.engine) for r in got.where("proposed").collect()} == {(2, "a")}
    assert {r.agreement for r in got.where("page = 3").collect()} == {1.0}
