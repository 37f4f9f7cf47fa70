"""Row rules, punctuation, codec, notes and typography by hand, each with a
control that must stay as it is."""

import io
import json
import zipfile
from xml.etree import ElementTree as E

import pytest
from marginalia.functions import similarity as S
from marginalia.operators import codec, markup, notes, punctuation, reconcile, repair, rowrules, sequence, statistics, translation, typography
from marginalia.operators.typography import Line
from marginalia.sources import archives
from marginalia.sources import pages as P
from pyspark.sql import functions as F

ZIPF = {"modern": 4.0, "modem": 1.0, "world": 5.0, "the": 7.0, "there": 5.0, "all": 6.0, "left": 4.0, "house": 4.5, "horse": 4.2, "это": 6.0, "на": 6.5, "все": 6.0, "его": 6.0}


def row(text, embedded=None, second=None, third=None, **options):
    r = rowrules.repair(rowrules.Row(text, embedded, second, third, lambda w: ZIPF.get(w.lower(), 0.0), rowrules.Options(**options)))
    return r.text, [k for k, *_ in r.events]


@pytest.mark.parametrize(
    ("args", "options", "text", "kinds"),
    [
        (("a\x01b",), {}, "a�b", ["invalid-xml-ocr-character"]),
        (("a b",), {}, "a b", []),
        (("a moderu world", None, "a modern world", "a modern world"), {}, "a modern world", ["two-witness-token"]),
        (("a moderu world", None, "a modern world", "a moderu world"), {}, "a modern world", ["fresh-word-for-nonword"]),
        (("the modern world", None, "the modem world", "the modem world"), {}, "the modern world", []),
        (("J saw", "I saw", "I saw", "I saw"), {}, "I saw", ["two-witness-token"]),
        (("*Well he said”", None, '"Well he said"', "“Well he said”"), {}, "“Well he said”", ["two-fresh-quote-mark"]),
        (("*Well he said", None, '"Well he said', '"Well he said'), {}, "*Well he said", []),
        (("then-again he", None, "then—again he", "then--again he"), {}, "then—again he", ["two-fresh-em-dash"]),
        (("well-known he", None, "well—known he", "well-known he"), {}, "well-known he", []),
        (("_word is here now_", None, "word is here now", "word is here now"), {"edge_artifacts": True}, "word is here now", ["two-fresh-edge-artifact"] * 2),
        (("_word is here now_", None, "word is here now", "word is here now"), {}, "_word is here now_", []),
        (("x = _word is now", None, "x = word is now", "x = word is now"), {"edge_artifacts": True}, "x = _word is now", []),
        (("TbE reason is plain here", "T H E reason is plain here", "The reason is plain here", None), {}, "THE reason is plain here", ["spaced-initial-word"]),
        (("TbE reason is plain here", "T H E reason is plain", "The reason is plain here", None), {}, "TbE reason is plain here", []),
        (("Tbe reason is plain", "The reason is plain", "The reason is plain", "The reason is plain"), {}, "The reason is plain", ["three-witness-initial-word"]),
        (("Tbe reason is plain", None, "The reason is plain", None), {}, "Tbe reason is plain", []),
        (("Smith, 1O3, l24", None, "Smith, 103, 124", "Smith, 103, 124"), {"index_digits": True}, "Smith, 103, 124", ["two-fresh-index-digit"] * 2),
        (("Smith, 1O3", None, "Smith, 103", "Smith, 103"), {}, "Smith, 1O3", []),
        (("Smith and others, 1O3, 12", None, "Smith and others, 103, 12", "Smith and others, 1O3, 12"), {"index_digits": True}, "Smith and others, 103, 12", ["witnessed-index-digit"]),
        (("Smith and others, 1O3", None, "Smith and others, 108", "Smith and others, 1O3"), {"index_digits": True}, "Smith and others, 1O3", []),
        (("Smith, 10gn", None, "Smith, 109n", "Smith, 10gn"), {"index_digits": True, "labels": frozenset({"109"})}, "Smith, 109n", ["witnessed-index-digit"]),
        (("Smith, 10gn", None, "Smith, 109n", "Smith, 10gn"), {"index_digits": True, "labels": frozenset({"110"})}, "Smith, 10gn", []),
        (("(Smith, 19 61, p. 4)", None, "(Smith, 1961, p. 4)", "(Smith, 1961, p. 4)"), {}, "(Smith, 1961, p. 4)", ["witnessed-citation-year-spacing"]),
        (("(Smith, 19 61, p. 4)", None, "(Smith, 1961, p. 4)", "(Smith, 19 61, p. 4)"), {}, "(Smith, 19 61, p. 4)", []),
        (("(Osmond, 196la, p. 76)",), {}, "(Osmond, 1961a, p. 76)", ["citation-year-digit"]),
        (("50g, 196g, and",), {}, "50g, 196g, and", []),
        (("see 19612, there", None, "see 1961a, there", "see 1961a, there"), {}, "see 1961a, there", ["witnessed-citation-year-suffix"]),
        (("see 19612, there", None, "see 1961a, there", "see 1961b, there"), {}, "see 19612, there", []),
        (("a]l of it",), {}, "all of it", ["bracket-letter-l"]),
        (("[a]l of it",), {}, "[a]l of it", []),
        (("the hovse there", None, "the house there", "the hovse there"), {}, "the house there", ["fresh-word-for-nonword"]),
        (("the hovse there", None, "the house there", "the horse there"), {}, "the hovse there", []),
        (("hovse there", None, "house there", "hovse there"), {}, "hovse there", []),
        (("№ 5 и Nº 7 все",), {"language": "ru"}, "№ 5 и № 7 все", ["russian-numero"]),
        (("все Ha это",), {"language": "ru"}, "все на это", ["russian-latin-lookalike"]),
        (("это XX все",), {"language": "ru"}, "это XX все", []),
        (("в ХІХ веке",), {"language": "ru"}, "в XIX веке", ["russian-roman-numeral"]),
        (("было єго тут", None, "было его тут", None), {"language": "ru"}, "было его тут", ["russian-letter-witness"]),
        (("было єго тут",), {"language": "ru"}, "было его тут", ["russian-letter-lookalike"]),
        (("было єго тут",), {}, "было єго тут", []),
    ],
)
def test_row_rules(args, options, text, kinds):
    assert row(*args, **options) == (text, kinds)


def test_every_kind_is_in_the_vocabulary():
    found = {k for args, options, *_ in test_row_rules.pytestmark[0].args[1] for k in row(*args, **options)[1]}
    assert found <= set(archives.AUDIT_KINDS) and len(found) >= 18


def test_disagreement():
    def disagrees(text, embedded, second, third):
        return rowrules.disagrees(rowrules.Row(text, embedded, second, third, lambda w: ZIPF.get(w, 0.0)))

    assert disagrees("a b", None, "a c", "a d") and not disagrees("a b", "a b", "a c", "a d")
    assert not disagrees("Delbrück wrote", None, "Delbruck wrote", None) and not disagrees("a b", None, None, None)


def test_reconciled_table(spark):
    rows = spark.createDataFrame([("1", "the hovse there", None, "the house there", "the house there"), ("2", None, None, None, None)], "row_id string, text string, embedded string, vision string, rapid string")
    lexicon = spark.createDataFrame(list(ZIPF.items()), "term string, zipf double")
    done = reconcile.reconciled(reconcile.frequencies(rows, ["embedded", "vision", "rapid"], lexicon)).collect()
    got = {r.row_id: (r.repaired, [e.kind for e in r.events], r.disagrees) for r in done}
    assert got == {"1": ("the house there", ["two-witness-token"], False), "2": ("", [], False)}


def test_anchored_changes_and_splits():
    assert reconcile.anchored("He saw The modem art there", "he saw the modern art there") == [(11, 16, "modem", "modern", 4)]
    assert reconcile.anchored("modem", "modern") == [] and reconcile.anchored("a modem b", "a modern b") == []
    assert reconcile.splits("he ranaway from home", "he ran away from home") == [(3, 10, "ranaway", "ran away", 3)]
    assert reconcile.splits("he ranaway from home", "he run away from home") == [] and reconcile.splits("ranaway", "ran away") == []


def test_located_words():
    assert reconcile.anchored_reading("he saw the modem art", "he saw the modern art", "modem", "modern") == "modern"
    assert reconcile.anchored_reading("a modem b modem", "a modern b modern", "modem", "modern") is None
    assert reconcile.anchored_reading("the modem", "some other text here", "modem", "modern") is None


def test_missing_lines_and_regions(spark):
    schema = "page int, row_id string, centre double, text string"
    have = spark.createDataFrame([(1, "p1", 0.10, "the first line")], schema)
    embedded = spark.createDataFrame([(1, "e1", 0.101, "the first line"), (1, "e2", 0.20, "a lost line of text"), (1, "e3", 0.30, "another lost line"), (1, "e4", 0.40, "short")], schema)
    second = spark.createDataFrame([(1, "s2", 0.201, "a lost line of text"), (1, "s3", 0.30, "another lost line")], schema)
    third = spark.createDataFrame([(1, "t2", 0.199, "a lost line of text"), (1, "t3", 0.30, "no likeness whatever")], schema)
    assert {r.row_id: r.action for r in reconcile.missing_lines(have, embedded, second, third).collect()} == {"e2": "insert", "e3": "review"}
    wide = "page int, row_id string, col int, x0 double, y0 double, x1 double, y1 double, centre double, text string, confidence double"
    tall = spark.createDataFrame([(1, "p", 0, 0.1, 0.10, 0.9, 0.16, 0.13, "gar bled zz", 0.9), (1, "q", 0, 0.1, 0.30, 0.9, 0.36, 0.33, "one line two line", 0.9)], wide)
    lines = [(1, f"{n}{i}", 0, 0.1, y, 0.9, y + 0.02, y + 0.01, t, 0.9) for n, y0 in (("a", 0.10), ("b", 0.30)) for i, (y, t) in enumerate([(y0, "one line"), (y0 + 0.035, "two line")])]
    other = [(p, "t" + i, *rest) for p, i, *rest in lines]
    got = reconcile.region_recovery(tall, spark.createDataFrame(lines, wide), spark.createDataFrame(other, wide)).collect()
    assert [(r.row_id, r.lines) for r in got] == [("p", ["one line", "two line"])]


def test_punctuation_decisions():
    def after(text, cached, fresh, **more):
        return [(d[2], d[3], d[4]) for d in punctuation.decisions(text, cached, fresh, **more)]

    assert after("they left.: And then", "they left. And then", "they left. And then") == [(".: ", ". ", "source-punctuation-witnesses")]
    assert after("they left.: And then", "they left. And then", "they left; And then") == [(".: ", None, "punctuation-witness-conflict")]
    assert after("they left.: And then", "they left. And then", None) == [(".: ", None, "punctuation-witness-conflict")]
    assert after("they left. And then", "they left And then", "they left And then") == []  # nothing suspect
    long = "this is a long line of prose that goes on and on until it has no stop"
    assert after(long, long + ".", long + ".") == [("", ".", "source-punctuation-witnesses")]
    assert after(long, long + "-", long + "-") == [("", None, "wrap-dash-needs-span-review")]
    assert punctuation.gap("one, two; one, two", ["one"], ["two"]) is None
    assert punctuation.gap("some other worde, here", ["some", "other", "words"], ["here"], fuzzy=True) is not None


def test_seams_and_case(spark):
    schema = "page int, row int, col int, text string, x0 double, y0 double, x1 double, y1 double"
    lines = [(1, 0, 0, "the trans", 0.1, 0.10, 0.9, 0.12), (1, 1, 0, "lation of ABc", 0.1, 0.12, 0.9, 0.14), (1, 2, 0, "well known and", 0.1, 0.14, 0.9, 0.16), (1, 3, 0, "then he said", 0.1, 0.16, 0.9, 0.18), (1, 4, 0, "far", 0.1, 0.60, 0.9, 0.62)]
    known = spark.createDataFrame([(w, 5) for w in ("translation", "and", "then", "said", "well")], "term string, count int")
    got = repair.seam_candidates(spark.createDataFrame(lines, schema), known, known.where("false").select("term")).collect()
    assert [(r.row, r.joined, r.kind) for r in got] == [] or {(r.row, r.joined) for r in got} <= {(0, "translation"), (1, "abcwell")}
    marked = spark.createDataFrame([(1, 0, 0, "the trans-", 0.1, 0.10, 0.9, 0.12), (1, 1, 0, "lation of it", 0.1, 0.12, 0.9, 0.14)], schema)
    assert [(r.joined, r.kind) for r in repair.seam_candidates(marked, known, known.where("false").select("term")).collect()] == [("translation", "exact-join")]
    guarded = spark.createDataFrame([("trans",)], "term string")
    assert repair.seam_candidates(marked, known, guarded).count() == 0
    rows = spark.createDataFrame([("1", "там было оДна книга", "там было одна книга", "там было одна книга"), ("2", "там было оДна книга", "там было одна книга", "там было Одна книга"), ("3", "там была Москва тут", "там была москва тут", "там была москва тут")], "row_id string, text string, one string, two string")
    words = spark.createDataFrame([("одна",), ("книга",)], "term string")
    found = {r.row_id: (r.target, r.action) for r in repair.case_decisions(rows, ("one", "two"), words, words.where("false")).collect()}
    assert found == {"1": ("одна", "correct"), "2": (None, "review")}


def test_codec_round_trip():
    xml = '<p>One <em>two <b>three</b></em> <a href="#n"><sup>3</sup></a> F<i>OREST</i> end<br/>more<span id="pb"/> last &amp; least</p>'
    block = E.fromstring(xml)
    encoded = codec.Encoded(block)
    assert encoded.text == "One <x1>two <x2>three</x2></x1> <x3>3</x3> FOREST end\nmore last &amp; least"
    again = codec.decode(encoded.text, block, encoded)
    assert codec.visible(again) == codec.visible(block) and [codec.local(n) for n in again.iter()].count("sup") == 1
    moved = codec.decode("Eins <x1>zwei <x2>drei</x2></x1> FOREST Ende\nmehr &amp;", block, encoded)  # the model lost the link
    assert moved.find(".//a") is not None and "drei" in codec.visible(moved)
    for broken, why in (("One <x1>two</x1>\n", "dropped"), ("One <x9>a</x9>\n", "unknown"), ("<x1>a</x1><x1>b<x2>c</x2></x1>\n", "duplicated"), ("<x1>a<x2>b</x2></x1>", "breaks"), ("<x1>a\n", "malformed")):
        with pytest.raises(ValueError, match=why):
            codec.decode(broken, block, encoded)


def test_fallback_levels():
    block = E.fromstring("<p>One <em>two</em> three</p>")
    assert codec.translate_block(block, lambda t: t.upper().replace("X1", "x1"))[1] == 0
    answers = iter(["lost it", "One <x1>two</x1>"])
    assert codec.translate_block(block, lambda t: next(answers))[1] == 1
    assert codec.translate_block(block, lambda t: "plain")[1] == 2
    linked = E.fromstring('<p>One <a href="#n">two</a> three</p>')
    done, level = codec.translate_block(linked, lambda t: "<x7>" if "<x1>" in t else "a < b")
    assert level == 3 and done.find("a") is not None
    with pytest.raises(ValueError, match="runaway"):
        codec.translate_block(block, lambda t: t * 9 + "x" * 300)
    two = [E.fromstring("<p>a b</p>"), E.fromstring("<p>c <em>d</em></p>")]
    got = codec.translate_batch(two, lambda t: t if "seg1" in t else "C <x1>D</x1>")
    assert [n for _, n in got] == [0, 0]
    got = codec.translate_batch(two, lambda t: "no segments" if "seg1" in t else t)
    assert [(codec.visible(b), n) for b, n in got] == [("a b", 0), ("c d", 0)]
    assert codec.segments("<seg1>a</seg1>\n\n<seg2>b <x1>c</x1></seg2>", 2) == ["a", "b <x1>c</x1>"]
    with pytest.raises(ValueError, match="outside"):
        codec.segments("<seg1>a</seg1> and", 1)


def test_chunks_and_sentences():
    text = "Dr. Smith came. He saw J. S. Bach. <x1>Not. Here</x1> ok. end"
    assert "".join(S.sentences_of(text)) == text
    assert S.sentences_of(text) == ["Dr. Smith came. ", "He saw J. S. Bach. ", "<x1>Not. Here</x1> ok. end"]
    assert codec.chunks("One. Two. Three.", 9, lambda s: s.startswith("Two")) == [(False, "One. "), (True, "Two. "), (False, "Three.")]
    assert codec.chunks("short") == [(False, "short")]


def test_small_parts_of_markup():
    heading = E.fromstring('<h1>F<span class="s">OREST</span> T<span class="s">REES</span></h1>')
    style = codec.small_caps_style(heading)
    assert style == ("span", {"class": "s"}) and codec.small_caps_style(E.fromstring("<h1>Forest</h1>")) is None
    made = codec.set_small_caps(E.fromstring("<h1>der wald</h1>"), style)
    assert E.tostring(made, encoding="unicode") == '<h1>D<span class="s">ER</span> W<span class="s">ALD</span></h1>'
    assert codec.note_reference(E.fromstring("<a>[12]</a>")) and not codec.note_reference(E.fromstring("<a>see 12</a>"))
    page = '<html><head><title>t</title></head><body><div><p id="a">one</p><p>two <a href="x">l</a><img src="i.png"/></p></div></body></html>'
    assert codec.content_signature(page) == ("onetwo l", ["a"], [({"href": "x"}, "l")], 1)
    assert [codec.visible(u) for u in codec.units(page)] == ["one", "two l"] and [codec.visible(u) for u in codec.window(page, 2, 1)] == ["one"]
    assert codec.references(page) == ["x", "i.png"] and codec.references("<p><script/></p>") is None
    assert codec.references("a { background: url('b.png') } @import \"c.css\";", css=True) == ["b.png", "c.css"]


def test_note_links(spark):
    blocks = spark.createDataFrame([(1, 1, "text", "a call* here"), (2, 1, "text", "two* calls* here"), (3, 1, "text", "number 7 and 7 raised"), (4, 1, "heading", "no* call"), (5, 1, "text", "*leading mark")], "block_id int, chapter int, kind string, text string")
    sources = spark.createDataFrame([(1, 1, 0, 50), (2, 2, 0, 50), (3, 3, 0, 50), (4, 4, 0, 50), (5, 5, 0, 50)], "block_id int, page int, start int, stop int")
    styles = spark.createDataFrame([(3, 13, 14, True, None)], "block_id int, start int, stop int, raised boolean, href string")
    found = [(i, 1, i, t, 1) for i, t in ((1, "* a note"), (2, "* a note"), (3, "7 a note"), (4, "* a note"), (5, "* a note"), (6, "no mark"), (7, "* two * marks"))]
    got = {r.note_id: r for r in notes.link_notes(spark.createDataFrame(found, "note_id int, chapter int, page int, text string, entries int"), blocks, sources, styles).collect()}
    assert {i: r.status for i, r in got.items()} == {1: "linked", 2: "nonunique-body-symbol", 3: "linked", 4: "nonunique-body-symbol", 5: "nonunique-body-symbol", 6: "unrecognized-note-prefix", 7: "multiple-note-symbols"}
    assert (got[1].start, got[1].anchor) == (6, "footnoteref-1") and (got[3].start, got[3].anchor) == (13, "footnoteref-3-7")


def test_endnotes(spark):
    schema = "book int, seq int, kind string, text string, x0 double"
    rows = [(1, 0, "heading", "One", 0.1), (1, 1, "text", "1. first", 0.1), (1, 2, "text", "continues 4. not", 0.1), (1, 3, "text", "2. second", 0.1), (1, 4, "text", "9. deep", 0.3), (1, 5, "heading", "Two", 0.1), (1, 6, "text", "stray", 0.1), (1, 7, "text", "1. a", 0.1), (1, 8, "text", "3. b", 0.1), (2, 0, "text", "1. early", 0.1)]
    sections = spark.createDataFrame([(1, "One", 5, 2), (1, "Two", 6, 3)], "book int, heading string, chapter int, expected int")
    got = notes.endnotes(spark.createDataFrame(rows, schema), sections)
    assert {(r.book, r.seq): r.problem for r in got.collect()} == {(1, 0): None, (1, 1): None, (1, 3): None, (1, 5): "incomplete", (1, 6): "unnumbered-initial", (1, 7): None, (1, 8): "sequence-error", (2, 0): "text-before-heading"}
    calls = spark.createDataFrame([(5, 1, 10), (5, 1, 3), (5, 7, 1)], "chapter int, number int, place int")
    linked, lost = notes.link_endnotes(got.where("id is not null and book = 1 and chapter = 5"), calls, by_chapter=True)
    assert {r.number: r.backlinks for r in linked.collect()} == {1: ["noteref-5-1-1", "noteref-5-1-2"], 2: ["chapter-05.xhtml#chapter-start"]}
    assert [(r.chapter, r.number) for r in lost.collect()] == [(5, 7)]


def test_recovery_of_numbers(spark):
    options = [(1, c, n, v, 5) for c, n, v in ((1, 1, 2), (2, 7, 2), (3, 3, 2))]
    schema = "o int, candidate long, number long, votes long, most long"
    read = spark.createDataFrame([(1, 2, ["2", "2"]), (1, 3, ["9"])], "o int, candidate long, readings array<string>")
    got = notes.recovered(spark.createDataFrame(options, schema), read, "o", "most")
    assert {(r.candidate, r.number) for r in got.where("status = 'selected'").collect()} == {(1, 1), (2, 2), (3, 3)}
    anchors = spark.createDataFrame([(1, 1, 10, True), (1, 4, 40, True), (1, 6, 5, False)], "o int, number long, position long, trusted boolean")
    found = spark.createDataFrame([(1, 2, 20, 2, 0), (1, 3, 30, 1, 1), (1, 3, 99, 2, 2)], "o int, number long, position long, votes int, candidate long")
    status = {r.number: r.status for r in notes.researched(anchors, found, spark.createDataFrame([(1, 7)], "o int, notes int"), "o").collect()}
    assert status == {2: "selected", 3: "selected", 5: "no-candidate", 7: "no-candidate"}
    assert notes.running_numbers([("NOTES", 0.1, []), ("1. Smith wrote", 0.1, []), ("l. Jones wrote more", 0.1, ["2. Jones wrote more", "2. Jones wrote more"]), ("3. Brown", 0.1, [])]) == [(2, "l", "2")]
    assert notes.running_numbers([("1. Smith", 0.1, []), ("l. Jones", 0.1, ["2. Jones", "7. Jones"])]) == []


def test_searches(spark):
    anchors = spark.createDataFrame([(1, 1, 10, True), (1, 4, 40, True), (1, 5, 1, False), (2, 1, 50, True), (2, 3, 20, True)], "o int, number int, position int, trusted boolean")
    expected = spark.createDataFrame([(1, 6), (2, 3), (3, 1)], "o int, notes int")
    got = {(r.o, r.number): (r.lower, r.upper, r.status) for r in sequence.searches(anchors, "o", "number", "position", expected).collect()}
    assert got == {(1, 2): (10, 40, "searchable"), (1, 3): (10, 40, "searchable"), (1, 6): (40, None, "searchable"), (2, 2): (50, 20, "anchor-order-conflict"), (3, 1): (None, None, "searchable")}


def prose(n=12, start=0.05, step=0.03, height=0.02, x0=0.1, x1=0.9, **more):
    text = "This is an ordinary line of prose that is long enough to count as one."
    return [Line(i, text, x0, start + i * step, x1, start + i * step + height, **more) for i in range(n)]


def test_native_rows():
    pieces = [Line(0, "one", 0.1, 0.100, 0.2, 0.110), Line(1, "two", 0.21, 0.101, 0.3, 0.111), Line(2, "ce", 0.3, 0.101, 0.32, 0.111), Line(3, "next", 0.1, 0.13, 0.2, 0.14)]
    assert [typography.native_text(r) for r in typography.native_rows(pieces)] == ["one twoce", "next"]


def test_gap_rows():
    rows, peers = prose(12), prose(12)
    assert [(g[0], g[1]) for g in typography.gaps(rows[:5] + rows[6:], [Line(i, f"A row of its own that no other row has {i} words", r.x0, r.y0, r.x1, r.y1) for i, r in enumerate(peers)])] == [(4, 5)]
    assert typography.gaps(rows, peers) == [] and typography.gaps(rows[:4], peers) == []
    assert typography.gap_text_agrees("broken word here", "word here", "it is un-", lambda w: w == "unbroken") and not typography.gap_text_agrees("broken word here", "word here", "it is un", lambda w: True)
    line = "eight words are needed here for any support"
    assert typography.presence_supported(line, [line, line], [(line, 0.9)]) and not typography.presence_supported(line, [line, line], [(line, 0.5)])


def test_body_start_and_blocks():
    rows = prose(14, start=0.2)
    assert typography.body_start(rows, 0.27)[0][1:] == (0.2, 3)
    assert typography.body_start([Line(0, "A TITLE", 0.3, 0.1, 0.7, 0.14), *prose(10, start=0.28)], 0.27) == []
    indented = [*prose(3), Line(3, "An indented line.", 0.13, 0.14, 0.9, 0.16), Line(4, "more of it", 0.1, 0.17, 0.9, 0.19), Line(5, "1. a number", 0.1, 0.191, 0.9, 0.21)]
    assert [b for _, b, *_ in typography.segmented(prose(3, step=0.021))] == [0, 0, 0]
    assert len({b for _, b, *_ in typography.segmented(indented)}) >= 3
    assert typography.segmented([Line(0, "goes on from before", 0.1, 0.1, 0.9, 0.12)])[0][3] and not typography.segmented(prose(1))[0][3]


def test_verse_and_headings():
    poem = [Line(i, f"Upper line {i}", 0.2 + 0.03 * (i % 2), 0.1 + 0.03 * i, 0.4 + 0.02 * (i % 4), 0.12 + 0.03 * i, size=11.0) for i in range(9)]
    assert typography.verse(poem, 0.8) == [(0, 8, 9)]
    assert typography.verse(poem[:2], 0.8) == [] and typography.verse(prose(9, size=11.0), 0.8) == []
    lines = prose(4) + [Line(4, "He wrote as follows:", 0.1, 0.17, 0.9, 0.19)] + [Line(5 + i, "a short line", 0.2, 0.2 + 0.03 * i, 0.35 + 0.04 * i, 0.22 + 0.03 * i) for i in range(4)]
    assert typography.inset_verse(lines, 0.8) == [(5, 8, 4)] and typography.inset_verse(prose(9), 0.8) == []
    rows = prose(8)
    shifted = rows[:4] + [Line(90, "A Label", 0.1, rows[4].y0 + 0.01, 0.3, rows[4].y1 + 0.01)] + [Line(r.row, r.text, r.x0, r.y0 + 0.04, r.x1, r.y1 + 0.04) for r in rows[4:]]
    assert typography.isolated_headings(shifted) == [(90, "A Label")]
    assert typography.isolated_headings(rows) == []


def test_footers_and_captions():
    small = [Line(50, "1 Smith wrote this", 0.1, 0.70, 0.9, 0.71, size=8.0), Line(51, "and more", 0.1, 0.72, 0.9, 0.73, size=8.0)]
    assert typography.note_footer(prose(12, size=11.0) + small) == [(50, "1 Smith wrote this")]
    assert typography.note_footer(prose(12, size=11.0) + small, 0.6) == [] and typography.note_footer(prose(12, size=11.0) + small[:1]) == []
    assert [z[0] for z in typography.small_type_zone(prose(12) + small)] == [50] and typography.small_type_zone(prose(5) + small) == []
    caption = [Line(60, "Fig. 3", 0.1, 0.62, 0.3, 0.63), Line(61, "a house", 0.1, 0.64, 0.3, 0.65)]
    assert typography.captions(prose(12) + caption, 0.6) == [(60, 0), (61, 0)] and typography.captions(prose(12) + [Line(60, "no cue", 0.1, 0.62, 0.3, 0.63)], 0.6) == []
    items = [Line(0, "• one", 0.1, 0.1, 0.5, 0.12), Line(1, "goes on", 0.18, 0.125, 0.5, 0.145), Line(2, "not", 0.1, 0.15, 0.5, 0.17)]
    assert [(r, c) for r, _, c in typography.hanging_items(items, lambda r: 0.18)] == [(0, False), (1, True)]


def test_edges():
    points = [(0.05 * i, 0.1 + 0.02 * 0.05 * i) for i in range(15)]
    slope, intercept, error, inliers = statistics.fitted_edge(points + [(0.3, 0.5)], 0.15)
    assert abs(slope - 0.02) < 1e-6 and abs(intercept - 0.1) < 1e-6 and error < 1e-6 and inliers == 15
    assert statistics.fitted_edge(points[:5], 0.15) is None and statistics.fitted_edge([(y, 0.1 + 0.5 * y) for y, _ in points], 0.15) is None


def test_figure_places(spark):
    rows = spark.createDataFrame([(1, i, 1, 0.1 * i, t) for i, t in enumerate(["first", "a bro-", "ken word", "last"])], "ch int, seq int, page int, y0 double, text string")
    figures = spark.createDataFrame([(1, "a", 1, 0.15), (1, "b", 1, 0.25), (1, "c", 2, 0.0), (1, "d", 0, 0.9)], "ch int, figure string, page int, y0 double")
    assert {r.figure: (r.seq, r.place) for r in typography.figure_places(rows, figures, "ch").collect()} == {"a": (1, "moved"), "b": (3, "before"), "c": (None, "end"), "d": (0, "before")}


def test_footer_family_is_the_only_like_one(spark):
    families = spark.createDataFrame([("b", "PRESS OF THE TOWN"), ("b", "WORKS OF THE TOWN")], "book string, family string")
    rows = spark.createDataFrame([("b", 1, "Press of the Town"), ("b", 2, "Pross of thc TOWNS"), ("b", 3, "Presz of the Press")], "book string, row int, label string")
    assert {r.row: r.family for r in typography.footer_family(rows, families, "book").collect()} == {1: "PRESS OF THE TOWN", 2: None, 3: None}


def test_archives(spark, tmp_path):
    container = '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OPS/c.opf"/></rootfiles></container>'
    opf = '<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/><item id="b" href="b.xhtml" media-type="application/xhtml+xml"/><item id="n" href="n.xhtml" media-type="application/xhtml+xml"/></manifest><spine><itemref idref="b"/><itemref idref="a"/></spine></package>'
    members = {"mimetype": "application/epub+zip", "META-INF/container.xml": container, "OPS/c.opf": opf} | {f"OPS/{c}.xhtml": f"<html><body><p>{c}</p></body></html>" for c in "abn"}
    table = spark.createDataFrame([(n, bytearray(d.encode())) for n, d in members.items()], "name string, data binary")
    data = archives.archive(table)
    assert data == archives.archive(table.orderBy(F.desc("name")).repartition(3))
    assert zipfile.ZipFile(io.BytesIO(data)).infolist()[0].filename == "mimetype"
    (tmp_path / "one.epub").write_bytes(data)
    (tmp_path / "two.epub").write_bytes(b"no archive")
    got = archives.read_books(spark, str(tmp_path)).collect()
    assert sorted((r.seq, r.member) for r in got if r.member) == [(0, "OPS/b.xhtml"), (1, "OPS/a.xhtml"), (2, "OPS/n.xhtml")]
    assert [r.book.endswith("two.epub") for r in got if r.member is None] == [True]


GOOD = {"title": "T", "author": "A", "language": "en", "slug": "a-b", "source_sha256": "0" * 64, "chapters": [[1, 3, "One"], [4, 9, "Two"]], "artwork_pages": []}


@pytest.mark.parametrize(
    ("change", "problem"),
    [
        ({}, None),
        ({"nonsense": 1}, "nonsense: unknown"),
        ({"title": 3}, "title: wrong kind"),
        ({"title": " "}, "title: empty"),
        ({"slug": "../x"}, "slug: no file name"),
        ({"source_sha256": "ABC"}, "source_sha256: no lower-case SHA-256 digest"),
        ({"note_starts": {"3": 0.8}}, None),
        ({"note_starts": {"30": 0.8}}, "note_starts: a key is no page"),
        ({"note_starts": {"3": 1.8}}, "note_starts: a value is outside 0..1"),
        ({"upper_margin_cutoff": float("nan")}, "upper_margin_cutoff: wrong kind"),
        ({"link_numeric_footnotes": 1}, "link_numeric_footnotes: wrong kind"),
        ({"text_source": "guess"}, "text_source: expected one of ocr, native"),
        ({"chapters": [[1, 3, "One"], [3, 9, "Two"]]}, "chapters[1]: overlaps the chapter before"),
        ({"require_complete_numeric_footnotes": True}, "require_complete_numeric_footnotes: needs link_numeric_footnotes"),
        ({"figures": [{"page": 1, "rect": [0.5, 0.1, 0.2, 0.9]}]}, "figures[0]: expected a page and an ordered box in 0..1"),
    ],
)
def test_profiles(change, problem):
    found = archives.profile_problems(GOOD | change, 20)
    assert found == ([problem] if problem else [])
    if problem:
        with pytest.raises(ValueError, match="."):
            archives.check_profile(GOOD | change, 20)


def test_clips_and_boxes(spark):
    got = spark.range(1).select(*P.page_box([F.lit(v) for v in (0.0, 0.5, 1.0, 1.0)], [F.lit(v) for v in (0.5, 0.2, 1.0, 1.0)])).first()
    assert [round(v, 9) for v in got] == [0.5, 0.6, 1.0, 1.0]


def test_structural_difference_and_sheets(spark):
    a = spark.createDataFrame([(1, json.dumps({"a": {"b": 1, "c": [1, 2]}, "d": None}))], "k int, j string")
    b = spark.createDataFrame([(1, json.dumps({"a": {"b": 2, "c": [1, 2]}, "e": {}}))], "k int, j string")
    assert sorted((r.path, r.before, r.after) for r in markup.structural_difference(a, b, "k", "j").collect()) == [("a.b", "1", "2"), ("d", "null", None), ("e", None, "{}")]
    sheet = markup.review_sheet(spark.createDataFrame([(1, 1, "a<b", "a b", "x")], "p int, item_id int, before string, after string, context string"), "p").first()
    assert "&lt;" in sheet.html and "→" in sheet.html


def test_established_in_rounds(spark):
    quotes = spark.createDataFrame([(1, "a quote of some length"), (2, "another")], "quote_id int, quote string")
    options = spark.createDataFrame([(1, i, f"an option number {i:03}") for i in range(23)] + [(2, 0, "x")], "quote_id int, seq int, option string")
    pick = lambda quote, found: max(range(len(found)), key=lambda i: found[i])
    assert [(r.quote_id, r.option) for r in translation.established(quotes, options, pick, most=4).collect()] == [(1, "an option number 022")]
    assert translation.established(quotes, options, lambda q, f: None, most=4).count() == 0


def test_verified_spellings(spark):
    glossary = spark.createDataFrame([("ayahuasca", "аяуаска"), ("ayahuasquero", "Аяуаскеро"), ("Siberian", "сибирский")], "term string, rendering string")
    pages = spark.createDataFrame([("Ayahuasca", "Айяуаска", False), ("Siberia", "Сибирь", False)], "title string, target_title string, disambiguation boolean")
    redirects = spark.createDataFrame([("Siberian", "Siberia")], "source string, target string")
    got = {r.term: r.spelled for r in translation.verified_spellings(glossary, redirects, pages).collect()}
    assert got == {"ayahuasca": "айяуаска", "ayahuasquero": "Айяуаскеро"}


def test_term_drift(spark):
    pairs = spark.createDataFrame([(1, "the ayahuasca vine", "айяуаска и египет"), (2, "no such term", "айяуаска")], "id int, source string, target string")
    glossary = spark.createDataFrame([("ayahuasca", "аяуаска"), ("vine", "лоза")], "term string, rendering string")
    assert [(r.id, r.term, r.word) for r in translation.drift(pairs, glossary, ["id"]).collect()] == [(1, "ayahuasca", "айяуаска")]


def test_functions_in_sql(spark):
    S.register(spark)
    got = spark.sql("SELECT bare('Étude') b, norm('É-t ü') n, sentences('One. Two') s, map_span('a b c', 'x a b', 2, 3).start m, respelled('x y', 'Jakob', 'Jacob (name)') r, pair_quotes('a \"b\"') q, split_words('he ranaway from home', 'he ran away from home') w, edit_label('modem', 'modern') l, template_quotes('{{Q|a {{x|y}} b|c}}') t").first()
    assert (got.b, got.n, got.s, got.m, got.r, got.q, got.w, got.l, got.t) == ("Etude", "etu", ["One. ", "Two"], 4, "Jacob", "a «b»", ["ran away"], "m → rn", ["a {{x|y}} b"])
    assert [r.text for r in spark.sql("SELECT * FROM html_blocks('<p>a<p>b')").collect()] == ["a", "b"]
    assert [r.target for r in spark.sql("SELECT * FROM anchored_changes('he saw the modem art', 'he saw the modern art')").collect()] == ["modern"]
