"""Scalar functions against hand values."""

from pyspark.sql import functions as F

from marginalia.functions import similarity as S
from marginalia.functions import text as X


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(*values):
    return [F.lit(v) for v in values]


def test_tokens(spark):
    assert one(spark, X.tokens(F.lit("Don’t re-use x2, l'été!"))) == ["Don’t", "re-use", "x", "l'été"]
    assert one(spark, X.space_tokens(F.lit("  a  b\tc "))) == ["a", "b", "c"]
    assert one(spark, X.space_tokens(F.lit(" "))) == []
    assert one(spark, X.comparable(F.lit("It’s OK-2!"))) == ["it's", "ok-2"]


def test_signature_and_plain(spark):
    assert one(spark, X.signature(F.lit(" 12 Chapter One. 3"))) == "CHAPTER ONE"
    assert one(spark, X.plain(F.lit("<p>a <b>b</b>\n c</p>"))) == "a b c"
    assert one(spark, X.escape(F.lit("a<b & c>"))) == "a&lt;b &amp; c&gt;"


def test_edit_predicates(spark):
    cases = [("modern", "modem", False), ("form", "from", True), ("cat", "cut", True), ("cat", "cats", True), ("cat", "cat", False), ("abcd", "badc", False), ("", "a", True)]
    for a, b, wanted in cases:
        assert one(spark, X.one_edit(*lit(a, b))) == wanted, (a, b)
    assert one(spark, X.confusable(*lit("clear", "elear")))
    assert not one(spark, X.confusable(*lit("clear", "dlear")))
    assert not one(spark, X.confusable(*lit("clear", "clears")))
    assert not one(spark, X.confusable(*lit("clear", "clear")))
    assert one(spark, X.meaning_sensitive(*lit("unable", "able")))
    assert not one(spark, X.meaning_sensitive(*lit("able", "unable")))


def test_checks(spark):
    assert one(spark, X.isbn13_check(F.lit("978030640615"))) == 7
    assert one(spark, X.isbn10_check(F.lit("030640615"))) == "2"
    assert one(spark, X.isbn10_check(F.lit("080442957"))) == "X"
    assert one(spark, X.is_roman(F.lit("xiv"))) and not one(spark, X.is_roman(F.lit("xiiv"))) and not one(spark, X.is_roman(F.lit("")))


def test_xml(spark):
    assert one(spark, X.xml_safe(F.lit("a\x01b\tc"))) == "a�b\tc"
    assert one(spark, X.illegal_points(F.lit("a\x01b\x0b"))) == [1, 3]


def test_patterns(spark):
    def found(before, text, **how):
        return one(spark, F.expr("1").isNotNull() & F.regexp_like(F.lit(text), X.edit_pattern(F.lit(before), **how)))

    assert found("a.b", "xa.by") and not found("a.b", "xacby")
    assert not found("cat", "cats", whole_word=True) and found("cat", "a cat.", whole_word=True)
    assert found("row", "row", exact_row=True) and not found("row", "row ", exact_row=True)
    assert found("ab", "abc", prefix=True) and not found("bc", "abc", prefix=True) and found("bc", "abc", suffix=True)


def test_boxes(spark):
    a, b = lit(0.0, 0.0, 2.0, 2.0), lit(1.0, 0.0, 3.0, 2.0)
    iou, least = X.box_iou(a, b)
    assert abs(one(spark, iou) - 1 / 3) < 1e-9 and one(spark, least) == 0.5


def test_case(spark):
    assert one(spark, X.transfer_case(*lit("ABC", "word"))) == "WORD"
    assert one(spark, X.transfer_case(*lit("Abc", "word"))) == "Word"
    assert one(spark, X.transfer_case(*lit("abc", "word"))) == "word"


def test_python_functions(spark):
    assert S.osa("ab", "ba") == 1 and S.osa("", "word") == 4 and S.osa("ca", "abc") == 3
    assert S.word_distance(["oflife"], ["of", "life"]) == 2
    assert S.chunks("modem", "modern") == [("m", "rn", 4)]
    rows = spark.createDataFrame([("modem", "modern"), (None, "x")], "a string, b string")
    S.register(spark)
    rows.createOrReplaceTempView("pairs")
    got = spark.sql("SELECT seq_ratio(a, b) r, osa_distance(a, b) o, diff_distance(a, b) d, accent_key('ÉTÉ') k, nfc('é') n, word_edits('oflife', 'of life') w FROM pairs").collect()
    assert abs(got[0].r - 8 / 11) < 1e-9 and got[0].o == 2 and got[0].d == 2
    assert got[1].r is None and got[1].o is None
    assert got[0].k == "ete" and got[0].n == "é" and got[0].w == 2
    row = spark.sql("SELECT beta_quantile(0.5D, 2D, 2D) m, beta_quantile(0.025D, 3D, 8D) l").first()
    assert abs(row.m - 0.5) < 1e-3 and abs(row.l - 0.0667) < 2e-3
