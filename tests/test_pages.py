"""Page scans, proposals and repairs, with negative controls."""

import json

import pytest
from pyspark.sql import functions as F

from marginalia.operators import repair
from marginalia.operators.punctuation import paired
from marginalia.sources import pages as P


def page(n, box=(0.1, 0.1, 0.5, 0.2), **other):
    return {"page": n, "width": 100.0, "height": 200.0, "lines": [{"text": "a", "bbox": list(box), "confidence": 0.9, "column": 0}]} | other


def test_scan_and_completeness(spark, tmp_path):
    bad = {2: page(2, box=(0.5, 0.1, 0.1, 0.2)), 3: page(3, width=-1.0), 5: page(5, box=(0.1, 0.1, 0.5)), 6: page(6, lines=None)}
    for n, data in ({1: page(1), 4: page(4)} | bad).items():
        (tmp_path / f"{n}.json").write_text(json.dumps(data))
    found = P.read_pages(spark, str(tmp_path))
    assert {r.page: r.p for r in found.select("page", P.problem().alias("p")).collect()} == {1: None, 2: "bbox", 3: "size", 4: None, 5: "bbox", 6: "lines"}
    assert [r.page for r in P.missing_pages(found, 6).orderBy("page").collect()] == [2, 3, 5, 6]
    assert P.rows(found).count() == 2
    (tmp_path / "7.json").write_text("{broken")
    with pytest.raises(Exception, match="."):
        P.read_pages(spark, str(tmp_path)).collect()


def test_publish_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    first = P.publish(spark.range(3), path, F.col("id") >= 0)
    with pytest.raises(ValueError, match="unchanged"):
        P.publish(spark.range(9), path, F.col("id") < 5)
    assert P.published(spark, path).count() == 3
    P.publish(spark.range(4), path, F.col("id") >= 0)
    assert P.published(spark, path).count() == 4
    assert spark.read.parquet(first).count() == 3  # readers of the old version are not disturbed


def test_seams_need_unknown_halves(spark):
    lines = spark.createDataFrame([(1, 0, "the trans"), (1, 1, "lation is"), (1, 2, "here to"), (1, 3, "gether now")], "doc_id int, pos int, line string")
    known = spark.createDataFrame([("translation",), ("to",), ("together",)], "term string")
    assert [r.joined for r in repair.seams(lines, known).collect()] == ["translation"]


def test_headings_and_labels(spark):
    df = spark.createDataFrame([("Chapter one", 0.2), ("CHAPTER", 0.9), ("plain text", 0.2), ("THE END", 0.3)], "line string, y0 double")
    assert [r.line for r in df.where(repair.heading(F.col("line"), F.col("y0"))).collect()] == ["Chapter one", "THE END"]
    assert [r.line for r in df.where(repair.heading(F.col("line"), F.col("y0"), F.lit(0.1))).collect()] == []
    rows = spark.createDataFrame([("12", 0.95, 0.97), ("12", 0.5, 0.52), ("xiv", 0.02, 0.04), ("ix", 0.06, 0.08), ("twelve", 0.95, 0.97)], "line string, y0 double, y1 double")
    assert [r.line for r in repair.page_labels(rows).collect()] == ["12", "xiv"]


def test_quotes():
    assert paired('he said "yes" and "no"') == ("he said «yes» and «no»", [])
    assert paired('"a ("b") c"') == ("«a („b“) c»", [])
    assert paired('an "orphan') == ('an "orphan', [(3, "unclosed-quote")])
    assert paired('5" wide') == ('5" wide', [(1, "unpaired-or-ambiguous-quote")])


def test_spread_and_boundaries(spark):
    one = spark.range(1)
    assert one.select(repair.spread(F.lit("a b c d e"), F.lit(2))).first()[0] == ["a b", "c d e"]
    assert one.select(repair.boundary_changes(F.lit("of life"), F.lit("oflife"))).first()[0] == [2]
    assert one.select(repair.boundary_changes(F.lit("a b"), F.lit("a b"))).first()[0] == []


def test_links(spark):
    notes = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "p int, n int")
    calls = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (1, 2, 21)], "p int, n int, call_id int")
    assert {r.n: (r.reason, r.call_id) for r in repair.linked(notes, calls, ["p", "n"]).collect()} == {1: ("linked", 10), 2: ("ambiguous", None), 3: ("no-call", None)}
