"""Queries over rows of pages with their places: margins, pitches, blocks,
figures, footers and page observations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marginalia.functions import text as X
from marginalia.operators import joins, layout, markup, reconcile, repair, statistics, typography, windows
from marginalia.plans.shared_sql import LINES, STATS, TOKENS
from marginalia.sources import pages as P
from marginalia.sources import tables as T

QUERIES, SQL = {}, {}

#: Lines on a made-up sheet, as :func:`tables.sheet` has them.
SHEET = (
    LINES
    + """, sheet AS (SELECT *, x0 + least(0.75, length(line) / 100.0::DOUBLE) AS x1 FROM (SELECT *, (pos + 0.1::DOUBLE) / n AS y0, (pos + 0.6::DOUBLE) / n AS y1, CASE WHEN pos % 3 = 2 THEN 0.15 ELSE 0.1 END::DOUBLE AS x0
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM lines)))"""
)


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


def _docs(spark, folder):
    return T.table(spark, folder, "documents")


def _sheet(spark, folder):
    return T.sheet(T.lines(_docs(spark, folder)))


def _rows(spark, folder):
    """Sheet rows under the names of the page operators."""
    return _sheet(spark, folder).select("source", F.col("doc_id").alias("page"), F.col("pos").alias("row"), F.col("line").alias("text"), "x0", "y0", "x1", "y1", F.lit(0).alias("col"))


def _wrapped(spark, folder):
    """The same of rows as wide as a page's."""
    rows = T.sheet(T.wrapped(_docs(spark, folder)))
    return rows.select("source", F.col("doc_id").alias("page"), F.col("pos").alias("row"), F.col("line").alias("text"), "x0", "y0", "x1", "y1", F.lit(0).alias("col"))


# ---- page observations -----------------------------------------------------


def _observations(spark, folder):
    """A page a document, one of seven with a planted fault."""
    kind = F.col("doc_id") % 7
    box = F.array(F.lit(0.1), F.lit(0.1), F.when(kind == 2, 0.05).otherwise(0.9), F.lit(0.2))
    line = F.struct(F.when(kind == 3, None).otherwise(F.col("lang")).alias("text"), box.alias("bbox"), F.when(kind == 4, 1.5).otherwise(0.9).alias("confidence"), F.lit(0).alias("column"))
    return _docs(spark, folder).select(
        (F.col("doc_id") + 1).cast("int").alias("page"), F.when(kind == 1, float("inf")).otherwise(612.0).alias("width"), F.lit(792.0).alias("height"), F.when(kind == 5, None).otherwise(F.array(line)).alias("lines")
    )


_FAULT = "CASE doc_id % 7 WHEN 1 THEN 'size' WHEN 2 THEN 'bbox' WHEN 3 THEN 'text' WHEN 4 THEN 'confidence' WHEN 5 THEN 'lines' END"


@query("s1_page_problems", f"SELECT (doc_id + 1)::INT AS page, {_FAULT} AS problem FROM documents")
def page_problems(spark, folder):
    return _observations(spark, folder).select("page", P.problem().alias("problem"))


@query(
    "s2_preflight",
    f"""SELECT (doc_id + 1)::INT AS page, {_FAULT} AS problem FROM documents WHERE doc_id % 7 BETWEEN 1 AND 5 UNION ALL SELECT (max(doc_id) + 2)::INT, 'missing' FROM documents
    UNION ALL SELECT (max(doc_id) + 3)::INT, 'missing' FROM documents UNION ALL SELECT NULL, 'other-source'""",
)
def preflight(spark, folder):
    last = _docs(spark, folder).agg(F.max("doc_id")).first()[0]
    return P.preflight(_observations(spark, folder), last + 3, "sha256-of-a-scan", "sha256-of-another")


@query(
    "s4_clips",
    """WITH p AS (SELECT doc_id AS page, CASE WHEN doc_id % 3 > 0 THEN 0.5 END AS split, CASE WHEN doc_id % 3 = 2 THEN 0.25 ELSE 0.0 END AS start FROM documents)
    SELECT page, 0 AS clip, 0.0::DOUBLE AS x0, 0.0::DOUBLE AS y0, 1.0::DOUBLE AS x1, CASE WHEN split IS NULL OR start = 0 THEN 1.0 ELSE start END::DOUBLE AS y1 FROM p WHERE split IS NULL OR start > 0
    UNION ALL SELECT page, (CASE WHEN start > 0 THEN 1 ELSE 0 END), 0.0, start, split, 1.0 FROM p WHERE split IS NOT NULL UNION ALL SELECT page, (CASE WHEN start > 0 THEN 2 ELSE 1 END), split, start, 1.0, 1.0 FROM p WHERE split IS NOT NULL""",
)
def clips(spark, folder):
    kind = F.col("doc_id") % 3
    return P.page_clips(_docs(spark, folder).select(F.col("doc_id").alias("page"), F.when(kind > 0, 0.5).alias("split"), F.when(kind == 2, 0.25).otherwise(0.0).alias("start")))


@query(
    "s5_embedded",
    f"""WITH {TOKENS}, s AS (SELECT doc_id AS page, pos AS line, string_agg(form, '' ORDER BY idx) AS text, min(idx * 40.0) / 612 AS x0, (max(idx) * 40.0 + 30) / 612 AS x1, min(pos * 12.0) / 792 AS y0, (min(pos) * 12.0 + 10) / 792 AS y1 FROM tokens GROUP BY 1, 2)
    SELECT page, line, text, round(x0::DOUBLE, 9) AS x0, round(y0::DOUBLE, 9) AS y0, round(x1::DOUBLE, 9) AS x1, round(y1::DOUBLE, 9) AS y1, CASE WHEN page % 2 = 0 THEN 0 WHEN y0 < 0.1 THEN -1 WHEN x0 > 0.05 THEN 1 ELSE 0 END AS col FROM s""",
)
def embedded(spark, folder):
    at = lambda c, k: F.col(c) * F.lit(float(k))
    # dealt by page, so that a line's words are joined where they are cut
    spans = T.tokens(T.dealt(_docs(spark, folder))).select(F.col("doc_id").alias("page"), F.col("pos").alias("line"), F.col("idx").alias("seq"), F.col("form").alias("text"), at("idx", 40).alias("x0"), at("pos", 12).alias("y0"), (at("idx", 40) + 30).alias("x1"), (at("pos", 12) + 10).alias("y1"))
    odd = F.col("doc_id") % 2 == 1
    sizes = _docs(spark, folder).select(F.col("doc_id").alias("page"), F.lit(612.0).alias("width"), F.lit(792.0).alias("height"), F.when(odd, 0.05).alias("split"), F.when(odd, 0.1).alias("start"))
    rows = P.embedded_rows(spans, sizes)
    return rows.select("page", "line", "text", *[F.round(c, 9).alias(c) for c in ("x0", "y0", "x1", "y1")], "col")


@query(
    "s15_rendered",
    f"""WITH {LINES}, b AS (SELECT doc_id, pos, CASE WHEN pos = 0 THEN 'h2' WHEN pos % 5 = 4 THEN 'aside' ELSE 'p' END AS t, replace(replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS x FROM lines)
    SELECT doc_id AS chapter, string_agg('<' || t || CASE WHEN pos = 0 THEN ' id="h0"' ELSE '' END || '>' || CASE WHEN pos % 5 = 4 THEN '<a href="#h0">' || x || '</a>' ELSE x END || '</' || t || '>', chr(10) ORDER BY pos) AS html FROM b GROUP BY 1""",
)
def rendered(spark, folder):
    note, head = F.col("pos") % 5 == 4, F.col("pos") == 0
    kind = F.when(head, "heading").when(note, "note").otherwise("text")
    rows = T.lines(_docs(spark, folder)).select(F.col("doc_id").alias("chapter"), F.col("pos").alias("seq"), kind.alias("kind"), F.when(head, "h0").alias("id"), F.col("line").alias("text"), F.when(note, "#h0").alias("href"))
    return markup.rendered(rows)


@query("s17_sheets")
def sheets(spark, folder):
    items = T.lines(_docs(spark, folder)).select("source", F.concat_ws(":", "doc_id", "pos").alias("item_id"), F.regexp_extract("line", r"^\S+", 0).alias("before"), F.lower(F.regexp_extract("line", r"^\S+", 0)).alias("after"), F.col("doc_id"), F.col("line").alias("context"))
    return markup.review_sheet(items, "doc_id").select("doc_id", F.length("html").alias("characters"))


# ---- margins and pages -----------------------------------------------------


@query(
    "f1_roles",
    rf"""WITH {SHEET}, l AS (SELECT source, trim(line) AS t, y0 AS y, pos = 0 AS f, doc_id % 31 = 0 AS xp, doc_id % 5 = 0 AS z, length(regexp_replace(trim(line), '[^\p{{Lu}}]', '', 'g')) / nullif(length(regexp_replace(trim(line), '[^\p{{L}}]', '', 'g')), 0)::DOUBLE AS up FROM sheet)
    SELECT source, CASE WHEN xp THEN 'excluded/profile-excluded-page' WHEN f AND y < 0.02 THEN 'excluded/chapter-title' WHEN y < 0.035 THEN 'excluded/upper-margin-artifact' WHEN y < 0.10 AND coalesce(up > 0.8, false) THEN 'excluded/uppercase-margin-fallback'
    WHEN length(t) <= 4 AND y > 0.84 THEN 'excluded/short-footer-fallback' WHEN z AND y >= 0.8 THEN 'note/profile-note-region' ELSE 'body/retained' END AS role, count(*) AS rows FROM l GROUP BY 1, 2""",
)
def roles(spark, folder):
    page = F.col("doc_id")
    role = layout.role(F.col("line"), F.col("y0"), F.col("pos") == 0, excluded_page=page % 31 == 0, start=F.lit(0.02), note_start=F.when(page % 5 == 0, 0.8))
    return _sheet(spark, folder).groupBy("source", role.alias("role")).agg(F.count("*").alias("rows"))


@query(
    "f2_recurring",
    f"""WITH {SHEET}, e AS (SELECT doc_id, line, y0 + CASE WHEN doc_id % 2 = 0 THEN 0.001 ELSE 0.01 END AS y FROM sheet WHERE pos % 4 = 0) SELECT s.doc_id AS page, s.pos AS row FROM sheet s WHERE EXISTS (SELECT 1 FROM e WHERE e.doc_id = s.doc_id AND e.line = s.line AND abs(e.y - s.y0) < 0.003)""",
)
def recurring(spark, folder):
    rows = _rows(spark, folder).withColumn("y", F.col("y0"))
    excluded = rows.where("row % 4 = 0").select("page", "text", (F.col("y0") + F.when(F.col("page") % 2 == 0, 0.001).otherwise(0.01)).alias("y"))
    return layout.recurring_rows(rows, excluded).select("page", "row")


@query(
    "f6_page_kind",
    f"""WITH h AS (SELECT doc_id, count(*) OVER () AS n, list_filter(string_split(CASE WHEN doc_id % 11 = 0 THEN 'An Index' || chr(10) || text ELSE text END, chr(10))[1:5], lambda t: regexp_matches(t, '(?i)\\bindex\\b')) AS said FROM documents)
    SELECT doc_id AS page, CASE WHEN doc_id % 29 = 3 THEN 'index' WHEN doc_id % 7 = 3 THEN 'figure' WHEN doc_id % 5 = 3 THEN 'note' WHEN doc_id <= least(16, n // 10) THEN 'front' WHEN len(said) > 0 THEN 'index' ELSE 'body' END AS kind FROM h""",
)
def page_kinds(spark, folder):
    docs, page = _docs(spark, folder), F.col("doc_id")
    heads = F.split(F.when(page % 11 == 0, F.concat(F.lit("An Index\n"), "text")).otherwise(F.col("text")), "\n")
    kind = layout.page_kind(page, F.lit(docs.count()), index=page % 29 == 3, figure=page % 7 == 3, note=page % 5 == 3, heads=heads)
    return docs.select(page.alias("page"), kind.alias("kind"))


_FOLIO = """, folio AS (SELECT doc_id, pos, y0, y1, CASE WHEN pos = n - 1 AND doc_id % 3 = 0 THEN (doc_id % 1000)::VARCHAR WHEN pos = 0 AND doc_id % 2 = 0 THEN 'xiv' ELSE line END AS line FROM sheet)"""


def _folios(spark, folder):
    last, first = (F.col("pos") == F.col("n_lines") - 1) & (F.col("doc_id") % 3 == 0), (F.col("pos") == 0) & (F.col("doc_id") % 2 == 0)
    return _sheet(spark, folder).withColumn("line", F.when(last, (F.col("doc_id") % 1000).cast("string")).when(first, "xiv").otherwise(F.col("line")))


@query(
    "f8_page_labels",
    f"""WITH {SHEET}{_FOLIO} SELECT doc_id, pos, trim(line) AS label FROM folio WHERE (y0 > 0.88 OR y1 < 0.075) AND (regexp_matches(trim(line), '^[0-9]{{1,4}}$') OR regexp_matches(trim(line), '^[ivxlcdmIVXLCDM]{{1,8}}$'))""",
)
def page_labels(spark, folder):
    return repair.page_labels(_folios(spark, folder)).select("doc_id", "pos", F.trim("line").alias("label"))


@query(
    "f9_headings",
    f"""WITH {SHEET}, h AS (SELECT doc_id, pos, x0, x1, y0, CASE WHEN pos % 6 = 2 THEN 'Part ' || left(line, 40) ELSE line END AS line FROM sheet) SELECT doc_id, pos FROM h WHERE y0 > 0.07 AND y0 < 0.55 AND length(line) BETWEEN 3 AND 85 AND (x0 + x1) / 2 BETWEEN 0.25 AND 0.75 AND (regexp_matches(line, '^(?i)(chapter|part|book|section)\\b') OR regexp_matches(line, '^[IVXLCDM]+[. ]')
    OR (upper(line) = line AND length(regexp_replace(line, '[^\\p{{L}}]', '', 'g')) >= 5))""",
)
def headings(spark, folder):
    line = F.when(F.col("pos") % 6 == 2, F.concat(F.lit("Part "), F.substring("line", 1, 40))).otherwise(F.col("line"))
    return _sheet(spark, folder).where(repair.heading(line, F.col("y0"), (F.col("x0") + F.col("x1")) / 2)).select("doc_id", "pos")


@query(
    "f13_gate",
    rf"""WITH {LINES}, c AS (SELECT doc_id || ':' || pos AS row_id, pos, line, {{cmp}} AS own, regexp_replace(line, '^\S+', 'Zed') AS v, CASE WHEN doc_id % 2 = 0 THEN regexp_replace(line, '^\S+', 'Zed') ELSE line END AS r FROM lines),
    f AS (SELECT *, list_filter([{{v}}, {{r}}], lambda t: len(t) >= 3) AS fresh FROM c), k AS (SELECT *, list_filter(fresh, lambda t: t[1] <> own[1] AND t[2:] = own[2:]) AS conf FROM f WHERE len(own) >= 3 AND len(fresh) > 0)
    SELECT row_id, CASE WHEN regexp_matches(regexp_extract(line, '^[‘“"]?\S+'), '[a-z][A-Z]') THEN 'irregular-case' WHEN pos = 0 THEN 'chapter-opening' WHEN len(conf) = 2 THEN 'two-peer-initial-word' END AS kind, 'zed' AS words
    FROM k WHERE len(conf) > 0 AND (regexp_matches(regexp_extract(line, '^[‘“"]?\S+'), '[a-z][A-Z]') OR pos = 0 OR len(conf) = 2)""".format(
        **{k: r"regexp_extract_all(lower(translate({}, '’', '''')), '[\p{{L}}\p{{N}}_]+(?:[''-][\p{{L}}\p{{N}}_]+)*')".format(c) for k, c in (("cmp", "line"), ("v", "v"), ("r", "r"))}
    ),
)
def gate(spark, folder):
    other = F.regexp_replace("line", r"^\S+", "Zed")
    rows = T.lines(_docs(spark, folder)).select(F.concat_ws(":", "doc_id", "pos").alias("row_id"), F.col("line").alias("text"), other.alias("vision"), F.when(F.col("doc_id") % 2 == 0, other).otherwise(F.col("line")).alias("rapid"), F.col("line").alias("rendered"), (F.col("pos") == 0).alias("opening"))
    return reconcile.quality_gate(rows).withColumn("words", F.array_join("words", ","))


@query("f14_leakage", f"""WITH {SHEET} SELECT doc_id AS page, pos AS row FROM sheet WHERE pos % 4 = 0 AND pos = n - 1""")
def leakage(spark, folder):
    rows = _sheet(spark, folder).select(F.col("doc_id").alias("page"), F.col("pos").alias("row"), "line", "n_lines")
    return layout.leaked_footers(rows.where("row % 4 = 0").select("page", "row", "line"), rows.where("row = n_lines - 1")).select("page", "row")


def _typed(spark, folder):
    """Rows with a type size: the last third of a page is in small type."""
    rows = _rows(spark, folder)
    small = F.col("y0") > 0.66
    return rows.withColumn("size", F.when(small, 8.0).otherwise(11.0)).withColumn("text", F.when(small & (F.col("row") % 2 == 0), F.concat(F.lit("1 Note "), "text")).otherwise(F.col("text")))


@query("f12_note_footer")
def note_footers(spark, folder):
    return typography.paged(_typed(spark, folder), lambda lines: typography.note_footer(lines), "row int, text string")


@query("m21_small_type")
def small_type(spark, folder):
    rows = _typed(spark, folder).withColumn("y1", F.when(F.col("size") < 10, F.col("y0") + 0.6 * (F.col("y1") - F.col("y0"))).otherwise(F.col("y1")))
    return typography.paged(rows, typography.small_type_zone, "row int, cutoff double, body double")


@query("f21_captions")
def captions(spark, folder):
    rows = _typed(spark, folder).withColumn("text", F.when(F.col("row") % 9 == 0, F.concat(F.lit("Fig. 1 "), "text")).otherwise(F.col("text")))
    rows = rows.withColumn("y1", F.when(F.col("size") < 10, F.col("y0") + 0.5 * (F.col("y1") - F.col("y0"))).otherwise(F.col("y1")))
    return typography.paged(rows, lambda lines: typography.captions(lines, 0.75), "row int, run int")


@query("m14_headers")
def headers(spark, folder):
    title = F.when(F.col("row") == 1, F.concat(F.lit("THE BOOK OF A "), F.when(F.col("page") % 9 == 4, "TOWM").otherwise("TOWN"))).otherwise(F.col("text"))
    rows = _rows(spark, folder).select("source", "page", F.col("y0").alias("y"), title.alias("text"))
    return layout.running_heads(layout.margin_rows(rows), "source")


@query(
    "a11_mode_offset",
    """WITH l AS (SELECT lang, doc_id, doc_id % 7 - len(string_split(text, chr(10))) % 7 AS o FROM documents), c AS (SELECT lang, o, count(DISTINCT doc_id) AS pages FROM l GROUP BY 1, 2)
    SELECT lang, o AS "offset", pages FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY pages DESC, abs(o), o) AS k FROM c) WHERE k = 1""",
)
def mode_offset(spark, folder):
    rows = _docs(spark, folder).select("lang", "doc_id", (F.col("doc_id") % 7 - F.size(F.split("text", "\n")) % 7).alias("offset"))
    return typography.mode_offset(rows, "lang", "offset", "doc_id")


@query(
    "a12_offset_runs",
    "SELECT len(string_split(text, chr(10))) - 10 AS \"offset\", count(*) AS pages, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS page_list FROM documents GROUP BY 1 HAVING count(*) >= 3",
)
def offset_runs(spark, folder):
    rows = _docs(spark, folder)
    found = typography.offset_runs(rows, (F.size(F.split("text", "\n")) - 10).cast("long"), "doc_id")
    return found.withColumn("page_list", F.array_join(F.transform("page_list", lambda p: p.cast("string")), ","))


@query("a14_edges")
def edges(spark, folder):
    return statistics.fitted_edges(_sheet(spark, folder).select("doc_id", "y0", (F.col("x0") + 0.05 * F.col("y0")).alias("x0")), "doc_id")


# ---- rows and blocks -------------------------------------------------------


@query("w2_native_rows")
def native_rows(spark, folder):
    half = F.expr("left(text, length(text) div 2)"), F.expr("substr(text, length(text) div 2 + 1)")
    rows = _rows(spark, folder).withColumn("h", F.explode(F.array(F.struct(F.lit(0).alias("k"), half[0].alias("t")), F.struct(F.lit(1).alias("k"), half[1].alias("t")))))
    k = F.col("h.k")
    pieces = rows.select("page", (F.col("row") * 2 + k).alias("row"), F.col("h.t").alias("text"), (F.lit(0.1) + 0.3 * k).alias("x0"), "y0", (F.lit(0.399) + 0.3 * k).alias("x1"), "y1")
    return typography.merged_native(pieces)


@query(
    "w3_pitch",
    f"""WITH {SHEET}, s AS (SELECT doc_id AS page, lead((y0 + y1) / 2) OVER (PARTITION BY doc_id ORDER BY pos) - (y0 + y1) / 2 AS step FROM sheet) SELECT page, 0 AS col, count(*) AS advances, round(median(step), 6) AS pitch FROM s WHERE step > 0 GROUP BY 1 HAVING count(*) >= 8""",
)
def pitch(spark, folder):
    return typography.pitches(_rows(spark, folder)).withColumn("pitch", F.round("pitch", 6))


@query("w4_blocks")
def blocks(spark, folder):
    return typography.paged(_rows(spark, folder), typography.segmented, "row int, block int, kind string, continuation boolean")


@query(
    "w6_line_policy",
    f"""WITH {STATS}, k AS (SELECT term FROM stats WHERE count >= 2), h AS (SELECT doc_id, pos * 2 + unnest([0, 1]) AS pos, unnest([left(line, length(line) // 2) || CASE WHEN pos % 3 = 0 THEN '-' WHEN pos % 3 = 1 THEN '-.' ELSE '' END, substr(line, length(line) // 2 + 1)]) AS line FROM lines),
    n AS (SELECT doc_id, pos, line AS a, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM h), e AS (SELECT *, regexp_extract(a, '([\\p{{L}}\\p{{N}}_]+)(-\\.?)$', 1) AS l, regexp_extract(a, '([\\p{{L}}\\p{{N}}_]+)(-\\.?)$', 2) AS d, regexp_extract(b, '^(\\p{{L}}+)', 1) AS r FROM n WHERE b IS NOT NULL),
    w AS (SELECT *, d <> '' AND r <> '' AS broken, lower(l || r) IN (SELECT term FROM k) AS whole, lower(l || '-' || r) IN (SELECT term FROM k) AS kept FROM e)
    SELECT doc_id, pos, CASE WHEN broken AND kept AND d = '-.' THEN 'remove-noise-retain-compound' WHEN broken AND kept THEN 'retain' WHEN broken AND whole THEN 'remove' WHEN broken AND d = '-.' THEN 'space' WHEN broken THEN 'retain' ELSE 'space' END AS action FROM w""",
)
def line_policy(spark, folder):
    mark = F.when(F.col("pos") % 3 == 0, "-").when(F.col("pos") % 3 == 1, "-.").otherwise("")
    halves = F.array(F.concat(F.expr("left(line, length(line) div 2)"), mark), F.expr("substr(line, length(line) div 2 + 1)"))
    lines = T.lines(_docs(spark, folder)).select("doc_id", "pos", F.posexplode(halves).alias("k", "half")).select("doc_id", (F.col("pos") * 2 + F.col("k")).alias("pos"), F.col("half").alias("line"))
    known = statistics.collection_stats(_docs(spark, folder)).where("count >= 2")
    return typography.line_policy(lines, known).select("doc_id", "pos", "action")


@query("w7_gaps")
def gap_rows(spark, folder):
    rows = _rows(spark, folder)
    return typography.paged(rows.where("row % 7 <> 3"), typography.gaps, "before int, peer int, top double, bottom double, represented boolean", other=rows)


@query(
    "w8_two_anchors",
    rf"""WITH {SHEET}, r AS (SELECT doc_id, pos, line, x0, y0, x1, y1, CASE WHEN pos % 2 = 0 THEN left(line, length(line) // 3) ELSE line END AS cut FROM sheet), c AS (SELECT *, x0 + least(0.75, length(cut) / 100.0::DOUBLE) AS cx1,
    regexp_extract_all(lower(cut), '\p{{L}}+(?:[''’-]\p{{L}}+)*') AS own FROM r), m AS (SELECT a.doc_id, a.pos, b.pos AS p, len(list_filter(list_distinct(a.own), lambda w: length(w) >= 3 AND list_contains(regexp_extract_all(lower(b.line), '\p{{L}}+(?:[''’-]\p{{L}}+)*'), w))) AS anchors
    FROM c a JOIN c b ON a.doc_id = b.doc_id AND len(a.own) >= 3 AND abs(a.y0 + a.y1 - b.y0 - b.y1) / 2 <= 0.012 AND greatest(a.x0 - b.x0, b.x1 - a.cx1) > 0.1 AND a.cx1 - a.x0 < 0.75 * (b.x1 - b.x0))
    SELECT doc_id AS page, pos AS row, min(p) AS peer FROM m WHERE anchors >= 2 GROUP BY 1, 2""",
)
def two_anchors(spark, folder):
    return typography.truncated(*_cut_rows(spark, folder), fuzzy=False)


def _cut_rows(spark, folder):
    peers = _rows(spark, folder)
    cut = F.when(F.col("row") % 2 == 0, F.expr("left(text, length(text) div 3)")).otherwise(F.col("text"))
    return peers.withColumn("x1", F.col("x0") + F.least(F.lit(0.75), F.length(cut) / 100)).withColumn("text", cut), peers


@query("w8_truncated")
def truncated(spark, folder):
    return typography.truncated(*_cut_rows(spark, folder))


@query("w9_body_start")
def body_starts(spark, folder):
    return typography.paged(_rows(spark, folder), lambda lines: typography.body_start(lines, 0.27), "configured double, inferred double, rows int")


@query("w11_verse")
def verse(spark, folder):
    rows = _rows(spark, folder).withColumn("size", F.lit(11.0)).withColumn("x1", F.col("x0") + F.col("x1") / 3)
    return typography.paged(rows, lambda lines: [*typography.verse(lines, 0.8), *typography.inset_verse(lines, 0.8)], "first int, last int, rows int")


@query("w12_headings")
def isolated(spark, folder):
    label, step = F.col("row") % 10 == 6, 0.4 * (F.col("y1") - F.col("y0"))
    rows = _rows(spark, folder).withColumn("text", F.when(label, "A Label").otherwise(F.col("text"))).withColumn("s", F.when(label, step).otherwise(0.0))
    rows = rows.withColumn("y0", F.col("y0") + F.col("s")).withColumn("y1", F.col("y1") + F.col("s")).drop("s")
    return typography.paged(rows, typography.isolated_headings, "row int, text string")


@query(
    "w10_quotes",
    f"""WITH {LINES}, m AS (SELECT doc_id, pos, length(line) < 40 AS i, lag(length(line) < 40) OVER (PARTITION BY doc_id ORDER BY pos) AS p FROM lines),
    r AS (SELECT doc_id, pos, i, sum(CASE WHEN p IS NULL OR p <> i THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM m)
    SELECT doc_id, min(pos) AS "first", max(pos) AS "last", count(*) AS rows FROM r WHERE i GROUP BY doc_id, run HAVING count(*) >= 3""",
)
def quote_runs(spark, folder):
    return layout.quote_runs(T.lines(_docs(spark, folder)).select("doc_id", "pos", "line"), F.length("line") < 40, ["doc_id"], "pos")


@query("w21_lists")
def hanging(spark, folder):
    rows = _rows(spark, folder).withColumn("text", F.when(F.col("row") % 3 == 0, F.concat(F.lit("• "), "text")).otherwise(F.col("text")))
    return windows.hanging_lists(rows.select("page", "row", "text", "x0"), "page", "row").select("page", "row", "item")


@query(
    "w22_gutter",
    f"""WITH {SHEET}, c AS (SELECT doc_id AS page, CASE WHEN pos % 2 = 0 THEN 0.1 ELSE 0.55 + pos % 4 / 100.0 END::DOUBLE AS x0, CASE WHEN pos % 2 = 0 THEN 0.3 + least(0.15, length(line) / 1000.0) ELSE 0.9 END::DOUBLE AS x1 FROM sheet WHERE y0 < 0.9),
    g AS (SELECT page, list_sort(list(x1) FILTER (x1 < 0.49)) AS l, list_sort(list(x0) FILTER (x0 > 0.51)) AS r FROM c GROUP BY 1), e AS (SELECT page, l[round_even((len(l) - 1) * 0.85, 0)::INT + 1] AS a, r[round_even((len(r) - 1) * 0.15, 0)::INT + 1] AS b FROM g WHERE len(l) >= 8 AND len(r) >= 8)
    SELECT page, round((a + b) / 2, 4) AS split, round(a, 4) AS left_edge, round(b, 4) AS right_edge FROM e WHERE b - a >= 0.025""",
)
def gutters(spark, folder):
    even = F.col("row") % 2 == 0
    rows = _rows(spark, folder).withColumn("x0", F.when(even, 0.1).otherwise(0.55 + F.col("row") % 4 / 100)).withColumn("x1", F.when(even, 0.3 + F.least(F.lit(0.15), F.length("text") / 1000)).otherwise(0.9))
    return typography.gutter(rows)


@query(
    "w23_controls",
    """WITH f AS (SELECT source, doc_id AS page, 0.9 + (doc_id * 37 % 100) / 2000.0::DOUBLE AS y FROM documents WHERE n_chars > 300), l AS (SELECT *, list(y) OVER (PARTITION BY source ORDER BY page RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING) AS v, median(y) OVER (PARTITION BY source) AS am, count(*) OVER (PARTITION BY source) AS n FROM f),
    m AS (SELECT *, list_aggregate(v, 'median') AS c FROM l), d AS (SELECT *, list_aggregate(list_transform(v, lambda x: abs(x - c)), 'median') AS mad, median(abs(y - am)) OVER (PARTITION BY source) AS amad FROM m)
    SELECT source, page, CASE WHEN len(v) >= 3 THEN len(v) ELSE n END AS controls, round(CASE WHEN len(v) >= 3 THEN c ELSE am END, 6) AS centre, round(least(0.035, greatest(0.015, 4 * CASE WHEN len(v) >= 3 THEN mad ELSE amad END)), 6) AS tolerance FROM d""",
)
def controls(spark, folder):
    folios = _docs(spark, folder).where("n_chars > 300").select("source", F.col("doc_id").alias("page"), (0.9 + (F.col("doc_id") * 37 % 100) / 2000.0).alias("y"))
    return typography.folio_controls(folios, "source")


@query(
    "m15_families",
    r"""WITH r AS (SELECT source, doc_id AS page, (doc_id % 30) || ' ' || CASE WHEN doc_id % 4 = 0 THEN 'Press of the Town' ELSE 'Works, vol. ' || chr(65 + (doc_id % 3)::INT) END || ' ' || (doc_id + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 2 END) AS t FROM documents),
    s AS (SELECT source, page, trim(regexp_replace(upper(regexp_extract(t, '^([0-9]{1,3}\s*[*∗]?)\s+(.+?)\s+(\d{1,4})$', 2)), '[^\p{L}]+', ' ', 'g')) AS family, regexp_extract(t, '^([0-9]{1,3}\s*[*∗]?)\s+(.+?)\s+(\d{1,4})$', 3) AS n FROM r)
    SELECT source, family, count(DISTINCT page) AS pages FROM s WHERE n <> '' AND n::BIGINT = page + 2 AND length(family) BETWEEN 4 AND 50 GROUP BY 1, 2 HAVING count(DISTINCT page) >= 3""",
)
def families(spark, folder):
    page = F.col("doc_id")
    label = F.when(page % 4 == 0, "Press of the Town").otherwise(F.concat(F.lit("Works, vol. "), F.char(65 + page % 3)))
    text = F.concat_ws(" ", (page % 30).cast("string"), label, (page + F.when(page % 5 == 0, 1).otherwise(2)).cast("string"))
    return typography.footer_families(_docs(spark, folder).select("source", page.alias("page"), text.alias("text")), "source", F.lit(2))


@query(
    "m20_places",
    f"""WITH {SHEET}, r AS (SELECT doc_id, pos, y0, line, lag(line) OVER w AS p FROM sheet WINDOW w AS (PARTITION BY doc_id ORDER BY pos)), b AS (SELECT *, coalesce(regexp_matches(p, '[\\p{{L}}\\p{{N}}_]-\\.?\\s*$') AND regexp_matches(line, '^\\s*\\p{{Ll}}'), false) AS broken FROM r),
    c AS (SELECT *, coalesce(lag(broken) OVER (PARTITION BY doc_id ORDER BY pos), false) AS above FROM b), f AS (SELECT d.doc_id, min(pos) AS s FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id AND c.y0 >= 0.45 GROUP BY 1)
    SELECT f.doc_id, f.doc_id::VARCHAR AS figure, CASE WHEN broken AND NOT above THEN s - 1 ELSE s END AS seq, CASE WHEN s IS NULL THEN 'end' WHEN broken AND above THEN 'after-block' WHEN broken THEN 'moved' ELSE 'before' END AS place FROM f LEFT JOIN c ON c.doc_id = f.doc_id AND c.pos = f.s""",
)
def figure_places(spark, folder):
    rows = _sheet(spark, folder).select("doc_id", F.col("pos").alias("seq"), F.col("doc_id").alias("page"), "y0", F.col("line").alias("text"))
    figures = _docs(spark, folder).select("doc_id", F.col("doc_id").alias("figure"), F.col("doc_id").alias("page"), F.lit(0.45).alias("y0"))
    return typography.figure_places(rows, figures, "doc_id")


@query(
    "m20_flow",
    f"""WITH {SHEET}, f AS (SELECT doc_id AS page, CASE WHEN doc_id % 2 = 0 THEN 0.0 ELSE 0.6 END::DOUBLE AS x0, CASE WHEN doc_id % 2 = 0 THEN 0.12 ELSE 1.0 END::DOUBLE AS x1 FROM documents),
    c AS (SELECT f.page, count(*) FILTER (s.x0 >= f.x1 - 0.06) AS r, count(*) FILTER (s.x1 <= f.x0 + 0.06) AS l FROM f JOIN sheet s ON s.doc_id = f.page AND s.y1 > 0.2 AND s.y0 < 0.7 GROUP BY 1)
    SELECT page AS figure, CASE WHEN r > l THEN 'float-left' ELSE 'float-right' END AS flow FROM c WHERE greatest(l, r) >= 3""",
)
def figure_flow(spark, folder):
    even = F.col("doc_id") % 2 == 0
    figures = _docs(spark, folder).select(F.col("doc_id").alias("figure"), F.col("doc_id").alias("page"), F.when(even, 0.0).otherwise(0.6).alias("x0"), F.when(even, 0.12).otherwise(1.0).alias("x1"), F.lit(0.2).alias("y0"), F.lit(0.7).alias("y1"))
    return typography.figure_flow(_rows(spark, folder), figures)


@query("m22_boxes")
def boxes(spark, folder):
    return typography.grouped_boxes(_rows(spark, folder).where("row % 4 < 2").select("page", "x0", "y0", "x1", "y1"))


# ---- joins by place --------------------------------------------------------


@query(
    "j2_band",
    f"""WITH {SHEET} SELECT a.doc_id AS page, a.pos AS row, count(*) AS peers FROM sheet a JOIN sheet b ON a.doc_id = b.doc_id AND (b.y0 + b.y1) / 2 + 0.001 BETWEEN a.y0 AND a.y1 + 0.002 AND abs(b.x0 - a.x0) < 0.035 AND abs(b.x1 - a.x1) < 0.05 GROUP BY 1, 2""",
)
def band(spark, folder):
    rows = _rows(spark, folder)
    peers = rows.withColumn("y0", F.col("y0") + 0.001).withColumn("y1", F.col("y1") + 0.001)
    return joins.in_band(rows, peers).groupBy("page", "row").agg(F.count("*").alias("peers"))


@query(
    "j11_nearby",
    f"""WITH {SHEET}, c AS (SELECT doc_id AS page, pos, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM sheet) SELECT a.page, a.pos AS decision, count(*) AS rows FROM c a JOIN c b ON a.page = b.page AND a.pos % 2 = 0 AND abs(a.y + 0.002 - b.y) < 0.005 AND abs(a.x - b.x) < 0.15 GROUP BY 1, 2""",
)
def nearby(spark, folder):
    rows = _rows(spark, folder).select("page", "row", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    decisions = rows.where("row % 2 = 0").select("page", F.col("row").alias("decision"), "x", (F.col("y") + 0.002).alias("y"))
    return joins.nearby(decisions, rows).groupBy("page", "decision").agg(F.count("*").alias("rows"))


@query("j23_aligned")
def aligned(spark, folder):
    rows = _wrapped(spark, folder).select("page", F.concat_ws(":", "page", "row").alias("row"), ((F.col("y0") + F.col("y1")) / 2).alias("centre"), "text")
    source = rows.withColumn("text", F.when(F.length("text") % 2 == 0, F.regexp_replace("text", "(.)", "$1 ")).otherwise(F.replace("text", F.lit("th"), F.lit("tb"))))
    return typography.aligned_source(rows, source)


@query("j24_missing_lines")
def missing_lines(spark, folder):
    rows = _wrapped(spark, folder).select("page", F.concat_ws(":", "page", "row").alias("row_id"), "row", ((F.col("y0") + F.col("y1")) / 2).alias("centre"), "text")
    third = F.when(F.col("row") % 6 == 3, F.reverse("text")).otherwise(F.col("text"))
    return reconcile.missing_readings(rows.select("page", "row_id", "centre", "text", (F.col("row") % 3 != 0).alias("primary"), F.struct("text").alias("second"), F.struct(third.alias("text")).alias("third")))


@query("m7_seam_candidates")
def seam_candidates(spark, folder):
    half = F.array(F.expr("left(text, length(text) div 2)"), F.expr("substr(text, length(text) div 2 + 1)"))
    rows = _rows(spark, folder).select("page", "row", "y0", "y1", F.posexplode(half).alias("k", "text"))
    high = F.col("y1") - F.col("y0")
    rows = rows.select("page", (F.col("row") * 2 + F.col("k")).alias("row"), F.lit(0).alias("col"), "text", F.lit(0.1).alias("x0"), (F.col("y0") + F.col("k") * high / 2).alias("y0"), F.lit(0.9).alias("x1"), (F.col("y0") + (F.col("k") + 1) * high / 2).alias("y1"))
    lexicon = statistics.collection_stats(_docs(spark, folder)).select("term", "count")
    return repair.seam_candidates(rows, lexicon, lexicon.where("false").select("term"))


@query(
    "m7_seams",
    f"""WITH {STATS}, k AS (SELECT term FROM stats WHERE page_df >= 3), h AS (SELECT doc_id, pos * 2 + unnest([0, 1]) AS pos, unnest([left(line, length(line) // 2), substr(line, length(line) // 2 + 1)]) AS line FROM lines),
    w AS (SELECT doc_id, pos, regexp_extract_all(lower(line), '\\p{{L}}+(?:[''’-]\\p{{L}}+)*') AS t FROM h), n AS (SELECT doc_id, pos, t, lead(t) OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM w), e AS (SELECT doc_id, pos, t[-1] AS a, n[1] AS b FROM n WHERE len(t) > 0 AND len(n) > 0)
    SELECT doc_id, pos, a, b, a || b AS joined FROM e WHERE a NOT IN (SELECT term FROM k) AND b NOT IN (SELECT term FROM k) AND a || b IN (SELECT term FROM k)""",
)
def seams(spark, folder):
    docs = _docs(spark, folder)
    halves = F.array(F.expr("left(line, length(line) div 2)"), F.expr("substr(line, length(line) div 2 + 1)"))
    lines = T.lines(docs).select("doc_id", "pos", F.posexplode(halves).alias("k", "line")).select("doc_id", (F.col("pos") * 2 + F.col("k")).alias("pos"), "line")
    return repair.seams(lines, statistics.collection_stats(docs).where("page_df >= 3"))


@query(
    "m12_case",
    f"""WITH {STATS}, f AS (SELECT doc_id, pos, idx, term, CASE WHEN length(form) >= 4 AND idx % 5 = 2 THEN left(lower(form), 2) || upper(substr(form, 3, 1)) || substr(form, 4) ELSE form END AS form FROM tokens WHERE NOT contains(form, 'ß'))
    SELECT doc_id, pos, idx, form, term AS repaired FROM f WHERE regexp_matches(form, '^\\p{{L}}*\\p{{Ll}}\\p{{Lu}}\\p{{L}}*$') AND term IN (SELECT term FROM stats WHERE page_df >= 2)""",
)
def case_repairs(spark, folder):
    tokens = T.tokens(_docs(spark, folder)).where(~F.contains("form", F.lit("ß")))
    mixed = F.concat(F.substring(F.lower("form"), 1, 2), F.upper(F.substring("form", 3, 1)), F.substr("form", F.lit(4)))
    tokens = tokens.withColumn("form", F.when((F.length("form") >= 4) & (F.col("idx") % 5 == 2), mixed).otherwise(F.col("form")))
    return repair.case_repairs(tokens, statistics.collection_stats(_docs(spark, folder)).where("page_df >= 2"))


@query("m12_witnessed_case")
def witnessed_case(spark, folder):
    line = F.col("line")
    rows = T.wrapped(_docs(spark, folder)).select(F.concat_ws(":", "doc_id", "pos").alias("row_id"), F.regexp_replace("line", r"\b(\p{Ll}{3})(\p{Ll}{2})\b", "$1X$2").alias("text"), F.regexp_replace(line, "X", "").alias("one"), line.alias("two"))
    known = statistics.collection_stats(_docs(spark, folder)).select("term")
    return repair.case_decisions(rows, ("one", "two"), known, known.where("false"), letters="A-Za-z")


@query(
    "u2_shared_words",
    f"""WITH {LINES}, t AS (SELECT doc_id, pos, list_distinct(regexp_extract_all(lower(line), '\\p{{L}}+(?:[''’-]\\p{{L}}+)*')) AS w, lead(list_distinct(regexp_extract_all(lower(line), '\\p{{L}}+(?:[''’-]\\p{{L}}+)*'))) OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM lines)
    SELECT doc_id, pos, len(list_filter(w, lambda x: list_contains(n, x))) AS shared FROM t WHERE n IS NOT NULL""",
)
def shared_words(spark, folder):
    words = F.array_distinct(X.tokens(F.lower("line")))
    rows = T.lines(_docs(spark, folder)).select("doc_id", "pos", words.alias("w"))
    rows = rows.withColumn("n", F.lead("w").over(Window.partitionBy("doc_id").orderBy("pos"))).where("n is not null")
    return rows.select("doc_id", "pos", F.size(F.array_intersect("w", "n")).cast("long").alias("shared"))


@query(
    "k5_triage",
    f"""WITH {SHEET}, t AS (SELECT source, doc_id AS page, pos, y0, CASE WHEN pos % 3 = 0 THEN 0 WHEN pos % 3 = 1 THEN 1 ELSE 2 END AS t FROM sheet) SELECT source, page, pos, row_number() OVER (PARTITION BY source ORDER BY t, page, y0) AS rank FROM t""",
)
def triage(spark, folder):
    tier = F.when(F.col("pos") % 3 == 0, "three-peer-consensus").when(F.col("pos") % 3 == 1, "fresh-peer-consensus").otherwise("other")
    rows = _sheet(spark, folder).select("source", F.col("doc_id").alias("page"), "pos", "y0", tier.alias("tier"))
    return windows.triage(rows, "source").select("source", "page", "pos", "rank")
