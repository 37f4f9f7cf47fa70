"""Queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.functions import similarity as S
from marginalia.functions import text as X
from marginalia.operators import punctuation, repair, statistics
from marginalia.plans.shared_sql import LINES, STATS, TOKENS
from marginalia.sources import tables as T

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


def _docs(spark, folder):
    return T.table(spark, folder, "documents")


def _lines(spark, folder):
    return T.lines(_docs(spark, folder))


def _stats(spark, folder):
    return statistics.collection_stats(_docs(spark, folder))


@query(
    "t1b_ocr_tokens",
    rf"""WITH {LINES} SELECT doc_id, pos, array_to_string(regexp_extract_all(line, '[\p{{L}}\p{{N}}_]+(?:[''’-][\p{{L}}\p{{N}}_]+)*|[^\p{{L}}\p{{N}}_\s\p{{Z}}]'), ' ') AS tokens FROM lines""",
)
def ocr_tokens(spark, folder):
    return _lines(spark, folder).select("doc_id", "pos", F.array_join(X.ocr_tokens(F.col("line")), " ").alias("tokens"))


@query("t1d_lexical", rf"""WITH {LINES} SELECT doc_id, pos, array_to_string(regexp_extract_all(line, '[\p{{L}}\p{{Nl}}\p{{No}}]+|\p{{Nd}}+'), ' ') AS tokens FROM lines""")
def lexical_tokens(spark, folder):
    return _lines(spark, folder).select("doc_id", "pos", F.array_join(X.lexical_tokens(F.col("line")), " ").alias("tokens"))


@query("t1g_short", rf"""WITH {LINES} SELECT doc_id, pos, array_to_string(list_filter(regexp_extract_all(line, '[\p{{L}}\p{{N}}]+'), lambda w: length(w) <= 3), ' ') AS tokens FROM lines""")
def short_tokens(spark, folder):
    return _lines(spark, folder).select("doc_id", "pos", F.array_join(X.short_tokens(F.col("line")), " ").alias("tokens"))


@query(
    "t1f_plain_sentences",
    rf"""WITH {LINES} SELECT doc_id, pos, unnest(string_split_regex(line, '[.!?;]\s+')) AS sentence, generate_subscripts(string_split_regex(line, '[.!?;]\s+'), 1)::INT - 1 AS seq FROM lines""",
)
def plain_sentences(spark, folder):
    return _lines(spark, folder).select("doc_id", "pos", F.posexplode(X.plain_sentences(F.col("line"))).alias("seq", "sentence"))


@query("t1f_sentences")
def sentences(spark, folder):
    return _docs(spark, folder).select("doc_id", F.posexplode(S.sentences("text")).alias("seq", "sentence"))


@query("t7_keys", f"""WITH {STATS} SELECT term, strip_accents(term) AS bare, regexp_replace(strip_accents(lower(term)), '[^\\p{{L}}\\p{{N}}_]', '', 'g') AS norm FROM stats""")
def accent_keys(spark, folder):
    return _stats(spark, folder).select("term", S.bare("term").alias("bare"), S.norm("term").alias("norm"))


@query(
    "t8_folded",
    r"""WITH t AS (SELECT item_id, '• ' || text || '-' || chr(10) || '  ' || text || '—“' AS t FROM benchmark)
    SELECT item_id, regexp_replace(trim(regexp_replace(regexp_replace(translate(t, '’—–', '''--'), '([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])', '\1\2', 'g'), '\s+', ' ', 'g')), '^[*•+ ]+', '') AS folded FROM t""",
)
def folded(spark, folder):
    text = F.concat(F.lit("• "), "text", F.lit("-\n  "), "text", F.lit("—“"))
    return T.table(spark, folder, "benchmark").select("item_id", X.folded(text).alias("folded"))


@query("t8_nfc", "SELECT item_id, nfc_normalize(text) AS nfc FROM benchmark")
def nfc(spark, folder):
    return T.table(spark, folder, "benchmark").select("item_id", S.nfc("text").alias("nfc"))


@query(
    "t10_punctuation",
    rf"""WITH {LINES}, q AS (SELECT doc_id, pos, replace(replace(line, '!!', '“'), '.', ' ’') AS t FROM lines)
    SELECT doc_id, pos, regexp_replace(translate(t, '“”‘’', repeat(chr(34), 2) || repeat(chr(39), 2)), '\s+', '', 'g') AS canonical,
    trim(regexp_replace(translate(CASE WHEN contains(t, '“') OR contains(t, chr(34)) THEN translate(t, '’‘' || chr(39), repeat(chr(34), 3)) ELSE t END, '„“”«»', repeat(chr(34), 5)), '\s+', ' ', 'g')) AS form FROM q""",
)
def punctuation_forms(spark, folder):
    t = F.replace(F.replace("line", F.lit("!!"), F.lit("“")), F.lit("."), F.lit(" ’"))
    rows = _lines(spark, folder).select("doc_id", "pos", t.alias("t"))
    return rows.select("doc_id", "pos", X.canonical(F.col("t")).alias("canonical"), X.punctuation_form(F.col("t"), F.col("t")).alias("form"))


@query(
    "t11_case",
    f"""WITH {TOKENS}, t AS (SELECT doc_id, pos, idx, replace(form, 'ß', 'ss') AS f, replace(reverse(term), 'ß', 'ss') AS t FROM tokens)
    SELECT doc_id, pos, idx, CASE WHEN upper(f) = f AND lower(f) <> f AND length(f) > 1 THEN upper(t) WHEN upper(left(f, 1)) = left(f, 1) AND lower(f) <> f THEN upper(left(t, 1)) || substr(t, 2) ELSE t END AS cased FROM t""",
)
def transferred_case(spark, folder):
    plain = lambda c: F.replace(c, F.lit("ß"), F.lit("ss"))
    return T.tokens(_docs(spark, folder)).select("doc_id", "pos", "idx", X.transfer_case(plain(F.col("form")), plain(F.reverse("term"))).alias("cased"))


@query(
    "t12_homoglyphs",
    f"""WITH {STATS} SELECT term, translate(term, 'aceopxyABCEHKMOPTX', 'асеорхуАВСЕНКМОРТХ') AS cyrillic, translate(translate(term, 'aceopxyABCEHKMOPTX', 'асеорхуАВСЕНКМОРТХ'), 'асеорхуАВСЕНКМОРТХ', 'aceopxyABCEHKMOPTX') AS latin, translate(term, 'IlOg', '1109') AS digits FROM stats""",
)
def homoglyphs(spark, folder):
    t = F.col("term")
    return _stats(spark, folder).select("term", X.to_cyrillic(t).alias("cyrillic"), X.to_latin(X.to_cyrillic(t)).alias("latin"), X.to_digits(t).alias("digits"))


@query(
    "t13_pattern",
    rf"""WITH {LINES} SELECT doc_id, pos, len(list_filter(regexp_extract_all(line, '[\p{{L}}\p{{N}}_]+'), lambda w: w = 'a')) AS words, len(regexp_extract_all(line, '^The')) AS starts FROM lines""",
)
def edit_patterns(spark, folder):
    word, start = X.edit_pattern(F.lit("a"), whole_word=True), X.edit_pattern(F.lit("The"), prefix=True)
    return _lines(spark, folder).select("doc_id", "pos", F.regexp_count("line", word).cast("long").alias("words"), F.regexp_count("line", start).cast("long").alias("starts"))


@query("t15_roman", f"""WITH {STATS} SELECT term FROM stats WHERE length(term) > 0 AND regexp_matches(term, '^(?i)m{{0,4}}(cm|cd|d?c{{0,3}})(xc|xl|l?x{{0,3}})(ix|iv|v?i{{0,3}})$')""")
def roman(spark, folder):
    return _stats(spark, folder).where(X.is_roman(F.col("term"))).select("term")


@query("t16_quotes")
def quotes(spark, folder):
    rows = _lines(spark, folder).select("doc_id", "pos", repair.normalized_quotes(F.replace("line", F.lit("!!"), F.lit('"'))).alias("q"))
    return rows.select("doc_id", "pos", "q.text", F.size("q.unresolved").alias("unresolved"))


@query(
    "t18_clean_wiki",
    r"""WITH w AS (SELECT item_id, '''''''' || left(text, 30) || ''''''' [[a b|' || substr(text, 31, 20) || ']] {{comment|kept|x}} {{gone}} <ref name="r">no</ref><ref n/> <b>' || substr(text, 51, 20) || '</b>  [[plain]]' AS t FROM benchmark)
    SELECT item_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?s)<ref[^>/]*/>|<ref[^>]*>.*?</ref>', '', 'g'),
    '\{\{comment\|([^|}]*)\|[^}]*\}\}', '\1', 'g'), '\{\{[^{}]*\}\}', '', 'g'), '\[\[(?:[^|\]]*\|)?([^\]]*)\]\]', '\1', 'g'), '<[^>]+>|''''''?', '', 'g'), '\s+', ' ', 'g')) AS clean FROM w""",
)
def clean_wiki(spark, folder):
    parts = ["'''", F.substring("text", 1, 30), "''' [[a b|", F.substring("text", 31, 20), ']] {{comment|kept|x}} {{gone}} <ref name="r">no</ref><ref n/> <b>', F.substring("text", 51, 20), "</b>  [[plain]]"]
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return T.table(spark, folder, "benchmark").select("item_id", X.clean_wiki(text).alias("clean"))


@query("t19_respelled")
def respelled(spark, folder):
    nations = T.table(spark, folder, "nation").select(F.lower("n_name").alias("term"))
    return nations.select("term", S.respelled("term", "term", F.concat(F.initcap("term"), F.lit("a (land)"))).alias("spelled"))


@query("t20_labels")
def labels(spark, folder):
    return _stats(spark, folder).select("term", S.edit_label("term", F.replace("term", F.lit("th"), F.lit("tb"))).alias("label"), S.diff_distance("term", F.replace("term", F.lit("th"), F.lit("tb"))).alias("distance"))


@query("t21_map_span")
def mapped_spans(spark, folder):
    rows = T.table(spark, folder, "benchmark").select("item_id", "text", F.regexp_replace("text", r"^\S+\s", "").alias("part"), F.regexp_instr("text", F.lit(r"\s\p{L}+\s")).alias("at"))
    word = F.regexp_extract("text", r"\s(\p{L}+)\s", 1)
    return rows.where("at > 0").select("item_id", S.map_span("text", "part", "at", F.col("at") + F.length(word)).alias("s")).select("item_id", "s.start", "s.stop")


@query("f10_meaning", f"""WITH {STATS} SELECT term, substr(term, 3) AS target, list_contains(list_transform(['a', 'un', 'non', 'in', 'im', 'ir'], lambda p: p || substr(term, 3)), term) AS sensitive FROM stats""")
def meaning(spark, folder):
    target = F.substr("term", F.lit(3))
    return _stats(spark, folder).select("term", target.alias("target"), X.meaning_sensitive(F.col("term"), target).alias("sensitive"))


@query(
    "f19_xml_safe",
    rf"""WITH {LINES}, p AS (SELECT doc_id, pos, replace(line, 'qu', chr(7) || chr(65534)) AS t FROM lines) SELECT doc_id, pos, regexp_replace(t, '[\x01-\x08\x0B\x0C\x0E-\x1F\x{{FFFE}}\x{{FFFF}}]', '�', 'g') AS safe, len(regexp_extract_all(t, '[\x01-\x08\x0B\x0C\x0E-\x1F\x{{FFFE}}\x{{FFFF}}]')) AS illegal FROM p""",
)
def xml_safe(spark, folder):
    rows = _lines(spark, folder).select("doc_id", "pos", F.replace("line", F.lit("qu"), F.lit("\x07\ufffe")).alias("t"))
    return rows.select("doc_id", "pos", X.xml_safe(F.col("t")).alias("safe"), F.size(X.illegal_points(F.col("t"))).cast("long").alias("illegal"))


@query(
    "a27_capitals",
    rf"""WITH {LINES} SELECT doc_id, pos, round(length(regexp_replace(line, '[^\p{{Lu}}]', '', 'g')) / nullif(length(regexp_replace(line, '[^\p{{L}}]', '', 'g')), 0)::DOUBLE, 6) AS share FROM lines""",
)
def capitals(spark, folder):
    return _lines(spark, folder).select("doc_id", "pos", F.round(X.letters_share(F.col("line"), "Lu"), 6).alias("share"))


@query(
    "glyph_cost",
    """WITH p AS (SELECT p_partkey, (p_partkey % 1000)::VARCHAR AS a, (p_partkey * 7 % 1000)::VARCHAR AS b FROM part)
    SELECT p_partkey, CASE WHEN length(a) <> length(b) THEN 2.0 ELSE list_sum(list_transform(range(1, length(a) + 1), lambda i: CASE WHEN substr(a, i, 1) = substr(b, i, 1) THEN 0.0
    WHEN list_contains(['68', '38', '56', '29', '17', '08', '86', '83', '65', '92', '71', '80'], substr(a, i, 1) || substr(b, i, 1)) THEN 0.5 ELSE 2.0 END))::DOUBLE END AS cost FROM p""",
)
def glyph_costs(spark, folder):
    number = lambda k: (F.col("p_partkey") * k % 1000).cast("string")
    return T.table(spark, folder, "part").select("p_partkey", X.glyph_cost(number(1), number(7)).alias("cost"))


@query(
    "quality_score",
    """WITH e AS (SELECT event_id, (event_id % 21) / 20.0::DOUBLE AS a, (event_id % 7) / 6.0::DOUBLE AS b, (event_id % 5) / 4.0::DOUBLE AS f FROM events)
    SELECT event_id, round_even(100 * (1 - greatest(greatest(0, (a - 0.5) / 0.5) * 1.0, greatest(0, (b - 0.5) / 0.5) * 0.7, 0)) * (0.7 + 0.3 * f), 0)::INT AS score FROM e""",
)
def quality_scores(spark, folder):
    share = lambda k: (F.col("event_id") % k) / F.lit(float(k - 1))
    return T.table(spark, folder, "events").select("event_id", X.quality_score({"omission": share(21), "addition": share(7)}, share(5)).alias("score"))


@query(
    "box_overlap",
    """WITH b AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey % 50 AS x0, l_suppkey % 40 AS y0, l_partkey % 50 + l_quantity AS x1, l_suppkey % 40 + 20 AS y1 FROM lineitem),
    m AS (SELECT a.o, a.n, b.n AS m, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS i, (a.x1 - a.x0) * (a.y1 - a.y0) AS p, (b.x1 - b.x0) * (b.y1 - b.y0) AS q FROM b a JOIN b ON a.o = b.o AND a.n < b.n)
    SELECT o, n, m, round(i / nullif(p + q - i, 0)::DOUBLE, 9) AS iou, round(i / nullif(least(p, q), 0)::DOUBLE, 9) AS inner_share FROM m""",
)
def box_overlap(spark, folder):
    box = T.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), (F.col("l_partkey") % 50).cast("double").alias("x0"), (F.col("l_suppkey") % 40).cast("double").alias("y0"),
        (F.col("l_partkey") % 50 + F.col("l_quantity")).cast("double").alias("x1"), (F.col("l_suppkey") % 40 + 20).cast("double").alias("y1"),
    )
    a, b = box.alias("a"), box.alias("b")
    met = a.join(b, (F.col("a.o") == F.col("b.o")) & (F.col("a.n") < F.col("b.n")))
    iou, inner = X.box_iou([F.col(f"a.{c}") for c in ("x0", "y0", "x1", "y1")], [F.col(f"b.{c}") for c in ("x0", "y0", "x1", "y1")])
    return met.select("a.o", "a.n", F.col("b.n").alias("m"), F.round(iou, 9).alias("iou"), F.round(inner, 9).alias("inner_share"))


@query("m13_punctuation")
def punctuation_repairs(spark, folder):
    w = F.col("line")
    rows = _lines(spark, folder).select(F.concat_ws(":", "doc_id", "pos").alias("row_id"), F.regexp_replace(w, r"\. ", ".: ").alias("text"), w.alias("cached"), w.alias("fresh"))
    return punctuation.repaired(rows, "cached", "fresh")
