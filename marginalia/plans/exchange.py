"""Queries over markup, and over source and target texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.functions import text as X
from marginalia.functions.similarity import seq_ratio
from marginalia.operators import codec, markup, statistics, translation, windows
from marginalia.plans.shared_sql import TOKENS, TURNS
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


def _pages(spark, folder):
    return T.table(spark, folder, "pages")


def _turns(spark, folder):
    return T.turns(T.table(spark, folder, "conversations"))


def _glossary(spark, folder):
    """Frequent words with a made-up rendering."""
    words = T.tokens(_docs(spark, folder)).where(F.length("term") >= 5).groupBy("term").agg(F.count("*").alias("n")).where("n >= 20")
    return words.select("term", F.concat("term", F.lit("ia")).alias("rendering"))


_GLOSSARY = f"""{TOKENS}, g AS (SELECT term, term || 'ia' AS rendering FROM tokens WHERE length(term) >= 5 GROUP BY term HAVING count(*) >= 20)"""


# ---- markup ----------------------------------------------------------------

_TAGS = ("h1", "h2", "h3", "li", "p", "title")
_ELEMENTS = " UNION ALL ".join(
    f"SELECT page_id, '{t}' AS tag, unnest(regexp_extract_all(html, '(?is)<{t}(?:\\s[^>]*)?>(.*?)</{t}>', 1)) AS b, generate_subscripts(regexp_extract_all(html, '(?is)<{t}(?:\\s[^>]*)?>(.*?)</{t}>', 1), 1)::INT - 1 AS seq FROM pages" for t in _TAGS
)


@query("h1_elements", f"""WITH e AS ({_ELEMENTS}) SELECT page_id, tag, seq, trim(regexp_replace(regexp_replace(b, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM e""")
def elements(spark, folder):
    return markup.blocks_by_pattern(_pages(spark, folder), _TAGS)


_HREF = r"""'(?is)<a\s(?:[^>]*\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1)"""


@query(
    "h3_links",
    rf"""WITH h AS (SELECT page_id, replace(html, '</p>', '<A class=x HREF = ''/single''>s</A><a href=/bare>b</a></p>') AS html FROM pages), p AS (SELECT page_id, unnest(regexp_extract_all(html, {_HREF}) AS raw, generate_subscripts(regexp_extract_all(html, {_HREF}, 1)::INT - 1 AS seq FROM h)
    SELECT page_id, seq, regexp_replace(raw, '^["'']|["'']$', '', 'g') AS href FROM p""",
)
def links(spark, folder):
    more = F.replace("html", F.lit("</p>"), F.lit("<A class=x HREF = '/single'>s</A><a href=/bare>b</a></p>"))
    return markup.links(_pages(spark, folder).select("page_id", more.alias("html")))


@query("s15_link_check", rf"""WITH p AS (SELECT unnest(regexp_extract_all(html, {_HREF}) AS raw FROM pages), l AS (SELECT regexp_replace(raw, '^["'']|["'']$', '', 'g') AS href FROM p) SELECT href, count(*) AS uses FROM l WHERE href NOT IN (SELECT url FROM pages) GROUP BY 1""")
def link_check(spark, folder):
    pages = _pages(spark, folder)
    return markup.broken_links(pages, pages.select(F.col("url").alias("href")))


@query(
    "f15_citation_cues",
    r"""WITH t AS (SELECT item_id, CASE item_id % 5 WHEN 0 THEN 'Smith, J. (1990). ' || text WHEN 1 THEN 'see pp. 12, ' || left(text, 20) WHEN 2 THEN text WHEN 3 THEN left(text, 20) || ', 1950, which he had not seen and they were there' ELSE 'https://example.org' END AS t FROM benchmark),
    c AS (SELECT item_id, trim(t) AS t, string_split_regex(trim(t), '[.;:()\[\]]\s|[;()\[\]]') AS cl FROM t),
    f AS (SELECT *, len(list_filter(cl, lambda c: len(regexp_extract_all(c, '[\p{L}\p{Nl}\p{No}]+')) >= 7 AND len(list_filter(regexp_extract_all(lower(c), '[\p{L}\p{Nl}\p{No}]+'), lambda w: list_contains(string_split('is was are were be been being that which who he she it they we i you his her its their our not but had has have would could should may might will does did this these those there', ' '), w))) >= 2)) > 0 AS commentary FROM c)
    SELECT item_id, regexp_matches(t, '^(?:[—–-]{2,}|\p{L}[\p{L}\p{N}_’''-]+,(?:\s+[A-Z]\.)+[\s,&]|.{0,120}\(\d{4}[a-z]?\)\.)') OR ((regexp_matches(t, '(?i)\bpp?\.\s*[\dxivlc]|\b(?:vols?|eds?|trans|repr|rev|chap|ch|fol|nos?)\.\s|\b(?:ibid|op\.\s*cit|loc\.\s*cit|et\s+al)\b|\b(?:press|university|verlag)\b|\(\s*(?:1[5-9]|20)\d\d[a-z]?\s*[,)]|[A-Z][a-z]+:\s+[A-Z][\w&]+.*\d{4}|,\s*\d+(?:[–-]\d+)?\.?$|\b[\dIVXLC]+:\d+\b|https?://|\bdoi\b')
    OR regexp_matches(t, '\b(?:1[5-9]|20)\d\d[a-z]?\b')) AND NOT commentary) AS cites FROM f""",
)
def citation_cues(spark, folder):
    kind, text = F.col("item_id") % 5, F.col("text")
    t = F.when(kind == 0, F.concat(F.lit("Smith, J. (1990). "), text)).when(kind == 1, F.concat(F.lit("see pp. 12, "), F.substring(text, 1, 20))).when(kind == 2, text)
    t = t.when(kind == 3, F.concat(F.substring(text, 1, 20), F.lit(", 1950, which he had not seen and they were there"))).otherwise("https://example.org")
    return T.table(spark, folder, "benchmark").select("item_id", markup.citation(t).alias("cites"))


@query("f15_citations")
def citations(spark, folder):
    return markup.apparatus(markup.blocks(_pages(spark, folder)))


@query("h4_bibliography")
def bibliography(spark, folder):
    blocks = markup.blocks(_pages(spark, folder))
    cited = blocks.where("tag = 'p'").withColumn("class", F.lit("reference")).withColumn("text", F.concat(F.lit("Smith, J. (1990). "), F.substring("text", 1, 20)))
    return markup.bibliography(cited.withColumn("page_id", F.col("page_id") % 20).withColumn("seq", F.col("seq")))


@query(
    "u5_json_diff",
    """WITH d AS (SELECT doc_id, lang, source, n_chars FROM documents) SELECT doc_id, 'meta.lang' AS path, '"' || lang || '"' AS before, '"xx"' AS "after" FROM d WHERE doc_id % 3 = 0 AND lang <> 'xx' UNION ALL SELECT doc_id, 'meta.n', n_chars::VARCHAR, NULL FROM d WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 'new', NULL, '1' FROM d WHERE doc_id % 2 = 0""",
)
def json_diff(spark, folder):
    docs = _docs(spark, folder)
    before = docs.select("doc_id", F.to_json(F.struct(F.struct("lang", F.col("n_chars").alias("n")).alias("meta"), "source")).alias("j"))
    even = F.col("doc_id") % 2 == 0
    meta = F.struct(F.when(F.col("doc_id") % 3 == 0, "xx").otherwise(F.col("lang")).alias("lang"), F.when(~even, F.col("n_chars")).alias("n"))
    after = docs.select("doc_id", F.to_json(F.struct(meta.alias("meta"), "source", F.when(even, 1).alias("new"))).alias("j"))
    return markup.structural_difference(before, after, "doc_id", "j")


@query(
    "u6_snapshot",
    """SELECT count(*) AS rows, sum(('0x' || substr(sha256(doc_id || chr(31) || text || chr(31) || lang || chr(31) || source || chr(31) || n_chars), 1, 15))::BIGINT)::VARCHAR AS digest FROM documents""",
)
def snapshot(spark, folder):
    return markup.snapshot(_docs(spark, folder), ["doc_id", "text", "lang", "source", "n_chars"])


@query("u6_members", """SELECT doc_id, sha256('{"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '"}') AS hash FROM documents""")
def members(spark, folder):
    return markup.member_hashes(_docs(spark, folder), "doc_id", ["source", "lang", "n_chars"])


def _shouted(text: str) -> str:
    """Stands for a model: upper case, markup as it is; drops one in five."""
    import re

    if len(text) % 5 == 0:
        text = re.sub(r"</?x1>", "", text, count=1)
    return "".join(p if p.startswith("<") else p.upper() for p in re.split(r"(<[^>]+>)", text))


@query("codec_translated")
def translated(spark, folder):
    texts = T.table(spark, folder, "benchmark").select("item_id", X.escape(F.substring("text", 1, 60)).alias("t"))
    plain = texts.where(~F.col("t").rlike("&[^;]*$")).select(F.col("item_id").cast("long").alias("block_id"), F.concat(F.lit("<p>"), F.regexp_replace(F.substring("t", 1, 20), "&[a-z]*;?", ""), F.lit('<em>word</em> <a href="#n1"><sup>3</sup></a> end<br/>more</p>')).alias("xml"))
    return codec.translated(plain, _shouted).select("block_id", "level", F.length("xml").alias("characters"))


# ---- flags and terms -------------------------------------------------------


@query(
    "f16_pair_flags",
    rf"""WITH {TURNS}, p AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(source, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS s, trim(regexp_replace(regexp_replace(target || CASE WHEN turn % 4 = 0 THEN ' the and of сloсk' ELSE '' END, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM turns),
    f AS (SELECT conv_id, turn, length(s) AS ls, length(t) / greatest(length(s), 1)::DOUBLE AS r, len(regexp_extract_all(s, '[.!?…]["”’»)\]]*(?:\s|$)')) AS es, len(regexp_extract_all(t, '[.!?…]["”’»)\]]*(?:\s|$)')) AS et, regexp_extract_all(t, '[\p{{L}}\p{{Nl}}\p{{No}}]+') AS w FROM p)
    SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN ls >= 80 AND r < 0.8 THEN 'short' END, CASE WHEN ls >= 80 AND r > 1.8 THEN 'long' END, CASE WHEN ls >= 80 AND et < es AND r < 0.9 THEN 'lost_sentence' END,
    CASE WHEN len(list_filter(w, lambda x: list_contains(['the', 'and', 'of', 'to', 'was', 'that', 'with', 'which', 'were', 'had', 'his', 'her', 'their', 'this', 'from'], lower(x)))) >= 3 THEN 'untranslated' END,
    CASE WHEN len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]') AND regexp_matches(x, '[^\x00-\x{{24F}}]'))) > 0 THEN 'mixed_script' END], lambda x: x IS NOT NULL), ',') AS flags FROM f""",
)
def pair_flags(spark, folder):
    target = F.concat("target", F.when(F.col("turn") % 4 == 0, " the and of сloсk").otherwise(""))
    return _turns(spark, folder).select("conv_id", "turn", F.array_join(translation.flags(F.col("source"), target, F.lit("ru")), ",").alias("flags"))


@query("f16_narrator")
def narrator(spark, folder):
    said = F.when(F.col("turn") % 4 == 0, "Я не видела его.").otherwise("Я видел её.")
    return _turns(spark, folder).select("conv_id", "turn", F.array_join(translation.flags(F.lit(""), said, F.lit("ru"), F.lit("male")), ",").alias("flags"), translation.first_person(said).alias("n")).select("conv_id", "turn", "flags", "n.masculine", "n.feminine")


@query(
    "f16_glossary_lines",
    f"""WITH {_GLOSSARY}, {TURNS}, m AS (SELECT conv_id, turn, term, rendering FROM turns, g WHERE regexp_matches(source, '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])' || term)) SELECT conv_id, turn, string_agg(term || ' = ' || rendering, chr(10) ORDER BY term || ' = ' || rendering) AS lines FROM m GROUP BY 1, 2""",
)
def glossary_lines(spark, folder):
    texts = _turns(spark, folder).select("conv_id", "turn", F.col("source").alias("text"))
    return translation.glossary_lines(texts, _glossary(spark, folder), ["conv_id", "turn"])


@query(
    "brief_lines",
    f"""WITH {_GLOSSARY}, {TURNS}, m AS (SELECT conv_id, turn, term || ' (' || CASE WHEN length(term) % 2 = 0 THEN 'man' ELSE 'woman' END || ')' AS w FROM turns, g WHERE regexp_matches(source, '(?:^|[^\\p{{L}}\\p{{N}}_])' || term || '(?:$|[^\\p{{L}}\\p{{N}}_])')), l AS (SELECT conv_id, turn, string_agg(w, ', ' ORDER BY w) AS w FROM m GROUP BY 1, 2)
    SELECT t.conv_id, t.turn, 'About the book: essay.' || coalesce(chr(10) || 'People in this passage: ' || w || '. Use the matching grammatical gender for each.', '') AS lines FROM turns t LEFT JOIN l USING (conv_id, turn)""",
)
def brief(spark, folder):
    texts = _turns(spark, folder).select("conv_id", "turn", F.col("source").alias("text"))
    people = _glossary(spark, folder).select(F.col("term").alias("name"), F.when(F.length("term") % 2 == 0, "male").otherwise("female").alias("gender"))
    return translation.brief_lines(texts, people, "essay", ["conv_id", "turn"])


@query("brief_excerpt", r"""WITH t AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) || chr(10) AS t FROM documents) SELECT left(string_agg(t, '' ORDER BY doc_id), 3000) AS excerpt FROM t""")
def excerpt(spark, folder):
    return translation.excerpt(_docs(spark, folder).select("doc_id", "text"), "doc_id")


@query("brief_names")
def names(spark, folder):
    docs = _docs(spark, folder).select("doc_id", F.regexp_replace("text", ", ", " Carlos "). alias("text"))
    found = translation.name_sentences(docs, docs.limit(1).select(F.lit("Carlos").alias("term")), "doc_id", 3)
    return found.select("term", F.size("sentences").alias("sentences"))


@query("f17_term_drift")
def drift(spark, folder):
    return translation.drift(_turns(spark, folder), _glossary(spark, folder), ["conv_id", "turn"])


@query("f17_variants")
def variants(spark, folder):
    return translation.term_variants(_turns(spark, folder), _glossary(spark, folder)).withColumn("forms", F.array_join("forms", ","))


def _attempts(spark, folder):
    """Three attempts at each answer, with their flags."""
    tries = F.array(*[F.struct(F.lit(k).alias("attempt"), F.expr(f"left(target, cast(length(target) * {s} as int))").alias("target")) for k, s in ((1, 0.5), (2, 0.9), (3, 1.0))])
    rows = _turns(spark, folder).select("conv_id", "turn", "source", F.explode(tries).alias("a")).select("conv_id", "turn", "source", "a.*")
    return rows.withColumn("flags", F.array_compact(F.array(F.when(F.length("target") < 0.8 * F.length("source"), "short"), F.when(F.length("target") > 1.8 * F.length("source"), "long"))))


_ATTEMPTS = f"""{TURNS}, a AS (SELECT conv_id, turn, source, unnest([1, 2, 3]) AS attempt, unnest([left(target, (length(target) * 0.5)::DOUBLE::INT), left(target, floor(length(target) * 0.9)::INT), target]) AS target FROM turns),
f AS (SELECT *, (length(target) < 0.8 * length(source))::INT + (length(target) > 1.8 * length(source))::INT AS n FROM a)"""


@query("fewest_flags", f"""WITH {_ATTEMPTS.replace("(length(target) * 0.5)::DOUBLE::INT", "floor(length(target) * 0.5)::INT")} SELECT conv_id, turn, attempt, target FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY n, attempt) AS k FROM f) WHERE k = 1""")
def fewest_flags(spark, folder):
    return translation.fewest_flags(_attempts(spark, folder), ["conv_id", "turn"])


@query(
    "f18_accepted",
    """SELECT event_id, event_id % 4 < event_id % 3 OR (event_id % 3 = 0 AND event_id % 4 = 0) AS edit, CASE WHEN event_id % 5 IS NULL THEN false ELSE event_id % 11 > event_id % 7 AND event_id % 4 <= event_id % 3 END AS review FROM events""",
)
def accepted(spark, folder):
    flags = lambda k: F.array_repeat(F.lit("x"), (F.col("event_id") % k).cast("int"))
    rows = T.table(spark, folder, "events").select("event_id", flags(3).alias("flags"), flags(4).alias("new_flags"), (F.col("event_id") % 7).alias("score"), (F.col("event_id") % 11).alias("new_score"))
    return translation.reviewed(rows).select("event_id", translation.accepted_edit(F.col("flags"), F.col("new_flags")).alias("edit"), F.col("accepted").alias("review"))


_GREEDY = """WITH RECURSIVE t AS (SELECT conv_id, turn, length(text) AS s, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
r(conv_id, k, chunk, used, held) AS (SELECT conv_id, k, 0::BIGINT, s::BIGINT, 1 FROM t WHERE k = 1 UNION ALL SELECT t.conv_id, t.k, r.chunk + (r.used + t.s > {limit} OR r.held >= {most})::BIGINT, CASE WHEN r.used + t.s > {limit} OR r.held >= {most} THEN t.s ELSE r.used + t.s END, CASE WHEN r.used + t.s > {limit} OR r.held >= {most} THEN 1 ELSE r.held + 1 END FROM r JOIN t ON t.conv_id = r.conv_id AND t.k = r.k + 1)
SELECT r.conv_id, t.turn, r.chunk FROM r JOIN t ON t.conv_id = r.conv_id AND t.k = r.k"""


@query("w20_chunks", _GREEDY.format(limit=800, most=1_000_000))
def chunks(spark, folder):
    return windows.greedy_chunks(T.table(spark, folder, "conversations"), "conv_id", "turn", F.length("text"), 800)


@query("judge_batches", _GREEDY.format(limit=4000, most=3))
def judge_batches(spark, folder):
    return translation.batches(T.table(spark, folder, "conversations"), "conv_id", "turn", F.length("text"), 4000, 3)


@query("verified_spellings")
def verified(spark, folder):
    k = T.table(spark, folder, "nation").select(F.initcap(F.lower("n_name")).alias("term"), F.col("n_nationkey").alias("k"))
    glossary = k.select("term", F.concat("term", F.lit("ia")).alias("rendering")).unionByName(k.select(F.concat("term", F.lit("s")).alias("term"), F.concat("term", F.lit("ians")).alias("rendering")))
    pages = k.select(F.col("term").alias("title"), F.concat("term", F.lit("ya (land)")).alias("target_title"), F.lit(False).alias("disambiguation"))
    return translation.verified_spellings(glossary, k.limit(0).select(F.col("term").alias("source"), F.col("term").alias("target")), pages)


@query(
    "k8_established",
    """WITH q AS (SELECT item_id, left(text, 40) AS quote FROM benchmark), o AS (SELECT q.item_id, quote, doc_id AS seq, left(text, 20 + (doc_id % 60)::INT) AS o FROM q JOIN documents ON doc_id % 13 = item_id % 13), f AS (SELECT * FROM o WHERE length(o) BETWEEN 0.4 * length(quote) AND 3 * length(quote) + 40)
    SELECT item_id AS quote_id, o AS option FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY length(o) DESC, seq) AS k FROM f) WHERE k = 1""",
)
def established(spark, folder):
    quotes = T.table(spark, folder, "benchmark").select(F.col("item_id").alias("quote_id"), F.substring("text", 1, 40).alias("quote"))
    texts = _docs(spark, folder).select((F.col("doc_id") % 13).alias("m"), F.col("doc_id").alias("seq"), F.expr("left(text, 20 + cast(doc_id % 60 as int))").alias("option"))
    options = quotes.withColumn("m", F.col("quote_id") % 13).join(texts, "m").select("quote_id", "seq", "option")

    def longest(quote: str, found: list[str]) -> int | None:
        return max(range(len(found)), key=lambda i: (len(found[i]), -i), default=None)

    return translation.established(quotes, options, longest, most=7)


@query("aligned_pairs")
def aligned_pairs(spark, folder):
    source = markup.blocks(_pages(spark, folder)).select("page_id", "seq", "tag", "text")
    target = source.withColumn("text", F.upper("text"))
    return translation.aligned_pairs(source, target, "page_id").select("page_id", "seq", F.round(seq_ratio("source", F.lower("target")), 6).alias("ratio"))


@query(
    "a26_glossary_terms",
    f"""WITH {TOKENS} SELECT term, arg_min(form, (doc_id, pos, idx)) AS form, count(*) AS count, count(*) FILTER (idx > 0) AS "inner" FROM tokens
    GROUP BY term HAVING count(*) >= 2 AND count(*) FILTER (form = term) = 0 AND count(*) FILTER (idx > 0) > 0""",
)
def glossary_terms(spark, folder):
    return statistics.glossary(T.tokens(_docs(spark, folder)), 2)
