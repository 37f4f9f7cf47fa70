"""Queries over texts: terms, lexicon, lines, layout, markup, translation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.functions import text as X
from marginalia.operators import evaluation, joins, layout, lexicon, markup, reconcile, statistics, translation, windows
from marginalia.plans.shared_sql import LINES, NEAR, SPANS, STATS, TOKENS, TURNS
from marginalia.sources import tables as T

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return T.table(spark, folder, "documents")


def _stats(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.collection_stats(_docs(spark, folder))


@query(
    "a1_term_stats",
    f"""WITH {STATS}, c AS (SELECT term, source, count(*) AS n FROM tokens GROUP BY 1, 2),
    x AS (SELECT term, max(n) AS m FROM c GROUP BY 1), k AS (SELECT count(DISTINCT source) AS n FROM tokens)
    SELECT s.*, round(ln((k.n + 1.0) / (chapter_df + 1)) + 1, 6) AS idf,
    round((1 + ln(m)) * (ln((k.n + 1.0) / (chapter_df + 1)) + 1), 6) AS max_tfidf FROM stats s JOIN x USING (term), k""",
)
def term_stats(spark, folder):
    return _stats(spark, folder)


@query(
    "a1_enrichment",
    f"""WITH {TOKENS}, c AS (SELECT lang, term, count(*) AS n FROM tokens GROUP BY 1, 2), g AS (SELECT lang, sum(n) AS gt FROM c GROUP BY 1),
    e AS (SELECT term, sum(n) AS ev FROM c GROUP BY 1), t AS (SELECT sum(n) AS total FROM c)
    SELECT lang, term, n AS count, round(log10((n + 0.5) / (gt * coalesce((ev - n) / nullif(total - gt, 0)::DOUBLE, 0) + 0.5)), 6) AS log10_enrichment
    FROM c JOIN g USING (lang) JOIN e USING (term), t""",
)
def enrichment(spark, folder):
    return statistics.enrichment(T.tokens(_docs(spark, folder)), "lang")


@query(
    "a15_bigrams",
    f"""WITH {TOKENS}, p AS (SELECT source, term AS "left", lead(term) OVER (PARTITION BY doc_id, pos ORDER BY idx) AS "right" FROM tokens)
    SELECT source, "left", "right", count(*) AS n FROM p WHERE "right" IS NOT NULL GROUP BY 1, 2, 3""",
)
def bigrams(spark, folder):
    return statistics.grams(T.tokens(_docs(spark, folder)), ["doc_id", "pos"], "idx")


@query(
    "a15_skips",
    f"""WITH {TOKENS}, p AS (SELECT source, term AS "left", lead(term, 2) OVER (PARTITION BY doc_id, pos ORDER BY idx) AS "right" FROM tokens)
    SELECT source, "left", "right", count(*) AS n FROM p WHERE "right" IS NOT NULL GROUP BY 1, 2, 3""",
)
def skips(spark, folder):
    return statistics.grams(T.tokens(_docs(spark, folder)), ["doc_id", "pos"], "idx", 2)


@query(
    "a16_char_model",
    f"""WITH {STATS}, p AS (SELECT term, count, '^^' || term || '$' AS p FROM stats),
    g AS (SELECT term, count, unnest(list_transform(range(1, length(p) - 1), lambda i: substr(p, i, 3))) AS gram FROM p),
    n AS (SELECT gram, sum(count) AS n FROM g GROUP BY 1), c AS (SELECT substr(gram, 1, 2) AS ctx, sum(n) AS total FROM n GROUP BY 1),
    a AS (SELECT count(DISTINCT substr(gram, 3, 1)) + 1 AS k FROM n),
    m AS (SELECT gram, ln((n + 1) / (total + k)) AS lp FROM n JOIN c ON substr(gram, 1, 2) = ctx, a)
    SELECT term, round(sum(lp) / (length(term) + 1), 6) AS score FROM g JOIN m USING (gram) GROUP BY term""",
)
def char_model(spark, folder):
    return statistics.char_model(_stats(spark, folder).select("term", "count"))


@query(
    "a26_glossary",
    f"""WITH {TOKENS} SELECT term, arg_min(form, (doc_id, pos, idx)) AS form, count(*) AS count, count(*) FILTER (idx > 0) AS "inner" FROM tokens
    GROUP BY term HAVING count(*) >= 3 AND count(*) FILTER (form = term) = 0 AND count(*) FILTER (idx > 0) > 0""",
)
def glossary(spark, folder):
    return statistics.glossary(T.tokens(_docs(spark, folder)))


@query(
    "f3_detector",
    f"""WITH {STATS}, k AS (SELECT term FROM stats WHERE page_df >= 5), p AS (SELECT term FROM stats WHERE chapter_df >= 15),
    h AS (SELECT s.term, bool_and(q.part IN (SELECT term FROM k) OR q.part IN (SELECT term FROM p)) AS whole
          FROM stats s, unnest(string_split(s.term, '-')) AS q(part) WHERE contains(s.term, '-') GROUP BY 1)
    SELECT s.term, CASE WHEN length(s.term) < 4 THEN 'short-token' WHEN s.term IN (SELECT term FROM p) THEN 'protected'
    WHEN s.term IN (SELECT term FROM k) THEN 'dictionary-known' WHEN coalesce(h.whole, false) THEN 'known-hyphen-parts' END AS reason
    FROM stats s LEFT JOIN h ON s.term = h.term""",
)
def detector(spark, folder):
    stats = _stats(spark, folder)
    return lexicon.detect(stats.select("term"), stats.where("page_df >= 5"), stats.where("chapter_df >= 15"))


@query(
    "j15_variants",
    f"""WITH {STATS}, pool AS (SELECT term, count FROM stats WHERE length(term) >= 4), {NEAR},
    s AS (SELECT n.term, suggestion, suggestion_count, row_number() OVER (PARTITION BY n.term ORDER BY suggestion_count DESC, suggestion) AS rank
    FROM near n JOIN pool p ON n.term = p.term WHERE suggestion_count >= 3 AND suggestion_count >= 3 * p.count) SELECT * FROM s WHERE rank <= 5""",
)
def variants(spark, folder):
    return lexicon.variants(_stats(spark, folder))


_CONF = """CASE WHEN length(term) = length(suggestion) AND length(term) > 0 AND len(d) = 1 AND
  array_to_string(list_sort([substr(term, d[1], 1), substr(suggestion, d[1], 1)]), '') IN ('ce','ft','it','il','bh','nr') THEN 2.0 ELSE 0.0 END"""


@query(
    "review_queue",
    f"""WITH {STATS}, k AS (SELECT term FROM stats WHERE page_df >= 3), pool AS (SELECT term, count FROM stats), {NEAR},
    h AS (SELECT s.term, bool_and(q.part IN (SELECT term FROM k)) AS whole FROM stats s, unnest(string_split(s.term, '-')) AS q(part) WHERE contains(s.term, '-') GROUP BY 1),
    surfaced AS (SELECT s.term, s.count FROM stats s LEFT JOIN h ON s.term = h.term WHERE length(s.term) >= 4 AND s.term NOT IN (SELECT term FROM k) AND NOT coalesce(h.whole, false)),
    c AS (SELECT n.term, q.count, n.suggestion, n.suggestion_count, list_filter(range(1, length(n.term) + 1), lambda i: substr(n.term, i, 1) <> substr(n.suggestion, i, 1)) AS d
          FROM near n JOIN surfaced q ON n.term = q.term WHERE n.suggestion IN (SELECT term FROM k)),
    r AS (SELECT term, count, suggestion, round(ln(greatest(suggestion_count, 1)) - 2 + {_CONF}, 6) AS score FROM c)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY score DESC, suggestion) AS rank FROM r) WHERE rank <= 5""",
)
def review_queue(spark, folder):
    return lexicon.review_queue(_stats(spark, folder))


def _spread(terms, count):
    """A table of terms as a broadcast side where their estimated number has a
    bound of some ten MB, else as it is."""
    return F.broadcast(terms) if count <= 400_000 else terms


@query(
    "m1_transition",
    f"""WITH {TOKENS}, q AS (SELECT source, term AS l, lead(term) OVER (PARTITION BY doc_id, pos ORDER BY idx) AS r FROM tokens),
    b AS (SELECT source, l, r, count(*) AS n FROM q WHERE r IS NOT NULL GROUP BY 1, 2, 3), o AS (SELECT source, l, sum(n) AS o FROM b GROUP BY 1, 2),
    g AS (SELECT l, r, sum(n) AS gn FROM b GROUP BY 1, 2), go AS (SELECT l, sum(gn) AS gout FROM g GROUP BY 1),
    z AS (SELECT term AS r, count(*)::DOUBLE / (SELECT count(*) FROM tokens) AS p FROM tokens GROUP BY 1)
    SELECT source, l AS "left", r AS "right", round((n + 10 * (0.9 * gn / (gout + 1) + 0.1 * p)) / (o + 10), 9) AS p
    FROM b JOIN o USING (source, l) JOIN g USING (l, r) JOIN go USING (l) JOIN z USING (r)""",
)
def transition(spark, folder):
    docs = _docs(spark, folder)
    tokens = T.tokens(docs)
    total, terms = tokens.agg(F.count("*"), F.approx_count_distinct("term", 0.02)).first()
    zipf = tokens.groupBy("term").agg((F.count("*") / F.lit(float(total))).alias("p"))
    # pairs are dealt by both words, so that the sums over sources find them in place
    pairs = T.pairs(docs).select("source", "left", "right")
    counted = pairs.repartition("left", "right").groupBy("source", "left", "right").agg(F.count("*").alias("n"))
    return lexicon.transitions(counted, _spread(zipf, terms), pairs.groupBy("source", "left").agg(F.count("*").alias("out")))



@query(
    "m4_leave_one_out",
    f"""WITH {TOKENS}, q AS (SELECT doc_id, term AS l, lead(term) OVER (PARTITION BY doc_id, pos ORDER BY idx) AS r FROM tokens),
    b AS (SELECT doc_id, l, r, count(*) AS n FROM q WHERE r IS NOT NULL GROUP BY 1, 2, 3), o AS (SELECT doc_id, l, sum(n) AS o FROM b GROUP BY 1, 2),
    g AS (SELECT l, r, sum(n) AS gn FROM b GROUP BY 1, 2), go AS (SELECT l, sum(gn) AS gout FROM g GROUP BY 1)
    SELECT doc_id, l AS "left", r AS "right", round((gn - n + 0.5) / (gout - o + 1), 9) AS p
    FROM b JOIN o USING (doc_id, l) JOIN g USING (l, r) JOIN go USING (l)""",
)
def leave_one_out(spark, folder):
    docs = _docs(spark, folder)
    pairs = T.pairs(docs)
    # texts are dealt by document, not words: counts within a document stay in place
    own = T.pairs(docs.select("doc_id", "source", "lang", "text").repartition("doc_id")).groupBy("doc_id", "left", "right").agg(F.count("*").alias("n"))
    own = own.withColumn("o", F.sum("n").over(Window.partitionBy("doc_id", "left")))
    gout = pairs.groupBy("left").agg(F.count("*").alias("gout"))
    terms = pairs.agg(F.approx_count_distinct("left", 0.02)).first()[0]
    joined = own.withColumn("gn", F.sum("n").over(Window.partitionBy("left", "right"))).join(_spread(gout, terms), "left")
    return joined.select("doc_id", "left", "right", F.round((F.col("gn") - F.col("n") + 0.5) / (F.col("gout") - F.col("o") + 1), 9).alias("p"))


@query(
    "f7_digit_in_word",
    f"""WITH {LINES} SELECT doc_id, pos, unnest(regexp_extract_all(replace(line, 'eri', 'er1i'), '\\p{{L}}{{2,}}[0-9]\\p{{L}}{{2,}}')) AS hit FROM lines""",
)
def digit_in_word(spark, folder):
    found = F.regexp_extract_all(F.replace("line", F.lit("eri"), F.lit("er1i")), F.lit(r"(\p{L}{2,}[0-9]\p{L}{2,})"), 1)
    return T.lines(_docs(spark, folder)).select("doc_id", "pos", F.explode(found).alias("hit"))



@query(
    "t9_signatures",
    f"""WITH {LINES} SELECT trim(regexp_replace(upper(replace(line, 'ß', 'ss')), '[^\\p{{L}}]+', ' ', 'g')) AS signature, count(DISTINCT doc_id) AS pages, count(*) AS rows
    FROM lines GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3 AND signature <> ''""",
)
def signatures(spark, folder):
    rows = T.lines(_docs(spark, folder)).withColumn("signature", X.signature(F.col("line"))).where("signature <> ''")
    return rows.groupBy("signature").agg(F.count_distinct("doc_id").alias("pages"), F.count("*").alias("rows")).where("pages >= 3")



@query("m14_clusters")
def clusters(spark, folder):
    rows = T.lines(_docs(spark, folder)).where("pos = 0").select("source", F.col("doc_id").alias("page"), F.col("line").alias("text"))
    return layout.clustered_margins(rows, "source")


@query(
    "s10_window",
    f"""WITH {SPANS} SELECT doc_id, pos, start, start + length(line) AS stop FROM spans WHERE start + length(line) > 200 AND start < 600""",
)
def window(spark, folder):
    return T.line_spans(_docs(spark, folder)).where("stop > 200 and start < 600").select("doc_id", "pos", "start", "stop")


@query(
    "s14_plain_text",
    f"""WITH {LINES} SELECT doc_id, string_agg(trim(line), chr(10) || chr(10) ORDER BY pos) AS body FROM lines GROUP BY doc_id""",
)
def plain_text(spark, folder):
    rows = T.lines(_docs(spark, folder)).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.trim("line").alias("t")))).alias("r"))
    return rows.select("doc_id", F.array_join(F.transform("r", lambda r: r["t"]), "\n\n").alias("body"))


@query(
    "s19_stratified",
    """SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents)
    WHERE k = 1 OR k = n OR k = n // 2 + 1""",
)
def stratified(spark, folder):
    return windows.stratified(_docs(spark, folder).select("doc_id", "lang"), "lang", "doc_id")


@query(
    "j4_interval",
    f"""WITH {SPANS}, c AS (SELECT doc_id, unnest(range(0, length(text), 80)) AS start, length(text) AS n FROM documents),
    w AS (SELECT doc_id, start, least(start + 80, n) AS stop FROM c), m AS (SELECT w.doc_id, w.start, w.stop, s.pos FROM w JOIN spans s ON w.doc_id = s.doc_id
    AND s.start <= w.start AND s.start + length(s.line) >= w.stop) SELECT doc_id, start, stop, min(pos) AS pos FROM m GROUP BY 1, 2, 3 HAVING count(*) = 1""",
)
def interval(spark, folder):
    docs = _docs(spark, folder)
    n = F.length("text")
    cut = docs.where(n > 0).select("doc_id", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1, F.lit(80))).alias("start"))
    spans = cut.select("doc_id", F.col("start").cast("long").alias("start"), F.least(F.col("start") + 80, "n").cast("long").alias("stop"))
    met = joins.within(spans, T.line_spans(docs).select("doc_id", "pos", "start", "stop"), "doc_id")
    return met.groupBy(F.col("a.doc_id"), F.col("a.start"), F.col("a.stop")).agg(F.min("b.pos").alias("pos"), F.count("*").alias("n")).where("n = 1").drop("n")


@query(
    "j4_overlap",
    f"""WITH {SPANS}, w AS (SELECT doc_id, unnest(range(0, length(text), 300)) AS start FROM documents)
    SELECT w.doc_id, w.start, count(*) AS lines FROM w JOIN spans s ON w.doc_id = s.doc_id AND s.start + length(s.line) > w.start AND s.start < w.start + 300 GROUP BY 1, 2""",
)
def overlap(spark, folder):
    docs = _docs(spark, folder)
    n = F.length("text")
    cut = docs.where(n > 0).select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1, F.lit(300).cast("long"))).alias("start"))
    met = joins.overlapping(cut.withColumn("stop", F.col("start") + 300), T.line_spans(docs).select("doc_id", "pos", "start", "stop"), "doc_id")
    return met.groupBy(F.col("a.doc_id"), F.col("a.start")).agg(F.count("*").alias("lines"))


_READ = """reads AS (SELECT doc_id, pos, line AS primary_, replace(line, 'nd', 'ncl') AS embedded, replace(line, 'th', 'tb') AS vision, replace(line, 'th', 'tb') AS rapid FROM lines)"""


def _readings(docs: DataFrame) -> DataFrame:
    """Lines with three deterministic, perturbed readings."""
    rows = T.lines(docs)
    return rows.select(
        "doc_id",
        "pos",
        F.concat_ws(":", "doc_id", "pos").alias("row_id"),
        F.col("line").alias("text"),
        F.replace("line", F.lit("nd"), F.lit("ncl")).alias("embedded"),
        F.replace("line", F.lit("th"), F.lit("tb")).alias("vision"),
        F.replace("line", F.lit("th"), F.lit("tb")).alias("rapid"),
    )


@query(
    "a2_votes",
    f"""WITH {LINES}, {_READ}, w AS (SELECT doc_id || ':' || pos AS row_id, string_split(primary_, ' ') AS own, unnest(['embedded', 'vision', 'rapid']) AS engine,
    unnest([string_split(embedded, ' '), string_split(vision, ' '), string_split(rapid, ' ')]) AS t FROM reads),
    p AS (SELECT row_id, engine, unnest(range(0, len(own))) AS idx, unnest(own) AS before, unnest(t) AS "after" FROM w WHERE len(own) = len(t))
    SELECT row_id, idx::INT AS idx, before, "after", count(DISTINCT engine) AS votes FROM p WHERE before <> "after" GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT engine) >= 2""",
)
def votes(spark, folder):
    return reconcile.votes(_readings(_docs(spark, folder)), ["embedded", "vision", "rapid"])


_SQUASH = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"


@query(
    "a3_consensus",
    f"""WITH {LINES}, {_READ}, s AS (SELECT doc_id, pos, list_distinct(list_filter([{_SQUASH.format("embedded")}, {_SQUASH.format("vision")}, {_SQUASH.format("rapid")}], lambda t: t <> '')) AS p FROM reads)
    SELECT doc_id, pos, CASE WHEN len(p) = 1 THEN p[1] END AS agreed FROM s""",
)
def consensus(spark, folder):
    return reconcile.consensus(_readings(_docs(spark, folder)), ["embedded", "vision", "rapid"]).select("doc_id", "pos", "agreed")


_CMP = r"regexp_extract_all(lower(translate({}, '’', '''')), '[\p{{L}}\p{{N}}_]+(?:[''-][\p{{L}}\p{{N}}_]+)*')"


@query(
    "f5_tier",
    f"""WITH {LINES}, {_READ}, t AS (SELECT doc_id, pos, {_CMP.format("primary_")} AS p, {_CMP.format("embedded")} AS e, {_CMP.format("vision")} AS v, {_CMP.format("rapid")} AS r FROM reads)
    SELECT doc_id, pos, CASE WHEN len(p) > 0 AND len(v) > 0 AND len(r) > 0 AND v = r AND v <> p THEN CASE WHEN e = v THEN 'three-peer-consensus' ELSE 'fresh-peer-consensus' END ELSE 'other' END AS tier FROM t""",
)
def tiers(spark, folder):
    rows = _readings(_docs(spark, folder))
    return rows.select("doc_id", "pos", reconcile.tier(*(F.col(c) for c in ("text", "embedded", "vision", "rapid"))).alias("tier"))


@query(
    "a20_attested",
    f"""WITH {TOKENS}, g AS (SELECT doc_id, sha256(text) AS group_id FROM documents), z AS (SELECT group_id, count(*) AS e FROM g GROUP BY 1 HAVING count(*) >= 2),
    s AS (SELECT group_id, term, count(DISTINCT doc_id) AS r FROM tokens JOIN g USING (doc_id) GROUP BY 1, 2),
    p AS (SELECT term, count(*) AS pages FROM s JOIN z USING (group_id) WHERE r = e GROUP BY 1 HAVING count(*) >= 2) SELECT term, pages, pages - 1 AS others FROM p""",
)
def attested(spark, folder):
    docs = _docs(spark, folder)
    return reconcile.attested(T.tokens(docs), docs.select("doc_id", F.sha2("text", 256).alias("group_id")))



@query(
    "a6_correction",
    f"""WITH {TOKENS}, u AS (SELECT source, replace(term, 'th', 'tb') AS before, term AS truth, replace(replace(term, 'th', 'tb'), 'tbe', 'the') AS output FROM tokens),
    a AS (SELECT source, count(*) FILTER (before <> output) AS changed, count(*) FILTER (before <> truth AND output = truth) AS resolved,
    count(*) FILTER (before = truth AND output <> truth) AS damaged, count(*) FILTER (before <> truth AND before <> output AND output <> truth) AS wrong_on_error,
    count(*) FILTER (before <> output AND output = truth) AS good, count(*) FILTER (before <> truth) AS err, count(*) FILTER (before = truth) AS ok FROM u GROUP BY 1)
    SELECT source, changed, resolved, damaged, wrong_on_error, round(good / nullif(changed, 0)::DOUBLE, 6) AS exact_precision, round(resolved / nullif(err, 0)::DOUBLE, 6) AS resolution_recall,
    round(damaged / nullif(ok, 0)::DOUBLE, 6) AS damage_rate, resolved - damaged AS net FROM a""",
)
def correction(spark, folder):
    before = F.replace("term", F.lit("th"), F.lit("tb"))
    units = T.tokens(_docs(spark, folder)).select("source", before.alias("before"), F.col("term").alias("truth"), F.replace(before, F.lit("tbe"), F.lit("the")).alias("output"))
    return evaluation.correction(units, "source")


@query(
    "a5_recall_at_k",
    f"""WITH {STATS}, t AS (SELECT term, count, chapter_df, row_number() OVER (PARTITION BY substr(term, 1, 3) ORDER BY count DESC, term) AS k FROM stats WHERE length(term) >= 5),
    c AS (SELECT substr(term, 1, 3) AS p, list(term ORDER BY k) AS cands FROM t WHERE k <= 8 GROUP BY 1),
    u AS (SELECT s.term AS truth, s.page_df >= 2 AS detected, c.cands, length(s.term) % 2 AS g FROM stats s JOIN c ON substr(s.term, 1, 3) = c.p WHERE length(s.term) >= 5)
    SELECT g, count(*) AS errors, count(*) FILTER (detected) AS detected, round(count(*) FILTER (detected AND list_contains(cands, truth)) / count(*)::DOUBLE, 6) AS pool_recall,
    round(count(*) FILTER (detected AND list_contains(cands, truth)) / nullif(count(*) FILTER (detected), 0)::DOUBLE, 6) AS conditional_recall,
    round(count(*) FILTER (detected AND list_contains(cands[1:1], truth)) / count(*)::DOUBLE, 6) AS recall_at_1,
    round(count(*) FILTER (detected AND list_contains(cands[1:3], truth)) / count(*)::DOUBLE, 6) AS recall_at_3,
    round(count(*) FILTER (detected AND list_contains(cands[1:5], truth)) / count(*)::DOUBLE, 6) AS recall_at_5,
    round(avg(CASE WHEN detected THEN len(cands) END), 6) AS mean_proposals FROM u GROUP BY g""",
)
def recall_at_k(spark, folder):
    stats = _stats(spark, folder).where("length(term) >= 5").select("term", "count", "page_df", F.substring("term", 1, 3).alias("p"))
    order = Window.partitionBy("p").orderBy(F.desc("count"), "term")
    top = stats.withColumn("k", F.row_number().over(order)).where("k <= 8").groupBy("p").agg(F.array_sort(F.collect_list(F.struct("k", "term"))).alias("c"))
    units = stats.join(top, "p").select(
        (F.length("term") % 2).cast("long").alias("g"), F.col("term").alias("truth"), (F.col("page_df") >= 2).alias("detected"), F.transform("c", lambda x: x["term"]).alias("candidates")
    )
    return evaluation.candidate_recall(units, "g")


@query(
    "w5_paragraphs",
    f"""WITH {LINES}, b AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM lines),
    s AS (SELECT doc_id, pos, CASE WHEN before IS NULL OR trim(before) = '' OR length(before) < 0.5 * length(line) OR regexp_matches(line, '^\\s{{2,}}\\S') THEN 1 ELSE 0 END AS n FROM b)
    SELECT doc_id, pos, sum(n) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS block FROM s""",
)
def paragraphs(spark, folder):
    return layout.paragraphs(T.lines(_docs(spark, folder))).select("doc_id", "pos", "block")


@query(
    "w5_stitching",
    """WITH b AS (SELECT source, doc_id, lag(rtrim(text)) OVER (PARTITION BY source ORDER BY doc_id) AS p FROM documents),
    s AS (SELECT source, doc_id, CASE WHEN p IS NOT NULL AND NOT regexp_matches(p, '[.!?]$') THEN 0 ELSE 1 END AS n FROM b)
    SELECT source, doc_id, sum(n) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS run FROM s""",
)
def stitching(spark, folder):
    return layout.stitched(_docs(spark, folder).select("source", "doc_id", "text")).select("source", "doc_id", "run")


@query(
    "w6_line_joins",
    f"""WITH {LINES}, b AS (SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS nx FROM lines)
    SELECT doc_id, pos, CASE WHEN nx IS NULL THEN 'end' WHEN ends_with(line, chr(173)) THEN 'removed' WHEN regexp_matches(line, '\\p{{L}}-$') AND regexp_matches(nx, '^\\p{{Ll}}') THEN 'retained' ELSE 'space' END AS policy FROM b""",
)
def line_joins(spark, folder):
    return layout.joined_lines(T.lines(_docs(spark, folder)))


@query(
    "w15_forward_split",
    """WITH p AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY source) AS n FROM documents)
    SELECT source, doc_id, k <= greatest(1, (n + 4) // 5) AS seed FROM p""",
)
def forward_split(spark, folder):
    return windows.forward_split(_docs(spark, folder).select("source", "doc_id"), "source", "doc_id").select("source", "doc_id", "seed")



@query(
    "w18_context",
    """WITH u AS (SELECT conv_id, turn, length(text) AS s, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS u FROM conversations)
    SELECT a.conv_id, a.turn, count(b.turn) AS context_rows FROM u a LEFT JOIN u b ON a.conv_id = b.conv_id AND b.turn < a.turn AND (a.u - a.s) - (b.u - b.s) <= 1500 GROUP BY 1, 2""",
)
def context(spark, folder):
    rows = T.table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return windows.recent(rows, "conv_id", "turn", F.length("text").cast("long"), 1500).select("conv_id", "turn", F.col("context_rows").cast("long").alias("context_rows"))



@query("w1_merge_rows")
def merge_rows(spark, folder):
    rows = T.geometry(T.lines(_docs(spark, folder)))
    halves = rows.select(
        F.col("doc_id").alias("page"), F.lit(0).alias("col"), "y0", "y1", F.explode(F.array(F.struct(F.lit(0).alias("h"), F.expr("left(line, length(line) div 2)").alias("t")), F.struct(F.lit(1).alias("h"), F.expr("substr(line, length(line) div 2 + 1)").alias("t")))).alias("p")
    )
    pieces = halves.select("page", "col", (F.lit(0.1) + 0.4 * F.col("p.h")).alias("x0"), "y0", (F.lit(0.5) + 0.4 * F.col("p.h")).alias("x1"), "y1", F.col("p.t").alias("text"), F.lit(0.9).alias("confidence"))
    return layout.merge_rows(pieces)




@query(
    "a14_theil_sen",
    f"""WITH {LINES}, r AS (SELECT doc_id, pos AS x, length(line) AS y, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM lines)
    SELECT a.doc_id, round(median((b.y - a.y) / (b.x - a.x)::DOUBLE), 6) AS slope, count(*) AS pairs FROM r a JOIN r b ON a.doc_id = b.doc_id AND a.k < b.k GROUP BY 1""",
)
def theil_sen(spark, folder):
    return statistics.theil_sen(T.lines(_docs(spark, folder)).withColumn("n", F.length("line")), "doc_id", "pos", "n")


@query(
    "a10_line_medians",
    f"""WITH {LINES}, m AS (SELECT source, lang, count(*) AS n, median(length(line)) AS med FROM lines GROUP BY 1, 2)
    SELECT l.source, l.lang, m.n, m.med, median(abs(length(l.line) - m.med)) AS mad FROM lines l JOIN m ON l.source = m.source AND l.lang = m.lang GROUP BY 1, 2, 3, 4""",
)
def line_medians(spark, folder):
    return statistics.median_mad(T.lines(_docs(spark, folder)), ["source", "lang"], F.length("line"))


@query("h1_blocks")
def html_blocks(spark, folder):
    return markup.blocks(T.table(spark, folder, "pages"))


@query(
    "h2_plain",
    r"""WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<p[^>]*>(.*?)</p>', 1)) AS b, generate_subscripts(regexp_extract_all(html, '(?s)<p[^>]*>(.*?)</p>', 1), 1) - 1 AS seq FROM pages)
    SELECT page_id, seq, trim(regexp_replace(regexp_replace(b, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM p""",
)
def html_plain(spark, folder):
    return markup.paragraphs(T.table(spark, folder, "pages"))





@query(
    "u5_diff",
    f"""WITH {TOKENS}, a AS (SELECT term, count(*) AS n FROM tokens WHERE lang = 'en' GROUP BY 1), b AS (SELECT term, count(*) AS n FROM tokens WHERE lang <> 'en' GROUP BY 1)
    SELECT coalesce(a.term, b.term) AS term, a.n AS before, b.n AS "after" FROM a FULL JOIN b ON a.term = b.term WHERE a.n IS DISTINCT FROM b.n""",
)
def term_diff(spark, folder):
    counts = T.tokens(_docs(spark, folder)).groupBy("term").agg(F.count_if(F.col("lang") == "en").alias("a"), F.count_if(F.col("lang") != "en").alias("b"))
    return markup.difference(counts.where("a > 0").select("term", F.col("a").alias("n")), counts.where("b > 0").select("term", F.col("b").alias("n")), "term", "n")
