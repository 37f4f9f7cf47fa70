"""Queries over candidates, decisions, readings, notes and sequences."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marginalia.functions import text as X
from marginalia.operators import evaluation, joins, lexicon, models, notes, reconcile, repair, sequence, statistics, windows
from marginalia.plans.shared_sql import LINES, STATS, TOKENS
from marginalia.sources import editions
from marginalia.sources import tables as T
from marginalia.sources.settle import settled
from marginalia.streaming import feeds

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


def _stats(spark, folder):
    return statistics.collection_stats(_docs(spark, folder))


def _counts(spark, folder):
    """``term, count`` alone: words are counted where they are read."""
    return T.tokens(_docs(spark, folder)).groupBy("term").agg(F.count("*").alias("count"))


def _lexicon(spark, folder, pages: int = 3):
    return _stats(spark, folder).where(F.col("page_df") >= pages).select("term", F.col("count").alias("frequency"), "page_df")


#: Latin letters with marks as single bytes, as DuckDB's edit distance counts
#: bytes.
_BYTES = "translate({}, 'ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü', chr(1) || chr(2) || chr(3) || chr(4) || chr(5) || chr(6) || chr(7) || chr(8) || chr(14) || chr(15) || chr(16) || chr(17) || chr(18) || chr(19) || chr(20) || chr(21) || chr(22) || chr(23) || chr(24) || chr(25) || chr(26))"


# ---- candidates ------------------------------------------------------------


@query(
    "m3_trigram_topk",
    f"""WITH {STATS}, w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{{L}}+(?:[''’-]\\p{{L}}+)*')) AS word FROM benchmark), a AS (SELECT word, list_distinct(list_transform(range(1, length(word) - 1), lambda i: substr(word, i, 3))) AS wg FROM w WHERE length(word) >= 6),
    b AS (SELECT term, count, list_distinct(list_transform(range(1, length(term) - 1), lambda i: substr(term, i, 3))) AS tg FROM stats WHERE length(term) >= 6), x AS (SELECT word, len(wg) AS nw, unnest(wg) AS g FROM a), y AS (SELECT term, count, len(tg) AS nt, unnest(tg) AS g FROM b),
    m AS (SELECT word, term, count, nw, nt, count(*) AS common FROM x JOIN y USING (g) WHERE word <> term GROUP BY 1, 2, 3, 4, 5), d AS (SELECT *, levenshtein({_BYTES.format("word")}, {_BYTES.format("term")}) AS distance FROM m), s AS (SELECT word, term, count, round(common / (nw + nt - common)::DOUBLE, 6) AS jaccard, distance FROM d WHERE distance <= 4)
    SELECT word, term, jaccard, distance::INT AS distance, rank FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY jaccard DESC, distance, count DESC, term) AS rank FROM s) WHERE rank <= 10""",
)
def trigram_topk(spark, folder):
    words = T.table(spark, folder, "benchmark").select(F.explode(X.tokens(F.lower("text"))).alias("word")).distinct()
    return lexicon.trigram_candidates(words, _counts(spark, folder))


def _unknown(spark, folder):
    """Words of benchmark items with a planted confusion."""
    words = T.table(spark, folder, "benchmark").select(F.explode(X.tokens(F.lower("text"))).alias("word")).where(F.length("word").between(4, 9)).distinct()
    return words.select(F.replace("word", F.lit("h"), F.lit("b")).alias("word")).distinct()


@query("m2b_near_terms")
def near_terms(spark, folder):
    return lexicon.near_terms(_unknown(spark, folder), _lexicon(spark, folder))


@query(
    "m2b_compounds",
    f"""WITH {STATS}, k AS (SELECT term, count FROM stats WHERE page_df >= 3), w AS (SELECT DISTINCT term FROM stats WHERE length(term) >= 8), c AS (SELECT term, unnest(range(1, length(term))) AS i FROM w),
    f AS (SELECT c.term AS word, a.term || ' ' || b.term AS split, a.count * b.count AS s FROM c JOIN k a ON a.term = substr(c.term, 1, i) JOIN k b ON b.term = substr(c.term, i + 1))
    SELECT word, arg_max(split, (s, split)) AS split FROM f GROUP BY 1""",
)
def compounds(spark, folder):
    words = _stats(spark, folder).where("length(term) >= 8").select(F.col("term").alias("word"))
    return lexicon.compound_splits(words, _lexicon(spark, folder))


def _occurrences(spark, folder):
    """Benchmark words with the words beside them, perturbed as above."""
    lines = T.table(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit(0).alias("pos"), F.col("text").alias("line"))
    beside = windows.neighbours(lines).where(F.length("term").between(4, 9))
    word = F.replace("term", F.lit("h"), F.lit("b"))
    return beside.where(word != F.col("term")).select(F.concat_ws(":", "doc_id", "sentence", "idx").alias("occ_id"), F.lit("src0").alias("source"), word.alias("word"), "before", "after", F.col("term").alias("truth"))


def _ranked(spark, folder):
    docs = _docs(spark, folder)
    occurrences = _occurrences(spark, folder)
    candidates = settled(lexicon.near_terms(occurrences.select("word").distinct(), _lexicon(spark, folder)))
    # only what a candidate or a word beside one opens is looked up: counts and pairs of other words are not kept
    terms = candidates.select("term").distinct()
    lefts = settled(terms.unionByName(occurrences.select(F.col("before").alias("term"))).where("term is not null").distinct())
    few = lambda df, n: F.broadcast(df) if n <= 400_000 else df
    n = lefts.count()
    counts = T.tokens(docs).select("source", "term").join(few(terms, n), "term", "left_semi").groupBy("source", "term").agg(F.count("*").alias("n"))
    pairs = T.pairs(docs).select("source", "left", "right").join(few(lefts.withColumnRenamed("term", "left"), n), "left", "left_semi")
    pairs = settled(pairs.groupBy("source", "left", "right").agg(F.count("*").alias("n")))
    zipf = _counts(spark, folder).select("term", (F.log10("count") + 3).alias("zipf"))
    return occurrences, lexicon.ranked_in_context(occurrences, candidates, counts, pairs, zipf), zipf


@query("m2_rank")
def ranked(spark, folder):
    return _ranked(spark, folder)[1]


@query("m5_decisions")
def decisions(spark, folder):
    occurrences, found, zipf = _ranked(spark, folder)
    best = found.where("rank = 1").select("occ_id", F.col("term").alias("best")).join(zipf, F.col("best") == F.col("term")).select("occ_id", "zipf")
    evidence = occurrences.join(best, "occ_id", "left").select("occ_id", F.when(F.length("truth") % 5 == 0, 2).otherwise(1).alias("row_count"), F.array("truth", F.when(F.length("truth") % 3 == 0, F.col("word")).otherwise(F.col("truth"))).alias("readings"), F.col("truth").alias("embedded"), "zipf")
    return lexicon.decided(found, evidence)


@query("m6_corrected")
def corrected(spark, folder):
    occurrences, found, zipf = _ranked(spark, folder)
    best = found.where("rank = 1").join(zipf, "term").join(occurrences.select("occ_id", "truth"), "occ_id")
    rows = best.select("occ_id", "word", "term", "distance", "zipf", F.lit(True).alias("known"), (F.length("word") % 7 == 0).alias("capitalised"), "score", (F.col("score") - 1).alias("own_score"), "confusion_supported", F.array("truth", F.when(F.length("truth") % 2 == 0, F.col("truth")).otherwise(F.col("word"))).alias("readings"))
    judged = rows.select("occ_id", F.when(F.length("word") % 2 == 0, 0.95).otherwise(0.5).alias("meaning"), F.lit(0.92).alias("grammar"))
    return lexicon.corrected_readings(rows, judged)


@query(
    "k1_attested_order",
    f"""WITH {STATS}, s AS (SELECT substr(term, 1, 4) AS word, term, length(term) - 4 AS distance, page_df AS attested FROM stats WHERE length(term) BETWEEN 5 AND 9)
    SELECT word, term, distance, attested, rank FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, attested DESC, term) AS rank FROM s) WHERE rank <= 5""",
)
def attested_order(spark, folder):
    rows = _stats(spark, folder).where("length(term) between 5 and 9").select(F.substring("term", 1, 4).alias("word"), "term", (F.length("term") - 4).alias("distance"), F.col("page_df").alias("attested"))
    return lexicon.attested_order(rows)


@query(
    "k4_signals",
    f"""WITH {STATS}, f AS (SELECT *, count >= 3 AND page_df >= 2 AND (chapter_df >= 2 OR page_df >= 3) AS dispersed, length(term) % 4 = 0 AS variant, length(term) % 3 = 0 AS proposal FROM stats)
    SELECT term, CASE WHEN variant THEN 0 WHEN dispersed AND NOT proposal THEN 2 ELSE 1 END AS review_priority, CASE WHEN dispersed AND NOT variant THEN 'consider-protecting' ELSE 'inspect-spelling' END AS recommendation FROM f""",
)
def signals(spark, folder):
    stats = _stats(spark, folder)
    return lexicon.review_signals(stats, stats.where("length(term) % 4 = 0").select("term"), stats.where("length(term) % 3 = 0").select("term"))


@query("m17_feedback")
def feedback(spark, folder):
    words = _unknown(spark, folder)
    # counted once: seeds are used twice, known words once
    stats = settled(_stats(spark, folder).where("page_df >= 3").select("term", "count", "page_df"))
    seeds = stats.where("page_df >= 5 and contains(term, 'th')").select(F.lit(1).alias("seed_id"), F.replace("term", F.lit("h"), F.lit("b")).alias("before"), F.col("term").alias("after"))
    return lexicon.feedback_proposals(words, seeds, stats.select("term", F.col("count").alias("frequency"), "page_df"))


@query(
    "a1_maps",
    f"""WITH {TOKENS}, f AS (SELECT term, form, count(*) AS n FROM tokens WHERE source <> 'src0' GROUP BY 1, 2), c AS (SELECT term, source, count(*) AS n FROM tokens WHERE source <> 'src0' GROUP BY 1, 2), r AS (SELECT term, count(*) AS n FROM tokens WHERE source = 'src0' GROUP BY 1),
    fs AS (SELECT term, string_agg(form || ':' || n, ',' ORDER BY form) AS forms FROM f GROUP BY 1), cs AS (SELECT term, string_agg(source || ':' || n, ',' ORDER BY source) AS chapters FROM c GROUP BY 1)
    SELECT coalesce(fs.term, r.term) AS term, forms, chapters, coalesce(r.n, 0) AS reference_count FROM fs JOIN cs ON fs.term = cs.term FULL JOIN r ON r.term = fs.term""",
)
def maps(spark, folder):
    found = statistics.term_maps(T.tokens(_docs(spark, folder)), F.col("source") == "src0")
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return found.select("term", text("forms").alias("forms"), text("chapter_counts").alias("chapters"), "reference_count")


def _pairs(spark, folder):
    terms = _stats(spark, folder).where("page_df >= 3").select(F.col("term").alias("target"))
    read = F.when(F.length("target") % 2 == 0, F.replace("target", F.lit("th"), F.lit("tb"))).otherwise(F.replace("target", F.lit("n"), F.lit("ri")))
    return terms.withColumn("observed", read).where("observed <> target")


@query("a17_error_model")
def error_model(spark, folder):
    return statistics.error_model(_pairs(spark, folder))


@query("a18_repeated_edits")
def repeated_edits(spark, folder):
    tokens = T.tokens(_docs(spark, folder)).select(F.col("source").alias("book"), F.col("term")).distinct()
    wrong = tokens.where(F.contains("term", F.lit("th"))).select("book", F.col("term").alias("id"), F.lit("correct").alias("expected"), F.replace("term", F.lit("th"), F.lit("tb")).alias("before"), F.col("term").alias("after"))
    right = tokens.where(F.contains("term", F.lit("b"))).select("book", F.col("term").alias("id"), F.lit("retain").alias("expected"), F.col("term").alias("before"), F.col("term").alias("after"))
    return statistics.repeated_edits(wrong.unionByName(right))


@query("a26_phrases")
def phrases(spark, folder):
    named = F.regexp_replace("text", ", ", " by Carlos Perez Shuma and ")
    cut = _docs(spark, folder).select("doc_id", F.posexplode(F.split(named, r"(?<=[.!?])\s+")).alias("seq", "sentence"))
    return statistics.glossary_phrases(cut)


# ---- readings --------------------------------------------------------------


def _readings(spark, folder):
    rows = T.wrapped(_docs(spark, folder))
    other = F.replace("line", F.lit("th"), F.lit("tb"))
    return rows.select(
        F.concat_ws(":", "doc_id", "pos").alias("row_id"),
        F.when(F.col("pos") % 4 == 1, F.concat(F.lit("*"), "line")).otherwise(F.replace("line", F.lit(", "), F.lit("-"))).alias("text"),
        F.col("line").alias("embedded"),
        F.when(F.col("pos") % 4 == 2, other).otherwise(F.replace("line", F.lit(", "), F.lit("—"))).alias("vision"),
        F.when(F.col("pos") % 4 == 2, other).otherwise(F.replace("line", F.lit(", "), F.lit("—"))).alias("rapid"),
    )


@query("m11_reconcile")
def reconciled(spark, folder):
    zipf = _counts(spark, folder).select("term", (F.log10("count") + 2).alias("zipf"))
    done = reconcile.reconciled_with(_readings(spark, folder), zipf, changed=True)
    return done.select("row_id", "repaired", F.array_join(F.transform("events", lambda e: e["kind"]), ",").alias("kinds"), "disagrees").where("kinds <> '' or disagrees")


def _respaced(spark, folder):
    return T.lines(_docs(spark, folder)).select(F.concat_ws(":", "doc_id", "pos").alias("row_id"), F.col("line").alias("text"), F.regexp_replace("line", r"\b(\p{L}{4})(\p{L}{4})\b", "$1 $2").alias("spaced"), F.replace("line", F.lit("th"), F.lit("tb")).alias("vision"))


@query("m9_changes")
def changes(spark, folder):
    return reconcile.changes(_respaced(spark, folder), "vision", ("change",))


@query("m10_splits")
def splits(spark, folder):
    return reconcile.changes(_respaced(spark, folder), "spaced", ("split",))


@query("j14_shared_changes")
def shared_changes(spark, folder):
    rows = _respaced(spark, folder).withColumn("third", F.replace("vision", F.lit("an"), F.lit("au")))
    return reconcile.shared_changes(reconcile.changes(rows, "vision"), reconcile.changes(rows, "third"))


@query("f20_accepted_splits")
def accepted_splits(spark, folder):
    found = reconcile.changes(_respaced(spark, folder), "spaced", ("split",))
    return reconcile.accepted_splits(found, T.tokens(_docs(spark, folder)).select("term").where("length(term) = 4"))


@query("m8_located")
def located(spark, folder):
    rows = T.lines(_docs(spark, folder)).select("doc_id", "pos", "line", F.try_element_at(X.tokens(F.col("line")), F.lit(3)).alias("word")).where("word is not null")
    return rows.select("doc_id", "pos", reconcile.read_at("line", F.replace("line", F.lit("th"), F.lit("tb")), "word", "word").alias("read"))


# ---- joins -----------------------------------------------------------------


@query(
    "j3_unique_match",
    """WITH m AS (SELECT a.event_id, b.event_id AS other FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 600000000)
    SELECT event_id, min(other) AS match FROM m GROUP BY 1 HAVING count(*) = 1""",
)
def unique_match(spark, folder):
    e = T.table(spark, folder, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return joins.unique_match(e, e, "user_id", "t", 600_000_000, "event_id")


@query(
    "j5_searches",
    """WITH a AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_quantity > 10 AS t FROM lineitem), e AS (SELECT o, unnest(range(1, 9)) AS n FROM (SELECT DISTINCT o FROM a)), m AS (SELECT e.o, e.n FROM e WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.o = e.o AND a.n = e.n)),
    b AS (SELECT m.o, m.n, max(a.p) FILTER (a.n < m.n AND a.t) AS lower, min(a.p) FILTER (a.n > m.n AND a.t) AS upper FROM m JOIN a ON a.o = m.o GROUP BY 1, 2) SELECT o, n AS number, lower, upper, CASE WHEN lower >= upper THEN 'anchor-order-conflict' ELSE 'searchable' END AS status FROM b""",
)
def searches(spark, folder):
    anchors = T.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), (F.col("l_quantity") > 10).alias("trusted"))
    return sequence.searches(anchors, "o", "n", "p", anchors.select("o").distinct().withColumn("notes", F.lit(8)))


@query(
    "j9_overlay",
    r"""WITH e AS (SELECT doc_id AS page, 1 AS seq, 'the ' AS before, 'THE ' AS "after", (doc_id % 3)::BIGINT AS count FROM documents UNION ALL SELECT doc_id, 2, 'an', 'AN', 1 FROM documents),
    c AS (SELECT e.*, d.text, (length(d.text) - length(replace(d.text, 'the ', ''))) // 4 AS n1, (length(d.text) - length(replace(d.text, 'an', ''))) // 2 AS n2 FROM e JOIN documents d ON d.doc_id = e.page)
    SELECT page, seq, before, "after", count, CASE seq WHEN 1 THEN n1 ELSE n2 END AS matches, count = CASE seq WHEN 1 THEN n1 ELSE n2 END AS applied FROM c""",
)
def overlay(spark, folder):
    docs = _docs(spark, folder)
    edits = docs.select(F.col("doc_id").alias("page"), F.lit(1).alias("seq"), F.lit("the ").alias("before"), F.lit("THE ").alias("after"), (F.col("doc_id") % 3).cast("long").alias("count"))
    edits = edits.unionByName(docs.select(F.col("doc_id").alias("page"), F.lit(2).alias("seq"), F.lit("an").alias("before"), F.lit("AN").alias("after"), F.lit(1).cast("long").alias("count")))
    return joins.checked_edits(docs.select(F.col("doc_id").alias("page"), F.lit(0).alias("pos"), "text"), edits)[1]


@query(
    "j10_decisions",
    """WITH r AS (SELECT doc_id, sha256(text) AS t, sha256(lang) AS e, n_chars % 7 + doc_id % 2 AS p FROM documents), m AS (SELECT a.doc_id, count(*) AS texts, min(b.doc_id) AS one, count(*) FILTER (a.e = b.e) AS evs, min(b.doc_id) FILTER (a.e = b.e) AS two, count(*) FILTER (a.e = b.e AND a.p = b.p) AS places, min(b.doc_id) FILTER (a.e = b.e AND a.p = b.p) AS three FROM r a JOIN r b ON a.t = b.t GROUP BY 1)
    SELECT doc_id AS decision_id, CASE WHEN texts = 1 THEN one WHEN evs = 1 THEN two WHEN places = 1 THEN three END AS row_id, CASE WHEN texts = 1 OR evs = 1 OR places = 1 THEN 'bound' WHEN evs = 0 THEN 'evidence-changed' ELSE 'ambiguous-place' END AS reason FROM m""",
)
def bound(spark, folder):
    rows = _docs(spark, folder).select(F.col("doc_id").alias("row_id"), F.sha2("text", 256).alias("text_hash"), F.sha2("lang", 256).alias("evidence_hash"), (F.col("n_chars") % 7 + F.col("doc_id") % 2).alias("place"))
    return joins.bound(rows.withColumnRenamed("row_id", "decision_id"), rows)


@query(
    "j17_redirects",
    """WITH t AS (SELECT lower(n_name) AS term, n_nationkey AS k FROM nation), r AS (SELECT term AS source, 'Mid' || k AS target FROM t WHERE k % 3 = 0 UNION ALL SELECT 'Mid' || k, 'Page' || k FROM t WHERE k % 2 = 0),
    p AS (SELECT 'Page' || k AS title, 'Seite' || k AS target_title, k % 4 = 0 AS d FROM t UNION ALL SELECT 'Mid' || k, 'Mitte' || k, false FROM t UNION ALL SELECT upper(left(term, 1)) || substr(term, 2), 'Land' || k, false FROM t),
    o AS (SELECT t.term, coalesce(a.target, upper(left(t.term, 1)) || substr(t.term, 2)) AS x FROM t LEFT JOIN r a ON a.source = t.term), q AS (SELECT o.term, coalesce(b.target, x) AS title FROM o LEFT JOIN r b ON b.source = x) SELECT q.term, q.title, p.target_title AS target FROM q JOIN p ON p.title = q.title WHERE NOT d""",
)
def redirects(spark, folder):
    t = T.table(spark, folder, "nation").select(F.lower("n_name").alias("term"), F.col("n_nationkey").alias("k"))
    name = lambda s: F.concat(F.lit(s), F.col("k").cast("string"))
    r = t.where("k % 3 = 0").select(F.col("term").alias("source"), name("Mid").alias("target")).unionByName(t.where("k % 2 = 0").select(name("Mid").alias("source"), name("Page").alias("target")))
    pages = t.select(name("Page").alias("title"), name("Seite").alias("target_title"), (F.col("k") % 4 == 0).alias("disambiguation"))
    pages = pages.unionByName(t.select(name("Mid").alias("title"), name("Mitte").alias("target_title"), F.lit(False).alias("disambiguation")))
    pages = pages.unionByName(t.select(F.concat(F.upper(F.substring("term", 1, 1)), F.substr("term", F.lit(2))).alias("title"), name("Land").alias("target_title"), F.lit(False).alias("disambiguation")))
    return joins.redirected(t, r, pages)


@query(
    "j21_reach",
    """WITH RECURSIVE r(node) AS (SELECT 1::BIGINT UNION SELECT p_partkey FROM part JOIN r ON (p_partkey = 2 * node OR (p_partkey = 2 * node + 1 AND node % 3 <> 0)))
    SELECT p_partkey AS node FROM part WHERE p_partkey NOT IN (SELECT node FROM r)""",
)
def unreached(spark, folder):
    nodes = T.table(spark, folder, "part").select(F.col("p_partkey").cast("long").alias("node"))
    edges = nodes.select(F.floor(F.col("node") / 2).alias("source"), F.col("node").alias("target")).where("target > 1 and (target % 2 = 0 or source % 3 <> 0)")
    return joins.unused(nodes, nodes.where("node = 1"), edges)


@query("j22_inventory", "SELECT doc_id, 'missing' AS status FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT conv_id + 1000000000, 'unknown' FROM (SELECT DISTINCT conv_id FROM conversations)")
def inventory(spark, folder):
    system = T.table(spark, folder, "labels").select("doc_id").unionByName(T.table(spark, folder, "conversations").select((F.col("conv_id") + 1_000_000_000).alias("doc_id")).distinct())
    return joins.inventory(_docs(spark, folder).select("doc_id"), system, "doc_id")


@query(
    "f22_editions",
    r"""WITH b AS (SELECT p_partkey AS k, '978' || lpad(p_partkey::VARCHAR, 9, '0') AS s, p_name AS title, 'A. ' || p_brand AS author, p_type AS pub FROM part),
    i AS (SELECT *, s || ((10 - list_sum(list_transform(range(1, 13), lambda j: substr(s, j, 1)::INT * (CASE WHEN j % 2 = 0 THEN 3 ELSE 1 END))) % 10) % 10)::INT AS isbn FROM b)
    SELECT k AS p_partkey, CASE WHEN k % 5 = 1 THEN 'isbn' WHEN k % 5 = 2 THEN 'title' WHEN k % 5 = 3 THEN 'author' WHEN k % 7 = 4 THEN 'publisher' END AS problem FROM i""",
)
def edition_problems(spark, folder):
    k = F.col("p_partkey")
    # a small file is one task: its rows are dealt before any work is done on them
    part = T.in_parts(T.table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type"), "p_partkey", mb=0.25)
    stem = F.concat(F.lit("978"), F.lpad(k.cast("string"), 9, "0"))
    part = part.withColumn("_isbn", F.concat(stem, X.isbn13_check(stem).cast("string"))).withColumn("_isbn", editions.isbn13(F.col("_isbn")))
    isbn = F.col("_isbn")
    book = {"isbn": isbn, "title": F.col("p_name"), "author": F.concat(F.lit("A. "), "p_brand"), "aliases": F.array(F.lit("Nobody")), "publisher": F.col("p_type")}
    record = {
        "isbns": F.array(F.when(k % 5 == 1, "9780000000002").otherwise(isbn)),
        "title": F.when(k % 5 == 2, "Another").otherwise(F.upper("p_name")),
        "authors": F.array(F.when(k % 5 == 3, "Someone").otherwise(F.concat(F.lit("a "), "p_brand"))),
        "publishers": F.array(F.when(k % 7 == 4, "Elsewhere").otherwise(F.concat("p_type", F.lit(" and Sons")))),
    }
    return part.select("p_partkey", editions.edition_problem(record, book).alias("problem"))


@query(
    "u7_first_forms",
    f"""WITH {TOKENS} SELECT source, term, doc_id, pos, idx FROM (SELECT *, row_number() OVER (PARTITION BY source, term ORDER BY doc_id, pos, idx) AS k FROM tokens) WHERE k = 1""",
)
def first_forms(spark, folder):
    return windows.first_of_each(T.tokens(_docs(spark, folder)), ["source", "term"], ["doc_id", "pos", "idx"]).select("source", "term", "doc_id", "pos", "idx")


@query(
    "k7_worst_share",
    """SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS k, count(*) OVER (PARTITION BY source) AS n FROM documents) WHERE k <= greatest(1, floor(n * 0.1))""",
)
def worst_share(spark, folder):
    return repair.worst_share(_docs(spark, folder).select("source", "doc_id", "n_chars"), "source", "n_chars", "doc_id", 0.1)


@query(
    "w14_queue",
    """WITH r AS (SELECT row_number() OVER (ORDER BY (n_chars < 300) DESC, (lang <> 'en') DESC, source, doc_id) AS n, (quality = 0)::INT AS e FROM labels JOIN documents USING (doc_id)), h(head) AS (VALUES (10), (50), (200))
    SELECT head, least(head, (SELECT count(*) FROM r))::INT AS reviewed, coalesce(sum(e) FILTER (n <= head), 0)::INT AS errors FROM h, r GROUP BY head""",
)
def queue(spark, folder):
    rows = T.table(spark, folder, "labels").join(_docs(spark, folder), "doc_id").select("doc_id", "source", (F.col("n_chars") < 300).alias("short"), (F.col("lang") != "en").alias("foreign"), (F.col("quality") == 0).alias("error"))
    return windows.queue_order(rows, ["short", "foreign"], ["source", "doc_id"], "error", [10, 50, 200])


@query(
    "w17_neighbours",
    f"""WITH {LINES}, s AS (SELECT doc_id, pos, unnest(string_split_regex(line, '[.!?;]')) AS part, generate_subscripts(string_split_regex(line, '[.!?;]'), 1)::INT - 1 AS sentence FROM lines),
    t AS (SELECT doc_id, pos, sentence, unnest(regexp_extract_all(lower(part), '\\p{{L}}+(?:[''’-]\\p{{L}}+)*')) AS term, generate_subscripts(regexp_extract_all(lower(part), '\\p{{L}}+(?:[''’-]\\p{{L}}+)*'), 1)::INT - 1 AS idx FROM s)
    SELECT doc_id, pos, sentence, idx, term, lag(term) OVER w AS before, lead(term) OVER w AS "after" FROM t WINDOW w AS (PARTITION BY doc_id, pos, sentence ORDER BY idx)""",
)
def neighbours(spark, folder):
    return windows.neighbours(T.lines(_docs(spark, folder)))


@query(
    "f7_repeated_word",
    f"""WITH {LINES}, s AS (SELECT doc_id, pos, unnest(string_split_regex(lower(line), '[^\\p{{L}}\\s]+')) AS part, generate_subscripts(string_split_regex(lower(line), '[^\\p{{L}}\\s]+'), 1) AS k FROM lines), w AS (SELECT doc_id, pos, k, list_filter(string_split_regex(part, '\\s+'), lambda x: x <> '') AS t FROM s)
    SELECT doc_id, pos, sum(len(list_filter(range(1, len(t)), lambda i: t[i] = t[i + 1] AND length(t[i]) >= 2)))::BIGINT AS repeats FROM w GROUP BY 1, 2 HAVING repeats > 0""",
)
def repeated_words(spark, folder):
    parts = F.split(F.lower("line"), r"[^\p{L}\s]+")
    words = F.transform(parts, lambda p: F.filter(F.split(p, r"\s+"), lambda x: x != ""))
    pairs = lambda t: F.size(F.filter(F.arrays_zip(t.alias("a"), F.slice(t, 2, 1_000_000).alias("b")), lambda z: (z["a"] == z["b"]) & (F.length(z["a"]) >= 2)))
    total = F.aggregate(F.transform(words, lambda t: pairs(t).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return T.lines(_docs(spark, folder)).select("doc_id", "pos", total.alias("repeats")).where("repeats > 0")


@query(
    "f7_line_marks",
    f"""WITH {LINES} SELECT doc_id, pos, len(regexp_extract_all(line, '(?i)\\s+[.•·](?:\\s|$)|[.:;,][.:;,]+')) AS marks, len(list_filter(regexp_extract_all(line || CASE WHEN pos % 3 = 0 THEN ' сloсk' ELSE '' END, '\\p{{L}}+'), lambda w: regexp_matches(w, '[A-Za-z]') AND regexp_matches(w, '[\\x{{0400}}-\\x{{04FF}}]'))) AS mixed FROM lines""",
)
def line_marks(spark, folder):
    mixed = F.concat("line", F.when(F.col("pos") % 3 == 0, " сloсk").otherwise(""))
    words = F.filter(F.regexp_extract_all(mixed, F.lit(r"(\p{L}+)"), 1), lambda w: w.rlike("[A-Za-z]") & w.rlike(r"[\x{0400}-\x{04FF}]"))
    return T.lines(_docs(spark, folder)).select("doc_id", "pos", F.regexp_count("line", F.lit(r"\s+[.•·](?:\s|$)|[.:;,][.:;,]+")).cast("long").alias("marks"), F.size(words).cast("long").alias("mixed"))


# ---- sequences and notes ---------------------------------------------------


def _lineitem(spark, folder):
    return T.table(spark, folder, "lineitem")


@query("q1_align")
def alignment(spark, folder):
    rows = _lineitem(spark, folder).select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("int").alias("position"), F.when(F.col("l_quantity") > 25, 2).otherwise(1).alias("votes"))
    return sequence.aligned(rows, "l_orderkey", "position", "l_linenumber", "votes").select("l_orderkey", "l_linenumber", "position", "aligned.status", "aligned.best", "aligned.without")


@query("q2_select")
def selection(spark, folder):
    rows = _lineitem(spark, folder).select("l_orderkey", F.col("l_partkey").alias("candidate"), F.col("l_linenumber").alias("number"), F.when(F.col("l_quantity") > 25, 2).otherwise(1).alias("votes"), F.lit(6).alias("most"))
    return sequence.selected(rows, "l_orderkey", "candidate", "number", "votes", "most")


@query("q3_anchors")
def anchors(spark, folder):
    rows = _lineitem(spark, folder).select("l_orderkey", F.col("l_partkey").alias("place"), "l_linenumber")
    return sequence.trusted_anchors(rows, "l_orderkey", "place", "l_linenumber", maximum=6)


@query(
    "q4_retries",
    """WITH o AS (SELECT l_orderkey AS o, l_linenumber AS c, l_linenumber AS n FROM lineitem), r AS (SELECT o, c, unnest([(c + 1)::VARCHAR, (c + 1)::VARCHAR, c::VARCHAR, '0' || c, 'x']) AS r FROM (SELECT DISTINCT o, c FROM o)), d AS (SELECT o, c, try_cast(r AS BIGINT) AS n, count(*) AS votes FROM r WHERE regexp_matches(r, '^[1-9][0-9]*$') GROUP BY 1, 2, 3),
    m AS (SELECT d.o, d.c, d.n, votes, list_contains(['68', '38', '56', '29', '17', '08', '86', '83', '65', '92', '71', '80'], d.c || '' || d.n) AS sim FROM d WHERE d.n <> d.c AND d.n <= 7)
    SELECT o, c AS candidate, n AS number, votes, CASE WHEN length(c::VARCHAR) <> length(n::VARCHAR) THEN 2.0 WHEN sim THEN 0.5 ELSE 2.0 END::DOUBLE AS cost FROM m""",
)
def retries(spark, folder):
    options = _lineitem(spark, folder).select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("candidate"), F.col("l_linenumber").alias("number"))
    # dealt once by candidate: every count and the join find their rows in place, none is made over a whole input file
    options = T.in_parts(options, "o", "candidate")
    up = (F.col("candidate") + 1).cast("string")
    read = options.select("o", "candidate").distinct().withColumn("readings", F.array(up, up, F.col("candidate").cast("string"), F.concat(F.lit("0"), F.col("candidate").cast("string")), F.lit("x")))
    return sequence.retries(read, options, "o", F.lit(7))


@query(
    "q5_absorbed",
    """WITH r AS (SELECT l_orderkey AS page, l_linenumber AS row, l_partkey % 20 AS x0, l_suppkey % 10 AS y0, l_partkey % 20 + 4 AS x1, l_suppkey % 10 + 4 AS y1, l_quantity FROM lineitem), m AS (SELECT *, row AS number FROM r WHERE l_quantity > 25)
    SELECT r.page, r.row, m.number, m.row AS target_row FROM r JOIN m ON r.page = m.page AND r.row <> m.row WHERE greatest(0, least(r.x1, m.x1) - greatest(r.x0, m.x0)) * greatest(0, least(r.y1, m.y1) - greatest(r.y0, m.y0)) / 16.0 >= 0.6""",
)
def absorbed(spark, folder):
    at = lambda c, k, d: (F.col(c) % k + d).cast("double")
    rows = _lineitem(spark, folder).select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("row"), F.col("l_linenumber").cast("string").alias("text"), at("l_partkey", 20, 0).alias("x0"), at("l_suppkey", 10, 0).alias("y0"), at("l_partkey", 20, 4).alias("x1"), at("l_suppkey", 10, 4).alias("y1"), "l_quantity")
    return sequence.absorbed(rows, rows.where("l_quantity > 25").withColumn("number", F.col("row")))


@query(
    "j18_note_links",
    r"""WITH n AS (SELECT doc_id AS id, CASE WHEN doc_id % 6 = 0 THEN 'plain note' WHEN doc_id % 6 = 1 THEN '* a * b' ELSE '* a note' END AS t FROM documents), c AS (SELECT doc_id AS id, CASE WHEN doc_id % 6 = 2 THEN 0 WHEN doc_id % 6 = 3 THEN 2 ELSE 1 END AS calls FROM documents)
    SELECT n.id AS note_id, CASE WHEN id % 6 = 0 THEN 'unrecognized-note-prefix' WHEN id % 6 = 1 THEN 'multiple-note-symbols' WHEN c.calls <> 1 THEN 'nonunique-body-symbol' WHEN id % 6 = 4 THEN 'existing-link' ELSE 'linked' END AS status,
    CASE WHEN id % 6 >= 2 THEN c.calls ELSE 0 END AS calls, CASE WHEN id % 6 = 5 THEN 4 END AS start FROM n JOIN c USING (id)""",
)
def note_links(spark, folder):
    page = F.col("doc_id")
    docs, kind = _docs(spark, folder), page % 6
    n = docs.select(page.alias("note_id"), F.lit(1).alias("chapter"), page.alias("page"), F.when(kind == 0, "plain note").when(kind == 1, "* a * b").otherwise("* a note").alias("text"), F.lit(1).alias("entries"))
    blocks = docs.select(page.alias("block_id"), F.lit(1).alias("chapter"), F.lit("text").alias("kind"), F.when(kind == 2, "* no call").when(kind == 3, "word* word* end").otherwise("word* end").alias("text"))
    sources = docs.select(page.alias("block_id"), page.alias("page"), F.lit(0).alias("start"), F.lit(100).alias("stop"))
    styles = docs.where(kind == 4).select(page.alias("block_id"), F.lit(3).alias("start"), F.lit(6).alias("stop"), F.lit(False).alias("raised"), F.lit("#x").alias("href"))
    return notes.link_notes(n, blocks, sources, styles).select("note_id", "status", "calls", "start")


@query(
    "j19_endnotes",
    """WITH s AS (SELECT l_orderkey AS o, l_linenumber AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS k, count(*) OVER (PARTITION BY l_orderkey) AS c FROM lineitem)
    SELECT o AS chapter, n::INT AS number, 'endnote-' || o || '-' || n AS id, CASE WHEN n <> k THEN 'sequence-error' END AS problem FROM s UNION ALL SELECT o, NULL, NULL, CASE WHEN c <> 4 THEN 'incomplete' END FROM (SELECT DISTINCT o, c FROM s)""",
)
def endnotes(spark, folder):
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    rows = _lineitem(spark, folder).select(F.lit("b").alias("x"), F.col("l_orderkey").alias("book"), F.row_number().over(order).alias("seq"), F.lit("text").alias("kind"), F.concat(F.col("l_linenumber").cast("string"), F.lit(". a note")).alias("text"), F.lit(0.1).alias("x0")).drop("x")
    orders = _lineitem(spark, folder).select(F.col("l_orderkey").alias("book")).distinct()
    heads = orders.select("book", F.lit(0).alias("seq"), F.lit("heading").alias("kind"), F.lit("Notes").alias("text"), F.lit(0.1).alias("x0"))
    sections = orders.select("book", F.lit("Notes").alias("heading"), F.col("book").alias("chapter"), F.lit(4).alias("expected"))
    return notes.endnotes(heads.unionByName(rows), sections).select("chapter", "number", "id", "problem")


@query(
    "j19_backlinks",
    """WITH n AS (SELECT o_orderkey AS chapter, unnest([1, 2, 3]) AS number FROM orders), c AS (SELECT l_orderkey AS chapter, l_linenumber AS number, count(*) AS k FROM lineitem GROUP BY 1, 2)
    SELECT n.chapter, n.number, coalesce(k, 0) AS backlinks, CASE WHEN k IS NULL THEN 'unlinked' ELSE 'linked' END AS status FROM n LEFT JOIN c USING (chapter, number)""",
)
def backlinks(spark, folder):
    n = T.table(spark, folder, "orders").select(F.col("o_orderkey").alias("chapter"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("number")).withColumn("id", F.concat_ws("-", "chapter", "number"))
    calls = _lineitem(spark, folder).select(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").cast("int").alias("number"), F.col("l_partkey").alias("place"))
    return notes.link_endnotes(n, calls)[0].select("chapter", "number", F.size("backlinks").cast("long").alias("backlinks"), "status")


@query("m19_recovered")
def recovered(spark, folder):
    options = _lineitem(spark, folder).select(F.col("l_orderkey").alias("o"), F.col("l_partkey").cast("long").alias("candidate"), F.col("l_linenumber").cast("long").alias("number"), F.when(F.col("l_quantity") > 25, 2).otherwise(1).cast("long").alias("votes"), F.lit(7).cast("long").alias("most"))
    read = options.select("o", "candidate", F.array((F.col("number") + 1).cast("string"), (F.col("number") + 1).cast("string")).alias("readings"))
    return notes.recovered(options, read, "o", "most")


@query("m19_researched")
def researched(spark, folder):
    rows = _lineitem(spark, folder).select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").cast("long").alias("number"), F.col("l_partkey").cast("long").alias("position"), F.col("l_quantity"))
    anchors_ = rows.where("l_quantity > 20").withColumn("trusted", F.col("l_quantity") > 25)
    options = rows.where("l_quantity <= 20").select("o", "number", "position", F.when(F.col("l_quantity") > 10, 2).otherwise(1).alias("votes"), F.col("position").alias("candidate"))
    return notes.researched(anchors_, options, rows.select("o").distinct().withColumn("notes", F.lit(7)), "o")


@query(
    "m19_footer_labels",
    r"""WITH l AS (SELECT l_orderkey AS chapter, 1 AS page, l_linenumber AS row, (l_linenumber + CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END) || '. a note' AS t FROM lineitem), n AS (SELECT chapter, page, row, regexp_extract(t, '^\s*(\d{1,3})[.)\]]?\s+\S', 1)::INT AS number FROM l)
    SELECT chapter, row, number, number = row_number() OVER (PARTITION BY chapter, page ORDER BY row, number) AS verified FROM n""",
)
def footer_labels(spark, folder):
    number = F.col("l_linenumber") + F.when(F.col("l_quantity") > 40, 1).otherwise(0)
    rows = _lineitem(spark, folder).select(F.col("l_orderkey").alias("chapter"), F.lit(1).alias("page"), F.col("l_linenumber").alias("row"), F.concat(number.cast("string"), F.lit(". a note")).alias("text"))
    return notes.footer_labels(rows).select("chapter", "row", "number", "verified")


# ---- evaluation and models -------------------------------------------------


@query(
    "a7_cer",
    f"""WITH b AS (SELECT item_id % 4 AS g, {_BYTES.format("translate(text, 'lO', '10')")} AS before, {_BYTES.format("text")} AS truth, {_BYTES.format("translate(text, 'O', '0')")} AS output FROM benchmark),
    t AS (SELECT g, sum(length(truth))::BIGINT AS characters, sum(levenshtein(before, truth))::BIGINT AS eb, sum(levenshtein(output, truth))::BIGINT AS ea FROM b GROUP BY 1)
    SELECT g, characters, eb AS edits_before, ea AS edits_after, round(eb / characters::DOUBLE, 6) AS cer_before, round(ea / characters::DOUBLE, 6) AS cer_after, round((eb - ea) / nullif(eb, 0)::DOUBLE, 6) AS reduction FROM t""",
)
def cer(spark, folder):
    rows = T.table(spark, folder, "benchmark")
    pages = rows.select((F.col("item_id") % 4).alias("g"), F.translate("text", "lO", "10").alias("before"), F.col("text").alias("truth"), F.translate("text", "O", "0").alias("output"))
    return evaluation.character_errors(pages, "g")


@query(
    "a7_wer",
    f"""WITH w AS (SELECT item_id % 4 AS g, {_BYTES.format("text")} AS truth, {_BYTES.format("replace(text, 'th', 'tb')")} AS before, string_split_regex(trim(text), '\\s+') AS t, string_split_regex(trim(replace(text, 'th', 'tb')), '\\s+') AS b FROM benchmark)
    SELECT g, sum(length(truth))::BIGINT AS characters, sum(len(t))::BIGINT AS words, sum(levenshtein(before, truth))::BIGINT AS edits_before, sum(len(list_filter(range(1, len(t) + 1), lambda i: t[i] <> b[i])))::BIGINT AS word_edits_before FROM w GROUP BY 1""",
)
def wer(spark, folder):
    rows = T.table(spark, folder, "benchmark").select((F.col("item_id") % 4).alias("g"), F.col("text").alias("truth"), F.replace("text", F.lit("th"), F.lit("tb")).alias("before"), F.col("text").alias("output"))
    return evaluation.text_errors(rows, "g").select("g", "characters", "words", "edits_before", "word_edits_before")


@query("a21_engines")
def engines(spark, folder):
    rows = T.table(spark, folder, "benchmark")
    each = F.array(*[F.struct(F.lit(e).alias("engine"), t.alias("text")) for e, t in (("a", F.col("text")), ("b", F.replace("text", F.lit("th"), F.lit("tb"))), ("c", F.replace("text", F.lit("e"), F.lit("c"))))])
    pages = rows.select(F.col("item_id").alias("page"), F.explode(each).alias("e")).select("page", "e.*", F.lit(1).alias("lines"), F.lit(0.9).alias("confidence"))
    return evaluation.engine_benchmark(pages)


def _sessions(spark, folder):
    e = T.table(spark, folder, "events")
    sessions = e.groupBy(F.col("user_id").alias("session")).agg((F.count("*") * 60000.0).alias("elapsed_ms")).withColumn("strategy", (F.col("session") % 3).cast("string"))
    decisions_ = e.select(F.col("user_id").alias("session"), F.col("event_id").alias("id"), F.when(F.col("event_type") == "click", None).otherwise(F.col("event_type")).alias("replacement"))
    gold = e.select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 2 == 0, "purchase").otherwise("view").alias("before"), F.lit("purchase").alias("truth"))
    return evaluation.review_sessions(sessions, decisions_, gold)


@query(
    "a22_outcomes",
    """SELECT user_id AS session, count(*) AS units, 0 AS unknown, count(*) FILTER (event_type = 'click') AS abstained, count(*) FILTER (event_type = 'purchase') AS correct, count(*) FILTER (event_type NOT IN ('click', 'purchase')) AS wrong,
    count(*) FILTER (event_type = 'purchase' AND event_id % 2 = 1) AS resolved, round(count(*) FILTER (event_type = 'purchase' AND event_id % 2 = 1) / count(*)::DOUBLE, 6) AS per_minute FROM events GROUP BY 1""",
)
def outcomes(spark, folder):
    return _sessions(spark, folder)[0].drop("elapsed_ms", "strategy")


@query(
    "a22_strategies",
    """WITH s AS (SELECT user_id, count(*) FILTER (event_type NOT IN ('click', 'purchase')) AS wrong, round(count(*) FILTER (event_type = 'purchase' AND event_id % 2 = 1) / count(*)::DOUBLE, 6) AS pm FROM events GROUP BY 1)
    SELECT (user_id % 3)::VARCHAR AS strategy, count(*) AS sessions, median(pm) AS median_per_minute, sum(wrong)::BIGINT AS wrong FROM s GROUP BY 1""",
)
def strategies(spark, folder):
    return _sessions(spark, folder)[1]


@query("a28_bootstrap")
def bootstrap(spark, folder):
    rows = T.table(spark, folder, "labels").join(_docs(spark, folder).select("doc_id", "source", "n_chars"), "doc_id").where("quality is not null")
    one = F.lit(1.0)
    return evaluation.bootstrap(rows, "source", "doc_id", {"quality": (F.col("quality"), one), "short": ((F.col("n_chars") < 400).cast("int"), one), "quality - short": (one, one)})


@query("m16_ridge")
def ridge_fit(spark, folder):
    size = T.table(spark, folder, "embeddings").select(F.size("embedding")).first()[0]
    names = [f"x{i}" for i in range(size)]
    rows = T.table(spark, folder, "embeddings").select(F.col("label").cast("double").alias("y"), (F.col("label") % 5).alias("pool"), *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return models.ridge(rows, "y", names, 1.0, "pool")


@query("m16_leave_one_out")
def held_out(spark, folder):
    e = T.table(spark, folder, "events")
    names = ["value", "hour", "even"]
    rows = e.select((F.col("user_id") % 4).cast("string").alias("book"), F.concat_ws(":", "user_id", F.date_trunc("day", "ts")).alias("unit"), (F.col("event_type") == "purchase").cast("double").alias("y"), "value", F.hour("ts").cast("double").alias("hour"), (F.col("event_id") % 2).cast("double").alias("even"))
    return models.leave_one_out(rows, "book", "y", names, unit="unit")


@query(
    "st_accepted",
    """WITH e AS (SELECT event_id % 900 AS id, user_id AS page, event_id % 4 AS span, event_type AS d, ts, event_id FROM events), i AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS k FROM e), f AS (SELECT *, row_number() OVER (PARTITION BY page, span ORDER BY ts, id) AS s, min(d) OVER (PARTITION BY page, span) = max(d) OVER (PARTITION BY page, span) AS same FROM i WHERE k = 1)
    SELECT event_id, CASE WHEN NOT same THEN 'conflict' WHEN s > 1 THEN 'duplicate-span' ELSE 'accepted' END AS status FROM f UNION ALL SELECT event_id, 'duplicate-id' FROM i WHERE k > 1""",
)
def accepted(spark, folder):
    e = T.table(spark, folder, "events").select((F.col("event_id") % 900).alias("id"), F.col("user_id").alias("page"), F.lit("r").alias("row_id"), (F.col("event_id") % 4).alias("start"), F.lit(9).alias("stop"), F.col("event_type").alias("decision"), F.lit("").alias("value"), F.struct("ts", "event_id").alias("ts"), "event_id")
    return feeds.accepted(e).select("event_id", "status")


@query("st_annotated")
def annotated(spark, folder):
    words = _unknown(spark, folder)
    items = words.select("word", F.lit(5).alias("first_page"), (F.length("word") % 2 == 0).alias("peer_conflict"), F.lit(1).alias("review_priority"))
    records = _stats(spark, folder).where("page_df >= 4").select(F.col("term").alias("form"), (F.length("term") % 8).alias("page"), F.when(F.length("term") % 3 == 0, "keep").otherwise("ocr-error").alias("decision"))
    near = lexicon.near_terms(words, records.select(F.col("form").alias("term"), F.lit(1).alias("frequency")), closest=False)
    return feeds.annotated(items, records, near).withColumn("suggestions", F.array_join("suggestions", ","))

