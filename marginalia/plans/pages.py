"""Queries over rows of pages: grouping, masks, proposals, seams, links."""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.functions import text as X
from marginalia.operators import lexicon, repair, statistics
from marginalia.plans.shared_sql import LINES, NEAR, STATS, TOKENS
from marginalia.sources import pages as P
from marginalia.sources import tables as T

QUERIES, SQL = {}, {}

_GEO = (
    LINES
    + """, geo AS (SELECT *, (pos + 1) / (n + 2)::DOUBLE AS y0, (pos + 1) / (n + 2)::DOUBLE + 0.5 / (n + 2) AS y1, 0.1 AS x0, 0.1 + least(0.8, length(line) / 100.0) AS x1
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM lines))"""
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


def _stats(spark, folder):
    return statistics.collection_stats(_docs(spark, folder))


@query(
    "s6_word_rows",
    f"""WITH {TOKENS} SELECT doc_id, pos, string_agg(form, ' ' ORDER BY idx) AS text, round(avg(1.0 / length(form)), 6) AS confidence, min(idx)::DOUBLE AS x0, max(idx + 1)::DOUBLE AS x1 FROM tokens GROUP BY 1, 2""",
)
def word_rows(spark, folder):
    words = T.tokens(_docs(spark, folder)).select(
        "doc_id", "pos", "idx", F.col("form").alias("text"), (F.lit(1.0) / F.length("form")).alias("confidence"), F.col("idx").cast("double").alias("x0"), F.lit(0.0).alias("y0"), (F.col("idx") + 1).cast("double").alias("x1"), F.lit(1.0).alias("y1")
    )
    return P.words_to_rows(words, ["doc_id", "pos"], "idx").drop("y0", "y1")


@query(
    "f4_figure_mask",
    f"""WITH {_GEO}, f AS (SELECT doc_id, 0.3 AS y0, 0.6 AS y1 FROM documents WHERE lang = 'en')
    SELECT doc_id, pos FROM geo g WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.doc_id = g.doc_id AND (g.y0 + g.y1) / 2 BETWEEN f.y0 AND f.y1)""",
)
def figure_mask(spark, folder):
    docs = _docs(spark, folder)
    figures = docs.where("lang = 'en'").select("doc_id", F.lit(0.0).alias("x0"), F.lit(0.3).alias("y0"), F.lit(1.0).alias("x1"), F.lit(0.6).alias("y1"))
    return repair.outside(T.geometry(T.lines(docs)), figures, "doc_id").select("doc_id", "pos")






@query(
    "a19_recurring_edits",
    f"""WITH {TOKENS}, e AS (SELECT source AS book, term AS before, replace(term, 'th', 'tb') AS "after" FROM tokens WHERE contains(term, 'th'))
    SELECT before, "after", count(*) AS places, count(DISTINCT book) AS books FROM e GROUP BY 1, 2 HAVING count(*) > 1 AND (count(DISTINCT book) > 1 OR count(*) >= 3)""",
)
def recurring_edits(spark, folder):
    tokens = T.tokens(_docs(spark, folder)).where(F.contains("term", F.lit("th")))
    return repair.recurring(tokens.select(F.col("source").alias("book"), F.col("term").alias("before"), F.replace("term", F.lit("th"), F.lit("tb")).alias("after")))


@query(
    "a9_generators",
    """WITH h AS (SELECT doc_id, list_filter([CASE WHEN n_chars < 400 THEN 'short' END, CASE WHEN contains(text, '###') THEN 'symbols' END, CASE WHEN contains(text, '!!') THEN 'shouting' END, CASE WHEN lang <> 'en' THEN 'foreign' END], lambda x: x IS NOT NULL) AS g FROM documents),
    e AS (SELECT len(g) AS n, unnest(g) AS generator FROM h) SELECT generator, count(*) AS answers, count(*) FILTER (n = 1) AS unique_answers FROM e GROUP BY 1""",
)
def generators(spark, folder):
    found = F.array_compact(
        F.array(F.when(F.col("n_chars") < 400, "short"), F.when(F.contains("text", F.lit("###")), "symbols"), F.when(F.contains("text", F.lit("!!")), "shouting"), F.when(F.col("lang") != "en", "foreign"))
    )
    return repair.contributions(_docs(spark, folder).select(F.col("doc_id").alias("id"), found.alias("generators")))




@query(
    "u4_boundaries",
    f"""WITH {LINES}, p AS (SELECT doc_id, pos, string_split(trim(regexp_replace(line, '\\s+', ' ', 'g')), ' ') AS a, string_split(trim(regexp_replace(replace(line, 'th', 't h'), '\\s+', ' ', 'g')), ' ') AS b FROM lines),
    e AS (SELECT doc_id, pos, list_transform(range(1, len(a) + 1), lambda i: list_sum(list_transform(a[1:i], lambda t: length(t)))) AS a, list_transform(range(1, len(b) + 1), lambda i: list_sum(list_transform(b[1:i], lambda t: length(t)))) AS b FROM p)
    SELECT doc_id, pos, len(list_filter(list_distinct(b), lambda x: NOT list_contains(a, x))) + len(list_filter(list_distinct(a), lambda x: NOT list_contains(b, x))) AS changed FROM e""",
)
def boundaries(spark, folder):
    changed = repair.boundary_changes(F.col("line"), F.replace("line", F.lit("th"), F.lit("t h")))
    return T.lines(_docs(spark, folder)).select("doc_id", "pos", F.size(changed).cast("long").alias("changed"))


@query(
    "w22_nearest_rank",
    f"""WITH {LINES}, l AS (SELECT source, list_sort(list(length(line))) AS v FROM lines GROUP BY 1)
    SELECT source, v[round_even((len(v) - 1) * 0.15, 0)::INT + 1] AS low, v[round_even((len(v) - 1) * 0.85, 0)::INT + 1] AS high FROM l""",
)
def nearest_rank(spark, folder):
    # counts of distinct lengths are gathered, not lines
    counts = T.lines(_docs(spark, folder)).groupBy("source", F.length("line").alias("v")).agg(F.count("*").alias("n"))
    return statistics.counted_rank(counts, "source", "v", "n", {"low": 0.15, "high": 0.85})


@query(
    "f11_confusable",
    f"""WITH {STATS}, pool AS (SELECT term, count FROM stats WHERE length(term) >= 4), {NEAR}, d AS (SELECT term, suggestion, list_filter(range(1, length(term) + 1), lambda i: substr(term, i, 1) <> substr(suggestion, i, 1)) AS d FROM near WHERE length(term) = length(suggestion))
    SELECT term, suggestion FROM d WHERE len(d) = 1 AND array_to_string(list_sort([substr(term, d[1], 1), substr(suggestion, d[1], 1)]), '') IN ('ce', 'ft', 'it', 'il', 'bh', 'nr')""",
)
def confusable(spark, folder):
    pool = _stats(spark, folder).where("length(term) >= 4")
    return lexicon.one_edit_pairs(pool, pool).where(X.confusable(F.col("term"), F.col("suggestion"))).select("term", "suggestion")



@query(
    "t17_spread",
    "SELECT item_id, 3 AS lines, len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '))::BIGINT AS words FROM benchmark",
)
def spread(spark, folder):
    cut = T.table(spark, folder, "benchmark").select("item_id", repair.spread(F.col("text"), F.lit(3)).alias("l"))
    return cut.select("item_id", F.size("l").alias("lines"), F.aggregate(F.transform("l", lambda x: F.size(X.space_tokens(x)).cast("long")), F.lit(0).cast("long"), lambda a, n: a + n).alias("words"))


@query(
    "a23_conditions",
    "SELECT event_type, value > 50 AS high, count(*) AS n, count(*) FILTER (user_id % 2 = 0) AS even FROM events GROUP BY CUBE (event_type, value > 50)",
)
def conditions(spark, folder):
    rows = T.table(spark, folder, "events").select("event_type", (F.col("value") > 50).alias("high"), "user_id")
    return rows.cube("event_type", "high").agg(F.count("*").alias("n"), F.count_if(F.col("user_id") % 2 == 0).alias("even"))
