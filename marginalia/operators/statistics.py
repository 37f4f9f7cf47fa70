"""Term statistics, n-gram counts, robust statistics and glossary terms."""

from __future__ import annotations

from statistics import median

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.similarity import edit_chunks
from marginalia.sources import tables

#: Words that open a run of capitals without belonging to it (fixed values).
OPENERS = ["from", "the", "a", "an", "in", "on", "at", "by", "for", "and", "of", "to", "with", "after", "before", "see", "as"]


def term_stats(tokens: DataFrame, chapters: int | None = None) -> DataFrame:
    """Counts and document frequencies of terms over a collection.

    ``tokens(term, source, doc_id, pos)``; chapters are sources, pages are
    documents, blocks are lines.  Counts are rolled up level by level, so each
    shuffle carries pre-aggregated rows only.  ``chapters`` is the number of
    sources with a term, where it is at hand.
    """
    chapters = tokens.select("source").distinct().count() if chapters is None else chapters
    page = tokens.groupBy("term", "source", "doc_id").agg(F.count("*").alias("n"), F.count_distinct("pos").alias("blocks"))
    chapter = page.groupBy("term", "source").agg(F.sum("n").alias("n"), F.sum("blocks").alias("blocks"), F.count("*").alias("pages"))
    whole = chapter.groupBy("term").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("chapter_df"),
        F.sum("pages").alias("page_df"),
        F.sum("blocks").alias("block_df"),
        F.max("n").alias("max_tf"),
    )
    idf = F.log(F.lit(float(chapters + 1)) / (F.col("chapter_df") + 1)) + 1
    return whole.withColumn("idf", F.round(idf, 6)).withColumn("max_tfidf", F.round((1 + F.log("max_tf")) * idf, 6)).drop("max_tf")


def collection_stats(docs: DataFrame) -> DataFrame:
    """:func:`term_stats` of whole documents: they are dealt once, and words
    are counted in place.  Sources are those of texts with a letter."""
    chapters = docs.where(F.col("text").rlike(r"\p{L}")).select("source").distinct().count()
    return term_stats(tables.tokens(tables.dealt(docs)), chapters)


def enrichment(tokens: DataFrame, by: str) -> DataFrame:
    """log10 of a term's count in a group against its share in all others."""
    counts = tokens.groupBy(by, "term").agg(F.count("*").alias("n"))
    groups = counts.groupBy(by).agg(F.sum("n").alias("group_total"))
    terms = counts.groupBy("term").agg(F.sum("n").alias("everywhere"))
    total = tokens.count()
    joined = counts.join(terms, "term").join(groups, by)
    share = F.try_divide(F.col("everywhere") - F.col("n"), (F.lit(total) - F.col("group_total")).cast("double"))
    value = F.log10((F.col("n") + 0.5) / (F.col("group_total") * F.coalesce(share, F.lit(0.0)) + 0.5))
    return joined.select(by, "term", F.col("n").alias("count"), F.round(value, 6).alias("log10_enrichment"))


def grams(tokens: DataFrame, by: list[str], order: str, gap: int = 1) -> DataFrame:
    """Counts of word pairs ``gap`` places apart within ``by``, per source."""
    ahead = F.lead("term", gap).over(Window.partitionBy(*by).orderBy(order))
    pairs = tokens.withColumn("right", ahead).where(F.col("right").isNotNull())
    return pairs.groupBy("source", F.col("term").alias("left"), "right").agg(F.count("*").alias("n"))


def char_model(terms: DataFrame) -> DataFrame:
    """Add-one character-trigram log probability per letter of each term.

    ``terms(term, count)``; a term is padded ``^^term$``."""
    padded = terms.select("term", "count", F.concat(F.lit("^^"), "term", F.lit("$")).alias("p"))
    cut = padded.select("term", "count", F.posexplode(F.transform(F.sequence(F.lit(1), F.length("p") - 2), lambda i: F.substr("p", i, F.lit(3)))).alias("i", "gram"))
    counts = cut.groupBy("gram").agg(F.sum("count").alias("n"))
    contexts = counts.groupBy(F.substring("gram", 1, 2).alias("context")).agg(F.sum("n").alias("total"))
    alphabet = counts.select(F.substring("gram", 3, 1).alias("c")).distinct().count() + 1
    model = counts.join(contexts, F.substring("gram", 1, 2) == F.col("context")).select("gram", F.log((F.col("n") + 1) / (F.col("total") + alphabet)).alias("lp"))
    scored = cut.select("term", "gram").join(model, "gram").groupBy("term").agg(F.sum("lp").alias("lp"))
    return scored.select("term", F.round(F.col("lp") / (F.length("term") + 1), 6).alias("score"))


def median_mad(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """``by, n, med, mad``: median and median absolute deviation."""
    rows = df.select(*by, value.alias("v"))
    centre = rows.groupBy(*by).agg(F.count("*").alias("n"), F.median("v").alias("med"))
    spread = rows.join(centre, by).groupBy(*by).agg(F.median(F.abs(F.col("v") - F.col("med"))).alias("mad"))
    return centre.join(spread, by)


def nearest_rank(values: Column, share: float) -> Column:
    """The element at place round((n - 1) share), half to even, of the sorted
    array; null for an empty one."""
    at = F.bround((F.size(values) - 1) * F.lit(share)).cast("int") + 1
    return F.when(F.size(values) > 0, F.try_element_at(F.array_sort(values), at))


def counted_rank(counts: DataFrame, by: str, value: str, n: str, shares: dict[str, float]) -> DataFrame:
    """Nearest-rank quantiles per group from counts of distinct values."""
    order = Window.partitionBy(by).orderBy(value)
    upto = counts.withColumn("_upto", F.sum(n).over(order)).withColumn("_total", F.sum(n).over(Window.partitionBy(by)))
    reached = {name: F.min(F.when(F.col("_upto") > F.bround((F.col("_total") - 1) * F.lit(share)), F.col(value))) for name, share in shares.items()}
    return upto.groupBy(by).agg(*[e.alias(name) for name, e in reached.items()])


def glossary(tokens: DataFrame, least: int = 3) -> DataFrame:
    """Capitalised recurring terms that never occur in lower case and at least
    once inside a line."""
    counted = tokens.groupBy("term").agg(
        F.count("*").alias("count"),
        F.count_if(F.col("form") == F.col("term")).alias("lower"),
        F.count_if(F.col("idx") > 0).alias("inner"),
        F.min_by("form", F.struct("doc_id", "pos", "idx")).alias("form"),
    )
    return counted.where((F.col("count") >= least) & (F.col("lower") == 0) & (F.col("inner") > 0)).select("term", "form", "count", "inner")


def theil_sen(df: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """Median of the slopes of all pairs of points per group."""
    w = Window.partitionBy(by).orderBy(x)
    rows = df.select(by, F.col(x).alias("x"), F.col(y).alias("y"), F.row_number().over(w).alias("k"))
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b, (F.col(f"a.{by}") == F.col(f"b.{by}")) & (F.col("a.k") < F.col("b.k")))
    slopes = pairs.select(F.col(f"a.{by}").alias(by), "a.x", "a.y", F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))
    slope = (F.col("y2") - F.col("y")) / (F.col("x2") - F.col("x")).cast("double")
    return slopes.where("x2 <> x").groupBy(by).agg(F.round(F.median(slope), 6).alias("slope"), F.count("*").alias("pairs"))


def term_maps(tokens: DataFrame, excluded: Column | None = None) -> DataFrame:
    """``term, forms, chapter_counts, reference_count``: how often a term is
    written in each form and occurs in each chapter; tokens of excluded
    (reference) chapters are only counted apart."""
    rows = tokens.withColumn("_out", excluded if excluded is not None else F.lit(False))
    forms = rows.where("not _out").groupBy("term", "form").agg(F.count("*").alias("n")).groupBy("term").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("form", "n")))).alias("forms"))
    chapters = rows.where("not _out").groupBy("term", "source").agg(F.count("*").alias("n")).groupBy("term").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("chapter_counts"))
    apart = rows.where("_out").groupBy("term").agg(F.count("*").alias("reference_count"))
    return forms.join(chapters, "term", "full_outer").join(apart, "term", "full_outer").withColumn("reference_count", F.coalesce("reference_count", F.lit(0).cast("long")))


def error_model(pairs: DataFrame) -> DataFrame:
    """``target, observed, count, opportunities, cost`` of the directed changes
    of at most three characters that turn targets into what was read.

    Cost is -ln of the smoothed share of a piece's chances in which it was
    misread, over ln 1000.  ``pairs(observed, target)``; repeated pairs count
    once.  Pieces and targets meet by substrings, not all with all."""
    rows = pairs.select("observed", "target").distinct()
    changed = rows.select(F.explode(edit_chunks("target", "observed")).alias("c")).select(F.col("c.before").alias("a"), F.col("c.after").alias("b"))
    rules = changed.where("greatest(length(a), length(b)) <= 3").groupBy("a", "b").agg(F.count("*").alias("count"))
    words = rows.groupBy(F.col("target").alias("w")).agg(F.count("*").alias("times"))
    every = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.substr("w", i, n))))
    held = words.select("w", "times", F.explode(F.array_distinct(every)).alias("a")).join(rules.select("a").distinct(), "a")
    found = held.select("a", (F.expr("(length(w) - length(replace(w, a, ''))) div length(a)") * F.col("times")).alias("n")).groupBy("a").agg(F.sum("n").alias("n"))
    spaces = words.agg(F.sum((F.length("w") + 1) * F.col("times")).alias("n")).select(F.lit("").alias("a"), "n")
    chances = found.where("a <> ''").unionByName(spaces)
    met = rules.join(chances, "a")
    cost = -F.log(F.least(F.lit(1.0), (F.col("count") + 0.5) / (F.col("n") + 1))) / F.log(F.lit(1000.0))
    return met.select(F.col("a").alias("target"), F.col("b").alias("observed"), "count", F.col("n").cast("long").alias("opportunities"), F.round(cost, 9).alias("cost"))


def inverse_variants(observed: str, costs: dict[tuple[str, str], float], budget: int = 2, beam: int = 64) -> dict[str, float]:
    """What may have been printed, with the least cost: at most ``budget``
    pieces changed back, the best ``beam`` kept each time."""
    best = {observed: 0.0}
    front = dict(best)
    for _ in range(budget):
        new: dict[str, float] = {}
        for word, score in front.items():
            for (target, read), cost in costs.items():
                at = -1
                while (at := word.find(read, at + 1)) >= 0:
                    other, total = word[:at] + target + word[at + len(read) :], score + cost
                    if total < best.get(other, float("inf")):
                        new[other] = min(total, new.get(other, float("inf")))
        front = dict(sorted(new.items(), key=lambda x: (x[1], x[0]))[:beam])
        best |= front
    return best


def repeated_edits(cases: DataFrame) -> DataFrame:
    """``book, target, observed, members, exposed``: the same single change of
    at most three characters in two or more cases of a book, and how many
    correct words a blanket rewrite would touch.

    ``cases(book, id, expected, before, after)``, expected ``correct`` or
    ``retain``."""
    wrong = cases.where("expected = 'correct'").select("book", "id", edit_chunks("after", "before").alias("c")).where("size(c) = 1")
    rules = wrong.select("book", "id", F.col("c")[0]["before"].alias("target"), F.col("c")[0]["after"].alias("observed")).where("greatest(length(target), length(observed)) <= 3")
    groups = rules.groupBy("book", "target", "observed").agg(F.count("*").alias("members")).where("members >= 2")
    right = cases.where("expected = 'retain'").select(F.col("book").alias("_b"), F.col("id").alias("_id"), F.col("before").alias("_w"))
    met = groups.join(right, (F.col("book") == F.col("_b")) & F.contains("_w", F.col("observed")), "left")
    return met.groupBy("book", "target", "observed", "members").agg(F.count("_id").alias("exposed"))


def fitted_edge(points: list[tuple[float, float]], share: float) -> tuple[float, float, float, int] | None:
    """``(slope, intercept, median error, inliers)`` of a page's edge over
    points (y, x): the median slope, an intercept at a nearest-rank share of the
    residuals, and both once more over what is within 0.008; none over less than
    a quarter of the page, under eight points, at a slope over 0.12 or an error
    over 0.004."""

    def slope_of(rows: list[tuple[float, float]]) -> float:
        slopes = [(b[1] - a[1]) / (b[0] - a[0]) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[0] != b[0]]
        return median(slopes) if slopes else 0.0

    def tall(rows: list[tuple[float, float]]) -> bool:
        return bool(rows) and max(r[0] for r in rows) - min(r[0] for r in rows) >= 0.25

    if not tall(points):
        return None
    slope = slope_of(points)
    rest = sorted(x - slope * y for y, x in points)
    intercept = rest[round((len(rest) - 1) * share)]
    inside = [(y, x) for y, x in points if abs(x - slope * y - intercept) < 0.008]
    if len(inside) < 8 or not tall(inside):
        return None
    slope = slope_of(inside)
    intercept = median(x - slope * y for y, x in inside)
    error = median(abs(x - slope * y - intercept) for y, x in inside)
    return None if abs(slope) > 0.12 or error > 0.004 else (slope, intercept, error, len(inside))


def fitted_edges(rows: DataFrame, by: str, share: float = 0.15) -> DataFrame:
    """``by, slope, intercept, error, inliers`` of the left edges of pages that
    have one.  ``rows(by, y0, x0)``; pages are gathered in the JVM."""

    @F.pandas_udf("struct<slope: double, intercept: double, error: double, inliers: bigint>")
    def fit(ys: pd.Series, xs: pd.Series) -> pd.DataFrame:
        found = [fitted_edge(list(zip(y, x, strict=True)), share) for y, x in zip(ys, xs, strict=True)]
        return pd.DataFrame([f or (None,) * 4 for f in found], columns=["slope", "intercept", "error", "inliers"]).astype({"inliers": "Int64"})

    pages = rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col("y0").cast("double").alias("y"), F.col("x0").cast("double").alias("x")))).alias("p"))
    found = pages.select(by, fit(F.transform("p", lambda p: p["y"]), F.transform("p", lambda p: p["x"])).alias("f"))
    return found.where("f.slope is not null").select(by, "f.*")


def glossary_phrases(sentences: DataFrame, least: int = 3, top: int = 40) -> DataFrame:
    """``term, count, example``: runs of two or three capitalised words seen
    ``least`` times, at least once inside a sentence.

    ``sentences(doc_id, seq, sentence)``.  A run at the start of a sentence
    loses its first word, and openers such as prepositions go."""
    run = r"(?<![\p{L}\p{N}_’'-])(\p{Lu}[\p{L}\p{N}_’'-]+(?:\s+\p{Lu}[\p{L}\p{N}_’'-]+){1,3})(?![\p{L}\p{N}_’'-])"
    found = sentences.select("doc_id", "seq", "sentence", F.explode(F.regexp_extract_all("sentence", F.lit(run), 1)).alias("run"))
    first = F.startswith(F.ltrim("sentence"), F.col("run"))
    words = F.split("run", r"\s+")
    rest = F.when(first, F.slice(words, 2, 10)).otherwise(words)
    cut = found.withColumn("_r", rest)
    cut = cut.withColumn("_n", F.aggregate("_r", F.struct(F.lit(0).alias("n"), F.lit(False).alias("done")), lambda a, w: F.struct(F.when(a["done"] | ~F.lower(w).isin(OPENERS), a["n"]).otherwise(a["n"] + 1).alias("n"), (a["done"] | ~F.lower(w).isin(OPENERS)).alias("done")), lambda a: a["n"]))
    cut = cut.withColumn("_w", F.slice("_r", F.col("_n") + 1, 10))
    kept = cut.where(F.size("_w").between(2, 3) & ~F.exists("_w", lambda w: F.upper(w) == w)).withColumn("term", F.regexp_replace(F.array_join("_w", " "), r"['’]s$", ""))
    counts = kept.groupBy("term").agg(
        F.count("*").alias("count"), F.count_if(~F.startswith(F.col("sentence"), F.col("run"))).alias("_inner"), F.min_by(F.substring(F.trim("sentence"), 1, 200), F.struct("doc_id", "seq")).alias("example")
    )
    return counts.where((F.col("count") >= least) & (F.col("_inner") > 0)).orderBy(F.desc("count"), "term").limit(top).drop("_inner")
