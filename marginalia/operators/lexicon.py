"""Lexicon operators: detection, candidates by deletions and trigrams, context
ranking, review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import text as X
from marginalia.functions.similarity import edit_chunks, osa_distance
from marginalia.sources.settle import settled


def detect(terms: DataFrame, lexicon: DataFrame, protected: DataFrame, short: int = 4) -> DataFrame:
    """``term, reason``: the first reason not to surface a term, null if it is
    surfaced: short-token, protected, dictionary-known, known-hyphen-parts."""
    known = lexicon.select(F.col("term").alias("_k")).distinct()
    kept = protected.select(F.col("term").alias("_p")).distinct()
    base = terms.join(kept, F.col("term") == F.col("_p"), "left").join(known, F.col("term") == F.col("_k"), "left")
    parts = terms.where(F.col("term").contains("-")).select("term", F.explode(F.split("term", "-")).alias("part"))
    parts = parts.join(known, F.col("part") == F.col("_k"), "left").join(kept, F.col("part") == F.col("_p"), "left")
    hyphen = parts.groupBy(F.col("term").alias("_h")).agg(F.bool_and(F.col("_k").isNotNull() | F.col("_p").isNotNull()).alias("whole"))
    joined = base.join(hyphen, F.col("term") == F.col("_h"), "left")
    reason = (
        F.when(F.length("term") < short, "short-token")
        .when(F.col("_p").isNotNull(), "protected")
        .when(F.col("_k").isNotNull(), "dictionary-known")
        .when(F.coalesce("whole", F.lit(False)), "known-hyphen-parts")
    )
    return joined.select("term", reason.alias("reason"))


def _deletions(terms: DataFrame, name: str) -> DataFrame:
    """Each term with itself and every form of one letter less."""
    cut = F.transform(F.sequence(F.lit(1), F.length(name)), lambda i: F.concat(F.substr(name, F.lit(1), i - 1), F.substr(name, i + 1)))
    return terms.withColumn("_form", F.explode(F.array_distinct(F.concat(F.array(F.col(name)), cut))))


def one_edit_pairs(terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Pairs at edit distance one (a swap counts one), found by meeting in a
    deletion and verified; no other pairs are compared."""
    a = _deletions(terms.select("term"), "term")
    b = _deletions(lexicon.select(F.col("term").alias("suggestion"), F.col("count").alias("suggestion_count")), "suggestion")
    met = a.join(b, "_form").where("term <> suggestion and abs(length(term) - length(suggestion)) <= 1").select("term", "suggestion", "suggestion_count").distinct()
    return met.where(X.one_edit(F.col("term"), F.col("suggestion")))


def variants(stats: DataFrame, least: int = 3, times: int = 3, top: int = 5) -> DataFrame:
    """The most frequent near forms of each term: at least ``least`` times,
    and ``times`` as frequent as the term."""
    terms = stats.where(F.length("term") >= 4)
    pairs = one_edit_pairs(terms, terms.where(F.col("count") >= least)).join(terms.select("term", "count"), "term")
    strong = pairs.where(F.col("suggestion_count") >= times * F.col("count"))
    order = Window.partitionBy("term").orderBy(F.desc("suggestion_count"), "suggestion")
    return strong.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("term", "suggestion", "suggestion_count", "rank")


def trigram_candidates(words: DataFrame, lexicon: DataFrame, most: int = 4, top: int = 10) -> DataFrame:
    """Terms that share a letter trigram with a word of six or more letters,
    within ``most`` edits, by trigram Jaccard similarity."""

    def grams(name: str) -> F.Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(name) - 2), lambda i: F.substr(name, i, F.lit(3))))

    a = words.where(F.length("word") >= 6).select("word", grams("word").alias("wg"))
    b = lexicon.where(F.length("term") >= 6).select("term", "count", grams("term").alias("tg"))
    # only sizes travel with the trigrams, and lengths that are too far apart never meet
    left = a.select("word", F.length("word").alias("_n"), F.size("wg").alias("nw"), F.explode("wg").alias("g"))
    right = b.select("term", "count", F.length("term").alias("_m"), F.size("tg").alias("nt"), F.explode("tg").alias("g"))
    met = left.join(right, "g").where((F.abs(F.col("_n") - F.col("_m")) <= most) & (F.col("word") != F.col("term")))
    met = met.groupBy("word", "term", "count", "nw", "nt").agg(F.count("*").alias("common"))
    # an edit touches three trigrams at most
    met = met.where(F.col("common") >= F.greatest("nw", "nt") - 3 * most)
    near = met.withColumn("distance", F.levenshtein("word", "term", most)).where("distance >= 0")
    scored = near.withColumn("jaccard", F.round(F.col("common") / (F.col("nw") + F.col("nt") - F.col("common")), 6))
    order = Window.partitionBy("word").orderBy(F.desc("jaccard"), "distance", F.desc("count"), "term")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("word", "term", "jaccard", "distance", "rank")


def transitions(pairs: DataFrame, zipf: DataFrame, out: DataFrame | None = None) -> DataFrame:
    """Smoothed probability of a word after another in a book: the book's
    count with ten pseudo-counts from all books and the word's frequency.

    ``pairs(source, left, right, n)``, ``zipf(term, p)``; ``out(source, left,
    out)`` are the sums over the right words, where they are at hand."""
    out = pairs.groupBy("source", "left").agg(F.sum("n").alias("out")) if out is None else out
    firsts = out.join(out.groupBy("left").agg(F.sum("out").alias("gout")), "left")
    everywhere = pairs.withColumn("gn", F.sum("n").over(Window.partitionBy("left", "right")))
    joined = everywhere.join(firsts, ["source", "left"]).join(zipf.withColumnRenamed("term", "right"), "right")
    g = 0.9 * F.col("gn") / (F.col("gout") + 1) + 0.1 * F.col("p")
    return joined.select("source", "left", "right", F.round((F.col("n") + 10 * g) / (F.col("out") + 10), 9).alias("p"))


def ranked(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """Suggestions by frequency, distance and confusability; best five."""
    score = F.log(F.greatest(F.col("suggestion_count"), F.lit(1))) - 2 + F.when(X.confusable(F.col("term"), F.col("suggestion")), 2.0).otherwise(0.0)
    scored = pairs.join(stats.select("term", "count"), "term").withColumn("score", F.round(score, 6))
    order = Window.partitionBy("term").orderBy(F.desc("score"), "suggestion")
    return scored.withColumn("rank", F.row_number().over(order)).where("rank <= 5").select("term", "count", "suggestion", "score", "rank")


def review_queue(stats: DataFrame, known_pages: int = 3) -> DataFrame:
    """Surfaced terms with their best suggestions: a term on few pages that is
    one edit from one on at least ``known_pages``.  The statistics are counted
    once: they are used four times."""
    stats = settled(stats)
    lexicon = stats.where(F.col("page_df") >= known_pages)
    reasons = detect(stats.select("term"), lexicon, stats.where("false").select("term"))
    surfaced = reasons.where("reason is null").select("term")
    return ranked(one_edit_pairs(surfaced, lexicon), stats)


def _fewer(forms: F.Column) -> F.Column:
    """Every form of one letter less of each form."""
    one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))
    return F.flatten(F.transform(F.filter(forms, lambda w: F.length(w) > 0), one))


def near_terms(words: DataFrame, lexicon: DataFrame, radius: int = 2, prefix: int = 7, closest: bool = True) -> DataFrame:
    """``word, term, distance, frequency``: lexicon terms within ``radius``
    edits, a swap counting one; the closest of each word, or all.

    Words and terms meet in a form of at most ``radius`` letters less of their
    first ``prefix`` letters and are then compared.  ``words(word)``,
    ``lexicon(term, frequency)``."""

    def forms(df: DataFrame, name: str) -> DataFrame:
        level = F.array(F.substring(name, 1, prefix))
        every = level
        for _ in range(radius):
            level = F.array_distinct(_fewer(level))
            every = F.concat(every, level)
        return df.withColumn("_form", F.explode(F.array_distinct(every)))

    a, b = forms(words.select("word").distinct(), "word"), forms(lexicon.select("term", "frequency"), "term")
    met = a.join(b, "_form").where(F.abs(F.length("word") - F.length("term")) <= radius).select("word", "term", "frequency").distinct()
    met = met.where(F.levenshtein("word", "term", 2 * radius) >= 0)
    found = met.withColumn("distance", F.when(F.col("word") == F.col("term"), 0).otherwise(osa_distance("word", "term"))).where(F.col("distance") <= radius)
    if closest:
        found = found.withColumn("_least", F.min("distance").over(Window.partitionBy("word"))).where("distance = _least").drop("_least")
    return found.select("word", "term", "distance", "frequency")


def compound_splits(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``word, split``: the likeliest cut of a word into two known ones.
    ``words(word)``, ``lexicon(term, frequency)``."""
    cut = words.where(F.length("word") >= 2).select("word", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("i"))
    cut = cut.select("word", F.substr("word", F.lit(1), F.col("i")).alias("a"), F.substr("word", F.col("i") + 1).alias("b"))
    left, right = lexicon.select(F.col("term").alias("a"), F.col("frequency").alias("fa")), lexicon.select(F.col("term").alias("b"), F.col("frequency").alias("fb"))
    found = cut.join(left, "a").join(right, "b")
    best = F.max_by(F.concat_ws(" ", "a", "b"), F.struct((F.col("fa") * F.col("fb")).alias("s"), F.concat_ws(" ", "a", "b")))
    return found.groupBy("word").agg(best.alias("split"))


def _transition(rows: DataFrame, left: str, right: str, pairs: DataFrame, zipf: DataFrame, name: str) -> DataFrame:
    """``rows`` with the smoothed probability of ``right`` after ``left`` in
    the row's source; pairs never seen count 0."""
    own = pairs.select(F.col("source").alias("_ps"), F.col("left").alias("_pl"), F.col("right").alias("_pr"), F.col("n").alias("_pn"))
    out = pairs.groupBy(F.col("source").alias("_os"), F.col("left").alias("_ol")).agg(F.sum("n").alias("_on"))
    every = pairs.groupBy(F.col("left").alias("_gl"), F.col("right").alias("_gr")).agg(F.sum("n").alias("_gn"))
    gout = pairs.groupBy(F.col("left").alias("_hl")).agg(F.sum("n").alias("_hn"))
    prior = zipf.select(F.col("term").alias("_zt"), F.col("zipf").alias("_z"))
    met = rows.join(own, (F.col("source") == F.col("_ps")) & (F.col(left) == F.col("_pl")) & (F.col(right) == F.col("_pr")), "left")
    met = met.join(out, (F.col("source") == F.col("_os")) & (F.col(left) == F.col("_ol")), "left")
    met = met.join(every, (F.col(left) == F.col("_gl")) & (F.col(right) == F.col("_gr")), "left").join(gout, F.col(left) == F.col("_hl"), "left")
    met = met.join(prior, F.col(right) == F.col("_zt"), "left")
    nil = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    general = 0.9 * nil("_gn") / (nil("_hn") + 1) + 0.1 * F.pow(F.lit(10.0), nil("_z") - 9)
    value = F.when(F.col(left).isNotNull() & F.col(right).isNotNull(), (nil("_pn") + 10 * general) / (nil("_on") + 10))
    return met.withColumn(name, value).select(*rows.columns, name)


def ranked_in_context(occurrences: DataFrame, candidates: DataFrame, counts: DataFrame, pairs: DataFrame, zipf: DataFrame, *, language: str = "en", include_known: bool = False) -> DataFrame:
    """``occ_id, word, term, distance, frequency, book_count,
    confusion_supported, score, rank``: candidates of each occurrence by
    frequency, book count and the smoothed transitions from and to the words
    beside it; a confusable letter is worth 2.

    ``occurrences(occ_id, source, word, before, after)``, ``candidates(word,
    term, distance, frequency)``, ``counts(source, term, n)``,
    ``pairs(source, left, right, n)``, ``zipf(term, zipf)``."""
    rows = occurrences.join(candidates, "word")
    book = counts.select(F.col("source").alias("_s"), F.col("term").alias("_t"), F.col("n").alias("_n"))
    rows = rows.join(book, (F.col("source") == F.col("_s")) & (F.col("term") == F.col("_t")), "left").withColumn("book_count", F.coalesce("_n", F.lit(0))).drop("_s", "_t", "_n")
    rows = _transition(_transition(rows, "before", "term", pairs, zipf, "_from"), "term", "after", pairs, zipf, "_to")
    supported = X.confusable(F.col("word"), F.col("term"))
    if language != "en":
        supported = supported | (F.col("distance") == 1)
    beside = lambda c: F.when(F.col(c).isNull(), 0.0).otherwise(F.log(F.greatest(F.col(c), F.lit(1e-15))))
    score = F.log(F.greatest(F.col("frequency").cast("double"), F.lit(1.0))) + 0.5 * F.log1p("book_count") + beside("_from") + beside("_to") + F.when(supported, 2.0).otherwise(0.0)
    if include_known:
        score = score - 2 * F.col("distance")
    scored = rows.withColumn("confusion_supported", supported).withColumn("score", F.round(score, 6))
    order = Window.partitionBy("occ_id").orderBy(F.desc("score"), "term")
    columns = ["occ_id", "word", "term", "distance", "frequency", "book_count", "confusion_supported", "score"]
    return scored.withColumn("rank", F.row_number().over(order)).select(*columns, "rank")


def decided(ranked_: DataFrame, evidence: DataFrame, *, language: str = "en") -> DataFrame:
    """``occ_id, word, term, action, reason`` of the source-faithful cascade.

    The best candidate corrects a word if it is confusable, twice in the book,
    common (Zipf 3; 2 in other languages), the word is once in its row, both
    crop readings are the candidate, and it leads by 1 or the embedded word
    agrees.  ``evidence(occ_id, row_count, readings, embedded, zipf)``: how
    often the row has the word, the crop readings, the embedded word, and the
    Zipf value of the best candidate."""
    order = Window.partitionBy("occ_id").orderBy("rank")
    best = ranked_.withColumn("_next", F.lead("score").over(order)).where("rank = 1").withColumn("margin", F.round(F.col("score") - F.col("_next"), 6))
    rows = best.join(evidence, "occ_id", "left")
    common = F.coalesce(F.col("zipf"), F.lit(0.0)) >= (3 if language == "en" else 2)
    read = F.coalesce((F.size("readings") == 2) & F.forall("readings", lambda r: r == F.col("term")), F.lit(False))
    reason = (
        F.when(~F.col("confusion_supported") | (F.col("book_count") < 2) | ~common, "insufficient-lexical-evidence")
        .when(F.coalesce("row_count", F.lit(0)) != 1, "ambiguous-row-occurrence")
        .when(~read, "crop-does-not-corroborate")
        .when((F.col("margin") < 1) & ~F.coalesce(F.col("embedded") == F.col("term"), F.lit(False)), "weak-context-without-embedded-corroboration")
        .otherwise("context-and-two-crop-readings")
    )
    action = F.when(reason == "context-and-two-crop-readings", "correct").otherwise("review")
    return rows.select("occ_id", "word", "term", "margin", action.alias("action"), reason.alias("reason"))


def origin(before: F.Column, after: F.Column, readings: F.Column) -> F.Column:
    """What two crop readings say about a word: ocr-supported if both are the
    correction, source-reading-supported if both are the word, else
    unresolved."""
    both = lambda w: (F.size(readings) == 2) & F.forall(readings, lambda r: r == F.lower(w))
    return F.when(F.coalesce(both(after), F.lit(False)), "ocr-supported").when(F.coalesce(both(before), F.lit(False)), "source-reading-supported").otherwise("unresolved")


def corrected_readings(candidates: DataFrame, judgments: DataFrame, *, editorial: bool = False) -> DataFrame:
    """``occ_id, word, term, action, route``: the corrected-reading cascade in
    two passes.

    First pass: a valid, common candidate (known, Zipf 3, distance 2) that is
    no meaning-sensitive edit and beats the word's own score is approved by
    ``character`` (a confusable letter), ``crop`` (both readings agree) or
    ``semantic`` evidence (both judgments 0.9).  Second pass: every other
    occurrence of an approved spelling follows it (``approved-spelling``).  An
    edit whose readings support the printed word is made only if ``editorial``.

    ``candidates(occ_id, word, term, distance, zipf, known, capitalised, score,
    own_score, confusion_supported, readings)``: the best candidate of each
    occurrence; ``judgments(occ_id, meaning, grammar)``."""
    rows = candidates.join(judgments, "occ_id", "left").withColumn("origin", origin(F.col("word"), F.col("term"), F.col("readings")))
    valid = F.col("known") & (F.col("zipf") >= 3) & (F.col("distance") <= 2) & ~F.coalesce(X.meaning_sensitive(F.lower("word"), F.col("term")), F.lit(False))
    named = F.coalesce(F.col("capitalised"), F.lit(False)) & (F.col("distance") > 1)
    better = F.col("score") > F.coalesce("own_score", F.lit(float("-inf")))
    judged = F.coalesce((F.col("meaning") >= 0.9) & (F.col("grammar") >= 0.9), F.lit(False))
    route = F.when(~valid | named, None).when(F.col("origin") == "ocr-supported", "crop").when(better & F.col("confusion_supported"), "character").when(better & judged, "semantic")
    first = rows.withColumn("route", route)
    allowed = F.lit(True) if editorial else F.col("origin") != "source-reading-supported"
    approved = first.where(F.col("route").isNotNull() & allowed).select(F.col("word").alias("_w"), F.col("term").alias("_t")).distinct()
    met = first.join(approved, (F.col("word") == F.col("_w")) & (F.col("term") == F.col("_t")), "left")
    final = F.coalesce("route", F.when(F.col("_w").isNotNull() & valid, "approved-spelling"))
    action = F.when(final.isNotNull() & allowed, "correct").when(final.isNotNull(), "editorial-review").otherwise("review")
    return met.select("occ_id", "word", "term", action.alias("action"), final.alias("route"))


def attested_order(suggestions: DataFrame, top: int = 5) -> DataFrame:
    """The best suggestions of each word by (distance, most attested, term)."""
    order = Window.partitionBy("word").orderBy("distance", F.desc("attested"), "term")
    return suggestions.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def review_signals(stats: DataFrame, variants_: DataFrame, proposals: DataFrame) -> DataFrame:
    """``term, review_priority, recommendation``: 0 where the book has near
    variants, 2 where a term is dispersed over it and may be protected, else 1.

    ``stats(term, count, page_df, chapter_df)``, ``variants_(term)``,
    ``proposals(term)`` with the terms that anything is proposed for."""
    near = variants_.select(F.col("term").alias("_v")).distinct()
    other = proposals.select(F.col("term").alias("_p")).distinct()
    rows = stats.join(near, F.col("term") == F.col("_v"), "left").join(other, F.col("term") == F.col("_p"), "left")
    dispersed = (F.col("count") >= 3) & (F.col("page_df") >= 2) & ((F.col("chapter_df") >= 2) | (F.col("page_df") >= 3))
    protect = dispersed & F.col("_v").isNull()
    priority = F.when(F.col("_v").isNotNull(), 0).when(protect & F.col("_p").isNull(), 2).otherwise(1)
    return rows.select("term", priority.alias("review_priority"), F.when(protect, "consider-protecting").otherwise("inspect-spelling").alias("recommendation"))


def feedback_proposals(words: DataFrame, seeds: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``word, term, generators``: what reviewed corrections suggest for other
    words: a reviewed target within two edits, or one changed piece of at most
    three letters carried over to a known word.

    ``words(word)``, ``seeds(seed_id, before, after)``, ``lexicon(term)``."""
    targets = seeds.select(F.col("after").alias("term")).distinct().withColumn("frequency", F.lit(1))
    literal = near_terms(words, targets, closest=False).where("distance > 0").select("word", "term", F.lit("reviewed-lexicon").alias("generator"))
    pieces = seeds.select(edit_chunks("before", "after").alias("c")).where("size(c) = 1").select(F.col("c")[0]["before"].alias("a"), F.col("c")[0]["after"].alias("b"))
    pieces = pieces.where("greatest(length(a), length(b)) <= 3").distinct()
    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda n: F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.struct(i.alias("i"), F.substr("word", i, n).alias("a"), n.alias("n")))))
    held = words.select("word", F.explode(every).alias("s")).select("word", "s.i", "s.a", "s.n").where("length(a) = n")
    carried = held.join(pieces, "a").withColumn("term", F.concat(F.expr("left(word, i - 1)"), "b", F.expr("substr(word, i + n)")))
    known = lexicon.select("term").distinct()
    rewritten = carried.where("term <> word").select("word", "term").distinct().join(known, "term", "left_semi").select("word", "term", F.lit("single-chunk-pattern").alias("generator"))
    return literal.unionByName(rewritten).groupBy("word", "term").agg(F.array_sort(F.collect_set("generator")).alias("generators"))
