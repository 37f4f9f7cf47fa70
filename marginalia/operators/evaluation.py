"""Detection, candidate, correction and error-rate reports."""

from __future__ import annotations

from itertools import accumulate
from math import exp, factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import text as X
from marginalia.functions.similarity import seq_ratio, word_edits


def _ratio(a: Column, b: Column) -> Column:
    """Null where the denominator is 0."""
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), 6)


def detection(rows: DataFrame, group: str, error: Column, detected: Column) -> DataFrame:
    """Confusion counts and rates per group and over all (null group)."""
    base = rows.select(group, error.alias("e"), detected.alias("d"))
    counts = base.rollup(group).agg(
        F.count_if(F.col("e") & F.col("d")).alias("tp"),
        F.count_if(~F.col("e") & F.col("d")).alias("fp"),
        F.count_if(~F.col("e") & ~F.col("d")).alias("tn"),
        F.count_if(F.col("e") & ~F.col("d")).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        group,
        "tp",
        "fp",
        "tn",
        "fn",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(1.25 * tp, 1.25 * tp + 0.25 * fn + fp).alias("f05"),
        _ratio(fp, fp + tn).alias("fpr"),
        _ratio(1000 * fp, fp + tn).alias("alarms_per_1000"),
    )


def candidate_recall(units: DataFrame, group: str, ks: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """Recall of ordered candidates; undetected units never hit.

    ``units(group, truth, detected, candidates)`` are errors."""
    hit = F.col("detected") & F.array_contains("candidates", F.col("truth"))
    n, found = F.count("*"), F.count_if("detected")
    return units.groupBy(group).agg(
        n.alias("errors"),
        found.alias("detected"),
        _ratio(F.count_if(hit), n).alias("pool_recall"),
        _ratio(F.count_if(hit), found).alias("conditional_recall"),
        *[_ratio(F.count_if(F.col("detected") & F.array_contains(F.slice("candidates", 1, k), F.col("truth"))), n).alias(f"recall_at_{k}") for k in ks],
        F.round(F.avg(F.when(F.col("detected"), F.size("candidates"))), 6).alias("mean_proposals"),
    )


def correction(units: DataFrame, group: str) -> DataFrame:
    """What changing ``before`` to ``output`` did, against ``truth``."""
    error, changed, right = F.col("before") != F.col("truth"), F.col("before") != F.col("output"), F.col("output") == F.col("truth")
    resolved, damaged = F.count_if(error & right), F.count_if(~error & ~right)
    return units.groupBy(group).agg(
        F.count_if(changed).alias("changed"),
        resolved.alias("resolved"),
        damaged.alias("damaged"),
        F.count_if(error & changed & ~right).alias("wrong_on_error"),
        _ratio(F.count_if(changed & right), F.count_if(changed)).alias("exact_precision"),
        _ratio(resolved, F.count_if(error)).alias("resolution_recall"),
        _ratio(damaged, F.count_if(~error)).alias("damage_rate"),
        (resolved - damaged).alias("net"),
    )


def character_errors(pages: DataFrame, group: str) -> DataFrame:
    """Character error rates before and after, by summed edit distance."""
    totals = pages.groupBy(group).agg(
        F.sum(F.length("truth")).alias("characters"),
        F.sum(F.levenshtein("before", "truth")).alias("edits_before"),
        F.sum(F.levenshtein("output", "truth")).alias("edits_after"),
    )
    return totals.select(
        "*",
        _ratio(F.col("edits_before"), F.col("characters")).alias("cer_before"),
        _ratio(F.col("edits_after"), F.col("characters")).alias("cer_after"),
        _ratio(F.col("edits_before") - F.col("edits_after"), F.col("edits_before")).alias("reduction"),
    )


def text_errors(pages: DataFrame, group: str) -> DataFrame:
    """Character and word error rates before and after, by summed edit
    distances: absolute improvement and share of errors removed.
    ``pages(group, before, output, truth)``."""
    words = lambda c: F.size(X.space_tokens(F.col(c)))
    totals = pages.groupBy(group).agg(
        F.sum(F.length("truth")).alias("characters"),
        F.sum(words("truth")).alias("words"),
        F.sum(F.levenshtein("before", "truth")).alias("edits_before"),
        F.sum(F.levenshtein("output", "truth")).alias("edits_after"),
        F.sum(word_edits("before", "truth")).alias("word_edits_before"),
        F.sum(word_edits("output", "truth")).alias("word_edits_after"),
    )
    rate = lambda a, b: _ratio(F.col(a), F.col(b))
    return totals.select(
        "*",
        rate("edits_before", "characters").alias("cer_before"),
        rate("edits_after", "characters").alias("cer_after"),
        rate("word_edits_before", "words").alias("wer_before"),
        rate("word_edits_after", "words").alias("wer_after"),
        _ratio(F.col("edits_before") - F.col("edits_after"), F.col("characters")).alias("cer_improvement"),
        _ratio(F.col("word_edits_before") - F.col("word_edits_after"), F.col("words")).alias("wer_improvement"),
        _ratio(F.col("edits_before") - F.col("edits_after"), F.col("edits_before")).alias("cer_reduction"),
    )


#: Cumulative probabilities of the Poisson distribution of mean 1, to 2**-53.
_POISSON = list(accumulate(exp(-1) / factorial(k) for k in range(18)))


def _share(*parts: Column) -> Column:
    """A number from 0 to 1 made from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _draws(share: Column) -> Column:
    """How often something is drawn: the Poisson number of a share."""
    out = F.lit(len(_POISSON))
    for n, top in reversed(list(enumerate(_POISSON))):
        out = F.when(share < top, n).otherwise(out)
    return out


def bootstrap(rows: DataFrame, book: str, page: str, values: dict[str, tuple[Column, Column]], replicates: int = 1000, seed: int = 7) -> DataFrame:
    """``metric, replicates, low, high``: 95 % intervals of ratios of sums by
    resampling books, then pages; every metric of a replicate is taken over the
    same draw, so differences of two of them are paired.

    ``values`` maps a metric to numerator and denominator; ``a - b`` names the
    difference of two others.  How often a book, and a page of it, is drawn in a
    replicate is a Poisson number made from a hash of (seed, replicate, book,
    page), the limit of drawing with replacement.  So no group is gathered
    anywhere, each replicate is pre-aggregated before the shuffle, and a run can
    be repeated.  Pages are dealt over all tasks, as a few bytes of them make
    many draws; a hash is a column of its own before it is compared, since
    eighteen copies of it are more than the JVM compiles.  Fewer than two books,
    or a hundred replicates, give no row.
    """
    if replicates < 100:
        raise ValueError("an interval needs a hundred replicates")
    ratios = {n: v for n, v in values.items() if " - " not in n}
    sums = [F.sum(v[k]).cast("double").alias(f"_{i}_{k}") for i, v in enumerate(ratios.values()) for k in (0, 1)]
    spark = rows.sparkSession
    # By other keys than the sums are grouped by, or the planner drops it and joins all pages in one task.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    pages = rows.groupBy(F.col(book).alias("_book"), F.col(page).alias("_page")).agg(*sums)
    names = [f"_{i}_{k}" for i in range(len(ratios)) for k in (0, 1)]
    spread = pages.repartition(tasks, "_page", "_book").select("_book", "_page", *names, F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("r"))
    shares = spread.select("r", *names, _share(F.lit(seed), F.col("r"), F.col("_book")).alias("_of_book"), _share(F.lit(seed + 1), F.col("r"), F.col("_book"), F.col("_page")).alias("_of_page"))
    some = shares.where((F.col("_of_book") >= _POISSON[0]) & (F.col("_of_page") >= _POISSON[0]))
    drawn = some.withColumn("w", _draws(F.col("_of_book")) * _draws(F.col("_of_page"))).groupBy("r").agg(*[F.sum(F.col("w") * F.col(n)).alias(n) for n in names])
    each = {n: F.try_divide(F.col(f"_{i}_0"), F.col(f"_{i}_1")) for i, n in enumerate(ratios)}
    for n in values:
        if " - " in n:
            a, b = n.split(" - ")
            each[n] = each[a] - each[b]
    long = drawn.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), c.alias("m")) for n, c in each.items()])).alias("e")).select("e.*")
    lists = long.where("m is not null").groupBy("metric").agg(F.array_sort(F.collect_list("m")).alias("v"))
    books = pages.agg(F.count_distinct("_book").alias("_books"))
    found = lists.join(books, F.col("_books") >= 2)  # one row
    place = lambda share, f: F.round(F.element_at("v", (f((F.size("v") - 1) * F.lit(share)) + 1).cast("int")), 6)
    return found.select("metric", F.size("v").alias("replicates"), place(0.025, F.floor).alias("low"), place(0.975, F.ceil).alias("high"))


def engine_benchmark(pages: DataFrame, least: float = 0.02) -> DataFrame:
    """``page, engine, characters, lines, agreement, confidence, proposed``:
    how alike an engine's text of a page is to the other engines', and whether
    it leads three or more of them by ``least``.

    ``pages(page, engine, text, lines, confidence)``."""
    other = pages.select(F.col("page").alias("_page"), F.col("engine").alias("_engine"), F.col("text").alias("_text"))
    met = pages.join(other, (F.col("page") == F.col("_page")) & (F.col("engine") != F.col("_engine")))
    means = met.groupBy(F.col("page").alias("_p"), F.col("engine").alias("_e")).agg(F.round(F.avg(seq_ratio("text", "_text")), 4).alias("agreement"))
    rows = pages.join(means, (F.col("page") == F.col("_p")) & (F.col("engine") == F.col("_e")), "left")
    order = Window.partitionBy("page").orderBy(F.desc("agreement"), "engine")
    ranked = rows.withColumn("_k", F.row_number().over(order)).withColumn("_n", F.count("agreement").over(Window.partitionBy("page"))).withColumn("_next", F.lead("agreement").over(order))
    proposed = (F.col("_k") == 1) & (F.col("_n") >= 3) & (F.round(F.col("agreement") - F.col("_next"), 4) >= least)
    return ranked.select("page", "engine", F.length("text").alias("characters"), "lines", "agreement", F.round("confidence", 4).alias("confidence"), F.coalesce(proposed, F.lit(False)).alias("proposed"))


def review_sessions(sessions: DataFrame, decisions: DataFrame, gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Outcomes per session, and per strategy: sessions, the median of correct
    errors a minute, wrong decisions.

    A decision without a replacement abstains; one is correct if it is the
    truth, and resolves an error if the word was not.  Decisions on unknown
    units count as ``unknown``.  ``sessions(session, strategy, elapsed_ms)``,
    ``decisions(session, id, replacement)``, ``gold(id, before, truth)``."""
    met = decisions.join(gold, "id", "left")
    right = F.col("replacement") == F.col("truth")
    known = F.col("truth").isNotNull()
    counts = met.groupBy("session").agg(
        F.count("*").alias("units"),
        F.count_if(~known).alias("unknown"),
        F.count_if(known & F.col("replacement").isNull()).alias("abstained"),
        F.count_if(right).alias("correct"),
        F.count_if(known & F.col("replacement").isNotNull() & ~right).alias("wrong"),
        F.count_if(right & (F.col("before") != F.col("truth"))).alias("resolved"),
    )
    each = sessions.join(counts, "session").withColumn("per_minute", F.round(F.try_divide(F.col("resolved") * 60000.0, F.col("elapsed_ms")), 6))
    by = each.groupBy("strategy").agg(F.count("*").alias("sessions"), F.median("per_minute").alias("median_per_minute"), F.sum("wrong").alias("wrong"))
    return each, by
