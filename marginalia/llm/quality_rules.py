"""Quality rules by robust multivariate outliers, in DataFrame operations only.

Every document that passes two base rules becomes a vector of transformed
statistics.  Per language and source a minimum-covariance-determinant estimate
is fitted from three starts by concentration steps: mean and covariance of a
subset, squared Mahalanobis distances of all rows, the closest :data:`COVER`
share of the rows as the next subset, until no determinant falls; the least one
is taken.  A source leans on its language and a language on all, the more
the fewer rows it has.  Rows beyond :data:`CUTOFF` are rejected.

Each step needs two small aggregations over numbers, pre-aggregated before
their shuffle: sums and products per group, and a histogram of distances per
group from which the order statistic is read.  Statistics are held as integers
of 1/10000, so that sums, and with them all verdicts, don't depend on the
order in which partitions arrive.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.native_text import SPACE, space_words, text_hash
from marginalia.llm.storage import free_name, materialize, tidy

#: Share of a group's rows that the estimate rests on.
COVER = 0.6
#: Concentration steps at most (a few reach a fixed point), after how many only
#: the best start of a group goes on, and how much the logarithm of a determinant
#: must fall for another step.
MAX_STEPS, FIRST_STEPS, FALL = 20, 2, 0.01
#: Rows at which a group's estimate counts as much as that one level up; its
#: weight is n**2 / (n**2 + PRIOR_ROWS**2), so a few rows, which can't outvote an
#: outlier among them, count for next to nothing.
PRIOR_ROWS = 100
#: Squared distance beyond which a row is rejected: the chi-square quantile of
#: five degrees of freedom at 1 - 1.5e-7.
CUTOFF = 40.0
#: Consistency factor of covariances from the central 60 % of five dimensions:
#: 0.6 / P(chi2_7 <= q), q being the 0.6 quantile of chi2_5.
CONSISTENCY = 1.685
#: Name, expression and least standard deviation of each statistic.  The least
#: deviation keeps statistics that are constant in clean text, such as symbol
#: counts of zero, from rejecting the first exception.
STATISTICS = [
    ("word length", "ln(word_chars / n_words)", 0.15),
    ("symbols a word", "ln(1 + n_symbols / n_words)", 0.03),
    ("repeated lines", "n_dup_lines / greatest(n_lines, 1)", 0.15),
    ("repeated words", "n_repeat_words / n_words", 0.25),
    ("capitals", "n_upper / word_chars", 0.04),
]
_P = len(STATISTICS)
_UNIT = 10_000
_X = [f"x{i}" for i in range(_P)]
_PAIRS = [(i, j) for i in range(_P) for j in range(i + 1)]


def statistics(docs: DataFrame, *, text: str = "text", key: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts of every whole text, with ``key, lang, source``.

    ``n_repeat_words`` sorts one number per three-word window: its hash with
    the low bits replaced by its place; equal neighbours are repeats."""
    body = F.coalesce(F.col(text), F.lit(""))
    cut = docs.select(
        F.col(key).alias("key"),
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
        F.col(text).alias("text"),
        text_hash(F.col(text)).alias("th"),
        space_words(F.col(text)).alias("w"),
        F.filter(F.split(body, "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACE))) > 0).alias("lines"),
    )
    counted = cut.select(
        "key",
        "lang",
        "source",
        "th",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "w",
        F.expr("cast(ceil(log2(size(w) + 1)) as int)").alias("k"),
    )
    marked = counted.withColumn(
        "marks",
        F.expr(
            "sort_array(transform(if(size(w) < 3, cast(array() as array<int>), sequence(0, size(w) - 3)), i -> "
            "coalesce(shiftleft(shiftrightunsigned(xxhash64(w[i], w[i + 1], w[i + 2]), k), k) | cast(i as bigint), 0L)))"
        ),
    ).drop("w")
    again = marked.withColumn(
        "again",
        F.expr(
            "sort_array(transform(filter(marks, (x, j) -> (j > 0 and shiftrightunsigned(x ^ marks[greatest(j - 1, 0)], k) = 0) or "
            "(j < size(marks) - 1 and shiftrightunsigned(x ^ marks[least(j + 1, size(marks) - 1)], k) = 0)), x -> x & (shiftleft(1L, k) - 1)))"
        ),
    )
    covered = F.aggregate(
        "again",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, i: F.struct((a.n + i + 3 - F.greatest(i, a.upto)).alias("n"), (i + 3).alias("upto")),
        lambda a: a.n,
    )
    return again.select(
        "key", "lang", "source", "th", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"), "n_upper", "n_lines"
    )


def _base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def _grouped(stats: DataFrame) -> DataFrame:
    """``key, g, x0..`` of rows that pass the base rules: the row's source and
    language as groups, and the statistics in 1/10000."""
    return stats.where(~_base_failed()).select(
        "key",
        F.array(F.concat(F.lit("source "), F.to_json(F.struct("lang", "source"))), F.concat(F.lit("lang "), F.to_json(F.struct("lang")))).alias("g"),
        *[F.expr(f"cast(round({e} * {_UNIT}) as bigint)").alias(f"x{i}") for i, (_, e, _) in enumerate(STATISTICS)],
    )


def _quantile(values: DataFrame, share: float, *by: str) -> DataFrame:
    """``by, q``: the least bin that holds the given share of the counts ``n``."""
    counts = values.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*by).orderBy("bin")
    upto = counts.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    return upto.where(F.col("upto") >= F.ceil(F.col("total") * share)).groupBy(*by).agg(F.min("bin").alias("q"))


def _starts(rows: DataFrame) -> DataFrame:
    """``g, start, n, m0.., c0_0..``: three first estimates of each group: the
    mean and covariance of all rows; medians with median deviations, as if
    uncorrelated; and these with the correlations of signs about the medians.

    Medians are read from bins of 1/100; the statistics are logarithms and
    shares, so a group has a few thousand bins whatever its size."""
    long = rows.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.round(F.col(x) / 100).cast("long").alias("bin")) for i, x in enumerate(_X)])).alias("e"))
    bins = materialize(long.select("g", "e.i", "e.bin").groupBy("g", "i", "bin").agg(F.count("*").alias("n")), "bins")
    centre = _quantile(bins, 0.5, "g", "i").withColumnRenamed("q", "m")
    spread = _quantile(bins.join(centre, ["g", "i"]).select("g", "i", F.abs(F.col("bin") - F.col("m")).alias("bin"), "n"), 0.5, "g", "i")
    wide = centre.join(spread, ["g", "i"]).groupBy("g").agg(
        *[F.max(F.when(F.col("i") == i, F.col("m") / 100)).alias(f"m{i}") for i in range(_P)],
        *[F.max(F.when(F.col("i") == i, F.col("q") * 1.4826 / 100)).alias(f"d{i}") for i in range(_P)],
    )
    wide = materialize(wide, "medians")
    away = lambda i: F.signum(F.col(f"x{i}") - F.col(f"m{i}") * _UNIT)
    signs = rows.join(wide, "g").groupBy("g").agg(F.count("*").alias("n"), *[F.avg((away(i) * away(j)).cast("double")).alias(f"q{i}_{j}") for i, j in _PAIRS if i != j])
    both = wide.join(signs, "g")

    def from_medians(name: str, correlated: bool) -> DataFrame:
        def entry(i: int, j: int) -> Column:
            if i == j:
                return F.pow(f"d{i}", F.lit(2))
            return F.sin(F.col(f"q{i}_{j}") * (math.pi / 2)) * F.col(f"d{i}") * F.col(f"d{j}") if correlated else F.lit(0.0)

        return both.select("g", F.lit(name).alias("start"), "n", *[f"m{i}" for i in range(_P)], *[entry(i, j).alias(f"c{i}_{j}") for i, j in _PAIRS])

    whole = _moments(rows, "g").withColumn("start", F.lit("all"))
    return from_medians("medians", False).unionByName(from_medians("signs", True)).unionByName(whole)


def _moments(rows: DataFrame, *by: str) -> DataFrame:
    """``by, n``, mean and covariance from exact integer sums."""
    total = lambda e: F.sum(F.expr(e).cast("decimal(28,0)")).cast("double")
    sums = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        *[total(x).alias(f"s{i}") for i, x in enumerate(_X)],
        *[total(f"x{i} * x{j}").alias(f"s{i}_{j}") for i, j in _PAIRS],
    )
    return sums.select(
        *by,
        "n",
        *[F.expr(f"s{i} / n / {_UNIT}").alias(f"m{i}") for i in range(_P)],
        *[F.expr(f"{CONSISTENCY} * (s{i}_{j} / n - (s{i} / n) * (s{j} / n)) / {_UNIT * _UNIT}").alias(f"c{i}_{j}") for i, j in _PAIRS],
    )


def _factored(estimates: DataFrame) -> DataFrame:
    """``estimates`` with the inverse Cholesky factor ``f`` of each covariance
    and the logarithm ``det`` of its determinant, with the square of the least
    deviation added to its diagonal."""
    out = estimates
    for i in range(_P):
        out = out.withColumn(f"v{i}", F.greatest(F.col(f"c{i}_{i}"), F.lit(0.0)) + STATISTICS[i][2] ** 2)
    for i in range(_P):  # the factor l
        for j in range(i + 1):
            inner = " ".join(f"- l{i}_{k} * l{j}_{k}" for k in range(j))
            value = f"{f'v{i}' if i == j else f'c{i}_{j}'} {inner}"
            least = STATISTICS[i][2] ** 2 / 4
            out = out.withColumn(f"l{i}_{j}", F.expr(f"sqrt(greatest({value}, {least}))" if i == j else f"({value}) / l{j}_{j}"))
    for i in range(_P):  # its inverse f
        for j in range(i + 1):
            inner = " ".join(f"- l{i}_{k} * f{k}_{j}" for k in range(j, i))
            out = out.withColumn(f"f{i}_{j}", F.expr(f"1 / l{i}_{i}" if i == j else f"(0 {inner}) / l{i}_{i}"))
    det = F.expr(" + ".join(f"2 * ln(l{i}_{i})" for i in range(_P)))
    return out.withColumn("det", det).select(*estimates.columns, *[f"f{i}_{j}" for i, j in _PAIRS], "det")


def _distance() -> Column:
    parts = []
    for i in range(_P):
        row = " + ".join(f"f{i}_{j} * (x{j} / {_UNIT} - m{j})" for j in range(i + 1))
        parts.append(f"pow({row}, 2)")
    return F.expr(" + ".join(parts))


def _octave(distance: Column) -> Column:
    """1/16 octaves of the distance between 1e-6 and 1e12: under 1,000 bins."""
    return F.round(F.log2(F.least(distance, F.lit(1e12)) + 1e-6) * 16).cast("long")


def least_determinants(rows: DataFrame) -> DataFrame:
    """``g, start, n, m0.., c0_0.., det``: the minimum-covariance-determinant
    estimate of each group of ``g, x0..``.

    Three starts are concentrated (each step takes the closest :data:`COVER`
    of the rows, whole bins of distance); after :data:`FIRST_STEPS` of a group's
    results that of least determinant goes on, until no determinant of any group
    falls any more."""
    fitted = materialize(_factored(_starts(rows)), "estimates")
    for number in range(1, MAX_STEPS + 1):
        model = fitted.withColumnRenamed("g", "eg").drop("n")
        placed = rows.join(model, F.col("g") == F.col("eg")).select("g", "start", *_X, _octave(_distance()).alias("bin"))
        near = _quantile(placed.groupBy("g", "start", "bin").agg(F.count("*").alias("n")), COVER, "g", "start")
        near = materialize(near.select(F.col("g").alias("ng"), F.col("start").alias("ns"), "q"), "near")
        inside = placed.join(near, (F.col("g") == F.col("ng")) & (F.col("start") == F.col("ns"))).where("bin <= q")
        last = fitted.select(F.col("g").alias("lg"), F.col("start").alias("ls"), F.col("det").alias("was"))
        step = _factored(_moments(inside, "g", "start")).join(last, (F.col("g") == F.col("lg")) & (F.col("start") == F.col("ls"))).drop("lg", "ls")
        if number == FIRST_STEPS:
            columns = [c for c in step.columns if c != "g"]
            step = step.groupBy("g").agg(F.min_by(F.struct(*columns), F.struct("det", "start")).alias("b")).select("g", "b.*")
        fitted = materialize(step, "estimates")
        if number > FIRST_STEPS and fitted.where(F.col("det") < F.col("was") - FALL).isEmpty():
            break
        fitted = fitted.drop("was")
    tidy(rows.sparkSession)
    return fitted


def estimates(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``eg, m0.., f0_0..`` of each source: its own estimate mixed with that of
    its language, and that with the languages' mean, by :data:`PRIOR_ROWS`.
    There is no size at which the rule changes.

    ``rows(g, x0..)`` of all groups, ``sizes(source, lang, n, lang_n)``."""
    fitted = least_determinants(rows)
    numbers = [f"m{i}" for i in range(_P)] + [f"c{i}_{j}" for i, j in _PAIRS]
    named = lambda x: fitted.select(F.col("g").alias(f"{x}g"), *[F.col(c).alias(f"{x}_{c}") for c in numbers])
    share = lambda n: F.pow(n, F.lit(2.0)) / (F.pow(n, F.lit(2.0)) + PRIOR_ROWS**2)
    mixed = lambda own, n, prior: own * share(n) + prior * (1 - share(n))
    languages = sizes.select("lang", "lang_n").distinct().join(named("l"), F.col("lang") == F.col("lg")).withColumn("w", F.col("lang_n") * share(F.col("lang_n")))
    whole = languages.agg(*[(F.sum(F.col(f"l_{c}") * F.col("w")) / F.sum("w")).alias(f"a_{c}") for c in numbers]).withColumn("all", F.lit("all"))
    every = sizes.drop("lang_n").join(languages, "lang").join(named("s"), F.col("source") == F.col("sg")).withColumn("all", F.lit("all")).join(whole, "all")
    language = {c: mixed(F.col(f"l_{c}"), F.col("lang_n"), F.col(f"a_{c}")) for c in numbers}
    final = every.select(F.col("source").alias("eg"), *[mixed(F.col(f"s_{c}"), F.col("n"), language[c]).alias(c) for c in numbers])
    return materialize(_factored(final).drop("det", *[f"c{i}_{j}" for i, j in _PAIRS]), "estimates")


def _judged(docs: DataFrame, *, text: str = "text", key: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """The columns of :func:`judged`, with language, source and a hash of the
    text."""
    stats = statistics(docs, text=text, key=key, lang=lang, source=source)
    stats = materialize(stats.withColumn("row", F.monotonically_increasing_id()), "statistics")
    tidy(docs.sparkSession)
    rows = materialize(_grouped(stats.withColumn("key", F.col("row"))), "rows")
    sizes = rows.groupBy(F.col("g")[0].alias("source"), F.col("g")[1].alias("lang")).agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang")))
    fitted = estimates(rows.select(F.explode("g").alias("g"), *_X), sizes)
    measured = rows.join(fitted, F.col("g")[0] == F.col("eg")).select(F.col("key").alias("r"), _distance().alias("distance"))
    out = stats.join(measured, F.col("row") == F.col("r"), "left")
    return out.select(
        "key",
        "lang",
        "source",
        "th",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        _base_failed().alias("base_failed"),
        (~_base_failed() & F.coalesce(F.col("distance") <= CUTOFF, F.lit(False))).alias("kept"),
        F.round("distance", 6).alias("distance"),
    )


def judged(docs: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """``key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance``: one row per input row.

    ``kept`` is false for rows that fail a base rule (fewer than 50 words, or
    over half of the words in repeated three-word windows) and for rows whose
    squared robust distance exceeds :data:`CUTOFF`.  Null texts have no words
    and fail; null languages and sources are groups like any other; null keys
    and repeated rows are judged as they come, rows of equal statistics alike;
    very long texts are counted whole; other columns are never read; an empty
    table gives no rows.
    """
    return _judged(docs, key=key, **options).drop("lang", "source", "th").withColumnRenamed("key", key)


def keep_good(docs: DataFrame, *, text: str = "text", key: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, each by its own text, language
    and source, whatever other rows have its key."""
    names = [free_name(docs, c) for c in ("bad_key", "bad_lang", "bad_source", "bad_text")]
    bad = _judged(docs, text=text, key=key, lang=lang, source=source).where("not kept")
    bad = bad.select(*[F.col(c).alias(n) for c, n in zip(("key", "lang", "source", "th"), names, strict=True)]).distinct()
    own = (F.col(key), F.col(lang), F.col(source), text_hash(F.col(text)))
    same = reduce(Column.__and__, [c.eqNullSafe(F.col(n)) for c, n in zip(own, names, strict=True)])
    return docs.join(bad, same, "left_anti")
