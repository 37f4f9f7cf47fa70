"""Proposals and repairs: margins, headings, seams, case, quotes, links."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions import text as X
from marginalia.functions.similarity import WORD
from marginalia.operators.punctuation import paired
from marginalia.operators.windows import ranked


def outside(rows: DataFrame, figures: DataFrame, by: str) -> DataFrame:
    """Rows whose centre is in no figure of the same page."""
    f = figures.select(F.col(by).alias("_by"), *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    inside = (F.col(by) == F.col("_by")) & x.between(F.col("_x0"), F.col("_x1")) & y.between(F.col("_y0"), F.col("_y1"))
    return rows.join(f, inside, "left_anti")


def page_labels(rows: DataFrame) -> DataFrame:
    """Margin rows that are a number of up to four digits or a Roman one."""
    text = F.trim("line")
    return rows.where(((F.col("y0") > 0.88) | (F.col("y1") < 0.075)) & (text.rlike(r"^\d{1,4}$") | text.rlike(r"^[ivxlcdmIVXLCDM]{1,8}$")))


def heading(text: Column, y: Column, centre: Column | None = None) -> Column:
    """A short, centred row in the upper half with a heading's cue."""
    cue = text.rlike(r"^(?i)(chapter|part|book|section)\b") | text.rlike(r"^[IVXLCDM]+[. ]") | ((F.upper(text) == text) & (F.length(F.regexp_replace(text, r"[^\p{L}]", "")) >= 5))
    found = (y > 0.07) & (y < 0.55) & F.length(text).between(3, 85) & cue
    return found if centre is None else found & centre.between(0.25, 0.75)


def seams(lines: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Words broken over two lines: the last word of a line and the first of
    the next are unknown and known when joined.

    ``lines(doc_id, pos, line)``, ``lexicon(term)``."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    words = lines.select("doc_id", "pos", X.tokens(F.lower("line")).alias("t"))
    ends = words.withColumn("n", F.lead("t").over(w)).where("size(t) > 0 and size(n) > 0").select("doc_id", "pos", F.element_at("t", -1).alias("a"), F.element_at("n", 1).alias("b"))
    known = lexicon.select("term")
    for column, kind in (("a", "left_anti"), ("b", "left_anti")):
        ends = ends.join(known, F.col(column) == F.col("term"), kind)
    return ends.withColumn("joined", F.concat("a", "b")).join(known, F.col("joined") == F.col("term"), "left_semi")


def case_repairs(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Words with a capital inside whose lower-case form is known."""
    mixed = tokens.where(F.col("form").rlike(r"^\p{L}*\p{Ll}\p{Lu}\p{L}*$"))
    return mixed.join(lexicon.select("term"), "term", "left_semi").select("doc_id", "pos", "idx", "form", F.col("term").alias("repaired"))


def recurring(edits: DataFrame) -> DataFrame:
    """Edits seen at more than one place, in more than one book or three
    times.  ``edits(book, place, before, after)``."""
    counts = edits.groupBy("before", "after").agg(F.count("*").alias("places"), F.count_distinct("book").alias("books"))
    return counts.where("places > 1 and (books > 1 or places >= 3)")


def contributions(hits: DataFrame) -> DataFrame:
    """Answers per generator, and those that no other gave.
    ``hits(id, generators)``."""
    each = hits.select("id", F.size("generators").alias("n"), F.explode("generators").alias("generator"))
    return each.groupBy("generator").agg(F.count("*").alias("answers"), F.count_if(F.col("n") == 1).alias("unique_answers"))


def worst_share(rows: DataFrame, by: str, score: str, key: str, share: float, width: int = 64) -> DataFrame:
    """The ``max(1, int(n share))`` rows of each group of lowest score, ties by
    key; places are counted within ranges of the score."""
    numbered = ranked(rows, by, [score, key], F.floor(F.col(score) / width))
    return numbered.where(F.col("_k") <= F.greatest(F.lit(1), F.floor(F.col("_n") * share))).drop("_k", "_n")


def linked(notes: DataFrame, calls: DataFrame, key: list[str]) -> DataFrame:
    """Notes with their one call, or the reason there is none."""
    counts = calls.groupBy(*key).agg(F.count("*").alias("calls"), F.min("call_id").alias("call_id"))
    joined = notes.join(counts, key, "left")
    reason = F.when(F.col("calls").isNull(), "no-call").when(F.col("calls") > 1, "ambiguous").otherwise("linked")
    return joined.withColumn("reason", reason).withColumn("call_id", F.when(reason == "linked", F.col("call_id")))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _ends_apart(before: pd.Series, after: pd.Series) -> pd.Series:
    """Running sums of one list but not of both; Catalyst has none that takes
    one pass over a row."""
    return pd.Series([None if a is None or b is None else sorted(set(accumulate(map(int, a))) ^ set(accumulate(map(int, b)))) for a, b in zip(before, after, strict=True)], dtype=object)


def boundary_changes(before: Column, after: Column) -> Column:
    """Offsets, counted without spaces, of word ends in one but not both."""
    sizes = lambda c: F.transform(F.split(X.collapse(c), " "), lambda t: F.length(t))
    return _ends_apart(sizes(before), sizes(after))


def spread(text: Column, n: Column) -> Column:
    """Words of a text over ``n`` lines, as evenly as whole words allow."""
    words = X.space_tokens(text)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_join(F.slice(words, F.floor(i * F.size(words) / n).cast("int") + 1, (F.floor((i + 1) * F.size(words) / n) - F.floor(i * F.size(words) / n)).cast("int")), " "))


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("unresolved", T.ArrayType(T.StructType([T.StructField("offset", T.IntegerType()), T.StructField("reason", T.StringType())])))]))
def normalized_quotes(text: pd.Series) -> pd.DataFrame:
    """Text with its paired quotes normalised, and the marks left for review."""
    done = [(None, None) if t is None else (lambda r: (r[0], [{"offset": o, "reason": why} for o, why in r[1]]))(paired(t)) for t in text]
    return pd.DataFrame(done, columns=["text", "unresolved"])


def masked(rows: DataFrame, figures: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """Rows outside all figures, and an audit of those that went."""
    kept = outside(rows, figures, by)
    return kept, rows.join(kept.select(by, "pos"), [by, "pos"], "left_anti").withColumn("kind", F.lit("figure-text"))


#: A word before and after a line's end.
_LEFT, _RIGHT = r"(\p{L}+)([^\p{L}\p{N}\s]*)\s*$", r"^\s*([^\p{L}\p{N}\s]*)(\p{L}+)"


def seam_candidates(rows: DataFrame, lexicon: DataFrame, protected: DataFrame, *, by: str = "page") -> DataFrame:
    """``by, row, first, second, joined, kind``: words that may be broken over
    two lines.

    The lines follow each other in one column by at most 2.5 line heights, the
    first ends near the right margin of the lines around it and the second
    starts near the left one.  Protected words, known compounds, ordinary words
    without a mark between them and finished sentences are left alone; mixed
    alphabets and a capital end of a small word are looked at in any case.
    ``rows(by, row, col, text, x0, y0, x1, y1)``, ``lexicon(term, count)``,
    ``protected(term)``."""
    w = Window.partitionBy(by, "col").orderBy("y0", "row")
    near = w.rowsBetween(-3, 3)
    ahead = {c: F.lead(c).over(w).alias(f"b_{c}") for c in ("text", "x0", "y0", "x1", "y1")}
    lines = rows.select("*", *ahead.values(), F.min("x0").over(near).alias("_left"), F.max("x1").over(near).alias("_right")).where("b_text is not null")
    height = F.greatest(F.col("y1") - F.col("y0"), F.col("b_y1") - F.col("b_y0"))
    advance = (F.col("b_y0") + F.col("b_y1") - F.col("y0") - F.col("y1")) / 2
    placed = lines.where((advance > 0) & (advance <= 2.5 * height) & (F.col("x1") >= F.col("_right") - 0.05) & (F.col("b_x0") <= F.col("_left") + 0.04))
    cut = placed.select(by, "row", F.regexp_extract("text", _LEFT, 1).alias("first"), F.regexp_extract("text", _LEFT, 2).alias("mark"), F.regexp_extract("b_text", _RIGHT, 2).alias("second"))
    cut = cut.where("first <> '' and second <> ''").withColumn("joined", F.lower(F.concat("first", "second"))).withColumn("_compound", F.lower(F.concat_ws("-", "first", "second")))
    guarded = protected.select(F.lower("term").alias("_p")).distinct()
    for column in ("first", "second"):
        cut = cut.join(guarded, F.lower(column) == F.col("_p"), "left_anti")
    known = lexicon.select("term", "count").where("count >= 2")
    cut = cut.join(known.select(F.col("term").alias("_c")), F.col("_compound") == F.col("_c"), "left_anti")
    for column, name in (("first", "_f"), ("second", "_s"), ("joined", "_j")):
        cut = cut.join(known.select(F.col("term").alias(name)), F.lower(column) == F.col(name), "left")
    both = F.concat("first", "second")
    mixed = both.rlike(r"\p{IsLatin}") & both.rlike(r"\p{IsCyrillic}")
    case = (F.length("first") >= 3) & (F.lower("first") == F.col("first")) & (F.length("second") >= 2) & (F.upper("second") == F.col("second")) & (F.lower("second") != F.col("second"))
    ordinary = (F.col("mark") == "") & (F.col("_s").isNotNull() | (F.length("first") > 3) | (F.col("_f").isNotNull() & (F.length("first") > 1)))
    exact = F.col("_s").isNull() & F.col("_j").isNotNull()
    ended = F.contains("mark", F.lit(".")) & F.col("_f").isNotNull() & ~exact
    kind = F.when(mixed, "mixed-script").when(case, "case-mismatch").when(ordinary | ended, None).when(F.col("_j").isNotNull(), "exact-join").otherwise("unknown-join")
    return cut.withColumn("kind", kind).where("kind is not null").select(by, "row", "first", "second", "joined", "kind")


def aligned_word(text: str, witness: str, index: int) -> str | None:
    """The witness's word at a word's place: four fifths alike, two equal words
    beside it, and more of them than any other."""
    own, other = [m[0].lower() for m in WORD.finditer(text)], [m[0] for m in WORD.finditer(witness)]
    low, found = [w.lower() for w in other], []
    for j, word in enumerate(low):
        held = sum(0 <= index + d < len(own) and 0 <= j + d < len(low) and own[index + d] == low[j + d] for d in (-2, -1, 1, 2))
        if held >= 2 and SequenceMatcher(None, own[index], word).ratio() >= 0.8:  # few words have equal neighbours
            found.append((held, other[j]))
    found.sort(reverse=True)
    return found[0][1] if found and (len(found) == 1 or found[0][0] > found[1][0]) else None


def case_decisions(rows: DataFrame, witnesses: tuple[str, str], lexicon: DataFrame, protected: DataFrame, letters: str = "А-Яа-яЁё") -> DataFrame:
    """``row_id, start, word, target, action, reason``: words with a capital
    inside, or with one in the middle of a row, against two other readings.

    Both must read the same lower-case known word there, at most one letter
    off.  ``rows(row_id, text, <witnesses>)``, ``lexicon(term)``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, text, one, two in frame[["row_id", "text", *witnesses]].itertuples(index=False):
                for i, m in enumerate(WORD.finditer(text or "")):
                    word = m[0]
                    inside = word[0].islower() and any(c.isupper() for c in word)
                    middle = word.istitle() and bool(re.search(r"\w\s+$", text[: m.start()]))
                    if len(word) >= 4 and re.fullmatch(f"[{letters}]+", word) and (inside or middle):
                        out.append((key, m.start(), word, inside, *(aligned_word(text, w, i) if w else None for w in (one, two))))
            yield pd.DataFrame(out, columns=["row_id", "start", "word", "inside", "one", "two"])

    found = rows.select("row_id", "text", *witnesses).mapInPandas(run, "row_id string, start int, word string, inside boolean, one string, two string")
    known = lexicon.select("term").distinct()
    found = found.join(protected.select(F.lower("term").alias("_p")).distinct(), F.lower("word") == F.col("_p"), "left_anti")
    own = known.select(F.col("term").alias("_own"))
    found = found.join(own, F.lower("word") == F.col("_own"), "left").where(F.col("inside") | F.col("_own").isNotNull())
    read = known.select(F.col("term").alias("_read"))
    met = found.join(read, F.col("one") == F.col("_read"), "left")
    fits = F.coalesce((F.col("one") == F.col("two")) & (F.lower("one") == F.col("one")) & F.col("_read").isNotNull() & (F.levenshtein(F.lower("word"), "one") <= 1), F.lit(False))
    return met.select("row_id", "start", "word", F.when(fits, F.col("one")).alias("target"), F.when(fits, "correct").otherwise("review").alias("action"), F.when(fits, "aligned-source-case").otherwise("case-witness-conflict").alias("reason"))
