"""Rows, paragraphs, margins and blocks of pages."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions import text as X
from marginalia.functions.similarity import beta_quantile
from marginalia.operators.windows import islands

#: Centres closer than this are one row (share of the page's height).
SAME_ROW = 0.008
#: A larger gap between lines starts a paragraph; a larger indent too.
GAP, INDENT = 0.012, 0.018


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _groups(columns: pd.Series, centres: pd.Series) -> pd.Series:
    """The number of each piece's row; pieces come by column and centre."""

    def one(cols, places) -> list[int]:
        out, number, held, column = [], -1, [], None
        for col, c in zip(cols, places, strict=True):
            if column != col or not held or abs(c - sum(held) / len(held)) >= SAME_ROW:
                number, held = number + 1, []
            column = col
            held.append(c)
            out.append(number)
        return out

    return pd.Series([one(*x) for x in zip(columns, centres, strict=True)])


def merge_rows(rows: DataFrame) -> DataFrame:
    """Pieces of a row joined: sorted by centre, a piece joins the open group
    while its centre is within :data:`SAME_ROW` of the group's mean centre.

    ``rows(page, col, x0, y0, x1, y1, text, confidence)``; texts are joined in
    order of x0, boxes united, confidence is the least, missing counting 1.
    The mean moves with the group, so a page is folded in order; pages are
    gathered in the JVM and folded many at a time.
    """
    piece = F.struct("col", ((F.col("y0") + F.col("y1")) / 2).alias("c"), "x0", "y0", "x1", "y1", "text", F.coalesce("confidence", F.lit(1.0)).alias("confidence"))
    pages = rows.groupBy("page").agg(F.array_sort(F.collect_list(piece)).alias("r"))
    numbered = pages.select("page", F.explode(F.arrays_zip("r", _groups(F.transform("r", lambda x: x["col"]), F.transform("r", lambda x: x["c"])).alias("g"))).alias("p"))
    one = numbered.groupBy("page", F.col("p.g").alias("g")).agg(
        F.min("p.r.col").alias("col"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p.r.x0", "p.r.c", "p.r.text"))), lambda x: x["text"]), " ").alias("text"),
        *[f(f"p.r.{c}").alias(c) for c, f in (("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max), ("confidence", F.min))],
    )
    return one.drop("g")


def paragraphs(rows: DataFrame) -> DataFrame:
    """Lines with ``block``, numbered from 1 per page: a blank line before, a
    short line before, or an indent starts one."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    before = F.lag("line").over(w)
    starts = before.isNull() | (F.trim(before) == "") | (F.length(before) < 0.5 * F.length("line")) | F.col("line").rlike(r"^\s{2,}\S")
    return islands(rows.withColumn("_starts", starts), ["doc_id"], ["pos"], F.col("_starts"), "block").drop("_starts")


def stitched(rows: DataFrame) -> DataFrame:
    """``source, doc_id, run``: a page goes on with the one before it if that
    ends without closing punctuation.  Only each page's last character travels."""
    w = Window.partitionBy("source").orderBy("doc_id")
    last = rows.select("source", "doc_id", F.rtrim("text").rlike(r"[.!?]$").alias("_closed"))
    goes_on = ~F.lag("_closed").over(w)
    return islands(last.withColumn("_new", ~F.coalesce(goes_on, F.lit(False))), ["source"], ["doc_id"], F.col("_new"), "run").drop("_new", "_closed")


def joined_lines(rows: DataFrame) -> DataFrame:
    """Each line with its successor and how they join: a soft hyphen is
    removed, a hyphen between letters is retained, else a space."""
    after = F.lead("line").over(Window.partitionBy("doc_id").orderBy("pos"))
    policy = (
        F.when(after.isNull(), "end")
        .when(F.col("line").endswith("­"), "removed")
        .when(F.col("line").rlike(r"\p{L}-$") & after.rlike(r"^\p{Ll}"), "retained")
        .otherwise("space")
    )
    return rows.select("doc_id", "pos", policy.alias("policy"))


def margins(rows: DataFrame, least: int = 3) -> DataFrame:
    """Recurring margin texts: signature, pages, median place, its deviation,
    parity concentration and the posterior mean of its rate.

    ``rows(page, y, text)``; opportunities are pages of the same parity where
    nine tenths of the signs are of one parity."""
    signed = rows.withColumn("signature", X.signature(F.col("text"))).where(F.col("signature") != "")
    base = signed.groupBy("signature").agg(
        F.count_distinct("page").alias("pages"), F.count("*").alias("rows"), F.min("page").alias("first"), F.max("page").alias("last"), F.median("y").alias("med"), F.avg((F.col("page") % 2).cast("double")).alias("odd")
    )
    often = base.where(F.col("pages") >= least)
    spread = signed.join(often.select("signature", "med"), "signature").groupBy("signature").agg(F.median(F.abs(F.col("y") - F.col("med"))).alias("mad"))
    parity = F.greatest("odd", 1 - F.col("odd"))
    chances = F.when(parity >= 0.9, F.floor((F.col("last") - F.col("first")) / 2) + 1).otherwise(F.col("last") - F.col("first") + 1)
    return often.join(spread, "signature").select(
        "signature",
        "pages",
        F.round("med", 6).alias("median_y"),
        F.round("mad", 6).alias("mad_y"),
        F.round(parity, 6).alias("parity"),
        F.round((F.col("pages") + 1) / (F.greatest(chances, F.col("pages")) + 2), 6).alias("posterior"),
    )


def _resembles(met: SequenceMatcher, seed: str, least: float) -> bool:
    """Whether the ratio is ``least`` or more; lengths and letters bound it
    from above, so most texts are never matched."""
    a, b = len(seed), len(met.b)
    if 2.0 * min(a, b) < least * (a + b):
        return False
    met.set_seq1(seed)
    return met.quick_ratio() >= least and met.ratio() >= least


def clustered(signatures: list[tuple[str, int]], least: float = 0.9) -> dict[str, str]:
    """Variants absorbed by seeds, most frequent first; a variant joins the
    first seed it resembles and never seeds others itself."""
    seeds: list[str] = []
    out: dict[str, str] = {}
    for name, n in sorted(signatures, key=lambda s: (-s[1], s[0])):
        met = SequenceMatcher(None, "", name)
        home = next((s for s in seeds if _resembles(met, s, least)), None)
        out[name] = home or name
        if home is None and n >= 3:
            seeds.append(name)
    return out


@F.pandas_udf(T.DoubleType())
def _ratio(seeds: pd.Series, names: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, s, n).ratio() for s, n in zip(seeds, names, strict=True)], dtype="float64")


def _absorbed(singles: DataFrame, seeds: DataFrame, by: str, least: float = 0.9) -> DataFrame:
    """``by, signature, seed, pages``: signatures of one page that resemble a
    seed, with the first such seed.

    Texts of ratio 0.9 differ by at most a tenth of both lengths in inserted
    and deleted characters.  A seed is cut into one piece more than the most
    such edits, three characters or longer, so one piece stays whole and moves
    by no more places than there are edits; texts meet by its first three
    characters and are then compared exactly."""
    n = F.length("signature")
    edits = F.floor(n * 2 / 9)
    short = n < 6
    step = F.when(short, 1).otherwise(F.floor(n / (edits + 1))).cast("int")
    pieces = F.when(short, F.greatest(n - 2, F.lit(1))).otherwise(edits + 1).cast("int")

    def grams(count: Column, apart: Column) -> Column:
        starts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: i * apart)
        return F.explode(F.transform(starts, lambda i: F.struct(i.alias("at"), F.col("signature").substr(i + 1, F.lit(3)).alias("text"))))

    # only numbers travel with the pieces, texts come back for the pairs that met
    one = singles.select(F.col(by), F.xxhash64("signature").alias("_id"), n.alias("_len"), grams(F.greatest(n - 2, F.lit(1)), F.lit(1)).alias("_a"))
    other = seeds.select(F.col(by).alias("_by"), F.xxhash64("signature").alias("_id2"), n.alias("_len2"), grams(pieces, step).alias("_b"))
    both = F.col("_len") + F.col("_len2")
    fits = (10 * (both - 2 * F.least("_len", "_len2")) <= both) & (10 * F.abs(F.col("_a.at") - F.col("_b.at")) <= both)
    met = one.join(other, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_a.text") == F.col("_b.text")) & fits).select("_by", "_id", "_id2").distinct()
    left = singles.select(by, "signature", "pages", F.xxhash64("signature").alias("_id"))
    right = seeds.select(F.col(by).alias("_by2"), F.col("signature").alias("seed"), F.col("pages").alias("_n"), F.xxhash64("signature").alias("_id2"))
    met = met.join(left, ["_id"]).where(F.col("_by").eqNullSafe(F.col(by))).join(right, ["_id2"]).where(F.col("_by").eqNullSafe(F.col("_by2")))
    met = met.where(10 * F.levenshtein("seed", "signature") <= F.length("seed") + F.length("signature")).select(by, "signature", "pages", "seed", "_n")
    found = met.where(_ratio("seed", "signature") >= least)
    first = F.min(F.struct((-F.col("_n")).alias("n"), F.col("seed").alias("seed")))
    return found.groupBy(by, "signature", "pages").agg(first.alias("_first")).select(by, "signature", F.col("_first.seed").alias("seed"), "pages")


def clustered_margins(rows: DataFrame, by: str) -> DataFrame:
    """``by, signature, seed, pages`` per book; a book's recurring margin texts
    are few and are clustered in order in one place, then those of one page
    join the seeds they resemble."""
    counts = rows.withColumn("signature", X.signature(F.col("text"))).where(F.col("signature") != "").groupBy(by, "signature").agg(F.count_distinct("page").alias("pages"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        seeds = clustered(list(zip(frame.signature, frame.pages, strict=True)))
        return frame.assign(seed=frame.signature.map(seeds))[[by, "signature", "seed", "pages"]]

    # texts of a page can't be seeds and come last in order; without a seed they are no margins
    often = counts.where("pages >= 2").groupBy(by).applyInPandas(run, f"{by} string, signature string, seed string, pages bigint")
    seeds = often.where("signature = seed and pages >= 3").select(by, "signature", "pages")
    return often.unionByName(_absorbed(counts.where("pages = 1"), seeds, by))


def role(
    text: Column,
    y: Column,
    first: Column,
    *,
    absorbed: Column | None = None,
    excluded_page: Column | None = None,
    in_figure: Column | None = None,
    start: Column | None = None,
    bottom: Column | None = None,
    top: Column | None = None,
    recurring: Column | None = None,
    note_start: Column | None = None,
) -> Column:
    """``kind/reason`` of a row: the first rule that fits.  What a profile says
    of the page (body start, cut-offs, note zone) and flags that joins have
    made (:func:`repair.outside`, :func:`recurring_rows`) are columns."""
    text = F.trim(text)
    no = F.lit(False)
    flag = lambda c: F.coalesce(c, no) if c is not None else no
    at = lambda c, value: F.coalesce(c, F.lit(value)) if c is not None else F.lit(value)
    return (
        F.when(flag(absorbed), "excluded/represented-by-recovered-note")
        .when(flag(excluded_page), "excluded/profile-excluded-page")
        .when(flag(in_figure), "excluded/preserved-figure-region")
        .when(first & (y < at(start, 0.27)), "excluded/chapter-title")
        .when(y >= at(bottom, 2.0), "excluded/profile-bottom-margin")
        .when(y < at(top, 0.035), "excluded/upper-margin-artifact")
        .when(flag(recurring), "excluded/recurring-margin")
        .when((y < 0.10) & F.coalesce(X.letters_share(text, "Lu") > 0.8, no), "excluded/uppercase-margin-fallback")
        .when((F.length(text) <= 4) & (y > 0.84), "excluded/short-footer-fallback")
        .when(y >= at(note_start, 2.0), "note/profile-note-region")
        .otherwise("body/retained")
    )


def recurring_rows(rows: DataFrame, excluded: DataFrame, reach: float = 0.003) -> DataFrame:
    """Rows that are excluded margin texts: same page and text, less than
    ``reach`` apart.  Both have ``page, text, y``."""
    e = excluded.select(F.col("page").alias("_page"), F.col("text").alias("_text"), F.col("y").alias("_y"))
    same = (F.col("page") == F.col("_page")) & (F.col("text") == F.col("_text")) & (F.abs(F.col("y") - F.col("_y")) < reach)
    return rows.join(e, same, "left_semi")


def leaked_footers(rendered: DataFrame, footers: DataFrame) -> DataFrame:
    """Rendered rows that were classified as footers: ``page, row, text``."""
    return rendered.join(footers.select("page", "row").distinct(), ["page", "row"], "left_semi")


def page_kind(page: Column, pages: Column, *, index: Column, figure: Column, note: Column, heads: Column) -> Column:
    """index, figure, note, front or body; ``heads`` are the page's first five
    rows, one of which may say that it is an index."""
    said = F.exists(F.slice(heads, 1, 5), lambda t: t.rlike(r"(?i)\bindex\b"))
    front = page <= F.least(F.lit(16), F.floor(pages / 10))
    return F.when(index, "index").when(figure, "figure").when(note, "note").when(front, "front").when(F.coalesce(said, F.lit(False)), "index").otherwise("body")


def margin_rows(rows: DataFrame) -> DataFrame:
    """Rows that can be running heads: near the top, over four letters, most of
    them capitals.  ``rows(page, y, text)``."""
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]", ""))
    return rows.where((F.col("y") > 0.025) & (F.col("y") < 0.14) & (letters > 4) & (X.letters_share(F.col("text"), "Lu") >= 0.55))


def running_heads(rows: DataFrame, by: str, least: int = 3) -> DataFrame:
    """``by, seed, pages, median_y, mad_y, parity, posterior, low, high`` of a
    book's recurring margin texts with their variants.

    Rows further than max(0.1, 4 deviations) from the median place don't count;
    the posterior is that of the rate among the pages of its span, of one parity
    where nine tenths are.  ``rows(by, page, y, text)``."""
    signed = rows.withColumn("signature", X.signature(F.col("text"))).where(F.col("signature") != "")
    homes = clustered_margins(rows.select(by, "page", "text"), by).select(F.col(by).alias("_by"), F.col("signature").alias("_s"), "seed")
    met = signed.join(homes, F.col(by).eqNullSafe(F.col("_by")) & (F.col("signature") == F.col("_s"))).drop("_by", "_s")
    base = met.groupBy(F.col(by).alias("_b"), F.col("seed").alias("_seed")).agg(F.median("y").alias("med"), F.count_distinct("page").alias("_n")).where(F.col("_n") >= least)
    placed = met.join(base, F.col(by).eqNullSafe(F.col("_b")) & (F.col("seed") == F.col("_seed")))
    spread = placed.groupBy("_b", "_seed").agg(F.median(F.abs(F.col("y") - F.col("med"))).alias("mad")).select(F.col("_b").alias("_b2"), F.col("_seed").alias("_seed2"), "mad")
    inside = placed.join(spread, F.col("_b").eqNullSafe(F.col("_b2")) & (F.col("_seed") == F.col("_seed2"))).where(F.abs(F.col("y") - F.col("med")) <= F.greatest(F.lit(0.1), 4 * F.col("mad")))
    found = inside.groupBy(by, "seed", "med", "mad").agg(F.count_distinct("page").alias("pages"), F.min("page").alias("first"), F.max("page").alias("last"), F.count_distinct(F.when(F.col("page") % 2 == 1, F.col("page"))).alias("odd"))
    parity = F.greatest(F.col("odd"), F.col("pages") - F.col("odd")) / F.col("pages")
    chances = F.greatest(F.when(parity >= 0.9, F.floor((F.col("last") - F.col("first")) / 2) + 1).otherwise(F.col("last") - F.col("first") + 1), F.col("pages"))
    known = found.withColumn("parity", parity).withColumn("_a", F.col("pages") + 1.0).withColumn("_z", chances - F.col("pages") + 1.0)
    return known.select(
        by, "seed", "pages", F.round("med", 6).alias("median_y"), F.round("mad", 6).alias("mad_y"), F.round("parity", 6).alias("parity"),
        F.round(F.col("_a") / (F.col("_a") + F.col("_z")), 6).alias("posterior"),
        F.round(beta_quantile(F.lit(0.025), "_a", "_z"), 4).alias("low"), F.round(beta_quantile(F.lit(0.975), "_a", "_z"), 4).alias("high"),
    )


def quote_runs(rows: DataFrame, inset: Column, by: list[str], order: str, least: int = 3) -> DataFrame:
    """Runs of at least ``least`` adjacent inset rows: first, last, rows."""
    w = Window.partitionBy(*by).orderBy(order)
    marked = rows.withColumn("_inset", inset)
    runs = islands(marked.withColumn("_new", F.col("_inset") != F.lag("_inset").over(w)), by, [order], F.col("_new"), "run")
    return runs.where("_inset").groupBy(*by, "run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("rows")).where(F.col("rows") >= least).drop("run")


def group_boxes(boxes: list[tuple[float, float, float, float]], gap: float = 0.035) -> list[tuple[float, float, float, float]]:
    """Boxes that overlap sideways and are at most ``gap`` apart vertically,
    merged until nothing changes."""
    boxes = sorted(boxes)
    merged = True
    while merged:
        merged = False
        for i in range(len(boxes)):
            for j in range(i + 1, len(boxes)):
                a, b = boxes[i], boxes[j]
                if min(a[2], b[2]) > max(a[0], b[0]) and max(a[1], b[1]) - min(a[3], b[3]) <= gap:
                    boxes[i] = (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))
                    del boxes[j]
                    merged = True
                    break
            if merged:
                break
    return boxes
