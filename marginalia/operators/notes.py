"""Footnotes and endnotes: linking notes to their calls, strict sequences, and
recovery of missing numbers from read glyphs."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.operators import sequence

#: The mark at the start of a note: one to three symbols, or a number.
_SYMBOL = r"""^\s*([*†‡]{1,3})(?![*†‡])(?=\s|\p{L}|["'“‘«(…])"""
_NUMBER = r"^\s*(\d{1,2})(?=\s|\[)"
_PROSE = ("text", "quote", "verse")


def _symbol_runs(text: Column) -> Column:
    """``(start, stop, symbol)`` of every run of up to three note symbols."""
    at = lambda i: F.substr(text, i, F.lit(1))
    is_mark = lambda i: at(i).isin("*", "†", "‡")
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: is_mark(i) & ~((i > 1) & is_mark(i - 1)))
    runs = F.transform(starts, lambda i: F.struct((i - 1).alias("start"), F.regexp_extract(F.substr(text, i), r"^[*†‡]+", 0).alias("symbol")))
    short = F.filter(runs, lambda r: F.length(r["symbol"]) <= 3)
    return F.transform(short, lambda r: F.struct(r["start"].alias("start"), (r["start"] + F.length(r["symbol"])).alias("stop"), r["symbol"].alias("symbol")))


def link_notes(notes: DataFrame, blocks: DataFrame, sources: DataFrame, styles: DataFrame, *, numeric: bool = True) -> DataFrame:
    """``note_id, page, symbol, status, calls, block_id, start, stop, anchor``:
    notes with their only call on their page, or the reason there is none.

    A symbol's call is a run of it in the chapter's prose; a number's call is
    raised text, in any chapter.  Marks at the start of a block and numbers
    inside numbers are no calls.  Reasons: unrecognized-note-prefix,
    multiple-note-symbols, nonunique-body-symbol, existing-link.

    ``notes(note_id, chapter, page, text, entries)`` with the number of entries
    a page's note holds, ``blocks(block_id, chapter, kind, text)``,
    ``sources(block_id, page, start, stop)``, ``styles(block_id, start, stop,
    raised, href)``."""
    symbol = F.regexp_extract("text", _SYMBOL, 1)
    number = F.regexp_extract("text", _NUMBER, 1) if numeric else F.lit("")
    marked = notes.withColumn("symbol", F.when(symbol != "", symbol).when(number != "", number))
    digits = F.col("symbol").rlike("^[0-9]+$")
    several = F.when(digits, F.coalesce("entries", F.lit(1)) != 1).otherwise(F.size(_symbol_runs(F.col("text"))) != 1)
    marked = marked.withColumn("_several", F.col("symbol").isNotNull() & several)
    prose = blocks.where(F.col("kind").isin(*_PROSE))
    runs = prose.where(F.col("text").rlike("[*†‡]")).select("block_id", "chapter", "text", F.explode(_symbol_runs(F.col("text"))).alias("r"))
    runs = runs.select("block_id", "chapter", "r.start", "r.stop", F.col("r.symbol").alias("symbol"), "text")
    raised = styles.where("raised").select("block_id", "start", "stop").join(prose.select("block_id", "chapter", "text"), "block_id")
    raised = raised.withColumn("symbol", F.substr("text", F.col("start") + 1, F.col("stop") - F.col("start"))).where(F.col("symbol").rlike("^[0-9]{1,2}$"))
    calls = runs.unionByName(raised.select(*runs.columns)).where("start > 0")
    between = F.substr("text", F.col("start"), F.lit(1)).rlike("[0-9]") & F.substr("text", F.col("stop") + 1, F.lit(1)).rlike("[0-9]")
    calls = calls.where(~between).drop("text")
    placed = calls.join(sources.select("block_id", F.col("page").alias("_page"), F.col("start").alias("_s"), F.col("stop").alias("_e")), "block_id").where("_s <= start and stop <= _e")
    placed = placed.select(F.col("symbol").alias("_symbol"), F.col("chapter").alias("_chapter"), "_page", "block_id", "start", "stop").distinct()
    same = (F.col("symbol") == F.col("_symbol")) & (F.col("page") == F.col("_page"))
    met = marked.where("symbol is not null and not _several").join(placed, same).where(digits | (F.col("chapter") == F.col("_chapter")))
    counted = met.groupBy("note_id").agg(F.count("*").alias("calls"), F.min(F.struct("block_id", "start", "stop")).alias("c"))
    linked = styles.where("href is not null").select(F.col("block_id").alias("_b"), F.col("start").alias("_s"), F.col("stop").alias("_e"))
    one = counted.where("calls = 1").select("note_id", "c.*")
    taken = one.join(linked, (F.col("block_id") == F.col("_b")) & (F.col("_s") < F.col("stop")) & (F.col("_e") > F.col("start"))).select("note_id").distinct().withColumn("_taken", F.lit(True))
    out = marked.join(counted, "note_id", "left").join(taken, "note_id", "left")
    status = (
        F.when(F.col("symbol").isNull(), "unrecognized-note-prefix")
        .when(F.col("_several"), "multiple-note-symbols")
        .when(F.coalesce("calls", F.lit(0)) != 1, "nonunique-body-symbol")
        .when(F.col("_taken"), "existing-link")
        .otherwise("linked")
    )
    plain = F.concat(F.lit("footnoteref-"), F.col("page").cast("string"))
    anchor = F.when((F.col("symbol") == "1") | ~digits, plain).otherwise(F.concat_ws("-", plain, F.col("symbol")))
    found = out.withColumn("status", status)
    held = lambda c: F.when(F.col("status") == "linked", c)
    return found.select(
        "note_id", "page", "symbol", "status", F.coalesce("calls", F.lit(0).cast("long")).alias("calls"), held(F.col("c.block_id")).alias("block_id"), held(F.col("c.start")).alias("start"), held(F.col("c.stop")).alias("stop"), held(anchor).alias("anchor")
    )


def endnotes(blocks: DataFrame, sections: DataFrame, *, left: float = 0.0, limit: float = 0.17) -> DataFrame:
    """``seq, chapter, number, id, problem`` of the headings and numbered rows
    of a chapter of endnotes.

    A number counts where it stands at the margin; sections must run 1, 2, ...
    to what they expect.  Problems: text-before-heading, unknown-heading,
    unnumbered-initial, sequence-error, incomplete (at the heading).

    ``blocks(book, seq, kind, text, x0)``, ``sections(book, heading, chapter,
    expected)``."""
    w = Window.partitionBy("book").orderBy("seq")
    heading = F.when(F.col("kind") == "heading", F.col("text"))
    named = blocks.withColumn("_heading", F.last(heading, True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    named = named.withColumn("_section", F.count(heading).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    label = F.regexp_extract("text", r"^(\d+)\.\s", 1)
    marker = (F.col("kind") != "heading") & (label != "") & (F.col("x0") >= left) & (F.col("x0") < limit)
    known = sections.select(F.col("book").alias("_b"), F.col("heading").alias("_h"), "chapter", "expected")
    rows = named.withColumn("_marker", marker).withColumn("number", F.when(marker, label.cast("int"))).join(known, (F.col("book") == F.col("_b")) & (F.col("_heading") == F.col("_h")), "left")
    part = Window.partitionBy("book", "_section").orderBy("seq")
    rows = rows.withColumn("_k", F.sum(F.col("_marker").cast("int")).over(part.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_all", F.sum(F.col("_marker").cast("int")).over(Window.partitionBy("book", "_section")))
    is_heading = F.col("kind") == "heading"
    problem = (
        F.when(F.col("_section") == 0, "text-before-heading")
        .when(is_heading & F.col("chapter").isNull(), "unknown-heading")
        .when(is_heading & (F.col("_all") != F.col("expected")), "incomplete")
        .when(~is_heading & ~F.col("_marker") & (F.col("_k") == 0), "unnumbered-initial")
        .when(F.col("_marker") & (F.col("number") != F.col("_k")), "sequence-error")
    )
    name = F.when(F.col("_marker"), F.concat_ws("-", F.lit("endnote"), "chapter", "number"))
    return rows.withColumn("problem", problem).where(is_heading | F.col("_marker") | F.col("problem").isNotNull()).select("book", "seq", "chapter", "number", name.alias("id"), "problem")


def link_endnotes(notes: DataFrame, calls: DataFrame, *, by_chapter: bool = False) -> tuple[DataFrame, DataFrame]:
    """Endnotes with the anchors of their calls in order, and calls without a
    note.  A note that nothing calls is ``unlinked``, or leads to its chapter's
    start.  ``notes(chapter, number, id)``, ``calls(chapter, number, place)``."""
    order = Window.partitionBy("chapter", "number").orderBy("place")
    numbered = calls.withColumn("_k", F.row_number().over(order))
    anchors = numbered.groupBy("chapter", "number").agg(F.transform(F.array_sort(F.collect_list("_k")), lambda k: F.concat_ws("-", F.lit("noteref"), F.col("chapter"), F.col("number"), k)).alias("backlinks"))
    met = notes.join(anchors, ["chapter", "number"], "left")
    start = F.array(F.concat(F.lit("chapter-"), F.lpad(F.col("chapter").cast("string"), 2, "0"), F.lit(".xhtml#chapter-start")))
    links = F.coalesce("backlinks", start if by_chapter else F.array().cast("array<string>"))
    status = F.when(F.col("backlinks").isNotNull(), "linked").otherwise("chapter-start" if by_chapter else "unlinked")
    lost = calls.join(notes.select("chapter", "number"), ["chapter", "number"], "left_anti")
    return met.select("chapter", "number", "id", links.alias("backlinks"), status.alias("status")), lost


def recovered(options: DataFrame, readings: DataFrame, by: str, maximum: str) -> DataFrame:
    """Selection in two passes: candidates that the first leaves open get the
    options that fresh readings of them add, then all are selected once more.

    ``options(by, candidate, number, votes, maximum)``, ``readings(by,
    candidate, readings)``."""
    first = sequence.selected(options, by, "candidate", "number", "votes", maximum)
    settled = first.where("status = 'selected'").select(by, "candidate").distinct()
    left = options.select(by, "candidate").distinct().join(settled, [by, "candidate"], "left_anti")
    most = options.groupBy(F.col(by).alias("_by")).agg(F.max(maximum).alias(maximum))
    more = sequence.retries(readings.join(left, [by, "candidate"], "left_semi"), options.select(by, "candidate", "number"), by, F.lit(2**31))
    more = more.join(most, F.col(by) == F.col("_by")).where(F.col("number") <= F.col(maximum)).select(by, "candidate", "number", "votes", maximum)
    kinds = {f.name: f.dataType for f in options.schema}
    more = more.select(*[F.col(c).cast(kinds[c]).alias(c) for c in options.columns])
    return sequence.selected(options.unionByName(more), by, "candidate", "number", "votes", maximum)


def researched(anchors: DataFrame, options: DataFrame, expected: DataFrame, by: str) -> DataFrame:
    """``by, number, status``: what a search for missing numbers comes to:
    selected, ambiguous, insufficient-evidence, anchor-order-conflict or
    no-candidate.

    Options count strictly inside the bounds of the trusted anchors; these join
    them as fixed points of the alignment.  ``anchors(by, number, position,
    trusted)``, ``options(by, number, position, votes, candidate)``,
    ``expected(by, notes)``."""
    wanted = sequence.searches(anchors, by, "number", "position", expected)
    bounded = options.join(wanted.select(F.col(by).alias("_by"), F.col("number").alias("_number"), "lower", "upper", F.col("status").alias("_search")), (F.col(by) == F.col("_by")) & (F.col("number") == F.col("_number")))
    inside = (F.col("_search") == "searchable") & (F.col("lower").isNull() | (F.col("position") > F.col("lower"))) & (F.col("upper").isNull() | (F.col("position") < F.col("upper")))
    nodes = bounded.where(inside).select(by, "position", F.col("number").cast("long").alias("number"), F.col("votes").cast("long").alias("votes"), F.col("candidate").cast("long").alias("candidate"), F.lit(False).alias("anchor"))
    fixed = anchors.where("trusted").select(by, "position", F.col("number").cast("long").alias("number"), F.lit(2).cast("long").alias("votes"), F.lit(None).cast("long").alias("candidate"), F.lit(True).alias("anchor"))
    solved = sequence.aligned(nodes.unionByName(fixed), by, "position", "number", "votes").where("not anchor")
    best = solved.groupBy(F.col(by).alias("_by"), F.col("number").alias("_number")).agg(F.bool_or(F.col("aligned.status") == "selected").alias("_one"), F.max("votes").alias("_votes"))
    met = wanted.join(best, (F.col(by) == F.col("_by")) & (F.col("number") == F.col("_number")), "left")
    status = F.when(F.col("status") != "searchable", F.col("status")).when(F.col("_votes").isNull(), "no-candidate").when(F.col("_one"), "selected").when(F.col("_votes") < 2, "insufficient-evidence").otherwise("ambiguous")
    return met.select(by, "number", status.alias("status"))


def running_numbers(rows: list[tuple[str, float, list[str]]]) -> list[tuple[int, str, str]]:
    """``(row, before, after)``: damaged numbers of a hanging reference list.

    ``rows`` are ``(text, x0, fresh readings)``; a row without a prefix and in
    capitals is a heading and starts the count anew.  A prefix of digits and
    look-alike letters at the margin (the 20th percentile of the numbered rows)
    must be the next number; if its digits are not, two fresh readings must have
    exactly that number before a rest that is nine tenths alike."""
    prefix = re.compile(r"^([0-9IlT]{1,3})[.,]\s*(.*)$")
    numbered = sorted(x for t, x, _ in rows if prefix.match(t))
    if not numbered:
        return []
    margin, count, out = numbered[len(numbered) // 5], 0, []
    letters = lambda t: re.sub(r"[\W\d_]+", "", t).lower()
    for i, (text, x0, fresh) in enumerate(rows):
        found = prefix.match(text)
        if not found:
            count = 0 if text.isupper() else count
            continue
        if abs(x0 - margin) > 0.02:
            continue
        wanted, read = str(count + 1), found[1].translate(str.maketrans("IlT", "111"))
        agreed = sum(bool((m := prefix.match(f)) and m[1] == wanted and SequenceMatcher(None, letters(m[2]), letters(found[2])).ratio() >= 0.9) for f in fresh)
        if read == wanted or agreed >= 2:
            count += 1
            if found[1] != wanted:
                out.append((i, found[1], wanted))
        elif found[1].isdigit():
            count = int(found[1])
    return out


def footer_labels(lines: DataFrame, *, per_chapter: bool = False) -> DataFrame:
    """``chapter, page, row, number, verified``: numbers that open rows of a
    note zone; verified where they run on from 1 on their page, or in their
    chapter.  ``lines(chapter, page, row, text)`` of note zones."""
    label = F.regexp_extract("text", r"^\s*(\d{1,3})[.)\]]?\s+\S", 1)
    numbered = lines.where(label != "").select("chapter", "page", "row", label.cast("int").alias("number"))
    w = Window.partitionBy("chapter").orderBy("page", "row", "number") if per_chapter else Window.partitionBy("chapter", "page").orderBy("row", "number")
    return numbered.withColumn("verified", F.col("number") == F.row_number().over(w))
