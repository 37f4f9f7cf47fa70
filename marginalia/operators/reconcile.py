"""Witness voting, consensus, review tiers, anchored changes and row repair."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions import matching
from marginalia.functions import text as X
from marginalia.functions.similarity import WORD, seq_over, seq_ratio
from marginalia.operators import rowrules
from marginalia.operators.joins import beside, bucketed, nearest, without
from marginalia.sources.settle import settled


def votes(rows: DataFrame, witnesses: list[str], least: int = 2) -> DataFrame:
    """Token replacements that at least ``least`` witnesses propose at the
    same place of equally long readings.

    ``rows(row_id, text, <witnesses>)``."""
    read = rows.select("row_id", F.split("text", " ").alias("own"), F.explode(F.array(*[F.struct(F.lit(w).alias("engine"), F.split(w, " ").alias("t")) for w in witnesses])).alias("w"))
    same = read.where(F.size("own") == F.size("w.t")).select("row_id", "w.engine", F.posexplode(F.arrays_zip(F.col("own").alias("before"), F.col("w.t").alias("after"))).alias("idx", "p"))
    proposed = same.where("p.before <> p.after").groupBy("row_id", "idx", F.col("p.before").alias("before"), F.col("p.after").alias("after")).agg(F.count_distinct("engine").alias("votes"))
    return proposed.where(F.col("votes") >= least)


def consensus(rows: DataFrame, witnesses: list[str]) -> DataFrame:
    """``agreed``: the one reading of all present witnesses, else null."""
    present = F.array_distinct(F.filter(F.array(*[X.collapse(F.col(w)) for w in witnesses]), lambda t: t.isNotNull() & (t != "")))
    return rows.withColumn("agreed", F.when(F.size(present) == 1, F.element_at(present, 1)))


def tier(primary: Column, embedded: Column, vision: Column, rapid: Column) -> Column:
    """Review tier of a row by how its witnesses agree."""
    p, e, v, r = (X.comparable(c) for c in (primary, embedded, vision, rapid))
    full = (F.size(p) > 0) & (F.size(v) > 0) & (F.size(r) > 0)
    fresh = full & (v == r) & (v != p)
    return F.when(fresh & (e == v), "three-peer-consensus").when(fresh, "fresh-peer-consensus").otherwise("other")


def attested(tokens: DataFrame, copies: DataFrame) -> DataFrame:
    """Terms present in a document and in all its copies, on at least two
    pages; ``others`` is the number of such pages besides one's own.

    ``tokens(doc_id, term)``, ``copies(doc_id, group_id)``."""
    seen = tokens.select("doc_id", "term").distinct().join(copies, "doc_id")
    sizes = copies.groupBy("group_id").agg(F.count("*").alias("engines")).where("engines >= 2")
    whole = seen.groupBy("group_id", "term").agg(F.count("*").alias("readings")).join(sizes, "group_id").where("readings = engines")
    return whole.groupBy("term").agg(F.count("*").alias("pages")).where("pages >= 2").select("term", "pages", (F.col("pages") - 1).alias("others"))


def _anchors(a: list[str], b: list[str], i: int, j: int, k: int, m: int) -> int:
    """Equal words of two or more letters within two places on either side."""
    left = sum(i >= d and k >= d and a[i - d] == b[k - d] and len(a[i - d]) >= 2 for d in (1, 2))
    return left + sum(j + d < len(a) and m + d < len(b) and a[j + d] == b[m + d] and len(a[j + d]) >= 2 for d in (0, 1))


_PHRASE = re.compile(r"[^\W\d_]+(?:[ \t]+[^\W\d_]+)*")


def _replaced(ours: str, theirs: str, form) -> Iterator[tuple[tuple[int, int], list[str], list[str], str, int]]:
    """Replaced stretches of words: span in ours, words of both, the other
    text, anchors."""
    a, b = list(WORD.finditer(ours)), list(WORD.finditer(theirs))
    left, right = [form(m[0]) for m in a], [form(m[0]) for m in b]
    for tag, i, j, k, m in matching.opcodes(left, right):
        if tag == "replace":
            yield (a[i].start(), a[j - 1].end()), left[i:j], right[k:m], theirs[b[k].start() : b[m - 1].end()], _anchors(left, right, i, j, k, m)


def anchored(ours: str, theirs: str) -> list[tuple[int, int, str, str, int]]:
    """Changes of one to three words each way, in any case, between two equal
    words or more: ``(start, stop, before, target, anchors)`` in characters."""
    out = []
    for (start, stop), old, new, target, anchors in _replaced(ours, theirs, str.lower):
        before = ours[start:stop]
        plain = all(w.isalpha() for w in old + new) and _PHRASE.fullmatch(before) and _PHRASE.fullmatch(target)
        if len(old) <= 3 and len(new) <= 3 and plain and before.lower() != target.lower() and anchors >= 2:
            out.append((start, stop, before, target, anchors))
    return out


def splits(ours: str, theirs: str) -> list[tuple[int, int, str, str, int]]:
    """Words that a witness reads as two or three with the same letters,
    between two equal words or more."""
    out = []
    for (start, stop), old, new, target, anchors in _replaced(ours, theirs, str):
        letters = len(old) == 1 and 2 <= len(new) <= 3 and all(w.isalpha() for w in old + new) and "".join(new) == old[0]
        if letters and _PHRASE.fullmatch(target) and anchors >= 2:
            out.append((start, stop, old[0], target, anchors))
    return out


def changes(rows: DataFrame, witness: str, kinds: tuple[str, ...] = ("change", "split")) -> DataFrame:
    """``row_id, start, stop, before, target, anchors, kind`` of anchored
    changes and splits, or of one of these ``kinds``, in characters of the
    row."""
    found = [(kind, find) for kind, find in (("change", anchored), ("split", splits)) if kind in kinds]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, own, other in zip(frame["row_id"], frame["text"], frame[witness], strict=True):
                for kind, find in found if own != other else ():
                    out += [(key, *c, kind) for c in find(own or "", other or "")]
            yield pd.DataFrame(out, columns=["row_id", "start", "stop", "before", "target", "anchors", "kind"])

    return rows.select("row_id", "text", witness).mapInPandas(run, "row_id string, start int, stop int, before string, target string, anchors int, kind string")


def shared_changes(first: DataFrame, second: DataFrame) -> DataFrame:
    """Changes that both witnesses propose for the same span."""
    key = ["row_id", "start", "stop", "target"]
    return first.join(second.select(*key).distinct(), key, "left_semi")


def accepted_splits(found: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Splits of an unknown lower-case word (or ``I`` and one) into words that
    are all known.  ``lexicon(term)``."""
    known = lexicon.select("term").distinct()
    parts = F.split(F.lower("target"), r"[ \t]+")
    lower = (F.lower("before") == F.col("before")) | (F.col("target").rlike("^I[ \t]") & F.col("before").rlike(r"^I\p{Ll}+$"))
    rows = found.where((F.col("kind") == "split") & lower).withColumn("_word", F.lower("before"))
    rows = rows.join(known, F.col("_word") == F.col("term"), "left_anti").drop("_word")
    each = rows.withColumn("_part", F.explode(parts)).join(known.withColumnRenamed("term", "_term"), F.col("_part") == F.col("_term"), "left")
    return each.groupBy(*rows.columns).agg(F.bool_and(F.col("_term").isNotNull()).alias("whole")).where("whole").drop("whole")


def frequencies(rows: DataFrame, witnesses: list[str], lexicon: DataFrame, language: str = "en") -> DataFrame:
    """``rows`` with ``zipf``: the frequencies of the words that the rules may
    ask for.  ``lexicon(term, zipf)``; only those words meet it."""

    @F.pandas_udf("array<string>")
    def words(text: pd.Series, *others: pd.Series) -> pd.Series:
        return pd.Series([sorted(rowrules.wanted(t or "", list(w), language)) for t, *w in zip(text, *others, strict=True)])

    asked = rows.select("row_id", F.explode(words("text", *witnesses)).alias("term"))
    found = asked.join(lexicon.select("term", "zipf"), "term").groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "zipf"))).alias("zipf"))
    return rows.join(found, "row_id", "left")


def reconciled(rows: DataFrame, options: rowrules.Options | None = None) -> DataFrame:
    """``row_id, text, repaired, events, disagrees`` of
    ``rows(row_id, text, embedded, vision, rapid, zipf)`` after every rule of
    :mod:`marginalia.operators.rowrules`; an event has kind, before and after."""
    chosen = options or rowrules.Options()
    names = ["text", "embedded", "vision", "rapid"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, zipf, *read in zip(frame["row_id"], frame["zipf"], *(frame[c] for c in names), strict=True):
                table = dict(zipf) if zipf is not None else {}
                row = rowrules.repair(rowrules.Row(read[0] or "", *read[1:], lambda w, t=table: t.get(w.lower(), 0.0), chosen))
                events = [dict(zip(("kind", "before", "after"), e, strict=True)) for e in row.events]
                out.append((key, read[0], row.text, events, rowrules.disagrees(row)))
            yield pd.DataFrame(out, columns=["row_id", "text", "repaired", "events", "disagrees"])

    kind = "array<struct<kind: string, before: string, after: string>>"
    return rows.select("row_id", "zipf", *names).mapInPandas(run, f"row_id string, text string, repaired string, events {kind}, disagrees boolean")


def reconciled_with(rows: DataFrame, lexicon: DataFrame, options: rowrules.Options | None = None, *, changed: bool = False) -> DataFrame:
    """:func:`reconciled` of ``rows(row_id, text, embedded, vision, rapid)``
    with the frequencies of ``lexicon(term, zipf)``; only rows that were
    changed or disagree, if ``changed``.

    Rows whose rules ask for no frequency, most of a clean book, are finished
    in the first pass; only the others meet the lexicon."""
    chosen = options or rowrules.Options()
    names = ["text", "embedded", "vision", "rapid"]
    columns = ["row_id", *names, "asked", "repaired", "events", "disagrees"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, *read in zip(frame["row_id"], *(frame[c] for c in names), strict=True):
                row = rowrules.Row(read[0] or "", *read[1:], lambda w: 0.0, chosen)
                unlike = rowrules.unasked(row)
                if unlike is None:
                    out.append((key, *read, sorted(rowrules.wanted(read[0] or "", read[1:], chosen.language)), None, None, None))
                elif unlike or row.events or not changed:
                    events = [dict(zip(("kind", "before", "after"), e, strict=True)) for e in row.events]
                    out.append((key, read[0], None, None, None, None, row.text, events, unlike))
            yield pd.DataFrame(out, columns=columns)

    kind = "array<struct<kind: string, before: string, after: string>>"
    first = settled(rows.select("row_id", *names).mapInPandas(run, f"row_id string, text string, embedded string, vision string, rapid string, asked array<string>, repaired string, events {kind}, disagrees boolean"))
    done = first.where("asked is null").select("row_id", "text", "repaired", "events", "disagrees")
    open_ = first.where("asked is not null")
    found = open_.select("row_id", F.explode("asked").alias("term")).join(lexicon.select("term", "zipf"), "term").groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "zipf"))).alias("zipf"))
    late = reconciled(open_.select("row_id", *names).join(found, "row_id", "left"), chosen)
    return done.unionByName(late.where("size(events) > 0 or disagrees") if changed else late)


def located(tokens: list[str], index: int, observed: list[str], candidate: str) -> int | None:
    """Which observed word is the one at ``index`` of ours: similar to it or
    to the candidate, with the most equal neighbours; none on a tie."""
    own = tokens[index]
    scored = []
    for i, token in enumerate(observed):
        held = sum(0 <= index + d < len(tokens) and 0 <= i + d < len(observed) and tokens[index + d] == observed[i + d] for d in (-2, -1, 1, 2))
        alone = len(tokens) == len(observed) == 1
        if not (held or alone):
            continue  # most words of a long row; only the others are compared
        near = max(SequenceMatcher(None, w, token).ratio() for w in (own, candidate))
        if near >= 0.75 or (len(own) <= 3 and (held >= 2 or alone)):
            scored.append((held, near, i))
    scored.sort(reverse=True)
    return scored[0][2] if scored and (len(scored) == 1 or scored[0][:2] != scored[1][:2]) else None


def anchored_reading(text: str, observation: str, word: str, candidate: str) -> str | None:
    """The observed word at a word's only place, with two equal neighbours."""
    own, other = WORD.findall(text.lower()), WORD.findall(observation.lower())
    if own.count(word.lower()) != 1:
        return None
    i = own.index(word.lower())
    j = located(own, i, other, candidate.lower())
    if j is None:
        return None
    held = sum(0 <= i + d < len(own) and 0 <= j + d < len(other) and own[i + d] == other[j + d] for d in (-2, -1, 1, 2))
    return other[j] if held >= 2 else None


@F.pandas_udf(T.StringType())
def read_at(text: pd.Series, observation: pd.Series, word: pd.Series, candidate: pd.Series) -> pd.Series:
    """:func:`anchored_reading` of columns."""
    return pd.Series([None if None in x else anchored_reading(*x) for x in zip(text, observation, word, candidate, strict=True)], dtype=object)


def missing_lines(primary: DataFrame, embedded: DataFrame, second: DataFrame, third: DataFrame, reach: float = 0.012) -> DataFrame:
    """``page, row_id, text, action``: embedded rows of eight characters or
    more without a primary row near; ``insert`` the second reading where the
    fresh ones are near and alike, else ``review``.

    Rows have ``row_id, page, centre, text``."""
    read = F.struct("text")
    roles = [(primary, {"primary": F.lit(True)}), (embedded, {"text": F.col("text")}), (second, {"second": read}), (third, {"third": read})]
    each = [rows.select("page", "row_id", "centre", *[c.alias(n) for n, c in role.items()]) for rows, role in roles]
    return missing_readings(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each), reach)


def missing_readings(rows: DataFrame, reach: float = 0.012) -> DataFrame:
    """:func:`missing_lines` of readings in one table, where a row that several
    of them have stands once: ``rows(page, row_id, centre, text, primary,
    second, third)`` with the embedded ``text``, null if that has no such row,
    whether the primary has it, and structs of ``text`` of the fresh readings,
    null likewise.  Every reading is looked up in one shuffle."""
    places = rows.select(
        F.col("page").alias("_by"), F.col("centre").alias("_at"), F.col("row_id").alias("_id"), F.when(F.length("text") >= 8, F.struct("text")).alias("_left"), F.when(F.col("primary"), True).alias("have"), "second", "third"
    )
    alone = without(bucketed(places, ["have", "second", "third"], reach), "have", reach)
    met = beside(alone, ["second", "third"], reach).where("_left is not null")
    both = met.select(F.col("_by").alias("page"), F.col("_id").alias("row_id"), "_left.text", F.col("second.m.text").alias("_second"), F.col("third.m.text").alias("_third"))
    words = lambda c: F.when(F.col("_second") != F.col("_third"), F.array_join(X.comparable(F.col(c)), " "))
    insert = F.col("_second").isNotNull() & F.col("_third").isNotNull() & F.coalesce(seq_over(words("_second"), words("_third"), F.lit(0.8)), F.lit(True))
    return both.withColumn("_insert", insert).select("page", "row_id", F.when(F.col("_insert"), F.col("_second")).otherwise(F.col("text")).alias("text"), F.when(F.col("_insert"), "insert").otherwise("review").alias("action"))


def region_recovery(rows: DataFrame, second: DataFrame, third: DataFrame, reach: float = 0.012) -> DataFrame:
    """Tall, garbled rows that two readings resolve into the same lines:
    ``page, row_id, lines``.

    A row goes where at least two rows of the second reading lie in it with
    its edges, it is over 1.5 times as tall as their median, each has an equal
    row of the third reading near, both are sure (0.85), and its text resembles
    theirs by less than 0.6.  Rows have ``row_id, page, col, x0, y0, x1, y1,
    centre, text, confidence``."""
    peer = second.select(*[F.col(c).alias(f"_{c}") for c in second.columns])
    band = (F.col("page") == F.col("_page")) & (F.col("col") == F.col("_col")) & F.col("_centre").between(F.col("y0"), F.col("y1") + 0.002)
    inside = rows.join(peer, band & (F.abs(F.col("_x0") - F.col("x0")) < 0.035) & (F.abs(F.col("_x1") - F.col("x1")) < 0.05))
    other = nearest(second, third, "page", "centre", "centre", reach, "row_id", "row_id").select(F.col("row_id").alias("_row_id"), F.col("nearest_id").alias("_other"))
    other = other.join(third.select(F.col("row_id").alias("_other"), F.col("text").alias("_read"), F.col("confidence").alias("_sure")), "_other", "left")
    inside = inside.join(other, "_row_id", "left")
    same = F.coalesce((X.comparable(F.col("_text")) == X.comparable(F.col("_read"))) & (F.col("_confidence") >= 0.85) & (F.col("_sure") >= 0.85), F.lit(False))
    found = inside.groupBy("page", "row_id", "text", (F.col("y1") - F.col("y0")).alias("tall")).agg(
        F.count("*").alias("n"), F.median(F.col("_y1") - F.col("_y0")).alias("median"), F.bool_and(same).alias("agreed"), F.array_sort(F.collect_list(F.struct("_centre", "_text"))).alias("lines")
    )
    tall = found.where("n >= 2 and agreed and tall > 1.5 * median").withColumn("lines", F.transform("lines", lambda x: x["_text"]))
    unlike = seq_ratio(F.array_join(X.comparable(F.col("text")), " "), F.array_join(X.comparable(F.array_join("lines", " ")), " ")) < 0.6
    return tall.where(unlike).select("page", "row_id", "lines")


def quality_gate(rows: DataFrame) -> DataFrame:
    """``row_id, kind, words``: unresolved rows whose first word a fresh reading
    has otherwise, all other words being equal: ``irregular-case``,
    ``chapter-opening`` or ``two-peer-initial-word``.

    A later edit of that word, or of its case alone, settles a row.
    ``rows(row_id, text, vision, rapid, rendered, opening)``."""
    own = X.comparable(F.col("text"))
    rest = lambda t: F.slice(t, 2, 1_000_000)
    fresh = F.filter(F.array(X.comparable(F.coalesce("vision", F.lit(""))), X.comparable(F.coalesce("rapid", F.lit("")))), lambda t: F.size(t) >= 3)
    marked = rows.withColumn("_own", own).withColumn("_fresh", fresh).where("size(_own) >= 3 and size(_fresh) > 0 and rendered is not null")
    conflicts = F.filter("_fresh", lambda t: (F.get(t, F.lit(0)) != F.get("_own", F.lit(0))) & (rest(t) == rest(F.col("_own"))))
    marked = marked.withColumn("_conflicts", conflicts).where("size(_conflicts) > 0").withColumn("_now", X.comparable(F.col("rendered")))
    marked = marked.where((F.size("_now") == 0) | (F.get("_now", F.lit(0)) == F.get("_own", F.lit(0))))
    initial = lambda c: F.regexp_extract(c, r"^[‘“\"]?\S+", 0)
    letters = lambda c: F.regexp_replace(initial(c), r"[^\p{L}]", "")
    before, after = letters("text"), letters("rendered")
    recased = (before != after) & (F.lower(before) == F.lower(after)) & ~after.rlike("[a-z][A-Z]")
    words = F.array_sort(F.array_distinct(F.transform("_conflicts", lambda t: F.get(t, F.lit(0)))))
    kind = F.when(initial("text").rlike("[a-z][A-Z]"), "irregular-case").when(F.col("opening"), "chapter-opening").when((F.size("_conflicts") == 2) & (F.size(words) == 1), "two-peer-initial-word")
    return marked.where(~recased).select("row_id", kind.alias("kind"), words.alias("words")).where("kind is not null")
