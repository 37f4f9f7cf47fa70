"""Geometry of pages: rows, pitches, gaps, verse, headings, captions, footers
and the places of figures.

Page tables have ``page, row, text, x0, y0, x1, y1`` in shares of the page and
may have ``col``, ``size`` (type size), ``kind`` and ``italic`` (share of the
text).  Rules that depend on the order of a page's rows are functions of a list
of :class:`Line`; :func:`paged` gathers pages in the JVM and hands many of them
over at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from statistics import median

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions import matching
from marginalia.functions import text as X
from marginalia.functions.similarity import WORD, seq_ratio
from marginalia.operators.joins import nearest
from marginalia.operators.rowrules import comparable

#: Shares of the page (fixed values): rows are one from this distance of
#: centres on; verse and prose end at a larger gap; edges may be this far off.
SAME_ROW, VERSE_GAP, EDGE = 0.008, 0.035, 0.015


@dataclass(frozen=True)
class Line:
    """A row of a page."""

    row: object
    text: str
    x0: float
    y0: float
    x1: float
    y1: float
    col: int = 0
    size: float | None = None
    kind: str = "text"
    italic: float = 0.0

    @property
    def width(self) -> float:
        return self.x1 - self.x0

    @property
    def height(self) -> float:
        return self.y1 - self.y0

    @property
    def centre(self) -> float:
        return (self.y0 + self.y1) / 2

    @property
    def words(self) -> list[str]:
        return [w.lower() for w in WORD.findall(self.text)]


_BASE = ["text", "x0", "y0", "x1", "y1"]
_MORE = {"col": "int", "size": "double", "kind": "string", "italic": "double"}



def paged(rows: DataFrame, find: Callable[[list[Line]], list[tuple]], result: str, page: str = "page", row: str = "row", other: DataFrame | None = None) -> DataFrame:
    """``page`` with the columns of ``result`` that ``find`` gives for the
    lines of each page, by column and place (and for those of another reading
    where one is given)."""

    def gathered(df: DataFrame, name: str) -> DataFrame:
        held = [c for c in _MORE if c in df.columns]
        line = F.struct(F.col(row).alias("row"), *_BASE, *[F.col(c).cast(_MORE[c]).alias(c) for c in held])
        order = F.struct(*([F.coalesce("col", F.lit(0)).alias("c")] if "col" in df.columns else []), "y0", "x0", F.col(row).alias("r"))
        return df.groupBy(page).agg(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("l")))), lambda x: x["l"]).alias(name))

    pages = gathered(rows, "lines")
    if other is not None:
        pages = pages.join(gathered(other, "peers"), page, "left")
    kind = rows.select(page).schema[0].dataType.simpleString()
    names = [c.strip().split(" ")[0] for c in result.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for at in range(len(frame)):
                lists = [frame[c].iloc[at] for c in frame.columns[1:]]
                args = [[] if x is None else [Line(**{k: v for k, v in r.items() if v is not None}) for r in x] for x in lists]
                out += [(frame[page].iloc[at], *found) for found in find(*args)]
            yield pd.DataFrame(out, columns=[page, *names])

    return pages.mapInPandas(run, f"`{page}` {kind}, {result}")


# ---- rows ------------------------------------------------------------------


def native_rows(pieces: list[Line], points: float = 612.0) -> list[list[Line]]:
    """Pieces of native text as rows: a piece joins the open row while its
    centre is near that of the row's first piece."""
    rows: list[list[Line]] = []
    for piece in sorted(pieces, key=lambda p: (p.col, p.centre, p.x0)):
        if rows and rows[-1][0].col == piece.col and abs(rows[-1][0].centre - piece.centre) < SAME_ROW:
            rows[-1].append(piece)
        else:
            rows.append([piece])
    return [sorted(r, key=lambda p: p.x0) for r in rows]


def native_text(row: list[Line], points: float = 612.0) -> str:
    """A row's text, pieces apart by over half a point with a space between."""
    out = row[0].text
    for a, b in zip(row, row[1:], strict=False):
        apart = (b.x0 - a.x1) * points > 0.5 and not out.endswith(" ") and not b.text.startswith(" ")
        out += (" " if apart else "") + b.text
    return out


def merged_native(rows: DataFrame, points: float = 612.0) -> DataFrame:
    """``page, text, x0, y0, x1, y1`` of native pieces joined into rows."""

    def find(lines: list[Line]) -> list[tuple]:
        merged = native_rows(lines, points)
        return [(native_text(r, points), min(p.x0 for p in r), min(p.y0 for p in r), max(p.x1 for p in r), max(p.y1 for p in r)) for r in merged]

    return paged(rows, find, "text string, x0 double, y0 double, x1 double, y1 double")


def pitches(rows: DataFrame, least: int = 8, by: tuple[str, ...] = ("page", "col")) -> DataFrame:
    """``by, advances, pitch``: the median distance of successive centres of a
    column, where there are at least ``least`` of them."""
    centre = (F.col("y0") + F.col("y1")) / 2
    placed = rows.withColumn("_centre", centre)
    ahead = F.lead("_centre").over(Window.partitionBy(*by).orderBy("_centre", "row"))
    steps = placed.withColumn("_step", ahead - F.col("_centre")).where("_step > 0")
    return steps.groupBy(*by).agg(F.count("*").alias("advances"), F.median("_step").alias("pitch")).where(F.col("advances") >= least)


def truncated(rows: DataFrame, peers: DataFrame, fuzzy: bool = True) -> DataFrame:
    """``page, row, peer``: rows that a peer of the same column and place
    shows to be cut: it reaches out by over a tenth of the page, the row is
    under three quarters as wide, and two words of three letters (or one alike
    of six, if it is under half as wide and ``fuzzy``) are in both.  The first peer
    counts."""
    b = peers.select(*[F.col(c).alias(f"p_{c}") for c in peers.columns])
    met = rows.where(F.size(X.tokens(F.col("text"))) >= 3).join(b, (F.col("page") == F.col("p_page")) & (F.col("col") == F.col("p_col")))
    near = F.abs(F.col("y0") + F.col("y1") - F.col("p_y0") - F.col("p_y1")) / 2 <= 0.012
    extra = F.greatest(F.col("x0") - F.col("p_x0"), F.col("p_x1") - F.col("x1")) > 0.1
    wide, own = F.col("p_x1") - F.col("p_x0"), F.col("x1") - F.col("x0")
    words = lambda c: F.array_distinct(X.tokens(F.lower(F.col(c))))
    anchors = F.size(F.filter(F.array_intersect(words("text"), words("p_text")), lambda w: F.length(w) >= 3))

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str, y: str) -> bool:
            return any(SequenceMatcher(None, v, w).ratio() >= 0.8 for v in map(str.lower, WORD.findall(x)) if len(v) >= 6 for w in map(str.lower, WORD.findall(y)))

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    found = met.where(near & extra & (own < 0.75 * wide)).withColumn("_anchors", anchors).withColumn("_half", own < 0.5 * wide)
    sure = found.where("_anchors >= 2").select("page", "row", "p_row")
    if not fuzzy:
        return sure.groupBy("page", "row").agg(F.min("p_row").alias("peer"))
    maybe = found.where("_anchors < 2 and _half").where(alike("text", "p_text")).select("page", "row", "p_row")
    return sure.unionByName(maybe).groupBy("page", "row").agg(F.min("p_row").alias("peer"))


def gaps(lines: list[Line], peers: list[Line]) -> list[tuple]:
    """``(row before, peer, top, bottom, represented)``: where about two line
    advances between prose rows hold a peer that no row reads."""
    body = sorted((r for r in lines if len(r.words) >= 5), key=lambda r: r.centre)
    steps = [b.centre - a.centre for a, b in zip(body, body[1:], strict=False) if a.col == b.col and 0 < b.centre - a.centre < 0.05]
    if len(steps) < 4:
        return []
    pitch, out = median(steps), []
    for left, right in zip(body, body[1:], strict=False):
        if left.col != right.col or not 1.6 * pitch <= right.centre - left.centre <= 2.6 * pitch:
            continue
        for peer in peers:
            inside = peer.col == left.col and left.centre + 0.6 * pitch < peer.centre < right.centre - 0.6 * pitch
            if not inside or len(peer.words) < 8 or peer.width < 0.3 or abs(peer.x0 - left.x0) > 0.04:
                continue
            read = comparable(peer.text)
            if any(abs(r.centre - peer.centre) < pitch and SequenceMatcher(None, comparable(r.text), read).ratio() >= 0.6 for r in body):
                continue
            anchors = {w for w in read if len(w) >= 4}
            maybe = any(len(anchors & set(comparable(r.text))) >= 3 for r in (left, right))
            out.append((left.row, peer.row, left.centre + 0.2 * pitch, right.centre - 0.2 * pitch, maybe))
    return out


def gap_text_agrees(candidate: str, cached: str, previous: str, known: Callable[[str], bool]) -> bool:
    """Whether a cached reading supports a gap's text: the same words, or all
    but the first, which completes the previous row's broken word."""
    own, other = comparable(candidate), comparable(cached)
    if own == other:
        return True
    broken = re.search(r"([^\W\d_]+)-$", previous)
    return bool(len(own) > 1 and own[1:] == other and broken and known(broken[1].lower() + own[0]))


def presence_supported(cached: str, readings: list[str], independent: list[tuple[str, float]]) -> bool:
    """Whether two readings and a sure one of another engine (0.8) show that a
    line is there: eight words, three long ones shared, 97 % alike, at most two
    changed characters."""
    tokens = lambda t: re.findall(r"[^\W_]+", t.lower())
    own = tokens(cached)
    long = {w for w in own if len(w) >= 4}

    def near(text: str) -> bool:
        matcher = SequenceMatcher(None, " ".join(own), " ".join(tokens(text)))
        changed = sum(max(j - i, m - k) for tag, i, j, k, m in matcher.get_opcodes() if tag != "equal")
        return len(long & set(tokens(text))) >= 3 and matcher.ratio() >= 0.97 and changed <= 2

    return len(own) >= 8 and len(readings) == 2 and all(map(near, readings)) and any(s >= 0.8 and near(t) for t, s in independent)


@F.pandas_udf(T.BooleanType())
def same_line(candidate: pd.Series, text: pd.Series) -> pd.Series:
    """85 % alike in lower case, or equal without white space where three
    letters stand apart."""

    def one(a: str, b: str) -> bool:
        a, b = a.lower(), b.lower()
        if a == b or (sum(len(w) == 1 and w.isalpha() for w in a.split()) >= 3 and "".join(a.split()) == "".join(b.split())):
            return True
        matcher = SequenceMatcher(None, a, b, autojunk=False)
        return matcher.real_quick_ratio() >= 0.85 and matcher.quick_ratio() >= 0.85 and matching.ratio(a, b) >= 0.85  # cheap bounds first

    return pd.Series([a is not None and b is not None and one(a, b) for a, b in zip(candidate, text, strict=True)], dtype=bool)


def aligned_source(rows: DataFrame, source: DataFrame, reach: float = 0.012) -> DataFrame:
    """``page, row, source_row``: the nearest source row of each row, where it
    has the same text.  Both have ``page, row, centre, text``."""
    met = nearest(rows, source, "page", "centre", "centre", reach, "row", "row").where("nearest_id is not null")
    met = met.join(source.select(F.col("row").alias("nearest_id"), F.col("text").alias("_other")), "nearest_id")
    return met.where(same_line("_other", "text")).select("page", "row", F.col("nearest_id").alias("source_row"))


# ---- blocks ----------------------------------------------------------------


def segmented(lines: list[Line], margin: float | None = None) -> list[tuple]:
    """``(row, block, kind, continuation)``: rows of a page as blocks.

    A block starts where the kind or column changes, after a gap (0.035 in
    verse), at a number, and at an indent beyond the margin (the given one or
    the 20th percentile of left edges).  A short row after a broad one is no
    new paragraph at an ordinary pitch if it starts in lower case.  Heading rows
    join while they touch and are set in one size.  The first block goes on
    from the page before if it neither is indented nor starts a sentence."""
    out: list[tuple] = []
    block, last = -1, None
    body = [r for r in lines if r.kind == "text"]
    left = margin if margin is not None else sorted(r.x0 for r in body)[len(body) // 5] if body else 0.0
    steps = [b.centre - a.centre for a, b in zip(body, body[1:], strict=False) if a.col == b.col and b.centre > a.centre]
    pitch, broad = (median(steps) if len(steps) >= 8 else None), max((r.width for r in body), default=0.0)
    for r in lines:
        indented = r.x0 > left + 0.018
        if last is None or last.kind != r.kind or last.col != r.col:
            new = True
        elif r.kind == "heading":
            new = not (-0.015 <= r.y0 - last.y1 <= 0.005) or abs((r.size or 0) - (last.size or 0)) >= 0.15
        elif r.kind == "verse":
            new = r.y0 - last.y1 > VERSE_GAP
        else:
            gap, numbered = r.y0 - last.y1 > 0.012, bool(re.match(r"\s*\d{1,3}[.)]\s", r.text))
            goes_on = pitch and last.width >= 0.8 * broad and 0.7 * pitch <= r.centre - last.centre <= 1.3 * pitch and r.text[:1].islower()
            new = numbered or ((gap or indented) and not goes_on)
        first = last is None
        block += new
        continuation = first and r.kind in ("text", "quote") and not indented and not r.text[:1].isupper()
        out.append((r.row, block, r.kind, bool(continuation)))
        last = r
    return out


def line_policy(lines: DataFrame, lexicon: DataFrame, by: str = "doc_id", order: str = "pos") -> DataFrame:
    """``by, order, action, joined``: how a line joins the next one.

    A soft hyphen goes.  At a hyphen between letters: kept where the hyphenated
    word is known (a dot read after it goes), removed where the joined word is
    known, kept else, and a dotted one keeps its space.  ``lexicon(term)``."""
    w = Window.partitionBy(by).orderBy(order)
    base = lines.select(by, order, F.col("line").alias("a"), F.lead("line").over(w).alias("b")).where("b is not null")
    left, dash = F.regexp_extract("a", r"([\p{L}\p{N}_]+)(-\.?)$", 1), F.regexp_extract("a", r"([\p{L}\p{N}_]+)(-\.?)$", 2)
    right = F.regexp_extract("b", r"^(\p{L}+)", 1)
    cut = base.withColumn("_dash", dash).withColumn("_whole", F.lower(F.concat(left, right))).withColumn("_kept", F.lower(F.concat(left, F.lit("-"), right)))
    broken = (F.col("_dash") != "") & (right != "")
    known = lexicon.select("term").distinct()
    whole = known.select(F.col("term").alias("_w")).withColumn("_has_whole", F.lit(True))
    kept = known.select(F.col("term").alias("_k")).withColumn("_has_kept", F.lit(True))
    met = cut.join(whole, broken & (F.col("_whole") == F.col("_w")), "left").join(kept, broken & (F.col("_kept") == F.col("_k")), "left")
    dotted = F.col("_dash") == "-."
    action = (
        F.when(F.col("a").endswith("­"), "remove-discretionary")
        .when(broken & F.col("_has_kept") & dotted, "remove-noise-retain-compound")
        .when(broken & F.col("_has_kept"), "retain")
        .when(broken & F.col("_has_whole"), "remove")
        .when(broken & dotted, "space")
        .when(broken, "retain")
        .otherwise("space")
    )
    cutoff = F.when(F.col("action").isin("remove", "remove-noise-retain-compound"), F.when((F.col("action") == "remove") & dotted, 2).otherwise(1)).when(F.col("action") == "remove-discretionary", 1).otherwise(0)
    first = F.substr("a", F.lit(1), F.length("a") - cutoff)
    done = met.withColumn("action", action)
    return done.select(by, order, "action", F.concat(first, F.when(F.col("action") == "space", " ").otherwise(""), F.col("b")).alias("joined"))


def body_start(lines: list[Line], cutoff: float = 0.27) -> list[tuple]:
    """``(configured, inferred, rows)``: prose above a chapter's title cutoff
    that runs on into the body: back from the first body row while width,
    height, margin and pitch are the body's."""

    def prose(r: Line) -> bool:
        letters = [c for c in r.text if c.isalpha()]
        return r.kind == "text" and len(letters) >= 40 and len(r.text.split()) >= 6 and sum(c.isupper() for c in letters) < 0.65 * len(letters)

    out = []
    for col in sorted({r.col for r in lines}):
        rows = [r for r in lines if r.col == col]
        body = [r for r in rows if r.y0 >= cutoff and prose(r)]
        steps = [b.centre - a.centre for a, b in zip(body, body[1:], strict=False) if b.y0 > a.y0]
        if len(body) < 4 or not steps:
            continue
        width, height, left, pitch = median(r.width for r in body), median(r.height for r in body), median(r.x0 for r in body), median(steps)

        def fits(r: Line, w=width, h=height, x=left) -> bool:
            return prose(r) and 0.8 * w <= r.width <= 1.2 * w and 0.7 * h <= r.height <= 1.3 * h and abs(r.x0 - x) <= 0.03

        at = next((i for i, r in enumerate(rows) if r.y0 >= cutoff and fits(r)), None)
        if at is None or rows[at].y0 - cutoff > 1.4 * pitch:
            continue
        first = at
        while first and fits(rows[first - 1]) and 0.65 * pitch <= rows[first].centre - rows[first - 1].centre <= 1.4 * pitch:
            first -= 1
        if first < at and rows[first].y0 < cutoff:
            out.append((cutoff, rows[first].y0, at - first))
    return out


def verse(lines: list[Line], body_width: float) -> list[tuple]:
    """``(first, last, rows)``: runs of short, ragged rows that are verse.

    At least three rows, seven tenths under 0.65 of the measure, raggedness of
    0.05; runs that are not in italics also need capitals on 45 % of the rows,
    three words a row, no broken words, and eight rows or an alternating
    indent."""
    runs: list[list[Line]] = []
    for r in lines:
        short = r.kind == "text" and r.size is not None and (r.italic >= 0.8 or r.width < 0.65 * body_width)
        if short and runs and runs[-1] and r.y0 - runs[-1][-1].y1 <= VERSE_GAP:
            runs[-1].append(r)
        elif short:
            runs.append([r])
        else:
            runs.append([])

    def holds(run: list[Line]) -> bool:
        widths = [r.width for r in run]
        if len(run) < 3 or sum(w < 0.65 * body_width for w in widths) < 0.7 * len(run) or max(widths) - min(widths) < 0.05 * body_width:
            return False
        if sum(r.italic >= 0.8 for r in run) >= 0.8 * len(run):
            return True
        steps = [b.x0 - a.x0 for a, b in zip(run, run[1:], strict=False) if abs(b.x0 - a.x0) > 0.02]
        turns = sum(a * b < 0 for a, b in zip(steps, steps[1:], strict=False)) >= 2
        capitals = sum(r.text.lstrip('("“')[:1].isupper() for r in run)
        broken = any(re.search(r"[A-Za-z]-$", a.text) and b.text[:1].islower() for a, b in zip(run, run[1:], strict=False))
        return (len(run) >= 8 or turns) and median(len(r.text.split()) for r in run) >= 3 and capitals >= 0.45 * len(run) and not broken

    return [(run[0].row, run[-1].row, len(run)) for run in runs if holds(run)]


def inset_verse(lines: list[Line], body_width: float) -> list[tuple]:
    """``(first, last, rows)``: deeply inset, aligned, ragged rows after an
    introduction: four after a colon, eight smaller ones after a sentence."""
    broad = [r for r in lines if r.kind == "text" and r.width >= 0.8 * body_width]
    if len(broad) < 3:
        return []
    left, height, out, upto = median(r.x0 for r in broad), median(r.height for r in broad), [], 0
    for i, intro in enumerate(lines[:-1]):
        colon = intro.text.rstrip().endswith(":")
        ended = intro.text.rstrip().endswith((".", "!", "?", "”", '"', "»")) and lines[i + 1].y0 - intro.y1 >= 0.008
        if i < upto or not (colon or ended):
            continue
        run: list[Line] = []
        for r in lines[i + 1 :]:
            before = run[-1] if run else intro
            overlaps = r.y0 - before.y1 < -0.5 * min(r.height, before.height)
            shallow = r.x0 - left < (0.06 if colon else 0.12) * body_width
            if r.kind != "text" or r.col != intro.col or shallow or r.width >= 0.95 * body_width or overlaps or r.y0 - before.y1 > VERSE_GAP or r.centre - before.centre < 0.004 or (run and abs(r.x0 - run[0].x0) > 0.012):
                break
            run.append(r)
        widths = [r.width for r in run]
        if not (4 if colon else 8) <= len(run) <= 30:
            continue
        small = colon or median(r.height for r in run) <= 0.9 * height
        ragged = max(widths) - min(widths) > 0.05 * body_width and sum(w < 0.7 * body_width for w in widths) >= 0.7 * len(widths)
        full = sum(max(widths) - w < 0.025 * body_width for w in widths) > 0.5 * len(widths)
        prose = any(re.search(r"[^\W\d_]-$", r.text) or re.match(r"\s*(?:\d+[.)]|[•▪])\s", r.text) for r in run)
        if small and ragged and not full and not prose:
            out.append((run[0].row, run[-1].row, len(run)))
            upto = i + 1 + len(run)
    return out


def isolated_headings(lines: list[Line]) -> list[tuple]:
    """``(row, text)``: short labels at the margin between prose, set apart
    from the row before, which ends a sentence, and at an ordinary pitch from
    the row behind, which starts one."""
    broad = sorted((r for r in lines if len(r.text) >= 60), key=lambda r: r.x0)
    steps = [b.centre - a.centre for a, b in zip(lines, lines[1:], strict=False) if a.col == b.col and b.centre > a.centre]
    if len(broad) < 6 or len(steps) < 4:
        return []
    left, right = broad[len(broad) // 5].x0, sorted(r.x1 for r in broad)[4 * len(broad) // 5]
    height, pitch, out = median(r.height for r in broad), median(steps), []
    for i, (r, behind) in enumerate(zip(lines, lines[1:], strict=False)):
        text, before = r.text.strip(), lines[i - 1] if i else None
        label = r.kind == "text" and 3 <= len(text) <= 55 and text[:1].isupper() and not re.search(r"[.!?;:,\"”]$", text)
        placed = abs(r.x0 - left) <= EDGE and 0.6 * height <= r.height <= 1.6 * height and 0.65 * pitch <= behind.centre - r.centre <= 1.55 * pitch
        prose = len(behind.text) >= 60 and behind.text[:1].isupper() and abs(behind.x0 - left) <= EDGE
        if before is None:
            apart = text.isupper() or r.width <= 0.65 * (right - left)
        else:
            apart = bool(re.search(r"[.!?][\"”’]?\d*$", before.text.strip())) and r.centre - before.centre >= 1.15 * pitch
        if label and placed and prose and apart:
            out.append((r.row, text))
    return out


_MARK = re.compile(r"^\s*(?:[•*–▪]|\d{1,3}[.)]|[a-z][.)])\s")


def hanging_items(lines: list[Line], left_of: Callable[[Line], float] | None = None) -> list[tuple]:
    """``(row, item, continuation)``: rows of lists: those with a visible mark,
    and those below that align with its text, in one size and without a gap."""
    out, active, left, item = [], None, 0.0, -1
    for r in lines:
        mark = _MARK.match(r.text)
        if mark:
            item += 1
            left = left_of(r) if left_of else r.x0 + r.width * mark.end() / max(len(r.text), 1)
            active = r
            out.append((r.row, item, False))
        elif active is not None and r.col == active.col and abs(r.x0 - left) <= 0.008 and abs((r.size or 0) - (active.size or 0)) < 0.15 and -0.005 <= r.y0 - active.y1 <= 0.02 and r.kind != "heading":
            active = r
            out.append((r.row, item, True))
        else:
            active = None
    return out


# ---- footers, captions, zones ----------------------------------------------


def note_footer(lines: list[Line], note_start: float = 2.0) -> list[tuple]:
    """``(row, text)``: the first numbered row in small type in the lower half
    that no note zone holds and that small rows follow."""
    sizes = [r.size for r in lines if r.size and 0.15 < r.y0 < 0.48]
    if len(sizes) < 3:
        return []
    body = median(sizes)
    small = [r for r in lines if (r.size if r.size is not None else body) <= 0.82 * body]
    for r in small:
        follows = any(r.y0 < s.y0 < min(r.y0 + 0.06, 0.86) for s in small)
        if 0.45 < r.y0 < min(0.86, note_start) and follows and re.match(r"\s*[1-9]\d?\s+[A-Za-zА-Яа-я]", r.text):
            return [(r.row, r.text)]
    return []


def small_type_zone(lines: list[Line]) -> list[tuple]:
    """``(row, cutoff, body height)``: where a footer in smaller type starts
    with a reference mark, without a separating rule."""
    prose = [r.height for r in lines if len(r.text) >= 25 and r.width > 0.5 and 0.1 < r.y0 < 0.8]
    if len(prose) < 10:
        return []
    rows, body = sorted(lines, key=lambda r: r.y0), median(prose)
    for i, r in enumerate(rows):
        if not i or not 0.5 < r.y0 < 0.98 or not re.match(r"\s*(?:[＊*†‡•'\"]|\d{1,2}(?!\d)|[¹²³⁴⁵⁶⁷⁸⁹])\s*", r.text):
            continue
        tail = rows[i:]
        cited = re.search(r"\b[^\W\d_]\.", r.text) and re.search(r"\b(?:18|19|20)\d{2}\b", " ".join(t.text for t in tail[:3]))
        tight = r.y0 - rows[i - 1].y1 < 0.008 or median(t.height for t in tail) >= 0.92 * body
        full = any(t.height >= 0.98 * body and len(t.text) > 15 for t in tail[1:])
        if cited or not (tight or full):
            return [(r.row, r.y0 - 0.001, body)]
    return []


_CAPTION = re.compile(r"(?i)(?:^|\s)(?:фото|рис\.|fig\.|figure|photo)(?:\s|$)")


def captions(lines: list[Line], bottom: float) -> list[tuple]:
    """``(row, run)``: one to four adjacent rows in small type near a figure's
    bottom that name a figure."""
    broad = [r.height for r in lines if len(r.text) >= 15]
    if len(broad) < 8:
        return []
    body, runs = median(broad), []
    for r in sorted(lines, key=lambda r: r.y0):
        if not bottom - 0.15 <= r.y0 <= bottom + 0.1 or r.height > 0.86 * body:
            continue
        if runs and r.y0 - runs[-1][-1].y1 <= body and abs(r.x0 - runs[-1][-1].x0) < 0.04:
            runs[-1].append(r)
        else:
            runs.append([r])
    return [(r.row, k) for k, run in enumerate(runs) if len(run) <= 4 and _CAPTION.search(" ".join(x.text for x in run)) for r in run]


def folio_controls(folios: DataFrame, by: str, reach: int = 12) -> DataFrame:
    """``by, page, controls, centre, tolerance``: for each page with a printed
    number the place that the numbers within ``reach`` pages have (those of the
    whole book where they are under three) and how far off it may be.

    ``folios(by, page, y)``, one a page.  A range frame collects at most
    2 * reach + 1 places."""
    near = Window.partitionBy(by).orderBy("page").rangeBetween(-reach, reach)
    middle = lambda v: (F.element_at(v, ((F.size(v) + 1) / 2).cast("int")) + F.element_at(v, (F.size(v) / 2).cast("int") + 1)) / 2
    held = folios.withColumn("_near", F.array_sort(F.collect_list("y").over(near)))
    held = held.withColumn("_centre", middle(F.col("_near")))
    held = held.withColumn("_mad", middle(F.array_sort(F.transform("_near", lambda y: F.abs(y - F.col("_centre"))))))
    whole = folios.groupBy(F.col(by).alias("_by")).agg(F.median("y").alias("_all"))
    spread = folios.join(whole, F.col(by) == F.col("_by")).groupBy("_by", "_all").agg(F.median(F.abs(F.col("y") - F.col("_all"))).alias("_all_mad"), F.count("*").alias("_count"))
    met = held.join(spread, F.col(by) == F.col("_by"))
    local = F.size("_near") >= 3
    mad = F.when(local, F.col("_mad")).otherwise(F.col("_all_mad"))
    return met.select(
        by,
        "page",
        F.when(local, F.size("_near")).otherwise(F.col("_count")).cast("long").alias("controls"),
        F.round(F.when(local, F.col("_centre")).otherwise(F.col("_all")), 6).alias("centre"),
        F.round(F.least(F.lit(0.035), F.greatest(F.lit(0.015), 4 * mad)), 6).alias("tolerance"),
    )


def footer_families(rows: DataFrame, by: str, offset: Column, least: int = 3) -> DataFrame:
    """``by, family, pages``: printer's labels that stand before the page's
    printed number on at least ``least`` pages.

    ``rows(by, page, text)``; ``offset`` is printed number less page."""
    cut = r"^([0-9ЗзОоІIl]{1,3}\s*[*∗]?)\s+(.+?)\s+(\d{1,4})$"
    label, number = F.regexp_extract(F.trim("text"), cut, 2), F.regexp_extract(F.trim("text"), cut, 3)
    signed = rows.select(by, "page", X.signature(label).alias("family"), number.alias("_n"), offset.alias("_offset"))
    fits = (F.col("_n") != "") & (F.expr("try_cast(_n as long)") == F.col("page") + F.col("_offset")) & F.length("family").between(4, 50)
    return signed.where(fits).groupBy(by, "family").agg(F.count_distinct("page").alias("pages")).where(F.col("pages") >= least)


def footer_family(rows: DataFrame, families: DataFrame, by: str) -> DataFrame:
    """``rows(by, row, label)`` with their ``family``: equal, or the only one
    with the same last long word that is three quarters alike."""
    signed = rows.withColumn("_key", X.signature(F.col("label")))
    last = lambda c: F.element_at(F.split(F.col(c), " "), -1)
    known = families.select(F.col(by).alias("_by"), "family", last("family").alias("_last"))
    met = signed.withColumn("_word", last("_key")).join(known, (F.col(by) == F.col("_by")) & (F.col("_word") == F.col("_last")))
    exact = F.col("family") == F.col("_key")
    near = met.where(exact | ((F.length("_word") >= 5) & (seq_ratio("family", "_key") >= 0.75)))
    counted = near.groupBy(by, "row").agg(F.max(F.when(exact, F.col("family"))).alias("_same"), F.count("*").alias("_n"), F.min("family").alias("_one"))
    found = counted.select(F.col(by).alias("_b"), F.col("row").alias("_r"), F.coalesce("_same", F.when(F.col("_n") == 1, F.col("_one"))).alias("family"))
    return rows.join(found, (F.col(by) == F.col("_b")) & (F.col("row") == F.col("_r")), "left").drop("_b", "_r")


def mode_offset(rows: DataFrame, by: str, offset: str, page: str) -> DataFrame:
    """``by, offset, pages``: the offset on most pages, ties to the smallest."""
    counts = rows.groupBy(by, offset).agg(F.count_distinct(page).alias("pages"))
    best = counts.groupBy(by).agg(F.min(F.struct((-F.col("pages")).alias("n"), F.abs(offset).alias("a"), F.col(offset).alias("o"), F.col("pages").alias("pages"))).alias("b"))
    return best.select(by, F.col("b.o").alias(offset), F.col("b.pages").alias("pages"))


def offset_runs(rows: DataFrame, offset: Column, page: str, least: int = 3) -> DataFrame:
    """``offset, pages, page_list``: offsets seen on at least ``least`` pages."""
    each = rows.select(offset.alias("offset"), F.col(page).alias("_page")).distinct()
    return each.groupBy("offset").agg(F.count("*").alias("pages"), F.array_sort(F.collect_list("_page")).alias("page_list")).where(F.col("pages") >= least)


def gutter(rows: DataFrame, page: str = "page", least: int = 8) -> DataFrame:
    """``page, split, left_edge, right_edge``: between the 85th percentile of
    the left column's right edges and the 15th of the right column's left ones,
    where both have eight rows and are 0.025 apart."""
    cut = rows.where("y0 < 0.9").groupBy(page).agg(
        F.array_sort(F.collect_list(F.when(F.col("x1") < 0.49, F.col("x1")))).alias("l"), F.array_sort(F.collect_list(F.when(F.col("x0") > 0.51, F.col("x0")))).alias("r")
    )
    at = lambda v, share: F.try_element_at(F.col(v), (F.bround((F.size(v) - 1) * F.lit(share)).cast("int") + 1))
    edges = cut.where((F.size("l") >= least) & (F.size("r") >= least)).select(page, at("l", 0.85).alias("a"), at("r", 0.15).alias("b")).where("b - a >= 0.025")
    return edges.select(page, F.round((F.col("a") + F.col("b")) / 2, 4).alias("split"), F.round("a", 4).alias("left_edge"), F.round("b", 4).alias("right_edge"))


# ---- figures ---------------------------------------------------------------


def figure_places(rows: DataFrame, figures: DataFrame, by: str) -> DataFrame:
    """``figure, seq, place``: the row before which a figure goes: the first at
    or after its place, moved up where that would part a word broken over two
    rows; ``after-block`` where the row above that is broken too, ``end`` where
    no row follows.

    ``rows(by, seq, page, y0, text)`` in order of ``seq``,
    ``figures(by, figure, page, y0)``.  Rows and figures are ordered together,
    so no row meets a figure in a join."""
    w = Window.partitionBy(by).orderBy("seq")
    broken = F.lag("text").over(w).rlike(r"[\p{L}\p{N}_]-\.?\s*$") & F.col("text").rlike(r"^\s*\p{Ll}") & (F.lag("page").over(w) == F.col("page"))
    lines = rows.withColumn("_broken", F.coalesce(broken, F.lit(False)))
    lines = lines.withColumn("_above", F.coalesce(F.lag("_broken").over(w), F.lit(False)))
    both = lines.select(by, "page", "y0", F.lit(1).alias("_kind"), F.struct("seq", "_broken", "_above").alias("_row"), F.lit(None).cast("string").alias("figure"))
    both = both.unionByName(figures.select(by, "page", "y0", F.lit(0).alias("_kind"), F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), F.col("figure").cast("string").alias("figure")))
    ahead = Window.partitionBy(by).orderBy("page", "y0", "_kind", F.col("_row.seq")).rowsBetween(0, Window.unboundedFollowing)
    found = both.withColumn("_next", F.first("_row", True).over(ahead)).where("figure is not null")
    place = F.when(F.col("_next").isNull(), "end").when(F.col("_next._broken") & F.col("_next._above"), "after-block").when(F.col("_next._broken"), "moved").otherwise("before")
    seq = F.when(F.col("_next._broken") & ~F.col("_next._above"), F.col("_next.seq") - 1).otherwise(F.col("_next.seq"))
    return found.select(by, "figure", seq.alias("seq"), place.alias("place"))


def figure_flow(rows: DataFrame, figures: DataFrame, least: int = 3) -> DataFrame:
    """``figure, flow``: a figure of at most 0.62 of the width floats away from
    the side on which at least ``least`` rows stand beside it.

    Both have ``page, x0, y0, x1, y1``."""
    f = figures.where("x1 - x0 <= 0.62").select("figure", F.col("page").alias("_page"), *[F.col(c).alias(f"f_{c}") for c in ("x0", "y0", "x1", "y1")])
    beside = rows.join(f, (F.col("page") == F.col("_page")) & (F.col("y1") > F.col("f_y0")) & (F.col("y0") < F.col("f_y1")))
    counts = beside.groupBy("figure").agg(F.count_if(F.col("x0") >= F.col("f_x1") - 0.06).alias("r"), F.count_if(F.col("x1") <= F.col("f_x0") + 0.06).alias("l"))
    return counts.where(F.greatest("l", "r") >= least).select("figure", F.when(F.col("r") > F.col("l"), "float-left").otherwise("float-right").alias("flow"))


def grouped_boxes(boxes: DataFrame, page: str = "page", gap: float = 0.035) -> DataFrame:
    """``page, x0, y0, x1, y1`` of a page's boxes merged where they overlap
    sideways and are at most ``gap`` apart, until nothing changes."""
    from marginalia.operators.layout import group_boxes

    @F.pandas_udf("array<array<double>>")
    def merge(values: pd.Series) -> pd.Series:
        return values.map(lambda v: [list(b) for b in group_boxes([tuple(x) for x in v], gap)])

    gathered = boxes.groupBy(page).agg(F.collect_list(F.array(*[F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")])).alias("v"))
    return gathered.select(page, F.explode(merge("v")).alias("b")).select(page, *[F.col("b")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))])
