"""Punctuation between stable words, and pairs of quotation marks."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from marginalia.functions.similarity import WORD, chunks
from marginalia.functions.text import QUOTES

#: Marks that look wrong: a lone stop or dot after white space, or several.
MARKS = re.compile(r"\s+[.•·](?=\s|$)|[.:;,][.:;,]+")
_VERSE_END = re.compile(r"[?!][.]*$", re.M)
#: Marks of an opening and a closing quotation by depth (fixed values).
OPEN, CLOSE = "«„", "»“"


def form(text: str, original: str = "") -> str:
    """Quotes folded to straight ones; apostrophes too where the original holds
    a double quote."""
    if any(c in QUOTES for c in original):
        text = text.translate(str.maketrans("’‘'", '"""'))
    return " ".join(text.translate(str.maketrans("„“”«»", '"""""')).split())


class _Words:
    """The words of a text with their places, found once."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.spans = [w.span() for w in WORD.finditer(text)]
        self.starts, self.ends = [s for s, _ in self.spans], [e for _, e in self.spans]
        self.values = [text[s:e].lower() for s, e in self.spans]
        self.places: dict[str, list[int]] = {}
        for i, w in enumerate(self.values):
            self.places.setdefault(w, []).append(i)

    def around(self, lo: int, hi: int) -> tuple[list[str], list[str]]:
        """Up to three words that end by ``lo``, and two that start from ``hi``."""
        left, right = bisect_right(self.ends, lo), bisect_left(self.starts, hi)
        return self.values[max(left - 3, 0) : left], self.values[right : right + 2]


def gap(text: str | _Words, left: list[str], right: list[str], fuzzy: bool = False) -> tuple[int, int, str] | None:
    """The only place where ``left`` words and ``right`` words (or the end)
    have nothing but punctuation between them.  ``fuzzy`` lets one word of four
    letters be off by one character where two others of four are equal.

    Only the places of the rarest word are looked at; of two words one is equal
    where a single one may be off, so ``fuzzy`` looks at those of the two
    rarest."""
    known = _Words(text) if isinstance(text, str) else text
    text, values, wanted = known.text, known.values, left + right

    def close(actual: list[str]) -> bool:
        off = [(a, b) for a, b in zip(actual, wanted, strict=False) if a != b]
        if not fuzzy or len(actual) != len(wanted) or len(off) != 1 or min(map(len, off[0])) < 4:
            return False
        same = sum(a == b and len(a) >= 4 for a, b in zip(actual, wanted, strict=True))
        return same >= 2 and sum(max(len(p), len(q)) for p, q, _ in chunks(*off[0])) <= 1

    rarest = sorted(range(len(wanted)), key=lambda k: len(known.places.get(wanted[k], ())))[: 2 if fuzzy else 1]
    hits = []
    for i in sorted({p - k for k in rarest for p in known.places.get(wanted[k], ())}):
        actual = values[i : i + len(wanted)] if 0 <= i <= len(values) - len(wanted) else None
        if actual is None or (actual != wanted and not close(actual)):
            continue
        end = known.ends[i + len(left) - 1]
        start = known.starts[i + len(left)] if right else len(text)
        if not re.search(r"\w", text[end:start]):
            hits.append((end, start, text[end:start]))
    return hits[0] if len(hits) == 1 else None


def suspects(text: str, verse: bool = False) -> list[tuple[int, int]]:
    """Places to look at: wrong marks, ends of verse, and the end of long prose
    without a stop."""
    found = [m.span() for m in MARKS.finditer(text)]
    if verse:
        found += [m.span() for m in _VERSE_END.finditer(text)]
    elif len(text) > 60 and re.search(r'[\w"”»]$', text):
        found.append((len(text), len(text)))
    return found


def decisions(text: str, cached: str | None, fresh: str | None, behind: str = "", verse: bool = False) -> list[tuple[int, int, str, str | None, str]]:
    """``(start, stop, before, after, reason)`` of a row's suspect places.

    Both readings must have the place between the same words, and agree on its
    form; or all end in a stop after a quote at the row's end; or be a plain
    stop where the row has two marks.  A dash at the end of a row is left to the
    repair of broken words, and a real stop before a capital is kept.
    ``behind`` is the next row's text."""
    out: list[tuple[int, int, str, str | None, str]] = []
    places = suspects(text, verse)
    if not places:
        return out
    known = {t: _Words(t) for t in {text, cached, fresh} if t}
    for lo, hi in places:
        left, right = known[text].around(lo, hi)
        place = gap(known[text], left, right) if left and len(left[-1]) >= 4 else None
        if place is None:
            continue
        start, stop, before = place
        found = [(gap(known[t], left, right) or gap(known[t], left, right, fuzzy=True)) if t else None for t in (cached, fresh)]
        read = [form(f[2], before) if f else None for f in found]
        after, reason = None, "punctuation-witness-conflict"
        if None not in read:
            ended = before.strip() and set(before.strip()) <= set(QUOTES) and all(r.endswith(".") and not re.search(r"[^\"„“”«»’'. ]", r) for r in read)
            if read[0] == read[1]:
                after = read[0]
            elif not right and ended:
                after = form(before) + "."
            elif before.strip() in (".:", ":.", ".,") and read[0] == "." and set(read[1]) <= set("., "):
                after = "."
        if after is not None and not right:
            next_word = WORD.match(behind.lstrip())
            if after in ("-", "–", "—"):
                after, reason = None, "wrap-dash-needs-span-review"
            elif after == "" and before.strip() == "." and next_word and not next_word[0].islower():
                after = None
        if after is not None:
            if found[0] and form(found[0][2], before) == after:
                after = found[0][2]
            elif right:
                after = f"{after} " if after else " "
            after = _own_quotes(before, after)
            reason = "punctuation-corroborated" if before == after else "source-punctuation-witnesses"
        out.append((start, stop, before, after, reason))
    return out


def _own_quotes(before: str, after: str) -> str:
    """The row's quotation marks in place of as many new ones."""
    old = [c for c in before if c in QUOTES]
    new = [c for c in after if c in QUOTES + "’‘"]
    if not old or len(old) != len(new):
        return after
    marks = iter(old)
    return "".join(next(marks) if c in QUOTES + "’‘" else c for c in after)


def repaired(rows: DataFrame, cached: str, fresh: str, *, behind: str | None = None) -> DataFrame:
    """``row_id, start, stop, before, after, reason`` of the suspect places of
    ``rows(row_id, text, cached, fresh)``; ``after`` is null in doubt."""
    columns = ["row_id", "text", cached, fresh, *([behind] if behind else [])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, text, *rest in frame[columns].itertuples(index=False):
                out += [(key, *d) for d in decisions(text or "", rest[0], rest[1], (rest[2] or "") if behind else "")]
            yield pd.DataFrame(out, columns=["row_id", "start", "stop", "before", "after", "reason"])

    return rows.select(*columns).mapInPandas(run, "row_id string, start int, stop int, before string, after string, reason string")


def paired(text: str) -> tuple[str, list[tuple[int, str]]]:
    """Text with paired double quotes as marks by depth, and ``(offset,
    reason)`` of marks left as they are: without a partner, or not clearly
    opening or closing."""
    out, stack, left = list(text), [], []
    for i, c in enumerate(text):
        if c not in QUOTES:
            continue
        before, after = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
        opens = bool(after) and not after.isspace() and (not before or before.isspace() or before in "([{—-:")
        closes = bool(before) and not before.isspace() and (not after or after.isspace() or after in ".,;:!?)]}" + QUOTES or after.isdigit())
        if opens and not closes:
            stack.append(i)
        elif closes and stack:
            at = stack.pop()
            out[at], out[i] = OPEN[len(stack) % 2], CLOSE[len(stack) % 2]
        else:
            left.append((i, "unpaired-or-ambiguous-quote"))
    left += [(i, "unclosed-quote") for i in stack]
    return "".join(out), sorted(left)


