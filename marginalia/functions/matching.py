"""Matching blocks of two sequences, as ``difflib.SequenceMatcher`` without
junk finds them, by searches for whole stretches.

Items are written as characters, so that a search runs in the string type.  No
block holds an item that the other side lacks, so blocks lie within the
stretches between such items; texts that differ here and there are matched
stretch by stretch, not place by place."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Hashable, Iterator, Sequence


def _coded(a: Sequence[Hashable], b: Sequence[Hashable]) -> tuple[str, str] | None:
    """Both sequences as strings of equal characters for equal items; none
    where there are more kinds of items than characters."""
    if isinstance(a, str) and isinstance(b, str):
        return a, b
    codes: dict[Hashable, int] = {}
    for x in (*a, *b):
        codes.setdefault(x, len(codes))
    if len(codes) > 0x10FFFF:
        return None
    return "".join([chr(codes[x]) for x in a]), "".join([chr(codes[x]) for x in b])


def _stretches(a: str, b: str) -> list[tuple[int, int]]:
    """The stretches of ``a`` of characters that ``b`` has."""
    shared, out, start = set(b), [], -1
    if shared.issuperset(a):
        return [(0, len(a))] if a else []
    for i, x in enumerate(a):
        if x in shared:
            if start < 0:
                start = i
        elif start >= 0:
            out.append((start, i))
            start = -1
    return [*out, (start, len(a))] if start >= 0 else out


def _grown(a: str, b: str, i: int, least: int, most: int, low: int, high: int) -> int:
    """The longest piece of ``a`` at ``i`` of ``least`` to ``most`` characters
    that ``b`` has in the range; it has that of ``least``."""
    step = 1
    while least < most:
        tried = min(least + step, most)
        if b.find(a[i : i + tried], low, high) < 0:
            most = tried - 1
            break
        least, step = tried, 2 * step
    while least < most:
        middle = (least + most + 1) // 2
        if b.find(a[i : i + middle], low, high) < 0:
            most = middle - 1
        else:
            least = middle
    return least


def matching_blocks(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int, int]]:
    """``(i, j, size)`` of the matching blocks, those that meet as one, and an
    empty one at the end."""
    end = (len(a), len(b), 0)
    coded = _coded(a, b)
    if coded is None:
        from difflib import SequenceMatcher

        return [tuple(x) for x in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()]
    one, two = coded
    if one == two:
        return [(0, 0, len(a)), end] if one else [end]
    parts = _stretches(one, two)
    starts = [s for s, _ in parts]
    found, todo = [], [(0, len(one), 0, len(two))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        inner = []
        for k in range(max(bisect_right(starts, alo) - 1, 0), len(parts)):
            s, e = parts[k]
            if s >= ahi:
                break
            s, e = max(s, alo), min(e, ahi)
            if s < e:
                inner.append((s, e))
        if not inner:
            continue
        # A longest stretch that is found whole bounds the block from below.
        best, at = 0, -1
        for s, e in sorted(inner, key=lambda x: x[0] - x[1])[:3]:
            if two.find(one[s:e], blo, bhi) >= 0:
                best = e - s - 1
                break
        for s, e in inner:
            i = s
            while e - i > best:
                if two.find(one[i : i + best + 1], blo, bhi) >= 0:
                    best, at = _grown(one, two, i, best + 1, min(e - i, bhi - blo), blo, bhi), i
                i += 1
        if at < 0:
            continue
        j = two.find(one[at : at + best], blo, bhi)
        found.append((at, j, best))
        if alo < at and blo < j:
            todo.append((alo, at, blo, j))
        if at + best < ahi and j + best < bhi:
            todo.append((at + best, ahi, j + best, bhi))
    out: list[tuple[int, int, int]] = []
    for i, j, size in sorted(found):
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1] = (out[-1][0], out[-1][1], out[-1][2] + size)
        else:
            out.append((i, j, size))
    return [*out, end]


def opcodes(a: Sequence[Hashable], b: Sequence[Hashable]) -> Iterator[tuple[str, int, int, int, int]]:
    """``(tag, i, j, k, m)``: how stretches of ``a`` become those of ``b``."""
    i = j = 0
    for x, y, size in matching_blocks(a, b):
        if i < x or j < y:
            yield "replace" if i < x and j < y else "delete" if i < x else "insert", i, x, j, y
        i, j = x + size, y + size
        if size:
            yield "equal", x, i, y, j


def in_common(a: str, b: str) -> int:
    """The length of a longest common subsequence, by the bits of an integer a
    letter; matching blocks never hold more."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = free = (1 << len(a)) - 1
    for c in b:
        if at := free & places.get(c, 0):
            free = ((free + at) | (free - at)) & full
    return len(a) - free.bit_count()


def over(a: str, b: str, least: float) -> bool:
    """Whether :func:`ratio` is over ``least``; cheap bounds of it come first."""
    length = len(a) + len(b)
    if a == b or not length:
        return least < 1.0
    for most in (lambda: min(len(a), len(b)), lambda: in_common(a, b)):
        if 2.0 * most() / length <= least:
            return False
    return ratio(a, b) > least


def ratio(a: Sequence[Hashable], b: Sequence[Hashable]) -> float:
    """Ratcliff-Obershelp similarity, arguments in this order."""
    length = len(a) + len(b)
    return 2.0 * sum(size for _, _, size in matching_blocks(a, b)) / length if length else 1.0
