"""Scalar text functions as Catalyst expressions.

Offsets are zero-based, half-open and count code points.  Null in, null out
unless a docstring says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of letters with inner apostrophes and hyphens.
TOKEN = r"\p{L}+(?:['’-]\p{L}+)*"
#: Pairs of letters that are easily confused in print (fixed values).
CONFUSABLE = ["ce", "ft", "it", "il", "bh", "nr"]
#: Latin letters and the Cyrillic letters that look like them (fixed values).
LATIN, CYRILLIC = "aceopxyABCEHKMOPTX", "асеорхуАВСЕНКМОРТХ"
#: Letters read for digits (fixed values).
DIGIT_LETTERS, DIGITS = "IlOg", "1109"
#: Negative prefixes whose loss turns a word's meaning around (fixed values).
MEANING_PREFIXES = ["a", "un", "non", "in", "im", "ir"]
_ILLEGAL_XML = r"[\x{0}-\x{8}\x{B}\x{C}\x{E}-\x{1F}\x{FFFE}\x{FFFF}]"
_ROMAN = r"^(?i)m{0,4}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$"


def tokens(text: Column) -> Column:
    """All words of a text in order."""
    return F.regexp_extract_all(text, F.lit(f"({TOKEN})"), 1)


def space_tokens(text: Column) -> Column:
    """White-space tokens; a blank text has none."""
    return F.when(F.trim(text) == "", F.array().cast("array<string>")).otherwise(F.split(F.trim(text), r"\s+"))


def comparable(text: Column) -> Column:
    """Lower-cased words and numbers with straight apostrophes, for comparing."""
    return F.regexp_extract_all(F.lower(F.translate(text, "’", "'")), F.lit(r"([\p{L}\p{N}_]+(?:['-][\p{L}\p{N}_]+)*)"), 1)


def signature(text: Column) -> Column:
    """Upper-cased letters, everything else one space: a margin's identity."""
    return F.trim(F.regexp_replace(F.upper(text), r"[^\p{L}]+", " "))


def collapse(text: Column) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def plain(markup: Column) -> Column:
    """Markup without tags, white space collapsed."""
    return collapse(F.regexp_replace(markup, r"<[^>]*>", " "))


def escape(text: Column) -> Column:
    """Text with the three markup characters escaped."""
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def is_roman(text: Column) -> Column:
    """A non-empty Roman numeral in either case."""
    return (F.length(text) > 0) & text.rlike(_ROMAN)


def xml_safe(text: Column) -> Column:
    """Code points that XML forbids, replaced by U+FFFD."""
    return F.regexp_replace(text, _ILLEGAL_XML, "�")


def illegal_points(text: Column) -> Column:
    """Offsets of code points that XML forbids."""
    chars = F.split(text, "")
    return F.filter(F.transform(chars, lambda c, i: F.when(c.rlike(_ILLEGAL_XML), i)), lambda i: i.isNotNull())


def confusable(left: Column, right: Column) -> Column:
    """Equal length and one differing letter, from a confusable pair."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(left), F.lit(1))), lambda i: F.substr(left, i, F.lit(1)) != F.substr(right, i, F.lit(1)))
    at = F.try_element_at(places, F.lit(1))
    pair = F.array_join(F.array_sort(F.array(F.substr(left, at, F.lit(1)), F.substr(right, at, F.lit(1)))), "")
    one = (F.length(left) == F.length(right)) & (F.length(left) > 0) & (F.size(places) == 1)
    return F.coalesce(one & pair.isin([*map("".join, map(sorted, CONFUSABLE))]), F.lit(False))


def one_edit(left: Column, right: Column) -> Column:
    """Edit distance exactly one, an adjacent swap counting one."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(left), F.lit(1))), lambda i: F.substr(left, i, F.lit(1)) != F.substr(right, i, F.lit(1)))
    a, b = F.try_element_at(places, F.lit(1)), F.try_element_at(places, F.lit(2))
    swap = (
        (F.length(left) == F.length(right))
        & (F.size(places) == 2)
        & (b == a + 1)
        & (F.substr(left, a, F.lit(1)) == F.substr(right, b, F.lit(1)))
        & (F.substr(left, b, F.lit(1)) == F.substr(right, a, F.lit(1)))
    )
    return (F.levenshtein(left, right) == 1) | F.coalesce(swap, F.lit(False))


def meaning_sensitive(before: Column, after: Column) -> Column:
    """``before`` is ``after`` with a negative prefix, or the other way round
    does not count."""
    return F.exists(F.array(*map(F.lit, MEANING_PREFIXES)), lambda p: before == F.concat(p, after))


def letters_share(text: Column, kind: str) -> Column:
    """Share of a Unicode class such as ``Lu`` among the letters; null without
    letters."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.try_divide(F.length(F.regexp_replace(text, rf"[^\p{{{kind}}}]", "")).cast("double"), letters)


def edit_pattern(before: Column, *, whole_word: bool = False, exact_row: bool = False, prefix: bool = False, suffix: bool = False) -> Column:
    """A regular expression for a checked edit of the literal ``before``."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(before, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E"))
    if exact_row:
        return F.concat(F.lit(r"\A"), quoted, F.lit(r"\z"))
    if whole_word:
        quoted = F.concat(F.lit(r"(?<![\p{L}\p{N}_])"), quoted, F.lit(r"(?![\p{L}\p{N}_])"))
    return F.concat(F.lit(r"\A" if prefix else ""), quoted, F.lit(r"\z" if suffix else ""))


def _weighted(body: Column, weights: list[int]) -> Column:
    """The sum of a number's digits by their weights; null for other text."""
    digits = [F.substring(body, i + 1, 1).try_cast("int") * w for i, w in enumerate(weights)]
    return reduce(lambda a, b: a + b, digits)


def isbn13_check(body: Column) -> Column:
    """The check digit of the first twelve digits of an ISBN-13."""
    return (10 - _weighted(body, [1, 3] * 6) % 10) % 10


def isbn10_check(body: Column) -> Column:
    """The check character of the first nine digits of an ISBN-10."""
    value = (11 - _weighted(body, [*range(10, 1, -1)]) % 11) % 11
    return F.when(value == 10, "X").otherwise(value.cast("string"))


def box_iou(a: list[Column], b: list[Column]) -> tuple[Column, Column]:
    """(intersection over union, intersection over the smaller box)."""
    wide = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    high = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    inner = wide * high
    one, two = (a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1])
    return F.try_divide(inner, one + two - inner), F.try_divide(inner, F.least(one, two))


def transfer_case(like: Column, text: Column) -> Column:
    """``text`` in the case of ``like``: all upper, first upper, or as it is."""
    first = F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))
    upper = (F.upper(like) == like) & (F.lower(like) != like) & (F.length(like) > 1)
    title = F.upper(F.substring(like, 1, 1)) == F.substring(like, 1, 1)
    return F.when(upper, F.upper(text)).when(title & (F.lower(like) != like), first).otherwise(text)


#: Words as the optical readers cut them: letters, digits and underscores.
_WORD = r"[\p{L}\p{N}_]+(?:['’-][\p{L}\p{N}_]+)*"
#: Double quotation marks of all kinds (fixed values).
QUOTES = '"„“”«»‟'
#: Pairs of digits that are easily confused in print (fixed values).
SIMILAR_DIGITS = ["68", "38", "56", "29", "17", "08"]
#: Weight of each kind of error in a judgment (fixed values).
ERROR_WEIGHTS = {"omission": 1.0, "meaning_error": 1.0, "addition": 0.7, "terminology": 0.5}


def ocr_tokens(text: Column) -> Column:
    """Words, or single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(rf"({_WORD}|[^\p{{L}}\p{{N}}_\s\p{{Z}}])"), 1)


def lexical_tokens(text: Column) -> Column:
    """Runs of letters and runs of digits."""
    return F.regexp_extract_all(text, F.lit(r"([\p{L}\p{Nl}\p{No}]+|\p{Nd}+)"), 1)


def short_tokens(text: Column, most: int = 3) -> Column:
    """Runs of letters and digits of at most ``most`` characters."""
    return F.filter(F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}]+)"), 1), lambda w: F.length(w) <= most)


def plain_sentences(text: Column) -> Column:
    """Pieces between sentence marks and white space, without the marks."""
    return F.split(text, r"[.!?;]\s+")


def folded(text: Column) -> Column:
    """Straight apostrophes and dashes, words broken over lines joined, white
    space collapsed, leading bullets dropped."""
    straight = F.translate(text, "’—–", "'--")
    joined = F.regexp_replace(straight, r"([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])", "$1$2")
    return F.regexp_replace(collapse(joined), r"^[*•+ ]+", "")


def punctuation_form(text: Column, original: Column) -> Column:
    """Quotes folded to straight ones; apostrophes too where the original
    holds a double quote."""
    lookalikes = F.when(original.rlike(f"[{QUOTES}]"), F.translate(text, "’‘'", '"""')).otherwise(text)
    return collapse(F.translate(lookalikes, "„“”«»", '"""""'))


def canonical(text: Column) -> Column:
    """Straight quotes and no white space."""
    return F.regexp_replace(F.translate(text, "“”‘’", "\"\"''"), r"\s+", "")


def to_cyrillic(text: Column) -> Column:
    """Latin letters replaced by the Cyrillic ones that look like them."""
    return F.translate(text, LATIN, CYRILLIC)


def to_latin(text: Column) -> Column:
    """Cyrillic letters replaced by the Latin ones that look like them."""
    return F.translate(text, CYRILLIC, LATIN)


def to_digits(text: Column) -> Column:
    """Letters replaced by the digits they are read for."""
    return F.translate(text, DIGIT_LETTERS, DIGITS)


def glyph_cost(observed: Column, alternative: Column) -> Column:
    """How unlike two digit strings look: a similar pair costs a half, another
    pair 2, different lengths 2 in all."""
    either = [p for pair in SIMILAR_DIGITS for p in (pair, pair[::-1])]
    one = lambda a, b: F.when(a == b, 0.0).when(F.concat(a, b).isin(either), 0.5).otherwise(2.0)
    costs = F.zip_with(F.split(observed, ""), F.split(alternative, ""), one)
    return F.when(F.length(observed) != F.length(alternative), 2.0).otherwise(F.aggregate(costs, F.lit(0.0), lambda a, x: a + x))


def quality_score(errors: dict[str, Column], fluency: Column) -> Column:
    """0 to 100 from error probabilities; those under a half count as none and
    the most likely error decides."""
    worst = F.greatest(*[F.greatest(F.lit(0.0), (c - 0.5) / 0.5) * ERROR_WEIGHTS[n] for n, c in errors.items()], F.lit(0.0))
    return F.bround(100 * (1 - worst) * (0.7 + 0.3 * fluency)).cast("int")


def clean_wiki(text: Column) -> Column:
    """Plain text of wiki markup: references, templates, links and emphasis
    removed, a comment template's text kept."""
    for pattern, kept in (
        (r"(?s)<ref[^>/]*/>|<ref[^>]*>.*?</ref>", ""),
        (r"\{\{comment\|([^|}]*)\|[^}]*\}\}", "$1"),
        (r"\{\{[^{}]*\}\}", ""),
        (r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1"),
        (r"<[^>]+>|'''?", ""),
    ):
        text = F.regexp_replace(text, pattern, kept)
    return collapse(text)
