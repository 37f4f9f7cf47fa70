"""Book archives and profiles: scans, deterministic writing, checked settings."""

from __future__ import annotations

import io
import math
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as E

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPF = "{http://www.idpf.org/2007/opf}"
_CONTAINER = "{urn:oasis:names:tc:opendocument:xmlns:container}"


def documents_of(archive: bytes) -> list[tuple[int, str, str]]:
    """``(order, member, markup)`` of a book's documents in reading order; those
    that only the manifest names come last, by name."""
    with zipfile.ZipFile(io.BytesIO(archive)) as z:
        package = E.fromstring(z.read("META-INF/container.xml")).find(f".//{_CONTAINER}rootfile").get("full-path")
        root, base = E.fromstring(z.read(package)), posixpath.dirname(package)
        items = {i.get("id"): i for i in root.iter(f"{_OPF}item")}
        names = [items[r.get("idref")].get("href") for r in root.iter(f"{_OPF}itemref") if r.get("idref") in items]
        others = sorted(i.get("href") for i in items.values() if i.get("media-type") == "application/xhtml+xml" and i.get("href") not in names)
        members = [posixpath.normpath(posixpath.join(base, n)) for n in [*names, *others]]
        return [(k, m, z.read(m).decode("utf-8-sig")) for k, m in enumerate(members) if m in z.namelist()]


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """``book, seq, member, html`` of the documents of every archive at a path;
    an archive that can't be read gives one row with a null member."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("book"), "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple] = []
            for book, content in zip(frame.book, frame.content, strict=True):
                try:
                    out += [(book, *d) for d in documents_of(bytes(content))]
                except (zipfile.BadZipFile, KeyError, E.ParseError, AttributeError):
                    out.append((book, None, None, None))
            yield pd.DataFrame(out, columns=["book", "seq", "member", "html"]).astype({"seq": "Int32"})

    return files.mapInPandas(run, "book string, seq int, member string, html string")


def archive(members: DataFrame, stored: str = "mimetype") -> bytes:
    """A ZIP file of ``members(name, data)``: one of them stored first, the
    others compressed in order of name, all of one time, so that equal members
    give equal bytes.  A book's files fit the driver."""
    rows = sorted(((r["name"], bytes(r["data"])) for r in members.select("name", "data").collect()), key=lambda r: (r[0] != stored, r[0]))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in rows:
            info = zipfile.ZipInfo(name, (2000, 1, 1, 0, 0, 0))
            info.compress_type = zipfile.ZIP_STORED if name == stored else zipfile.ZIP_DEFLATED
            info.external_attr = 0o644 << 16
            z.writestr(info, data, compresslevel=9)
    return out.getvalue()


#: Settings of a profile by kind.
SETTINGS: dict[str, type | tuple[type, ...]] = (
    dict.fromkeys(["title", "author", "language", "slug", "source_sha256", "publisher", "date", "isbn", "text_source", "lexical_repair_policy", "numeric_footnote_numbering", "figure_color_mode", "endnote_reference_mode"], str)
    | dict.fromkeys(["link_symbol_footnotes", "link_numeric_footnotes", "require_complete_numeric_footnotes", "repair_lexical_confusions", "recover_index_digits", "recover_edge_artifacts", "recover_regions", "recover_glyphs", "source_figure_anchors"], bool)
    | dict.fromkeys(["chapters", "artwork_pages", "figures", "endnote_sections", "index_pages", "reference_pages", "protected_terms", "edits", "metadata_author_aliases", "statistics_excluded_chapters"], list)
    | dict.fromkeys(["note_starts", "index_splits", "index_column_starts", "excluded_pages", "chapter_body_starts", "bottom_margin_cutoffs", "comments", "glossary_terms", "page_labels"], dict)
    | dict.fromkeys(["printed_page_offset", "endnote_chapter"], int)
    | dict.fromkeys(["upper_margin_cutoff", "uppercase_margin_cutoff", "endnote_marker_min", "endnote_marker_limit", "quote_font_scale"], (int, float))
)
REQUIRED = ["title", "author", "language", "slug", "source_sha256", "chapters", "artwork_pages"]
#: Settings with a page as key, and those whose values are shares of a page.
_BY_PAGE = ["note_starts", "index_splits", "index_column_starts", "excluded_pages", "chapter_body_starts", "bottom_margin_cutoffs", "page_labels"]
_SHARES = ["note_starts", "index_splits", "index_column_starts", "chapter_body_starts", "bottom_margin_cutoffs"]
_CHOICES = {
    "text_source": ("ocr", "native"),
    "lexical_repair_policy": ("source-faithful", "corrected-reading"),
    "numeric_footnote_numbering": ("page", "chapter"),
    "figure_color_mode": ("auto", "rgb", "grayscale"),
    "endnote_reference_mode": ("strict", "chapter"),
}
#: A setting that needs another one.
_NEEDS = {"require_complete_numeric_footnotes": "link_numeric_footnotes", "lexical_repair_policy:corrected-reading": "repair_lexical_confusions"}


def profile_problems(profile: dict, pages: int | None = None) -> list[str]:
    """What is wrong with a book's settings: unknown, missing, of the wrong
    kind, out of range, or without what they need.  Nothing is corrected."""
    out = [f"{k}: required" for k in REQUIRED if k not in profile]
    whole = lambda v: type(v) is int
    number = lambda v: type(v) in (int, float) and math.isfinite(v)
    page = lambda v: whole(v) and v >= 1 and (pages is None or v <= pages)
    for key, value in profile.items():
        kind = SETTINGS.get(key)
        if kind is None:
            out.append(f"{key}: unknown")
        elif (not number(value)) if kind == (int, float) else type(value) is not kind:
            out.append(f"{key}: wrong kind")
        elif key in _CHOICES and value not in _CHOICES[key]:
            out.append(f"{key}: expected one of {', '.join(_CHOICES[key])}")
        elif key in _BY_PAGE and not all(isinstance(k, str) and k.isdigit() and page(int(k)) for k in value):
            out.append(f"{key}: a key is no page")
        elif key in _SHARES and not all(number(v) and 0 <= v <= 1 for v in value.values()):
            out.append(f"{key}: a value is outside 0..1")
    if isinstance(profile.get("source_sha256"), str) and not re.fullmatch("[0-9a-f]{64}", profile["source_sha256"]):
        out.append("source_sha256: no lower-case SHA-256 digest")
    if isinstance(profile.get("slug"), str) and not re.fullmatch("[A-Za-z0-9][A-Za-z0-9_-]*", profile["slug"]):
        out.append("slug: no file name")
    out += [f"{k}: empty" for k in ("title", "author", "language") if isinstance(profile.get(k), str) and not profile[k].strip()]
    if number(profile.get("quote_font_scale", 1)) and not 0.5 <= profile.get("quote_font_scale", 1) <= 1.5:
        out.append("quote_font_scale: outside 0.5..1.5")
    chapters = profile.get("chapters") if isinstance(profile.get("chapters"), list) else []
    last = 0
    for i, c in enumerate(chapters):
        if not (isinstance(c, (list, tuple)) and len(c) == 3 and page(c[0]) and page(c[1]) and c[0] <= c[1] and isinstance(c[2], str)):
            out.append(f"chapters[{i}]: expected first page, last page, title")
        elif c[0] <= last:
            out.append(f"chapters[{i}]: overlaps the chapter before")
        else:
            last = c[1]
    for i, f in enumerate(profile.get("figures", []) if isinstance(profile.get("figures", []), list) else []):
        box = f.get("rect") if isinstance(f, dict) else None
        if not (isinstance(f, dict) and page(f.get("page")) and isinstance(box, list) and len(box) == 4 and all(number(v) and 0 <= v <= 1 for v in box) and box[0] < box[2] and box[1] < box[3]):
            out.append(f"figures[{i}]: expected a page and an ordered box in 0..1")
    for need, other in _NEEDS.items():
        key, _, choice = need.partition(":")
        if profile.get(key) and (not choice or profile[key] == choice) and not profile.get(other):
            out.append(f"{key}: needs {other}")
    return out


def check_profile(profile: dict, pages: int | None = None) -> None:
    """``ValueError`` with all problems of a profile that has any."""
    if problems := profile_problems(profile, pages):
        raise ValueError("; ".join(problems))


#: What a repair may be recorded as; a rule adds its rows under one of these.
AUDIT_KINDS = [
    "invalid-xml-ocr-character", "two-witness-region-recovery", "missing-line-recovery", "possible-missing-line", "two-fresh-edge-artifact", "spaced-initial-word",
    "spaced-initial-compound", "three-witness-initial-word", "two-fresh-index-digit", "two-fresh-quote-mark", "two-witness-token", "two-fresh-em-dash",
    "witnessed-index-digit", "witnessed-citation-year-spacing", "citation-year-digit", "witnessed-citation-year-suffix", "bracket-letter-l", "fresh-word-for-nonword",
    "russian-numero", "russian-latin-lookalike", "russian-roman-numeral", "russian-letter-witness", "russian-letter-lookalike", "ocr-disagreement",
]
