"""Column functions over text, built in to the JVM: no Python in the row path.

Null counts as the empty text in every predicate, as in the data model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a regular-expression class that Java and RE2 read alike, and its characters.
WS = r"[\s\p{Z}]"
BLANKS = "\t\n\v\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Words that open a chapter-like heading.
KEYWORDS = (
    "chapter|part|book|section|volume|preface|foreword|introduction|prologue|epilogue|appendix|afterword|glossary|"
    r"bibliography|index|dedication|acknowledgement|acknowledgment|contents|table\s+of\s+contents"
)
# Blocks of Indic scripts.
INDIC = r"[\x{0900}-\x{097F}\x{0980}-\x{09FF}\x{0A00}-\x{0A7F}\x{0A80}-\x{0AFF}\x{0B00}-\x{0B7F}\x{0B80}-\x{0BFF}\x{0C00}-\x{0C7F}\x{0C80}-\x{0CFF}\x{0D00}-\x{0D7F}]"
#: Roman numerals to 39; the empty text matches.
ROMAN = r"^X{0,3}(?:IX|IV|V?I{0,3})$"
PAGE_NUMBER = r"^\[?\(?\d{1,4}\)?\]?[.*]?$"
STANDALONE_LABEL = r"(?i)^(?:chapter|part|book|section|volume)\s+(?:\d+|[ivxlcdm]+)\.?\s*$"
CITATION = r"(?i)\b(?:vol|no|pp?)\.\s*\d"
FOOTNOTE_REF = r"\[\^([A-Za-z0-9_*†‡§-]+)\]"
FOOTNOTE_DEF = r"^(?:\[\^[^\]]+\](?::|\s)|\$\^[^$]+\$\s+|[⁰¹²³⁴⁵⁶⁷⁸⁹]+\s+)"
# Lines of scanning services.
SCAN_NOISE = (
    r"(?i)(?:^\s*uc[- ]?nrlf\s*$|^\s*[ab]\s*\d[\d\s]{3,}\s*$|^\s*(?:repl|refel|reel)\s+\d+\s*$|^\s*reproduced\s+by\s+duopage\s+process\b"
    r"|^\s*in\s+the\s+united\s+states\s+of\s+america\s*$|^\s*micro\s+photo\s+inc\.?\s*$|^\s*cleveland\s+\d+,\s*ohio\.?\s*$"
    r"|^\s*[a-z]-\d{5,}\s*$|^\s*ds\s*\.?\s*\d{1,4}\s*[a-z]?\d*\s*$|^\s*r\d{1,4}\s*$)"
)


def text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def let(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make(value)``, but ``value`` is computed once however often it stands there."""
    return F.get(F.transform(F.array(value), lambda x: make(x)), F.lit(0))


def strip(c: Column, also: str = "") -> Column:
    """Without white space (and the characters ``also``, as in a class) at both ends."""
    if not set(also) & set("\\-^[]&"):
        return F.trim(c, F.lit(BLANKS + also))
    k = f"[\\s\\p{{Z}}{also}]"
    return F.regexp_replace(c, f"^{k}+|{k}+$", "")


def ascii_edges(pattern: str) -> str:
    """The pattern with word boundaries as RE2 has them: to Java's, letters of other scripts (a look-alike, a long s) belong to a word too."""
    return pattern.replace(r"\b", r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))")


def words(c: Column) -> Column:
    """Number of runs without white space; 0 for blank text."""
    return F.size(F.filter(F.split(c, WS + "+"), lambda w: w != ""))


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def full_lines(c: Column) -> Column:
    """Stripped lines that are not blank, in order."""
    return F.filter(F.transform(lines(c), lambda x: strip(x)), lambda x: x != "")


def count_matches(c: Column, pattern: str) -> Column:
    """Characters of ``c`` in a one-character class."""
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def simple(c: Column) -> Column:
    """Key for fuzzy comparison: lower case, a-z 0-9 # and single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9\s#]", " "), r"\s+", " "))


def margin_key(c: Column) -> Column:
    """Key of a margin line: numbers and Roman numerals as #, no punctuation."""
    s = F.regexp_replace(strip(c), WS + "+", " ")
    s = F.regexp_replace(s, r"\b\d+\b", "#")
    s = F.regexp_replace(s, r"(?i)\b[ivxlcdm]+\b", "#")
    s = F.regexp_replace(s, r"[_\-–—]+", " ")
    s = F.regexp_replace(F.lower(s), r"[^a-z0-9\s#]", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def loose(c: Column) -> Column:
    """Lower case, no soft hyphens, plain dashes, single blanks."""
    s = F.regexp_replace(F.lower(c), "­", "")
    s = F.regexp_replace(s, r"[\x{2010}-\x{2015}]", "-")
    return strip(F.regexp_replace(s, WS + "+", " "))


def slug(c: Column, fallback: str = "na") -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit(fallback)).otherwise(s)


def is_page_number(c: Column) -> Column:
    """A line of a printed page number, Arabic or Roman (dots alone count too)."""
    s = strip(c)
    return (s != "") & (s.rlike(PAGE_NUMBER) | F.upper(F.regexp_replace(s, r"\.+$", "")).rlike(ROMAN))


def is_keyword(c: Column) -> Column:
    return c.rlike(ascii_edges(rf"(?i)^(?:{KEYWORDS})\b"))


def is_header_with_number(c: Column) -> Column:
    """A chapter label with a page number after it, but no bare label or citation."""
    s = strip(strip(strip(c), "*"))
    numbered = s.rlike(ascii_edges(r"\b\d{1,4}\b\s*\.?$")) | s.rlike(ascii_edges(r"(?i)\b[ivxlcdm]{1,8}\b\s*\.?$"))
    return is_keyword(s) & ~s.rlike(ascii_edges(CITATION)) & ~s.rlike(STANDALONE_LABEL) & numbered


def is_header_combo(c: Column) -> Column:
    """Number and chapter label in one short line."""
    s = strip(F.regexp_replace(F.regexp_replace(strip(c), WS + "+", " "), r"\*", ""))
    return (
        (s != "")
        & ~s.rlike(STANDALONE_LABEL)
        & (s.rlike(r"\b\d{1,4}\b") | s.rlike(r"(?i)\b[ivxlcdm]{1,8}\b"))
        & s.rlike(rf"(?i)^(?:\d{{1,4}}\s+)?(?:{KEYWORDS})\b")
        & (words(s) <= 8)
        & ~s.rlike(CITATION)
        & ~s.rlike(r"(?i)\b(?:contains|says|treats|describes|devoted)\b")
    )


def is_standalone_heading(c: Column) -> Column:
    """A chapter-like heading line and no prose that starts with such a word."""
    s = strip(strip(c), "#")
    numbered = ~s.rlike(ascii_edges(r"(?i)^(?:part|book|section|volume)\b")) | s.rlike(ascii_edges(r"(?i)^(?:part|book|section|volume)\s+(?:\d+|[ivxlcdm]+|[a-z])(?:\b|[.):-])"))
    return is_keyword(s) & numbered & (F.length(s) <= 90) & ~s.rlike(ascii_edges(r"(?i)\b(?:contains|says|treats|describes|devoted|remarks?)\b"))


def is_running_header(first: Column, second: Column) -> Column:
    """Short line of capitals above a line that goes on in lower case."""
    a, b = strip(first), strip(second)
    letters = F.length(F.regexp_replace(a, r"[^\p{L}]", ""))
    upper = F.length(F.regexp_replace(a, r"[^\p{Lu}]", ""))
    return (
        (a != "") & (b != "") & (F.length(a) <= 80) & (words(a) <= 12)
        & (~is_keyword(a) | a.rlike(ascii_edges(r"\b\d{1,4}\b\s*\.?$")))
        & ~F.regexp_replace(a, r"\.+$", "").rlike(ROMAN)
        & (letters > 0) & (upper * 4 >= letters * 3)
        & b.rlike(r"^[a-z0-9\"'(\[]")
    )


def is_footnote_def(c: Column) -> Column:
    s = F.regexp_replace(c, rf"^(?:{WS}|>)+", "")
    s = F.regexp_replace(s, r"^(?:\*\*|\*|__|_)\s*", "")
    return strip(F.regexp_replace(s, r"\s*(?:\*\*|\*|__|_)\s*$", "")).rlike(FOOTNOTE_DEF)


def is_margin_line(c: Column) -> Column:
    s = strip(c)
    return (s != "") & (F.length(s) <= 80) & ~is_footnote_def(s) & (words(s) <= 12)


def line_class(c: Column) -> Column:
    """One of twelve classes of a line of markdown."""
    s = strip(c)
    return (
        F.when(s == "", "blank")
        .when(s.startswith("## "), "chapter_heading")
        .when(s.startswith("# "), "title_heading")
        .when(s.rlike(r"^\[\^[^\]]+\](?::|\s)"), "footnote_def")
        .when(s.startswith(">"), "blockquote")
        .when(s.startswith("|"), "table")
        .when(s.startswith("#"), "heading")
        .when(is_page_number(s), "page_number")
        .when(is_header_with_number(s) | is_header_combo(s), "running_header_with_page")
        .when(is_keyword(s) & (words(s) <= 12), "chapterish_label")
        .when(s.rlike(SCAN_NOISE), "scan_noise")
        .otherwise("prose")
    )


def title_kind(c: Column) -> Column:
    s = strip(text(c))
    out = F.when(s == "", "other").when(F.lower(s) == "front matter", "frontmatter")
    for kind in ("book", "part", "chapter", "index", "appendix", "preface", "introduction"):
        out = out.when(s.rlike(rf"(?i)^{kind}\b"), kind)
    return out.otherwise("other")


def heading_level(c: Column) -> Column:
    return F.when(title_kind(c).isin("part", "chapter"), 3).otherwise(2)
