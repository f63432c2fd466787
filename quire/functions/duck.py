"""SQL fragments for DuckDB that stand beside ``functions.text``; for the SQL twins only."""

from __future__ import annotations

from quire.functions.text import CITATION, KEYWORDS, PAGE_NUMBER, ROMAN, SCAN_NOISE, STANDALONE_LABEL

WS = r"[\s\p{Z}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rep(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def strip(x: str, also: str = "") -> str:
    k = f"[\\s\\p{{Z}}{also}]"
    return rep(x, f"^{k}+|{k}+$")


def words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, {q(WS + '+')}), lambda w: w <> ''))"


def page_number(s: str) -> str:
    return f"({s} <> '' AND ({has(s, PAGE_NUMBER)} OR {has('upper(' + rep(s, r'[.]+$') + ')', ROMAN)}))"


def keyword(s: str) -> str:
    return has(s, rf"(?i)^(?:{KEYWORDS})\b")


def header_with_number(x: str) -> str:
    s = strip(strip(x), "*")
    numbered = rf"\b\d{{1,4}}\b\s*\.?$|\b[ivxlcdm]{{1,8}}\b\s*\.?$"
    return f"({s} <> '' AND NOT {has(s, CITATION)} AND {keyword(s)} AND NOT {has(s, STANDALONE_LABEL)} AND {has(s, '(?i)' + numbered)})"


def header_combo(x: str) -> str:
    s = strip(rep(rep(strip(x), WS + "+", " "), r"\*"))
    start = rf"(?i)^(?:\d{{1,4}}\s+)?(?:{KEYWORDS})\b"
    verbs = r"(?i)\b(?:contains|says|treats|describes|devoted)\b"
    digits = r"(?i)\b\d{1,4}\b|\b[ivxlcdm]{1,8}\b"
    return f"({s} <> '' AND NOT {has(s, STANDALONE_LABEL)} AND {has(s, digits)} AND {has(s, start)} AND {words(s)} <= 8 AND NOT {has(s, CITATION)} AND NOT {has(s, verbs)})"


def standalone_heading(x: str) -> str:
    s = strip(strip(x), "#")
    part = r"(?i)^(?:part|book|section|volume)"
    return (
        f"({s} <> '' AND {keyword(s)} AND (NOT {has(s, part + chr(92) + 'b')} OR {has(s, part + r'\s+(?:[0-9]+|[ivxlcdm]+|[a-z])(?:\b|[.):-])')}) "
        f"AND length({s}) <= 90 AND NOT {has(s, r'(?i)\b(?:contains|says|treats|describes|devoted|remarks?)\b')})"
    )


def running_header(a: str, b: str) -> str:
    """Of two stripped lines."""
    letters, upper = f"length({rep(a, '[^' + chr(92) + 'p{L}]')})", f"length({rep(a, '[^' + chr(92) + 'p{Lu}]')})"
    roman = has(rep(a, "[.]+$"), ROMAN)
    return (
        f"({a} <> '' AND {b} <> '' AND length({a}) <= 80 AND {words(a)} <= 12 AND (NOT {keyword(a)} OR {has(a, r'\b[0-9]{1,4}\b\s*[.]?$')}) AND NOT {roman} "
        f"AND {letters} > 0 AND {upper} * 4 >= {letters} * 3 AND {has(b, '^[a-z0-9\"' + chr(39) + '(' + chr(92) + '[]')})"
    )


def line_class(x: str) -> str:
    s = strip(x)
    return f"""CASE WHEN {s} = '' THEN 'blank' WHEN starts_with({s}, '## ') THEN 'chapter_heading' WHEN starts_with({s}, '# ') THEN 'title_heading'
      WHEN {has(s, r'^\[\^[^\]]+\](?::|\s)')} THEN 'footnote_def' WHEN starts_with({s}, '>') THEN 'blockquote' WHEN starts_with({s}, '|') THEN 'table'
      WHEN starts_with({s}, '#') THEN 'heading' WHEN {page_number(s)} THEN 'page_number'
      WHEN {header_with_number(s)} OR {header_combo(s)} THEN 'running_header_with_page'
      WHEN {keyword(s)} AND {words(s)} <= 12 THEN 'chapterish_label' WHEN {has(s, SCAN_NOISE)} THEN 'scan_noise' ELSE 'prose' END"""


def footnote_def(x: str) -> str:
    from quire.functions.text import FOOTNOTE_DEF

    s = rep(x, rf"^(?:{WS}|>)+")
    s = rep(s, r"^(?:\*\*|\*|__|_)\s*")
    return has(strip(rep(s, r"\s*(?:\*\*|\*|__|_)\s*$")), FOOTNOTE_DEF)


def margin_key(x: str) -> str:
    s = rep(strip(x), WS + "+", " ")
    s = rep(rep(s, r"\b\d+\b", "#"), r"(?i)\b[ivxlcdm]+\b", "#")
    s = rep("lower(" + rep(s, r"[_\-–—]+", " ") + ")", r"[^a-z0-9\s#]", " ")
    return f"trim({rep(s, r'\s+', ' ')})"


def simple(x: str) -> str:
    return f"trim({rep(rep('lower(' + x + ')', r'[^a-z0-9\s#]', ' '), r'\s+', ' ')})"


def loose(x: str) -> str:
    s = rep(rep(f"lower({x})", "­"), "[‐‑‒–—―]", "-")
    return strip(rep(s, WS + "+", " "))


def title_kind(x: str) -> str:
    s = strip(f"coalesce({x}, '')")
    cases = " ".join(f"WHEN {has(s, rf'(?i)^{k}\b')} THEN '{k}'" for k in ("book", "part", "chapter", "index", "appendix", "preface", "introduction"))
    return f"CASE WHEN {s} = '' THEN 'other' WHEN lower({s}) = 'front matter' THEN 'frontmatter' {cases} ELSE 'other' END"


#: The latest extraction of each page of a book.
CURRENT = "current AS (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY book_id, page_number ORDER BY extracted_at DESC NULLS LAST, extraction_id DESC) = 1)"
#: Lines of the latest extractions, with their number.
LINES = "lines AS (SELECT extraction_id, book_id, page_number, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no FROM current)"
