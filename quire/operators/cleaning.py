"""The cleanup of a page for readers: a chain of line filters, each a function of the page's lines and kind.

Order: running margins, a running header at the top, a stack of page number and
label, signature marks, library stamps, scan noise (and the top once more, where
noise was found), loan slips, captions.  A filter blanks a line or drops it; all
stays in the JVM, as functions over the array of lines.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.duck import has, header_combo, header_with_number, keyword, page_number, rep, running_header, simple, strip
from quire.operators.cleanup import SLIP, is_loan_slip, is_stamp, stamp_sql
from quire.operators.margins import _DETECT, STRIPPED, detect, strip_margins, with_margins
from quire.operators.pages import page_kind
from quire.sources.tables import latest, table

#: Kinds of page that each filter is for.
HEADER_KINDS, STACK_KINDS = ("text", "frontmatter", "backmatter", "chapter_start", "toc"), ("text", "frontmatter", "backmatter", "toc")
SIGNATURE_KINDS, STAMP_KINDS, NOISE_KINDS, SLIP_KINDS = ("text", "chapter_start", "backmatter"), ("frontmatter", "illustration", "toc"), ("frontmatter", "toc"), ("frontmatter", "backmatter")
# Headings of front matter that no running header is.
SECTION_HEADINGS = (
    "an introductory note", "contents", "illustrations", "list of illustrations", "list of plates", "list of maps", "list of paintings", "list of authorities", "list of authorities consulted",
)
# A signature mark before the first word of a line; empty rows of a catalogue card.
SIGNATURE, SHELLS = r"^\s*(?:\d{1,4}|[IVXLCDM]{1,6})\s{2,}[A-Z](?:\s+\d+)?\s+([a-z])", ("| | |", "| |", "|")
# Numbers of scans, signature codes and folios on lines of their own; a page reference at a line's end.
CODES = r"(?i)^(?:\d{5,}|\d{1,3}-[ivxlcdm]{1,8}-[a-z]|\d{1,3}|[ivxlcdm]{1,4})$"
REFERENCE_END = r"(?:[.·•]+\s*|\s)[\[{(]?\d{1,4}\s*$"
# Notes on where a plate stands, zoom factors, and owners before a caption.
PLACEMENT, ZOOM, CAPTION_MARK = r"(?i)\bto\s+face\s+p\.?|\bfacing\s+page\b", r"^\d{2,4}%$", r"(?i)^\[?\s*illustration\s*:?\s*"
CAPTION_OWNER = r"(?i)^(?:univ(?:ersity)?\.?\s+of\s+california|u\.?\s*c\.?\s*berkeley\s+libraries|general\s+library)\b[\s:;,\-]*"
CAPTION_LINES = 4
RULES = ("margins", "running_header", "header_stack", "signatures", "stamps", "scan_noise", "top_again", "loan_slip")


def _full(ls: Column) -> Column:
    """Positions of lines that are not blank."""
    return F.filter(F.transform(ls, lambda x, i: F.when(X.strip(x) != "", i)), lambda i: i.isNotNull())


def _line(ls: Column, at: Column, k: int) -> Column:
    return F.coalesce(X.strip(F.get(ls, F.get(at, F.lit(k)))), F.lit(""))


def _blank(ls: Column, positions: Column) -> Column:
    return F.transform(ls, lambda x, i: F.when(F.array_contains(positions, i), "").otherwise(x))


def top_lines(d: DataFrame, name: str, where: Column | None = None) -> DataFrame:
    """``ls`` without a running header and then a stack of number and label at its top, of rows with ``where``; ``name`` counts the lines."""
    where = F.lit(True) if where is None else where
    none = F.array().cast("array<int>")
    top = lambda x: x.withColumn("_at", _full(F.col("ls"))).withColumns({"_a": _line(F.col("ls"), F.col("_at"), 0), "_b": _line(F.col("ls"), F.col("_at"), 1)})
    a, b = F.col("_a"), F.col("_b")
    d = top(d)
    section = F.col("kind").isin("frontmatter", "toc") & X.simple(F.regexp_replace(a, "[.:]+$", "")).isin(*SECTION_HEADINGS)
    header = where & F.col("kind").isin(*HEADER_KINDS) & (F.size("_at") >= 2) & ~section & X.is_running_header(a, b)
    d = d.withColumn("_gone", F.when(header, F.slice("_at", 1, 1)).otherwise(none))
    d = top(d.withColumns({"ls": _blank(F.col("ls"), F.col("_gone")), f"{name}_header": F.size("_gone")}))
    label = lambda x: X.is_keyword(X.strip(X.strip(x), "*"))
    one = X.is_header_with_number(a) | X.is_header_combo(a)
    two = (X.is_page_number(a) & (label(b) | X.is_header_combo(b))) | (label(a) & X.is_page_number(b))
    able = where & F.col("kind").isin(*STACK_KINDS) & (F.size("_at") >= 2)
    d = d.withColumn("_gone", F.when(able & one, F.slice("_at", 1, 1)).when(able & two, F.slice("_at", 1, 2)).otherwise(none))
    return d.withColumns({"ls": _blank(F.col("ls"), F.col("_gone")), f"{name}_stack": F.size("_gone")}).drop("_at", "_gone", "_a", "_b")


def is_noise(s: Column) -> Column:
    """A stripped line that a scan left in front matter."""
    return (s != "") & (F.upper(F.regexp_replace(s, r"\.+$", "")).rlike(X.ROMAN) | s.rlike(CODES) | s.rlike(X.SCAN_NOISE))


def without_noise(ls: Column, kind: Column) -> Column:
    """Lines without scan noise; in a table of contents a page number below a page reference stays."""

    def add(acc: Column, x: Column) -> Column:
        s = X.strip(x)
        stays = (kind == "toc") & s.rlike(r"^\d{1,4}$") & acc["last"].rlike(REFERENCE_END)
        kept = (s == "") | stays | ~is_noise(s)
        return F.struct(F.when(kept, F.concat(acc["ls"], F.array(x))).otherwise(acc["ls"]).alias("ls"), F.when(kept & (s != ""), s).otherwise(acc["last"]).alias("last"))

    return F.aggregate(ls, F.struct(F.array().cast("array<string>").alias("ls"), F.lit("").alias("last")), add)["ls"]


def with_caption(d: DataFrame) -> DataFrame:
    """``caption``: the one line that stays of a page with an illustration (null for other pages)."""
    full = F.filter(F.transform("ls", lambda x: X.strip(x)), lambda x: (x != "") & ~X.is_page_number(x) & ~is_stamp(x) & ~x.rlike(ZOOM))
    d = d.withColumn("_f", F.when(F.col("kind") == "illustration", full))
    d = d.withColumn("_b", F.filter(F.transform(F.filter("_f", lambda x: ~x.rlike(PLACEMENT)), lambda x: X.strip(X.strip(x, "*_"), r"\[\]")), lambda x: x != ""))
    marked = F.get(F.filter("_f", lambda x: x.startswith("[Illustration")), F.lit(0))
    joined = F.when(F.size("_b") > 0, F.array_join(F.slice("_b", 1, CAPTION_LINES), " "))
    d = d.withColumn("_c", F.regexp_replace(X.strip(F.coalesce(marked, joined, F.get("_f", F.lit(0)), F.lit(""))), X.WS + "+", " "))
    d = d.withColumn("_c", X.strip(F.regexp_replace(F.regexp_replace("_c", CAPTION_MARK, ""), CAPTION_OWNER, ""), r"\[\]"))
    text = F.when(F.size("_f") == 0, "").when(F.col("_c") == "", "[Illustration]").otherwise(F.concat(F.lit("[Illustration: "), "_c", F.lit("]")))
    return d.withColumn("caption", F.when(F.col("_f").isNotNull(), text)).drop("_f", "_b", "_c")


def cleaned(pages: DataFrame) -> DataFrame:
    """``extraction_id, book_id, page_number, kind, text`` and a count of what each of RULES removed.

    Pages of every kind are there, blank ones with their text as it is; null
    counts as ''.  Margins are those of the book (see ``margins``).
    """
    marked = with_margins(pages).persist(StorageLevel.DISK_ONLY)
    bare = strip_margins(marked, detect(marked)).select("extraction_id", F.col("text").alias("bare"))
    d = pages.select("extraction_id", "book_id", "page_number", page_kind(pages).alias("kind"), X.text("text").alias("whole")).join(bare, "extraction_id", "left")
    d = d.withColumn("ls", X.lines(F.coalesce("bare", "whole")))
    d = d.withColumn("margins", F.size(X.full_lines(F.col("whole"))) - F.size(_full(F.col("ls"))))
    d = top_lines(d, "top")
    sign = F.col("kind").isin(*SIGNATURE_KINDS)
    signed = F.filter("ls", lambda x: x.rlike(SIGNATURE))
    d = d.withColumns({"signatures": F.when(sign, F.size(signed)).otherwise(0), "ls": F.when(sign, F.transform("ls", lambda x: F.regexp_replace(x, SIGNATURE, "$1"))).otherwise(F.col("ls"))})
    stamped = F.filter("ls", lambda x: ~(is_stamp(x) | ((F.col("kind") == "frontmatter") & X.strip(x).isin(*SHELLS))))
    d = d.withColumn("_ls", F.when(F.col("kind").isin(*STAMP_KINDS), stamped).otherwise(F.col("ls")))
    d = d.withColumns({"stamps": F.size("ls") - F.size("_ls"), "ls": F.col("_ls")})
    d = d.withColumn("_ls", F.when(F.col("kind").isin(*NOISE_KINDS), without_noise(F.col("ls"), F.col("kind"))).otherwise(F.col("ls")))
    d = d.withColumns({"scan_noise": F.size("ls") - F.size("_ls"), "ls": F.col("_ls")}).drop("_ls")
    # numbers above a running header hide it; once they are gone the top is looked at again
    d = top_lines(d, "again", F.col("scan_noise") > 0).withColumn("text", F.array_join("ls", "\n"))
    d = with_caption(d)
    d = d.withColumn("loan_slip", (F.col("kind").isin(*SLIP_KINDS) & (X.strip(F.col("text")) != "") & is_loan_slip(F.col("text"))).cast("int"))
    d = d.withColumn("text", F.when(F.col("loan_slip") == 1, "").otherwise(F.coalesce("caption", "text")))
    return d.select(
        "extraction_id", "book_id", "page_number", "kind", "text", "margins", F.col("top_header").alias("running_header"), F.col("top_stack").alias("header_stack"), "signatures", "stamps", "scan_noise",
        (F.col("again_header") + F.col("again_stack")).alias("top_again"), "loan_slip",
    )


def q_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = cleaned(latest(table(spark, sf_dir, "pages")))
    return d.select("extraction_id", "kind", F.sha1("text").alias("text_sha1"), F.size(X.full_lines(F.col("text"))).alias("lines_left"))


def q_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule removed, by kind of page."""
    d = cleaned(latest(table(spark, sf_dir, "pages")))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("n")) for r in RULES])).alias("e")
    return d.select("kind", each).select("kind", "e.*").where("n > 0").groupBy("kind", "rule").agg(F.count("*").alias("pages"), F.sum("n").alias("removed"))


QUERIES = {"cleaned_pages": q_cleaned, "removed_lines": q_removed}


def _top_sql(source: str, out: str, name: str) -> str:
    """CTEs as ``top_lines``: from ``source`` (ls, kind) to ``out``."""
    at = "list_filter(range(1, len(ls) + 1), lambda i: " + strip("ls[i]") + " <> '')"
    label = lambda x: keyword(strip(strip(x), "*"))
    gone = "list_transform(ls, lambda x, i: CASE WHEN list_contains(gone, i) THEN '' ELSE x END)"
    section = f"(kind IN ('frontmatter', 'toc') AND {simple(rep('a', '[.:]+$'))} IN {SECTION_HEADINGS})"
    return f"""{out}0 AS (SELECT *, {at} AS at_ FROM {source}), {out}1 AS (SELECT *, coalesce({strip('ls[at_[1]]')}, '') AS a, coalesce({strip('ls[at_[2]]')}, '') AS b FROM {out}0),
    {out}2 AS (SELECT * EXCLUDE (a, b, at_), CASE WHEN kind IN {HEADER_KINDS} AND len(at_) >= 2 AND NOT {section} AND {running_header('a', 'b')} THEN at_[1:1] ELSE []::BIGINT[] END AS gone FROM {out}1),
    {out}3 AS (SELECT * EXCLUDE (ls, gone), {gone} AS ls, len(gone)::INTEGER AS {name}_header FROM {out}2), {out}4 AS (SELECT *, {at} AS at_ FROM {out}3),
    {out}5 AS (SELECT *, coalesce({strip('ls[at_[1]]')}, '') AS a, coalesce({strip('ls[at_[2]]')}, '') AS b FROM {out}4),
    {out}6 AS (SELECT * EXCLUDE (a, b, at_), CASE WHEN kind IN {STACK_KINDS} AND len(at_) >= 2 THEN CASE WHEN {header_with_number('a')} OR {header_combo('a')} THEN at_[1:1]
        WHEN ({page_number('a')} AND ({label('b')} OR {header_combo('b')})) OR ({label('a')} AND {page_number('b')}) THEN at_[1:2] ELSE []::BIGINT[] END ELSE []::BIGINT[] END AS gone FROM {out}5),
    {out} AS (SELECT * EXCLUDE (ls, gone), {gone} AS ls, len(gone)::INTEGER AS {name}_stack FROM {out}6)"""


_SX = strip("x")
_NOISE = f"(s <> '' AND ({has('upper(' + rep('s', '[.]+$') + ')', X.ROMAN)} OR {has('s', CODES)} OR {has('s', X.SCAN_NOISE)}))"
_SLIPS = " + ".join(f"contains(lower(text), '{m}')::INTEGER" for m in SLIP)
_CODE = "regexp_matches(lower(text), '\\bc[0-9]{8,}\\b')"
_SLIP = f"(kind IN {SLIP_KINDS} AND {strip('text')} <> '' AND (({_SLIPS}) >= 2 OR (({_SLIPS}) >= 1 AND {_CODE}) OR ({_CODE} AND len(list_filter(ls, lambda x: {_SX} <> '')) <= 3)))"
_CFULL = f"list_filter(list_transform(ls, lambda x: {_SX}), lambda x: x <> '' AND NOT {page_number('x')} AND NOT {stamp_sql('x')} AND NOT {has('x', ZOOM)})"
_CBARE = f"list_filter(list_transform(list_filter(cf, lambda x: NOT {has('x', PLACEMENT)}), lambda x: {strip(strip('x', '*_'), chr(92) + '[' + chr(92) + ']')}), lambda x: x <> '')"
_CLEANED = f"""{_DETECT}, {STRIPPED}, n0 AS (SELECT c.extraction_id, c.book_id, c.page_number, c.kind, coalesce(c.text, '') AS whole, string_split(coalesce(s.text, c.text, ''), chr(10)) AS ls FROM kinds c LEFT JOIN stripped s USING (extraction_id)),
    n1 AS (SELECT *, (len(list_filter(string_split(whole, chr(10)), lambda x: {_SX} <> '')) - len(list_filter(ls, lambda x: {_SX} <> '')))::INTEGER AS margins FROM n0),
    {_top_sql('n1', 'n2', 'top')},
    n3 AS (SELECT * EXCLUDE (ls), CASE WHEN kind IN {SIGNATURE_KINDS} THEN len(list_filter(ls, lambda x: {has('x', SIGNATURE)})) ELSE 0 END::INTEGER AS signatures, CASE WHEN kind IN {SIGNATURE_KINDS} THEN list_transform(ls, lambda x: {rep('x', SIGNATURE, chr(92) + '1')}) ELSE ls END AS ls FROM n2),
    n4 AS (SELECT *, CASE WHEN kind IN {STAMP_KINDS} THEN list_filter(ls, lambda x: NOT ({stamp_sql(_SX)} OR (kind = 'frontmatter' AND {_SX} IN {SHELLS}))) ELSE ls END AS ls2 FROM n3),
    n5 AS (SELECT * EXCLUDE (ls, ls2), (len(ls) - len(ls2))::INTEGER AS stamps, ls2 AS ls FROM n4),
    o0 AS (SELECT extraction_id, kind, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM n5 WHERE kind IN {NOISE_KINDS}), o1 AS (SELECT *, {strip('line')} AS s FROM o0), o2 AS (SELECT *, {_NOISE} AS noise, kind = 'toc' AND {has('s', '^[0-9]{1,4}$')} AS digits FROM o1),
    o3 AS (SELECT *, sum(CASE WHEN s <> '' AND NOT noise THEN 1 ELSE 0 END) OVER (PARTITION BY extraction_id ORDER BY i) AS g FROM o2),
    o4 AS (SELECT *, max(CASE WHEN s <> '' AND NOT noise THEN s END) OVER (PARTITION BY extraction_id, g) AS head, sum(CASE WHEN digits AND noise THEN 1 ELSE 0 END) OVER (PARTITION BY extraction_id, g ORDER BY i) AS k FROM o3),
    o5 AS (SELECT extraction_id, coalesce(list(line ORDER BY i) FILTER (WHERE s = '' OR NOT noise OR (digits AND k = 1 AND {has("coalesce(head, '')", REFERENCE_END)})), []) AS ls2 FROM o4 GROUP BY extraction_id),
    n6 AS (SELECT n5.* EXCLUDE (ls), coalesce(len(ls) - len(ls2), 0)::INTEGER AS scan_noise, coalesce(ls2, ls) AS ls FROM n5 LEFT JOIN o5 USING (extraction_id)),
    m1 AS (SELECT * FROM n6 WHERE scan_noise > 0), {_top_sql('m1', 'm2', 'again')},
    n7 AS (SELECT * FROM m2 UNION ALL BY NAME SELECT *, 0 AS again_header, 0 AS again_stack FROM n6 WHERE scan_noise = 0),
    n8 AS (SELECT *, array_to_string(ls, chr(10)) AS text, {_CFULL} AS cf FROM n7), n9 AS (SELECT *, {_SLIP} AS slip, {_CBARE} AS cb FROM n8),
    n10 AS (SELECT *, {rep(strip("coalesce(list_filter(cf, lambda x: starts_with(x, '[Illustration'))[1], CASE WHEN len(cb) > 0 THEN array_to_string(cb[1:" + str(CAPTION_LINES) + "], ' ') END, cf[1], '')"), X.WS + '+', ' ')} AS c0 FROM n9),
    n11 AS (SELECT *, {strip(f"regexp_replace(regexp_replace(c0, '{CAPTION_MARK}', ''), '{CAPTION_OWNER}', '')", chr(92) + '[' + chr(92) + ']')} AS c FROM n10),
    cleaned AS (SELECT extraction_id, kind, CASE WHEN slip THEN '' WHEN kind = 'illustration' THEN CASE WHEN len(cf) = 0 THEN '' WHEN c = '' THEN '[Illustration]' ELSE '[Illustration: ' || c || ']' END ELSE text END AS text,
        margins, top_header AS running_header, top_stack AS header_stack, signatures, stamps, scan_noise, again_header + again_stack AS top_again, slip::INTEGER AS loan_slip FROM n11)"""
SQL = {
    "cleaned_pages": f"WITH {_CLEANED} SELECT extraction_id, kind, sha1(text) AS text_sha1, len(list_filter(string_split(text, chr(10)), lambda x: {_SX} <> ''))::INTEGER AS lines_left FROM cleaned",
    "removed_lines": f"WITH {_CLEANED} SELECT kind, rule, count(*) AS pages, sum(n)::BIGINT AS removed FROM (" + " UNION ALL ".join(f"SELECT kind, '{r}' AS rule, {r} AS n FROM cleaned" for r in RULES) + ") WHERE n > 0 GROUP BY ALL",
}
