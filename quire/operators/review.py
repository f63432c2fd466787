"""What deserves a look before a book goes out: hotspots in the chapters, and the gate over the quality report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.duck import CURRENT, footnote_def, has, rep, simple, standalone_heading, strip, title_kind, words
from quire.operators.chapters import ORNAMENT, is_ordinal
from quire.operators.footnotes import SQL as FOOTNOTES
from quire.operators.footnotes import q_book_integrity
from quire.operators.maps import numbered_lines
from quire.operators.tables import _cells, _sep, cells, is_row, is_separator
from quire.sources.tables import latest, table

#: Hotspots of a book that are kept, in reading order; full lines of a chapter that may repeat its title.
MOST, OPENER = 200, 8
#: A line that stands so often in a book is a repeated header; so many of them are shown.
REPEATS, SHOWN = 3, 8
# Starts of marked-up lines, a line that goes on, and words of a heading.
MARKED, GOES_ON, HEADING_WORD = r"^(?:#|\||>|\[\^)", r"^[a-z\"“'(\[]", r"(?i)\b(?:book|part|chapter|introduction|preface|appendix|index)\b"
# A numbered heading, words run together with capitals, a page number left in brackets.
NUMBERED, HYPHENED, FUSED, TOKEN = r"(?i)^[ivxlcdm]+[.\-—–:]\s*\S+", r"\b[a-z]{4,}-[A-Z]{4,}\b", r"\b[a-z]{5,}[A-Z]{5,}\b", r"(?:^|[^\\])[\[{]\d{2,4}\b"


def _headingish(s: Column) -> Column:
    return X.is_standalone_heading(s) | is_ordinal(s) | s.rlike(NUMBERED) | s.rlike(HEADING_WORD)


def _prose(s: Column) -> Column:
    return (s != "") & (s.rlike(GOES_ON) | (X.words(s) > 8))


def _header(s: Column) -> Column:
    letters, upper = F.length(F.regexp_replace(s, r"[^\p{L}]", "")), F.length(F.regexp_replace(s, r"[^\p{Lu}]", ""))
    shape = (F.length(s) <= 80) & (X.words(s) <= 8) & (letters >= 4) & (upper * 10 >= letters * 8)
    return shape & ~s.rlike(MARKED) & ~s.rlike(ORNAMENT) & ~s.rlike(r"^[(\[]") & ~is_ordinal(s) & ~s.rlike(r"(?i)^[ivxlcdm]+$")


def hotspots(chapters: DataFrame, most: int = MOST) -> DataFrame:
    """``book_id, chapter_id, line_no, category, severity, s, rank`` of lines that deserve a look, the first ``most`` of each book.

    Categories: chapter_opener_duplicate, suspicious_boundary_merge,
    malformed_page_token, malformed_markdown_table_restart, header_like_body_line
    (between prose) and repeated_header_like_line.  Each full line is classed once
    with its neighbours in the chapter; windows run over a chapter, and over a
    book only for the few lines found, without their texts.
    """
    lines = numbered_lines(chapters, ["book_id", "chapter_id", "number", "title"], F.col("body")).withColumn("s", X.strip(F.col("line"))).where("s <> ''").drop("line")
    w = Window.partitionBy("chapter_id").orderBy("line_no")
    d = lines.withColumns({"rn": F.row_number().over(w), "prev": F.coalesce(F.lag("s").over(w), F.lit("")), "next": F.coalesce(F.lead("s").over(w), F.lit("")), "kind": X.title_kind(F.col("title")), "key": X.simple(F.regexp_replace("s", "[.:]+$", "")), "of": X.simple(F.regexp_replace(X.text("title"), "[.:]+$", ""))})
    marked = F.col("s").rlike(MARKED)
    # the opener ends with the first line that is no heading
    near = d.where(F.col("rn") <= OPENER)
    heading, long = _headingish(F.col("s")), F.length("key") >= 6
    ends = marked | X.is_footnote_def(F.col("s")) | F.col("s").rlike("^[a-z]") | (long & ~heading)
    near = near.withColumn("over", F.max(ends.cast("int")).over(w))
    repeats = (F.col("over") == 0) & long & heading & (F.col("of") != "") & (F.col("of").contains(F.col("key")) | F.col("key").contains(F.col("of")))
    opener = near.where(repeats).select("chapter_id", "line_no", F.lit(True).alias("opener"))
    row = is_row(F.col("s")) & ~is_separator(F.col("s"))
    rows = d.where(row).select("chapter_id", "line_no", "s", is_separator(F.col("next")).alias("head"), (is_row(F.col("next")) & (F.size(cells(F.col("next"))) == F.size(cells(F.col("s"))))).alias("again"))
    seen = F.max(F.col("head").cast("int")).over(Window.partitionBy("chapter_id", "s").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1))
    restart = rows.withColumn("seen", seen).where("not head and again and seen = 1").select("chapter_id", "line_no", F.lit(True).alias("restart"))
    d = d.join(opener, ["chapter_id", "line_no"], "left").join(restart, ["chapter_id", "line_no"], "left")
    like = ~F.col("kind").isin("frontmatter", "preface", "index") & _header(F.col("s")) & (_prose(F.col("prev")) | _prose(F.col("next")))
    free = ~marked
    found = [
        (F.coalesce("opener", F.lit(False)), "chapter_opener_duplicate", "medium"), (free & F.col("s").rlike(HYPHENED), "suspicious_boundary_merge", "high"), (free & ~F.col("s").rlike(HYPHENED) & F.col("s").rlike(FUSED), "suspicious_boundary_merge", "medium"),
        (free & F.col("s").rlike(TOKEN), "malformed_page_token", "medium"), (F.coalesce("restart", F.lit(False)), "malformed_markdown_table_restart", "medium"), (like, "header_like_body_line", "low"),
    ]
    each = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("category"), F.lit(v).alias("severity"))) for c, n, v in found]))
    hit = d.select("book_id", "chapter_id", "number", "line_no", "s", "key", F.explode(each).alias("e")).select("book_id", "chapter_id", "number", "line_no", "s", "key", "e.*")
    heads = hit.where("category = 'header_like_body_line' and key not in ('', 'introduction', 'preface')")
    many = heads.groupBy("book_id", "key").agg(F.count("*").alias("times")).where(F.col("times") >= REPEATS).select("book_id", "key")
    order = ["number", "chapter_id", "line_no"]
    again = heads.join(many, ["book_id", "key"]).withColumn("k", F.row_number().over(Window.partitionBy("book_id", "key").orderBy(*order))).where(F.col("k") <= SHOWN).drop("k")
    out = hit.unionByName(again.withColumns({"category": F.lit("repeated_header_like_line"), "severity": F.lit("medium")})).drop("key")
    # the rank needs no texts; a book's cells of chapters are cut to the first ones before they meet
    lean = out.select("book_id", *order, "category")
    cell = F.pmod(F.xxhash64("chapter_id"), F.lit(64)).alias("cell")
    first = lean.select("*", cell).withColumn("r", F.row_number().over(Window.partitionBy("book_id", "cell").orderBy(*order, "category"))).where(F.col("r") <= most).drop("r", "cell")
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("book_id").orderBy(*order, "category"))).where(F.col("rank") <= most)
    return out.join(first.drop("number"), ["book_id", "chapter_id", "line_no", "category"]).select("book_id", "chapter_id", "line_no", "category", "severity", "s", "rank")


# The rules of the gate: name, condition over a book's totals (SQL that both engines read).
GATE = (
    ("orphaned footnote refs", "orphaned > 0"),
    ("unreferenced footnote defs", "unreferenced > 0"),
    ("duplicate footnote defs", "repeated > 0"),
    ("no words", "total_words = 0"),
    ("failed pages", "failed_pages > 0"),
    ("empty pages that are not blank", "empty_pages > 0"),
)


def gate(integrity: DataFrame, chapters: DataFrame, pages: DataFrame) -> DataFrame:
    """``book_id, failures, passed``: a book passes if no rule of GATE holds.  Books without chapters or notes are judged too."""
    kind, ok = X.text("page_type"), F.coalesce("success", F.lit(False))
    p = pages.groupBy("book_id").agg(F.count_if((kind == "error") | ~ok).alias("failed_pages"), F.count_if(ok & (kind != "blank") & (X.strip(X.text("text")) == "")).alias("empty_pages"))
    c = chapters.groupBy("book_id").agg(F.sum(X.words(X.text("body"))).alias("total_words"))
    d = p.join(c, "book_id", "left").join(integrity.select("book_id", "orphaned", "unreferenced", "repeated"), "book_id", "left").na.fill(0, ["total_words", "orphaned", "unreferenced", "repeated"])
    failures = F.array_join(F.array_compact(F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in GATE])), "; ")
    return d.select("book_id", failures.alias("failures"), (~reduce(Column.__or__, [F.expr(c) for _, c in GATE])).alias("passed"))


def q_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots(table(spark, sf_dir, "chapters"))


def q_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate(q_book_integrity(spark, sf_dir), table(spark, sf_dir, "chapters"), latest(table(spark, sf_dir, "pages")))


QUERIES = {"hotspots": q_hotspots, "qa_gate": q_gate}

_B, _T = "coalesce(body, '')", "coalesce(text, '')"


def _ordinal_sql(x: str) -> str:
    o = strip(rep(strip(strip(x), "*"), "[.]+$"))
    return f"({o} <> '' AND (coalesce(CASE WHEN {has(o, '^[0-9]{1,3}$')} THEN {o}::INTEGER BETWEEN 1 AND 500 END, false) OR {has(f'upper({o})', X.ROMAN)}))"


def _prose_sql(x: str) -> str:
    return f"({x} <> '' AND ({has(x, GOES_ON)} OR {words(x)} > 8))"


_ROWX = "(starts_with(@, '|') AND ends_with(@, '|') AND length(@) >= 2)"
_HEADING = f"({standalone_heading('s')} OR {_ordinal_sql('s')} OR {has('s', NUMBERED)} OR {has('s', HEADING_WORD)})"
_HEADER = f"""(length(s) <= 80 AND {words('s')} <= 8 AND length({rep('s', '[^' + chr(92) + 'p{L}]')}) >= 4 AND length({rep('s', '[^' + chr(92) + 'p{Lu}]')}) * 10 >= length({rep('s', '[^' + chr(92) + 'p{L}]')}) * 8
    AND NOT {has('s', MARKED)} AND NOT {has('s', ORNAMENT)} AND NOT {has('s', '^[(' + chr(92) + '[]')} AND NOT {_ordinal_sql('s')} AND NOT {has('s', '(?i)^[ivxlcdm]+$')})"""
_FREE = f"NOT {has('s', MARKED)}"
SQL = {
    "hotspots": f"""WITH l AS (SELECT book_id, chapter_id, number, title, unnest(string_split({_B}, chr(10))) AS line, generate_subscripts(string_split({_B}, chr(10)), 1) AS line_no FROM chapters), f AS (SELECT *, {strip('line')} AS s FROM l),
        d AS (SELECT book_id, chapter_id, number, line_no, s, row_number() OVER w AS rn, coalesce(lag(s) OVER w, '') AS prev, coalesce(lead(s) OVER w, '') AS nxt, {title_kind('title')} AS kind, {simple(rep('s', '[.:]+$'))} AS key, {simple(rep("coalesce(title, '')", '[.:]+$'))} AS of_
            FROM f WHERE s <> '' WINDOW w AS (PARTITION BY chapter_id ORDER BY line_no)),
        n AS (SELECT *, {_HEADING} AS heading FROM d WHERE rn <= {OPENER}), o AS (SELECT *, max(({has('s', MARKED)} OR {footnote_def('s')} OR {has('s', '^[a-z]')} OR (length(key) >= 6 AND NOT heading))::INTEGER) OVER (PARTITION BY chapter_id ORDER BY line_no) AS over_ FROM n),
        op AS (SELECT chapter_id, line_no FROM o WHERE over_ = 0 AND length(key) >= 6 AND heading AND of_ <> '' AND (contains(of_, key) OR contains(key, of_))),
        r AS (SELECT chapter_id, line_no, s, {_sep('nxt')} AS head, {_ROWX.replace('@', 'nxt')} AND len({_cells('nxt')}) = len({_cells('s')}) AS again FROM d WHERE {_ROWX.replace('@', 's')} AND NOT {_sep('s')}),
        rs AS (SELECT *, max(head::INTEGER) OVER (PARTITION BY chapter_id, s ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM r), re AS (SELECT chapter_id, line_no FROM rs WHERE NOT head AND again AND seen = 1),
        h AS (SELECT book_id, chapter_id, number, line_no, s, key, 'chapter_opener_duplicate' AS category, 'medium' AS severity FROM d SEMI JOIN op USING (chapter_id, line_no)
            UNION ALL SELECT book_id, chapter_id, number, line_no, s, key, 'suspicious_boundary_merge', CASE WHEN {has('s', HYPHENED)} THEN 'high' ELSE 'medium' END FROM d WHERE {_FREE} AND ({has('s', HYPHENED)} OR {has('s', FUSED)})
            UNION ALL SELECT book_id, chapter_id, number, line_no, s, key, 'malformed_page_token', 'medium' FROM d WHERE {_FREE} AND {has('s', TOKEN)}
            UNION ALL SELECT book_id, chapter_id, number, line_no, s, key, 'malformed_markdown_table_restart', 'medium' FROM d SEMI JOIN re USING (chapter_id, line_no)
            UNION ALL SELECT book_id, chapter_id, number, line_no, s, key, 'header_like_body_line', 'low' FROM d WHERE kind NOT IN ('frontmatter', 'preface', 'index') AND {_HEADER} AND ({_prose_sql('prev')} OR {_prose_sql('nxt')})),
        m AS (SELECT book_id, key FROM h WHERE category = 'header_like_body_line' AND key NOT IN ('', 'introduction', 'preface') GROUP BY ALL HAVING count(*) >= {REPEATS}),
        g AS (SELECT h.* FROM h JOIN m USING (book_id, key) WHERE category = 'header_like_body_line' QUALIFY row_number() OVER (PARTITION BY book_id, key ORDER BY number, chapter_id, line_no) <= {SHOWN}),
        u AS (SELECT * FROM h UNION ALL SELECT * REPLACE ('repeated_header_like_line' AS category, 'medium' AS severity) FROM g)
        SELECT book_id, chapter_id, line_no::INTEGER AS line_no, category, severity, s, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY number, chapter_id, line_no, category) AS rank FROM u) WHERE rank <= {MOST}""",
    "qa_gate": f"""WITH {CURRENT}, n AS ({FOOTNOTES['footnote_book_integrity']}), p AS (SELECT book_id, count(*) FILTER (WHERE coalesce(page_type, '') = 'error' OR NOT coalesce(success, false)) AS failed_pages,
            count(*) FILTER (WHERE coalesce(success, false) AND coalesce(page_type, '') <> 'blank' AND {strip(_T)} = '') AS empty_pages FROM current GROUP BY book_id), c AS (SELECT book_id, sum({words(_B)}) AS total_words FROM chapters GROUP BY book_id),
        t AS (SELECT p.*, coalesce(total_words, 0) AS total_words, coalesce(orphaned, 0) AS orphaned, coalesce(unreferenced, 0) AS unreferenced, coalesce(repeated, 0) AS repeated FROM p LEFT JOIN c USING (book_id) LEFT JOIN n USING (book_id))
        SELECT book_id, array_to_string(list_filter([{', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in GATE)}], lambda x: x IS NOT NULL), '; ') AS failures, NOT ({' OR '.join(c for _, c in GATE)}) AS passed FROM t""",
}
