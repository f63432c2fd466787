"""Chapters: heading kinds, boundary joins, grouping of pages, assembly of books."""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from quire.functions import text as X
from quire.functions.duck import CURRENT, footnote_def, has, keyword, page_number, q, rep, simple, standalone_heading, strip, title_kind, words
from quire.functions.ordered import cell, with_previous, with_running_sum
from quire.operators.cleanup import is_stamp, stamp_sql
from quire.operators.pages import KINDS, page_kind
from quire.sources.tables import latest, table

STRUCTURAL = ("book", "part", "frontmatter", "index", "appendix", "preface", "introduction")
#: Kinds of page whose text may go on from one page to the next.
MERGEABLE = ("text", "frontmatter", "backmatter")
_CLOSERS = r"[\"”’')\]]*"


def boundary(prev_text: Column, next_text: Column) -> tuple[Column, Column]:
    """(joins, mode) of two neighbouring page texts.

    Modes: drop_hyphen, keep_hyphen (an upper-case continuation), paragraph (a
    quoted block after a colon), nospace (before punctuation) and space.
    """
    before, after = X.full_lines(X.text(prev_text)), X.full_lines(X.text(next_text))
    last, first = F.coalesce(F.element_at(F.when(F.size(before) > 0, before), -1), F.lit("")), F.coalesce(F.get(after, F.lit(0)), F.lit(""))
    return _joins(last, first), _mode(last, first)


def _joins(last: Column, first: Column) -> Column:
    barred = X.is_footnote_def(first) | first.rlike(X.PAGE_NUMBER) | first.rlike(r"(?i)^[ivxlcdm]{1,8}[.]?$") | first.startswith("[Illustration") | last.startswith("[Illustration")
    goes_on = first.rlike(r"^[a-z0-9\"'(\[]") | first.rlike(r"^-{2,}\s*[A-Za-z0-9\"'(\[]") | last.rlike(r"[,;:—]$")
    return (last != "") & (first != "") & ~barred & (last.endswith("-") | (~last.rlike(r"[.!?]" + _CLOSERS + "$") & goes_on))


def _mode(last: Column, first: Column) -> Column:
    return (
        F.when(last.endswith("-") & first.rlike("^[A-Z]"), "keep_hyphen")
        .when(last.endswith("-"), "drop_hyphen")
        .when(last.endswith(":") & first.rlike(r"^['\"“‘][A-Z]"), "paragraph")
        .when(first.rlike(r"^[.,;:)\]}\"'”’]"), "nospace")
        .otherwise("space")
    )


def boundaries(pages: DataFrame) -> DataFrame:
    """Every pair of successive mergeable pages of a book with its join decision.

    Only the last and first full lines of the pages travel through the window.
    """
    full = X.full_lines(X.text("text"))
    edge = pages.select("book_id", "page_number", "kind", F.coalesce(F.element_at(F.when(F.size(full) > 0, full), -1), F.lit("")).alias("last"), F.coalesce(F.get(full, F.lit(0)), F.lit("")).alias("first"))
    edge = edge.where("kind not in ('blank', 'illustration') and page_number is not null")
    d = with_previous(edge, "book_id", "page_number", {"prev_page": "page_number", "prev_kind": "kind", "prev_last": "last"})
    able = F.col("kind").isin(*MERGEABLE) & F.col("prev_kind").isin(*MERGEABLE, "chapter_start")
    joins = able & _joins(F.col("prev_last"), F.col("first"))
    return d.where("prev_page is not null").select("book_id", "prev_page", F.col("page_number").alias("next_page"), joins.alias("joins"), F.when(joins, _mode(F.col("prev_last"), F.col("first"))).alias("mode"), catchword(F.col("prev_last")).alias("catchword"))


def grouped_strict(pages: DataFrame) -> DataFrame:
    """Chapter number of each page by a running count of chapter starts (all titles distinct)."""
    d = pages.select("book_id", "page_number", "kind", (F.col("kind") == "chapter_start").cast("int").alias("start"))
    return with_running_sum(d, "book_id", "page_number", "start", "chapter").drop("start")


#: Words that name a chapter-like division, and those that outweigh an overlap of titles.
DIVISION, STRONG = r"(?i)\b(?:chapter|book|part|introduction|preface|conclusion|appendix|index)\b", r"(?i)\b(?:chapter|book|part|appendix|conclusion)\b"
# Lines of ornaments; parts of a library's name on lines of their own.
ORNAMENT, LIBRARY_LINE = r"^[\-—–_*=·•♦◈\s]{3,}$", r"(?i)^(?:univ\.?\s+of|california\.?)$"
#: Lines at the top of a page that may hold an opener, and of those that stand before prose.
OPENER_LINES, BEFORE_PROSE = 16, 8
#: Pages of one piece of a body, and the title of what stands before the first chapter.
PIECE_PAGES, FIRST_TITLE = 512, "Front Matter"


def is_ordinal(c: Column) -> Column:
    """A number up to 500 or a Roman numeral alone on its line."""
    s = X.strip(F.regexp_replace(X.strip(X.strip(c), "*"), r"\.+$", ""))
    number = F.when(s.rlike(r"^\d{1,3}$"), s.cast("int"))
    return (s != "") & (F.coalesce(number.between(1, 500), F.lit(False)) | F.upper(s).rlike(X.ROMAN))


def _overlap(a: Column, b: Column) -> Column:
    return (a != "") & (b != "") & ((a == b) | b.contains(a) | a.contains(b))


def opens_chapter(t: Column, heading: Column) -> Column:
    """Whether a page of plain text holds a stack of headings before its prose, and its heading is among them."""
    h = X.simple(X.strip(heading))

    def headingish(x: Column) -> Column:
        letters, upper = F.length(F.regexp_replace(x, r"[^\p{L}]", "")), F.length(F.regexp_replace(x, r"[^\p{Lu}]", ""))
        return X.is_standalone_heading(x) | is_ordinal(x) | x.rlike(X.ascii_edges(DIVISION)) | ((letters > 0) & (F.length(x) <= 100) & (X.words(x) <= 10) & (upper * 100 >= letters * 65))

    def stacked(visible: Column) -> Column:
        prose = F.array_position(F.transform(visible, lambda x: x.rlike("^[a-z]") | (F.length(x) > 90) | ((X.words(x) > 12) & x.rlike("[a-z].*[a-z].*[a-z]"))), True)
        length = X.let(prose.cast("int"), lambda n: F.least(F.lit(BEFORE_PROSE), F.when(n > 0, n - 1).otherwise(F.size(visible))))
        return (F.size(visible) >= 2) & X.let(F.slice(visible, F.lit(1), length), titled)

    def titled(before: Column) -> Column:
        named = F.exists(before, lambda x: x.rlike(X.ascii_edges(DIVISION))) | F.exists(before, lambda x: X.let(X.simple(F.regexp_replace(x, "[.:]+$", "")), lambda own: _overlap(own, h)))
        return (F.size(before) >= 2) & (F.size(F.filter(before, headingish)) >= 2) & named

    visible = F.filter(
        F.slice(X.full_lines(t), 1, OPENER_LINES),
        lambda x: ~X.is_page_number(x) & ~x.rlike(ORNAMENT) & ~((F.length(x) <= 90) & (X.words(x) <= 10) & is_stamp(x)) & ~x.rlike(LIBRARY_LINE),
    )
    return (X.strip(heading) != "") & (heading.rlike(X.ascii_edges(DIVISION)) | (F.length(h) >= 20)) & X.let(visible, stacked)


#: What the walk over a book's cells gives each cell: see ``walked``.
_EDGE = [("page_number", pa.int32()), ("kind", pa.string()), ("last", pa.string())]
_WALKED = pa.schema([
    ("book_id", pa.string()), ("cell", pa.int64()), ("chapters", pa.int32()), ("title", pa.string()), ("prev", pa.struct(_EDGE)), ("next", pa.struct([("kind", pa.string()), ("first", pa.string()), ("starts", pa.bool_())])),
    ("texts", pa.int32()), ("pages", pa.list_(pa.int32())), ("titles", pa.list_(pa.string())),
])


def walked(cells: DataFrame) -> DataFrame:
    """One row per cell of a book: the state it begins with, and the pages in it that start a chapter.

    A possible start whose title equals or overlaps the title it stands under is a
    running header and stays in the chapter, if the chapter has text already; a
    rescued page must differ, any other may overlap if its own lines are a strong
    opener.  That depends on the title so far and can't be a window.

    ``chapters, title``: starts so far and the last one's title; ``prev``, ``next``: the
    nearest page with an edge before and after the cell; ``texts``: the chapter of the
    last page with text before it.
    """

    def walk(book: pa.Table) -> pa.Table:
        cells = sorted(book.to_pylist(), key=lambda c: c["cell"])
        old, at, rest, title, count, full, prev, texts, rows = FIRST_TITLE.lower(), None, False, FIRST_TITLE, 0, None, None, None, []
        for c in cells:
            row = {"book_id": c["book_id"], "cell": c["cell"], "chapters": count, "title": title, "prev": prev, "next": None, "texts": texts, "pages": [], "titles": []}
            for x in c["candidates"]:
                before, new = full if x["before"] is None else x["before"], x["key"]
                body = before is not None and (at is None or before > at or (before == at and rest))
                overlap = body and new and old and (new == old or new in old or old in new)
                if overlap and (x["rescued"] or not x["strong"]):
                    continue
                old, at, rest, title, count = new, x["page_number"], x["rest"], x["heading"], count + 1
                row["pages"].append(at)
                row["titles"].append(title)
            if c["last_text"] is not None:
                texts = row["chapters"] + bisect_right(row["pages"], c["last_text"])
            full, prev = c["last_full"] if c["last_full"] is not None else full, c["last_edge"] or prev
            rows.append(row)
        coming = None
        for c, row in zip(reversed(cells), reversed(rows), strict=True):
            row["next"] = coming
            if edge := c["first_edge"]:
                coming = {"kind": edge["kind"], "first": edge["first"], "starts": edge["page_number"] in row["pages"]}
        return pa.Table.from_pylist(rows, schema=_WALKED)

    return cells.groupBy("book_id").applyInArrow(walk, from_arrow_schema(_WALKED))


def placed(pages: DataFrame) -> DataFrame:
    """Each page with a number: ``book_id, page_number, cell, kind, text, edge, first, last``, its ``chapter`` and ``title``, whether it ``starts`` it, ``prev`` and ``next`` (the nearest pages with an edge), ``opens_text`` (no page before has text of the chapter).

    The pages are looked at once and kept on the executors' disks, sorted within cells
    of a book; one branch sums up each cell for the walk over the book, the other reads
    the pages with what the walk found.
    """
    said, start, w = X.strip(X.text("chapter_heading")), F.col("kind") == "chapter_start", Window.partitionBy("book_id", "cell").orderBy("page_number")
    past, so_far = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    d = pages.where("page_number is not null and book_id is not null").withColumn("cell", cell("page_number")).repartition("book_id", "cell")
    d = d.select("book_id", "page_number", "cell", "kind", X.strip(X.text("text")).alias("whole"), "page_type", said.alias("said"))
    d = d.withColumns({"ls": X.full_lines(F.col("whole")), "may": start | (F.col("kind") == "text")})
    opens = F.col("may") & F.coalesce(F.col("page_type") == "text", F.lit(False)) & opens_chapter(F.col("whole"), F.col("said"))
    d = d.withColumns({"edge": ~F.col("kind").isin("blank", "illustration"), "first": F.coalesce(F.get("ls", F.lit(0)), F.lit("")), "last": F.coalesce(F.element_at(F.when(F.size("ls") > 0, F.col("ls")), -1), F.lit("")), "opens": opens})
    heading = F.when(F.col("said") != "", F.col("said")).otherwise(F.substring(X.strip(F.regexp_replace("first", "^#+", "")), 1, 80))
    d = d.withColumn("heading", F.when(start | F.col("opens"), heading)).withColumn("key", X.simple(F.col("heading")))
    rest = F.exists("ls", lambda x: ~(X.is_keyword(x) | X.let(X.simple(x), lambda own: _overlap(own, F.col("key")))))
    candidate = F.when(F.col("heading").isNotNull(), F.struct("page_number", "heading", "key", (~start).alias("rescued"), (F.col("opens") & F.col("heading").rlike(X.ascii_edges(STRONG))).alias("strong"), rest.alias("rest")))
    text = F.when(F.col("kind") != "blank", F.col("whole")).otherwise("")
    d = d.select("book_id", "page_number", "cell", "kind", text.alias("text"), "edge", "first", "last", candidate.alias("candidate")).persist(StorageLevel.DISK_ONLY)

    full, edge = F.when(F.col("kind") != "blank", F.col("page_number")), lambda *names: F.when(F.col("edge"), F.struct(*names))
    s = d.select("book_id", "page_number", "cell", full.alias("full"), F.when(F.col("text") != "", F.col("page_number")).alias("with_text"), edge("page_number", "kind", "last").alias("ending"), edge("page_number", "kind", "first").alias("beginning"), "candidate")
    s = s.withColumn("before", F.last("full", True).over(past))
    s = s.groupBy("book_id", "cell").agg(
        F.max("full").alias("last_full"), F.max("with_text").alias("last_text"), F.max_by("ending", "ending.page_number").alias("last_edge"), F.min_by("beginning", "beginning.page_number").alias("first_edge"),
        F.array_sort(F.collect_list(F.when(F.col("candidate").isNotNull(), F.struct("candidate.*", "before")))).alias("candidates"),
    )
    d = d.drop("candidate").join(walked(s), ["book_id", "cell"])
    d = d.withColumn("at", F.array_position("pages", F.col("page_number")).cast("int"))
    d = d.select("*", (F.col("at") > 0).alias("starts"), F.when(F.col("at") > 0, F.get("titles", F.col("at") - 1)).alias("own_title")).drop("pages", "titles", "at")
    d = d.withColumns({"ending": edge("page_number", "kind", "last"), "beginning": edge("kind", "first", "starts")})
    d = d.withColumns({
        "chapter": (F.col("chapters") + F.sum(F.col("starts").cast("int")).over(so_far)).cast("int"), "title": F.coalesce(F.last("own_title", True).over(so_far), "title"),
        "prev": F.coalesce(F.last("ending", True).over(past), "prev"), "next": F.coalesce(F.expr("lead(beginning) ignore nulls over (partition by book_id, cell order by page_number)"), "next"),
    })
    before = F.coalesce(F.last(F.when(F.col("text") != "", F.col("chapter")), True).over(past), "texts")
    return d.withColumn("opens_text", (F.col("text") != "") & ~before.eqNullSafe(F.col("chapter"))).drop("chapters", "texts", "own_title", "ending", "beginning")


def grouped(pages: DataFrame) -> DataFrame:
    """``book_id, page_number, chapter, title``: only possible chapter starts enter the walk over a book."""
    return placed(pages).select("book_id", "page_number", "chapter", "title")


# The word that ends a page, the word that begins one, and signs that follow without a blank.
_LAST_WORD, _FIRST_WORD = r"([A-Za-zſ][A-Za-zſ'’\-]{3,})[.,;:!?]*\s*$", r"^[\"'“‘(\[]*([A-Za-zſ][A-Za-zſ'’\-]{3,})\b[.,;:!?]*(?:\s+|$)"
_NO_SPACE = r"^[.,;:)\]}\"'”’]"


def catchword(last: Column) -> Column:
    """The last word of a line as it may stand again on the next page ('' if it is divided)."""
    return F.when(last.endswith("-"), "").otherwise(F.translate(F.lower(F.regexp_extract(last, _LAST_WORD, 1)), "ſ", "s"))


def without_catchword(word: Column, t: Column) -> Column:
    """A text without its first word if that is the catchword and more follows."""
    rest = F.regexp_replace(t, X.ascii_edges(_FIRST_WORD), "")
    own = F.translate(F.lower(F.regexp_extract(t, X.ascii_edges(_FIRST_WORD), 1)), "ſ", "s")
    return F.when((word != "") & (own == word) & (X.strip(rest) != ""), F.ltrim(rest)).otherwise(t)


def bodies(pages: DataFrame) -> DataFrame:
    """``book_id, chapter, title, piece, body, pages, first_page``: page texts in order, joined at the boundaries as decided.

    What a page gives depends on its neighbours' edges only, so it is known
    before anything is grouped; a body comes in pieces of PIECE_PAGES page
    numbers, to be put together without anything between.
    """
    d = placed(pages)
    # a page joins the one before it in its chapter, and gives up its hyphen to the one after it
    able = lambda before, after: before.isin(*MERGEABLE, "chapter_start") & after.isin(*MERGEABLE)
    joins = F.col("edge") & ~F.col("starts") & F.col("prev").isNotNull() & able(F.col("prev.kind"), F.col("kind")) & _joins(F.col("prev.last"), F.col("first"))
    cut = F.col("edge") & F.col("last").endswith("-") & F.col("next").isNotNull() & ~F.col("next.starts") & able(F.col("kind"), F.col("next.kind")) & _joins(F.col("last"), F.col("next.first")) & (_mode(F.col("last"), F.col("next.first")) == "drop_hyphen")
    d = d.withColumns({"mode": F.when(joins, _mode(F.col("prev.last"), F.col("first"))), "cut": F.coalesce(cut, F.lit(False))})
    dashed = F.regexp_replace("text", r"^-{2,}\s*(?=[A-Za-z0-9\"'(\[])", "")
    d = d.withColumn("own", F.when(F.col("mode").isNull(), F.col("text")).otherwise(X.let(dashed, lambda t: without_catchword(catchword(F.col("prev.last")), t))))
    sep = F.when(F.col("opens_text"), "").when(F.col("mode").isin("drop_hyphen", "keep_hyphen"), "").when(F.col("mode").isin("space", "nospace"), F.when(F.col("own").rlike(_NO_SPACE), "").otherwise(" ")).otherwise("\n\n")
    part = F.when(F.col("text") == "", "").otherwise(F.concat(sep, F.when(F.col("cut"), F.regexp_replace("own", r"-\s*$", "")).otherwise(F.col("own"))))
    d = d.select("book_id", "cell", "chapter", "title", F.floor(F.col("page_number") / PIECE_PAGES).cast("int").alias("piece"), "page_number", part.alias("part"))
    parts = F.array_sort(F.collect_list(F.struct("page_number", "part")))  # at most PIECE_PAGES
    # a piece lies in one cell, so the pages stay where they are
    g = d.groupBy("book_id", "cell", "chapter", "title", "piece").agg(F.array_join(F.transform(parts, lambda x: x["part"]), "").alias("body"), F.count("*").alias("pages"), F.min("page_number").alias("first_page"))
    return g.drop("cell")


def heading_plan(chapters: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """Level and emission of each chapter's heading; a plan's rows override the defaults."""
    kind = X.title_kind(F.col("title"))
    d = chapters.select("chapter_id", "title", kind.alias("kind"), X.heading_level(F.col("title")).alias("level"), kind.isin(*STRUCTURAL).alias("emit_if_empty"), (X.strip(X.text("body")) == "").alias("is_empty"))
    if plan is not None:
        p = plan.select("chapter_id", F.col("heading_level").alias("_l"), F.col("emit_if_empty").alias("_e"))
        d = d.join(p, "chapter_id", "left").withColumns({"level": F.coalesce(F.when(F.col("_l").between(2, 4), F.col("_l")), "level"), "emit_if_empty": F.coalesce("_e", "emit_if_empty")}).drop("_l", "_e")
    return d.withColumn("emitted", ~F.col("is_empty") | F.col("emit_if_empty"))


def books(chapters: DataFrame, pages: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per book: chapters, words, pages, blank pages, pages to review, mean fidelity."""
    c = chapters.groupBy("book_id").agg(F.count("*").alias("chapters"), F.sum(X.words(X.text("body"))).alias("total_words"), F.count_if(X.text("body").rlike(X.INDIC)).alias("indic_chapters"))
    kind, ok = X.text("page_type"), F.coalesce("success", F.lit(False))
    p = pages.groupBy("book_id").agg(
        F.count("*").alias("total_pages"), F.count_if(kind == "blank").alias("blank_pages"), F.count_if(F.coalesce(F.size("warnings"), F.lit(0)) > 0).alias("review_pages"),
        F.coalesce(F.round(F.avg(F.when(ok & (kind != "blank"), F.col("fidelity"))), 1), F.lit(0.0)).alias("avg_fidelity"),
    )
    return catalog.select("book_id", "title", "author").join(p, "book_id", "left").join(c, "book_id", "left")


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest pages with their kind."""
    p = latest(table(spark, sf_dir, "pages"))
    return p.select("book_id", "page_number", "text", "page_type", "chapter_heading", page_kind(p).alias("kind"))


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, kept on the executors' disks, as several branches of a query read it, and computed again where one is lost."""
    return _current(spark, sf_dir).persist(StorageLevel.DISK_ONLY)


def q_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundaries(_kept(spark, sf_dir)).drop("catchword")


def q_grouped_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_strict(_kept(spark, sf_dir).where("page_number is not null"))


def q_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(_current(spark, sf_dir))


def q_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bodies(_current(spark, sf_dir))
    return b.select("book_id", "chapter", "title", "piece", "pages", "first_page", X.words(F.col("body")).alias("words"), F.sha1("body").alias("body_sha1"))


def q_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heading_plan(table(spark, sf_dir, "chapters"))


def q_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return books(table(spark, sf_dir, "chapters"), latest(table(spark, sf_dir, "pages")), table(spark, sf_dir, "books"))


def q_chapter_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of each chapter from its pages: an exploded equi-join, any() over the pages."""
    c = table(spark, sf_dir, "chapters").select("chapter_id", "book_id", F.explode("pages").alias("page_number"))
    p = latest(table(spark, sf_dir, "pages")).select("book_id", "page_number", "has_poetry", "has_tables", F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    return c.join(p, ["book_id", "page_number"]).groupBy("chapter_id").agg(F.count("*").alias("pages_found"), F.coalesce(F.bool_or("has_poetry"), F.lit(False)).alias("any_poetry"), F.coalesce(F.bool_or("has_tables"), F.lit(False)).alias("any_tables"), F.min("confidence").alias("least_confidence"))


QUERIES = {
    "boundary_joins": q_boundaries, "chapters_strict": q_grouped_strict, "chapters_grouped": q_grouped, "chapter_bodies": q_bodies, "heading_plan": q_headings, "assembled_books": q_books, "chapter_page_flags": q_chapter_pages,
}

_TEXT = "coalesce(text, '')"
_JOINS = f"""(prev_last <> '' AND first <> '' AND NOT ({footnote_def('first')} OR {has('first', X.PAGE_NUMBER)} OR {has('first', '(?i)^[ivxlcdm]{1,8}[.]?$')} OR starts_with(first, '[Illustration') OR starts_with(prev_last, '[Illustration'))
    AND (ends_with(prev_last, '-') OR (NOT {has('prev_last', '[.!?]' + _CLOSERS + '$')} AND ({has('first', r'''^[a-z0-9"'(\[]''')} OR {has('first', r'''^-{2,}\s*[A-Za-z0-9"'(\[]''')} OR {has('prev_last', '[,;:—]$')}))))"""
_MODE = f"""CASE WHEN ends_with(prev_last, '-') AND {has('first', '^[A-Z]')} THEN 'keep_hyphen' WHEN ends_with(prev_last, '-') THEN 'drop_hyphen' WHEN ends_with(prev_last, ':') AND {has('first', r'''^['"“‘][A-Z]''')} THEN 'paragraph'
    WHEN {has('first', r'''^[.,;:)\]}"'”’]''')} THEN 'nospace' ELSE 'space' END"""
_LINES = f"list_filter(list_transform(string_split({_TEXT}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
_FOLDED = "translate(lower(@), 'ſ', 's')"
_BOUNDS = f"""b0 AS (SELECT book_id, page_number, kind, {_LINES} AS ls FROM kinds WHERE page_number IS NOT NULL AND kind NOT IN ('blank', 'illustration')),
    b1 AS (SELECT book_id, page_number, kind, coalesce(ls[len(ls)], '') AS last, coalesce(ls[1], '') AS first FROM b0),
    b2 AS (SELECT *, lag(page_number) OVER o AS prev_page, lag(kind) OVER o AS prev_kind, lag(last) OVER o AS prev_last FROM b1 WINDOW o AS (PARTITION BY book_id ORDER BY page_number)),
    b3 AS (SELECT *, kind IN ('text', 'frontmatter', 'backmatter') AND prev_kind IN ('text', 'frontmatter', 'backmatter', 'chapter_start') AND {_JOINS} AS joins FROM b2 WHERE prev_page IS NOT NULL),
    bounds AS (SELECT book_id, prev_page, page_number AS next_page, joins, CASE WHEN joins THEN {_MODE} END AS mode, CASE WHEN ends_with(prev_last, '-') THEN '' ELSE {_FOLDED.replace("@", f"regexp_extract(prev_last, {q(_LAST_WORD)}, 1)")} END AS catchword FROM b3)"""


def _overlap_sql(a: str, b: str) -> str:
    return f"({a} <> '' AND {b} <> '' AND ({a} = {b} OR contains({b}, {a}) OR contains({a}, {b})))"


def _headingish_sql(x: str) -> str:
    o = strip(rep(strip(strip(x), "*"), "[.]+$"))
    ordinal = f"({o} <> '' AND (coalesce(CASE WHEN {has(o, '^[0-9]{1,3}$')} THEN {o}::INTEGER BETWEEN 1 AND 500 END, false) OR {has(f'upper({o})', X.ROMAN)}))"
    letters, upper = f"length({rep(x, '[^' + chr(92) + 'p{L}]')})", f"length({rep(x, '[^' + chr(92) + 'p{Lu}]')})"
    return f"({standalone_heading(x)} OR {ordinal} OR {has(x, DIVISION)} OR ({letters} > 0 AND length({x}) <= 100 AND {words(x)} <= 10 AND {upper} * 100 >= {letters} * 65))"


_PROSE = f"({has('x', '^[a-z]')} OR length(x) > 90 OR ({words('x')} > 12 AND {has('x', '[a-z].*[a-z].*[a-z]')}))"
_GROUPED = f"""g0 AS (SELECT book_id, page_number, kind, coalesce(page_type, '') = 'text' AS plain, {_LINES} AS ls, {strip("coalesce(chapter_heading, '')")} AS said FROM kinds WHERE page_number IS NOT NULL AND book_id IS NOT NULL AND kind <> 'blank'),
    g1 AS (SELECT *, CASE WHEN said <> '' THEN said ELSE substr({strip(rep("coalesce(ls[1], '')", '^#+'))}, 1, 80) END AS heading, {simple('said')} AS h,
        list_filter(ls[1:{OPENER_LINES}], lambda x: NOT {page_number('x')} AND NOT {has('x', ORNAMENT)} AND NOT (length(x) <= 90 AND {words('x')} <= 10 AND {stamp_sql('x')}) AND NOT {has('x', LIBRARY_LINE)}) AS vis FROM g0),
    g2 AS (SELECT *, coalesce(list_position(list_transform(vis, lambda x: {_PROSE}), true), 0) AS prose FROM g1),
    g3 AS (SELECT *, vis[1:least({BEFORE_PROSE}, CASE WHEN prose > 0 THEN prose - 1 ELSE len(vis) END)] AS pre FROM g2),
    g4 AS (SELECT *, plain AND said <> '' AND ({has('said', DIVISION)} OR length(h) >= 20) AND len(vis) >= 2 AND len(pre) >= 2 AND len(list_filter(pre, lambda x: {_headingish_sql('x')})) >= 2
        AND (len(list_filter(pre, lambda x: {_overlap_sql(simple(rep('x', '[.:]+$')), 'h')})) > 0 OR len(list_filter(pre, lambda x: {has('x', DIVISION)})) > 0) AS opens, {simple('heading')} AS key, lag(page_number) OVER (PARTITION BY book_id ORDER BY page_number) AS before FROM g3),
    g5 AS (SELECT book_id, page_number, heading, key, opens AND kind = 'text' AS rescued, opens AND {has('heading', STRONG)} AS strong, before,
        len(list_filter(ls, lambda x: NOT ({keyword('x')} OR {_overlap_sql(simple('x'), 'key')}))) > 0 AS rest, row_number() OVER (PARTITION BY book_id ORDER BY page_number) AS rn FROM g4 WHERE kind = 'chapter_start' OR (opens AND kind = 'text')),
    walk AS (SELECT book_id, 0::BIGINT AS rn, '{FIRST_TITLE.lower()}' AS old, NULL::INTEGER AS spot, false AS more, 0 AS chapter, NULL::INTEGER AS page_number, NULL::VARCHAR AS title, false AS took FROM (SELECT DISTINCT book_id FROM g5)
        UNION ALL SELECT book_id, rn, CASE WHEN took THEN key ELSE old END, CASE WHEN took THEN page_number ELSE spot END, CASE WHEN took THEN rest ELSE more END, chapter + took::INTEGER, page_number, CASE WHEN took THEN heading ELSE title END, took
        FROM (SELECT w.book_id, g.rn, w.old, w.spot, w.more, w.chapter, g.page_number, w.title, g.key, g.rest, g.heading,
            NOT (coalesce(g.before IS NOT NULL AND (w.spot IS NULL OR g.before > w.spot OR (g.before = w.spot AND w.more)), false) AND {_overlap_sql('g.key', 'w.old')} AND (g.rescued OR NOT g.strong)) AS took
            FROM walk w JOIN g5 g ON g.book_id = w.book_id AND g.rn = w.rn + 1)),
    found AS (SELECT book_id, page_number, chapter, title FROM walk WHERE took),
    numbered AS (SELECT k.book_id, k.page_number, sum(CASE WHEN f.chapter IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY k.book_id ORDER BY k.page_number)::INTEGER AS chapter FROM kinds k LEFT JOIN found f USING (book_id, page_number) WHERE k.page_number IS NOT NULL AND k.book_id IS NOT NULL),
    grouped AS (SELECT n.book_id, n.page_number, n.chapter, coalesce(f.title, '{FIRST_TITLE}') AS title FROM numbered n LEFT JOIN found f ON f.book_id = n.book_id AND f.chapter = n.chapter)"""
_REST = f"ltrim({rep('dashed', _FIRST_WORD)})"
_BODIES = f"""d0 AS (SELECT g.*, CASE WHEN k.kind <> 'blank' THEN {strip("coalesce(k.text, '')")} ELSE '' END AS text FROM grouped g JOIN kinds k USING (book_id, page_number)),
    d1 AS (SELECT book_id, chapter, min(page_number) AS first FROM d0 WHERE text <> '' GROUP BY ALL),
    d2 AS (SELECT b.book_id, b.next_page AS page_number, b.prev_page, b.mode, b.catchword FROM bounds b JOIN d0 x ON x.book_id = b.book_id AND x.page_number = b.next_page JOIN d0 y ON y.book_id = b.book_id AND y.page_number = b.prev_page WHERE b.joins AND x.chapter = y.chapter),
    d3 AS (SELECT d0.*, first, mode, catchword, o.prev_page IS NOT NULL AS cut, CASE WHEN mode IS NULL THEN text ELSE regexp_replace(text, '^-{{2,}}\\s*([A-Za-z0-9"''(\\[])', '\\1') END AS dashed FROM d0 LEFT JOIN d1 USING (book_id, chapter) LEFT JOIN d2 USING (book_id, page_number)
        LEFT JOIN (SELECT book_id, prev_page FROM d2 WHERE mode = 'drop_hyphen') o ON o.book_id = d0.book_id AND o.prev_page = d0.page_number),
    d4 AS (SELECT *, CASE WHEN mode IS NOT NULL AND catchword <> '' AND {_FOLDED.replace("@", f"regexp_extract(dashed, {q(_FIRST_WORD)}, 1)")} = catchword AND {strip(rep('dashed', _FIRST_WORD))} <> '' THEN {_REST} ELSE dashed END AS own FROM d3),
    d5 AS (SELECT *, CASE WHEN text = '' THEN '' ELSE CASE WHEN page_number = first THEN '' WHEN mode IN ('drop_hyphen', 'keep_hyphen') THEN '' WHEN mode IN ('space', 'nospace') THEN CASE WHEN {has('own', _NO_SPACE)} THEN '' ELSE ' ' END ELSE chr(10) || chr(10) END
        || CASE WHEN cut THEN regexp_replace(own, '-\\s*$', '') ELSE own END END AS part FROM d4),
    bodies AS (SELECT book_id, chapter, title, (page_number // {PIECE_PAGES})::INTEGER AS piece, string_agg(part, '' ORDER BY page_number) AS body, count(*) AS pages, min(page_number) AS first_page FROM d5 GROUP BY ALL)"""
SQL = {
    "boundary_joins": f"""WITH {KINDS}, {_BOUNDS} SELECT book_id, prev_page, next_page, joins, mode FROM bounds""",
    "chapters_strict": f"WITH {KINDS} SELECT book_id, page_number, kind, sum(CASE WHEN kind = 'chapter_start' THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY page_number)::BIGINT AS chapter FROM kinds WHERE page_number IS NOT NULL",
    "chapters_grouped": f"WITH RECURSIVE {KINDS}, {_GROUPED} SELECT book_id, page_number, chapter, title FROM grouped",
    "chapter_bodies": f"WITH RECURSIVE {KINDS}, {_GROUPED}, {_BOUNDS}, {_BODIES} SELECT book_id, chapter, title, piece, pages, first_page, {words('body')}::INTEGER AS words, sha1(body) AS body_sha1 FROM bodies",
    "heading_plan": f"""WITH k AS (SELECT chapter_id, title, {title_kind('title')} AS kind, {strip("coalesce(body, '')")} = '' AS is_empty FROM chapters)
        SELECT chapter_id, title, kind, CASE WHEN kind IN ('part', 'chapter') THEN 3 ELSE 2 END AS level, kind IN {STRUCTURAL} AS emit_if_empty, is_empty, NOT is_empty OR kind IN {STRUCTURAL} AS emitted FROM k""",
    "assembled_books": f"""WITH {CURRENT}, c AS (SELECT book_id, count(*) AS chapters, sum({words("coalesce(body, '')")})::BIGINT AS total_words, count(*) FILTER (WHERE {has("coalesce(body, '')", X.INDIC)}) AS indic_chapters FROM chapters GROUP BY book_id),
        p AS (SELECT book_id, count(*) AS total_pages, count(*) FILTER (WHERE page_type = 'blank') AS blank_pages, count(*) FILTER (WHERE len(coalesce(warnings, [])) > 0) AS review_pages,
        coalesce(round(avg(fidelity) FILTER (WHERE coalesce(success, false) AND coalesce(page_type, '') <> 'blank'), 1), 0.0) AS avg_fidelity FROM current GROUP BY book_id)
        SELECT b.book_id, title, author, total_pages, blank_pages, review_pages, avg_fidelity, chapters, total_words, indic_chapters FROM (SELECT book_id, title, author FROM books) b LEFT JOIN p USING (book_id) LEFT JOIN c USING (book_id)""",
    "chapter_page_flags": f"""WITH {CURRENT}, c AS (SELECT chapter_id, book_id, unnest(pages) AS page_number FROM chapters)
        SELECT chapter_id, count(*) AS pages_found, coalesce(bool_or(has_poetry), false) AS any_poetry, coalesce(bool_or(has_tables), false) AS any_tables, min(coalesce(confidence, 0)) AS least_confidence FROM c JOIN current p USING (book_id, page_number) GROUP BY chapter_id""",
}
