"""Markdown tables and tables of contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.duck import CURRENT, LINES, has, rep, strip
from quire.operators.maps import numbered_lines
from quire.sources.tables import latest, table

#: A row of a table of contents: label, leader or gap, page.
TOC_ROW = r"^(?:([ivxlcdmIVXLCDM]+|\d+)\.\s+)?(.*?\S)\s*(?:\.{2,}|\s{2,})\s*(\d{1,4}|[ivxlcdm]{1,8})\s*$"


def is_row(c: Column) -> Column:
    s = X.strip(c)
    return s.startswith("|") & s.endswith("|") & (F.length(s) >= 2)


def cells(c: Column) -> Column:
    """Trimmed cells of a table row."""
    return F.transform(F.split(F.regexp_replace(X.strip(c), r"^\|+|\|+$", ""), r"\|"), lambda x: X.strip(x))


def is_separator(c: Column) -> Column:
    return is_row(c) & F.forall(cells(c), lambda x: x.rlike(r"^:?-{3,}:?$"))


def separator(columns: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.greatest(F.lit(1), columns)), " | "), F.lit(" |"))


def rendered(rows: Column) -> Column:
    """An array of rows of cells as a table; short rows are padded."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), " | "), F.lit(" |"))
    return F.array_join(F.concat(F.array(line(F.get(rows, F.lit(0))), separator(width)), F.transform(F.slice(rows, F.lit(2), F.greatest(F.lit(0), F.size(rows) - 1)), line)), "\n")


def tables_of(lines: DataFrame, key: list[str]) -> DataFrame:
    """Runs of table rows: place, rows, columns, header, whether a separator follows it."""
    rows = lines.where(is_row(F.col("line")))
    run = rows.withColumn("run", F.col("line_no") - F.row_number().over(Window.partitionBy(*key).orderBy("line_no")))
    second = F.get(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), F.lit(1))
    g = run.groupBy(*key, "run").agg(F.min("line_no").alias("line_start"), F.count("*").alias("rows"), F.max(F.size(cells(F.col("line")))).alias("columns"), F.min_by("line", "line_no").alias("header"), second.alias("second"))
    return g.select(*key, "line_start", "rows", "columns", X.strip(F.col("header")).alias("header"), F.coalesce(is_separator(F.col("second")), F.lit(False)).alias("has_separator"))


def restarts(lines: DataFrame, key: list[str]) -> DataFrame:
    """Rows that repeat a header seen before in the same text and lack a separator below."""
    d = lines.where(is_row(F.col("line"))).withColumn("s", X.strip(F.col("line")))
    w = Window.partitionBy(*key).orderBy("line_no")
    d = d.withColumns({"next_no": F.lead("line_no").over(w), "next": F.lead("s").over(w)})
    below = F.coalesce((F.col("next_no") == F.col("line_no") + 1) & is_separator(F.col("next")), F.lit(False))
    head = d.where(below).groupBy(*key, "s").agg(F.min("line_no").alias("first_no"))
    return d.where(~below).join(head, [*key, "s"]).where("line_no > first_no").select(*key, "line_no", F.col("s").alias("row"))


def toc_rows(lines: DataFrame, key: list[str]) -> DataFrame:
    """Rows of a table of contents: ordinal, title and page."""
    s = X.strip(F.col("line"))
    d = lines.where(s.rlike(TOC_ROW)).select(*key, "line_no", F.nullif(F.regexp_extract(s, TOC_ROW, 1), F.lit("")).alias("ordinal"), X.strip(F.regexp_replace(F.regexp_extract(s, TOC_ROW, 2), r"[.\s]+$", "")).alias("title"), F.regexp_extract(s, TOC_ROW, 3).alias("page"))
    return d.where("title <> ''")


def _lines(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    p = latest(table(spark, sf_dir, "pages"))
    return numbered_lines(p if kind is None else p.where(F.col("page_type") == kind), ["extraction_id"], F.col("text"))


def q_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables_of(_lines(spark, sf_dir), ["extraction_id"])


def q_restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chapters")
    return restarts(numbered_lines(c, ["chapter_id"], F.col("body")), ["chapter_id"])


def q_toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toc_rows(_lines(spark, sf_dir, "toc"), ["extraction_id"])


def q_toc_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents pages rendered as markdown tables."""
    r = toc_rows(_lines(spark, sf_dir, "toc"), ["extraction_id"])
    row = F.struct("line_no", F.array(F.coalesce("ordinal", F.lit("")), "title", "page").alias("r"))
    g = r.groupBy("extraction_id").agg(F.array_sort(F.collect_list(row)).alias("rows")).where("size(rows) >= 3")
    head = F.array(F.array(F.lit("No."), F.lit("Title"), F.lit("Page")))
    return g.select("extraction_id", F.size("rows").alias("entries"), rendered(F.concat(head, F.transform("rows", lambda x: x["r"]))).alias("markdown"))


def q_toc_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents entries beside the chapter of that title in the book (equal keys)."""
    p = latest(table(spark, sf_dir, "pages")).where("page_type = 'toc'").select("extraction_id", "book_id")
    t = toc_rows(_lines(spark, sf_dir, "toc"), ["extraction_id"]).join(p, "extraction_id").select("extraction_id", "book_id", "line_no", X.simple(F.col("title")).alias("key"))
    bare = F.regexp_replace(X.text("title"), r"(?i)^\s*chapter\s+[ivxlcdm\d]+\s*[.:—–-]*\s*", "")
    c = table(spark, sf_dir, "chapters").select("book_id", "chapter_id", X.simple(bare).alias("key")).where("key <> ''")
    return t.join(c, ["book_id", "key"], "left").groupBy("extraction_id", "line_no").agg(F.count("chapter_id").alias("chapters"))


QUERIES = {"page_tables": q_tables, "table_header_restarts": q_restarts, "toc_rows": q_toc, "toc_tables": q_toc_tables, "toc_targets": q_toc_targets}

_S = strip("line")
_ROW = f"(starts_with({_S}, '|') AND ends_with({_S}, '|') AND length({_S}) >= 2)"


def _cells(x: str) -> str:
    return f"list_transform(string_split({rep(strip(x), '^[|]+|[|]+$')}, '|'), lambda y: {strip('y')})"


def _sep(x: str) -> str:
    return f"(starts_with({strip(x)}, '|') AND ends_with({strip(x)}, '|') AND length({strip(x)}) >= 2 AND len(list_filter({_cells(x)}, lambda z: NOT regexp_full_match(z, ':?-{{3,}}:?'))) = 0)"


_TOC = f"""toc AS (SELECT * FROM (SELECT extraction_id, book_id, line_no, nullif(regexp_extract({_S}, '{TOC_ROW}', 1), '') AS ordinal, {strip(rep(f"regexp_extract({_S}, '{TOC_ROW}', 2)", '[.\\s]+$'))} AS title, regexp_extract({_S}, '{TOC_ROW}', 3) AS page
    FROM lines JOIN (SELECT extraction_id FROM current WHERE page_type = 'toc') USING (extraction_id) WHERE {has(_S, TOC_ROW)}) WHERE title <> '')"""
SQL = {
    "page_tables": f"""WITH {CURRENT}, {LINES}, r AS (SELECT extraction_id, line_no, line, line_no - row_number() OVER (PARTITION BY extraction_id ORDER BY line_no) AS run FROM lines WHERE {_ROW}),
        g AS (SELECT extraction_id, run, min(line_no) AS line_start, count(*) AS rows, max(len({_cells('line')})) AS columns, arg_min(line, line_no) AS header, list(line ORDER BY line_no)[2] AS second FROM r GROUP BY ALL)
        SELECT extraction_id, line_start::INTEGER AS line_start, rows, columns::INTEGER AS columns, {strip('header')} AS header, coalesce({_sep('second')}, false) AS has_separator FROM g""",
    "table_header_restarts": f"""WITH clines AS (SELECT chapter_id, unnest(string_split(coalesce(body, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(body, ''), chr(10)), 1) AS line_no FROM chapters),
        d AS (SELECT chapter_id, line_no, {_S} AS s, lead(line_no) OVER w AS next_no, lead({_S}) OVER w AS nx FROM clines WHERE {_ROW} WINDOW w AS (PARTITION BY chapter_id ORDER BY line_no)),
        e AS (SELECT *, coalesce(next_no = line_no + 1 AND {_sep('nx')}, false) AS below FROM d), h AS (SELECT chapter_id, s, min(line_no) AS first_no FROM e WHERE below GROUP BY ALL)
        SELECT e.chapter_id, e.line_no::INTEGER AS line_no, e.s AS row FROM e JOIN h ON e.chapter_id = h.chapter_id AND e.s = h.s WHERE NOT below AND line_no > first_no""",
    "toc_rows": f"WITH {CURRENT}, {LINES}, {_TOC} SELECT extraction_id, line_no::INTEGER AS line_no, ordinal, title, page FROM toc",
    "toc_tables": f"""WITH {CURRENT}, {LINES}, {_TOC} SELECT extraction_id, count(*)::INTEGER AS entries, '| No. | Title | Page |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || coalesce(ordinal, '') || ' | ' || title || ' | ' || page || ' |', chr(10) ORDER BY line_no) AS markdown
        FROM toc GROUP BY extraction_id HAVING count(*) >= 3""",
}
