"""Running margins: lines that recur at the top or bottom of a book's pages, and their removal."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.duck import footnote_def, margin_key, page_number, strip, words
from quire.operators.pages import KINDS, page_kind
from quire.sources.tables import latest, table

#: Lines at either edge that count, and the kinds of page that have margins.
EDGE, KINDS_WITH = 2, ("text", "chapter_start", "backmatter")


def _edge_lines(full: Column) -> Column:
    """Array of (edge, line) of the first and last EDGE lines; they may overlap."""
    top = F.transform(F.slice(full, 1, EDGE), lambda x: F.struct(F.lit("top").alias("edge"), x.alias("line")))
    tail = F.slice(full, F.greatest(F.lit(1), F.size(full) - EDGE + 1), F.least(F.lit(EDGE), F.size(full)))
    low = F.transform(tail, lambda x: F.struct(F.lit("bottom").alias("edge"), x.alias("line")))
    return F.concat(top, F.when(F.size(full) > 0, low).otherwise(F.array().cast("array<struct<edge:string,line:string>>")))


def with_margins(pages: DataFrame) -> DataFrame:
    """Pages that take part: ``book_id, page_number, text`` of margin-bearing kinds with text."""
    return pages.where(X.strip(X.text("text")) != "").select("book_id", "page_number", "extraction_id", X.text("text").alias("text"), page_kind(pages).alias("kind")).where(F.col("kind").isin(*KINDS_WITH))


def detect(pages: DataFrame) -> DataFrame:
    """``book_id, edge, key, times`` of running margins.

    ``pages`` comes from ``with_margins``.  A key counts each time it stands at
    an edge; needed are 2 times in a book of up to 30 pages, else
    max(3, 12 % of the pages), and a book of two pages at least.
    """
    lines = pages.select("book_id", F.explode(_edge_lines(X.full_lines(F.col("text")))).alias("e")).select("book_id", "e.*").where(X.is_margin_line(F.col("line")))
    counts = lines.groupBy("book_id", "edge", X.margin_key(F.col("line")).alias("key")).agg(F.count("*").alias("times")).where("key <> ''")
    n = pages.groupBy("book_id").agg(F.count("*").alias("n"))
    need = F.when(F.col("n") <= 30, 2).otherwise(F.greatest(F.lit(3), F.floor(F.col("n") * 12 / 100).cast("int")))
    return counts.join(n.where("n >= 2").select("book_id", need.alias("need")), "book_id").where("times >= need").select("book_id", "edge", "key", "times")


def strip_margins(pages: DataFrame, margins: DataFrame) -> DataFrame:
    """Pages with margin and page-number lines at their edges blanked; line count stays.

    The bottom is looked at after the top was blanked.  The margins of a book
    are few: at most 2 * EDGE / 0.12 keys an edge, so they travel as arrays.
    """
    per = margins.groupBy("book_id").agg(F.collect_set(F.when(F.col("edge") == "top", F.col("key"))).alias("tops"), F.collect_set(F.when(F.col("edge") == "bottom", F.col("key"))).alias("lows"))
    none = F.array().cast("array<string>")

    def blanked(lines: Column, keys: Column, positions: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            s, k = X.strip(x), X.margin_key(x)
            gone = ~X.is_footnote_def(s) & (X.is_page_number(s) | ((k != "#") & (k != "") & F.array_contains(F.coalesce(keys, none), k)))
            return F.when(F.array_contains(positions, i) & gone, "").otherwise(x)

        return F.transform(lines, one)

    def at(lines: Column) -> Column:
        return F.filter(F.transform(lines, lambda x, i: F.when(X.strip(x) != "", i)), lambda i: i.isNotNull())

    d = pages.join(per, "book_id", "left").withColumn("ls", X.lines(F.col("text")))
    d = d.withColumn("pos", at(F.col("ls"))).withColumn("ls", blanked(F.col("ls"), F.col("tops"), F.slice("pos", 1, EDGE)))
    d = d.withColumn("pos", at(F.col("ls")))
    tail = F.slice("pos", F.greatest(F.lit(1), F.size("pos") - EDGE + 1), F.greatest(F.lit(1), F.least(F.lit(EDGE), F.size("pos"))))
    d = d.withColumn("ls", blanked(F.col("ls"), F.col("lows"), tail))
    return d.withColumn("text", F.array_join("ls", "\n")).drop("ls", "pos", "tops", "lows")


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept on the executors' disks, as lines and sizes are counted apart."""
    return with_margins(latest(table(spark, sf_dir, "pages"))).persist(StorageLevel.DISK_ONLY)


def q_running_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(_marked(spark, sf_dir))


def q_stripped_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _marked(spark, sf_dir)
    out = strip_margins(p, detect(p))
    return out.select("extraction_id", F.sha1("text").alias("text_sha1"), F.size(X.full_lines(F.col("text"))).alias("lines_left"))


QUERIES = {"running_margins": q_running_margins, "stripped_margins": q_stripped_margins}

_PROBABLE = f"({strip('line')} <> '' AND length({strip('line')}) <= 80 AND NOT {footnote_def(strip('line'))} AND {words(strip('line'))} <= 12)"
_DETECT = f"""{KINDS}, p AS (SELECT book_id, page_number, extraction_id, text FROM kinds WHERE {strip("coalesce(text, '')")} <> '' AND kind IN {KINDS_WITH}),
    full_lines AS (SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}), lambda x: x <> '') AS ls FROM p),
    edges AS (SELECT book_id, 'top' AS edge, unnest(ls[1:2]) AS line FROM full_lines UNION ALL SELECT book_id, 'bottom', unnest(ls[greatest(1, len(ls) - 1):len(ls)]) FROM full_lines),
    counts AS (SELECT book_id, edge, {margin_key('line')} AS key, count(*) AS times FROM edges WHERE {_PROBABLE} GROUP BY ALL),
    sizes AS (SELECT book_id, count(*) AS n FROM p GROUP BY book_id),
    margins AS (SELECT book_id, edge, key, times FROM counts JOIN sizes USING (book_id) WHERE key <> '' AND n >= 2 AND times >= CASE WHEN n <= 30 THEN 2 ELSE greatest(3, n * 12 // 100) END)"""
_GONE = f"(NOT {footnote_def('s')} AND ({page_number('s')} OR (key <> '#' AND key <> '' AND hit)))"
#: ``stripped``: extraction_id and text without margins, of the pages that have any.
STRIPPED = f"""l AS (SELECT extraction_id, book_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM p),
        k AS (SELECT *, {strip('line')} AS s, {margin_key('line')} AS key FROM l),
        t AS (SELECT k.*, sum(CASE WHEN s <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY extraction_id ORDER BY n) AS pos, m.key IS NOT NULL AS hit FROM k LEFT JOIN margins m ON m.edge = 'top' AND m.book_id = k.book_id AND m.key = k.key),
        u AS (SELECT * EXCLUDE (line, s, hit, pos), CASE WHEN s <> '' AND pos <= 2 AND {_GONE} THEN '' ELSE line END AS line FROM t),
        v AS (SELECT u.*, {strip('u.line')} AS s, m.key IS NOT NULL AS hit FROM u LEFT JOIN margins m ON m.edge = 'bottom' AND m.book_id = u.book_id AND m.key = u.key),
        w AS (SELECT *, sum(CASE WHEN s <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY extraction_id ORDER BY n DESC) AS pos FROM v),
        x AS (SELECT extraction_id, n, CASE WHEN s <> '' AND pos <= 2 AND {_GONE} THEN '' ELSE line END AS line FROM w),
        stripped AS (SELECT extraction_id, string_agg(line, chr(10) ORDER BY n) AS text FROM x GROUP BY extraction_id)"""
SQL = {
    "running_margins": f"WITH {_DETECT} SELECT * FROM margins",
    "stripped_margins": f"WITH {_DETECT}, {STRIPPED} SELECT extraction_id, sha1(text) AS text_sha1, (len(list_filter(string_split(text, chr(10)), lambda line: {strip('line')} <> '')))::INTEGER AS lines_left FROM stripped",
}
