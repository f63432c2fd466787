"""Structural maps of source and output, blocks, and the difference report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.duck import CURRENT, LINES, has, header_combo, header_with_number, line_class, loose, page_number, strip, title_kind, words
from quire.operators.pages import script_profile
from quire.sources.tables import latest, table

SEVERITY = ("critical", "high", "medium", "low")
#: Issues of a whole book: name, severity, condition over its totals (SQL that both engines read).
BOOK_RULES = (
    ("footnote_count_mismatch_reader_vs_source", "high", "out_notes <> notes"),
    ("footnote_count_mismatch_archival_vs_source", "high", "archival_notes <> notes"),
    ("indic_script_loss_reader", "critical", "indic_chars > 0 and out_indic < indic_chars"),
    ("indic_script_loss_archival", "critical", "indic_chars > 0 and archival_indic < indic_chars"),
    ("quote_formatting_missed", "low", "quotes >= 5 and quoted_blocks = 0"),
)
#: Who repairs an issue that no fixed rule can.
MANUAL, BY_MODEL = ("indic_script_loss_reader", "indic_script_loss_archival"), ("quote_formatting_missed",)


def numbered_lines(df: DataFrame, key: list[str], text: Column) -> DataFrame:
    """``key, line_no, line`` with line_no from 1."""
    return df.select(*key, F.posexplode(X.lines(X.text(text))).alias("pos", "line")).select(*key, (F.col("pos") + 1).alias("line_no"), "line")


def blocks(df: DataFrame, key: list[str], text: Column) -> DataFrame:
    """Runs of lines that are not blank, with type, span, sizes and hash.

    A run starts at a full line below a blank one and ends above the next; both
    are found in the array of lines, so nothing is shuffled.  A run of table rows
    only is a table, of quoted lines only a blockquote; else its first line decides.
    """
    d = df.select(*key, X.lines(X.text(text)).alias("ls")).withColumn("full", F.transform("ls", lambda x: X.strip(x) != ""))
    beside = lambda i, by: F.coalesce(F.get("full", i + by), F.lit(False))
    edge = lambda by: F.filter(F.transform("full", lambda x, i: F.when(x & ~beside(i, by), i + 1)), lambda i: i.isNotNull())
    d = d.select(*key, "ls", F.explode(F.arrays_zip(edge(-1).alias("a"), edge(1).alias("b"))).alias("run"))
    d = d.select(*key, F.col("run.a").alias("line_start"), F.col("run.b").alias("line_end"), F.slice("ls", F.col("run.a"), F.col("run.b") - F.col("run.a") + 1).alias("part"))
    d = d.withColumns({"text": F.array_join("part", "\n"), "first": X.line_class(F.get("part", F.lit(0)))})
    kind = (
        F.when(F.forall("part", lambda x: X.strip(x).startswith("|")), "table").when(F.forall("part", lambda x: X.strip(x).startswith(">")), "blockquote").when(F.col("first") == "footnote_def", "footnote_block")
        .when(F.col("first").isin("chapter_heading", "title_heading", "heading", "chapterish_label"), "heading_block")
        .when(F.col("first").isin("page_number", "running_header_with_page", "scan_noise"), "artifact_candidate").otherwise("prose_block")
    )
    return d.select(*key, kind.alias("type"), "line_start", "line_end", F.size("part").cast("long").alias("line_count"), F.length("text").alias("char_count"), F.sha1("text").alias("sha1"), "text")


def page_ranges(df: DataFrame, key: list[str], page: str = "page_number") -> DataFrame:
    """Pages of each key as ranges, "1-3, 5"."""
    d = df.where(F.col(page).isNotNull()).select(*key, page).distinct()
    d = d.withColumn("run", F.col(page) - F.row_number().over(Window.partitionBy(*key).orderBy(page)))
    r = d.groupBy(*key, "run").agg(F.min(page).alias("a"), F.max(page).alias("b"))
    one = F.struct("a", F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat(F.col("a").cast("string"), F.lit("-"), F.col("b").cast("string"))).alias("s"))
    return r.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]), ", ").alias("ranges"))


def is_artifact(c: Column) -> Column:
    return X.is_page_number(c) | X.is_header_with_number(c) | X.is_header_combo(c) | X.strip(c).rlike(X.SCAN_NOISE)


def edges(pages: DataFrame) -> DataFrame:
    """Top and bottom three full lines of each page and how many of the top ones are artifacts."""
    full = X.full_lines(X.text("text"))
    d = pages.select("extraction_id", "book_id", "page_number", "page_type", F.slice(full, 1, 3).alias("top"), F.when(F.size(full) > 0, F.slice(full, F.greatest(F.lit(1), F.size(full) - 2), F.lit(3))).otherwise(full).alias("bottom"))
    t = d.select("extraction_id", F.explode("top").alias("line")).groupBy("extraction_id").agg(F.count_if(is_artifact(F.col("line"))).alias("artifacts"))
    return d.join(t, "extraction_id", "left").withColumn("artifacts", F.coalesce("artifacts", F.lit(0)))


def source_totals(pages: DataFrame) -> DataFrame:
    """Totals of a source map, per book."""
    prof = script_profile(F.col("text"))
    d = pages.select("book_id", "page_type", *prof, X.words(X.text("text")).alias("w"))
    return d.groupBy("book_id").agg(F.count("*").alias("pages"), F.count_if(F.col("page_type") == "blank").alias("blank_pages"), F.sum("indic_chars").alias("indic_chars"), F.sum("non_ascii_chars").alias("non_ascii_chars"), F.sum("w").alias("words"))


def output_sections(markdown: DataFrame, key: list[str], text: Column) -> DataFrame:
    """Sections of an output: "## " starts one; what stands before the first is dropped.

    ``key, section, title, line_start, line_end, words``.
    """
    lines = numbered_lines(markdown, key, text)
    w = Window.partitionBy(*key).orderBy("line_no")
    d = lines.withColumn("section", F.sum(F.col("line").startswith("## ").cast("int")).over(w)).where("section > 0")
    return d.groupBy(*key, "section").agg(
        X.strip(F.substring(F.min_by("line", "line_no"), 4, 2**30)).alias("title"), F.min("line_no").alias("line_start"), F.max("line_no").alias("line_end"),
        F.sum(F.when(F.col("line").startswith("## "), 0).otherwise(X.words(F.col("line")))).alias("words"),
    )


def title_issues(chapters: DataFrame) -> DataFrame:
    """Repeated titles (from the second on) and tiny chapters, by book."""
    t = X.loose(X.text("title"))
    w = Window.partitionBy("book_id", "t").orderBy("number", "chapter_id")
    order = Window.partitionBy("book_id").orderBy("number", "chapter_id")
    d = chapters.select("book_id", "chapter_id", "number", "title", t.alias("t"), X.words(X.text("body")).alias("w")).withColumns({"k": F.row_number().over(w), "i": F.row_number().over(order)})
    again = d.where("t <> '' and k > 1").select("book_id", "chapter_id", F.lit("duplicate_chapter_title").alias("issue"), F.lit("high").alias("severity"))
    tiny = d.where((F.col("w") > 0) & (F.col("w") < 120) & (F.col("i") > 1) & ~X.text("title").rlike(r"(?i)^(?:book|part)\b")).select("book_id", "chapter_id", F.lit("tiny_chapter_segment").alias("issue"), F.lit("medium").alias("severity"))
    return again.unionByName(tiny)


def leak_issues(chapters: DataFrame) -> DataFrame:
    """Page numbers, running headers and scan noise in the lines of chapter bodies."""
    lines = numbered_lines(chapters, ["book_id", "chapter_id", "title"], F.col("body")).withColumn("s", X.strip(F.col("line"))).where("s <> '' and not (startswith(s, '#') or startswith(s, '|') or startswith(s, '>'))")
    t, s = X.loose(X.text("title")), F.col("s")
    front, index = t == "front matter", t.startswith("index ")
    toc = s.rlike(r"(?i)^(?:book|part|chapter)\b|^(?:introduction|conclusion)\.?$|^[ivxlcdm]+\.\s+|^(?:page|contents)\.?$")
    number = X.is_page_number(s)
    skip = (front & (toc | s.rlike(r"^(?:1[5-9]\d{2}|20\d{2})$"))) | (index & number)
    issue = F.when(number, "reader_page_number_leak").when(X.is_header_with_number(s) | X.is_header_combo(s), "reader_running_header_leak").when(s.rlike(X.SCAN_NOISE), "reader_scan_noise_leak")
    d = lines.where(~skip).select("book_id", "chapter_id", "line_no", issue.alias("issue")).where("issue is not null")
    return d.withColumn("severity", F.when(F.col("issue") == "reader_running_header_leak", "high").otherwise("medium"))


def output_totals(chapters: DataFrame) -> DataFrame:
    """Per book, of chapters assembled twice once: Indic letters, notes and quoted blocks of the output."""
    one = chapters.groupBy("book_id", "number").agg(F.max_by(F.struct("body", "footnotes"), "chapter_id").alias("c")).select("book_id", "c.*")
    quoted = F.filter(F.split(X.text("body"), r"\n\s*\n"), lambda b: (X.strip(b) != "") & ~F.exists(X.full_lines(b), lambda x: ~x.startswith(">")))
    d = one.select("book_id", X.count_matches(X.text("body"), X.INDIC).alias("i"), F.coalesce(F.size("footnotes"), F.lit(0)).alias("n"), F.size(quoted).alias("q"))
    return d.groupBy("book_id").agg(F.sum("i").alias("out_indic"), F.sum("n").alias("out_notes"), F.sum("q").alias("quoted_blocks"))


def archival_totals(pages: DataFrame) -> DataFrame:
    """The same of an archival output, which keeps the pages' text as it is: by the raw text."""
    t = X.text("raw_text")
    return pages.groupBy("book_id").agg(F.sum(X.count_matches(t, X.INDIC)).alias("archival_indic"), F.sum(_notes(t)).alias("archival_notes"))


def _notes(t: Column) -> Column:
    return F.size(F.filter(X.full_lines(t), lambda x: x.rlike(r"^\[\^[^\]]+\](?::|\s)")))


def book_issues(pages: DataFrame, chapters: DataFrame) -> DataFrame:
    """Differences of a book's totals: notes and Indic letters lost in either output, quotations that stand in no quoted block.

    A book without any chapter has lost all it had.
    """
    leading = F.size(F.filter(X.full_lines(X.text("text")), lambda x: x.rlike("^[\"'“‘]")))
    src = pages.groupBy("book_id").agg(F.sum(X.count_matches(X.text("text"), X.INDIC)).alias("indic_chars"), F.sum(_notes(X.text("text"))).alias("notes"), F.sum(leading).alias("quotes"))
    d = src.join(output_totals(chapters), "book_id", "left").join(archival_totals(pages), "book_id", "left").na.fill(0, ["out_indic", "out_notes", "quoted_blocks", "archival_indic", "archival_notes"])
    rules = [(name, severity, F.expr(cond)) for name, severity, cond in BOOK_RULES]
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("issue"), F.lit(v).alias("severity"))) for n, v, c in rules]))
    return d.select("book_id", F.explode(found).alias("e")).select("book_id", "e.*")


def difference(pages: DataFrame, chapters: DataFrame) -> DataFrame:
    """Issues per book, with all severities and repair classes counted, zeros kept."""
    risk = edges(pages).where("artifacts >= 2 and page_type in ('text', 'frontmatter', 'backmatter')").select("book_id", F.lit("high_header_leak_risk_page").alias("issue"), F.lit("low").alias("severity"))
    parts = [title_issues(chapters), leak_issues(chapters), book_issues(pages, chapters), risk]
    all_ = parts[0].select("book_id", "issue", "severity")
    for p in parts[1:]:
        all_ = all_.unionByName(p.select("book_id", "issue", "severity"))
    counts = [F.count_if(F.col("severity") == s).alias(s) for s in SEVERITY]
    return all_.groupBy("book_id").agg(F.count("*").alias("issues"), *counts, F.count_if(F.col("issue").isin(*MANUAL)).alias("manual_review"), F.count_if(F.col("issue").isin(*BY_MODEL)).alias("by_model"), F.count_distinct("issue").alias("kinds"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(table(spark, sf_dir, "pages"))


def q_page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(_pages(spark, sf_dir), ["extraction_id"], F.col("text")).drop("text")


def q_chapter_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of each type in each chapter."""
    b = blocks(table(spark, sf_dir, "chapters"), ["chapter_id"], F.col("body"))
    return b.groupBy("chapter_id", "type").agg(F.count("*").alias("blocks"), F.sum("line_count").alias("lines"), F.sum("char_count").alias("chars"))


def q_source_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_totals(_pages(spark, sf_dir))


def q_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = edges(_pages(spark, sf_dir))
    return e.select("extraction_id", F.array_join("top", "\n").alias("top"), F.array_join("bottom", "\n").alias("bottom"), "artifacts")


def q_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chapters")
    md = F.concat(F.lit("## "), X.text("title"), F.lit("\n\n"), X.text("body"))
    return output_sections(c.select("chapter_id", md.alias("md")), ["chapter_id"], F.col("md"))


def q_blank_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_ranges(_pages(spark, sf_dir).where("page_type = 'blank'"), ["book_id"])


def q_title_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return title_issues(table(spark, sf_dir, "chapters"))


def q_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_issues(table(spark, sf_dir, "chapters"))


def q_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return difference(_pages(spark, sf_dir), table(spark, sf_dir, "chapters"))


QUERIES = {
    "page_blocks": q_page_blocks, "chapter_blocks": q_chapter_blocks, "source_totals": q_source_totals, "page_edges": q_edges, "output_sections": q_sections, "blank_page_ranges": q_blank_ranges,
    "title_issues": q_title_issues, "reader_leaks": q_leaks, "structural_difference": q_difference,
}


def _blocks_sql(key: str, source: str) -> str:
    return f"""full_lines AS (SELECT *, line_no - row_number() OVER (PARTITION BY {key} ORDER BY line_no) AS run FROM {source} WHERE {strip('line')} <> ''),
    g AS (SELECT {key}, run, min(line_no) AS line_start, max(line_no) AS line_end, count(*) AS line_count, string_agg(line, chr(10) ORDER BY line_no) AS text,
        bool_and(starts_with({strip('line')}, '|')) AS rows_, bool_and(starts_with({strip('line')}, '>')) AS quoted, arg_min(line, line_no) AS head FROM full_lines GROUP BY {key}, run),
    h AS (SELECT *, {line_class('head')} AS first_class FROM g),
    blocks AS (SELECT {key}, CASE WHEN rows_ THEN 'table' WHEN quoted THEN 'blockquote' WHEN first_class = 'footnote_def' THEN 'footnote_block' WHEN first_class IN ('chapter_heading', 'title_heading', 'heading', 'chapterish_label') THEN 'heading_block'
        WHEN first_class IN ('page_number', 'running_header_with_page', 'scan_noise') THEN 'artifact_candidate' ELSE 'prose_block' END AS type, line_start::INTEGER AS line_start, line_end::INTEGER AS line_end, line_count, length(text)::INTEGER AS char_count, sha1(text) AS sha1 FROM h)"""


_T, _B = "coalesce(text, '')", "coalesce(body, '')"
_CLINES = f"clines AS (SELECT book_id, chapter_id, number, title, unnest(string_split({_B}, chr(10))) AS line, generate_subscripts(string_split({_B}, chr(10)), 1) AS line_no FROM chapters)"
_FULL = f"list_filter(list_transform(string_split({_T}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
_ARTIFACT = f"({page_number('line')} OR {header_with_number('line')} OR {header_combo('line')} OR {has('line', X.SCAN_NOISE)})"
_NON = "length(regexp_replace(@, '[\\x00-\\x7F]', '', 'g'))"
_IND = "length(regexp_replace(@, '[^" + X.INDIC[1:] + "', '', 'g'))"
_TITLES = f"""tw AS (SELECT book_id, chapter_id, number, title, {loose("coalesce(title, '')")} AS t, {words(_B)} AS w FROM chapters), tk AS (SELECT *, row_number() OVER (PARTITION BY book_id, t ORDER BY number, chapter_id) AS k, row_number() OVER (PARTITION BY book_id ORDER BY number, chapter_id) AS i FROM tw),
    title_issues AS (SELECT book_id, chapter_id, 'duplicate_chapter_title' AS issue, 'high' AS severity FROM tk WHERE t <> '' AND k > 1 UNION ALL SELECT book_id, chapter_id, 'tiny_chapter_segment', 'medium' FROM tk WHERE w > 0 AND w < 120 AND i > 1 AND NOT {has("coalesce(title, '')", '(?i)^(?:book|part)\\b')})"""
_TOC = r"(?i)^(?:book|part|chapter)\b|^(?:introduction|conclusion)\.?$|^[ivxlcdm]+\.\s+|^(?:page|contents)\.?$"
_LEAKS = f"""{_CLINES}, ls AS (SELECT *, {strip('line')} AS s, {loose("coalesce(title, '')")} AS t FROM clines), lf AS (SELECT * FROM ls WHERE s <> '' AND NOT (starts_with(s, '#') OR starts_with(s, '|') OR starts_with(s, '>'))
        AND NOT ((t = 'front matter' AND ({has('s', _TOC)} OR {has('s', '^(?:1[5-9][0-9]{2}|20[0-9]{2})$')})) OR (starts_with(t, 'index ') AND {page_number('s')}))),
    li AS (SELECT book_id, chapter_id, line_no::INTEGER AS line_no, CASE WHEN {page_number('s')} THEN 'reader_page_number_leak' WHEN {header_with_number('s')} OR {header_combo('s')} THEN 'reader_running_header_leak' WHEN {has('s', X.SCAN_NOISE)} THEN 'reader_scan_noise_leak' END AS issue FROM lf),
    leaks AS (SELECT *, CASE WHEN issue = 'reader_running_header_leak' THEN 'high' ELSE 'medium' END AS severity FROM li WHERE issue IS NOT NULL)"""
_TOTALS = f"totals AS (SELECT book_id, count(*) AS pages, count(*) FILTER (WHERE page_type = 'blank') AS blank_pages, sum({_IND.replace("@", _T)})::BIGINT AS indic_chars, sum({_NON.replace("@", _T)})::BIGINT AS non_ascii_chars, sum({words(_T)})::BIGINT AS words FROM current GROUP BY book_id)"
_EDGES = f"""e0 AS (SELECT extraction_id, book_id, page_type, {_FULL} AS ls FROM current), e1 AS (SELECT extraction_id, unnest(ls[1:3]) AS line FROM e0), ea AS (SELECT extraction_id, count(*) FILTER (WHERE {_ARTIFACT}) AS artifacts FROM e1 GROUP BY extraction_id),
    edges AS (SELECT e0.extraction_id, book_id, page_type, array_to_string(ls[1:3], chr(10)) AS top, array_to_string(ls[greatest(1, len(ls) - 2):len(ls)], chr(10)) AS bottom, coalesce(artifacts, 0) AS artifacts FROM e0 LEFT JOIN ea USING (extraction_id))"""
_RFULL = f"list_filter(list_transform(string_split(@, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
_NOTES = f"len(list_filter({_RFULL}, lambda x: {has('x', '^' + chr(92) + '[' + chr(92) + '^[^' + chr(92) + ']]+' + chr(92) + '](?::|' + chr(92) + 's)')}))"
_RAW = "coalesce(raw_text, '')"
_QUOTED = f"len(list_filter(regexp_split_to_array({_B}, '\\n\\s*\\n'), lambda b: {strip('b')} <> '' AND len(list_filter({_RFULL.replace('@', 'b')}, lambda x: NOT starts_with(x, '>'))) = 0))"
_BOOKS = f"""bs AS (SELECT book_id, sum({_IND.replace("@", _T)}) AS indic_chars, sum({_NOTES.replace("@", _T)}) AS notes, sum(len(list_filter({_RFULL.replace("@", _T)}, lambda x: {has('x', '^["' + chr(39) + '“‘]')}))) AS quotes,
        sum({_IND.replace("@", _RAW)}) AS archival_indic, sum({_NOTES.replace("@", _RAW)}) AS archival_notes FROM current GROUP BY book_id),
    bo AS (SELECT book_id, sum({_IND.replace("@", _B)}) AS out_indic, sum(coalesce(len(footnotes), 0)) AS out_notes, sum({_QUOTED}) AS quoted_blocks FROM (SELECT * FROM chapters QUALIFY row_number() OVER (PARTITION BY book_id, number ORDER BY chapter_id DESC) = 1) GROUP BY book_id),
    bt AS (SELECT bs.*, coalesce(out_indic, 0) AS out_indic, coalesce(out_notes, 0) AS out_notes, coalesce(quoted_blocks, 0) AS quoted_blocks FROM bs LEFT JOIN bo USING (book_id))"""
SQL = {
    "page_blocks": f"WITH {CURRENT}, {LINES}, {_blocks_sql('extraction_id', 'lines')} SELECT * FROM blocks",
    "chapter_blocks": f"WITH {_CLINES}, {_blocks_sql('chapter_id', 'clines')} SELECT chapter_id, type, count(*) AS blocks, sum(line_count)::BIGINT AS lines, sum(char_count)::BIGINT AS chars FROM blocks GROUP BY ALL",
    "source_totals": f"WITH {CURRENT}, {_TOTALS} SELECT * FROM totals",
    "page_edges": f"WITH {CURRENT}, {_EDGES} SELECT extraction_id, top, bottom, artifacts FROM edges",
    "output_sections": f"""WITH m AS (SELECT chapter_id, string_split('## ' || coalesce(title, '') || chr(10) || chr(10) || {_B}, chr(10)) AS ls FROM chapters), l AS (SELECT chapter_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM m),
        s AS (SELECT *, sum(CASE WHEN starts_with(line, '## ') THEN 1 ELSE 0 END) OVER (PARTITION BY chapter_id ORDER BY line_no) AS section FROM l)
        SELECT chapter_id, section::BIGINT AS section, {strip('substr(arg_min(line, line_no), 4)')} AS title, min(line_no)::INTEGER AS line_start, max(line_no)::INTEGER AS line_end, sum(CASE WHEN starts_with(line, '## ') THEN 0 ELSE {words('line')} END)::BIGINT AS words FROM s WHERE section > 0 GROUP BY chapter_id, section""",
    "blank_page_ranges": f"""WITH {CURRENT}, d AS (SELECT book_id, page_number, page_number - row_number() OVER (PARTITION BY book_id ORDER BY page_number) AS run FROM (SELECT DISTINCT book_id, page_number FROM current WHERE page_type = 'blank' AND page_number IS NOT NULL)),
        r AS (SELECT book_id, min(page_number) AS a, max(page_number) AS b FROM d GROUP BY book_id, run) SELECT book_id, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ', ' ORDER BY a) AS ranges FROM r GROUP BY book_id""",
    "title_issues": f"WITH {_TITLES} SELECT * FROM title_issues",
    "reader_leaks": f"WITH {_LEAKS} SELECT * FROM leaks",
    "structural_difference": f"""WITH {CURRENT}, {_TITLES}, {_LEAKS}, {_EDGES}, {_BOOKS},
        i AS (SELECT book_id, issue, severity FROM title_issues UNION ALL SELECT book_id, issue, severity FROM leaks UNION ALL {" UNION ALL ".join(f"SELECT book_id, '{n}', '{v}' FROM bt WHERE {c}" for n, v, c in BOOK_RULES)}
            UNION ALL SELECT book_id, 'high_header_leak_risk_page', 'low' FROM edges WHERE artifacts >= 2 AND page_type IN ('text', 'frontmatter', 'backmatter'))
        SELECT book_id, count(*) AS issues, {', '.join(f"count(*) FILTER (WHERE severity = '{s}') AS {s}" for s in SEVERITY)}, count(*) FILTER (WHERE issue IN {MANUAL}) AS manual_review, count(*) FILTER (WHERE issue = '{BY_MODEL[0]}') AS by_model, count(DISTINCT issue) AS kinds FROM i GROUP BY book_id""",
}
