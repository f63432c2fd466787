"""Footnotes: references and definitions, integrity, ids, and their repair."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.duck import q, strip
from quire.sources.tables import table

REF, DOLLAR_REF = X.FOOTNOTE_REF, r"\$\^\{?([A-Za-z0-9_*†‡§-]+)\}?\$"


def refs_of(body: Column) -> Column:
    """Ids referred to in a body, in order, with repetition."""
    return F.concat(F.regexp_extract_all(body, F.lit(REF), 1), F.regexp_extract_all(body, F.lit(DOLLAR_REF), 1))


def base_id(c: Column) -> Column:
    """An id without its page suffix: a-p12-2 -> a."""
    return F.regexp_replace(X.strip(X.text(c)), r"^(.*?)-p\d+(?:-\d+)?$", "$1")


def is_page_scoped(c: Column) -> Column:
    return X.strip(X.text(c)).rlike(r"-p\d+(?:-\d+)?$")


def marker_letter(c: Column) -> Column:
    """a, a-p12, c3-a -> a; null for others."""
    s = X.strip(X.text(c))
    m = F.regexp_extract(s, r"^(?:c\d+-)?([a-z])(?:-p\d+(?:-\d+)?|-\d+)?$", 1)
    return F.nullif(m, F.lit(""))


def sort_key(c: Column) -> list[Column]:
    """Numbers first by value, then the others in lower case."""
    s = X.strip(X.text(c))
    number = F.when(s.rlike(r"^\d+$"), s)
    return [number.isNull().cast("int"), number.cast("decimal(38,0)"), F.lower(s)]


def definitions(chapters: DataFrame) -> DataFrame:
    """``chapter_id, book_id, number, ord, id, text`` of the chapters' notes, in order."""
    d = chapters.select("chapter_id", "book_id", "number", F.posexplode("footnotes").alias("pos", "n"))
    return d.select("chapter_id", "book_id", "number", (F.col("pos") + 1).alias("ord"), F.col("n.id").alias("id"), F.col("n.text").alias("text"))


def integrity(chapters: DataFrame) -> DataFrame:
    """Per chapter: distinct refs and defs, orphaned refs, unreferenced and repeated defs."""
    ids = F.coalesce(F.transform("footnotes", lambda n: n["id"]), F.array().cast("array<string>"))
    ids = F.filter(ids, lambda x: x.isNotNull())
    d = chapters.select("chapter_id", F.array_distinct(refs_of(X.text("body"))).alias("refs"), ids.alias("all"), F.array_distinct(ids).alias("defs"))
    orphaned, unreferenced = F.array_sort(F.array_except("refs", "defs")), F.array_sort(F.array_except("defs", "refs"))
    d = d.select("*", orphaned.alias("orphaned"), unreferenced.alias("unreferenced"))
    return d.select(
        "chapter_id", F.size("refs").alias("refs"), F.size("defs").alias("defs"), F.array_join("orphaned", ",").alias("orphaned"), F.array_join("unreferenced", ",").alias("unreferenced"),
        (F.size("all") - F.size("defs")).alias("repeated_defs"), (F.size("orphaned") + F.size("unreferenced")).alias("mismatches"),
    )


def deduplicated(defs: DataFrame, key: list[str]) -> DataFrame:
    """First of the notes of one chapter with equal id and text."""
    w = Window.partitionBy(*key, "id", X.strip(X.text("text"))).orderBy("ord")
    return defs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def uniquified(defs: DataFrame) -> DataFrame:
    """Ids that occur twice or more in a book become c{chapter}-{id}[-k]; others stay.

    Counted per (book, id), numbered within (book, chapter, id), so no window
    holds more than the repetitions of one id in one chapter.
    """
    many = defs.groupBy("book_id", "id").agg(F.count("*").alias("n")).where("n > 1").select("book_id", "id", F.lit(True).alias("dup"))
    w = Window.partitionBy("book_id", "chapter", "id").orderBy("chapter_id", "ord")
    d = defs.withColumn("chapter", F.greatest(F.lit(1), F.coalesce("number", F.lit(0))))
    d = d.join(many, ["book_id", "id"], "left").withColumn("k", F.row_number().over(w))
    new = F.concat(F.lit("c"), F.col("chapter").cast("string"), F.lit("-"), F.col("id"), F.when(F.col("k") > 1, F.concat(F.lit("-"), F.col("k").cast("string"))).otherwise(""))
    return d.withColumn("new_id", F.when(F.col("dup"), new).otherwise(F.col("id"))).drop("dup", "k", "chapter")


def remapped(notes: DataFrame) -> DataFrame:
    """Page-scoped ids for notes whose id already stands for another text in the chapter.

    ``notes`` has book_id, chapter_number, page_number, ord, id, text.  The first
    text of an id keeps it, equal texts keep it too; another text becomes
    id-p{page}, and -2, -3 where a page has several.
    """
    t = F.regexp_replace(X.strip(X.text("text")), X.WS + "+", " ")
    w = Window.partitionBy("book_id", "chapter_number", "id").orderBy("page_number", "ord")
    d = notes.withColumn("t", t).withColumn("first_text", F.first("t").over(w)).withColumn("other", F.col("t") != F.col("first_text"))
    first_of = Window.partitionBy("book_id", "chapter_number", "id", "t").orderBy("page_number", "ord")
    d = d.withColumn("seen_page", F.first("page_number").over(first_of)).withColumn("rank_of_text", F.row_number().over(first_of))
    new = F.col("other") & (F.col("rank_of_text") == 1)
    k = F.sum(new.cast("int")).over(Window.partitionBy("book_id", "chapter_number", "id", "page_number").orderBy("ord"))
    d = d.withColumn("new", new).withColumn("k", k)
    scoped = F.concat("id", F.lit("-p"), F.col("page_number").cast("string"), F.when(F.col("k") > 1, F.concat(F.lit("-"), F.col("k").cast("string"))).otherwise(""))
    return d.withColumn("new_id", F.when(F.col("new"), scoped).otherwise(F.col("id"))).drop("t", "first_text", "other", "seen_page", "rank_of_text", "new", "k")


def reconciled(chapters: DataFrame) -> DataFrame:
    """Which spare plain reference goes to which unreferenced page-scoped note.

    Per chapter and base id with several notes: the k-th spare occurrence of
    [^base] in reading order (the first stays with a plain note) meets the k-th
    page-scoped note without reference, in definition order.
    """
    defs = definitions(chapters).where("id is not null").withColumn("base", base_id(F.col("id"))).withColumn("scoped", is_page_scoped(F.col("id")))
    refs = chapters.select("chapter_id", F.posexplode(F.regexp_extract_all(X.text("body"), F.lit(REF), 1)).alias("pos", "id"))
    used = refs.select("chapter_id", "id").distinct()
    several = defs.groupBy("chapter_id", "base").agg(F.count("*").alias("n"), F.max((~F.col("scoped")).cast("int")).alias("plain")).where("n > 1")
    missing = defs.where("scoped").join(used, ["chapter_id", "id"], "left_anti").join(several, ["chapter_id", "base"])
    missing = missing.withColumn("k", F.row_number().over(Window.partitionBy("chapter_id", "base").orderBy("ord"))).select("chapter_id", "base", "k", F.col("id").alias("target"))
    spare = refs.withColumnRenamed("id", "base").join(several, ["chapter_id", "base"])
    w = Window.partitionBy("chapter_id", "base").orderBy("pos")
    spare = spare.withColumn("occurrence", F.row_number().over(w)).withColumn("k", F.col("occurrence") - F.col("plain")).where("k > 0")
    return spare.join(missing, ["chapter_id", "base", "k"]).select("chapter_id", "base", "occurrence", "target")


def sibling_merge(chapters: DataFrame) -> DataFrame:
    """Unreferenced page-scoped notes and the nearest earlier note of their page that takes their text.

    A referenced sibling is preferred to an unreferenced one; an as-of join by
    ``last`` over the rows before, within one page of one chapter.
    """
    defs = definitions(chapters).where("id is not null").withColumn("page", F.nullif(F.regexp_extract("id", r"-p(\d+)(?:-\d+)?$", 1), F.lit(""))).where("page is not null")
    used = chapters.select("chapter_id", F.explode(F.array_distinct(refs_of(X.text("body")))).alias("id")).withColumn("used", F.lit(True))
    d = defs.join(used, ["chapter_id", "id"], "left").withColumn("used", F.coalesce("used", F.lit(False)))
    w = Window.partitionBy("chapter_id", "page").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    near = F.coalesce(F.last(F.when(F.col("used"), F.col("id")), ignorenulls=True).over(w), F.last("id").over(w))
    return d.withColumn("into", near).where("not used and into is not null").select("chapter_id", "id", "ord", "into")


# ── extraction of notes from the text of a page ──
_DEF_LINE = re.compile(r"^\[\^([^\]\s]+)\](?::\s*|\s+)(.*)$")
_DOLLAR_LINE = re.compile(r"^\$\^\{?([\w*†‡§-]+)\}?\$\s+(.*)$")
_SUPER_LINE = re.compile(r"^([⁰¹²³⁴⁵⁶⁷⁸⁹]+)\s+(.*)$")
_PACKED = re.compile(r"\s{2,}(?=\[\^[^\]]+\](?::|\s))")
_PLAIN_DIGITS = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789")
_WRAP = re.compile(r"^[>\s]+")


def parse_notes(text: str) -> tuple[str, list[tuple[str, str]]]:
    """(body, notes) of a page: definitions with their continuation lines leave the body.

    A definition goes on over the lines below it up to a blank line or the next
    definition; equal (id, text) count once.
    """
    body: list[str] = []
    notes: list[list[str]] = []
    open_note = False
    for line in (text or "").split("\n"):
        bare = _WRAP.sub("", line).strip()
        parts = _PACKED.split(bare) if bare.startswith("[^") else [bare]
        hits = [m for p in parts if (m := _DEF_LINE.match(p) or _DOLLAR_LINE.match(p) or _SUPER_LINE.match(p))]
        if hits and len(hits) == len(parts):
            notes += [[m[1].translate(_PLAIN_DIGITS), m[2].strip()] for m in hits]
            open_note = True
        elif open_note and bare:
            notes[-1][1] = f"{notes[-1][1]} {bare}".strip()
        else:
            open_note = False
            body.append(line)
    seen: dict[tuple[str, str], None] = {}
    for i, t in notes:
        seen.setdefault((i, t))
    return "\n".join(body).rstrip("\n"), list(seen)


def extracted(pages: DataFrame) -> DataFrame:
    """``extraction_id, ord, id, text`` of the notes at the pages' feet."""

    @F.pandas_udf("array<struct<id:string,text:string>>")
    def notes(t: pd.Series) -> pd.Series:
        return t.map(lambda x: [{"id": i, "text": s} for i, s in parse_notes(x)[1]])

    # a page without a mark at the start of a line has no note: it never leaves the JVM
    maybe = pages.where(X.text("text").rlike(r"(?m)^[>\s]*(?:\[\^|\$\^|[⁰¹²³⁴⁵⁶⁷⁸⁹])"))
    d = maybe.select("extraction_id", F.posexplode(notes(X.text("text"))).alias("pos", "n"))
    return d.select("extraction_id", (F.col("pos") + 1).alias("ord"), "n.id", "n.text")


# Superscript digits and letters with what they stand for, and endings of ordinals.
SUPER_DIGITS, PLAIN_DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789"
SUPER_LETTERS, PLAIN_LETTERS = "ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸᶻ", "abcdefghijklmnoprstuvwxyz"
ORDINALS = "d|st|nd|rd|th"
_ID = r"[A-Za-z0-9]{1,4}(?:-[A-Za-z0-9]+)?"
_NUMBER_ID = r"\d{1,3}(?:-[A-Za-z0-9]+)?"


def superscript_refs(c: Column) -> Column:
    """Superscript digits as [^n]; an equal mark right beside is not doubled."""
    out = F.translate(F.regexp_replace(c, f"([{SUPER_DIGITS}]+)", "[^$1]"), SUPER_DIGITS, PLAIN_DIGITS)
    return F.regexp_replace(out, r"(\[\^([^\]]+)\])\s*\[\^\2\]", "$1")


def letter_refs(c: Column, allowed: str = PLAIN_LETTERS) -> Column:
    """Superscript letters, of the allowed ones, as [^a]."""
    if not (some := "".join(u for u, x in zip(SUPER_LETTERS, PLAIN_LETTERS, strict=True) if x in allowed)):
        return c
    plain = "".join(x for u, x in zip(SUPER_LETTERS, PLAIN_LETTERS, strict=True) if u in some)
    out = F.regexp_replace(c, rf"(?<!\[\^)([{some}])", "[^$1]")
    for u, x in zip(some, plain, strict=True):
        out = F.replace(out, F.lit(f"[^{u}]"), F.lit(f"[^{x}]"))
    return F.regexp_replace(out, r"(?i)(\[\^([a-z])\])\s*\[\^\2\]", "$1")


def dollar_refs(c: Column) -> Column:
    """A mark caught at the end of a span of text between dollars: $x,^3$ and $x^{3}$ -> $x,$[^3]; formulas stay."""
    out = F.regexp_replace(c, rf"\$([^$\n]*?[A-Za-zÀ-ɏ][^$\n]*?)\^({_NUMBER_ID})\$", r"\$$1\$[^$2]")
    return F.regexp_replace(out, rf"\$([^$\n]*?[A-Za-z\\À-ɏ][^$\n]*?)\^\{{({_NUMBER_ID})\}}\$", r"\$$1\$[^$2]")


def tex_refs(c: Column) -> Column:
    r"""$^\text{a}$ -> [^a]; after a digit an ordinal's ending stays one (3$^\text{d}$ -> 3d)."""
    mark = lambda x: rf"\$\^\s*(?:\{{\s*)?\\(?:text|mathrm)\s*\{{\s*({x})\s*\}}(?:\s*\}})?\$"
    out = F.regexp_replace(c, rf"(?i)(?<=\d){mark(ORDINALS)}(?![A-Za-z0-9_])", "$1")
    return F.regexp_replace(out, mark(_ID), "[^$1]")


def caret_refs(c: Column) -> Column:
    """word.^1 -> word.[^1], outside of dollars; an ordinal's ending after a digit stays one."""

    def one(x: Column) -> Column:
        x = F.regexp_replace(x, rf"(?i)(?<=\d)\^({ORDINALS})\b(?!-[A-Za-z0-9])", "$1")
        return F.regexp_replace(x, rf"(?<![\[\\])\^({_ID})\b", "[^$1]")

    return F.array_join(F.transform(F.split(c, r"\$", -1), lambda x, i: F.when(i % 2 == 0, one(x)).otherwise(x)), "$")


def marked(c: Column) -> Column:
    """All forms of a note's mark as [^id]."""
    for f in (superscript_refs, letter_refs, dollar_refs, tex_refs, caret_refs):
        c = f(c)
    return c


def healed(c: Column) -> Column:
    """Paragraphs that a removed note had cut behind its mark, as one again."""

    def add(acc: Column, x: Column) -> Column:
        last = F.element_at(F.when(F.size(acc["out"]) > 0, acc["out"]), -1)
        end, first = F.element_at(F.when(F.size(X.full_lines(last)) > 0, X.full_lines(last)), -1), F.get(X.full_lines(x), F.lit(0))
        joins = ~acc["closed"] & F.coalesce(end.rlike(r"\[\^[^\]]+\][\"”’')\]]*\s*$") & first.rlike(r"^(?:[a-z]|['\"“‘(\[]\s*[a-z]|[,:;)\]])"), F.lit(False))
        right = F.ltrim(X.strip(x))
        merged = F.concat(F.regexp_replace(last, r"\s+$", ""), F.when(right.rlike(r"^[,.;:)\]}\"”’]"), "").otherwise(" "), F.regexp_replace(x, r"^\s+", ""))
        out = F.when(joins, F.concat(F.slice(acc["out"], F.lit(1), F.greatest(F.lit(0), F.size(acc["out"]) - 1)), F.array(merged))).otherwise(F.concat(acc["out"], F.array(x)))
        return F.struct(out.alias("out"), joins.alias("closed"))

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("closed"))
    return F.when(c.contains("[^"), F.array_join(F.aggregate(F.split(c, "\n\n", -1), start, add)["out"], "\n\n")).otherwise(c)


def rewritten(chapters: DataFrame, ids: DataFrame) -> DataFrame:
    """``chapter_id, body, changed``: references by the new ids of their notes (chapter_id, id, new_id)."""
    # the notes of one chapter
    per = ids.where("id is not null and new_id <> id").select("chapter_id", "id", "new_id").distinct().groupBy("chapter_id").agg(F.array_sort(F.collect_list(F.struct((-F.length("id")).alias("n"), "id", "new_id"))).alias("map"))
    d = chapters.select("chapter_id", X.text("body").alias("body")).join(per, "chapter_id", "left")
    body = F.aggregate("map", F.col("body"), lambda b, m: F.replace(b, F.concat(F.lit("[^"), m["id"], F.lit("]")), F.concat(F.lit("[^"), m["new_id"], F.lit("]"))))
    return d.select("chapter_id", F.when(F.col("map").isNull(), F.col("body")).otherwise(body).alias("body"), F.coalesce(F.size("map"), F.lit(0)).alias("changed"))


def q_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's text with its marks in one form, and how many there are then."""
    p = table(spark, sf_dir, "pages")
    d = p.select("extraction_id", X.text("text").alias("t")).withColumn("m", F.when(F.col("t").rlike(f"[{SUPER_DIGITS}{SUPER_LETTERS}^]"), marked(F.col("t"))).otherwise(F.col("t")))
    return d.select("extraction_id", F.sha1("m").alias("text_sha1"), F.regexp_count("m", F.lit(r"\[\^[^\]]+\]")).alias("marks"))


def q_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _chapters(spark, sf_dir)
    d = rewritten(c, uniquified(definitions(c).where("id is not null")))
    return d.select("chapter_id", F.sha1("body").alias("body_sha1"), "changed")


def q_healed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chapters(spark, sf_dir).select("chapter_id", F.sha1(healed(X.text("body"))).alias("body_sha1"))


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chapters")


def q_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity(_chapters(spark, sf_dir))


def q_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(definitions(_chapters(spark, sf_dir)), ["chapter_id"]).select("chapter_id", "ord", "id")


def q_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each note in its chapter's list of notes."""
    d = definitions(_chapters(spark, sf_dir))
    w = Window.partitionBy("chapter_id").orderBy(*sort_key(F.col("id")), "ord")
    return d.select("chapter_id", "ord", "id", F.row_number().over(w).alias("place"))


def q_uniquified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniquified(definitions(_chapters(spark, sf_dir)).where("id is not null")).select("chapter_id", "ord", "id", "new_id")


def q_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes by family of ids: page-scoped or not, marker letter or not."""
    n = table(spark, sf_dir, "footnotes")
    return n.groupBy("book_id", base_id(F.col("id")).alias("base")).agg(
        F.count("*").alias("notes"), F.count_if(is_page_scoped(F.col("id"))).alias("page_scoped"), F.count_if(marker_letter(F.col("id")).isNotNull()).alias("letters"), F.count_if(X.strip(X.text("text")) == "").alias("empty")
    )


def q_remapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remapped(table(spark, sf_dir, "footnotes").where("id is not null")).select("book_id", "chapter_number", "page_number", "ord", "id", "new_id")


def q_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciled(_chapters(spark, sf_dir))


def q_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sibling_merge(_chapters(spark, sf_dir))


def q_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def q_book_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per book: distinct refs and defs over all chapters, those without partner, and whether all is well."""
    c = _chapters(spark, sf_dir)
    refs = c.select("book_id", F.explode(F.array_distinct(refs_of(X.text("body")))).alias("id")).distinct().withColumn("r", F.lit(1))
    defs = definitions(c).where("id is not null").groupBy("book_id", "id").agg(F.count("*").alias("times"))
    d = refs.join(defs, ["book_id", "id"], "full")
    out = d.groupBy("book_id").agg(
        F.count("r").alias("refs"), F.count("times").alias("defs"), F.count_if(F.col("times").isNull()).alias("orphaned"), F.count_if(F.col("r").isNull()).alias("unreferenced"), F.count_if(F.col("times") > 1).alias("repeated")
    )
    return out.withColumn("ok", (F.col("orphaned") == 0) & (F.col("unreferenced") == 0) & (F.col("repeated") == 0))


QUERIES = {
    "footnote_integrity": q_integrity, "footnote_dedup": q_dedup, "footnote_order": q_sorted, "footnote_unique_ids": q_uniquified, "footnote_families": q_families,
    "footnote_page_scoped": q_remapped, "footnote_reconcile": q_reconciled, "footnote_siblings": q_siblings, "footnotes_from_pages": q_extracted, "footnote_book_integrity": q_book_integrity,
    "footnote_markers": q_markers, "footnote_bodies": q_rewritten, "footnote_healed": q_healed,
}

TEXT = "coalesce(text, '')"
_BASE = "regexp_replace({}, '^(.*?)-p[0-9]+(?:-[0-9]+)?$', '\\1')"
_DEFS = """d0 AS (SELECT chapter_id, book_id, number, body, unnest(footnotes) AS n, generate_subscripts(footnotes, 1) AS ord FROM chapters), d AS (SELECT chapter_id, book_id, number, ord, n.id AS id, n.text AS text FROM d0)"""
_REFS = f"list_concat(regexp_extract_all(coalesce(body, ''), {q(REF)}, 1), regexp_extract_all(coalesce(body, ''), {q(DOLLAR_REF)}, 1))"
SQL = {
    "footnote_integrity": f"""WITH x AS (SELECT chapter_id, list_distinct({_REFS}) AS r, list_filter(list_transform(coalesce(footnotes, []), lambda n: n.id), lambda i: i IS NOT NULL) AS a FROM chapters),
        y AS (SELECT chapter_id, r, a, list_distinct(a) AS f FROM x), z AS (SELECT *, list_sort(list_filter(r, lambda i: NOT list_contains(f, i))) AS o, list_sort(list_filter(f, lambda i: NOT list_contains(r, i))) AS u FROM y)
        SELECT chapter_id, len(r)::INTEGER AS refs, len(f)::INTEGER AS defs, array_to_string(o, ',') AS orphaned, array_to_string(u, ',') AS unreferenced, (len(a) - len(f))::INTEGER AS repeated_defs, (len(o) + len(u))::INTEGER AS mismatches FROM z""",
    "footnote_dedup": f"WITH {_DEFS} SELECT chapter_id, ord::INTEGER AS ord, id FROM d QUALIFY row_number() OVER (PARTITION BY chapter_id, id, {strip(TEXT)} ORDER BY ord) = 1",
    "footnote_order": f"""WITH {_DEFS} SELECT chapter_id, ord::INTEGER AS ord, id, row_number() OVER (PARTITION BY chapter_id ORDER BY CASE WHEN regexp_full_match(trim(coalesce(id, '')), '[0-9]+') THEN 0 ELSE 1 END,
        try_cast(CASE WHEN regexp_full_match(trim(coalesce(id, '')), '[0-9]+') THEN trim(id) END AS HUGEINT) NULLS FIRST, lower(trim(coalesce(id, ''))), ord)::INTEGER AS place FROM d""",
    "footnote_unique_ids": f"""WITH {_DEFS}, m AS (SELECT book_id, id FROM d WHERE id IS NOT NULL GROUP BY ALL HAVING count(*) > 1), e AS (SELECT d.*, greatest(1, coalesce(number, 0)) AS ch FROM d WHERE id IS NOT NULL),
        f AS (SELECT *, row_number() OVER (PARTITION BY book_id, ch, id ORDER BY chapter_id, ord) AS k FROM e)
        SELECT chapter_id, ord::INTEGER AS ord, f.id, CASE WHEN m.id IS NULL THEN f.id ELSE 'c' || ch || '-' || f.id || CASE WHEN k > 1 THEN '-' || k ELSE '' END END AS new_id FROM f LEFT JOIN m ON m.book_id = f.book_id AND m.id = f.id""",
    "footnote_families": f"""SELECT book_id, {_BASE.format("trim(coalesce(id, ''))")} AS base, count(*) AS notes, count(*) FILTER (WHERE regexp_matches(trim(coalesce(id, '')), '-p[0-9]+(?:-[0-9]+)?$')) AS page_scoped,
        count(*) FILTER (WHERE regexp_matches(trim(coalesce(id, '')), '^(?:c[0-9]+-)?[a-z](?:-p[0-9]+(?:-[0-9]+)?|-[0-9]+)?$')) AS letters, count(*) FILTER (WHERE {strip("coalesce(text, '')")} = '') AS empty FROM footnotes GROUP BY ALL""",
    "footnote_page_scoped": f"""WITH a AS (SELECT *, regexp_replace({strip("coalesce(text, '')")}, '[\\s\\p{{Z}}]+', ' ', 'g') AS t FROM footnotes WHERE id IS NOT NULL),
        b AS (SELECT *, first_value(t) OVER (PARTITION BY book_id, chapter_number, id ORDER BY page_number, ord) AS f, row_number() OVER (PARTITION BY book_id, chapter_number, id, t ORDER BY page_number, ord) AS rn FROM a),
        c AS (SELECT *, t <> f AND rn = 1 AS fresh FROM b), e AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY book_id, chapter_number, id, page_number ORDER BY ord) AS k FROM c)
        SELECT book_id, chapter_number, page_number, ord, id, CASE WHEN fresh THEN id || '-p' || page_number || CASE WHEN k > 1 THEN '-' || k ELSE '' END ELSE id END AS new_id FROM e""",
    "footnote_reconcile": f"""WITH {_DEFS}, g AS (SELECT *, {_BASE.format('trim(id)')} AS base, regexp_matches(trim(id), '-p[0-9]+(?:-[0-9]+)?$') AS scoped FROM d WHERE id IS NOT NULL),
        r0 AS (SELECT chapter_id, regexp_extract_all(coalesce(body, ''), {q(REF)}, 1) AS l FROM chapters), r AS (SELECT chapter_id, unnest(l) AS id, generate_subscripts(l, 1) AS pos FROM r0),
        s AS (SELECT chapter_id, base, max(CASE WHEN scoped THEN 0 ELSE 1 END) AS plain FROM g GROUP BY ALL HAVING count(*) > 1),
        m AS (SELECT g.chapter_id, g.base, g.id AS target, row_number() OVER (PARTITION BY g.chapter_id, g.base ORDER BY ord) AS k FROM g JOIN s USING (chapter_id, base) WHERE scoped AND NOT EXISTS (SELECT 1 FROM r WHERE r.chapter_id = g.chapter_id AND r.id = g.id)),
        o AS (SELECT r.chapter_id, r.id AS base, row_number() OVER (PARTITION BY r.chapter_id, r.id ORDER BY pos) AS occurrence, plain FROM r JOIN s ON s.chapter_id = r.chapter_id AND s.base = r.id)
        SELECT o.chapter_id, o.base, occurrence::INTEGER AS occurrence, target FROM o JOIN m ON m.chapter_id = o.chapter_id AND m.base = o.base AND m.k = o.occurrence - plain WHERE o.occurrence - plain > 0""",
    "footnote_siblings": f"""WITH {_DEFS}, r AS (SELECT DISTINCT chapter_id, unnest({_REFS}) AS id FROM chapters), g AS (SELECT d.chapter_id, d.id, d.ord, regexp_extract(d.id, '-p([0-9]+)(?:-[0-9]+)?$', 1) AS page, r.id IS NOT NULL AS used FROM d LEFT JOIN r ON r.chapter_id = d.chapter_id AND r.id = d.id WHERE d.id IS NOT NULL),
        h AS (SELECT *, coalesce(last_value(CASE WHEN used THEN id END IGNORE NULLS) OVER w, last_value(id) OVER w) AS "into" FROM g WHERE page <> '' WINDOW w AS (PARTITION BY chapter_id, page ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT chapter_id, id, ord::INTEGER AS ord, "into" FROM h WHERE NOT used AND "into" IS NOT NULL""",
    "footnote_book_integrity": f"""WITH {_DEFS}, r AS (SELECT DISTINCT book_id, unnest({_REFS}) AS id FROM chapters), f AS (SELECT book_id, id, count(*) AS times FROM d WHERE id IS NOT NULL GROUP BY ALL),
        j AS (SELECT coalesce(r.book_id, f.book_id) AS book_id, r.id AS rid, f.times FROM r FULL JOIN f ON r.book_id = f.book_id AND r.id = f.id)
        SELECT book_id, count(rid) AS refs, count(times) AS defs, count(*) FILTER (WHERE times IS NULL) AS orphaned, count(*) FILTER (WHERE rid IS NULL) AS unreferenced, count(*) FILTER (WHERE times > 1) AS repeated,
        count(*) FILTER (WHERE times IS NULL OR rid IS NULL OR times > 1) = 0 AS ok FROM j GROUP BY book_id""",
}
SQL["footnote_bodies"] = f"""WITH u AS ({SQL["footnote_unique_ids"]}), m AS (SELECT DISTINCT chapter_id, id, new_id FROM u WHERE id IS NOT NULL AND new_id <> id),
    l AS (SELECT chapter_id, list(id || chr(1) || new_id ORDER BY length(id) DESC, id, new_id) AS ms FROM m GROUP BY chapter_id)
    SELECT c.chapter_id, sha1(list_reduce(list_concat([coalesce(body, '')], coalesce(ms, [])), lambda b, x: replace(b, '[^' || split_part(x, chr(1), 1) || ']', '[^' || split_part(x, chr(1), 2) || ']'))) AS body_sha1, coalesce(len(ms), 0)::INTEGER AS changed
    FROM chapters c LEFT JOIN l USING (chapter_id)"""
