"""Problem 5: noise in text from scanned pages, and its repair.

Candidates for misread words come from ``words.corrections`` (Levenshtein automata
against a vocabulary trie) and are ranked by their neighbours (``words.choose``).  Words divided at line ends are told from compounds by the
corpus' own words and compounds.  Running heads are lines at the edge of a page
that repeat a title of their book; page numbers stand there alone.  The repaired
text is without furniture, with words joined and corrected, one paragraph a line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from quire.llm.common import hash_filter, letters, passing, spread, staged, table
from quire.llm.words import MAX_CHARS, NUMBER, TOKEN, choose, fold, frequent, lexicon, plain, token

#: Lines at either edge of a page among which furniture stands.
EDGE = 4
#: Most misread letters of a title of less than 10, 16, 32 and of more letters.
EDITS = "case when length(title) < 10 then 1 when length(title) < 16 then 2 when length(title) < 32 then 3 else 4 end"
#: Pages on which an untabled section title stands at least.
SECTION_PAGES = 5

_PAGE_NUMBER = re.compile(r"[\W_]*(?:(?:p|pp|page|pag|seite|पृष्ठ)[.\s]*)?(?=[\W_]*[0-9lOIoS|ivxclIVXCL])[\s\[\](){}*·•.,:;—–‐‑-]*(?:[0-9lOISo|]{1,5}|[ivxclIVXCL]{1,8})[\s\[\](){}*·•.,:;—–‐‑-]*", re.I)
_HYPHEN_END = re.compile(r"(?<![^\W_])([^\W\d_](?:[^\W_]|[|!])*)[-‐‑­]\s*$")
_FIRST_WORD = re.compile(r"\s*[“\"'(]*([^\W_](?:[^\W_]|[|!])*)")
_ORDINAL = re.compile(r"\d+(?:st|nd|rd|th|er|re|e|me|ème|ter|te)$")
_ROMAN = re.compile(r"^[\W_]*[ivxlcIVXLC]{1,8}[\s.\])]+(?=\S)|(?<=\S)[\s.\[(]+[ivxlcIVXLC]{1,8}[\W_]*$")


def key_of(text: str) -> str:
    """Folded letters of a text."""
    tab = letters()
    return "".join([chr(c) for ch in fold(text) if ord(ch) < 0x10000 and (c := int(tab[ord(ch)]))])


def _is_number(raw: str) -> bool:
    return bool(NUMBER.fullmatch(raw)) and any(c.isdigit() for c in raw)


def titled(line: str) -> bool:
    """Capitals throughout, or at the start of every longer word; at least two words."""
    words = [w for w in re.findall(r"[^\W\d_]+", line) if w.isascii()]
    return len(words) >= 2 and all(w[0].isupper() for w in words if len(w) > 3) and any(len(w) > 3 for w in words)


class Scanner:
    """Noise of the lines of one page, as far as the page itself tells."""

    def __init__(self, often: list[str]):
        self.often = set(often)
        pairs = [w.split("-", 1) for w in often if "-" in w]
        self.firsts, self.seconds = {a for a, _ in pairs}, {b for _, b in pairs}

    def broken(self, first: str, second: str | None) -> bool:
        """Whether the parts of a divided word join without the hyphen."""
        first = first.lower()
        if second is None:
            return first not in self.firsts
        second = second.lower()
        if first + second in self.often:
            return True
        if f"{first}-{second}" in self.often:
            return False
        return not (first in self.firsts and second in self.seconds)

    def page(self, text: str) -> list[list]:
        """[line_no, what, value, length of a first part, word before, word after]: what is
        broken, number, digits (a misread number), word (to be looked up) or edge (a line's letters)."""
        out: list[list] = []
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x and not x.isspace()]
        edge = set(full[:EDGE]) | set(full[-EDGE:])
        often, carried = self.often, 0
        before, waiting = "", None  # the last word that is no name; a word that waits for the next one
        for i in full:
            line = fold(lines[i])
            skip, carried = carried, 0
            last = _HYPHEN_END.search(line) if line.rstrip()[-1:] in ("-", "‐", "‑", "­") else None
            words, joined = line, None
            if last:
                here = last.group(1)
                after = fold(lines[i + 1]) if i + 1 < len(lines) else ""
                m = _FIRST_WORD.match(after)
                second = m.group(1) if m else None
                if self.broken(here, second):
                    out.append([i + 1, "broken", here, 0, "", ""])
                    if second:
                        carried = 1
                        joined = here + second
                words = line[: last.start()]
            for raw in [*TOKEN.findall(words), *([joined] if joined else [])]:
                if skip:  # the second part of a divided word
                    skip = 0
                    continue
                now = raw if plain(raw) else ""
                if waiting is not None:
                    waiting[5], waiting = now, None
                w = token(raw)
                if raw.isdigit() or len(raw) > MAX_CHARS or w in often or not w or w.isdigit():
                    pass
                elif raw is not joined and _is_number(raw.rstrip("|!")):
                    out.append([i + 1, "digits", raw, 0, "", ""])
                elif len(w) > 2 or not w.isalpha():
                    out.append([i + 1, "word", w, len(here) if raw is joined else 0, before, ""])
                    waiting = out[-1] if raw[:1] == w[:1] else None
                before = now
            if i in edge:
                if len(lines[i]) <= 24 and _PAGE_NUMBER.fullmatch(line.strip()):
                    out.append([i + 1, "number", "", 0, "", ""])
                else:
                    k = key_of(line)
                    if len(k) >= 4:
                        out.append([i + 1, "edge", k, int(titled(line)), "", ""])
                        if (k2 := key_of(_ROMAN.sub("", line))) != k and len(k2) >= 4:
                            out.append([i + 1, "edge", k2, 0, "", ""])
        return out


def _bare(c: Column) -> Column:
    """A title without the word and number of its chapter."""
    return F.regexp_replace(F.trim(c), r"(?i)^\s*(?:chapter|chap|book|part|section)\b\.?\s*[ivxlcdm\d]+\s*[.:—–-]*\s*", "")


_MARKS = pa.schema([("extraction_id", pa.int64()), ("book_id", pa.string()), ("page_number", pa.int32()), ("line_no", pa.int32()), ("what", pa.string()), ("value", pa.string()), ("first", pa.int32()), ("before", pa.string()), ("after", pa.string()), ("heading", pa.bool_())])


def _marks(pages: DataFrame, often: list[str]) -> DataFrame:
    """What ``Scanner.page`` finds, with the page of edge lines and whether they are its heading; title pages have no edge."""
    known = pages.sparkSession.sparkContext.broadcast(often)  # at most 1 / FREQUENT words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                rows = []
                for e, b, p, heading, titles, t in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    for no, what, value, first, before, after in scanner.page(t):
                        if what != "edge":
                            rows.append((e, None, None, no, what, value, first, before, after, None))
                        elif not titles:
                            rows.append((e, b, p, no, what, value, first, "", "", value == heading))
                cols = list(zip(*rows, strict=True)) if rows else [()] * len(_MARKS)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _MARKS, strict=True)], schema=_MARKS)

    heading = _letters_sql(_bare(F.coalesce("chapter_heading", F.lit(""))))
    src = pages.where(F.col("text").rlike(r"\S")).select(F.col("extraction_id").cast("long"), "book_id", F.col("page_number").cast("int"), heading.alias("heading"), F.coalesce(F.col("page_type") == "title", F.lit(False)).alias("titles"), "text")
    return spread(src).mapInArrow(run, from_arrow_schema(_MARKS))


def _chosen(looked: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``extraction_id, line_no, value, first, word``: the candidate that its neighbours speak for, if any."""
    known = looked.sparkSession.sparkContext.broadcast(sketch)  # SLOTS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [choose(o, x or "", y or "", known.value) for o, x, y in zip(*[b.column(i).to_pylist() for i in (4, 5, 6)], strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(words, pa.string())], ["extraction_id", "line_no", "value", "first", "word"])

    rows = looked.select("extraction_id", "line_no", "value", "first", "others", "before", "after")
    return rows.mapInArrow(run, "extraction_id bigint, line_no int, value string, first int, word string").where("word is not null")


def _letters_sql(c):
    """Letters of a title, as far as titles go: lower case, no digits, blanks or signs."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}]+", "")


def titles(pages: DataFrame, books: DataFrame, chapters: DataFrame) -> DataFrame:
    """``book_id, title`` (letters) of books, chapters and chapter headings."""
    all_ = (
        books.select("book_id", F.col("title").alias("t"))
        .unionByName(chapters.select("book_id", _bare(F.col("title")).alias("t")))
        .unionByName(pages.where("chapter_heading is not null").select("book_id", _bare(F.col("chapter_heading")).alias("t")))
    )
    return all_.select("book_id", _letters_sql("t").alias("title")).where("length(title) >= 4").distinct()


def section_titles(marks: DataFrame, books: DataFrame) -> DataFrame:
    """``book_id, title`` of sections that no table names: titled edge lines that
    stand on SECTION_PAGES pages or more of one book and of no other, and don't
    name the collection, as its notices do."""
    rows = marks.where("what = 'edge' and first = 1 and book_id is not null").select("book_id", "value", "page_number").distinct()
    per = rows.groupBy("book_id", "value").agg(F.count("*").alias("n"))
    often = per.groupBy("value").agg(F.max("n").alias("n"), F.count("*").alias("books"), F.max_by("book_id", "n").alias("book_id")).where(f"n >= {SECTION_PAGES} and books = 1")
    host = books.groupBy("book_id").agg(F.max(_letters_sql("source")).alias("host"))
    own = often.join(host, "book_id", "left").where("host is null or host = '' or instr(value, host) = 0")
    return own.select("book_id", F.col("value").alias("title"))


def near_titles(keys: DataFrame, title: DataFrame) -> DataFrame:
    """``book_id, key`` of the lines that a title of their book is within EDITS of; all of them.

    Titles of less than 16 letters are compared with every line of a like length.
    For the others a line is cut into more pieces than letters may be misread
    (5 from 28 letters on, else 4), so one piece stands unchanged in the title; a
    filter of fixed size lets no other line pass but by chance.
    """
    size = lambda n: f"int(({n}) div if({n} < 28, 4, 5))"
    lengths = f"sequence(length(title) - {EDITS}, length(title) + {EDITS})"
    parts = f"flatten(transform(array_distinct(transform({lengths}, n -> {size('n')})), m -> transform(sequence(1, length(title) - m + 1), i -> substring(title, i, m))))"
    probes = F.expr(f"array_distinct(transform(if(length(title) < 16, transform({lengths}, n -> string(n)), {parts}), x -> xxhash64(book_id, x)))")
    bits = hash_filter(title.select(F.explode(probes).alias("h")))
    n = "if(length(key) < 28, 4, 5)"
    pieces = f"transform(sequence(0, {n} - 1), i -> substring(key, int(i * length(key) div {n}) + 1, {size('length(key)')}))"
    own = f"concat(if(length(key) <= 17, array(string(length(key))), array()), if(length(key) >= 13, {pieces}, array()))"
    # lines that no title is like in length go no further
    like = title.select("book_id", F.expr(f"explode({lengths})").alias("n")).distinct()
    at = keys.withColumn("n", F.length("key")).join(like, ["book_id", "n"], "left_semi").select("book_id", "key", F.expr(f"transform({own}, x -> xxhash64(book_id, x))").alias("h"))
    near = passing(at, "h", bits).select("book_id", "key", F.length("key").alias("n"))
    blocks = title.select("book_id", "title", F.expr(f"explode({lengths})").alias("n"))
    return near.join(blocks, ["book_id", "n"]).where(F.expr(f"levenshtein(key, title, {EDITS}) >= 0")).select("book_id", "key").distinct()


def _running(marks: DataFrame, title: DataFrame) -> DataFrame:
    """Edge lines that repeat a title of their book, exactly or but for misread characters."""
    edge = marks.where("what = 'edge' and not heading and book_id is not null").select("extraction_id", "line_no", "book_id", F.col("value").alias("key"))
    keys = staged(edge.select("book_id", "key").distinct(), "edge")
    exact = keys.join(title.withColumnRenamed("title", "key"), ["book_id", "key"], "left_semi")
    hit = exact.unionByName(near_titles(keys, title)).distinct()
    return edge.join(hit, ["book_id", "key"], "left_semi").select("extraction_id", "line_no")


def noise(pages: DataFrame, books: DataFrame, chapters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cases, fixes): ``extraction_id, line_no, kind`` of each noisy line, and
    ``extraction_id, line_no, token, word`` of each misread word.

    Null and empty texts have no lines; pages of unknown books have no titles,
    so no running heads; repeated rows count once; empty tables give nothing.
    """
    counts, wrong, sketch = lexicon(pages.select("text", "book_id", "page_number"))
    marks = staged(_marks(pages, frequent(counts, wrong.where("edits = 0"))), "marks")
    looked = _chosen(marks.where("what = 'word'").join(wrong.select(F.col("token").alias("value"), "others"), "value"), sketch)
    # of a divided word the line with the misread character counts
    second = (F.col("first") > 0) & F.expr("left(word, first) = left(value, first)")
    fixes = looked.select("extraction_id", (F.col("line_no") + second.cast("int")).alias("line_no"), F.col("value").alias("token"), "word")
    kinds = [
        fixes.select("extraction_id", "line_no", F.lit("misread").alias("kind")),
        marks.where("what = 'digits'").select("extraction_id", "line_no", F.lit("misread").alias("kind")),
        marks.where("what = 'broken'").select("extraction_id", "line_no", F.lit("broken_word").alias("kind")),
        marks.where("what = 'number'").select("extraction_id", "line_no", F.lit("page_number").alias("kind")),
        _running(marks, staged(titles(pages, books, chapters).unionByName(section_titles(marks, books)).distinct(), "titles")).withColumn("kind", F.lit("running_head")),
    ]
    out = kinds[0]
    for k in kinds[1:]:
        out = out.unionByName(k)
    return out.distinct(), fixes


def reflow(lines: list[str], cut: set[int], broken: set[int], fixes: dict[int, list[tuple[str, str]]]) -> str:
    """Paragraphs of a page, each on one line, a blank line between."""
    out, now, glue = [], "", False
    for no, line in enumerate(lines, 1):
        if no in cut:
            continue
        if not line.strip():
            if now and not glue:
                out.append(now)
                now = ""
            continue
        line = line.strip()
        for wrong, right in fixes.get(no, ()):
            line = re.sub(re.escape(wrong), lambda m, r=right: r.upper() if m[0].isupper() else r.capitalize() if m[0][0].isupper() else r, line, flags=re.I)
        now = now + line if glue or not now else f"{now} {line}"
        glue = no in broken
        if glue:
            now = re.sub(r"[-‐‑­]\s*$", "", now)
    return "\n\n".join([*out, now] if now else out)


def repaired(pages: DataFrame, books: DataFrame, chapters: DataFrame) -> DataFrame:
    """``extraction_id, text``: continuous paragraphs without furniture."""
    cases, fixes = noise(pages, books, chapters)
    # the lists below hold at most the lines and words of one page
    per = cases.groupBy("extraction_id").agg(
        F.collect_set(F.when(F.col("kind").isin("running_head", "page_number"), F.col("line_no"))).alias("cut"),
        F.collect_set(F.when(F.col("kind") == "broken_word", F.col("line_no"))).alias("broken"),
    )
    words = fixes.groupBy("extraction_id").agg(F.collect_set(F.struct("line_no", "token", "word")).alias("fixes"))
    src = pages.select(F.col("extraction_id").cast("long"), "text").join(per, "extraction_id", "left").join(words, "extraction_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                out = []
                for r in batch.slice(lo, 500).to_pylist():
                    by: dict[int, list[tuple[str, str]]] = {}
                    for f in r["fixes"] or ():
                        by.setdefault(f["line_no"], []).append((f["token"], f["word"]))
                    out.append(None if r["text"] is None else reflow(r["text"].split("\n"), set(r["cut"] or ()), set(r["broken"] or ()), by))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 500), pa.array(out, pa.string())], ["extraction_id", "text"])

    return src.mapInArrow(run, "extraction_id bigint, text string")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, sf_dir, "pages"), table(spark, sf_dir, "books"), table(spark, sf_dir, "chapters")


def p5_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(*_tables(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noise(*_tables(spark, sf_dir))[0]
