"""Problem 2: template residue, filler, error pages and script notices.

Placeholder detectors find unfilled fields anywhere in a response.  For the rest
three kinds of evidence are combined, and no phrase decides alone:

* low information: the same response came back for several books, or it repeats
  itself, or phrases of filler, errors or notices make up a good part of it;
* host evidence: of how many books and of how many sources it came back;
* mismatch: its terms are not those of the book's address slug, title and
  heading, nor of the book's other pages.

Lengths don't matter; whole responses are looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from re import _parser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import hash_filter, spread, staged, table

#: Names in template marks.
_NAME = r"[A-Za-z][A-Za-z0-9]*(?:[._][A-Za-z0-9]+)*"
#: Unfilled placeholders.
PLACEHOLDERS = (
    r"\{\{\s*" + _NAME + r"\s*\}\}",
    r"\{%-?\s*" + _NAME + r"[^%{}\n]{0,40}%\}",
    r"<%=?\s*" + _NAME + r"[^%<>\n]{0,40}%>",
    r"[$#]\{\s*" + _NAME + r"\s*\}",
    r"%%\s*" + _NAME + r"\s*%%",
    r"@@\s*" + _NAME + r"\s*@@",
    r"\[\[\s*" + _NAME + r"\s*\]\]",
    r"<<\s*" + _NAME + r"\s*>>",
    r"(?<![\p{L}\p{N}_])__" + _NAME + r"__(?![\p{L}\p{N}_])",
    r"(?<![\p{L}\p{N}\\$])\{[A-Za-z]{3,}(?:[._][A-Za-z0-9]+)*\}",
    r"(?i)\[\s*(?:insert|add|enter|put|paste)\s[\p{L}\s]{2,60}?\]",
    r"(?i)\[[\p{L}\s]{2,60}?\s(?:to come|goes here|tbd|pending|forthcoming|to be (?:supplied|added|inserted))\s*\]",
)
#: In lower case one of the first stands in every placeholder, or a bracket with one of the second.
PLACEHOLDER_SIGNS, BRACKETED = ("{", "<%", "%%", "@@", "[[", "<<", "__"), ("insert", "add", "enter", "put", "paste", "to come", "goes here", "tbd", "pending", "forthcoming", "to be ")
#: Words of the usual filler text.
FILLER_WORDS = (
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore "
    "magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat "
    "duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum"
).split()
#: Sentences that stand for a text still to come.
FILLER_PHRASES = r"(?i)\b(?:placeholder (?:for|text)|sample text|dummy text|text goes here|insert the text|replace with the|to be supplied by)\b|\btodo\b\s*:|\byour (?:caption|title|text) here\b|\bcontent (?:goes|to come)\b"
#: Messages of servers and viewers.
ERRORS = (
    r"(?i)\b(?:40[0-9]|41[0-9]|42[0-9]|50[0-9]|52[0-9])\b.{0,20}\b(?:not found|forbidden|unauthorized|error|unavailable|timeout|time-out|gateway|too many|gone)"
    r"|\b(?:error|erreur|fehler|http/\d(?:\.\d)?)\s*[:#]?\s*(?:40[0-9]|41[0-9]|42[0-9]|50[0-9])\b|त्रुटि\s*[45]\d\d"
    r"|\b(?:internal server error|service unavailable|bad gateway|gateway time-?out|access denied|permission to view|too many requests|download limit"
    r"|session has expired|sign in again|upstream|traceback \(most recent|timeouterror|requested page could not be found|page demandée n'existe"
    r"|something went wrong|please try again later|could not complete your request|not found|seite nicht gefunden|nicht verfügbar|plus disponible)\b"
    r"|उपलब्ध नहीं है"
    r"|\"error\"\s*:\s*[{\"]"
)
#: Notices that scripts, cookies or a check of the browser are needed.
NOTICES = (
    r"(?i)\bjavascript\b|\b(?:enable|allow|turn on|activer|aktivieren)\b.{0,40}\b(?:scripts?|scripting|cookies)\b|\bscripts? (?:must|are|is) |\bdoes not run scripts\b"
    r"|<noscript|\bchecking your browser\b|\bnot a robot\b|\bscripts are not blocked\b|\bcookies to (?:use|continue)\b"
)
#: Remarks that a page is blank or holds nothing to read: no cases.
REMARKS = r"(?i)\[?blank page\]?|appears? to be blank|no visible text|no text on this page|cannot transcribe|shows a decorative|contains only a"
#: For problem 6: a message with more letters than this may have a page beside it.
SHORT = 700
#: Sentences with a phrase make up this part of a message's letters at least.
COVER = 0.25
#: Where they make up this part, common terms are no sign of a page.
WHOLLY = 0.8
#: A response is repeated if it came back for so many books, and for one more for every so many of its distinct words.
BOOKS, WORDS_A_BOOK = 2, 8
#: Distinct words over words, and pairs over pairs, at most, of a response of so many words that repeats itself.
VARIETY, WORDS = 0.5, 4
#: A response mismatches its book if at most this part of its terms stands on other pages
#: of it: of one that repeats itself or is repeated, of one with a phrase, of a repeated one with a phrase.
KNOWN, KNOWN_SAID, KNOWN_BOTH = 0.5, 0.85, 0.95
#: Lines at either edge of a response among which furniture stands.
EDGE = 4
#: Letters of a term.
TERM = 4


def literals(pattern: str) -> set[str]:
    """Strings in lower case of which every match of a pattern holds one; found from the pattern itself."""

    def best(items) -> set[str] | None:
        found, run = [], ""
        for op, arg in [*items, (None, None)]:
            if op is _parser.LITERAL:
                run += chr(arg).lower()
                continue
            if run:
                found.append({run})
                run = ""
            if op is _parser.SUBPATTERN:
                found.append(best(arg[3]))
            elif op is _parser.BRANCH:
                each = [best(x) for x in arg[1]]
                found.append(set().union(*each) if all(each) else None)
            elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT) and arg[0]:
                found.append(best(arg[2]))
        return max((f for f in found if f), key=lambda f: (min(map(len, f)), -len(f)), default=None)

    if not (out := best(_parser.parse(pattern))):
        raise ValueError(f"no literal in {pattern}")
    return out


def _may(low: Column, pattern: str) -> Column:
    return reduce(Column.__or__, [low.contains(x) for x in sorted(literals(pattern))])


def _slug_terms(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{M}]+"), lambda w: F.length(w) >= 5)


def _plain(c: Column) -> Column:
    """Without invisible characters, signs of templates in their usual form."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), "[​‌‍⁠﻿­]", "")
    return F.translate(out, "｛｝［］％＜＞＠＄    　", "{}[]%<>@$     ")


def _covered(left: Column, pattern: str) -> Column:
    """Part of the letters of a text that stands in sentences with the pattern."""
    letters = lambda x: F.length(F.regexp_replace(x, r"[^\p{L}\p{N}]+", ""))
    parts = F.split(F.regexp_replace(left, r"\s+", " "), r"(?<=[.!?।]) ")
    hit = F.aggregate(F.filter(parts, lambda x: x.rlike(pattern)), F.lit(0), lambda n, x: n + letters(x))
    return F.coalesce(F.try_divide(hit, letters(left)), F.lit(0.0))


def responses(pages: DataFrame, books: DataFrame) -> DataFrame:
    """Evidence of each extraction as it stands: placeholder, filler, error, notice, dull (it repeats itself), response (its form).

    Null raw_text counts as empty: nothing is found in it.  Books without title
    or source, and pages of unknown books, are judged by the slug alone.
    """
    b = books.groupBy("book_id").agg(F.max("title").alias("title"), F.max("source").alias("source"))
    p = pages.select("extraction_id", "book_id", "page_number", "page_type", "chapter_heading", _plain(F.col("raw_text")).alias("raw")).join(b, "book_id", "left")
    p = p.withColumn("low", F.lower("raw"))
    any_of = lambda signs: reduce(Column.__or__, [F.col("low").contains(x) for x in signs])
    marks = any_of(PLACEHOLDER_SIGNS) | (F.col("low").contains("[") & any_of(BRACKETED))
    p = p.withColumn("placeholder", F.when(marks, F.col("raw").rlike("|".join(f"(?:{x})" for x in PLACEHOLDERS))).otherwise(False))
    # furniture: lines that hold the book's own words, a number, or the host's navigation
    own = F.array_union(F.array_union(_slug_terms(F.coalesce("book_id", F.lit(""))), _slug_terms(F.coalesce("title", F.lit("")))), _slug_terms(F.coalesce("chapter_heading", F.lit(""))))
    host = F.regexp_replace(F.lower(F.coalesce("source", F.lit(""))), "_", " ")
    p = p.withColumns({"own": own, "longest": F.greatest(F.length(F.coalesce("title", F.lit(""))), F.length(F.coalesce("chapter_heading", F.lit(""))), F.length(F.coalesce("book_id", F.lit("")))) * 2 + 40})
    # full lines at either edge; only these are taken apart
    p = p.withColumn("ls", F.filter(F.split("raw", r"\n"), lambda x: x.rlike(r"\S")))
    shared = lambda t: F.size(F.array_intersect(t, F.col("own"))) * 2 > F.size(t)
    furniture = lambda x: (
        ((F.length(x) <= 24) & F.regexp_replace(x, r"[^\p{L}]+", "").rlike(r"^(?i:[ivxlc]{0,8}|page|p)$"))
        | (F.lower(F.trim(x)) == host)
        | x.rlike(r"(?i)^\s*home \|")
        | ((F.length(x) <= F.col("longest")) & F.exists("own", lambda w: F.lower(x).contains(w)) & shared(_slug_terms(x)))
    )
    lines = F.filter("ls", lambda x, i: ~(((i < EDGE) | (i >= F.size("ls") - EDGE)) & furniture(x)))
    p = p.withColumn("left", F.array_join(lines, "\n"))
    known = F.array(*map(F.lit, FILLER_WORDS))
    split = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}\p{M}]+"), lambda w: w != "")
    share = lambda w: F.coalesce(F.try_divide(F.size(F.filter(w, lambda x: F.array_contains(known, x))), F.size(w)), F.lit(0.0))
    maybe = reduce(Column.__or__, [F.col("low").contains(w) for w in ("lorem", "ipsum", "eiusmod", "consectetur")])
    words, unwrapped = split(F.col("raw")), split(F.regexp_replace("raw", r"\n", ""))
    lorem = F.when(maybe, (F.size(words) >= 5) & (F.greatest(share(words), share(unwrapped)) >= 0.6)).otherwise(False)
    remark = F.when(_may(F.col("low"), REMARKS), F.col("left").rlike(REMARKS)).otherwise(False)
    p = p.withColumns({"words": split(F.col("left")), "remark": remark})
    p = p.withColumns({k: F.when(_may(F.col("low"), x), F.col("left").rlike(x)).otherwise(False) for k, x in (("f", FILLER_PHRASES), ("e", ERRORS), ("n", NOTICES))})
    part = lambda hit, x: F.when(~F.col("remark") & F.col(hit), _covered(F.col("left"), x)).otherwise(0.0)
    p = p.withColumns({"f": part("f", FILLER_PHRASES), "e": part("e", ERRORS), "n": part("n", NOTICES)})
    few = F.size("words") >= WORDS
    pairs = F.zip_with(F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))), F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    p = p.withColumns({
        "filler": lorem | (F.col("f") >= COVER), "error": F.col("e") >= COVER, "notice": F.col("n") >= COVER, "wholly": F.greatest("f", "e", "n") >= WHOLLY,
        "dull": F.when(~F.col("remark") & few & (F.size(F.array_distinct("words")) <= VARIETY * F.size("words")), F.size(F.array_distinct(pairs)) <= VARIETY * F.size(pairs)).otherwise(False),
        # the form of a response: its letters; digits and names of files differ from one to the next
        "response": F.when((F.size("words") > 0) & ~F.col("remark") & F.coalesce(F.col("page_type") != "blank", F.lit(True)), F.xxhash64(F.array_join("words", " "))),
    })
    return p.select("extraction_id", "book_id", "source", "placeholder", "filler", "error", "notice", "wholly", "dull", "response", F.size(F.array_distinct("words")).alias("variety"), "own", "left")


#: Runs of characters that are no blanks, digits or punctuation, in lower case.
_TERMS = re.compile(rf"[^\x00-@\[-`{{-\u00bf\u00d7\u00f7\u2000-\u206f।॥\u0966-\u0970]{{{TERM},}}")


_UNSEEN = dict.fromkeys(map(ord, "​‌‍⁠﻿­"))


class Terms:
    """Hashes of a book with each distinct term of a text; remembers those of terms and books."""

    def __init__(self):
        self.seen: dict[str, int] = {}

    def hash(self, word: str) -> int:
        if (h := self.seen.get(word)) is None:
            if len(self.seen) > 500_000:
                self.seen.clear()
            self.seen[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, book: str | None, text: str) -> list[int]:
        text = (text if text.isascii() else text.translate(_UNSEEN)).lower()
        own = self.hash(f"of {book}")
        return [(self.hash(t) ^ own) - (1 << 63) for t in set(_TERMS.findall(text))]


def unknown_share(suspects: DataFrame, pages: DataFrame) -> DataFrame:
    """``extraction_id, known``: part of a suspect's terms that stand on other pages of its book.

    Only the suspects' terms are counted, over all pages: a filter of fixed size
    keeps the others out.  Pages that are suspect themselves don't count.
    """

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms()
        for b in batches:
            rows = [(e, book, h) for e, book, t in zip(*[c.to_pylist() for c in b.columns], strict=True) for h in known.of(book, t)]
            e, book, h = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()), pa.array(book, pa.string()), pa.array(h, pa.int64())], ["extraction_id", "book_id", "h"])

    own = staged(suspects.select(F.col("extraction_id").cast("long"), "book_id", "left").mapInArrow(terms, "extraction_id bigint, book_id string, h bigint"), "terms")
    bits = hash_filter(own.select("h"))
    wanted = pages.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = wanted.value.astype("<i8").tobytes(), Terms()
        top = len(bits) * 8 - 1
        for b in batches:
            n: dict[int, int] = {}
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                for book, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for h in known.of(book, t or ""):
                        at = h & top
                        if bits[at >> 3] >> (at & 7) & 1:
                            n[h] = n.get(h, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64())], ["h", "n"])

    every = spread(pages.select("book_id", "raw_text")).mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    rows = own.groupBy("h").agg(F.count("*").alias("mine"))
    stands = every.join(rows, "h").select("h", (F.col("n") > F.col("mine")).alias("stands"))
    per = own.join(stands, "h", "left").groupBy("extraction_id").agg(F.avg(F.coalesce("stands", F.lit(False)).cast("double")).alias("known"))
    return per


def residue(pages: DataFrame, books: DataFrame) -> DataFrame:
    """``extraction_id, placeholder, filler, error, notice, repeated_in_books, sources, mismatch, found`` of each extraction.

    ``mismatch`` is only looked into where a response has little information.
    Remarks that a page is blank are no residue, however often they come back.
    """
    r = staged(responses(pages, books), "responses")
    # of a response that came back for one book only nothing is to be counted
    hosts = r.where("response is not null").select("response", "book_id", "source").distinct().groupBy("response").agg(F.count("book_id").alias("books"), F.count_distinct("source").alias("sources")).where(F.col("books") >= BOOKS)
    r = r.join(hosts, "response", "left").withColumn("repeated", F.coalesce(F.col("books") * WORDS_A_BOOK >= F.col("variety"), F.lit(False)))
    said = F.col("filler") | F.col("error") | F.col("notice")
    most = F.when(F.col("wholly"), 1.0).when(said & F.col("repeated"), KNOWN_BOTH).when(said, KNOWN_SAID).otherwise(KNOWN)
    dull = F.col("filler") | F.col("error") | F.col("notice") | F.col("dull") | F.col("repeated")
    suspects = staged(r.where(dull & ~F.col("placeholder")).select("extraction_id", "book_id", most.alias("most"), "own", "left"), "suspects")
    terms = F.filter(F.split(F.lower("left"), r"[^\p{L}\p{M}]+"), lambda w: F.length(w) >= TERM + 1)
    alien = F.size(F.array_intersect(terms, "own")) * 4 <= F.size(terms)
    known = unknown_share(suspects, pages)
    judged = suspects.select("extraction_id", "most", alien.alias("alien")).join(known, "extraction_id", "left").groupBy("extraction_id").agg(F.max((F.col("alien") & (F.coalesce("known", F.lit(1.0)) <= F.col("most"))).cast("int")).alias("mismatch"))
    r = r.join(judged, "extraction_id", "left").withColumn("mismatch", F.coalesce(F.col("mismatch") == 1, F.lit(False)))
    found = F.col("placeholder") | F.col("mismatch")
    return r.select("extraction_id", "placeholder", "filler", "error", "notice", F.coalesce("books", F.lit(1)).alias("repeated_in_books"), F.coalesce("sources", F.lit(1)).alias("sources"), "mismatch", found.alias("found"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue(table(spark, sf_dir, "pages"), table(spark, sf_dir, "books")).where("found").select("extraction_id").distinct()
