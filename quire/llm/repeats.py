"""Problem 1: lines that stand on page after page of one book.

1. Content-defined chunks: a rolling hash over four letters cuts the letters of
   each page into chunks (a line end cuts too, as a line is what a case is).
   Pages are chunked once; their lines and chunks are written out.
2. Occurrences are counted per book and chunk, with partial sums.  A chunk that
   occurs on half the threshold's pages or more is repeated.
3. Lines with a repeated chunk are candidates.  They are found without a shuffle
   by a filter of fixed size that lets every repeated chunk pass (and, by chance,
   some others).
4. Exact check: distinct pages of the candidates' letters are counted; a line that
   differs from a frequent one by a misread character counts with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from quire.llm.common import expand, fold_letters, hash_filter, letters, passing, spread, staged, table

#: A chunk ends on average after so many letters; letters of the rolling window.
MEAN_CHUNK, WINDOW = 16, 4
#: Least letters of a line, least pages, least part of the book's pages.
MIN_LETTERS, MIN_PAGES, MIN_SHARE = 8, 4, 0.1
#: Most misread letters of a line of less than 16, 40 and of more letters.
MISREAD = "case when length(centre) < 16 then 1 when length(centre) < 40 then 2 else 3 end"

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_IS_LETTER: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _IS_LETTER
    if _IS_LETTER is None:
        import unicodedata

        _IS_LETTER = np.array([bool(c) and unicodedata.category(chr(c))[0] == "L" for c in letters()])
    return _IS_LETTER


class Lines:
    """Letters, lines and chunks of some pages, as arrays."""

    def __init__(self, texts: list[str]):
        whole = "\n".join(expand(t) for t in texts)
        cp = np.frombuffer(whole.encode("utf-32-le", "replace"), dtype=np.uint32)
        per_page = np.array([t.count("\n") + 1 for t in texts])
        self.page = np.repeat(np.arange(len(texts)), per_page)
        self.line_no = np.arange(len(self.page)) - np.repeat(np.cumsum(per_page) - per_page, per_page) + 1
        fold = fold_letters(cp)
        at = np.flatnonzero(fold)
        line = np.cumsum(cp == 10)[at]
        n = len(self.page)
        count = np.bincount(line[_is_letter()[np.where(cp[at] < 0x10000, cp[at], ord("a"))]], minlength=n)
        keep = (count >= MIN_LETTERS)[line]
        self.seq, self.line = fold[at][keep].astype(np.uint64), line[keep]
        self.bounds = np.searchsorted(self.line, np.arange(n + 1))  # letters of a line
        self._chunk()

    def _chunk(self) -> None:
        seq, line, n = self.seq, self.line, len(self.seq)
        if not n:
            self.chunk_line, self.chunk = np.empty(0, np.int64), np.empty(0, np.int64)
            return
        rolled = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            rolled[k:] += seq[: n - k] * np.uint64(pow(31, k) + 7 * k)
        rolled = (rolled * _BASE) >> np.uint64(40)
        start = self.bounds[line]
        cut = (rolled % np.uint64(MEAN_CHUNK) == 0) & (np.arange(n) - start >= WINDOW - 1)
        last = np.append(line[1:] != line[:-1], True)
        # a line without a cut of its own is cut in the middle: one misread letter spares one half
        inner = np.bincount(line[cut & ~last], minlength=len(self.page))
        lone = np.unique(line[inner[line] == 0])
        cut[(self.bounds[lone] + self.bounds[lone + 1] - 1) // 2] = True
        ends = np.flatnonzero(cut | last) + 1
        starts = np.append(0, ends[:-1])
        power = np.cumprod(np.full(n, _BASE, np.uint64))
        total = np.append(np.uint64(0), np.cumsum(seq * power))
        inverse = np.cumprod(np.full(n, _INV, np.uint64))
        value = (total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)
        value ^= value >> np.uint64(29)
        self.chunk = (value * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
        self.chunk_line = line[starts]

    def keys(self, lines: np.ndarray) -> list[str]:
        """Letters of each of the lines."""
        whole = self.seq.astype("<u4").tobytes().decode("utf-32-le", "replace")
        return [whole[a:b] for a, b in zip(self.bounds[lines].tolist(), self.bounds[lines + 1].tolist(), strict=True)]


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("extraction_id").cast("long"), F.xxhash64("book_id").alias("book"), F.coalesce(F.col("page_number").cast("int"), F.lit(-1)).alias("page"), "text"
    ).where(F.col("book_id").isNotNull() & F.col("text").rlike(r"\S"))


_LINES = pa.schema([("book", pa.int64()), ("page", pa.int32()), ("extraction_id", pa.int64()), ("line_no", pa.int32()), ("key", pa.string()), ("chunks", pa.list_(pa.int64()))])


def chunked_lines(pages: DataFrame) -> DataFrame:
    """``book, page, extraction_id, line_no, key, chunks`` of each line with MIN_LETTERS letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 400):
                part = batch.slice(lo, 400)
                lines = Lines(part.column(3).to_pylist())
                own = np.unique(lines.chunk_line)
                at = lines.page[own]
                ends = np.searchsorted(lines.chunk_line, np.append(own, len(lines.page)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part.column(1).to_numpy()[at]), pa.array(part.column(2).to_numpy()[at], pa.int32()), part.column(0).take(pa.array(at)), pa.array(lines.line_no[own], pa.int32()),
                        pa.array(lines.keys(own), pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lines.chunk)),
                    ],
                    schema=_LINES,
                )

    return spread(_pages(pages)).mapInArrow(run, from_arrow_schema(_LINES))


def repeated_lines(pages: DataFrame) -> DataFrame:
    """``extraction_id, line_no`` of every line that stands on at least a tenth,
    and at least four, of its book's pages.

    Pages without book, or whose text is null, empty or blank, have no lines;
    pages without number count as one page.  Repeated rows and extractions
    count once a page, and each occurrence is a row.  Empty tables give none.
    """
    sizes = _pages(pages).groupBy("book", "page").agg(F.lit(1)).groupBy("book").agg(F.count("*").alias("pages"))
    sizes = staged(sizes.withColumn("least", F.greatest(F.lit(float(MIN_PAGES)), F.col("pages") * MIN_SHARE)).select("book", "least"), "books")
    whole = staged(chunked_lines(pages), "chunks")
    often = whole.select("book", F.explode("chunks").alias("chunk")).groupBy("book", "chunk").agg(F.count("*").alias("n")).where("n > 1")
    bits = hash_filter(often.join(sizes, "book").where("n >= greatest(2, least / 2)").select(F.col("book").bitwiseXOR(F.col("chunk")).alias("h")))
    own = F.transform("chunks", lambda x: x.bitwiseXOR(F.col("book")))
    lines = staged(passing(whole.select("book", "extraction_id", "page", "line_no", "key", own.alias("h")), "h", bits), "lines")
    per_key = lines.select("book", "key", "page").distinct().groupBy("book", "key").agg(F.count("*").alias("pages"))
    per_key = staged(per_key.join(sizes, "book"), "keys")
    # frequent keys of a book: at most twenty times the lines of a page; each meets the keys of like length
    centres = per_key.where("pages >= greatest(2, 0.75 * least)").select("book", F.col("key").alias("centre"), "least")
    centres = centres.withColumn("length", F.expr(f"explode(sequence(length(centre) - {MISREAD}, length(centre) + {MISREAD}))"))
    keys = per_key.select("book", "key", F.length("key").alias("length"))
    member = staged(keys.join(centres, ["book", "length"]).where(F.expr(f"key = centre or levenshtein(key, centre, {MISREAD}) >= 0")).drop("length"), "members")
    cases = lines.join(member, ["book", "key"])
    pages_of = cases.select("book", "centre", "least", "page").distinct().groupBy("book", "centre", "least").agg(F.count("*").alias("pages"))
    kept = pages_of.where("pages >= least").select("book", "centre")
    keys = member.join(kept, ["book", "centre"]).select("book", "key").distinct()
    return lines.join(keys, ["book", "key"]).select("extraction_id", "line_no").distinct()


def without_lines(pages: DataFrame, found: DataFrame) -> DataFrame:
    """``pages`` with the found lines cut out of ``text``."""
    per = found.groupBy("extraction_id").agg(F.collect_set("line_no").alias("_cut"))  # at most the lines of a page
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.coalesce(F.array_contains("_cut", (i + 1).cast("int")), F.lit(False)))
    return pages.join(per, "extraction_id", "left").withColumn("text", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))).drop("_cut")


def p1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return without_lines(pages, repeated_lines(pages)).select("extraction_id", "text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(table(spark, sf_dir, "pages"))
