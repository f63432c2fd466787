"""Problem 3: split oversized texts at natural boundaries.

Lexical cohesion: at every paragraph (or, where needed, sentence) boundary the
words of the block before are compared with those of the block after; the
depth of a similarity valley tells how much the topic changes there.  Within
each size window the deepest valley of the coarsest boundary kind is the cut.
The next piece starts up to ``overlap`` characters earlier, at a boundary.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import spread, table

KINDS = ("paragraph", "sentence", "word", "inside")
#: Words of a block on either side of a boundary, and characters that hold them.
BLOCK, REACH = 120, 800
#: A piece is at least this part of its window where a boundary allows.
LEAST = 0.7

_BLANK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
_SENTENCE = re.compile(r"[.!?।](?=\s)")
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"\w+").findall


class Cohesion:
    """Similarity of the blocks around the boundaries of one text."""

    def __init__(self, text: str):
        self.text = text

    def similarities(self, cuts: list[int]) -> list[float]:
        """Cosine of the word counts of the two blocks around each cut."""
        text, number, ids, at = self.text, {}, [], []
        edges = [max(0, cuts[0] - REACH), *cuts, cuts[-1] + REACH]
        for lo, hi in zip(edges, edges[1:], strict=False):
            ids += [number.setdefault(w, len(number)) for w in _WORDS(text[lo:hi].lower())]
            at.append(len(ids))
        seq, size, out = np.array(ids, dtype=np.int64), len(number), []
        for i in at[:-1]:
            a = np.bincount(seq[max(0, i - BLOCK) : i], minlength=size)
            b = np.bincount(seq[i : i + BLOCK], minlength=size)
            norm = int(a @ a) * int(b @ b)
            out.append(int(a @ b) / norm**0.5 if norm else 0.0)
        return out

    def deepest(self, cuts: list[int]) -> int:
        """The cut at the deepest valley; the last one among equals."""
        if len(cuts) == 1:
            return cuts[0]
        sims = self.similarities(cuts)
        best, depth = cuts[-1], -1.0
        for i, s in enumerate(sims):
            left = right = s
            for j in range(i - 1, -1, -1):
                if sims[j] < left:
                    break
                left = sims[j]
            for j in range(i + 1, len(sims)):
                if sims[j] < right:
                    break
                right = sims[j]
            if (d := left + right - 2 * s) >= depth:
                best, depth = cuts[i], d
        return best


class Cuts:
    """Offsets where a cut falls between paragraphs, sentences or words.

    Both ends of the white space between two units count, so that the blanks go
    with the unit that has room for them.  Finer kinds are looked for only in
    the stretch where they are needed.
    """

    def __init__(self, text: str):
        self.text = text
        self.paragraphs = sorted({x for m in _BLANK.finditer(text) for x in m.span()})
        self._sentences: list[int] | None = None

    @property
    def sentences(self) -> list[int]:
        if self._sentences is None:
            found = set(self.paragraphs)
            for m in _SENTENCE.finditer(self.text):
                found.update((m.end(), _SPACE.match(self.text, m.end()).end()))
            self._sentences = sorted(found)
        return self._sentences

    def words(self, after: int, to: int) -> list[int]:
        return [x for m in _SPACE.finditer(self.text, after, to + 1) for x in m.span() if after < x <= to]

    def between(self, kind: str, after: int, to: int) -> list[int]:
        if kind == "word":
            return self.words(after, to)
        here = self.paragraphs if kind == "paragraph" else self.sentences
        return here[bisect_right(here, after) : bisect_right(here, to)]

    def start(self, earliest: int, at: int) -> int:
        """First word boundary from ``earliest`` on, at most ``at``."""
        if earliest <= 0:
            return 0
        m = _SPACE.search(self.text, earliest - 1, at)
        return at if not m else m.start() if m.start() >= earliest else m.end()


def split(text: str, limit: int = 6000, overlap: int = 300) -> list[tuple[int, int, str]]:
    """(start, end, kind of the cut that ended it) of the pieces; the last kind is ''."""
    n = len(text)
    if n <= limit:
        return [(0, n, "")]
    cuts, cohesion = Cuts(text), Cohesion(text)
    pieces, at = [], 0  # ``at``: where the last piece ended
    while True:
        earliest = max(0, at - overlap) if pieces else 0
        start = cuts.start(earliest, at)
        if n - start <= limit:
            pieces.append((start, n, ""))
            return pieces
        if n - at <= limit and cuts.start(max(earliest, n - limit), at) >= n - limit:
            pieces.append((cuts.start(max(earliest, n - limit), at), n, ""))
            return pieces
        for kind in KINDS:
            if kind == "inside":
                end = start + limit
                break
            inside = cuts.between(kind, at, min(n - 1, start + limit))
            if inside:
                late = [c for c in inside if c - start >= LEAST * limit and not (c < n and text[c].isspace())]
                end = cohesion.deepest(late) if late else inside[-1]
                break
            # with a shorter overlap the boundary may still be within reach
            inside = cuts.between(kind, at, min(n - 1, at + limit))
            if inside:
                end = inside[0]
                start = cuts.start(max(earliest, end - limit), at)
                break
        pieces.append((start, end, kind))
        at = end


def pieces(df: DataFrame, id_col: str = "chapter_id", text_col: str = "body", limit: int = 6000, overlap: int = 300, with_text: bool = True) -> DataFrame:
    """Numbered pieces of each text longer than ``limit`` characters.

    Columns: ``id_col``, piece_no (from 1), start_char, end_char (offsets,
    end exclusive), overlap_chars (shared with the piece before), cut_kind
    (how the piece's end was found; null for the last) and, with ``with_text``,
    piece_text.  Null, empty and short texts give no rows; a text without any
    boundary is cut anywhere, its overlap then is as long as asked; repeated
    rows give repeated pieces; other columns are ignored.
    """
    fields = "id bigint, piece_no int, start_char int, end_char int, overlap_chars int, cut_kind string" + (", piece_text string" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in fields.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                cols: list[list] = [[] for _ in names]
                for key, text in zip(batch.column(0).slice(lo, 256).to_pylist(), batch.column(1).slice(lo, 256).to_pylist(), strict=True):
                    last = 0
                    for no, (a, b, kind) in enumerate(split(text, limit, overlap), 1):
                        row = (key, no, a, b, last - a if no > 1 else 0, kind or None, text[a:b])
                        last = b
                        for c, v in zip(cols, row, strict=False):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=False)], names)

    long = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.length("text") > limit)
    out = spread(long).mapInArrow(run, fields)
    return out.withColumnRenamed("id", id_col)


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(table(spark, sf_dir, "chapters"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters that had to be cut, with the finest cut the splitter needed."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("cut_kind"))
    cut = pieces(table(spark, sf_dir, "chapters"), with_text=False)
    worst = cut.groupBy("chapter_id").agg(F.max(rank).alias("r"))
    return worst.select("chapter_id", F.element_at(F.array(*map(F.lit, KINDS)), F.col("r").cast("int")).alias("finest_cut"))
