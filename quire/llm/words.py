"""Counts of the corpus' words and word pairs, and the repair of misread words.

An automaton of each doubtful word, with its reading errors and one plain edit,
is intersected with a trie of the vocabulary, which gives all candidates.  They
are ranked by how usual the reading error is, by frequency, and by the context:
how often the candidate stands beside the neighbours of the doubtful word, from
a sketch of the corpus' word pairs.  A candidate by a plain edit is taken only
where both neighbours speak for it.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import INVISIBLE, LOOKALIKE_FROM, LOOKALIKE_TO, expand, staged
from quire.llm.trie import build, search

#: A word of Latin, Devanagari or Tamil script as it may come from a scan, at most so many characters.
TOKEN, MAX_CHARS = re.compile(r"[A-Za-z0-9À-ÖØ-öø-ɏḀ-ỿ|!]+|[ऀ-ॣॱ-ॿ஀-௿]+"), 40
#: Words of one shard of the trie, doubtful words of one task.
SHARD, SLICE = 100_000, 50_000
#: Counters of the sketch of word pairs (4 bytes each), and how often both pairs of a plain edit are seen at least.
SLOTS, PAIR_LEAST = 1 << 20, 5
#: Least letters of a word that is repaired by a plain edit, and what the edit costs.
EDIT_LEAST, EDIT_COST = 5, 5.0
#: Words with at least this share of all words are frequent: at most 1 / share of them.
FREQUENT = 1e-5
#: A vocabulary word is seen at least so often, whatever the size of the corpus.
MIN_COUNT = 4
#: A misreading is seen once, or at most in this part of the word's places.
MISREAD_RATE = 0.01
#: What one reading error costs a candidate, in logarithms of its frequency.
SWAP_COST = 3.0
#: Usual reading errors, "meant>seen".
CONFUSIONS = (
    "e>c e>é t>f a>ci n>ri n>u d>cl u>ii m>rn h>li h>b v>y b>h in>m w>vv r>í rn>m li>h r>k e>f l>i h>ii "
    "i>1 i>! i>| l>1 l>| l>! o>0 s>5 g>9 a>4 ti>d"
).split()

#: A compound within a line; hyphens at line ends.
COMPOUND = re.compile(r"(?<![\w-])[A-Za-z]{2,20}-[A-Za-z]{2,20}(?![\w-])")
HYPHENS = "-‐‑­"
_SPECIAL = re.compile("[" + LOOKALIKE_FROM + INVISIBLE + "！-～]")
_FOLD = str.maketrans(dict(zip(LOOKALIKE_FROM, LOOKALIKE_TO, strict=True)) | {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)})
#: Digits read as letters: a number in which a letter stands for a digit.
NUMBER = re.compile(r"(?=.*[0-9lOI|])(?=.*[lOI|])[0-9lOI|]{2,}")


def fold(text: str) -> str:
    """Look-alike and full-width forms as plain letters; for tokens only."""
    if text.isascii():
        return text
    text = expand(text)
    return unicodedata.normalize("NFC", text.translate(_FOLD)) if _SPECIAL.search(text) else text


def token(raw: str) -> str:
    return raw.strip("|!").lower() if raw[-1] in "|!" or raw[0] in "|!" else raw.lower()


def plain(word: str) -> bool:
    """Whether a word is in lower case or of a script without case: not marked as a name."""
    return word.islower() and word.isalpha() or "ऀ" <= word <= "௿\uffff"


def slot(a: str, b: str) -> int:
    """Counter of a pair of words."""
    return zlib.crc32(f"{a} {b}".encode()) & (SLOTS - 1)


def swaps() -> dict[str, list[tuple[str, str]]]:
    out: dict[str, list[tuple[str, str]]] = {}
    for pair in CONFUSIONS:
        meant, seen = pair.split(">")
        out.setdefault(seen[0], []).append((seen, meant))
    return out


def undivided(text: str) -> str:
    """Without the parts of words divided at line ends, which are no words."""
    for mark in HYPHENS:
        if (end := mark + "\n") in text:
            first, *rest = text.split(end)
            parts = [first.rsplit(None, 1)[0] if len(first.split(None, 1)) > 1 else ""]
            for i, p in enumerate(rest):
                words = p.split(None, 1)
                p = words[1] if len(words) > 1 else ""
                parts.append((p.rsplit(None, 1)[0] if len(p.split(None, 1)) > 1 else "") if i < len(rest) - 1 else p)
            text = " ".join(parts)
    return text


def word_counts(texts: DataFrame, pairs: bool = False) -> DataFrame:
    """``token, n`` over the distinct texts of the first column; tokens hold a letter.

    Further columns, if any, name the page of a text: of the texts of one page a
    token counts as often as in the one that has it most, so neither copies nor
    repeated extractions make a misreading frequent.  Texts whose page has a null
    stand for themselves; a text that stands on several pages goes with one of
    them.  Runs without white space are counted first; each distinct one is folded
    and cut into tokens once.

    With ``pairs`` also ``low`` (how often the token is no name by its case) and rows of
    ``slot, n`` without token: counters of the pairs of plain words.
    """
    text, *page = texts.columns
    own = F.xxhash64(text)
    unit = F.when(reduce(or_, map(F.isnull, page)), own).otherwise(F.xxhash64(*page)) if page else own
    # the texts of a page come together, equal texts on one of their pages only
    src = texts.where(F.col(text) != "").select(text, unit.alias("unit"))
    rows = src.repartition("unit")
    if page:
        home = src.groupBy(own.alias("own")).agg(F.min("unit").alias("unit")).groupBy("unit").agg(F.collect_set("own").alias("homes"))  # the extractions of a page
        rows = rows.join(home, "unit").where(F.array_contains("homes", own)).select(text, "unit")
    rows = rows.sortWithinPartitions("unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        now, held = None, []
        pages: Counter = Counter()  # tokens of pages with several texts
        beside: Counter = Counter()

        def close() -> None:
            if len(held) == 1:
                total.update(undivided(held[0]).split())
            elif held:
                most: Counter = Counter()
                for t in held:
                    most |= _tokens(Counter(undivided(t).split()))
                pages.update(most)
            if pairs and held:
                words = [w if plain(w) else "" for w in undivided(held[0]).split()]
                beside.update(zip(words, words[1:], strict=False))

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                for t, u in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if u != now:
                        close()
                        now, held = u, []
                    if t not in held:
                        held.append(t)
            if len(total) + len(pages) + len(beside) > 400_000:  # bounded memory: what is counted so far goes on
                yield from _counted(total, pages, beside, pairs)
                total.clear()
                pages.clear()
                beside.clear()
        close()
        yield from _counted(total, pages, beside, pairs)

    if not pairs:
        return rows.mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return rows.mapInArrow(run, "token string, slot int, n bigint, low bigint").groupBy("token", "slot").agg(F.sum("n").alias("n"), F.sum("low").alias("low"))


def _tokens(runs: Counter) -> Counter:
    """Tokens of runs, as (token, whether it is plain)."""
    low: Counter = Counter()
    for raw, n in runs.items():
        text = fold(raw)
        for w in TOKEN.findall(text) + (COMPOUND.findall(text) if "-" in text else []):
            if len(w) <= MAX_CHARS and not w.isdigit() and (t := token(w)):
                low[t, w[:1] == t[:1] and not w[:1].isdigit()] += n
    return low


def _counted(total: Counter, pages: Counter, beside: Counter, pairs: bool) -> Iterator[pa.RecordBatch]:
    both = _tokens(total)
    both.update(pages)
    n: dict[str, int] = {}
    for (t, _), k in both.items():
        n[t] = n.get(t, 0) + k
    names, counts = pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())
    if not pairs:
        yield pa.RecordBatch.from_arrays([names, counts], ["token", "n"])
        return
    low = pa.array([both.get((t, True), 0) for t in n], pa.int64())
    yield pa.RecordBatch.from_arrays([names, pa.nulls(len(n), pa.int32()), counts, low], ["token", "slot", "n", "low"])
    slots: Counter = Counter()
    for (a, b), k in beside.items():
        if a and b:
            slots[slot(a, b)] += k
    m = len(slots)
    yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.string()), pa.array(list(slots), pa.int32()), pa.array(list(slots.values()), pa.int64()), pa.nulls(m, pa.int64())], ["token", "slot", "n", "low"])


def _heads(word: str, pairs: dict[str, list[tuple[str, str]]], most: int) -> set[str]:
    """First two characters that a word may mean with at most ``most`` reading errors."""
    out, stack = set(), [("", 0, 0)]
    while stack:
        head, i, used = stack.pop()
        if len(head) >= 2 or i >= len(word):
            out.add(head[:2])
            continue
        stack.append((head + word[i], i + 1, used))
        if used < most:
            stack.extend((head + meant, i + len(seen), used + 1) for seen, meant in pairs.get(word[i], ()) if word.startswith(seen, i))
    return out


def most_swaps(word: str) -> int:
    return 1 if len(word) < 5 else 2


def corrections(counts: DataFrame) -> DataFrame:
    """``token, word, swaps, edits, word_n, others`` of tokens that may be misreadings of a far more frequent word.

    ``others`` holds every candidate, ``word`` is the best by reading errors and
    frequency.  Candidates by a plain edit are sought for tokens that are no
    names by their case (``low``, where counts have it).

    The trie is cut into shards by the first two characters of its words, and
    again by the last two.  A token goes to the shards of the first characters
    it may mean by reading errors, and, as an edit may change these, to the shard
    of its last two; so all candidates are found whatever the size of either.
    No task holds more than about SHARD words and SLICE tokens.
    """
    spark = counts.sparkSession
    if "low" not in counts.columns:
        counts = counts.withColumn("low", F.col("n"))
    vocabulary = counts.where(F.col("n") >= MIN_COUNT).where(F.col("token").rlike(r"^[^0-9|!-]{3,}$"))
    known, most = vocabulary.agg(F.count("*"), F.max("n")).first()
    # what is as frequent as every word it might stand for is no misreading
    doubtful = counts.where(F.col("token").rlike(r"^.*\p{L}.*$")).where("length(token) >= 3 and token not like '%-%'").where(F.col("n") <= 1 + MISREAD_RATE * (most or 0))
    shards = max(8, -(-2 * known // SHARD))
    salts = max(1, -(-4 * doubtful.count() // (SLICE * shards)))
    group = lambda key: zlib.crc32(key.encode()) % shards
    pairs = swaps()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(w, n, g) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for g in {group("^" + w[:2]), group(w[-2:] + "$")}]
            yield _groups(out)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for w, n, low in zip(*[c.to_pylist() for c in b.columns], strict=True):
                edit = low and len(w) >= EDIT_LEAST
                keys = {group("^" + h) for h in _heads(w, pairs, most_swaps(w))} | ({group(w[-2:] + "$")} if edit else set())
                out += [(w, n if edit else -n, g) for g in keys]
            yield _groups(out)

    v = vocabulary.select("token", "n").mapInArrow(words, "token string, n bigint, shard int").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    d = doubtful.select("token", "n", "low").mapInArrow(tokens, "token string, n bigint, shard int").withColumn("salt", F.pmod(F.xxhash64("token"), F.lit(salts)).cast("int"))

    def run(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        freq = dict(zip(right["token"], right["n"].astype(int), strict=True))
        trie, rows = build(freq), []
        for w, n in zip(left["token"], left["n"].astype(int), strict=True):
            edit, n = n > 0, abs(n)
            for cand, (edits, used) in search(trie, w, pairs, most_swaps(w), int(edit)).items():
                m = freq[cand]
                if cand != w and (n <= MISREAD_RATE * m if edits else used and n <= 1 + MISREAD_RATE * m):
                    rows.append((w, cand, used, edits, m, math.log(m) - SWAP_COST * used - EDIT_COST * edits))
        return pd.DataFrame(rows, columns=["token", "word", "swaps", "edits", "word_n", "score"])

    out = d.groupBy("shard", "salt").cogroup(v.groupBy("shard", "salt")).applyInPandas(run, "token string, word string, swaps int, edits int, word_n bigint, score double")
    # the words within reach of one token
    best = out.groupBy("token").agg(F.max_by(F.struct("word", "swaps", "edits", "word_n"), F.struct(-F.col("edits"), F.col("score"), F.col("word"))).alias("b"), F.collect_set(F.struct("word", "edits", "score")).alias("others"))
    return best.select("token", "b.*", "others")


def _groups(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
    w, n, g = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(n, pa.int64()), pa.array(g, pa.int32())], ["token", "n", "shard"])


def choose(others: list[dict], before: str, after: str, sketch: np.ndarray) -> str | None:
    """The candidate that fits best between its neighbours ('' where there is none or it is a name)."""
    best = None
    for c in others:
        a = int(sketch[slot(before, c["word"])]) if before else 0
        b = int(sketch[slot(c["word"], after)]) if after else 0
        if c["edits"] and min(a, b) < PAIR_LEAST:
            continue
        rank = (-c["edits"], c["score"] + math.log1p(a) + math.log1p(b), c["word"])
        if best is None or rank > best:
            best = rank
    return best and best[2]


def sketch_of(counts: DataFrame) -> np.ndarray:
    """The counters of word pairs: SLOTS numbers, whatever the corpus."""
    out = np.zeros(SLOTS, np.int32)
    got = counts.where("slot is not null").select("slot", F.least("n", F.lit((1 << 31) - 1)).cast("int").alias("n")).toPandas()
    out[got["slot"].to_numpy(int)] = got["n"].to_numpy(int)
    return out


def frequent(counts: DataFrame, fixes: DataFrame) -> list[str]:
    """Frequent words that are no misreadings: at most 1 / FREQUENT of them."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = F.when(F.col("token").contains("-"), 1.0).otherwise(float(MIN_COUNT))
    often = counts.where(F.col("n") >= F.greatest(least, F.lit(total * FREQUENT))).join(fixes.select("token"), "token", "left_anti")
    return [r[0] for r in often.select("token").collect()]


def lexicon(texts: DataFrame) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Counts, corrections and pair counters of texts (see ``word_counts``); the tables are written out once."""
    both = staged(word_counts(texts, pairs=True), "words")
    counts = both.where("token is not null").drop("slot")
    return counts, staged(corrections(counts), "fixes"), sketch_of(both)
