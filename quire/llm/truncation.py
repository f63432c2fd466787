"""Problem 6: extractions that were cut off, and how often each source cuts.

Intact texts are cut artificially: at a random place as in a broken transfer (at
times inside a character), or at a place that then counts as the limit of its
source or of the client.  A hashed logistic regression learns what a cut looks
like from the closing characters, the last word and line, the room left on that
line for the first word of the next page, missing page furniture, the length
relative to the book, the limit of the source (a length on which its texts pile
up), longer extractions of the same page and the client's report.  One threshold
decides: the share of cut rows is estimated by expectation maximisation over the
histogram of the scores, and a row is cut if the corrected probability says so.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from quire.llm.common import spread, staged, table
from quire.llm.residue import ERRORS, FILLER_PHRASES, NOTICES, SHORT
from quire.llm.scans import _PAGE_NUMBER, key_of, titled
from quire.llm.words import TOKEN, fold, frequent, token, word_counts

#: Hashed features; intact rows of the fit, about; parts of the fit,
#: each scored by a fit of the others.
FEATURES, FIT_ROWS, FOLDS = 1 << 15, 20_000, 3
#: Rows of a fit, and characters of a text that is cut artificially, at least.
FIT_LEAST, CUT_LEAST = 100, 12
#: Pages on which a line of an edge stands at least to be furniture.
FOOT_PAGES = 4
#: An extraction has a longer one of its page if it is shorter than this part of it.
SIBLING = 0.97
#: Distinct texts that end at a source's limit at least, and times the usual number at a length.
LIMIT_TEXTS, LIMIT_TIMES = 5, 8
#: What a limit may count; so many bytes of a divided character are lost besides.
MEASURES, LIMIT_SLACK = ("chars", "size"), 3
#: First lines of a page among which its body starts.
HEADS = 4

_ENDS = {".": "stop", "!": "stop", "?": "stop", "।": "stop", "”": "quote", '"': "quote", ",": "comma", ";": "comma", ":": "comma", "-": "hyphen", "‐": "hyphen", "—": "dash", "�": "broken", "|": "bar", ")": "close", "]": "close", ">": "close"}
_LAST_WORD = re.compile(r"(\S+)\s*$")


class Closing(NamedTuple):
    """What the end of a text looks like."""

    chars: int
    size: int  #: bytes
    lines: int
    end: str  #: kind of the last character, and signs left open
    word: str  #: kind of the last word
    share: int  #: tenths of the widest line that the last one fills
    width: int
    room: int  #: characters that a full line has more than the last one
    number: int
    last: str  #: letters of the last line


def closing(text: str, often: set[str]) -> Closing:
    body = text.rstrip()
    lines = [x for x in body.split("\n") if x.strip()]
    last = lines[-1] if lines else ""
    lengths = sorted(map(len, lines)) or [0]
    width, full = lengths[-1], lengths[len(lengths) * 4 // 5 if len(lengths) > 4 else -1]
    ch = body[-1] if body else ""
    end = _ENDS.get(ch) or ("letter" if ch.isalpha() else "digit" if ch.isdigit() else "mark" if ch else "none")
    m = _LAST_WORD.search(body)
    raw = fold(m.group(1)) if m else ""
    tokens = TOKEN.findall(raw)
    if not tokens:
        word = "other"
    else:
        w = token(tokens[-1])
        word = "number" if w.isdigit() else "known" if w in often else "short" if len(w) < 3 else "unknown"
    number = int(len(last) <= 24 and bool(_PAGE_NUMBER.fullmatch(fold(last).strip())))
    share = min(10, 10 * len(last) // width) if width else 0
    signs = "".join(s for s, x in (("q", last.count("“") - last.count("”")), ("b", last.count("[") - last.count("]")), ("p", last.count("(") - last.count(")")), ("t", last.startswith("|") and not last.endswith("|"))) if x > 0)
    return Closing(len(text), len(text.encode("utf-8", "replace")), len(lines), end + signs, word, share, width, full - len(last), number, key_of(last))


def openings(text: str, often: set[str]) -> list[dict]:
    """The first HEADS lines of a page that are no page number: letters, kind of start, first word and its length."""
    out: list[dict] = []
    for line in text.split("\n"):
        plain = fold(line).strip()
        if not plain or len(plain) <= 24 and _PAGE_NUMBER.fullmatch(plain):
            continue
        first = plain.split(None, 1)[0]
        ch = plain.lstrip("“\"'([")[:1]
        kind = "head" if plain.startswith(("#", "|", "[")) or titled(plain) else "lower" if ch.islower() else "upper" if ch.isupper() else "digit" if ch.isdigit() else "plain" if ch.isalpha() else "other"
        word = "".join(c for c in first if c.isalpha())
        out.append({"key": key_of(plain), "kind": kind, "word": word if word.lower() in often else "", "first": len(first)})
        if len(out) == HEADS:
            break
    return out


def _artificial(text: str, h: int) -> tuple[str, bool, str]:
    """A cut text, whether its length counts as a limit, and what the client says of it."""
    way = h // 7 % 10
    as_limit = way in (0, 1, 5)
    least = len(text) * (9 if way else 6) // 10 if as_limit else CUT_LEAST // 2  # most texts are little longer than a limit of their source
    part = text[: least + h % (len(text) - least)]
    if way == 4:  # the rest of a character came, no more
        return part + "\ufffd", False, "regular"
    return part, as_limit, ("limit", "none", "other")[way - 7] if way > 6 else "regular"


_CLOSINGS = pa.schema(
    [
        ("extraction_id", pa.int64()), ("book_id", pa.string()), ("page_number", pa.int32()), ("page_type", pa.string()), ("message", pa.bool_()), ("text_hash", pa.int64()), ("h", pa.int64()), ("cut", pa.int32()), ("as_limit", pa.bool_()), ("said", pa.string()),
        ("chars", pa.int32()), ("size", pa.int32()), ("lines", pa.int32()), ("end", pa.string()), ("word", pa.string()), ("share", pa.int32()), ("width", pa.int32()), ("room", pa.int32()), ("number", pa.int32()), ("last", pa.string()),
        ("heads", pa.list_(pa.struct([("key", pa.string()), ("kind", pa.string()), ("word", pa.string()), ("first", pa.int32())]))),
    ]
)


def _closings(rows: DataFrame, often: list[str]) -> DataFrame:
    """Closing features of each row, and of each row with ``h`` cut once."""
    known = rows.sparkSession.sparkContext.broadcast(often)  # at most 1 / FREQUENT words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = set(known.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part, out = batch.slice(lo, 500), []
                for e, b, p, kind, message, own, h, t in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    out.append((e, b, p, kind, message, own, h, 0, False, None, *closing(t, words), openings(t, words)))
                    if h is not None and len(t) > CUT_LEAST and not message:
                        cut, as_limit, said = _artificial(t, h)
                        out.append((e, b, p, kind, message, own, h, 1, as_limit, said, *closing(cut, words), []))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _CLOSINGS, strict=True)], schema=_CLOSINGS)

    return rows.mapInArrow(run, from_arrow_schema(_CLOSINGS))


def reports(responses: DataFrame) -> DataFrame:
    """``extraction_id, reason``: regular, limit, other or none, of the last transcription."""
    said = F.lower(F.coalesce("stop_reason", "finish_reason", F.lit("")))
    kind = F.when(said.rlike(r"max_tokens|length"), "limit").when(said.rlike(r"(^|\.)(stop|end_turn|stop_sequence)$"), "regular").when(said == "", "none").otherwise("other")
    last = responses.where("purpose = 'transcribe' and extraction_id is not null")
    return last.groupBy(F.col("extraction_id").cast("long").alias("extraction_id")).agg(F.max_by(kind, F.struct(F.coalesce("attempt", F.lit(0)), "received_at")).alias("reason"))


def limits(lengths: DataFrame) -> DataFrame:
    """``source, measure, value``: where a source's distinct texts pile up in characters
    or bytes, with fewer texts of the source beyond; of rows with source, chars, size and text_hash."""
    measures = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])).alias("m")
    per = lengths.where("source is not null").select("source", "text_hash", measures).select("source", "text_hash", "m.*").distinct().groupBy("source", "measure", "value").agg(F.count("*").alias("n"))
    by = Window.partitionBy("source", "measure").orderBy("value")  # one row a length
    usual = (F.sum("n").over(by.rangeBetween(-100, 100)) - F.col("n")) / 200
    beyond = F.coalesce(F.sum("n").over(by.rangeBetween(LIMIT_SLACK + 1, Window.unboundedFollowing)), F.lit(0))
    per = per.withColumns({"usual": usual, "beyond": beyond})
    return per.where((F.col("n") >= LIMIT_TEXTS) & (F.col("n") >= LIMIT_TIMES * F.greatest("usual", F.lit(0.25))) & (F.col("beyond") < F.col("n"))).select("source", "measure", "value")


def _features() -> Column:
    """Names of a row's features, hashed."""
    s = lambda *cols: F.concat_ws("|", *[F.lit(x[1:]) if isinstance(x, str) and x[0] == "=" else F.col(x) if isinstance(x, str) else x for x in cols])
    size = F.least(F.lit(12), F.floor(10 * F.try_divide("chars", "usual_chars"))).cast("string")
    rows = F.least(F.lit(12), F.floor(10 * F.try_divide("lines", "usual_lines"))).cast("string")
    short = F.greatest(F.lit(-6), F.least(F.lit(2), F.col("lines") - F.col("usual_lines"))).cast("string")
    foot = F.when(F.col("number") == 1, "number").when(F.col("foot"), "foot").otherwise("none")
    often = F.floor(F.col("foot_share") * 5).cast("string")
    narrow = F.least(F.lit(12), F.floor(10 * F.try_divide("width", "usual_width"))).cast("string")
    after = F.coalesce("next_kind", F.lit("none"))
    room = F.col("room") - 1 - F.coalesce("next_first", F.lit(5))
    fits = F.when(room < -4, "a").when(room < 0, "b").when(room < 3, "c").when(room < 7, "d").when(room < 16, "e").otherwise("f")
    plain = F.when(F.col("foot") | (F.col("number") == 1), "foot").otherwise(F.col("end"))
    names = [
        s("=e", "end"), s("=w", "word"), s("=ew", "end", "word"), s("=f", foot, often), s("=es", "end", "share"), s("=efo", "end", foot, often),
        s("=er", "end", rows), s("=ec", "end", size), s("=ews", "end", "word", "share"), s("=fs", foot, often, "share"), s("=fr", foot, often, rows), s("=n", narrow, "share"),
        s("=eso", "end", "share", foot, often), s("=t", "page_type", "end"), s("=tp", "page_type", "word", size), s("=p", "page_type", foot, often, rows),
        s("=a", plain, after), s("=b", plain, fits), s("=ab", plain, after, fits), s("=awf", plain, after, "word", fits), s("=sf", plain, short, fits), s("=sfo", plain, often, short, after),
        s("=x", plain, F.coalesce("next_word", F.lit("")), after), s("=xf", plain, F.coalesce("next_word", F.lit("")), fits),
        s("=l", F.col("at_limit").cast("string")), s("=la", F.col("at_limit").cast("string"), plain), s("=r", "reason"), s("=rp", "reason", plain), s("=h", F.col("shorter").cast("string")), s("=hp", F.col("shorter").cast("string"), plain), s("=m", F.col("message").cast("string")),
    ]
    return F.array(*[F.pmod(F.xxhash64(F.coalesce(x, F.lit(""))), F.lit(FEATURES)).cast("int") for x in names])


def train(index: np.ndarray, label: np.ndarray, steps: int = 300, rate: float = 0.5, penalty: float = 2e-5) -> np.ndarray:
    """Weights of a logistic regression over hashed features; the last is the bias."""
    w = np.zeros(FEATURES + 1)
    grad2 = np.full(FEATURES + 1, 1e-8)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(w[index].sum(1) + w[-1], -30, 30)))
        err = (p - label) / len(label)
        g = np.bincount(index.ravel(), np.repeat(err, index.shape[1]), FEATURES + 1)
        g[-1] = err.sum()
        g[:-1] += penalty * w[:-1]
        grad2 += g * g
        w -= rate * g / np.sqrt(grad2)
    return w


def prior(counts: np.ndarray, centres: np.ndarray, rounds: int = 200) -> float:
    """Share of positives among rows whose scores, of a fit with equal classes, have this histogram."""
    share = 0.5
    for _ in range(rounds):
        up, down = share * centres, (1 - share) * (1 - centres)
        share = float((counts * up / (up + down)).sum() / max(1, counts.sum()))
    return share


def features(pages: DataFrame, books: DataFrame, responses: DataFrame) -> DataFrame:
    """A row of features of each extraction with a text (cut = 0), and of the artificially cut ones (cut = 1)."""
    spark = pages.sparkSession
    src = books.groupBy("book_id").agg(F.max("source").alias("source"))
    total = max(1, pages.select("extraction_id").count())
    chosen = F.pmod(F.xxhash64("extraction_id"), F.lit(1 << 30)) < F.lit(int(min(1.0, FIT_ROWS / total) * (1 << 30)))
    # a message or filler in place of the page is whole, however it ends
    message = (F.length("raw_text") <= SHORT) & (F.col("raw_text").rlike(ERRORS) | F.col("raw_text").rlike(NOTICES) | F.col("raw_text").rlike(FILLER_PHRASES))
    rows = pages.where(F.col("raw_text").rlike(r"\S")).select(
        F.col("extraction_id").cast("long"), "book_id", F.col("page_number").cast("int"), F.coalesce("page_type", F.lit("")).alias("page_type"), message.alias("message"), F.xxhash64("raw_text").alias("own"),
        F.when(chosen & ~F.coalesce("page_type", F.lit("")).isin("blank", "error"), F.pmod(F.xxhash64("extraction_id", F.lit(5)), F.lit(1_000_003 * 7))).alias("h"), "raw_text",
    )
    counts = staged(word_counts(pages.select("raw_text", "book_id", "page_number")), "words")
    often = frequent(counts, spark.createDataFrame([], "token string"))
    c = staged(_closings(spread(rows), often), "closings")
    # lines that stand at the edge of a book's pages again and again
    whole = c.where("cut = 0").dropDuplicates(["extraction_id"])
    heads = whole.select("extraction_id", "book_id", "page_number", F.posexplode("heads").alias("at", "line")).select("extraction_id", "book_id", "page_number", "at", "line.*")
    edge = heads.select("book_id", "key", "page_number").unionByName(whole.select("book_id", F.col("last").alias("key"), "page_number"))
    fixed = staged(edge.where("length(key) >= 4").distinct().groupBy("book_id", "key").agg(F.count("*").alias("n")).where(f"n >= {FOOT_PAGES}").select("book_id", "key"), "edges")
    body = heads.join(fixed, ["book_id", "key"], "left_anti").where("page_number is not null")
    follows = body.groupBy("book_id", (F.col("page_number") - 1).alias("page_number")).agg(F.min_by(F.struct(F.col("kind").alias("next_kind"), F.col("word").alias("next_word"), F.col("first").alias("next_first")), F.struct(-F.col("extraction_id"), "at")).alias("next"))
    follows = follows.select("book_id", "page_number", "next.*")
    marked = c.drop("heads").join(fixed.select("book_id", F.col("key").alias("last"), F.lit(True).alias("foot")), ["book_id", "last"], "left").withColumn("foot", F.coalesce("foot", F.lit(False))).drop("last")
    marked = staged(marked.join(src, "book_id", "left"), "marked")
    limit = staged(limits(marked.where("cut = 0")), "limits")
    for m in MEASURES:  # a few lengths a source
        at = limit.where(F.col("measure") == m).select("source", F.col("value").alias(m), F.lit(True).alias(f"{m}_limit"))
        marked = marked.join(at, ["source", m], "left")
    marked = marked.withColumn("at_limit", F.expr(" or ".join(f"coalesce({m}_limit, false)" for m in MEASURES)))
    longest = marked.where("cut = 0 and page_number is not null").groupBy("book_id", "page_number").agg(F.max("chars").alias("longest"), F.count_distinct("extraction_id").alias("n")).where("n > 1").drop("n")
    usual = marked.where("cut = 0").groupBy("book_id").agg(
        F.percentile_approx("chars", 0.5, 200).alias("usual_chars"), F.percentile_approx("lines", 0.5, 200).alias("usual_lines"),
        F.percentile_approx("width", 0.5, 200).alias("usual_width"), F.avg((F.col("foot") | (F.col("number") == 1)).cast("double")).alias("foot_share"),
    )
    # a null book has sizes of its own, as any other
    x = marked.join(usual.withColumnRenamed("book_id", "of"), F.col("book_id").eqNullSafe(F.col("of"))).drop("of")
    x = x.join(reports(responses), "extraction_id", "left").join(longest, ["book_id", "page_number"], "left").join(follows, ["book_id", "page_number"], "left")
    x = x.withColumns({
        "at_limit": F.coalesce(F.when(F.col("cut") == 1, F.col("as_limit")).otherwise(F.col("at_limit")), F.lit(False)), "reason": F.coalesce("said", "reason", F.lit("none")),
        "shorter": F.coalesce(F.col("chars") < SIBLING * F.col("longest"), F.lit(False)),
    })
    return x.select("extraction_id", "source", "cut", F.pmod(F.floor(F.col("h") / 70), F.lit(FOLDS)).cast("int").alias("fold"), "reason", "at_limit", "shorter", _features().alias("f"))


def fitted(x: DataFrame) -> tuple[np.ndarray, np.ndarray, dict]:
    """(weights by fold and of all, share of cut rows apart from limits and at them, report): recall and false alarms on rows that the fit hasn't seen.

    The fit takes about FIT_ROWS extractions, each also cut once.  Those that end at
    a source's limit or that the client reports as cut at its own count as cut;
    others of which the client reports no regular end, or that have a longer
    extraction, aren't sure to be whole and are left out.
    """
    label = F.expr("case when cut = 1 or at_limit or reason = 'limit' then 1 when reason = 'regular' and not shorter then 0 end").alias("cut")
    sample = x.where("fold is not null").select(label, "f", "fold").where("cut is not null").toPandas()  # about 2 * FIT_ROWS
    w = np.zeros((FOLDS + 1, FEATURES + 1))
    report: dict = {}
    if len(sample) >= FIT_LEAST and sample["cut"].nunique() == 2:
        f, y, fold = np.array(sample["f"].tolist()), sample["cut"].to_numpy(float), sample["fold"].to_numpy()
        for k in range(FOLDS):
            if len(set(y[fold != k])) == 2:
                w[k] = train(f[fold != k], y[fold != k])
        w[FOLDS] = w[:FOLDS].mean(0)
        p = probability(w, f, fold)
        report = {"rows": len(y), "recall": float((p[y == 1] > 0.5).mean()), "false_alarms": float((p[y == 0] > 0.5).mean())}
    # the share of cut rows is estimated apart for texts that end at a limit
    bins, share = 500, np.full(2, 0.5)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, bins), np.int64)
        for b in batches:
            at = np.minimum((probability(w, _matrix(b.column(0)), _folds(b.column(1))) * bins).astype(int), bins - 1)
            n += np.bincount(at + bins * _flags(b.column(2)), minlength=2 * bins).reshape(2, bins)
        yield pa.RecordBatch.from_arrays([pa.array(list(range(2 * bins)), pa.int32()), pa.array(n.ravel())], ["bin", "n"])

    rows = x.where("cut = 0").select("f", "fold", "at_limit").mapInArrow(histogram, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).collect()  # 1000 rows
    n = np.zeros(2 * bins)
    for r in rows:
        n[r["bin"]] = r["n"]
    if w.any():
        share = np.array([prior(k, (np.arange(bins) + 0.5) / bins) if k.sum() else 0.5 for k in n.reshape(2, bins)])
    return w, share, report


def _flags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(int)


def _folds(column: pa.Array) -> np.ndarray:
    return column.fill_null(FOLDS).to_numpy(zero_copy_only=False)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def probability(w: np.ndarray, f: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Of each row by the weights of its fold (FOLDS: of all folds)."""
    if not len(f):
        return np.zeros(0)
    z = w[fold[:, None], f].sum(1) + w[fold, -1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scores(pages: DataFrame, books: DataFrame, responses: DataFrame) -> DataFrame:
    """``extraction_id, source, score, reason, at_limit, is_cut`` of each extraction with a text.

    ``score`` is the probability of a cut.  Null and empty raw_text has no row.
    Extractions without responses count as reported "none"; books without source
    have no limit; repeated rows count once.  Where less than FIT_LEAST rows
    can be fitted, only the client's report of a limit counts.
    """
    x = staged(features(pages, books, responses), "features")
    w, share, _ = fitted(x)
    known = x.sparkSession.sparkContext.broadcast((w, share))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, share = known.value
        for b in batches:
            p = probability(w, _matrix(b.column(0)), _folds(b.column(1)))
            s = share[_flags(b.column(5))]
            p = s * p / (s * p + (1 - s) * (1 - p))
            if not w.any():
                p = np.array([float(r == "limit") for r in b.column(4).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(p), *b.columns[2:]], ["score", "extraction_id", "source", "reason", "at_limit"])

    out = x.where("cut = 0").select("f", "fold", "extraction_id", "source", "reason", "at_limit").mapInArrow(score, "score double, extraction_id bigint, source string, reason string, at_limit boolean")
    return out.groupBy("extraction_id").agg(*[F.max(c).alias(c) for c in ("source", "score", "reason", "at_limit")]).withColumn("is_cut", F.col("score") >= 0.5)


def _of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "pages"), table(spark, sf_dir, "books"), table(spark, sf_dir, "model_responses"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir).where("is_cut").select("extraction_id").distinct()


def p6_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of cut extractions of each source, among extractions with a text."""
    s = _of(spark, sf_dir).groupBy("source").agg(F.count("*").alias("extractions"), F.count_if("is_cut").alias("cut"))
    return s.withColumn("share", F.col("cut") / F.col("extractions"))
