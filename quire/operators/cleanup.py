"""Line filters and publication form: signatures, stamps, scan noise, headings, verse and quotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.duck import CURRENT, LINES, has, keyword, rep, strip
from quire.operators.maps import blocks, numbered_lines
from quire.sources.tables import latest, table

SIGNATURE = r"(?m)^[^\S\n]*(?:\d{1,4}|[IVXLCDM]{1,6})\s{2,}[A-Z](?:\s+\d+)?\s+([a-z])"
# Words of library stamps and cards.
LIBRARY = (
    r"(?i)\b(?:loan\s+dept\.?|general\s+library|univ\.?\s+of\s+california|university\s+of\s+california|berkeley\s+libraries|return\s+to\s+desk"
    r"|due\s+on\s+the\s+last\s+date\s+stamped|acc(?:ession)?\.?\s*no\.?|class\s*no\.?|st\.\s*card|bk\.\s*card|checked|library\s*stamp)\b"
)
# Marks of a loan slip.
SLIP = (
    "loan dept", "return to desk from which borrowed", "due on the last date stamped below", "renewed books are subject to immediate recall", "general library",
    "university of california", "u. c. berkeley libraries", "uc berkeley libraries",
)
#: Labels of eras, regnal years and circa dates that stand alone in a margin.
MARGINAL = (
    r"(?i)^(?:(?:a\s*[.;:]?\s*d\s*\.?|b\s*[.;:]?\s*c\s*\.?|a\s*[.;:]?\s*h\s*\.?|hijri|hijrah|hejira|saka|śaka|saka era|samvat|vikrama(?:\s+samvat)?|fasli)\s*\d{2,4}(?:\s*[-–—/]\s*\d{1,4})?[a-z]?"
    r"|(?:c(?:irca)?|ca|fl)\.?\s*\d{2,4}(?:\s*[-–—/]\s*\d{1,4})?|regnal\s+year\s+\d{1,3}|(?:year\s+)?of\s+reign\s+\d{1,3}|\d{1,3}(?:st|nd|rd|th)\s+year(?:\s+of\s+(?:reign|his\s+reign))?)(?:\s*[.,;:])?$"
)
STRUCTURAL_LINE = r"^(?:#|---|\||>|\[\^|[-*+]\s|\d+\.\s)"
_OPEN_END = r"[.!?;:][\"”’')\]]*$"


def without_signatures(c: Column) -> Column:
    """Without signature marks that run into the first word of a line."""
    return F.regexp_replace(c, SIGNATURE, "$1")


def is_stamp(c: Column) -> Column:
    s = X.strip(c)
    return (s != "") & (s.rlike(X.ascii_edges(LIBRARY)) | s.rlike(r"(?i)^\|\s*(?:Date|St\.?\s*Card|Class|Cat|Bk\.?\s*Card\.?|Checked)\s*\|") | s.rlike(r"^\|\s*:?-{3,}:?\s*\|\s*:?-{3,}:?\s*\|?$"))


def is_loan_slip(c: Column) -> Column:
    s = F.lower(c)
    hits = sum((s.contains(m).cast("int") for m in SLIP[1:]), s.contains(SLIP[0]).cast("int"))
    code = s.rlike(r"\bc\d{8,}\b")
    return (hits >= 2) | ((hits >= 1) & code) | (code & (F.size(X.full_lines(c)) <= 3))


def headings_kept(c: Column, all_headings: bool = True) -> Column:
    """Markdown headings as they are, or only chapter-like ones with their marks."""
    if all_headings:
        return X.text(c)
    bare = lambda x: X.strip(F.regexp_replace(X.strip(x), "^#+", ""))
    return F.array_join(F.transform(X.lines(X.text(c)), lambda x: F.when(X.strip(x).startswith("#") & ~X.is_keyword(bare(x)), bare(x)).otherwise(x)), "\n")


def merged_segments(segments: Column) -> Column:
    """Texts of overlapping bands of a page as one: equal lines at a seam stand once.

    Lines are equal if their letters and digits are; the longest overlap of up
    to eight lines counts.
    """
    key = lambda ls: F.transform(ls, lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]+", ""))

    def add(acc: Column, seg: Column) -> Column:
        new = F.split(seg, "\r?\n")
        most = F.least(F.lit(8), F.size(acc), F.size(new))

        def fits(k: Column) -> Column:
            left = key(F.slice(acc, F.greatest(F.lit(1), F.size(acc) - k + 1), k))
            return (left == key(F.slice(new, F.lit(1), k))) & F.exists(left, lambda x: x != "")

        probes = F.filter(F.when(most > 0, F.sequence(most, F.lit(1))).otherwise(F.array().cast("array<int>")), fits)
        skip = F.coalesce(F.get(probes, F.lit(0)), F.lit(0))
        return F.when(F.size(acc) == 0, new).otherwise(F.concat(acc, F.slice(new, skip + 1, F.greatest(F.lit(0), F.size(new) - skip))))

    return X.strip(F.array_join(F.aggregate(segments, F.array().cast("array<string>"), add), "\n"))


def block_style(b: DataFrame, key: list[str]) -> DataFrame:
    """Style of each block of lines: verse, quote or prose.

    Verse: three short lines or more, a quarter indented, not running on like
    prose.  Quote: begins with a quotation mark and is no longer than 40 lines.
    """
    ls = F.split("text", "\n")
    full = F.transform(ls, lambda x: X.strip(x))
    n = F.size(full)
    counts = F.transform(full, lambda x: X.words(x))
    total = F.aggregate(counts, F.lit(0), lambda a, x: a + x)
    pairs = F.zip_with(F.slice(full, F.lit(1), F.greatest(F.lit(0), n - 1)), F.slice(full, F.lit(2), F.greatest(F.lit(0), n - 1)), lambda a, x: ~a.rlike(_OPEN_END) & x.rlike("^[a-z]"))
    run_on = F.size(F.filter(pairs, lambda x: x))
    indented = F.size(F.filter(ls, lambda x: x.rlike(r"^\s")))
    marked = F.exists(full, lambda x: x.rlike(STRUCTURAL_LINE))
    short = F.size(F.filter(counts, lambda x: x <= 12))
    verse = (n >= 3) & ~marked & (run_on < F.greatest(F.lit(1), F.floor(n / 3))) & (total * 2 <= n * 19) & (F.array_max(counts) <= 16) & (short * 4 >= n * 3) & (indented * 4 >= n)
    quote = ~marked & F.get(full, F.lit(0)).rlike("^[\"'“‘]") & (n <= 40)
    return b.select(*key, "line_start", F.when(verse, "verse").when(quote, "quote").otherwise("prose").alias("style"), n.alias("lines"), total.alias("words"), run_on.alias("run_on"))


def q_line_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the line filters find in each page."""
    lines = numbered_lines(latest(table(spark, sf_dir, "pages")), ["extraction_id"], F.col("text")).where(X.strip(F.col("line")) != "")
    s = X.strip(F.col("line"))
    return lines.groupBy("extraction_id").agg(
        F.count("*").alias("lines"), F.count_if(is_stamp(F.col("line"))).alias("stamps"), F.count_if(s.rlike(MARGINAL)).alias("marginal_labels"), F.count_if(s.rlike(X.SCAN_NOISE)).alias("scan_noise"),
        F.count_if(s.rlike(STRUCTURAL_LINE)).alias("structural"), F.count_if(X.is_standalone_heading(F.col("line"))).alias("standalone_headings"),
    )


def q_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = latest(table(spark, sf_dir, "pages"))
    return p.select("extraction_id", F.sha1(without_signatures(X.text("text"))).alias("text_sha1"), is_loan_slip(X.text("text")).alias("loan_slip"))


def q_headings_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chapters")
    return c.select("chapter_id", F.sha1(headings_kept(F.col("body"), False)).alias("body_sha1"))


def q_block_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blocks(table(spark, sf_dir, "chapters"), ["chapter_id"], F.col("body"))
    return block_style(b, ["chapter_id"])


def q_merged_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page cut into three bands that overlap by two lines, and merged again: as it was."""
    full = X.full_lines(X.text("text"))
    d = latest(table(spark, sf_dir, "pages")).select("extraction_id", full.alias("ls")).where("size(ls) >= 12")
    third = F.floor(F.size("ls") / 3).cast("int")
    band = lambda a, b: F.array_join(F.slice("ls", a, b), "\n")
    d = d.withColumn("bands", F.array(band(F.lit(1), third + 1), band(third, third + 1), band(third * 2 - 1, F.size("ls") - third * 2 + 2)))
    return d.select("extraction_id", F.sha1(merged_segments(F.col("bands"))).alias("text_sha1"), F.size("ls").alias("lines"))


QUERIES = {"line_cleanup": q_line_cleanup, "signature_prefixes": q_signatures, "headings_kept": q_headings_kept, "block_styles": q_block_styles, "segment_merge": q_merged_segments}

_S = strip("line")
_B = "coalesce(body, '')"


def stamp_sql(s: str) -> str:
    """``is_stamp`` of a stripped line."""
    return f"({s} <> '' AND ({has(s, LIBRARY)} OR {has(s, '(?i)^[|]' + chr(92) + 's*(?:Date|St[.]?' + chr(92) + 's*Card|Class|Cat|Bk[.]?' + chr(92) + 's*Card[.]?|Checked)' + chr(92) + 's*[|]')} OR {has(s, '^[|]' + chr(92) + 's*:?-{3,}:?' + chr(92) + 's*[|]' + chr(92) + 's*:?-{3,}:?' + chr(92) + 's*[|]?$')}))"


_STAMP = f"({has(_S, LIBRARY)} OR {has(_S, '(?i)^[|]\\s*(?:Date|St[.]?\\s*Card|Class|Cat|Bk[.]?\\s*Card[.]?|Checked)\\s*[|]')} OR {has(_S, '^[|]\\s*:?-{3,}:?\\s*[|]\\s*:?-{3,}:?\\s*[|]?$')})"
_H = strip(f"ltrim({_S}, '#')")


def _standalone() -> str:
    s = strip(_S, "#")
    return (
        f"({keyword(s)} AND (NOT {has(s, '(?i)^(?:part|book|section|volume)\\b')} OR {has(s, '(?i)^(?:part|book|section|volume)\\s+(?:[0-9]+|[ivxlcdm]+|[a-z])(?:\\b|[.):-])')}) "
        f"AND length({s}) <= 90 AND NOT {has(s, '(?i)\\b(?:contains|says|treats|describes|devoted|remarks?)\\b')})"
    )


_SLIPS = " + ".join(f"CAST(contains(lower(coalesce(text, '')), '{m}') AS INTEGER)" for m in SLIP)
_CODE = "regexp_matches(lower(coalesce(text, '')), '\\bc[0-9]{8,}\\b')"
_FULLN = f"len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: {strip('x')} <> ''))"
SQL = {
    "line_cleanup": f"""WITH {CURRENT}, {LINES} SELECT extraction_id, count(*) AS lines, count(*) FILTER (WHERE {_STAMP}) AS stamps, count(*) FILTER (WHERE {has(_S, MARGINAL)}) AS marginal_labels, count(*) FILTER (WHERE {has(_S, X.SCAN_NOISE)}) AS scan_noise,
        count(*) FILTER (WHERE {has(_S, STRUCTURAL_LINE)}) AS structural, count(*) FILTER (WHERE {_standalone()}) AS standalone_headings FROM lines WHERE {_S} <> '' GROUP BY extraction_id""",
    "signature_prefixes": f"""WITH {CURRENT} SELECT extraction_id, sha1({rep("coalesce(text, '')", SIGNATURE, chr(92) + '1')}) AS text_sha1, ({_SLIPS}) >= 2 OR (({_SLIPS}) >= 1 AND {_CODE}) OR ({_CODE} AND {_FULLN} <= 3) AS loan_slip FROM current""",
    "headings_kept": f"""SELECT chapter_id, sha1(array_to_string(list_transform(string_split({_B}, chr(10)), lambda line: CASE WHEN starts_with({_S}, '#') AND NOT {keyword(_H)} THEN {_H} ELSE line END), chr(10))) AS body_sha1 FROM chapters""",
}
