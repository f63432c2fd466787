"""Page level: blank filter, scripts, structure payloads, extraction decision, page typing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.duck import CURRENT, has, header_with_number, keyword, q, rep, running_header, simple, standalone_heading, strip, words
from quire.sources.tables import latest, table

# Remarks of a model about a page without text.
COMMENTARY = (
    r"there\s+is\s+no\s+(?:visible\s+)?text\s+(?:on|in)\s+this\s+(?:page|image)",
    r"this\s+(?:page|image)\s+(?:is|appears?\s+to\s+be)\s+blank",
    r"this\s+(?:page|image)\s+(?:does\s+not|doesn'?t)\s+contain\s+(?:any\s+)?text",
    r"(?:the\s+)?page\s+(?:is|appears?)\s+(?:to\s+be\s+)?(?:entirely\s+)?(?:blank|empty)",
    r"no\s+(?:visible\s+|readable\s+)?text\s+(?:is\s+)?(?:present|visible|found|detected)",
    r"the\s+image\s+(?:shows?|contains?|displays?)\s+(?:a\s+)?blank\s+page",
    r"i\s+(?:cannot|can'?t|am\s+unable\s+to)\s+(?:extract|transcribe|read|find|identify)\s+(?:any\s+)?text",
    r"i\s+(?:can\s+)?see\s+(?:that\s+)?(?:this|the)\s+(?:page|image)\s+(?:is|appears?)",
    r"i\s+(?:don'?t|do\s+not)\s+see\s+any\s+(?:readable\s+)?text",
    r"this\s+(?:page|image)\s+(?:contains?|shows?|displays?)\s+(?:only\s+)?(?:an?\s+)?(?:illustration|photograph|image|figure|plate|diagram|map|frontispiece)",
    r"(?:the\s+)?(?:page|image)\s+(?:contains?|shows?)\s+(?:a\s+)?(?:decorative|ornamental)\s+(?:border|element|design)",
    r"(?:this\s+page\s+)?(?:contains?|shows?)\s+(?:only\s+)?(?:a\s+)?library\s+(?:stamp|card|marking|label)",
    r"(?:i\s+)?apologi[sz]e,?\s+(?:but\s+)?(?:there|this|i)",
    r"unfortunately,?\s+(?:there\s+is\s+no|this\s+page|i\s+cannot)",
    r"\[?\s*this\s+page\s+(?:is\s+)?(?:intentionally\s+)?(?:left\s+)?blank\s*\]?",
)
# Whole short texts that mean a blank page.
SHORT_COMMENTARY = (
    r"^(?:blank\s+page|empty\s+page|no\s+text)\.?\s*$",
    r"^\[?\s*(?:blank|empty)\s*\]?\s*$",
    r"^(?:page\s+\d+\s+)?(?:is\s+)?blank\.?\s*$",
    r"^n/?a\.?\s*$",
)
_ANY = "(?i)(?:" + "|".join(COMMENTARY) + ")"
_EARLY = "(?i)^(?s:.{0,199}?)(?:" + "|".join(COMMENTARY) + ")"
_SHORT = "(?i)(?:" + "|".join(f"(?:{p})" for p in SHORT_COMMENTARY) + ")"
# Keys that mark a structure payload.
STRUCTURE_KEYS = ("page_type", "has_footnotes", "has_illustrations", "has_indic_script", "has_tables", "has_poetry", "chapter_heading", "confidence")


def is_commentary(c: Column) -> Column:
    """Whether a text is a remark about a page and not the page.

    Blank text is.  Under 300 characters any remark decides; a longer text must
    begin with one (before character 200) and hold under 100 characters after it.
    """

    def remark(s: Column) -> Column:
        def leads(p: str) -> Column:
            at, found = F.regexp_instr(s, F.lit("(?i)" + p)), F.regexp_extract(s, "(?i)" + p, 0)
            rest = X.strip(F.substring(s, at + F.length(found), F.lit(2**30)))
            return (found != "") & (at <= 200) & (F.length(rest) < 100)

        # in a long text, no remark is looked for beyond the place where it may begin
        led = s.rlike(_EARLY) & reduce(Column.__or__, map(leads, COMMENTARY))
        return (s == "") | ((F.length(s) < 150) & s.rlike(_SHORT)) | F.when(F.length(s) < 300, s.rlike(_ANY)).otherwise(led)

    return X.let(X.strip(X.text(c)), remark)


def without_commentary(c: Column) -> Column:
    """The text without lines that are remarks; '' if all of it is one."""
    t = X.text(c)

    def keep(line: Column) -> Column:
        s = X.strip(line)
        return (s == "") | ~(s.rlike(_ANY) | ((F.length(s) < 150) & s.rlike(_SHORT)))

    # most pages hold no remark at all; only the others are taken apart
    touched = t.rlike(_ANY) | F.exists(F.split(t, "\n"), lambda x: (F.length(x) < 150) & X.strip(x).rlike(_SHORT))
    lines = F.array_join(F.filter(F.split(t, "\n", -1), keep), "\n")
    return F.when(is_commentary(t), "").when(touched, X.strip(lines)).otherwise(X.strip(t))


def content_class(c: Column, cleaned: Column) -> Column:
    return F.when(cleaned == "", "BLANK").when(F.length(cleaned) * 10 < F.length(X.strip(X.text(c))) * 8, "MIXED").otherwise("CONTENT")


def structure(c: Column) -> Column:
    """A structure payload as a map of JSON strings, or null.

    An object is taken as it is; of an array the sole object, else the first
    with a known key, else its key/value items.  Code fences are dropped;
    malformed text gives null.
    """
    s = X.strip(F.regexp_replace(X.text(c), r"^\s*```(?:json)?|```\s*$", ""))
    obj = F.when(s.startswith("{"), F.from_json(s, "map<string,string>"))
    arr = F.when(s.startswith("["), F.from_json(s, "array<map<string,string>>"))
    known = F.filter(arr, lambda m: F.exists(F.map_keys(m), lambda k: k.isin(*STRUCTURE_KEYS)))
    pairs = F.filter(arr, lambda m: F.array_contains(F.map_keys(m), "key") & F.array_contains(F.map_keys(m), "value"))
    as_map = F.map_from_entries(F.transform(pairs, lambda m: F.struct(F.element_at(m, "key"), F.element_at(m, "value"))))
    one = F.when(F.size(arr) == 1, F.get(arr, F.lit(0)))
    return F.coalesce(obj, one, F.when(F.size(known) > 0, F.get(known, F.lit(0))), F.when(F.size(pairs) > 0, as_map))


def script_profile(c: Column) -> list[Column]:
    t = X.text(c)
    return [
        X.count_matches(t, X.INDIC).alias("indic_chars"),
        X.count_matches(t, "[A-Za-z]").alias("ascii_letters"),
        X.count_matches(t, r"[^\x00-\x7F]").alias("non_ascii_chars"),
        X.count_matches(t, r"\p{Nd}").alias("digits"),
    ]


def decide(pages: DataFrame) -> DataFrame:
    """The extraction decision of each page: type, confidence, fidelity, flags.

    Failed or empty -> error; a remark -> blank 0.9; the blank mark -> blank 1;
    nothing left after the line filter -> blank 0.8; else what the structure
    payload says (text, 0.8 by default).  Fidelity starts at 100 times the
    confidence; a fallback model, heavy filtering and a missing payload cost.
    """
    raw = F.when(F.coalesce("success", F.lit(False)), X.strip(X.text("raw_text"))).otherwise("")
    d = pages.select("extraction_id", "extraction_model", raw.alias("raw"), structure(F.col("structure_data")).alias("s"))
    d = d.select("*", without_commentary(F.col("raw")).alias("clean"), is_commentary(F.col("raw")).alias("remark"))
    kind = F.when(F.col("raw") == "", "error").when(F.col("remark") | (F.col("raw") == "[BLANK PAGE]") | (F.col("clean") == ""), "blank").otherwise(F.coalesce(F.element_at("s", "page_type"), F.lit("text")))
    said = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.expr("try_cast(element_at(s, 'confidence') as double)"), F.lit(0.8))))
    conf = F.when(F.col("raw") == "", 0.0).when(F.col("remark"), 0.9).when(F.col("raw") == "[BLANK PAGE]", 1.0).when(F.col("clean") == "", 0.8).otherwise(said)
    d = d.withColumns({"page_type": kind, "seed": conf})
    body = ~F.col("page_type").isin("error") & ~((F.col("page_type") == "blank") & (F.col("remark") | (F.col("raw") == "[BLANK PAGE]") | (F.col("clean") == "")))
    model = F.lower(X.text("extraction_model"))
    claude, other = model.contains("claude") & model.contains("fallback"), ~model.contains("claude") & model.contains("fallback")
    cost = F.when(claude, 5).when(other, 7).otherwise(0) + F.when(F.length("clean") * 10 < F.length("raw") * 9, 10).otherwise(0) + F.when(F.col("s").isNull(), 5).otherwise(0)
    fidelity = F.when(body, F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col("seed") * 100 - cost))).otherwise(F.lit(0.0))
    return d.select(
        "extraction_id", "page_type", F.when(body & other, F.least(F.lit(0.7), F.col("seed"))).otherwise(F.col("seed")).alias("confidence"), F.round(fidelity, 6).alias("fidelity"),
        F.when(body, X.words(F.col("clean"))).otherwise(0).alias("word_count"),
        (body & F.col("clean").rlike(r"\[\^[A-Za-z0-9]+\]")).alias("has_footnotes"),
        (body & F.col("clean").rlike(X.INDIC)).alias("has_indic_script"),
    )


def chapter_start(t: Column, heading: Column) -> Column:
    """Strict chapter start: a standalone heading among the first five lines, no running header above it."""
    def found(full: Column) -> Column:
        first, second = F.coalesce(F.get(full, F.lit(0)), F.lit("")), F.coalesce(F.get(full, F.lit(1)), F.lit(""))
        number = r"^\d{1,4}\*?\.?$"
        block = (F.size(full) >= 2) & (F.length(t) > 250) & ((first.rlike(number) & X.is_keyword(X.strip(second, "*"))) | (X.is_keyword(X.strip(first, "*")) & second.rlike(number)))
        top = F.slice(full, 1, 5)
        hit = F.exists(top, lambda x: X.is_standalone_heading(x) & ~((F.length(t) > 250) & X.is_header_with_number(x)))
        caps = (F.length(t) < 200) & F.exists(F.slice(full, 1, 3), lambda x: (X.is_keyword(x) & (F.upper(x) == x)) | ((X.strip(x, ".") != "") & F.regexp_replace(x, r"\.+$", "").rlike(X.ROMAN)))
        agrees = (X.strip(heading) != "") & (F.length(first) > 3) & (X.simple(first) == X.simple(heading)) & (F.get(F.transform(F.split(X.strip(t), "\n"), lambda x: X.strip(x)), F.lit(1)) == "")
        return (hit | caps | F.coalesce(agrees, F.lit(False))) & ~block & ~X.is_running_header(first, second)

    return X.let(X.full_lines(t), found)


def page_kind(pages: DataFrame) -> Column:
    """Assembly type of a page; the first rule that holds decides."""
    said, heading = X.text("page_type"), X.text("chapter_heading")
    return X.let(
        X.strip(X.text("text")),
        lambda t: (
            F.when((t == "") | (said == "blank") | is_commentary(t), "blank")
            .when((said == "illustration") | (t.startswith("[Illustration") & (F.length(t) < 200)), "illustration")
            .when(said == "toc", "toc")
            .when(chapter_start(t, heading), "chapter_start")
            .when(said.isin("title", "frontmatter"), "frontmatter")
            .when(said == "backmatter", "backmatter")
            .otherwise("text")
        ),
    )


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def q_blank_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and cleaned length of every extraction's raw text."""
    p = _pages(spark, sf_dir).select("extraction_id", "raw_text", is_commentary(F.col("raw_text")).alias("is_commentary"), without_commentary(F.col("raw_text")).alias("clean"))
    return p.select("extraction_id", "is_commentary", content_class(F.col("raw_text"), F.col("clean")).alias("class"), F.length("clean").alias("clean_chars"), F.sha1("clean").alias("clean_sha1"))


def q_script_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pages(spark, sf_dir)
    return p.select("extraction_id", *script_profile(F.col("text")), X.text("text").rlike(X.INDIC).alias("has_indic"), X.words(X.text("text")).alias("words"))


def q_structure_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = structure(F.col("structure_data"))
    p = _pages(spark, sf_dir).select("extraction_id", s.alias("s"))
    return p.select("extraction_id", F.col("s").isNotNull().alias("is_object"), F.element_at("s", "page_type").alias("said_type"), F.element_at("s", "chapter_heading").alias("said_heading"))


def q_extraction_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(_pages(spark, sf_dir))


def q_page_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = latest(_pages(spark, sf_dir))
    return p.select("book_id", "page_number", page_kind(p).alias("kind"))


def q_line_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each class, by book."""
    p = latest(_pages(spark, sf_dir)).select("book_id", F.explode(X.lines(X.text("text"))).alias("line"))
    return p.groupBy("book_id", X.line_class(F.col("line")).alias("class")).agg(F.count("*").alias("lines"))


def q_page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per book and page type: pages, failures, fallbacks, reviews, low confidence, empty pages."""
    p = latest(_pages(spark, sf_dir))
    kind, conf = F.coalesce(F.nullif("page_type", F.lit("")), F.lit("unknown")), F.coalesce("confidence", F.lit(0.0))
    ok = F.coalesce("success", F.lit(False))
    return p.groupBy("book_id", kind.alias("page_type")).agg(
        F.count("*").alias("pages"), F.count_if(ok).alias("successful"), F.count_if((kind == "error") | ~ok).alias("failed"),
        F.count_if(F.lower(X.text("extraction_model")).contains("fallback")).alias("fallback"), F.count_if(F.coalesce(F.size("warnings"), F.lit(0)) > 0).alias("review"),
        F.count_if(ok & (kind != "blank") & (conf < 0.65)).alias("low_confidence"), F.count_if((X.strip(X.text("text")) == "") & (kind != "blank")).alias("empty_nonblank"),
        F.round(F.avg(F.when(ok & (kind != "blank"), F.col("fidelity"))), 4).alias("avg_fidelity"),
    )


QUERIES = {
    "blank_filter": q_blank_filter, "script_profile": q_script_profile, "structure_payload": q_structure_payload, "extraction_decision": q_extraction_decision,
    "page_kinds": q_page_kinds, "line_classes": q_line_classes, "page_audit": q_page_audit,
}

_S = strip("coalesce(raw_text, '')")
_LED = " OR ".join(
    f"(regexp_extract(s, {q('(?i)' + p)}) <> '' AND strpos(s, regexp_extract(s, {q('(?i)' + p)})) <= 200 AND length({strip(f'substr(s, strpos(s, regexp_extract(s, {q("(?i)" + p)})) + length(regexp_extract(s, {q("(?i)" + p)})))')}) < 100)" for p in COMMENTARY
)
_REMARK = f"(s = '' OR (length(s) < 150 AND {has('s', _SHORT)}) OR ({has('s', _ANY)} AND (length(s) < 300 OR {_LED})))"
_KEEP = f"({strip('x')} = '' OR NOT ({has(strip('x'), _ANY)} OR (length({strip('x')}) < 150 AND {has(strip('x'), _SHORT)})))"
_CLEANED = f"""base AS (SELECT *, {_S} AS s, string_split(coalesce(raw_text, ''), chr(10)) AS ls FROM pages),
    marked AS (SELECT *, {_REMARK} AS remark FROM base),
    cleaned AS (SELECT *, CASE WHEN remark THEN '' ELSE {strip(f"array_to_string(list_filter(ls, lambda x: {_KEEP}), chr(10))")} END AS clean FROM marked)"""
_T = "coalesce(text, '')"
_INDIC = X.INDIC
SQL = {
    "blank_filter": f"""WITH {_CLEANED} SELECT extraction_id, remark AS is_commentary, CASE WHEN clean = '' THEN 'BLANK' WHEN length(clean) * 10 < length(s) * 8 THEN 'MIXED' ELSE 'CONTENT' END AS class,
        length(clean)::INTEGER AS clean_chars, sha1(clean) AS clean_sha1 FROM cleaned""",
    "script_profile": f"""SELECT extraction_id, length(regexp_replace({_T}, {q('[^' + _INDIC[1:])}, '', 'g'))::INTEGER AS indic_chars, length(regexp_replace({_T}, '[^A-Za-z]', '', 'g'))::INTEGER AS ascii_letters,
        length(regexp_replace({_T}, '[\\x00-\\x7F]', '', 'g'))::INTEGER AS non_ascii_chars, length(regexp_replace({_T}, '[^\\p{{Nd}}]', '', 'g'))::INTEGER AS digits,
        {has(_T, _INDIC)} AS has_indic, {words(_T)}::INTEGER AS words FROM pages""",
    "page_audit": f"""WITH {CURRENT}, c AS (SELECT *, coalesce(nullif(page_type, ''), 'unknown') AS kind, coalesce(success, false) AS ok FROM current)
        SELECT book_id, kind AS page_type, count(*) AS pages, count(*) FILTER (WHERE ok) AS successful, count(*) FILTER (WHERE kind = 'error' OR NOT ok) AS failed,
        count(*) FILTER (WHERE contains(lower(coalesce(extraction_model, '')), 'fallback')) AS fallback, count(*) FILTER (WHERE len(coalesce(warnings, [])) > 0) AS review,
        count(*) FILTER (WHERE ok AND kind <> 'blank' AND coalesce(confidence, 0) < 0.65) AS low_confidence, count(*) FILTER (WHERE {strip(_T)} = '' AND kind <> 'blank') AS empty_nonblank,
        round(avg(fidelity) FILTER (WHERE ok AND kind <> 'blank'), 4) AS avg_fidelity FROM c GROUP BY ALL""",
}


_FULL = f"list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
_LABEL, _NUM = keyword(strip("@", "*")), has("@", r"^\d{1,4}\*?\.?$")
_BLOCK = f"(len(ls) >= 2 AND length(t) > 250 AND (({_NUM.replace('@', 'l1')} AND {_LABEL.replace('@', 'l2')}) OR ({_LABEL.replace('@', 'l1')} AND {_NUM.replace('@', 'l2')})))"
_HIT = f"len(list_filter(ls[1:5], lambda x: {standalone_heading('x')} AND NOT (length(t) > 250 AND {header_with_number('x')}))) > 0"
_CAPS = f"(length(t) < 200 AND len(list_filter(ls[1:3], lambda x: ({keyword('x')} AND upper(x) = x) OR ({strip('x', '.')} <> '' AND {has(rep('x', '[.]+$'), X.ROMAN)}))) > 0)"
_AGREES = f"({strip('heading')} <> '' AND {simple('l1')} = {simple('heading')} AND length(l1) > 3 AND coalesce({strip('string_split(t, chr(10))[2]')}, 'x') = '')"
#: ``kinds``: the latest pages with their assembly type.
KINDS = f"""{CURRENT}, k0 AS (SELECT *, {strip(_T)} AS t, {strip(_T)} AS s, coalesce(page_type, '') AS said, coalesce(chapter_heading, '') AS heading FROM current),
    k1 AS (SELECT *, {_FULL} AS ls FROM k0), k2 AS (SELECT *, coalesce(ls[1], '') AS l1, coalesce(ls[2], '') AS l2 FROM k1),
    kinds AS (SELECT * EXCLUDE (s, t, said, heading, ls, l1, l2), CASE WHEN t = '' OR {_REMARK} OR said = 'blank' THEN 'blank' WHEN said = 'illustration' OR (starts_with(t, '[Illustration') AND length(t) < 200) THEN 'illustration' WHEN said = 'toc' THEN 'toc'
        WHEN NOT {running_header('l1', 'l2')} AND NOT {_BLOCK} AND ({_HIT} OR {_CAPS} OR {_AGREES}) THEN 'chapter_start' WHEN said IN ('title', 'frontmatter') THEN 'frontmatter' WHEN said = 'backmatter' THEN 'backmatter' ELSE 'text' END AS kind FROM k2)"""
SQL["page_kinds"] = f"WITH {KINDS} SELECT book_id, page_number, kind FROM kinds"


def _line_classes_sql() -> str:
    from quire.functions.duck import LINES, line_class

    return f"WITH {CURRENT}, {LINES} SELECT book_id, {line_class('line')} AS class, count(*) AS lines FROM lines GROUP BY ALL"


SQL["line_classes"] = _line_classes_sql()
