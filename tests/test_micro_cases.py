"""Values worked out by hand from the rules of the data model, not by any engine."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import chapters, cleaning, cleanup, footnotes, maps, pages, review


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "x string").select(make(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("make", "value", "want"),
    [
        (footnotes.marked, "$Rāmāyaṇa,^3$", "$Rāmāyaṇa,$[^3]"),
        (footnotes.marked, r"$R\bar{a}ja^{1}$", r"$R\bar{a}ja$[^1]"),
        (footnotes.marked, "$2^3$", "$2^3$"),
        (footnotes.marked, r"$^\text{a}$", "[^a]"),
        (footnotes.marked, r"the 3$^\text{d}$ of May", "the 3d of May"),
        (footnotes.marked, "x[^1]¹", "x[^1]"),
        (footnotes.marked, "wordᵃ and word¹²", "word[^a] and word[^12]"),
        (footnotes.marked, "word.^1 and 3^d", "word.[^1] and 3d"),
        (footnotes.marked, "a [^1] stays", "a [^1] stays"),
        (footnotes.base_id, "a-p12-2", "a"),
        (footnotes.healed, "he said[^1]\n\nand went.\n\nThen he came.", "he said[^1] and went.\n\nThen he came."),
        (footnotes.healed, "he said[^1]\n\nHe went.", "he said[^1]\n\nHe went."),
        (X.line_class, "10 INTRODUCTION.", "running_header_with_page"),
        (chapters.is_ordinal, "XV.", True),
        (chapters.is_ordinal, "501", False),
        (chapters.is_ordinal, "**12.**", True),
        (lambda c: pages.script_profile(c)[0], "aé1", 0),
        (lambda c: pages.script_profile(c)[1], "aé1", 1),
        (lambda c: pages.script_profile(c)[2], "aé1", 1),
        (lambda c: pages.script_profile(c)[3], "aé1", 1),
        (pages.is_commentary, "There is no text on this page.", True),
        (X.is_header_combo, "10 INTRODUCTION.", True),
        (X.is_header_with_number, "CHAPTER I.", False),
        (lambda c: X.strip(c).rlike(cleanup.MARGINAL), "A.D. 1412.", True),
        (cleaning.is_noise, "5-VII-S", True),
        (cleaning.is_noise, "xiv.", True),
        (cleaning.is_noise, "The river", False),
    ],
)
def test_value(spark, make, value, want):
    assert one(spark, value, make) == want


@pytest.mark.parametrize(
    ("before", "after", "joins", "mode"),
    [
        ("the archaeo-", "logical finds", True, "drop_hyphen"),
        ("at Durga-", "Navaratri it", True, "keep_hyphen"),
        ("he went", "and came", True, "space"),
        ("he went.", "and came", False, None),
        ("he said:", "“Let it be”", True, "paragraph"),
        ("he went", "[^1]: a note", False, None),
        ("he went", "12", False, None),
        ("he went", ", and came", False, None),
        ("he went,", "; and came", True, "nospace"),
    ],
)
def test_boundary(spark, before, after, joins, mode):
    d = spark.createDataFrame([(before, after)], "a string, b string")
    j, m = chapters.boundary(F.col("a"), F.col("b"))
    r = d.select(j.alias("j"), m.alias("m")).first()
    assert r["j"] is joins and (not joins or r["m"] == mode)


def body(spark, *texts, kinds=None):
    rows = [("b", i + 1, t, (kinds or {}).get(i, "text"), None, "text") for i, t in enumerate(texts)]
    p = spark.createDataFrame(rows, "book_id string, page_number int, text string, kind string, chapter_heading string, page_type string")
    return {r["chapter"]: r["body"] for r in chapters.bodies(p).collect()}


def test_bodies(spark):
    assert body(spark, "the archaeo-", "logical finds,", "finds, and so", "on.", "He came.") == {0: "the archaeological finds, and so on.\n\nHe came."}
    assert body(spark, "a river", "", "-- ran on", kinds={1: "blank"}) == {0: "a river ran on"}
    assert body(spark, None, "only this") == {0: "only this"}


def test_groups(spark):
    rows = [(1, "text", None, "Before it all."), (2, "chapter_start", "CHAPTER I. Rivers", "CHAPTER I. Rivers\nThe river."), (3, "chapter_start", "Rivers", "Rivers\nwent on"), (4, "text", None, "more"), (5, "chapter_start", "CHAPTER II. Hills", "CHAPTER II. Hills\nThe hills."), (900_000_000, "text", None, "far")]
    p = spark.createDataFrame([("b", n, k, h, t, "text") for n, k, h, t in rows], "book_id string, page_number int, kind string, chapter_heading string, text string, page_type string")
    got = {r["page_number"]: (r["chapter"], r["title"]) for r in chapters.grouped(p).collect()}
    assert got == {1: (0, "Front Matter"), 2: (1, "CHAPTER I. Rivers"), 3: (1, "CHAPTER I. Rivers"), 4: (1, "CHAPTER I. Rivers"), 5: (2, "CHAPTER II. Hills"), 900_000_000: (2, "CHAPTER II. Hills")}


CLEANED = [
    ("frontmatter", "20\nINTRODUCTION.\n" + "The river ran. " * 20, "\n\n" + "The river ran. " * 20),
    ("text", "20\nINTRODUCTION.\nThe river ran.", "\nINTRODUCTION.\nThe river ran."),
    ("text", "THE OLD ANNALS\nof the river.", "\nof the river."),
    ("text", "I    B that ran on", "that ran on"),
    ("frontmatter", "CONTENTS\nof the book", "CONTENTS\nof the book"),
    ("frontmatter", "UC-NRLF\nGENERAL LIBRARY\nThe title", "The title"),
    ("frontmatter", "123456\nxiv\nThe title", "The title"),
    ("toc", "Of rivers ... 235\n236\n12", "Of rivers ... 235\n236"),
    ("illustration", "[Illustration: The  tank]\n12", "[Illustration: The tank]"),
    ("illustration", "To face p. 12\n*The tank*", "[Illustration: The tank]"),
    ("illustration", "General Library, The tank\nTo face p. 12", "[Illustration: To face p. 12]"),
    ("backmatter", "LOAN DEPT\nDue on the last date stamped below", ""),
    ("text", "", ""),
]


def test_cleaned_pages(spark):
    """Each page is a book of its own; the kind is said by the page."""
    rows = [(i, f"b{i}", 1, before, kind, None) for i, (kind, before, _) in enumerate(CLEANED)]
    p = spark.createDataFrame(rows, "extraction_id long, book_id string, page_number int, text string, page_type string, chapter_heading string")
    got = {r["extraction_id"]: r["text"] for r in cleaning.cleaned(p).collect()}
    assert [got[i] for i in range(len(CLEANED))] == [after for *_, after in CLEANED]


@pytest.mark.parametrize(("n", "need"), [(30, 2), (31, 3), (50, 6)])
def test_margin_threshold(spark, n, need):
    from quire.operators import margins

    for times, found in ((need, True), (need - 1, False)):
        rows = [("b", i, f"{'THE ANNALS' if i < times else 'x' * (i % 26 + 3) + chr(97 + i % 26) * 3}\n{chr(97 + i % 26) * (i // 26 + 3)} ran {chr(98 + i % 24) * 5} on.\nthe {chr(97 + i // 2 % 26) * (i % 11 + 2)} end {chr(97 + i % 26) * 4}.") for i in range(n)]
        p = spark.createDataFrame(rows, "book_id string, page_number int, text string")
        assert ("the annals" in {r["key"] for r in margins.detect(p).collect()}) is found


def notes(spark, rows):
    return spark.createDataFrame(rows, "chapter_id long, book_id string, number int, title string, body string, footnotes array<struct<id string, text string>>")


def test_rewritten_bodies(spark):
    c = notes(spark, [(1, "b", 0, "a", "x[^1] y[^10]", [("1", "n"), ("10", "m")]), (2, "b", 1, "b", "z[^1]", [("1", "o")])])
    d = footnotes.rewritten(c, footnotes.uniquified(footnotes.definitions(c)))
    assert {r["chapter_id"]: r["body"] for r in d.collect()} == {1: "x[^c1-1] y[^10]", 2: "z[^c1-1-2]"}


def test_hotspots(spark):
    table = "| a | b |\n| --- | --- |\n| 1 | 2 |\n| a | b |\n| 3 | 4 |"
    c = notes(spark, [(1, "b", 1, "Chapter I. Rivers", f"CHAPTER I.\nRivers\nthe river ran on and on\nTHE OLD ANNALS\nof the mother-LAND it ran [12\n{table}", None), (2, "b", 2, None, None, None)])
    got = {(r["category"], r["line_no"]) for r in review.hotspots(c).collect()}
    assert got == {("chapter_opener_duplicate", 1), ("header_like_body_line", 4), ("suspicious_boundary_merge", 5), ("malformed_page_token", 5), ("malformed_markdown_table_restart", 9)}


def test_gate(spark):
    p = spark.createDataFrame([("good", "t", "text", True), ("bad", "", "text", True), ("none", "", "blank", True)], "book_id string, text string, page_type string, success boolean").withColumns({"page_number": F.lit(1)})
    c = notes(spark, [(1, "good", 1, "a", "words", None), (2, "bad", 1, "a", "x[^1]", None)])
    i = spark.createDataFrame([("bad", 1, 0, 0)], "book_id string, orphaned long, unreferenced long, repeated long")
    got = {r["book_id"]: (r["failures"], r["passed"]) for r in review.gate(i, c, p).collect()}
    assert got == {"good": ("", True), "bad": ("orphaned footnote refs; empty pages that are not blank", False), "none": ("no words", False)}


def test_difference_of_books(spark):
    p = spark.createDataFrame([("b", 1, "नदी\n[^1]: note", "नदी\n[^1]: note", "text"), ("c", 1, "“a\n" * 5, "", "text")], "book_id string, page_number int, text string, raw_text string, page_type string")
    got = {(r["book_id"], r["issue"]) for r in maps.book_issues(p, notes(spark, [(1, "c", 1, "t", "plain", None), (2, "c", 1, "t", "plain", None)])).collect()}
    assert got == {("b", "indic_script_loss_reader"), ("b", "footnote_count_mismatch_reader_vs_source"), ("c", "quote_formatting_missed")}
