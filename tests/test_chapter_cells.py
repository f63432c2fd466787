"""Chapter bodies over cells of a book, and the size of their plan."""

import re

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import chapters, pages

SCHEMA = "book_id string, page_number int, kind string, chapter_heading string, text string, page_type string"


def test_plan_is_small(spark, sf_dir):
    """The pages are looked at once, kept, and read by two branches; what is kept takes no more than its own two exchanges each time."""
    plan = chapters.q_bodies(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") <= 2 and plan.count("FileScan") <= 2 and len(re.findall(r"[+:]- Exchange", plan)) <= 9


def test_bodies_over_cells(spark):
    rows = [
        ("b", 1, "text", None, "the archaeo-"), ("b", 4095, "blank", None, None), ("b", 4096, "text", None, "logical finds and"), ("b", 20_000, "text", None, "so on."),
        ("b", 20_001, "chapter_start", "CHAPTER I. Rivers", "CHAPTER I. Rivers\nThe river"), ("b", 40_960, "text", None, "ran on."), ("b", 45_056, "chapter_start", "Rivers", "Rivers\nwent on"),
        ("c", 4095, "chapter_start", "CHAPTER I", "CHAPTER I"), ("c", 4096, "chapter_start", "CHAPTER I", "CHAPTER I\nIt ran."), ("c", 8192, "chapter_start", "CHAPTER I", "CHAPTER I\nIt stood."),
    ]
    p = spark.createDataFrame([(*r, "text") for r in rows], SCHEMA)
    got = {(r["book_id"], r["chapter"], r["piece"]): r["body"] for r in chapters.bodies(p).collect()}
    assert got == {
        ("b", 0, 0): "the archaeo", ("b", 0, 7): "", ("b", 0, 8): "logical finds and", ("b", 0, 39): " so on.",
        ("b", 1, 39): "CHAPTER I. Rivers\nThe river", ("b", 1, 80): " ran on.", ("b", 1, 88): "\n\nRivers\nwent on",
        ("c", 1, 7): "CHAPTER I", ("c", 2, 8): "CHAPTER I\nIt ran.", ("c", 2, 16): "\n\nCHAPTER I\nIt stood.",
    }


def test_no_pages(spark):
    assert chapters.bodies(spark.createDataFrame([(None, 1, "text", None, "a", "text"), ("b", None, "text", None, "a", "text")], SCHEMA)).collect() == []


def test_blanks(spark):
    """strip() takes away what its regular expression did."""
    d = spark.range(1, 0x10000).where("id not between 55296 and 57343 and id <> 65279").select("id", F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    blank = F.col("c").rlike(f"^{X.WS}$")
    assert d.where(blank != (X.strip("c") == "")).count() == 0 and d.where(blank).count() == len(X.BLANKS)
    got = spark.createDataFrame([(" \n* .a b. * ",)], "c string").select(X.strip(F.col("c")).alias("x"), X.strip(F.col("c"), "*.").alias("y")).first()
    assert (got["x"], got["y"]) == ("* .a b. *", "a b")


@pytest.mark.parametrize(
    ("make", "value", "want"),
    [
        (X.is_header_with_number, "CHAPTER I.—Of the provincial blossοm.", True),  # the m after a Greek letter stands for itself, as in SQL
        (X.is_keyword, "Partа", True),
        (pages.is_commentary, "x" * 198 + " there is no text on this page " + "y" * 99, True),
        (pages.is_commentary, "x" * 198 + " there is no text on this page " + "y" * 100, False),
        (pages.is_commentary, "x" * 199 + " there is no text on this page " + "y" * 99, False),
    ],
)
def test_values(spark, make, value, want):
    assert spark.createDataFrame([(value,)], "x string").select(make(F.col("x")).alias("y")).first()["y"] is want
