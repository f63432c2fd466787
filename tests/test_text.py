"""Text functions and page operators on hand-made cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import chapters, cleanup, footnotes, maps, margins, pages, tables
from quire.sources import tables as sources
from quire.streaming import events


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "x string").select(make(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("line", "kind"),
    [("10 INTRODUCTION.", "running_header_with_page"), ("CHAPTER I.", "chapterish_label"), ("[^1]: a note", "footnote_def"), ("| a | b |", "table"), ("> q", "blockquote"), ("[12]", "page_number"), ("xiv.", "page_number"), ("plain words", "prose"), ("", "blank"), ("UC-NRLF", "scan_noise"), ("## A", "chapter_heading")],
)
def test_line_class(spark, line, kind):
    assert one(spark, line, X.line_class) == kind


def test_words_and_slugs(spark):
    assert one(spark, "", X.words) == 0
    assert one(spark, " a  b c ", X.words) == 3
    assert one(spark, "The Old  Annals!", X.slug) == "the-old-annals"
    assert one(spark, "***", X.slug) == "na"
    assert one(spark, "12 The Annals, iv", X.margin_key) == "# the annals #"


@pytest.mark.parametrize(
    ("text", "remark"),
    [("", True), (None, True), ("There is no visible text on this page.", True), ("[blank]", True), ("n/a", True), ("A page of text about a blank field.", False), ("word " * 100 + "this page is blank", False), ("This page is blank. " + "x " * 200, False)],
)
def test_commentary(spark, text, remark):
    assert one(spark, text, pages.is_commentary) is remark


@pytest.mark.parametrize(
    ("payload", "kind"),
    [('{"page_type": "toc"}', "toc"), ('[{"page_type": "toc"}]', "toc"), ('[{"a": 1}, {"page_type": "index"}]', "index"), ('[{"key": "page_type", "value": "text"}, {"key": "a", "value": "1"}]', "text"), ('```json\n{"page_type": "title"}\n```', "title"), ("not json", None), (None, None)],
)
def test_structure(spark, payload, kind):
    assert one(spark, payload, lambda c: F.element_at(pages.structure(c), "page_type")) == kind


@pytest.mark.parametrize(
    ("left", "right", "mode"),
    [("archaeo-", "logical work", "drop_hyphen"), ("Durga-", "Navaratri", "keep_hyphen"), ("he came,", "and went", "space"), ("The end.", "then more", None), ("he said:", "“Come here”", "paragraph"), ("on the", "[^1]: note", None), ("on the", "12", None), ("[Illustration: x]", "and so", None), ("", "a", None)],
)
def test_boundary(spark, left, right, mode):
    df = spark.createDataFrame([(left, right)], "l string, r string")
    joins, how = chapters.boundary(F.col("l"), F.col("r"))
    got = df.select(joins.alias("j"), how.alias("m")).first()
    assert (got["m"] if got["j"] else None) == mode


def test_catchword(spark):
    df = spark.createDataFrame([("by his command,", "command, and so"), ("the againſt", "against Warunkul it"), ("a com-", "mand"), ("the command", "command.")], "l string, r string")
    got = [r["r"] for r in df.select(chapters.without_catchword(chapters.catchword(F.col("l")), F.col("r")).alias("r")).collect()]
    assert got == ["and so", "Warunkul it", "mand", "command."]


def test_page_ranges(spark):
    df = spark.createDataFrame([("b", n) for n in (3, 1, 2, 5, 5)] + [("b", None)], "book_id string, page_number int")
    assert maps.page_ranges(df, ["book_id"]).first()["ranges"] == "1-3, 5"


def test_footnote_ids(spark):
    assert one(spark, "a-p12-2", footnotes.base_id) == "a"
    assert one(spark, "c3-a", footnotes.marker_letter) == "a"
    assert one(spark, "x[^1]¹", footnotes.superscript_refs) == "x[^1]"
    d = spark.createDataFrame([(1, i, x) for i, x in enumerate(("10", "2", "b", "a"))], "c int, ord int, id string")
    assert [r["id"] for r in d.orderBy(*footnotes.sort_key(F.col("id"))).collect()] == ["2", "10", "a", "b"]


def test_notes_of_a_page():
    body, notes = footnotes.parse_notes("Text[^1] more.\n\n[^1]: first\ngoes on\n[^2]: a   [^3]: b\n\nafter")
    assert notes == [("1", "first goes on"), ("2", "a"), ("3", "b")]
    assert "goes on" not in body and "after" in body
    assert footnotes.parse_notes("") == ("", []) and footnotes.parse_notes(None) == ("", [])


def test_remapped_ids(spark):
    rows = [("b", 1, 4, 1, "1", "x"), ("b", 1, 5, 1, "1", "y"), ("b", 1, 6, 1, "1", "x")]
    d = spark.createDataFrame(rows, "book_id string, chapter_number int, page_number int, ord int, id string, text string")
    assert sorted((r["page_number"], r["new_id"]) for r in footnotes.remapped(d).collect()) == [(4, "1"), (5, "1-p5"), (6, "1")]


def test_margin_threshold_and_removal(spark):
    rows = [("b", n, n, f"{n} THE ANNALS\nBody {chr(96 + n % 26 + 1) * (n % 7 + 3)} runs {chr(97 + n // 26) * 4} on.\nmore {chr(97 + n % 25) * (n % 9 + 2)} text\n{n}") for n in range(1, 41)]
    p = spark.createDataFrame(rows, "book_id string, page_number int, extraction_id int, text string")
    m = margins.detect(p)
    assert ("top", "# the annals") in {(r["edge"], r["key"]) for r in m.collect()}
    out = margins.strip_margins(p, m).orderBy("page_number").first()["text"]
    assert out.split("\n")[0] == "" and out.split("\n")[-1] == "" and "Body" in out and out.count("\n") == 3


def test_segments(spark):
    df = spark.createDataFrame([(["a b\nc d\ne f", "C D\ne f\ng h", "i"],)], "s array<string>")
    assert df.select(cleanup.merged_segments(F.col("s")).alias("m")).first()["m"] == "a b\nc d\ne f\ng h\ni"


def test_tables(spark):
    assert one(spark, "| --- | :-: |".replace(":-:", ":---:"), tables.is_separator) is True
    df = spark.createDataFrame([([["a", "b"], ["c"]],)], "r array<array<string>>")
    assert df.select(tables.rendered(F.col("r")).alias("m")).first()["m"] == "| a | b |\n| --- | --- |\n| c |  |"


def test_checkpoint_round_trip(spark, tmp_path):
    p = spark.createDataFrame([("b", 1, "t", True), ("b", 2, "", False)], "book_id string, page_number int, text string, success boolean")
    full = p.select(*[F.col(f.name) if f.name in p.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in sources.PAGE_SCHEMA.fields])
    sources.write_checkpoint(full, str(tmp_path / "c"))
    (tmp_path / "c" / "book_id=b" / "broken.json").write_text("{not json\n")
    got = sources.read_checkpoint(spark, str(tmp_path / "c"))
    assert [(r["page_number"], r["text"]) for r in got.collect()] == [(1, "t")]
    wanted = spark.createDataFrame([("b", 1), ("b", 2)], "book_id string, page_number int")
    assert [r["page_number"] for r in sources.pending(wanted, got).collect()] == [2]


def test_streams(spark, tmp_path):
    t = dt.datetime(2026, 1, 1, 10)
    rows = [("x", "page", "b", "v", "{}", t), ("x", "page", "b", "v", "{}", t), ("y", "page", "b", "v", "{}", t + dt.timedelta(minutes=5)), ("z", "end", None, "v", None, None)]
    spark.createDataFrame(rows, events.EVENT_SCHEMA).write.json(str(tmp_path / "log"))
    src = lambda: events.read_stream(spark, str(tmp_path / "log"))
    late = [("w", "page", "b", "v", "{}", t + dt.timedelta(hours=9))]
    spark.createDataFrame(late, events.EVENT_SCHEMA).write.mode("append").json(str(tmp_path / "log"))
    got = events.run_once(events.hourly(src())).collect()
    assert [(r["event"], r["events"], r["hour"].hour) for r in got] == [("page", 2, 10)]
    assert [r["events"] for r in events.run_once(events.bursts(src())).collect()] == [3]
    events.upsert_stream(events.progress(src()), str(tmp_path / "seen"), str(tmp_path / "state"), ["book_id"])
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "seen")).select("book_id", "events").collect()] == [("b", 4)]
