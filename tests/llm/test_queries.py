"""Queries on the smallest tables, and operators on awkward ones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire.llm import abuse, canonical, mixing, repeats, residue, scans, splitting, tokens, truncation
from quire.llm.queries import queries

PAGES = (
    "extraction_id bigint, book_id string, page_number int, text string, raw_text string, page_type string, chapter_heading string, success boolean, extracted_at timestamp, "
    "key string, page int, cell int, chunks string, line string, line_no int, what string, value string, source string, n bigint, title string, reason string, h bigint, token string, word string"
)
BOOKS, CHAPTERS = "book_id string, title string, source string, key string, host string", "chapter_id bigint, book_id string, title string, body string, id bigint, text string"
RESPONSES = "response_id bigint, extraction_id bigint, purpose string, attempt int, stop_reason string, finish_reason string, received_at timestamp, source string"
DOCS, TARGETS = "doc_id bigint, text string, source string, n_tokens bigint, times int, q string, h bigint", "mix_id string, source string, target_share double, max_repeats int, size_factor double, tokens double"


def frame(spark, schema, rows):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


AWKWARD = [
    {}, {"extraction_id": 1}, {"extraction_id": 2, "book_id": "b"}, {"extraction_id": 3, "book_id": "b", "page_number": 1, "text": "", "raw_text": ""}, {"extraction_id": 4, "book_id": "b", "page_number": 2, "text": " \n ", "raw_text": "\n"},
    {"extraction_id": 5, "book_id": "b", "page_number": 3, "text": "word " * 60_000, "raw_text": "x" * 300_000}, {"extraction_id": 5, "book_id": "b", "page_number": 3, "text": "word " * 60_000, "raw_text": "x" * 300_000},
    {"extraction_id": None, "book_id": "b", "page_number": 4, "text": "THE OLD ANNALS OF BARTORA\nbody", "raw_text": "THE OLD ANNALS OF BARTORA\nbody"},
    *[{"extraction_id": 10 + n, "book_id": "b", "page_number": n, "text": f"{n} THE OLD ANNALS OF BARTORA\n{chr(92 + n) * 9} of the page", "raw_text": f"{n} THE OLD ANNALS OF BARTORA\nbody", "page_type": "text"} for n in range(5, 12)],
]


@pytest.mark.parametrize("name", sorted(queries()))
def test_runs_on_small_tables(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    assert df.count() >= (0 if name in ("p4_found", "p6_found", "p9_found") else 1)


@pytest.mark.parametrize("rows", [[], AWKWARD])
def test_page_operators_survive(spark, rows):
    p = frame(spark, PAGES, rows)
    b = frame(spark, BOOKS, rows and [{"book_id": "b", "title": "The Old Annals of Bartora"}, {"book_id": "b"}, {}])
    c = frame(spark, CHAPTERS, rows and [{}, {"book_id": "b"}])
    r = frame(spark, RESPONSES, rows and [{}, {"extraction_id": 15, "purpose": "transcribe", "finish_reason": "MAX_TOKENS"}, {"extraction_id": 16, "purpose": "transcribe", "finish_reason": "STOP"}])
    found = repeats.repeated_lines(p)
    got = {(x["extraction_id"], x["line_no"]) for x in found.collect()}
    assert got == ({(None, 1)} | {(10 + n, 1) for n in range(5, 12)} if rows else set())
    left = repeats.without_lines(p, found).where("page_number = 6").collect()
    assert all(x["text"] == "b" * 9 + " of the page" for x in left)
    assert residue.residue(p, b).where("found").count() == 0
    assert canonical.look_pairs(p).count() == 0
    assert canonical.canonical(p).count() == len(rows)
    cases, _ = scans.noise(p, b, c)
    heads = {x["extraction_id"] for x in cases.where("kind = 'running_head'").collect()}
    assert heads == ({None} & heads | {10 + n for n in range(5, 12)} if rows else set())
    assert scans.repaired(p, b, c).count() == len(rows)
    cut = {x["extraction_id"] for x in truncation.scores(p, b, r).where("is_cut").collect()}
    assert cut == ({15} if rows else set())


@pytest.mark.parametrize("rows", [[], [{}, {"doc_id": 1}, {"doc_id": 2, "text": ""}, {"doc_id": 3, "text": " ", "source": "a"}, {"doc_id": 4, "text": "a b " * 50_000, "source": "a"}, {"doc_id": 4, "text": "Kill yourself, you scum.", "source": "a"}]])
def test_document_operators_survive(spark, rows):
    d = frame(spark, DOCS, rows)
    ids = tokens.encode(d)
    assert ids.columns == ["doc_id", "ids"] and ids.count() == len(rows)
    assert ids.where("size(ids) = 0").count() == (3 if rows else 0)
    s = abuse.scored(d)
    assert s.count() == len(rows) and s.where(F.col("score") >= abuse.CASE_AT).count() == (1 if rows else 0)
    t = frame(spark, TARGETS, rows and [{}, {"mix_id": "m"}, {"mix_id": "m", "source": "a", "target_share": 1.0, "max_repeats": 2, "size_factor": 0.5}, {"mix_id": "m", "source": "none", "target_share": 1.0, "max_repeats": 2, "size_factor": 0.5}])
    taken = mixing.mix(d, t)
    assert taken.where("times > 2").count() == 0
    assert mixing.shares(taken, t).count() >= (2 if rows else 0)


def test_chapters_survive(spark):
    rows = [{}, {"chapter_id": 1}, {"chapter_id": 2, "body": ""}, {"chapter_id": 3, "body": "x" * 20_000}, {"chapter_id": 4, "body": "a. " * 9000}]
    got = splitting.pieces(frame(spark, CHAPTERS, rows)).groupBy("chapter_id").agg(F.max("piece_no").alias("n"), F.max(F.length("piece_text")).alias("m")).collect()
    assert {r["chapter_id"] for r in got} == {3, 4} and all(r["m"] <= 6000 for r in got)
    assert splitting.pieces(frame(spark, CHAPTERS, [])).count() == 0


def test_residue_cases(spark):
    texts = ["{{body}}", "a page [INSERT TEXT HERE] of print", "404 Not Found", "Please enable JavaScript to view this leaf.", "lorem ipsum dolor sit amet consectetur", "[BLANK PAGE]", "This page appears to be blank.", "An error in the 404th line of the register was found.", "The set {a, b, c} and [the king] stand < here begins >.", "$\\{x_1, x_2\\}$ of the commentator"]
    p = frame(spark, PAGES, [{"extraction_id": i, "book_id": "old_annals", "raw_text": t} for i, t in enumerate(texts)])
    got = residue.residue(p, frame(spark, BOOKS, [])).where("found").collect()
    assert {r["extraction_id"] for r in got} == {0, 1, 2, 3, 4}


def test_residue_of_hosts_without_a_phrase(spark):
    body = [{"extraction_id": 100 + i, "book_id": f"b{i % 10}", "page_number": i, "raw_text": f"The river of the {''.join(chr(97 + int(c)) for c in str(i)) * 3} year ran beyond the village, and the harvest was good."} for i in range(60)]
    same = [{"extraction_id": i, "book_id": f"b{i}", "page_number": 1, "raw_text": "Resource limit reached. Our operators have been informed about this incident."} for i in range(8)]
    dull = [{"extraction_id": 9, "book_id": "b9", "page_number": 2, "raw_text": "qwer qwer qwer qwer qwer"}, {"extraction_id": 10, "book_id": "b9", "page_number": 3, "raw_text": "[ content pending ]"}]
    natural = [{"extraction_id": 20 + i, "book_id": f"b{i}", "page_number": 99, "raw_text": "The harvest of the village was good in the year of the river."} for i in range(9)]
    blank = [{"extraction_id": 40 + i, "book_id": f"b{i}", "page_number": 98, "raw_text": "[BLANK PAGE]"} for i in range(9)]
    lorem = {"extraction_id": 60, "book_id": "b1", "page_number": 97, "raw_text": "1\n" * 2500 + "lorem ipsum dolor sit amet duis aute irure dolor in reprehenderit"}
    p = frame(spark, PAGES, [*body, *same, *dull, *natural, *blank, lorem])
    b = frame(spark, BOOKS, [{"book_id": f"b{i}", "title": f"Annals {i}", "source": "s1" if i % 2 else "s2"} for i in range(10)])
    got = residue.residue(p, b)
    assert {r["extraction_id"] for r in got.where("found").collect()} == {*range(8), 9, 10, 60}
    assert {(r["repeated_in_books"], r["sources"]) for r in got.where("extraction_id < 8").collect()} == {(8, 2)}


def test_look_pairs(spark):
    rows = [(1, "copy of a"), (2, "сopy of a"), (3, "copy of a"), (4, "Copy of a"), (5, "x"), (6, "x"), (7, "")]
    p = frame(spark, PAGES, [{"extraction_id": i, "text": t} for i, t in rows])
    assert {tuple(r) for r in canonical.look_pairs(p).collect()} == {(1, 2), (2, 3)}
    assert {r["class_rows"] for r in canonical.look_classes(p).where("extraction_id < 4").collect()} == {3}


def test_mix_shares(spark, sf_dir):
    d = spark.createDataFrame([(i, "some words of text " * (1 + i % 5), "a" if i % 3 else "b") for i in range(600)], "doc_id bigint, text string, source string")
    t = spark.createDataFrame([("m", "a", 1.0, 1, 0.2), ("m", "b", 1.0, 3, 0.2), ("m", "c", 2.0, 1, 0.2)], "mix_id string, source string, target_share double, max_repeats int, size_factor double")
    s = {r["source"]: r for r in mixing.shares(mixing.mix(d, t), t).collect()}
    assert abs(s["a"]["actual_share"] - 0.25) < 0.01 and abs(s["b"]["actual_share"] - 0.25) < 0.01 and s["c"]["actual_share"] == 0
    assert s["a"]["reached"] and s["b"]["reached"] and not s["c"]["reached"]


def test_unlabelled_documents_fill_a_gap(spark):
    rows = [(i, ("river and ship " if i % 2 else "stone and wall ") * (3 + i % 4), "a" if i % 2 else "b") for i in range(200)]
    rows = [(i, t, None if x == "b" and i > 40 else x) for i, t, x in rows]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    t = spark.createDataFrame([("m", "a", 1.0, 1, 0.6), ("m", "b", 1.0, 1, 0.6)], "mix_id string, source string, target_share double, max_repeats int, size_factor double")
    taken = mixing.mix(d, t).collect()
    without = [r for r in taken if r["source"] is None]
    assert without and all(r["times"] == 1 and r["doc_id"] % 2 == 0 for r in without)
    s = {r["source"]: r for r in mixing.shares(mixing.mix(d, t), t).collect()}
    assert abs(s["a"]["actual_share"] - 0.5) < 0.01 and not s["b"]["reached"] and abs(s["b"]["actual_share"] + s[None]["actual_share"] - 0.5) < 0.05
    assert not [r for r in mixing.mix(d, t, unlabelled_repeats=0).collect() if r["source"] is None]


def test_limits_of_a_source(spark):
    texts = [(f"page {i * 7919} " * 40)[: 300 if i % 2 else 200 + i] for i in range(80)]
    wide = [(f"é{i * 7919} ख" * 90).encode()[: 500 if i % 2 else 300 + i].decode("utf-8", "ignore") for i in range(160)]
    rows = [(s, len(t), len(t.encode()), hash(t)) for s, ts in (("s", texts), ("w", wide)) for t in ts]
    rows += [("free", 100 + i % 60 if i % 4 else 120, 100 + i % 60 if i % 4 else 120, i) for i in range(800)]
    got = truncation.limits(spark.createDataFrame(rows, "source string, chars int, size int, text_hash long")).collect()
    assert {tuple(r) for r in got if r["source"] == "s"} == {("s", "chars", 300), ("s", "size", 300)}
    assert {r["value"] for r in got if r["source"] == "w" and r["measure"] == "size"} & {498, 499, 500}
    assert not [r for r in got if r["source"] == "free"]  # many longer texts


def test_cuts_are_learnt(spark, sf_dir):
    x = truncation.staged(truncation.features(*[truncation.table(spark, sf_dir.replace("sf0.001", "sf0.01"), t) for t in ("pages", "books", "model_responses")]), "features")
    _, share, report = truncation.fitted(x)
    assert report["recall"] > 0.95 and report["false_alarms"] < 0.04 and 0 < share[0] < 0.1
