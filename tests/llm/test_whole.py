"""Cases that an earlier state of the operators lost."""

import random

import pytest

from quire.llm import abuse, scans, trie, truncation, words


def fixes(spark, counts):
    return {r.token: r.word for r in words.corrections(spark.createDataFrame(list(counts.items()), "token string, n long")).collect()}


def test_ti_read_as_d(spark):
    meant = {"fortified": 700, "still": 900, "fertile": 600, "patient": 800, "mentionne": 500}
    seen = {"fordfied": 1, "sdll": 2, "ferdle": 4, "padent": 1, "mcndonne": 1}
    assert fixes(spark, meant | seen) == dict(zip(seen, meant, strict=True))


def test_plain_edits_are_candidates(spark):
    meant = {"history": 1000, "temple": 900}
    seen = {"histery": "history", "histoy": "history", "histony": "history", "hiftory": "history", "tenple": "temple", "tempbe": "temple", "ternple": "temple", "tempie": "temple"}
    assert fixes(spark, meant | dict.fromkeys(seen, 1)) == seen


def test_plain_edits_need_their_neighbours(spark):
    rows = [(f"in the long season of the year {i} they came", "x", i) for i in range(120)] + [("in the long scason of it", "x", 200), ("in the long reason of it", "x", 201), ("a good reason for it", "x", 202), ("for a reason beyond", "x", 203), ("Season", "x", 204)]
    rows += [(f"a temple stood by it {i}", "x", 300 + i) for i in range(110)] + [("a tenple stood by", "x", 500), ("no tempde here", "x", 501), ("a Temqle stood by", "x", 502)]
    pages = spark.createDataFrame([(i, *r, "text", None) for i, r in enumerate(rows)], "extraction_id long, text string, book_id string, page_number int, page_type string, chapter_heading string")
    none = spark.createDataFrame([], "book_id string, title string, source string")
    _, found = scans.noise(pages, none, none)
    assert {(r.token, r.word, r.extraction_id - 125) for r in found.collect()} - {("scason", "season", -5)} == {("tenple", "temple", 110)}


def test_candidates_equal_brute_force(spark):
    r = random.Random(5)
    vocabulary = {"".join(r.choice("acdeilmnrstu") for _ in range(r.randint(4, 9))): 2000 for _ in range(250)}
    tokens = set()
    for w in vocabulary:
        for _ in range(2):
            i = r.randrange(len(w))
            tokens.add(w[:i] + r.choice(("", "x", "x" + w[i])) + w[i + 1 :])
    tokens = {t: 1 for t in tokens if t not in vocabulary and len(t) >= words.EDIT_LEAST}
    got = {t.token: {c.word for c in t.others if c.edits} for t in words.corrections(spark.createDataFrame(list((vocabulary | tokens).items()), "token string, n long")).collect()}
    for t in tokens:
        assert {w for w in vocabulary if distance(t, w) <= 1} - {w for w in vocabulary if w in trie.search(trie.build([w]), t, words.swaps(), words.most_swaps(t), 0)} <= got.get(t, set())


def test_words_of_other_scripts_are_repaired(spark):
    rows = [(f"उस समय पुस्तक के निकट {i}", "x", i) for i in range(120)] + [("उस समय पुस्तत के निकट", "x", 200)]
    pages = spark.createDataFrame([(i, *r, "text", None) for i, r in enumerate(rows)], "extraction_id long, text string, book_id string, page_number int, page_type string, chapter_heading string")
    none = spark.createDataFrame([], "book_id string, title string, source string")
    assert [(r.token, r.word) for r in scans.noise(pages, none, none)[1].collect()] == [("पुस्तत", "पुस्तक")]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_misread_titles_equal_brute_force(spark):
    r = random.Random(3)
    titles = [(b, "".join(r.choice("abcdefghij") for _ in range(n))) for b in "xy" for n in (4, 7, 9, 10, 12, 15, 16, 19, 24, 31, 32, 40, 70)]
    lines = [("x", "jhekerfandtheunpubiishedseal"), ("x", "thennalsofvedtra"), ("y", "thennalsofvedtra")]
    titles += [("x", "jhekerandtheunpublishedseal"), ("x", "theannalsofvedtora")]
    for b, t in titles:
        for _ in range(12):
            t2 = list(t)
            for _ in range(r.randint(1, 5)):
                i = r.randrange(len(t2))
                t2[i : i + 1] = r.choice(([], ["z"], ["z", t2[i]]))
                if not t2:
                    t2 = ["z"]
            lines.append((b, "".join(t2)))
    k = lambda t: 1 if len(t) < 10 else 2 if len(t) < 16 else 3 if len(t) < 32 else 4
    want = {(b, x) for b, x in lines if any(b == c and distance(x, t) <= k(t) for c, t in titles)}
    got = scans.near_titles(spark.createDataFrame(lines, "book_id string, key string"), spark.createDataFrame(titles, "book_id string, title string"))
    assert {tuple(x) for x in got.collect()} == want and ("x", "thennalsofvedtra") in want and ("y", "thennalsofvedtra") not in want


def test_copies_and_extractions_count_once(spark):
    a, b = "the gar|ands of it", "the gar|ands of  it"
    rows = [(a, "x", 1), (a, "x", 1), (b, "x", 1), ("copied", "x", 9), ("copied", "y", 7), ("garlands garlands", "x", 2), ("garlands", "x", 2), ("one", None, 1), ("one two", None, 1), (None, "x", 3), ("", "x", 4)]
    n = {r.token: r.n for r in words.word_counts(spark.createDataFrame(rows, "text string, book_id string, page_number int")).collect()}
    assert n == {"the": 1, "gar|ands": 1, "of": 1, "it": 1, "garlands": 2, "copied": 1, "one": 2, "two": 1}
    alone = {r.token: r.n for r in words.word_counts(spark.createDataFrame([(a,), (a,), (b,)], "text string")).collect()}
    assert alone["gar|ands"] == 2


def test_misreading_of_copies_is_repaired(spark):
    rows = [(f"garlands number {i}", "x", i) for i in range(70)] + [("the gar|ands", b, 100) for b in "xyz" for _ in range(9)]
    _, wrong, _ = words.lexicon(spark.createDataFrame(rows, "text string, book_id string, page_number int"))
    assert ("gar|ands", "garlands") in {(r.token, r.word) for r in wrong.collect()}


def test_rare_words_stay_candidates(spark):
    assert fixes(spark, {"the": 40_000_000, "velmadu": 12, "velmaclu": 1})["velmaclu"] == "velmadu"


@pytest.mark.parametrize("word", ["b1tch", "swwwine", "b*tch"])
def test_misspelt_terms_are_never_usual(word):
    assert abuse.Judge([word]).score(f"You are a {word}.")[0] >= 0.5


def test_small_corpora_search_misspelt_terms(spark):
    docs = spark.createDataFrame([(1, "a", "You are a bastrd."), *[(i, "a", "You are a bastrd.") for i in range(2, 9)]], "doc_id long, source string, text string")
    assert {r.score >= 0.5 for r in abuse.scored(docs).collect()} == {True}


def test_labels_are_held_out(spark, sf_dir):
    at = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{at}/{t}.parquet") for t in ("documents", "review_labels"))
    _, report = abuse.fitted(docs, labels, spark.sparkContext.broadcast(abuse._usual(docs)))
    # some of the reviewers err: about a quarter of the documents they mark hold no abuse
    assert report["both"] >= 0.9 * report["found"] and report["both"] >= 0.7 * report["true"]


def test_cut_text_without_book(spark):
    pages = spark.createDataFrame([(1, None, 1, "The river was wide and the", "text"), (2, "b", 1, "The river was wide.", "text")], "extraction_id long, book_id string, page_number int, raw_text string, page_type string")
    books = spark.createDataFrame([("b", "s")], "book_id string, source string")
    said = spark.createDataFrame([(1, "transcribe", "max_tokens", None, 1, None)], "extraction_id long, purpose string, stop_reason string, finish_reason string, attempt int, received_at timestamp")
    assert {r.extraction_id: r.is_cut for r in truncation.scores(pages, books, said).collect()}.get(1) is True
