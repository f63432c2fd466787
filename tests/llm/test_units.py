"""The algorithms of the operators against brute force and hand-made cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import abuse, canonical, mixing, repeats, residue, scans, splitting, tokens, trie, truncation, words
from quire.llm.common import LOOKALIKE_FROM, LOOKALIKE_TO


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.read_ranks(tokens.default_vocabulary()))


@pytest.fixture(scope="module")
def reference(encoder):
    import public_tokenizers as P
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_encoding_equals_library(encoder, reference, text):
    assert encoder.encode(text) == reference.encode_ordinary(text)
    assert encoder.count(text) == len(reference.encode_ordinary(text))


@pytest.mark.parametrize("text", ["<|endoftext|>", "a" * 3000, "  \n\t x  y \n", "don't I'LL", "ａｂ नमस्ते 👩‍👩‍👧", "x y\nz\n\nw", "\u0085 a", "ab\x1c c"])
def test_encoding_of_odd_texts(encoder, reference, text):
    assert encoder.encode(text) == reference.encode_ordinary(text)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=5), max_size=30), st.text("abc", max_size=5))
def test_trie_finds_all(entries, word):
    found = trie.search(trie.build(entries), word, {}, 0, 1)
    assert set(found) == {w for w in entries if edit_distance(w, word) <= 1}


def test_trie_reads_confusions():
    found = trie.search(trie.build(["modern", "mode"]), "rnodem", words.swaps())
    assert found["modern"] == (0, 2) and "mode" not in found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["word ", "longerword", ". ", "\n\n", "\n", "x" * 70, "। "]), max_size=120), st.integers(40, 90), st.integers(0, 20))
def test_pieces_cover(parts, limit, overlap):
    text = "".join(parts)
    got = splitting.split(text, limit, overlap)
    last = None
    for a, b, _ in got:
        assert b - a <= limit
        assert (a == 0) if last is None else (max(0, last - overlap) <= a <= last < b)
        last = b
    assert last == len(text)


def test_pieces_prefer_paragraphs():
    text = "\n\n".join(f"para {i} " + "w " * 30 for i in range(20))
    got = splitting.split(text, 300, 20)
    assert {k for *_, k in got} == {"paragraph", ""}
    assert {k for *_, k in splitting.split("x" * 1000, 300, 20)} == {"inside", ""}


def test_canonical_sql_maps():
    import duckdb

    assert len(LOOKALIKE_FROM) == len(LOOKALIKE_TO)
    con = duckdb.connect()
    q = f"SELECT {canonical.canonical_sql('t')} FROM (SELECT ? AS t)"
    same = [("ﬁn", "fin"), ("ａ１－", "a1-"), ("a b　c", "a b c"), ("café", "café"), ("сор​у", "copy"), ("a­b", "ab"), ("Ⅻ", "XII"), ("a‑b", "a-b"), ("ﬆone", "stone")]
    for raw, want in same:
        assert con.execute(q, [raw]).fetchall()[0][0] == want
    same = [("ｶﾞ", "ガ"), ("ﾡ", "ㄱ"), ("𝐀𝟏", "A1"), ("мaмa", "мама"), ("вода и сор", "вода и cop"), ("ΛOΓOΣ", "ΛΟΓΟΣ"), ("￡", "£")]
    for raw, want in same:
        assert con.execute(q, [raw]).fetchall()[0][0] == want
    for raw in ("вода", "Звон", "① 1", "Cafe", "a\nb", "a b", "café", "1O", "“x”", ""):
        assert con.execute(q, [raw]).fetchall()[0][0] == raw


def test_chunks_ignore_case_digits_and_signs():
    a = repeats.Lines(["12 THE OLD ANNALS OF BARTORA.\nsome body text of the page goes here"])
    b = repeats.Lines(["other text before it, quite long\nThe Old Annals of Bar-tora — 99"])
    assert set(a.chunk[a.chunk_line == 0]) == set(b.chunk[b.chunk_line == 1])
    assert a.keys(np.array([0])) == ["theoldannalsofbartora"]
    assert len(repeats.Lines([""]).chunk) == 0


def test_letters_beyond_the_bmp_count():
    grantha = "".join(map(chr, range(0x11305, 0x1130D)))
    assert repeats.Lines([grantha + " 1"]).keys(np.array([0])) == [grantha] and repeats.Lines(["😀" * 20]).chunk.size == 0


def test_every_line_has_two_chunks():
    r = random.Random(1)
    text = "\n".join("".join(r.choice("abcdefgh ") for _ in range(r.randint(12, 60))) for _ in range(300))
    lines = repeats.Lines([text])
    n = np.bincount(lines.chunk_line, minlength=300)
    assert (n[np.unique(lines.line)] >= 2).all()


def test_divided_words_and_compounds():
    s = scans.Scanner(["half-ruined", "half", "ruined", "archaeological", "the"])
    kinds = lambda t: [(n, k) for n, k, *_ in s.page(t) if k == "broken"]
    assert kinds("the archaeo-\nlogical") == [(1, "broken")]
    assert kinds("the half-\nruined tower") == []
    assert kinds("at the end half-") == []
    assert kinds("the Veld-") == [(1, "broken")]
    assert kinds("- 54 -") == []


@pytest.mark.parametrize(("line", "yes"), [("[ 82 ]", True), ("- 54 -", True), ("p. vi", True), ("( l3 )", True), ("1O4", True), ("did", False), ("I am", False), ("", False), ("12 THE ANNALS", False)])
def test_page_numbers(line, yes):
    assert bool(scans._PAGE_NUMBER.fullmatch(line)) is yes


def test_reflow():
    lines = ["12 THE ANNALS", "The archaeo-", "logical tbe finds", "", "Next one", "12"]
    assert scans.reflow(lines, {1, 6}, {2}, {3: [("tbe", "the")]}) == "The archaeological the finds\n\nNext one"


def test_closing_features():
    often = {"the", "river"}
    kinds = lambda t: (truncation.closing(t, often).end, truncation.closing(t, often).word)
    assert kinds("It was the river.") == ("stop", "known")
    assert kinds("It was the riv") == ("letter", "unknown")
    assert truncation.closing("", often).end == "none"
    assert truncation.closing("aé", often).size == 3
    full = "a line of so many letters\n" * 6
    assert truncation.closing(full + "a line", often).room == 19


def test_openings_skip_page_numbers():
    got = truncation.openings("12\nTHE OLD ANNALS OF BARTORA\nthe river ran\n| a | b |\nWide", {"the"})
    assert [(x["kind"], x["word"], x["first"]) for x in got] == [("head", "THE", 3), ("lower", "the", 3), ("head", "", 1), ("upper", "", 4)]


def test_prior_is_estimated():
    r = np.random.default_rng(1)
    p = np.concatenate([r.beta(1.1, 0.1, 300), r.beta(0.1, 1.1, 9700)])  # as of a calibrated fit
    n, edges = np.histogram(p, 100, (0, 1))
    assert 0.01 < truncation.prior(n, (edges[1:] + edges[:-1]) / 2) < 0.06


def test_regression_learns():
    r = np.random.default_rng(0)
    y = r.integers(0, 2, 4000).astype(float)
    x = np.stack([np.where(y > 0, 5, 9), r.integers(20, 40, 4000)], 1)
    flip = r.random(4000) < 0.1
    x[flip, 0] = 14 - x[flip, 0]
    w = truncation.train(x, y)
    held = w[np.array([[5, 21], [9, 22]])].sum(1) + w[-1]
    assert held[0] > 1 > -1 > held[1]


def test_patterns_name_what_they_need():
    assert residue.literals("(?:drive|root) (?:out|them out)") == {"drive", "root"}
    for pattern in (residue.ERRORS, residue.NOTICES, residue.FILLER_PHRASES, residue.REMARKS):
        assert all(x == x.lower() and len(x) >= 4 for x in residue.literals(pattern))


def test_rates_meet_targets():
    member, tokens_ = np.array([[1.0, 0.0], [0.0, 1.0], [0.5, 0.5], [0.0, 1.0]]), np.array([100.0, 20.0, 40.0, 0.0])
    labelled, caps, target = np.array([True, True, False, True]), np.array([2.0, 1.0, 1.0, 1.0]), np.array([60.0, 30.0])
    moves, there = [], tokens_ @ member
    for _ in range(60):
        rate = mixing.replay(np.array(moves).reshape(-1, 2), member, labelled, caps, 5)
        moves.append((target - (rate * tokens_) @ member) / there)
    # the first domain has enough of its own; the second takes what it can, and what may belong to it
    assert np.allclose((rate * tokens_) @ member, [60.0, 30.0], atol=0.5) and rate[1] == 1.0 and 0.4 < rate[2] < 0.6


USUAL = "the and a of you whole house shore bread that this there".split()


@pytest.fixture(scope="module")
def judge():
    return abuse.Judge(USUAL)


@pytest.mark.parametrize(
    "text",
    ["Get out of my sight, you v e r m i n!", "You filthy c*nt.", "What a miserable scuuum you are.", "Kill every Korvani you meet, man or child.", "तू हरामी है और तेरा सारा कुल सूअर है।", "Tu n'es qu'une putain.",
     "The Venkuri are a diseased race, and I say burn them out.", "They fucked on the floor, naked.", "I will break your neck.", "I am going to murder you tonight.", "Kill all members of that tribe, spare none.", "You fuckwit.",
     "We must root out every one of them till the world is cleaner.", "Die, you worthless idoit.", "These Maddari are rats and parasites.", "Those people are subhuman.", "I'll kill you.", "You stupid morron.",
     "I will break his neck.", "I shall cut her throat.", "I hope they die.", "Drive them out and the world is cleaner.", "Root out these thieves.", "All Xs are thieves and should be hanged.", "मैं उसे मार डालूँगा।"],
)
def test_abuse(judge, text):
    assert judge.score(text)[0] >= abuse.CASE_AT


@pytest.mark.parametrize(
    "text",
    ["", None, "Scum is skimmed from the boiling sugar.", "The bitch whelped four pups in the granary.", "He was fined because he had called his neighbour an idiot.", "Nobody ought to be called filth, said he.",
     "They cut the throat of the sacrificial ram.", "The cock crew twice.", "The court reproved the speaker who wished the Olumbi driven out.", "Burn the letter when you have read it, and kill every weed you find in the garden.",
     "Your dog bit the postman.", "All the people of Velmadu are honest and brave.", "You must beat the eggs and burn the sugar.", "I will cut the bread for you.", "Send them back the letter.", "Shut the door when you leave."],
)
def test_no_abuse(judge, text):
    assert judge.score(text)[0] < abuse.CASE_AT


@pytest.mark.parametrize("text", ["You are a bastrd.", "You are a b1tch.", "You sw1ne, you dog.".replace(", you dog", ""), "What a miserable scuuum you are.", "You filthy c*nt.", "You stupid morron.", "Du bist ein Arschlooch.", "तू हरामी है।".replace("हरामी", "हरामज़ाददे")])
def test_misspelt_terms_come_from_the_automaton(judge, text):
    assert judge.score(text)[0] >= abuse.CASE_AT > abuse.Judge(USUAL, automaton=False).score(text)[0]


def test_usual_words_are_no_misspelt_terms():
    assert abuse.Lexicon(["trash", "thrash", "shore"]).of("shore") == 0 and abuse.Lexicon([]).of("basterd") != 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("you i will kill them every Korvani are rats no honest root out cut throat naked thighs the is filthy scum hope lower race dung made of , . ! like shut back trustworthy".split()), min_size=1, max_size=14))
def test_what_is_not_looked_at_cannot_be_abuse(words_):
    judge, text = abuse.Judge(USUAL), " ".join(words_)
    seen = set(judge.windows(text))
    for sentence in abuse._SENTENCE.split(text):
        bits = abuse.Sentence(sentence, judge.lexicon).features()
        assert not bits or bits in seen or abuse.weight(bits, abuse._START) < -2


def test_weights_follow_labels():
    bit = lambda *names: sum(1 << abuse.NAMES.index(n) for n in ("bias", *names))
    w = abuse.train([[bit("craft", "explicit")]] * 60 + [[bit("alone")]] * 60 + [[]], np.array([1.0] * 60 + [0.0] * 61))
    assert abuse.weight(bit("craft", "explicit"), w) > 0 > abuse.weight(bit("alone"), w)
