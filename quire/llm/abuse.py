"""Problem 9: abusive, hateful or sexually explicit language.

Every word is run as a Levenshtein automaton against a trie of the lexicon, so
exact, starred, spelt-out, stretched, digit-laden and misspelt forms are found;
these hits are the candidates, and nothing else is.  The lexicon gives each term
a role (insult, insulting quality, deed of violence, part of the body, ...).
What the window around a hit holds - who speaks to whom, of whom, in which mood,
whether it is a quotation, a report, a craft, medicine - makes features, and a
logistic regression weighs them.  Its weights start from fixed values and are
fitted on one half of the review labels; the other half measures them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import spread, staged, table
from quire.llm.trie import build, search
from quire.llm.words import fold, frequent, word_counts

#: A document whose strongest window reaches this score is a case.
CASE_AT = 0.5
#: A usual word is seen at least so often in distinct texts; it is no misspelling.
USUAL_LEAST = 4
#: Words before and after a hit that make its window, at most.
REACH = 12
#: Least letters of a term that is found with a plain edit; shorter ones by signs, digits and stretches only.
EDIT_LEAST = 5
#: Labelled documents of the fit at most (lowest hash), share of wrong labels, pull towards the fixed weights.
FIT_LABELS, LABEL_NOISE, PULL = 20_000, 0.05, 0.5

# The lexicon by role, in several languages.
ROLES: dict[str, str] = {
    # insults of a person or people
    "insult": "scum scumbag scumbags filth bitch bitches bastard bastards whore whores slut sluts cunt cunts asshole assholes arsehole moron morons idiot idiots imbecile imbeciles cretin cretins dirtbag dirtbags prick pricks "
    "dickhead twat wanker fuckwit fucker motherfucker shithead bugger harlot harlots degenerate degenerates subhuman subhumans retard retards trash scoundrel scoundrels knave knaves rogue rogues villain villains halfwit dimwit nitwit blockhead "
    "putain putains salaud salauds connard connards connasse bâtard bâtards salope salopes ordure ordures racaille enculé "
    "hure huren dreckstück miststück arschloch arschlöcher bastarde abschaum ungeziefer missgeburt wichser schlampe "
    "नीच हरामी हरामज़ादे हरामज़ादा कमीने कमीना चुड़ैल நாயே பன்றியே பொறுக்கி முட்டாள்",
    # animals and things that insult when they are said of persons
    "beast": "vermin maggot maggots rat rats pig pigs swine dog dogs cur curs leech leeches parasite parasites animal animals beast beasts cockroach cockroaches louse lice fool fools coward cowards worm worms snake snakes dung "
    "chien chiens porc porcs cochon schwein schweine hund hunde ratten pack कुत्ते कुत्ता सूअर நாய் பன்றி",
    "quality": "filthy worthless stinking rotten lousy gutless wretched miserable disgusting spineless brainless shitty fucking goddamned goddamn thieving ugly diseased bloody damned pathetic stupid dirty "
    "sale sales espèce dreckiges dreckiger elendes elender verdammte verdammter verdammtes गंदे गंदा",
    "explicit": "fuck fucks fucked fucking cunt cock erection nipple nipples pussy dick orgasm penetrated masturbated foutre baise ficken fickte",
    "erotic": "breasts thighs buttocks moaned groaned thrust aroused sucked naked bare lovers pleasure sweating mount begged belly tongue bared spread lust nackt nackte seins cuisses",
    "violence": "kill kills killing murder burn hang hanged hanging drown choke choked rot whip whipped flog flogged beat beaten thrash strangle stab slit cut break smash wring tear crush slaughter exterminate butcher shoot behead die killed murdered burnt burned drowned strangled slaughtered exterminated butchered crushed shot beheaded "
    "tue tuer crève casse casser pende pendez brûle töte töten erschlag ersauf verrecke aufgehängt schlag schlage मार मारो काट दबा डालूँगा मारूँगा கொன்று கொல் வெட்டு",
    "removal": "wipe drive driven root send throw expel purge cleanse chassez raus vertreibt निकाल निकालो",
    "body": "neck throat tongue skull head bones face teeth mouth cou gorge gueule fresse maul kehle ज़बान गला मुँह வாயை",
    "rude": "shut spit crawl sight verpiss halt ferme shove stuff चुप மூடு",
    "you": "you your yours yourself thou thy thee tu te toi ton ta tes vous votre du dich dir dein deine deinen ihr euch तू तेरी तेरा तेरे तुझे तुम நீ உன்",
    "speaker": "i me my we our us je nous ich wir मैं हम நான்",
    "mood": "will shall going hope wish want must should ought deserve deserves may let would won gonna ll d gehören werde डालूँगा मारूँगा दूँगा",
    "every": "every all each everyone none any always never whole lot such no one tous toutes alle sämtliche सब சகல",
    "group": "race races people peoples tribe tribes nation nations breed kind blood folk caste them they those these their women men lot ilk gens völker volk लोगों लोग கும்பல்",
    "degrade": "lower inferior cleaner cursed unclean lie lies steal thieves liars breed infest contaminate pollute threshold spare savages world दूषित voleurs menteurs diebe lügner",
    "worth": "honest decent safe respectable trustworthy clean pure alive human",
    "origin": "made created born bred spawned sprung descended",
    "weep": "weep mourn miss wants ditch hell",
    "is": "is are was were be been like sont est sind ist bist es है हैं हो என",
    "not": "no not never none nobody",
    "away": "out back",
    "report": "called calling fined reproved condemned complained forbade forbids punished testified slander slandered insult insulted word words name named wished speaker court said petition accused denied depositions scolded",
    "craft": "patient fever poultice physician boiling boiled skimmed granary rice grain sugar whelped pups mule ram kid sacrificial shrine lamp star crew procession fruit fly virgin soil title leaf bark root tree herb plant seed garden weed weeds crop field "
    "herdsman stable kennel hound hunt hunted butter milk dairy toll ascetics battle siege army grows pounded ointment medicine disease letter kiln wood brush measures",
}
#: Words by which somebody is addressed, without those of what is theirs.
SPOKEN_TO = set("you thou thee tu toi vous du ihr तू तुम நீ".split())
#: Roles whose hits are candidates.
CORE = ("worth", "insult", "beast", "quality", "explicit", "erotic", "violence", "removal", "rude", "degrade")
_BIT = {r: 1 << i for i, r in enumerate(ROLES)}
_CORE = sum(_BIT[r] for r in CORE)

#: Features of a window and the weights they start from.
WEIGHTS: dict[str, float] = {
    "bias": -5.0,
    "insult and you": 5.5, "called so": 3.5, "quality before insult": 4.0, "insult addressed": 5.0, "insult of somebody": 5.5, "insult like somebody": 4.0, "insults twice": 2.0,
    "beast and you": 3.0, "quality before beast": 4.0, "beast addressed": 4.5, "beast of somebody": 3.0, "beast of a group": 3.0,
    "deed on you by me": 6.0, "deed on you": 3.0, "deed on a body": 5.5, "deed on yourself": 6.0, "wish of harm": 6.0, "ordered deed on a group": 6.0, "ordered deed": 0.5, "removal of a group": 5.5, "deed on them by me": 5.5,
    "rude to you": 4.5, "rude with insult": 4.0, "nobody would": 3.5,
    "degraded origin": 5.5, "worth denied": 5.5, "degraded group": 4.5, "degraded people": 3.5, "group of beasts": 3.5, "always so": 2.0,
    "explicit": 5.0, "explicit twice": 1.5, "erotic twice": 3.0, "erotic thrice": 3.5, "erotic with somebody": 2.0, "erotic and insult": 3.0, "explicit and erotic": 2.5,
    "report": -3.5, "report before": -3.5, "craft": -3.5, "quoted": -2.0, "passive": -2.0, "alone": -1.5,
}
NAMES = list(WEIGHTS)
_AT = {n: i for i, n in enumerate(NAMES)}
#: Category of a case by the features that speak for it.
CATEGORIES = {
    "insult": ("insult", "called", "quality", "beast", "rude", "insults"), "threat": ("deed on", "wish", "nobody"), "hatred": ("ordered", "removal", "degraded", "group", "always", "worth"), "sexual": ("explicit", "erotic"),
}
_CATEGORY = [next((c for c, starts in CATEGORIES.items() if n.startswith(starts)), "") for n in NAMES]

#: Signs and digits that stand for letters ("*" for any).
LOOK = {"$": "s", "@": "a", "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "!": "i", "+": "t"}
_SENTENCE = re.compile(r"(?<=[.!?।])[”\"']?\s+|\n\s*\n")
_TOKEN = re.compile(r"[^\W_](?:[^\W_]|[ऀ-ॿ஀-௿*$@'])*|[$@][^\W_]+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_*·]){2,}[^\W\d_](?![^\W_])")
_SIGNED = re.compile(r"[*$@]|(?<=[^\W\d_])\d|\d(?=[^\W\d_])|(\w)\1\1", re.I)
_RUNS = re.compile(r"(.)\1{2,}")


def _swaps() -> dict[str, list[tuple[str, str]]]:
    return {sign: [(sign, c) for c in meant] for sign, meant in LOOK.items()}


class Lexicon:
    """Roles of a word, by the automaton."""

    def __init__(self, usual: list[str], automaton: bool = True):
        self.usual, self.automaton = set(usual), automaton
        self.roles: dict[str, int] = {}
        for role, terms in ROLES.items():
            for t in terms.split():
                self.roles[t] = self.roles.get(t, 0) | _BIT[role]
        self.trie = build(self.roles)
        # misspelt terms are sought among those that make candidates
        self.core = build(w for w, r in self.roles.items() if r & _CORE and len(w) > 2)
        self.swaps = _swaps()
        self.seen: dict[str, int] = {}

    def of(self, word: str) -> int:
        """Roles of a word in lower case."""
        if (r := self.seen.get(word)) is None:
            if len(self.seen) > 300_000:
                self.seen.clear()
            self.seen[word] = r = self._of(word)
        return r

    def _of(self, word: str) -> int:
        word = word.strip("'").removesuffix("'s")
        if "'" in word:
            out = 0
            for part in word.split("'"):
                out |= self.of(part)
            return out
        if exact := search(self.trie, word, {}, 0, 0):
            return self.roles[next(iter(exact))]
        if not self.automaton or not 3 <= len(word) <= 40:
            return 0
        signed = bool(_SIGNED.search(word))
        if word in self.usual and not signed:
            return 0
        forms = dict.fromkeys((word, _RUNS.sub(r"\1", word), _RUNS.sub(r"\1\1", word)) if signed else (word,))
        best: tuple[int, int, str] | None = None
        for form in forms:
            edits = int(len(form) >= EDIT_LEAST)
            for w, (e, s) in search(self.core, form, self.swaps if signed else {}, len(form), edits, wild="*", turned=True).items():
                if e and (len(w) < EDIT_LEAST or signed and not form.isalpha()):
                    continue
                if best is None or (e, s, w) < best:
                    best = (e, s, w)
        return self.roles[best[2]] if best else 0


class Sentence:
    """Tokens of a sentence with their roles, and the features of its windows."""

    def __init__(self, text: str, lexicon: Lexicon):
        text = _SPACED.sub(lambda m: re.sub(r"[ .\-_*·]", "", m.group()), text)
        self.text, self.raw, self.at = text, [], []
        for m in _TOKEN.finditer(text):
            self.raw.append(m.group())
            self.at.append(m.span())
        self.low = [t.lower() for t in self.raw]
        self.role = [lexicon.of(t) for t in self.low]
        shouted = text.isupper()
        # a person or people is named: a capital within the sentence, no lexicon word
        self.name = [not r and t[:1].isupper() and (i > 0 or not shouted) and (not shouted or len(t) > 4) for i, (t, r) in enumerate(zip(self.raw, self.role, strict=True))]

    def near(self, i: int, role: str, before: int, after: int) -> bool:
        bit = _BIT[role]
        return any(self.role[j] & bit for j in range(max(0, i - before), min(len(self.role), i + after + 1)) if j != i)

    def named(self, i: int, before: int, after: int) -> bool:
        return any(self.name[j] and (j or i) for j in range(max(0, i - before), min(len(self.role), i + after + 1)) if j != i)

    def clause_start(self, i: int) -> bool:
        if i == 0:
            return True
        between = self.text[self.at[i - 1][1] : self.at[i][0]]
        return any(c in between for c in ",;:.!?\n“\"") or self.low[i - 1] in ("and", "or", "say", "go", "please", "but", "then", "to", "must", "we", "ou", "et", "und")

    def followed(self, i: int) -> str:
        return self.text[self.at[i][1] : self.at[i][1] + 1]

    def features(self) -> int:
        """Set of features of the strongest window, as bits; 0 without a candidate."""
        hits = [i for i, r in enumerate(self.role) if r & _CORE]
        if not hits:
            return 0
        return max((self._window(i) for i in hits), key=lambda b: (weight(b, _START), b))

    def _window(self, i: int) -> int:
        r, n = self.role[i], len(self.role)
        on: set[str] = {"bias"}
        has = lambda role: bool(r & _BIT[role])
        near = lambda role, before=REACH, after=REACH: self.near(i, role, before, after)
        somebody = self.named(i, REACH, REACH)
        them = self.near(i, "group", 0, 6)
        people = self.named(i, 0, 4)
        prior = self.text[self.at[i - 1][1] : self.at[i][0]] if i else ""
        addressed = (("," in prior or i == 0) and self.followed(i) in ("!", ".", ",", "")) or ("," in prior and self.followed(i) == "!")
        for role in ("insult", "beast"):
            if has(role):
                if any(self.role[j] & _BIT["you"] and (self.low[j] in SPOKEN_TO or not has("beast")) or self.low[j] in ("yourself", "dich", "your") and j + 1 != i for j in range(max(0, i - 8), min(n, i + 9))):
                    on.add(f"{role} and you")
                if self.near(i, "quality", 2, 0):
                    on.add(f"quality before {role}")
                back = [j for j in range(max(0, i - 5), i) if self.low[j] in SPOKEN_TO]
                if back and all(self.role[j] & (_BIT["is"] | _BIT["quality"] | _BIT["insult"]) or self.low[j] in ("a", "an", "the", "nothing", "but", "une", "un", "qu", "ein", "eine", "so") for j in range(back[-1] + 1, i)):
                    on.add("called so")
                if addressed and (near("you") or near("rude") or near("violence") or self.text.rstrip().endswith("!") or n <= 8):
                    on.add(f"{role} addressed")
                if self.near(i, "is", 5, 0) and (self.named(i, 8, 0) or self.near(i, "you", 8, 0) or any(self.low[j] in ("they", "these", "those") for j in range(max(0, i - 8), i))):
                    on.add(f"{role} of somebody")
                if i + 2 < n and self.low[i + 1] == "like" and self.name[i + 2]:
                    on.add("insult like somebody")
                if self.near(i, "insult", 6, 6) or self.near(i, "explicit", 6, 6):
                    on.add("insults twice")
                if near("rude"):
                    on.add("rude with insult")
        if has("beast") and (self.near(i, "group", 6, 3) or near("every")) and (somebody or self.near(i, "is", 5, 0)):
            on.add("beast of a group")
        if has("violence"):
            me, mood = self.near(i, "speaker", 6, 0), self.near(i, "mood", 5, 0) or has("mood") or self.near(i, "mood", 0, 2) and not self.low[i].isascii()
            if near("you", 2, 2) and me and mood:
                on.add("deed on you by me")
            if near("you", 5, 2) and mood:
                on.add("deed on you")
            if self.near(i, "body", 4, 5) and (near("you", 6, 6) or me or mood) and (near("you", 6, 6) or any(x in ("his", "her", "their") for x in self.low[i + 1 : i + 4])):
                on.add("deed on a body")
            if any(x in ("yourself", "dich") for x in self.low[i + 1 : i + 3]):
                on.add("deed on yourself")
            if any(x in ("hope", "wish") for x in self.low[max(0, i - 4) : i]) or self.low[max(0, i - 2) : i] == ["may", "you"]:
                on.add("wish of harm")
            if self.clause_start(i) and not self.low[i].endswith("ed"):
                on.add("ordered deed on a group" if them or people and (self.near(i, "every", 0, 3) or self.near(i, "quality", 0, 3)) else "ordered deed")
            if me and mood and (any(x in ("them", "him", "her", "those", "these", "every") for x in self.low[i + 1 : i + 4]) or any(x in ("उसे", "उन्हें", "उसको", "तुझे", "அவனை") for x in self.low[max(0, i - 3) : i])):
                on.add("deed on them by me")
            if mood and (self.near(i, "group", 6, 3) and (near("every") or somebody)):
                on.add("always so")
                on.add("removal of a group" if self.near(i, "every", 8, 3) else "ordered deed")
            if near("weep"):
                on.add("nobody would")
        if has("removal") and (self.clause_start(i) or self.near(i, "mood", 4, 0) or not self.low[i].isascii()) and (them or people or self.near(i, "group", 6, 3)) and (near("degrade") or near("violence") or near("quality") or any(x in ("out", "back") for x in self.low[i + 1 : i + 7])):
            on.add("removal of a group")
        if has("rude"):
            if near("you", 8, 8):
                on.add("rude to you")
            if near("insult") or near("beast") or near("explicit") or near("body", 0, 4):
                on.add("rude with insult")
        if has("worth") and any(x in ("no", "not", "never", "none", "nobody") for x in self.low[max(0, i - 6) : i]) and (somebody or near("group")) and (near("insult") or near("beast") or near("mood") or near("every", 8, 0) and somebody):
            on.add("worth denied")
        if has("degrade") and (near("group") or near("every")):
            if near("quality") or near("beast") or near("insult") or near("violence") or near("every") and near("group"):
                on.add("degraded group" if somebody or near("group", 6, 6) else "always so")
            if somebody and near("every"):
                on.add("degraded people")
        if (has("beast") or has("insult")) and near("origin") and somebody and self.low[max(0, i - 2) : i] in (["out", "of"], ["from", "the"], ["of", "the"]):
            on.add("degraded origin")
        if has("beast") and self.near(i, "group", 4, 4) and somebody and not self.near(i, "craft", 6, 6):
            on.add("group of beasts")
        if has("quality") and self.near(i, "group", 0, 2) and (somebody or near("violence")):
            on.add("degraded people")
        if has("explicit"):
            on.add("explicit")
        count = lambda role: sum(bool(x & _BIT[role]) for x in self.role)
        if has("explicit") or has("erotic"):
            x, y = count("explicit"), count("erotic")
            if x > 1:
                on.add("explicit twice")
            if y > 1:
                on.add("erotic twice")
            if y > 2:
                on.add("erotic thrice")
            if y > 1 and any(x in ("him", "her", "his", "she", "he") for x in self.low):
                on.add("erotic with somebody")
            if y and near("insult"):
                on.add("erotic and insult")
            if x and y:
                on.add("explicit and erotic")
        if near("report"):
            on.add("report")
            if self.near(i, "report", 8, 0):
                on.add("report before")
        if near("craft"):
            on.add("craft")
        if self.text[: self.at[i][0]].count("“") > self.text[: self.at[i][0]].count("”"):
            on.add("quoted")
        if any(x in ("was", "were", "had", "been") for x in self.low[max(0, i - 4) : i + 5]):
            on.add("passive")
        if len(on) == 1:
            on.add("alone")
        return sum(1 << _AT[x] for x in on)


_NEEDS = {
    role: sum(_BIT[x] for x in needed.split())
    for role, needed in {
        "worth": "not", "beast": "you quality rude violence is insult explicit group every origin", "violence": "you body weep group every quality mood", "removal": "degrade violence quality away", "degrade": "group every",
    }.items()
}
_ALWAYS = sum(_BIT[x] for x in ("insult", "quality", "explicit", "rude"))


def may_speak(roles: int, erotic: int, short: bool) -> bool:
    """Whether any feature that speaks for abuse can come of a sentence's roles (all of its words, erotic words counted).

    The conditions are those of ``Sentence._window``; where none can hold, the window has features against abuse only.
    """
    if roles & _ALWAYS or erotic > 1 or short and roles & _BIT["beast"]:
        return True
    return any(roles & _BIT[role] and roles & needed & ~(_BIT[role] if role == "violence" else 0) for role, needed in _NEEDS.items())


def weight(bits: int, w: np.ndarray) -> float:
    out = 0.0
    while bits:
        low = bits & -bits
        out += w[low.bit_length() - 1]
        bits ^= low
    return out


_START = np.array(list(WEIGHTS.values()))


class Judge:
    """Windows of a text, and their score."""

    def __init__(self, usual: list[str], weights: np.ndarray | None = None, automaton: bool = True):
        self.lexicon = Lexicon(usual, automaton)
        self.weights = _START if weights is None else weights
        self.words: dict[str, tuple[int, int]] = {}

    def roles(self, word: str) -> tuple[int, int]:
        """Roles of a word as it stands between blanks, and how many erotic terms it holds."""
        if (known := self.words.get(word)) is None:
            if len(self.words) > 300_000:
                self.words.clear()
            each = [self.lexicon.of(t.lower()) for t in _TOKEN.findall(fold(word).replace("’", "'"))]
            self.words[word] = known = (reduce(or_, each, 0), sum(bool(x & _BIT["erotic"]) for x in each))
        return known

    def windows(self, text: str | None) -> list[int]:
        """Features of each sentence with a candidate that may be abuse."""
        if not text:
            return []
        out = []
        for sentence in _SENTENCE.split(fold(text).replace("’", "'")):
            all_, erotic, n = 0, 0, 0
            for w in sentence.split():
                bits, k = self.words.get(w) or self.roles(w)
                all_ |= bits
                erotic += k
                n += 1
            short = n <= 10 or "!" in sentence or " like " in sentence
            # single letters in a row may spell a term
            if all_ & _CORE and may_speak(all_, erotic, short) or _SPACED.search(sentence):
                if bits := Sentence(sentence, self.lexicon).features():
                    out.append(bits)
        return list(dict.fromkeys(out))

    def score(self, text: str | None) -> tuple[float, str]:
        """Score and category of a text's strongest window."""
        found = [(weight(b, self.weights), b) for b in self.windows(text)]
        if not found:
            return 0.0, ""
        z, bits = max(found)
        by: dict[str, float] = {}
        for k, c in enumerate(_CATEGORY):
            if c and bits >> k & 1:
                by[c] = by.get(c, 0.0) + max(0.0, self.weights[k])
        return 1 / (1 + float(np.exp(-z))), max(by, key=lambda c: (by[c], c)) if by else ""


def train(windows: list[list[int]], labels: np.ndarray, rounds: int = 8, steps: int = 60, rate: float = 0.3) -> np.ndarray:
    """Weights that lie near the fixed ones and tell labelled documents apart.

    The strongest window of a document stands for it and is chosen anew each
    round; LABEL_NOISE of the labels count as wrong.
    """
    w = _START.copy()
    rows = [np.array([[b >> k & 1 for k in range(len(w))] for b in x], float) for x in windows]
    for _ in range(rounds):
        x = np.array([r[np.argmax(r @ w)] if len(r) else np.zeros(len(w)) for r in rows])
        keep = x.any(1)  # without a candidate nothing is to be weighed
        x, y = x[keep], labels[keep]
        if not len(x):
            return w
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            q = LABEL_NOISE + (1 - 2 * LABEL_NOISE) * p
            g = ((y / q - (1 - y) / (1 - q)) * (1 - 2 * LABEL_NOISE) * p * (1 - p)) @ x - PULL * (w - _START)
            w = w + rate * g / (1 + 0.25 * x.sum(0))
    return w


def _usual(docs: DataFrame) -> list[str]:
    counts = staged(word_counts(docs.select("text")), "words")
    none = counts.sparkSession.createDataFrame([], "token string")
    return frequent(counts.where(F.col("n") >= USUAL_LEAST), none)


def fitted(docs: DataFrame, labels: DataFrame, usual) -> tuple[np.ndarray, dict]:
    """(weights, report): fitted on the labelled documents of even hash, measured on the others.

    ``usual`` is the broadcast list of usual words.  At most FIT_LABELS labelled
    documents are taken, those of lowest hash; null labels don't count, several
    of one document are averaged.
    """
    y = labels.where("abusive is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("abusive").alias("y"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_LABELS)
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(y), "doc_id")  # at most FIT_LABELS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(usual.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([judge.windows(t) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))], ["doc_id", "y", "windows"])

    got = rows.select("doc_id", "text", "y").mapInArrow(run, "doc_id bigint, y double, windows array<bigint>").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2))).orderBy("doc_id").toPandas()
    windows, y, half = [list(x) for x in got["windows"]], got["y"].to_numpy(float), got["half"].to_numpy()
    w = train([x for x, h in zip(windows, half, strict=True) if not h], y[half == 0])
    hit = np.array([max((weight(b, w) for b in x), default=-1.0) > 0 for x in windows], bool)
    held, true = half == 1, y > 0.5
    report = {"labelled": len(y), "held_out": int(held.sum()), "true": int((held & true).sum()), "found": int((held & hit).sum()), "both": int((held & hit & true).sum())}
    return w, report


def scored(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``doc_id, source, score, category`` of every document.

    Null, empty and blank texts score 0; a null source stays null; repeated rows
    stay repeated; other columns are ignored.  Without labels the fixed weights
    hold.  Only the frequent words of the corpus (at most 1 / FREQUENT of them)
    are broadcast, as words that are spelt as they should be; equal texts count
    once, and words with digits, signs or stretched letters inside are never
    among them.
    """
    known = docs.sparkSession.sparkContext.broadcast(_usual(docs))
    weights = fitted(docs, labels, known)[0] if labels is not None else _START

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(known.value, weights)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                out = [judge.score(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([s for s, _ in out], pa.float64()), pa.array([c or None for _, c in out], pa.string())], ["doc_id", "source", "score", "category"])

    src = docs.select(F.col("doc_id").cast("long"), "source", "text")
    return spread(src).mapInArrow(run, "doc_id bigint, source string, score double, category string")


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "review_labels"))


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, cases and rate of each source."""
    s = p9_scores(spark, sf_dir).groupBy("source").agg(F.count("*").alias("documents"), F.count_if(F.col("score") >= CASE_AT).alias("cases"))
    return s.withColumn("rate", F.col("cases") / F.col("documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_scores(spark, sf_dir).where(F.col("score") >= CASE_AT).select("doc_id").distinct()
