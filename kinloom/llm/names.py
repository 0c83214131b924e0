"""Names of businesses and persons as lists of comparable words, and phonetic codes of words."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable

from kinloom.functions.vocab import LEGAL_FORMS, NAME_STOPWORDS
from kinloom.functions.romanize import INDIC
from kinloom.llm.matching import alike, edits, fold, unscan

#: Given names and the short forms they are called by.
NICKNAMES = {
    "alexander": "alex sandy xander", "alexandre": "alex", "charles": "charlie chuck chas", "christophe": "chr chris", "dinesh": "dinu",
    "edward": "ed eddie ned ted", "elisabeth": "babette elise lise", "elizabeth": "beth betsy betty eliz eliza liz lizzie",
    "francois": "fr francis", "frederic": "fred freddy fredo", "genevieve": "ginette viviane", "jean": "jeannot", "jennifer": "jen jenn jenny",
    "josephine": "jo josette josie", "katherine": "catherine kate kathy kathie katie kay kit", "krishna": "kishan kishen krish", "lakshmi": "lakshmee laxmi laxmee",
    "margaret": "maggie margie marge meg peggy", "mohammed": "md mohamed mohammad mohd muhammad", "patricia": "pat patsy patti patty tricia trish",
    "rajendra": "raj rajinder raju", "richard": "dick rich rick ricky", "robert": "bob bobby rob robbie", "suresh": "suri",
    "theodore": "ted teddy theo", "venkatesh": "venkat venky", "william": "bill billy liam will willie wm", "chaudhary": "chaudhari choudhary choudhury chowdhury",
}
GIVEN: dict[str, frozenset[str]] = {}
for _name, _shorts in NICKNAMES.items():
    for _short in [_name, *_shorts.split()]:
        GIVEN[_short] = GIVEN.get(_short, frozenset()) | {_name}
_LONG_GIVEN: dict[str, list[str]] = {}
for _name in sorted(GIVEN):
    if len(_name) >= 6:
        _LONG_GIVEN.setdefault(_name[0], []).append(_name)
_SPOKEN: dict[str, list[str]] = {}
for _name in sorted(GIVEN, key=lambda g: (-len(g), g)):
    if len(_name) >= 3:
        _SPOKEN.setdefault(_name[:3], []).append(_name)
#: Usual short forms of words in business names.
SHORT_WORDS = {
    "acad": "academy", "adv": "advisors", "agri": "agricole", "assn": "associates", "assoc": "associates", "bat": "batiment", "bldg": "building", "bros": "brothers",
    "chem": "chemicals", "cie": "compagnie", "constr": "construction", "corpn": "corporation", "ctr": "center", "dent": "dental", "dev": "development", "devel": "development",
    "dist": "distributors", "distr": "distributors", "elec": "electrical", "elem": "elementary", "eng": "engineering", "engg": "engineering",
    "engrg": "engineering", "ent": "enterprises", "equip": "equipment", "est": "estate", "ets": "etablissements", "fam": "family", "fin": "financial", "fmly": "family", "furn": "furniture", "gen": "general",
    "gp": "group", "grp": "group", "hosp": "hospital", "ind": "industries", "inds": "industries", "ins": "insurance", "intl": "international", "inv": "investment", "lab": "laboratories", "labs": "laboratories",
    "med": "medical", "mfg": "manufacturing", "mgmt": "management", "mgmnt": "management", "mgt": "management", "natl": "national", "org": "organisation",
    "phcy": "pharmacy", "pkg": "packaging", "ppty": "property", "prop": "property", "rep": "repair", "ste": "societe", "soc": "societe", "serv": "services", "svc": "services", "svcs": "services",
    "tech": "technologies", "trans": "transport", "trd": "trading", "utd": "united", "univ": "universal", "vet": "veterinary",
}
#: What English words of names become when Indian scripts write them by sound.
INDIC_WORDS = {"aind": "and", "end": "and", "nyu": "new"}
#: What is put to given names in address.
HONORIFICS = ("bhai", "ben", "ji")
#: Usual words of what a business is or does. They are common words wherever they occur, however small the table.
USUAL_WORDS = frozenset(
    """academy accounting advertising advisors advocates agency agence agricole agro architecte architects associates atelier auto automotive avocat bakery bank
    batiment beauty best books boulangerie boutique brothers builders building business cabinet cafe care catering center chemicals chiropractic church cleaning
    clinic club coaching coffee coiffure college commercial community compagnie computers conseil construction constructions consultants consulting contractors
    creations dairy dental design development digital distributors ecole education electrical electricals electricite electronics elementary energy engineering
    enterprises entertainment equipment estate etablissements events exports family farms fashion fils finance financial fitness foods foundation fromagerie
    furniture garage garden general generale gestion global group hardware health healthcare heating holdings home hospital hotel imports industries insurance
    international investment investments jewellers kitchen laboratories landscaping law library librairie logistics machinery maintenance management manufacturing
    market marketing media medical menuiserie metals mills modern motors music national new notaire office optics packaging painting partners patisserie
    pharmaceuticals pharmacie pharmacy photography plastics plumbing power printing products projects property realty rental repair restaurant retail royal salon
    school security services societe software solutions sons sports steel stores studio super supply sweets systems technologies textiles tours traders trading
    traiteur transport travel united universal university ventures veterinary vision water works""".split()
)
#: Designations that tell businesses of one person apart are kept as words.
_KEEP = {"cpa", "dds", "dpm", "esq", "md"}
_DROP = (set(LEGAL_FORMS) - _KEEP - {"pra", "li"}) | set(NAME_STOPWORDS) | {"liability", "incorp", "limite", "anonyme", "lte", "pvtltd", "ms"}
_LONG_DROP = ("company", "corporation", "incorporated", "limited", "private", "liability")
_SECOND = re.compile(r"\(?\b(?:d\s*/\s*b\s*/\s*a|dba|f\s*/\s*k\s*/\s*a|fka|a\s*/\s*k\s*/\s*a|aka|t\s*/\s*a|trading as|doing business as|formerly known as|formerly|previously|also known as|anciennement)\b")
_SITE = re.compile(r"(?:https?://|www\.)|\.(?:example|com|net|org|biz|info|io|us|fr|in|co\.in|org\.in|net\.in)\b")
_IDS = re.compile(r"#\s*\d+")
_MESSRS = re.compile(r"^\W*m\s*/\s*s\b\.?")
_WORD = re.compile(r"[a-z0-9]+")
_DOTTED = re.compile(r"(?<![a-z])(?:[a-z]\.\s?){2,}(?:[a-z]\b)?")


@functools.lru_cache(maxsize=65536)
def _says_nothing(word: str) -> bool:
    return word.isdigit() or word in _DROP or (len(word) >= 5 and any(alike(word, w) for w in _LONG_DROP))


@functools.lru_cache(maxsize=8192)
def name_words(name: str) -> tuple[tuple[str, ...], bool]:
    """Words of a name's own part in order (legal forms and small words dropped, short forms spelled out), and whether it holds
    letters of an Indian script. Of two names at a marker such as "d/b/a" or "formerly" the longer is the own one; before a bar."""
    text = fold(name)
    text = _IDS.sub(" ", text)
    text = _MESSRS.sub(" ", text)
    if m := _SECOND.search(text):
        # the invented second name is short, on whichever side of the marker it stands
        before, after = text[: m.start()], text[m.end() :]
        text = max(after, before, key=lambda part: len([w for w in _WORD.findall(part) if w not in _DROP and not w.isdigit()]))
    if "|" in text:
        text = next((part for part in text.split("|") if _WORD.search(part) and not _SITE.search(part)), text)
    text = _SITE.sub(" ", text)
    text = _DOTTED.sub(lambda m: m.group().replace(".", "").replace(" ", "") + " ", text)
    words: list[str] = []
    indic = INDIC.search(name) is not None
    for word in _WORD.findall(text.replace("'", "")):
        word = unscan(word)
        word = SHORT_WORDS.get(word, word)
        if indic:
            word = INDIC_WORDS.get(word, word)
        if _says_nothing(word):
            continue
        if len(word) == 1 or word not in words:
            words.append(word)
    return tuple(words), indic


_CODE = str.maketrans({"c": "k", "q": "k", "g": "k", "z": "s", "v": "b", "w": "b", "f": "b", "p": "b", "d": "t", "j": "s", "m": "n"})
#: Sounds: what a word has to hold for the pattern to be looked for, the pattern, and what it becomes.
_SOUNDS = (
    ("ph", re.compile("ph"), "f"), ("h", re.compile("s?ch|sh"), "s"), ("k", re.compile("ck|kh"), "k"), ("h", re.compile("(?<=[bdgjt])h"), ""),
    ("ion", re.compile("[ts]ion"), "sn"), ("x", re.compile("x"), "ks"), ("c", re.compile("c(?=[eiy])"), "s"), ("g", re.compile("g(?=[eiy])"), "j"),
)

_MUTE = dict.fromkeys(map(ord, "aeiouyh"))
_DOUBLE = re.compile(r"(.)\1+")


def _sounds(word: str, classes: dict[int, str]) -> str:
    text = word
    for part, pattern, sound in _SOUNDS:
        if part in text:
            text = pattern.sub(sound, text)
    head = "a" if text[:1] in "aeiouy" else text[:1]
    return _DOUBLE.sub(r"\1", (head + text[1:].translate(_MUTE)).translate(classes))


@functools.lru_cache(maxsize=65536)
def code(word: str) -> str:
    """Phonetic code: classes of consonants in order, doubles once; a leading vowel counts as such."""
    return _sounds(word, _CODE)


_FINE = str.maketrans({"c": "k", "q": "k", "z": "s", "w": "v"})


@functools.lru_cache(maxsize=65536)
def fine_code(word: str) -> str:
    """Phonetic code that keeps voiced, voiceless, lip and nasal sounds apart: for rare words, of which there are many."""
    return _sounds(word, _FINE)


@functools.lru_cache(maxsize=65536)
def skeleton(word: str) -> str:
    """Consonants in order without classes: finer than ``code``."""
    return _DOUBLE.sub(r"\1", word[:1] + word[1:].translate(_MUTE))


def shortens(short: str, long: str) -> bool:
    """An abbreviation: the same first letter, all letters of ``short`` in order in ``long``, and clearly fewer."""
    if len(short) < 2 or len(short) > 0.7 * len(long) or short[0] != long[0]:
        return False
    it = iter(long)
    return all(ch in it for ch in short)


def same_word(a: str, b: str, vocabulary: bool) -> bool:
    """Whether two words of names are one: equal, a typing error apart, a nickname, an initial of a given name, an abbreviation or the
    same to the ear (the last two only for words of the common vocabulary)."""
    return a == b or (_same_common(a, b) if vocabulary else _same_rare(a, b))


@functools.lru_cache(maxsize=65536)
def _same_common(a: str, b: str) -> bool:
    if _same_spelling(a, b):
        return True
    if len(a) == 1 or len(b) == 1:
        one, other = (a, b) if len(a) == 1 else (b, a)
        return other[0] == one or any(full[0] == one for full in GIVEN.get(other, ()))
    return shortens(a, b) or shortens(b, a) or (len(a) >= 4 and len(b) >= 4 and code(a) == code(b))


def _same_rare(a: str, b: str) -> bool:
    """Most pairs of rare words meet once only: nothing is kept of them, and what is told by the letters at their ends is told first."""
    same_start, shorter = a[0] == b[0], min(len(a), len(b))
    # one edit leaves the first or the last letter as it is, a skeleton the first
    if not same_start and a[-1] != b[-1] and shorter < 8 and not (a in GIVEN or "rn" in a or "rn" in b):
        return False
    return _same_spelling(a, b) or (same_start and shorter >= 5 and skeleton(a) == skeleton(b) and len(skeleton(a)) >= 3)


def _same_spelling(a: str, b: str) -> bool:
    return (alike(a, b) and jaro_winkler(a, b) >= 0.8) or (a in GIVEN and b in GIVEN and not GIVEN[a].isdisjoint(GIVEN[b]))


def given(word: str) -> str:
    """One name for all short forms of a given name, as far as it is the only one they stand for."""
    names = GIVEN.get(word)
    return next(iter(names)) if names and len(names) == 1 else word


def jaro_winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity, prefix weight 0.1 for up to four letters; two empty strings are equal."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    hit_b = [False] * len(b)
    common_a = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not hit_b[j] and b[j] == x:
                hit_b[j] = True
                common_a.append(x)
                break
    m = len(common_a)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(common_a, (y for y, hit in zip(b, hit_b) if hit))) / 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


_CLUSTER = re.compile(r"[bcdfghjklmnpqrstvwxyz]{2}$")


class Vocabulary:
    """The common words of all names: every word in at least a given share of the records, so a table of bounded size."""

    def __init__(self, counts: dict[str, int]):
        self.counts = {w: n for w, n in counts.items() if len(w) > 1}
        self.words = frozenset(self.counts)
        self._by_length: dict[tuple[str, int], list[str]] = {}
        self._by_code: dict[str, str] = {}
        self._by_first: dict[str, list[str]] = {}
        for w in sorted(self.words, key=lambda w: (self.counts[w], w)):
            self._by_first.setdefault(w[0], []).append(w)
            if not _CLUSTER.search(w) or len(w) > 5:
                self._by_length.setdefault((w[0], len(w)), []).append(w)
                self._by_code[code(w)] = w
        #: short forms that stand for several common words; each is compared with them as it is
        self._unclear: set[str] = set()
        self._ends: dict[str, list[str]] = {}
        self._starts: dict[str, list[str]] = {}
        for w in sorted(self.words, key=lambda w: (-len(w), w)):
            if len(w) >= 4:
                self._ends.setdefault(w[-4:], []).append(w)
            if len(w) >= 5:
                self._starts.setdefault(w[:5], []).append(w)
        self._known: dict[tuple[str, bool], tuple[str, ...]] = {}

    def _near(self, word: str) -> str:
        if len(word) < 5:
            return ""
        near = [v for k in (-1, 0, 1) for v in self._by_length.get((word[0], len(word) + k), ()) if len(v) >= 5 and alike(v, word)]
        return max(near, key=lambda v: (self.counts[v], v), default="") or next((given(g) for g in _LONG_GIVEN.get(word[0], ()) if abs(len(g) - len(word)) <= 1 and alike(g, word)), "")

    def _spelled_out(self, word: str) -> str:
        """The common word that a short form stands for: its beginning, or its letters with a cluster of consonants at the end."""
        if len(word) < 3:
            return ""
        clipped = _CLUSTER.search(word) and not word.endswith(("nd", "wy", "ry"))
        full = [v for v in self._by_first.get(word[0], ()) if len(v) > len(word) and (not _CLUSTER.search(v) or len(v) > 5) and ((clipped and shortens(word, v)) or (len(word) >= 4 and len(v) >= len(word) + 3 and v.startswith(word)))]
        if len(full) > 1:
            self._unclear.add(word)
            return word
        return full[0] if full else ""

    def _sounds_like(self, word: str) -> str:
        v = self._by_code.get(code(word), "")
        length = len(code(word))
        return v if length >= 6 or (length >= 3 and jaro_winkler(v, word) >= (0.65 if length >= 4 else 0.8)) else ""

    def _split(self, word: str) -> tuple[str, ...]:
        """A word run together with common ones: those are parted from its ends, and a long one at an "and" inside."""
        if len(word) >= 12 and (m := re.fullmatch(r"(.{4,})and(.{4,})", word)):
            return (*self._split(m.group(1)), *self._split(m.group(2)))
        if len(word) >= 8 and word.endswith("and"):
            return self._split(word[:-3])
        for small in ("and", "et", "de"):
            if word.startswith(small) and (word[len(small) :] in self.words or small == "and" and len(word) >= 7):
                return self._split(word[len(small) :])
        for v in (*_LONG_DROP, *_KEEP, "law"):
            if word.endswith(v) and len(word) - len(v) >= 5:
                return (*self._split(word[: -len(v)]), *((v,) if v not in _LONG_DROP else ()))
        for v in self._ends.get(word[-4:], ()):
            if word.endswith(v) and len(word) - len(v) >= 4:
                return (*self._split(word[: -len(v)]), v)
        for v in self._starts.get(word[:5], ()):
            if word.startswith(v) and len(word) - len(v) >= 4:
                return (v, *self._split(word[len(v) :]))
        for end in HONORIFICS:
            if word.endswith(end) and word[: -len(end)] in GIVEN:
                return (given(word[: -len(end)]),)
        for g in _SPOKEN.get(word[:3], ()):
            if word.startswith(g) and len(word) - len(g) >= 5:
                return (given(g), *self._split(word[len(g) :]))
        return (word,)

    def read(self, word: str, indic: bool) -> tuple[str, ...]:
        if word in self.words or word in GIVEN or len(word) == 1:
            full = "" if word in GIVEN or len(word) > 6 or len(word) < 3 else self._spelled_out(word)
            return (full or given(word),)
        if (known := self._known.get((word, indic))) is None:
            if len(self._known) > 100_000:
                self._known.clear()
            found = self._near(word) or self._spelled_out(word) or (indic and self._sounds_like(word)) or ""
            known = self._known[word, indic] = (found,) if found else self._split(word)
        return known

    def parts(self, words: Iterable[str], indic: bool) -> tuple[list[str], list[str]]:
        """(rare words, common words) of a name; common ones in their full form."""
        rare: list[str] = []
        common: list[str] = []
        for word in words:
            for w in self.read(word, indic):
                to = common if w in self.words or w in GIVEN or len(w) == 1 or w in self._unclear else rare
                if w not in to:
                    to.append(w)
        return rare, common


def same_name(a_rare: list[str], a_common: list[str], b_rare: list[str], b_common: list[str]) -> int:
    """3: the same name, with equal rare words; 2: the same name, with rare words alike; 1: the same but for common words that one side
    lacks; 0: different names.

    -1: alike, but only a common place could tell. The rare words are equal, but either side has a common word that the other lacks, or one
    side lacks one of several rare words; or the rare words are spelled differently and common words are lacking; or the only
    rare word starts with another letter.
    """
    left_ra: list[str] = []
    left_rb: list[str] = []
    if not a_rare or not b_rare:
        if a_rare or b_rare or len(a_common) < 2 or len(b_common) < 2:
            return 0
    else:
        left_ra, left_rb = _leftover(a_rare, b_rare, False)
        if (left_ra or left_rb) and _run_together(a_rare, b_rare):
            left_ra, left_rb = [], []
        # no rare word has a partner, or more are left than common words of the other side could be spellings of
        if (left_ra or left_rb) and (len(left_ra) == len(a_rare) or max(0, len(left_ra) - len(b_common)) + max(0, len(left_rb) - len(a_common)) > 1):
            return 0
    left_a, left_b = _leftover(a_common, b_common, True)
    left_a, left_b = [w for w in left_a if len(w) > 1], [w for w in left_b if len(w) > 1]
    equal = sorted(a_rare) == sorted(b_rare)
    if left_ra or left_rb:
        # a rare word may be an unusual spelling of a common one
        left_ra, left_b = _leftover(left_ra, left_b, True)
        left_rb, left_a = _leftover(left_rb, left_a, True)
        shared = bool(set(a_rare) & set(b_rare))
        if left_ra or left_rb:
            return -1 if len(left_ra) + len(left_rb) == 1 and shared and not (left_a and left_b) else 0
        equal = equal or shared
    if left_a and left_b:
        # different given names are different persons
        persons = any(w in GIVEN for w in left_a) and any(w in GIVEN for w in left_b)
        return -1 if a_rare and equal and not persons else 0
    if left_a or left_b:
        return 1 if equal or "".join(a_rare) == "".join(b_rare) else -1
    if equal or "".join(a_rare) == "".join(b_rare):
        return 3
    return -1 if len(a_rare) == len(b_rare) == 1 and a_rare[0][0] != b_rare[0][0] else 2


def _run_together(a: list[str], b: list[str]) -> bool:
    """Whether the words are the same but for up to two edits when they are written as one."""
    x, y = "".join(a), "".join(b)
    if len(a) == len(b):
        return len(a) > 1 and edits(x, y, 2) <= 2
    z, one = ("".join(reversed(b)), x) if len(a) < len(b) else ("".join(reversed(a)), y)
    return edits(x, y, 2) <= 2 or edits(one, z, 2) <= 2


def _leftover(a: list[str], b: list[str], vocabulary: bool) -> tuple[list[str], list[str]]:
    """Words of either side without a partner on the other; equal words are partners first."""
    b = list(b)
    rest, left = [], []
    for w in a:
        if w in b:
            b.remove(w)
        else:
            rest.append(w)
    for w in rest:
        hit = next((v for v in b if same_word(w, v, vocabulary)), None)
        if hit is None:
            left.append(w)
        else:
            b.remove(hit)
    return left, b
