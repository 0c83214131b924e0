"""Bring visually identical text to one form.

Two steps per text. First, compatibility normalization and deletion of ignorable characters. Then every token that holds
a letter with a look-alike becomes a lattice (each such letter: itself or the letters it looks like), and a Viterbi
search takes the reading with the best character-bigram score that stays within one script.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other alphabets (or rarely used Latin ones) that look like the Latin letter given first.
LOOKALIKES = {
    "a": "аɑα", "b": "Ꮟ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡց", "h": "һհ", "i": "іıιɩᎥ", "j": "јϳ", "k": "кκ", "l": "ӏǀ",
    "n": "ոп", "o": "оοօσ", "p": "рρ", "q": "ԛգ", "s": "ѕ", "u": "υս", "v": "νѵ", "w": "ԝա", "x": "хχ", "y": "уγ",
    "A": "АΑᎪꓮ", "B": "ВΒᏴꓐ", "C": "СϹᏟꓚ", "D": "Ꭰꓓ", "E": "ЕΕᎬꓰ", "F": "Ϝꓝ", "G": "ԌᏀꓖ", "H": "НΗᎻꓧ", "I": "ІΙӀꓲ", "J": "ЈͿᎫꓙ",
    "K": "КΚᏦꓗ", "L": "ԼᏞꓡ", "M": "МΜᎷꓟ", "N": "Νꓠ", "O": "ОΟՕꓳ", "P": "РΡᏢꓑ", "Q": "Ԛ", "R": "ᎡᏒꓣ", "S": "ЅՏᏚꓢ", "T": "ТΤᎢꓔ", "U": "Սꓴ",
    "V": "ѴᏙꓦ", "W": "ԜᎳᏔꓪ", "X": "ХΧꓫ", "Y": "УΥҮᎩꓬ", "Z": "ΖᏃꓜ", "ë": "ё", "Ë": "Ё", "ï": "ї", "Ï": "Ї", "3": "Зз", "-": "‐‑", "/": "∕⁄",
}
READINGS: dict[str, str] = {}
for _latin, _others in LOOKALIKES.items():
    for _ch in _others:
        READINGS[_ch] = READINGS.get(_ch, "") + _latin
#: The other way: what a letter beside letters of another alphabet may stand for.
OTHERS = {latin: others for latin, others in LOOKALIKES.items() if latin.isalpha()}
#: Alphabets that no plain word mixes with Latin letters.
APART = frozenset({"CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE", "LISU"})
#: Letters the score model knows: both sides of the table. The model has at most (len + 2) ** 2 entries.
ALPHABET = frozenset("".join(READINGS).lower() + "".join(LOOKALIKES).lower() + "abcdefghijklmnopqrstuvwxyz")
#: Compatibility characters that look like what they are, not like plain letters.
_VISIBLE_TAGS = ("<super>", "<sub>", "<fraction>", "<square>")
_VISIBLE = "…№"
#: Blank characters outside category Cf.
_BLANK = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))
_TOKEN = re.compile(r"\S+")
SWITCH = math.log(1e-5)
REPLACE = math.log(0.2)
#: For a letter of another alphabet than the sure letters of the whole text.
OTHER = math.log(0.02)


def _script(ch: str) -> str:
    """First word of the character's name: LATIN, CYRILLIC, GREEK, DEVANAGARI ...; empty for what has no alphabet."""
    return unicodedata.name(ch, "").split(" ")[0] if ch.isalpha() else ""


_SCRIPT = {ch: _script(ch) for ch in {*READINGS, *LOOKALIKES}}


def _is_indic(ch: str) -> bool:
    return "ऀ" <= ch <= "෿"


def plain(text: str) -> tuple[str, bool]:
    """Compatibility normalization and deletion of ignorable characters; whether that touched more than composition.

    A joiner (U+200C, U+200D) directly after a virama and before an Indic letter shapes a conjunct: it is deleted in the
    result but does not count as a change. Nukta letters are decomposed without counting either.
    """
    if text.isascii() and text.isprintable():
        return text, False
    out: list[str] = []
    touched = False
    for k, ch in enumerate(text):
        kind = unicodedata.category(ch)
        if kind in ("Cf", "Cc", "Cs", "Co") or ch in _BLANK:
            if ch in "\t\n\r\v\f\x85":
                out.append(" ")
                touched = True
                continue
            before, after = text[k - 1 : k], text[k + 1 : k + 2]
            conjunct = ch in "‌‍" and before and unicodedata.combining(before) == 9 and after and _is_indic(after)
            touched |= not conjunct
            continue
        if kind in ("Zs", "Zl", "Zp"):
            touched |= ch != " "
            out.append(" ")
            continue
        if kind == "Mn" and not (out and unicodedata.name(out[-1][-1], "").startswith(unicodedata.name(ch, "?").split(" ")[0])):
            touched |= not _is_indic(ch)
        tag = unicodedata.decomposition(ch)
        if tag.startswith("<"):
            if tag.startswith(_VISIBLE_TAGS) or ch in _VISIBLE:
                out.append(ch)
                continue
            touched = True
        elif tag and " " not in tag and not _is_indic(ch):
            touched = True  # a singleton: a sign that stands for another character
        out.append(unicodedata.normalize("NFKC", ch))
    return unicodedata.normalize("NFC", "".join(out)), touched


class LatticeReader:
    """Viterbi search over look-alike lattices under a character-bigram model."""

    def __init__(self, counts: dict[str, int]):
        after: Counter[str] = Counter()
        for pair, n in counts.items():
            after[pair[0]] += n
        size = len(ALPHABET) + 2
        self._log = {pair: math.log((n + 0.01) / (after[pair[0]] + 0.01 * size)) for pair, n in counts.items()}
        self._none = {ch: math.log(0.01 / (n + 0.01 * size)) for ch, n in after.items()}
        self._unseen = math.log(1 / size)
        self._known: dict[str, str] = {}

    def _score(self, a: str, b: str) -> float:
        a, b = a.lower(), b.lower()
        a, b = a if a in ALPHABET else "^", b if b in ALPHABET else "$"
        return self._log.get(a + b) or self._none.get(a, self._unseen)

    def token(self, token: str, main: str) -> str:
        if token.isascii() or not any(ch in READINGS for ch in token) and not _mixed(token):
            return token
        if (known := self._known.get(key := main + " " + token)) is None:
            if len(self._known) > 100_000:
                self._known.clear()
            known = self._known[key] = self._search(token, main)
        return known

    def _search(self, token: str, main: str) -> str:
        # a state is (character, script of the last letter seen); the text so far comes with its score
        states: dict[tuple[str, str], tuple[float, str]] = {("^", ""): (0.0, "")}
        mixed = _mixed(token)
        for ch in token:
            new: dict[tuple[str, str], tuple[float, str]] = {}
            # letters of a word in one alphabet stand for Latin ones or for themselves; in a mixed word also Latin letters may be meant for others
            for option in ch + READINGS.get(ch, "") + (OTHERS.get(ch, "") if mixed else ""):
                script = _SCRIPT.get(option)
                script = _script(option) if script is None else script
                foreign = OTHER if script and main and script != main else 0.0
                for (last, alphabet), (score, text) in states.items():
                    s = score + self._score(last, option) + foreign + (REPLACE if option != ch else 0.0)
                    if script and alphabet and script != alphabet:
                        s += SWITCH
                    key = (option, script or alphabet)
                    if key not in new or s > new[key][0]:
                        new[key] = (s, text + option)
            states = new
        return max((s + self._score(last, "$"), text) for (last, _), (s, text) in states.items())[1]

    def read(self, text: str) -> str:
        if text.isascii() or not any(ch in READINGS for ch in text) and not any(map(_mixed, _TOKEN.findall(text))):
            return text
        letters = [ch for ch in text if ch.isalpha()]
        # the alphabet of the letters that have one reading only; of all letters where there is none
        sure = Counter(_script(ch) for ch in letters if ch not in READINGS and ch not in OTHERS) or Counter(map(_script, letters))
        main = min(sure, key=lambda s: (-sure[s], s != "LATIN", s)) if sure else ""
        return _TOKEN.sub(lambda m: self.token(m.group(), main), text)


def _mixed(token: str) -> bool:
    """Whether a word holds letters of Latin and of an alphabet that is not mixed with it."""
    if token.isascii():
        return False
    scripts = {_script(ch) for ch in token if ch.isalpha()}
    return "LATIN" in scripts and not APART.isdisjoint(scripts)


def _count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pairs: Counter[str] = Counter()
        for text in batch["t"]:
            for token in plain(text)[0].lower().split():
                pairs.update(zip("^" + token, token + "$"))
        known: Counter[str] = Counter()
        for (a, b), n in pairs.items():
            if a in ALPHABET or b in ALPHABET:
                known[(a if a in ALPHABET else "^") + (b if b in ALPHABET else "$")] += n
        yield pd.DataFrame(list(known.items()), columns=["pair", "n"])


def pair_counts(df: DataFrame, text: str) -> dict[str, int]:
    """Counts of adjacent letters over all texts, of the letters in ``ALPHABET``: a table of bounded size."""
    counted = (
        df.select(F.col(text).cast("string").alias("t")).where("t is not null").mapInPandas(_count_pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    )
    return {r["pair"]: r["n"] for r in counted.collect()}


def canonical_text(df: DataFrame, text: str, out: str = "canonical", flag: str = "affected", counts: dict[str, int] | None = None) -> DataFrame:
    """Add ``out``, the one form of ``text`` in which equal-looking texts are equal, and ``flag``.

    ``flag`` is true where the text holds a character a plain spelling would not: another form of a letter, digit, sign or
    space, a look-alike of another alphabet, an accent kept apart from its letter, an invisible character.

    * A null text gives null and false; an empty text stays empty and is not affected. Texts of any length are read whole.
    * Precomposed accents are kept, with or without reason in the word.
    * An existing column named ``out`` or ``flag`` is replaced. Rows are kept as they are, repeated ones too.
    * The score model is learned from all rows of ``df`` unless ``counts`` gives one.
    """
    model = df.sparkSession.sparkContext.broadcast(pair_counts(df, text) if counts is None else counts)

    @F.pandas_udf("canonical string, affected boolean")
    def read(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = LatticeReader(model.value)
        for series in texts:
            rows = []
            for t in series:
                if t is None:
                    rows.append((None, False))
                    continue
                p, touched = plain(t)
                c = reader.read(p)
                # a word that still mixes alphabets holds a letter without a look-alike
                rows.append((c, touched or c != p or any(map(_mixed, _TOKEN.findall(c)))))
            yield pd.DataFrame(rows, columns=["canonical", "affected"])

    kept = [c for c in df.columns if c not in (out, flag)]
    return df.withColumn("__kl_read", read(F.col(text).cast("string"))).select(
        *kept, F.col("__kl_read.canonical").alias(out), F.col("__kl_read.affected").alias(flag)
    )
