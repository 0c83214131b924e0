"""Latin spelling of text in the Brahmic scripts of India, from the Unicode character names.

No letter table is kept: the name of a character says what it is (LETTER KA, VOWEL SIGN I, SIGN VIRAMA) and a few
rules turn that into the usual Latin spelling, with Hindi deletion of the unspoken inherent vowel.
"""

from __future__ import annotations

import functools
import re
import unicodedata

INDIC = re.compile("[ऀ-ൿ][ऀ-ൿ​-‍⁠﻿­]*")
#: Sounds whose usual Latin spelling is not the one in the character's name.
_CONSONANTS = {
    "nga": "n", "nya": "n", "ca": "ch", "cha": "chh", "tta": "t", "ttha": "th", "dda": "d", "ddha": "dh", "nna": "n", "nnna": "n",
    "pha": "f", "ssa": "sh", "lla": "l", "llla": "l", "rra": "r", "dddha": "r", "rha": "rh", "khha": "kh", "ghha": "g", "yya": "y", "fa": "f", "qa": "q", "za": "z",
}
_VOWELS = {"aa": "a", "ii": "i", "uu": "u", "vocalic r": "ri", "vocalic rr": "ri", "vocalic l": "li", "vocalic ll": "li", "candra e": "e", "short e": "e", "ee": "e", "candra o": "o", "short o": "o", "oo": "o"}
_PLAIN_VOWELS = {"a", "i", "u", "e", "o", "ai", "au"}


@functools.lru_cache(maxsize=4096)
def _sound(ch: str) -> tuple[str, str]:
    """Kind (consonant, vowel, sign, virama, nasal, other) and Latin spelling of one character."""
    name = unicodedata.name(ch, "").lower()
    if "digit" in name:
        return "other", str(unicodedata.digit(ch, 0))
    what = name.partition(" vowel sign ")[2]
    if what:
        return "sign", _VOWELS.get(what, what.split(" ")[-1])
    if "virama" in name:
        return "virama", ""
    if "anusvara" in name or "candrabindu" in name or name.endswith("sign tippi") or name.endswith("sign bindi"):
        return "nasal", "n"
    if "visarga" in name:
        return "nasal", "h"
    what = name.partition(" letter ")[2]
    if what in _PLAIN_VOWELS or what in _VOWELS:
        return "vowel", _VOWELS.get(what, what)
    if "chillu" in what:
        return "other", what.split(" ")[-1].strip("nl")[:1] or what[-1]
    if what.endswith("a") and " " not in what:
        return "consonant", _CONSONANTS.get(what, what[:-1])
    return "other", "om" if name.endswith(" om") else " " if "danda" in name else ""


@functools.lru_cache(maxsize=65536)
def romanize_word(word: str) -> str:
    """Latin spelling of one run of Brahmic letters."""
    word = unicodedata.normalize("NFC", re.sub("[​-‍⁠﻿­]", "", word))
    # a syllable is [consonant spelling, vowel]; the vowel None is the inherent one
    syllables: list[list[str | None]] = []
    for ch in word:
        kind, latin = _sound(ch)
        if kind == "consonant":
            syllables.append([latin, None])
        elif kind == "vowel":
            syllables.append(["", latin])
        elif kind in ("sign", "virama") and syllables:
            syllables[-1][1] = latin
        elif kind == "nasal" and syllables:
            syllables[-1][1] = "a" if syllables[-1][1] is None else syllables[-1][1]
            syllables.append([latin, ""])
        elif latin:
            syllables.append([latin, ""])
    spoken = [v is None or v != "" for _, v in syllables]
    last = len(syllables) - 1
    for k, (_, vowel) in enumerate(syllables):
        if vowel is None:
            before = k > 0 and any(spoken[j] for j in range(max(0, k - 2), k))
            full_after = any(syllables[j][1] for j in range(k + 1, min(last, k + 2) + 1) if all(syllables[i][1] == "" for i in range(k + 1, j)))
            if before and (k == last or full_after):
                spoken[k] = False
    return "".join((c or "") + ("a" if v is None else v or "") * spoken[k] for k, (c, v) in enumerate(syllables))


def romanize(text: str) -> str:
    """Every run of Brahmic letters in Latin spelling; all else untouched."""
    return INDIC.sub(lambda m: romanize_word(m.group()), text)
