"""What the matching operators share: folding of noisy text, string distances, connected components."""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.functions.romanize import INDIC, romanize
from kinloom.llm.lookalike import READINGS, plain
from kinloom.session import materialize, release

_TO_LATIN = str.maketrans({ch: latin[0] for ch, latin in READINGS.items()})
_SPECIAL = str.maketrans({"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "ı": "i", "’": "'", "‘": "'"})
_OCR = ((re.compile(r"(?<=[a-z])0|0(?=[a-z]{2})"), "o"), (re.compile(r"(?<=[a-z])1|1(?=[a-z]{2})"), "l"), (re.compile(r"(?<=[a-z])5|5(?=[a-z]{2})"), "s"))


@functools.lru_cache(maxsize=8192)
def fold(text: str) -> str:
    """Lower-case Latin text without accents, look-alikes, invisible characters and other scripts of India."""
    if not text.isascii():
        text = plain(text)[0].translate(_TO_LATIN)
        if INDIC.search(text):
            text = romanize(text)
        text = unicodedata.normalize("NFKD", text.translate(_SPECIAL))
        text = "".join(ch for ch in text if not unicodedata.combining(ch))
    return text.lower().strip()


def unscan(word: str) -> str:
    """Digits that stand for letters inside a word: 0, 1 and 5."""
    if word.isalpha() or word.isdigit():
        return word
    for pattern, letter in _OCR:
        word = pattern.sub(letter, word)
    return word


def edits(a: str, b: str, most: int = 2) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between two words, ``most + 1`` where there are more."""
    if a == b:
        return 0
    # what both begin and end with costs nothing, and each letter that only one of them has is an edit
    least = min(len(a), len(b))
    i = 0
    while i < least and a[i] == b[i]:
        i += 1
    j = 0
    while j < least - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b or abs(len(a) - len(b)) > most:
        return min(max(len(a), len(b)), most + 1)
    if len(a) > most or len(b) > most:
        x, y = set(a), set(b)
        if len(x - y) > most or len(y - x) > most:
            return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            new.append(cost)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


#: The same for words that are met again and again.
distance = functools.lru_cache(maxsize=32768)(edits)


def _one_edit(a: str, b: str) -> bool:
    """At most one insertion, deletion, replacement or swap of neighbours: what lies between the common ends tells."""
    if abs(len(a) - len(b)) > 1:
        return False
    least = min(len(a), len(b))
    i = 0
    while i < least and a[i] == b[i]:
        i += 1
    j = 0
    while j < least - i and a[-1 - j] == b[-1 - j]:
        j += 1
    x, y = a[i : len(a) - j], b[i : len(b) - j]
    return (len(x) <= 1 and len(y) <= 1) or (len(x) == 2 and len(y) == 2 and x == y[::-1])


def alike(a: str, b: str) -> bool:
    """The same word up to typing errors: one in words of four letters or more, two in words of eight or more; "rn" passes for "m"."""
    if "rn" in a or "rn" in b:
        a, b = a.replace("rn", "m"), b.replace("rn", "m")
    if a == b:
        return True
    shorter = min(len(a), len(b))
    if shorter < 4 or abs(len(a) - len(b)) > 2:
        return False
    return _one_edit(a, b) if shorter < 8 else edits(a, b, 2) <= 2


def unmatched_words(a: list[str], b: list[str]) -> tuple[list[str], list[str]]:
    """Words of either side without a partner of their own on the other: equal partners first, then those alike."""
    left_b = list(b)
    rest, left_a = [], []
    for w in a:
        if w in left_b:
            left_b.remove(w)
        else:
            rest.append(w)
    for w in rest:
        partner = next((v for v in left_b if alike(w, v)), None)
        if partner is None:
            left_a.append(w)
        else:
            left_b.remove(partner)
    return left_a, left_b


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the graph of ``edges``: ``node, component`` (the smallest node), for nodes with an edge.

    Labels spread to neighbours and jump to the label of their label, so long chains end in a logarithmic number of rounds. A
    node's messages are combined before the shuffle; nothing is collected but one count per round. Only the last labels stay on disk,
    until they are released.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = materialize(both.union(both.select("v", "u")).distinct(), "links")
    last = materialize(links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("c")), "labels")
    labels = last
    while True:
        near = links.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("c").alias("d"))
        step = labels.join(near, "u").select("u", "c", F.least("c", "d").alias("d"))
        jump = step.join(labels.select(F.col("u").alias("d"), F.col("c").alias("e")), "d").select("u", "c", F.least("d", "e").alias("d"))
        jump = materialize(jump, "labels")
        release(last)
        last, labels = jump, jump.select("u", F.col("d").alias("c"))
        if not jump.where("c <> d").limit(1).count():
            release(links)
            out = labels.select(F.col("u").alias("node"), F.col("c").alias("component"))
            out._kinloom_path = last._kinloom_path
            return out


def text_key(country: str, text: str) -> Column:
    """A key of 16 bytes that only equal texts of one country have; neither is null."""
    return F.unhex(F.md5(F.concat(F.char_length(country).cast("string"), F.lit("|"), F.col(country), F.col(text))))


def pairs_of_records(grouped: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Pairs of records ``i, key`` whose keys differ and are of one ``group`` of ``grouped`` (a table ``key, group`` that is released): ``id_col_a, id_col_b``, smaller first.

    Pairs of keys are found once and only then carried to the records, one side after the other, so that little is on disk at a time.
    """
    pairs = materialize(grouped.withColumnRenamed("key", "ka").join(grouped.withColumnRenamed("key", "kb"), "group").where("ka < kb").select("ka", "kb"), "key-pairs")
    release(grouped)
    # by key at once, for the repeated rows of an id as for both joins
    ids = ids.repartition("key").distinct()
    half = materialize(pairs.join(ids.toDF("ia", "ka"), "ka").select("ia", "kb"), "half-pairs")
    release(pairs)
    out = half.join(ids.toDF("ib", "kb"), "kb").where("ia <> ib")
    return out.select(F.least("ia", "ib").alias(f"{id_col}_a"), F.greatest("ia", "ib").alias(f"{id_col}_b")).distinct()
