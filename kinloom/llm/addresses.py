"""Decide which differently written postal addresses denote the same building.

Addresses become bags of weighted character trigrams of their telling words. Candidates come from prefix-filtered inverted
indexes (one for each country and house number), are verified by cosine similarity, and then checked part by part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.functions.vocab import ADDRESS_SHORT, DESIGNATORS, IN_STATES, STATE_CODES, US_STATES
from kinloom.llm.matching import components, distance, fold, pairs_of_records, text_key, unmatched_words, unscan
from kinloom.session import bounded_broadcast, materialize, release

COSINE = 0.3
#: Forms of one house number that a task keeps at a time, and forms of all house numbers for which there is a task.
FORMS_PER_PART = 20_000
_EMPTY = re.compile(r"<\s*null\s*>|\bnull\b|\bn\s*/\s*a\b|\bnone\b|\bnil\b|\bunknown\b|\bnot available\b|\bna\b(?=\s*$)")
_SUITE = re.compile(r"\b(?:suite|ste|unit|apt|apartment|floor|fl|level|room|rm)\b\.?\s*(?:no\b\.?)?\s*#?\s*\d+[a-z]?\b")
_AFTER_DESIGNATOR = re.compile(r"(?<=plot|shop|flat|door)[\s.]*#|(?<=house)[\s.]*#|(?<=\bno)[\s.]*#")
_HASH = re.compile(r"#\s*(\d+)")
_FLOOR = re.compile(r"\b\d+\s*(?:er|re|e|eme|st|nd|rd|th)\s+(?:etage|floor)\b|\brez[ -]de[ -]chaussee\b")
_FRANCE = re.compile(r"\bbat(?:iment)?\b\.?\s+[a-z0-9]\b|\bcedex\b(?:\s*\d{1,2}\b(?!\d))?|\bbp\s*\d+|\bz\s*\.?\s*[iac]\b\.?(?:\s+(?:nord|sud|est|ouest))?")
_LANDMARK = re.compile(r"\b(?:opp|opposite|near|behind|beside|next to|nr|adj)\b\.?\s+")
_ZIP4 = re.compile(r"\b(\d{5})\s*-\s*\d{4}\b")
_HALF = re.compile(r"\b(\d+)\s*1\s*/\s*2\b")
_COUNTRY = re.compile(r"\bu\.?\s?s\.?\s?a\b\.?|\bunited states(?: of america)?\b|\bindia\b|\bfrance\b|\bbharat\b")
_MULTI = re.compile(r"\b(?:" + "|".join(sorted((s for s in STATE_CODES if " " in s), key=len, reverse=True)) + r")\b")
_NAGAR = re.compile(r"(?<=[a-z]{2})n(?:a?gr|gar)$")
_TOKENS = re.compile(r"[a-z0-9]+")
_PART = re.compile(r"[,;]")
#: "12-14": the buildings of one side of a street; elsewhere than in India, where such numbers are compound.
_RANGE = re.compile(r"(?<![\d-])(\d{1,4})[a-z]?\s*[-–/]\s*(\d{1,4})[a-z]?(?![\d-])")
#: Further kinds of streets and their short forms.
_KINDS = (
    "bld", "boul", "che", "clny", "crt", "drv", "gali", "market", "marg", "mg", "mkt", "pky", "rue", "so", "spgs", "springs",
)
#: Words that say little about a place: kinds of streets, directions, generic parts of town names.
_GENERIC = frozenset(
    [*ADDRESS_SHORT, *ADDRESS_SHORT.values(), *DESIGNATORS, *_KINDS, "d", "rue", "r", "quai", "cours", "falls", "spring", "city", "town", "village", "sur", "mer", "les", "bains", "le", "la", "de", "du", "des"]
    + ["the", "us", "number", "num", "door", "etage", "and", "bis", "nord", "sud", "est", "ouest", "way", "lane"]
)
#: Codes of states that are also short forms of kinds of streets; such a word is a state only where it is alone in its part.
_UNCLEAR_STATES = frozenset(STATE_CODES.values()) & frozenset([*ADDRESS_SHORT, *ADDRESS_SHORT.values()])
_STATES = {"US": {**US_STATES, **{c: c for c in US_STATES.values()}}, "India": {**IN_STATES, **{c: c for c in IN_STATES.values()}}, "France": {}}
#: Landmarks are two words, or three after these.
_THREE = ("old", "new")


def _drop_landmarks(text: str) -> str:
    while m := _LANDMARK.search(text):
        rest = text[m.end() :]
        end = re.search(r"[,;]", rest)
        if end:
            cut = end.start()
        else:
            words = list(_TOKENS.finditer(rest))
            take = 3 if words and words[0].group() in _THREE else 2
            cut = words[min(take, len(words)) - 1].end() if words else len(rest)
        text = text[: m.start()] + " , " + rest[cut:]
    return text


def parse_address(address: str | None, country: str | None) -> tuple[str, str, str, list[str]] | None:
    """(house number, postal code, state, telling words) of one address, or None if it names no building."""
    parsed = parse_numbers(address, country)
    return None if parsed is None else (parsed[0][0], *parsed[1:])


def parse_numbers(address: str | None, country: str | None) -> tuple[list[str], str, str, list[str]] | None:
    """As ``parse_address``, with all house numbers: those of a range ("12-14": 12 and 14), else the one."""
    if not address:
        return None
    text = _EMPTY.sub(" , ", fold(address))
    text = _COUNTRY.sub(" , ", text)
    text = _ZIP4.sub(r"\1", text)
    text = _FLOOR.sub(" , ", _FRANCE.sub(" , ", text))
    text = _SUITE.sub(" , ", text)
    # "#12" after a designator is the house number; elsewhere it is one only if there is no other, else a suite
    text = _AFTER_DESIGNATOR.sub(" ", text)
    hashed = _HASH.findall(text)
    text = _HASH.sub(" , ", text)
    text = _drop_landmarks(text)
    text = _HALF.sub(r"\1", text)
    text = _MULTI.sub(lambda m: STATE_CODES[m.group()], text)
    states = _STATES.get(country or "", STATE_CODES)
    span: list[str] = []
    if country != "India" and (m := _RANGE.search(text)) and 0 < int(m.group(1)) < int(m.group(2)) <= int(m.group(1)) + 98:
        low, high = int(m.group(1)), int(m.group(2))
        span = [str(n) for n in range(low, high + 1, 2 if (high - low) % 2 == 0 else 1)]
        text = text[: m.end(1)] + " " + text[m.end() :]
    lone = {p.strip(" .0123456789-") for p in _PART.split(text)}
    postal = state = ""
    digits = 6 if country == "India" else 5
    codes: list[str] = []
    numbers: list[str] = []
    words: list[str] = []
    for token in _TOKENS.findall(text.replace("'", "").replace(".", " ")):
        if token.isdigit() or (token[:-1].isdigit() and token[-1].isalpha()):
            value = token.rstrip("abcdefghijklmnopqrstuvwxyz")
            if len(value) == digits and value[0] != "0":
                codes.append(value)
            elif value.lstrip("0"):
                numbers.append(value.lstrip("0"))
            continue
        token = _NAGAR.sub("nagar", unscan(token))
        if token in states and (token not in _UNCLEAR_STATES or token in lone):
            state = states[token]
        elif len(token) > 1 and token not in _GENERIC and token not in words:
            m = token[-1].isdigit() and re.fullmatch(r"([a-z]+)(\d+)", token)
            if m and m.group(1) in _GENERIC:
                numbers.append(m.group(2).lstrip("0"))
            else:
                words.append(token)
    if codes:
        postal = codes[-1]
        numbers += codes[:-1]
    numbers += [h.lstrip("0") for h in hashed if h.lstrip("0")]
    if not numbers or not words:
        return None
    return span if span and span[0] == numbers[0] else numbers[:1], postal, state, words


def grams(words: list[str]) -> list[str]:
    return sorted({f"^{w}$"[k : k + 3] for w in words for k in range(len(w))})


_FORM = "numbers array<string>, postal string, state string, words array<string>"


def _parse(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for address, country in batches:
        rows = []
        for a, c in zip(address, country):
            p = parse_numbers(a, c)
            rows.append((None, None, None, None) if p is None else (p[0], p[1], p[2], sorted(p[3])))
        yield pd.DataFrame(rows, columns=["numbers", "postal", "state", "words"])


def same_building(a_words, b_words, a_postal: str, b_postal: str, a_state: str, b_state: str) -> int:
    """2: certainly the same building (number and country agree already); 1: nothing speaks against it; 0: not.

    Two known states, or two known postal codes more than a typing error apart, speak against it; so do words without a partner on both
    sides, as of two towns with one street name, unless the codes are equal and two words agree or the others are two errors apart.
    """
    left_a, left_b = unmatched_words(list(a_words), list(b_words))
    n = len(a_words) - len(left_a)
    if n == 0 or (a_state and b_state and a_state != b_state):
        return 0
    codes = bool(a_postal and b_postal)
    if codes and distance(a_postal, b_postal, 1) > 1:
        return 0
    apart = bool(left_a and left_b)
    if n >= 2:
        return 0 if apart and not (codes and a_postal == b_postal) else 2
    if apart and not (codes and a_postal == b_postal and len(left_a) == len(left_b) == 1 and len(left_a[0]) >= 5 and distance(left_a[0], left_b[0], 2) <= 2):
        return 0
    if codes:
        return 2 if a_postal == b_postal else 0
    return 1 if min(len(a_words), len(b_words)) == 1 else 0


def _weights(df: DataFrame) -> dict[str, float]:
    """Inverse document frequency of every trigram over all distinct forms: letters, digits and two marks make at most 38**3."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for words in batch["words"]:
                seen.update(grams(words.split(" ")))
        if seen:
            yield pd.DataFrame({"g": list(seen.keys()), "n": list(seen.values())})

    counted = df.select(F.array_join("words", " ").alias("words")).mapInPandas(count, "g string, n long").groupBy("g").agg(F.sum("n").alias("n")).collect()
    n = max(1, sum(r["n"] for r in counted))
    return {r["g"]: math.log(1 + n / r["n"]) for r in counted}


def _stored(records: DataFrame, address: str, country: str, *keep: str) -> DataFrame:
    """``address, country, key`` of each record and ``keep``: equal addresses of one country, and only those, have one key."""
    d = records.select(*keep, F.col(address).cast("string").alias("address"), F.col(country).cast("string").alias("country")).where("address is not null")
    return d.withColumn("known", F.coalesce("country", F.lit(""))).withColumn("key", text_key("known", "address")).drop("known")


def address_forms(records: DataFrame, address: str, country: str) -> DataFrame:
    """``key, form, country, numbers, postal, state, words`` of each stored address. A form is country, number, postal code, state and sorted telling words."""
    distinct = _stored(records, address, country).dropDuplicates(["key"]).withColumn("country", F.coalesce("country", F.lit("")))
    parsed = distinct.withColumn("p", F.pandas_udf(_parse, _FORM)("address", "country")).select("key", "country", "p.*").where("numbers is not null")
    return materialize(parsed.withColumn("form", F.unhex(F.md5(F.concat_ws("|", "country", F.array_join("numbers", "-"), "postal", "state", F.array_join("words", " "))))), "forms")


def compared_forms(forms: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Pairs of forms as of ``candidate_forms``, with what ``same_building`` says of them: ``a, b, similarity, v``.

    The forms of one country and house number meet in one task, which keeps their index; pairs are found, compared and judged there, so that
    only forms are shuffled. A block of more than ``FORMS_PER_PART`` forms is cut into parts, and every two parts meet in a task of their own.
    """
    weights = forms.sparkSession.sparkContext.broadcast(_weights(forms))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squares = {g: x * x for g, x in weights.value.items()}
        block: tuple = ()
        index: dict[str, list[tuple]] = {}
        out: list[tuple] = []
        for batch in batches:
            for form, country, number, low, high, part, numbers, postal, state, words in batch.itertuples(index=False, name=None):
                if (country, number, low, high) != block:
                    block, index = (country, number, low, high), {}
                words, numbers = words.split(" "), numbers.split("-")
                own = grams(words)
                order = sorted(own, key=lambda g: (-squares[g], g))
                left = total = sum(squares[g] for g in order)
                taken = []
                for g in order:
                    if left < cosine**2 * total * (1 - 1e-9):
                        break
                    taken.append(g)
                    left -= squares[g]
                x = (form, frozenset(own), total, numbers, words, postal, state)
                # where two parts meet, each is compared with the other only
                for y in {y[0]: y for g in taken if part == high for y in index.get(g, ())}.values():
                    # forms that share several numbers are compared at the first of them
                    if len(numbers) > 1 and len(y[3]) > 1 and next(n for n in numbers if n in y[3]) != number:
                        continue
                    similarity = sum(squares[g] for g in x[1] & y[1]) / math.sqrt(total * y[2])
                    if similarity >= cosine:
                        a, b = (x, y) if form < y[0] else (y, x)
                        out.append((a[0], b[0], similarity, same_building(a[4], b[4], a[5], b[5], a[6], b[6])))
                if part == low:
                    for g in taken:
                        index.setdefault(g, []).append(x)
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=["a", "b", "similarity", "v"])
                    out = []
        if out:
            yield pd.DataFrame(out, columns=["a", "b", "similarity", "v"])

    entries = forms.select("form", F.coalesce("country", F.lit("")).alias("country"), F.explode("numbers").alias("number"), F.array_join("numbers", "-").alias("numbers"), "postal", "state", F.array_join("words", " ").alias("words"))
    sizes = entries.groupBy("country", "number").count()
    large = sizes.where(F.col("count") > FORMS_PER_PART).select("country", "number", F.ceil(F.col("count") / FORMS_PER_PART).cast("int").alias("parts"))
    d = entries.join(bounded_broadcast(large, 100_000), ["country", "number"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    d = d.withColumn("part", F.pmod(F.xxhash64("form"), F.col("parts")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    d = d.select("form", "country", "number", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"), "part", "numbers", "postal", "state", "words")
    # work grows with pairs, not with bytes, hence tasks of their own
    tasks = max(int(forms.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(forms.count() / FORMS_PER_PART))
    met = d.repartition(tasks, "country", "number", "low", "high").sortWithinPartitions("country", "number", "low", "high", "part")
    kind = forms.schema["form"].dataType.simpleString()
    return met.mapInPandas(compare, f"a {kind}, b {kind}, similarity double, v int")


def candidate_forms(forms: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Pairs of forms of one country and with a common house number, with cosine similarity of at least ``cosine``: ``a, b, similarity``.

    Exact: a pair at or above the threshold shares a trigram of both prefixes, the rarest trigrams after which
    less than ``cosine`` of a vector's length is left.
    """
    return compared_forms(forms, cosine).select("a", "b", "similarity")


def _located(records: DataFrame, address: str, country: str, cosine: float) -> tuple[DataFrame, list[DataFrame]]:
    """(``key, location`` of each stored address that names a building, the tables that are to be released once it is read)."""
    stored = address_forms(records, address, country)
    forms = stored.dropDuplicates(["form"]).select("form", "country", "numbers", "postal", "state", "words")
    judged = materialize(compared_forms(forms, cosine).where("v > 0").select("a", "b", "v"), "judged")
    strong = components(judged.where("v = 2"), "a", "b")
    told = stored.select("form", (F.size("words") > 1).alias("t"), (F.col("postal") != "").alias("c")).distinct()
    placed = told.join(strong.withColumnRenamed("node", "form"), "form", "left").select("form", F.coalesce("component", "form").alias("location"), "t", "c")
    placed = placed_forms = materialize(placed, "placed")
    release(strong)
    # weak pairs between locations: one that has neither town nor postal code follows the other if that is its only choice, and two
    # of which one knows only its town and the other only its code are joined if each is the other's only choice
    known = placed.groupBy("location").agg(F.bool_or("t").alias("t"), F.bool_or("c").alias("c"))
    weak = (
        judged.where("v = 1")
        .join(placed.select(F.col("form").alias("a"), F.col("location").alias("la")), "a")
        .join(placed.select(F.col("form").alias("b"), F.col("location").alias("lb")), "b")
        .where("la <> lb")
        .join(known.select(F.col("location").alias("la"), F.col("t").alias("ta"), F.col("c").alias("ca")), "la")
        .join(known.select(F.col("location").alias("lb"), F.col("t").alias("tb"), F.col("c").alias("cb")), "lb")
        .where("not (ta and tb) and not (ca and cb)")
    )
    bare_a, bare_b = F.expr("not ta and not ca"), F.expr("not tb and not cb")
    sides = weak.select(F.col("la").alias("from"), F.col("lb").alias("to"), bare_a.alias("bare"), bare_b.alias("other_bare")).union(
        weak.select(F.col("lb"), F.col("la"), bare_b, bare_a)
    )
    choice = materialize(
        sides.groupBy("from").agg(F.min("to").alias("one"), F.max("to").alias("other"), F.bool_and("bare").alias("bare"), F.bool_or("other_bare").alias("to_bare")).where("one = other"), "choices"
    )
    back = choice.select(F.col("from").alias("one"), F.col("one").alias("back"))
    mutual = choice.where("not bare").join(back, "one").where("back = from and one < from").select("from", "one")
    target = choice.where("bare and not to_bare").select("from", "one").union(mutual).groupBy("from").agg(F.min("one").alias("one")).select(F.col("from").alias("location"), "one")
    placed = placed.join(target, "location", "left").select("form", F.coalesce("one", "location").alias("location"))
    return stored.select("key", "form").join(placed, "form").select("key", "location"), [stored, judged, placed_forms, choice]


def locate(records: DataFrame, id_col: str, address: str, country: str, cosine: float = COSINE) -> DataFrame:
    """The location of each stored address: ``address, country, location``; absent where an address names no building.

    * Null, empty and placeholder addresses, and such without a house number or a telling word, denote none.
    * Equal addresses have equal locations; repeated rows change nothing. Texts of any length are read whole.
    * Pairs that verify as the same building are joined to components. A location known without its town or without its postal code
      goes with another it agrees with only if that is the only one.
    * An empty table gives an empty result; other columns are ignored.
    """
    located, _ = _located(records, address, country, cosine)
    return _stored(records, address, country).distinct().join(located, "key").select("address", "country", F.lower(F.hex("location")).alias("location"))


def same_location_pairs(records: DataFrame, id_col: str, address: str, country: str, cosine: float = COSINE) -> DataFrame:
    """Pairs of records whose addresses denote one location and are not equal as stored: ``id_col_a, id_col_b``, smaller first.

    Records that share a stored address are matched through that address: the pairs of differing addresses are found once
    and only then carried to the records, so a hot address costs what its result rows cost. An id given in several rows
    counts once for each of its addresses.
    """
    located, read = _located(records, address, country, cosine)
    where = materialize(located.withColumnRenamed("location", "group"), "located")
    release(*read)
    ids = _stored(records.select(F.col(id_col).alias("i"), address, country).where("i is not null"), address, country, "i").select("i", "key")
    return pairs_of_records(where, ids, id_col)
