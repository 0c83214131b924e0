"""Link the spellings under which one business or person appears.

Names are blocked by phonetic codes of their sorted words, compared word by word with Jaro-Winkler similarity, edit distance and a
nickname table, and accepted pairs are clustered by connected components.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.llm.addresses import parse_address
from kinloom.llm.matching import components, pairs_of_records, text_key
from kinloom.llm.names import GIVEN, USUAL_WORDS, Vocabulary, code, fine_code, name_words, same_name
from kinloom.session import bounded_broadcast, materialize, release

#: A word is common if at least this share of the records holds it; so there are at most (words per name) / SHARE of them.
SHARE = 0.0015
#: A word in fewer records than this is not common, unless it is one of the usual words: more than the copies of one business.
LEAST = 20
#: A place of so many clusters of names is no cluster's own.
MANY = 10
#: Blocks, and then pairs, of this many forms are on disk at a time, but at least an eighth of them.
FORMS_PER_SLICE, SLICES = 50_000, 8
_DOUBLE = re.compile(r"(.)\1+")
#: "and" inside words that are run together
_LINK = re.compile(r"(?<=[a-z]{4})(?:and|et)(?=[a-z]{4})")


def _once(sounds: str) -> str:
    return _DOUBLE.sub(r"\1", sounds)


@functools.lru_cache(maxsize=65536)
def _cuts(sounds: str) -> frozenset[str]:
    """A code of three sounds or more with one of them left out."""
    return frozenset(_once(sounds[:k] + sounds[k + 1 :]) for k in range(len(sounds))) if len(sounds) >= 3 else frozenset()


def block_keys(rare: list[str], common: list[str]) -> list[str]:
    """Phonetic codes of the sorted words, one of them rare; codes of rare words also with one sound left out.

    A long code stands for itself, so names meet that differ in all other words. A whole code is paired with each other word's. Of that word the first sound suffices where the code is long, or where it is an
    initial or a given name. A short code with a sound left out is shared by many words: it is paired with other rare words, and with
    all other words at once.
    """
    words = sorted({*rare, *common})
    joined = "".join([*rare, *common])
    keys = {"=" + code(text) for text in {joined, _LINK.sub("", joined), "".join(words)}}
    for r in rare:
        others = [w for w in words if w != r]
        sounds = [fine_code(w) for w in others] or ["-"]
        telling = {fine_code(w) for w in others if w in rare} | {"".join(sounds)}
        for c in {fine_code(r), fine_code(r.replace("rn", "m"))}:
            cut = _cuts(c)
            keys |= {f"{c}+{fine_code(w)[:1]}" for w in others if len(c) >= 4 or len(w) == 1 or w in GIVEN}
            keys |= {f"{c}~{o}" if c < o else f"{o}~{c}" for o in sounds} | ({c} if len(c) >= 4 else set())
            keys |= {f"{f}~{o}" if f < o else f"{o}~{f}" for f in cut | {c} for o in (telling if len(c) <= 4 else sounds)}
    return sorted(keys)


def read_names(records: DataFrame, name: str, country: str) -> DataFrame:
    """``name, country, n, words, indic``: each distinct name read once, with the number of its rows."""

    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            yield pd.DataFrame([(list(words), indic) for words, indic in map(name_words, series)], columns=["words", "indic"])

    distinct = records.select(F.col(name).cast("string").alias("name"), F.coalesce(F.col(country).cast("string"), F.lit("")).alias("country")).where("name is not null")
    distinct = distinct.groupBy("name", "country").agg(F.count("*").alias("n"))
    return materialize(distinct.withColumn("r", F.pandas_udf(read, "words array<string>, indic boolean")("name")).select("name", "country", "n", "r.*"), "names")


def common_words(names: DataFrame, share: float = SHARE) -> dict[str, int]:
    """The words that at least ``share`` of all rows hold, with the number of rows."""
    least = share * (names.agg(F.sum("n")).first()[0] or 0)
    counted = names.select("n", F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.sum("n").alias("n")).where((F.col("n") >= max(least, LEAST)) | F.col("w").isin(*USUAL_WORDS))
    return {r["w"]: r["n"] for r in counted.collect()}


def parsed_names(records: DataFrame, name: str, country: str) -> DataFrame:
    """``name, country, form, parts, n_common, tells``: each distinct name with its rare and common words in one text.

    A form is country, rare and common words. A name without a rare word and two common ones tells no business: ``tells`` is false.
    """
    names = read_names(records, name, country)
    model = records.sparkSession.sparkContext.broadcast(common_words(names))

    def parse(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(model.value)
        for words, indic in batches:
            rows = []
            for w, i in zip(words, indic):
                rare, common = vocabulary.parts(w, i)
                rows.append((" ".join(rare) + "|" + " ".join(common), len(common), bool(rare) or len(common) > 1))
            yield pd.DataFrame(rows, columns=["parts", "n_common", "tells"])

    parsed = names.withColumn("p", F.pandas_udf(parse, "parts string, n_common int, tells boolean")("words", "indic")).select("name", "country", "p.*")
    parsed = materialize(parsed.withColumn("form", F.unhex(F.md5(F.concat_ws("|", "country", "parts")))), "name-forms")
    release(names)
    return parsed


def blocked_forms(parsed: DataFrame, *keep: str) -> DataFrame:
    """``id, form, country, parts, n_common, keys``: each distinct form of the names that tell a business, with a short number and its blocks, made once for all its names, and ``keep``."""

    def block(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for parts in batches:
            # a form has dozens of blocks: forms are handed over in small parts, which bounds the worker's memory
            for at in range(0, len(parts), 2000):
                yield pd.Series([block_keys(*_parts(x)) for x in parts[at : at + 2000]])

    forms = parsed.where("tells").select("form", "country", "parts", "n_common", *keep).distinct()
    # a block is one number for country and key
    keyed = forms.withColumn("keys", F.transform(F.pandas_udf(block, "array<string>")("parts"), lambda k: F.xxhash64("country", k)))
    return materialize(keyed.withColumn("id", F.monotonically_increasing_id()), "blocked-forms")


@functools.lru_cache(maxsize=16384)
def _parts(text: str) -> tuple[list[str], list[str]]:
    rare, _, common = text.partition("|")
    return rare.split(), common.split()


def _verdict(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([same_name(*_parts(a), *_parts(b)) for a, b in zip(x, y)], dtype="int32")


def judged_pairs(left: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """Pairs of forms that share a block, with the verdict of the comparison: ``a, b, v, short`` (v as in ``same_name``, 0 left out).

    Within one table each pair comes once; with ``right``, ``a`` is of ``left`` and ``b`` of ``right``, equal forms included.
    """
    other = left if right is None else right
    n = min(SLICES, max(1, math.ceil(left.count() / FORMS_PER_SLICE)))
    found = []
    for i in range(n):
        sliced = F.explode(F.filter("keys", lambda h: F.pmod(h, F.lit(n)) == i)).alias("h")
        a, b = left.select(F.col("id").alias("a"), sliced), other.select(F.col("id").alias("b"), sliced)
        pairs = a.join(b, "h").where("a < b") if right is None else a.join(b, "h")
        found.append(materialize(pairs.select("a", "b").distinct(), "blocked-pairs"))
    pairs = found[0]
    if n > 1:
        pairs = materialize(functools.reduce(DataFrame.union, found).distinct(), "blocked-pairs")
        release(*found)
    text = ["form", "country", "parts", "n_common"]
    x, y = left.select(F.col("id").alias("a"), F.struct(*text).alias("x")), other.select(F.col("id").alias("b"), F.struct(*text).alias("y"))
    judged = []
    for i in range(n):
        own = F.pmod(F.xxhash64("a"), F.lit(n)) == i
        # should two blocks ever share a number, the check of the country parts them
        d = pairs.where(own).join(x.where(own), "a").join(y, "b").where("x.country = y.country").select("x", "y")
        if right is None:  # numbers of forms differ from run to run: the comparison goes by the forms
            d = d.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        d = d.withColumn("v", F.pandas_udf(_verdict, "int")("x.parts", "y.parts")).where("v <> 0")
        shorter = F.when(F.col("x.n_common") < F.col("y.n_common"), F.col("x.form")).otherwise(F.col("y.form"))
        judged.append(materialize(d.select(F.col("x.form").alias("a"), F.col("y.form").alias("b"), "v", shorter.alias("short")), "name-pairs"))
    release(pairs)
    return functools.reduce(DataFrame.union, judged)


def place_keys(parsed: tuple[str, str, str, list[str]]) -> list[str]:
    """House number with two telling words, or with one and the postal code."""
    number, postal, _, words = parsed
    codes = sorted({code(w) for w in words})
    pairs = {f"{number}|{a}|{b}" for i, a in enumerate(codes) for b in codes[i + 1 :]}
    return sorted(pairs | ({f"{number}|{a}|{postal}" for a in codes} if postal else set()))


def address_places(records: DataFrame, address: str, country: str) -> DataFrame:
    """``address, country, places``: the places of each distinct address as numbers (the country among them); none for an address without."""

    rows = records.select(F.col(address).cast("string").alias("address"), F.coalesce(F.col(country).cast("string"), F.lit("")).alias("country")).where("address is not null").distinct()
    return rows.withColumn("places", _places("address", "country"))


@functools.lru_cache(maxsize=16384)
def _address_keys(address: str, country: str) -> list[str]:
    p = parse_address(address, country)
    return place_keys(p) if p else []


def _places(address: str, country: str) -> Column:
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for addresses, countries in batches:
            yield pd.Series([_address_keys(a, c) for a, c in zip(addresses, countries)])

    return F.transform(F.pandas_udf(place, "array<string>")(address, country), lambda p: F.xxhash64(country, p))


def name_clusters(records: DataFrame, name: str, address: str, country: str) -> DataFrame:
    """The cluster of each stored name: ``name, country, cluster``.

    * Names whose words all have a partner are one cluster, if the rare ones are equal, or if not both have places of their own, apart from each other.
    * Names of the same rare words that differ by a common word, and names that lack a rare word of two, are joined only at a common place (an
      exact check by house number and two parts of the address) that is their own: a place of ``MANY`` or more clusters speaks for none.
    * A name that lacks common words of a longer one joins its cluster if both occur at a common place and no other longer cluster does, or
      if there is only one longer cluster and that has no place of its own, which would speak for another business.
    * Null names, and names without two common words or a rare one, are in no cluster. Texts are read whole.
    * An empty table gives an empty result; other columns are ignored; repeated rows change nothing.
    """
    clusters, _ = _clustered(records, name, address, country, keep_blocks=True)
    return clusters.select("name", "country", F.lower(F.hex("cluster")).alias("cluster"))


def _clustered(records: DataFrame, name: str, address: str, country: str, keep_blocks: bool = False) -> tuple[DataFrame, list[DataFrame]]:
    """(``name, country, cluster`` of each stored name, the tables that are to be released once it is read)."""
    parsed = parsed_names(records, name, country)
    stored = parsed.where("tells").select("name", "country", "form")
    blocked = blocked_forms(parsed)
    judged = judged_pairs(blocked)
    if not keep_blocks:
        release(blocked)
    uses = records.select(F.col(name).cast("string").alias("name"), F.col(address).cast("string").alias("address"), F.coalesce(F.col(country).cast("string"), F.lit("")).alias("country")).where("name is not null and address is not null")
    # by form at once, for its addresses as for its places
    uses = uses.join(stored, ["name", "country"]).select("form", "address", "country").repartition("form").distinct()
    at_form = materialize(uses.select("form", F.explode(_places("address", "country")).alias("place")).distinct(), "name-places")
    agreed = components(judged.where("v = 3"), "a", "b")
    of = of_forms = materialize(stored.select("form").distinct().join(agreed.withColumnRenamed("node", "form"), "form", "left").select("form", F.coalesce("component", "form").alias("c")), "name-components")
    at = at_clusters = materialize(at_form.join(of, "form").select("c", "place").distinct(), "cluster-places")
    release(agreed, at_form)
    busy = at.groupBy("place").count().where(F.col("count") >= MANY).select("place")
    own = materialize(at.join(bounded_broadcast(busy, 100_000), "place", "left_anti"), "own-places")

    def between(pairs: DataFrame, of: DataFrame) -> DataFrame:
        """Pairs of forms as pairs of clusters, the one of the shorter name first."""
        d = pairs.join(of.select(F.col("form").alias("a"), F.col("c").alias("ca")), "a").join(of.select(F.col("form").alias("b"), F.col("c").alias("cb")), "b").where("ca <> cb")
        return d.select(F.expr("if(short = a, ca, cb)").alias("s"), F.expr("if(short = a, cb, ca)").alias("l")).distinct()

    def together(pairs: DataFrame, at: DataFrame) -> DataFrame:
        return pairs.join(at.withColumnRenamed("c", "s"), "s").join(at.withColumnRenamed("c", "l"), ["l", "place"]).select("s", "l").distinct()

    # names spelled differently are one unless both have places of their own and none in common, which speaks for two businesses
    alike = materialize(between(judged.where("v = 2"), of), "alike-names")
    settled = own.select("c").distinct()
    apart = alike.join(settled.withColumnRenamed("c", "s"), "s", "left_semi").join(settled.withColumnRenamed("c", "l"), "l", "left_semi").join(together(alike, at), ["s", "l"], "left_anti")
    swapped = together(between(judged.where("v = -1"), of), own)
    merged = materialize(alike.join(apart, ["s", "l"], "left_anti").select("s", "l").union(swapped), "merged-names")
    merged_components = components(merged, "s", "l")
    release(alike, merged)
    joined = merged_components.select(F.col("node").alias("c"), F.col("component").alias("d"))
    of = materialize(of.join(joined, "c", "left").select("form", F.coalesce("d", "c").alias("c")), "name-components")
    at = materialize(at.join(joined, "c", "left").select(F.coalesce("d", "c").alias("c"), "place").distinct(), "cluster-places")
    release(of_forms, at_clusters)
    owners = own.join(joined, "c", "left").select(F.coalesce("d", "c").alias("l")).distinct()
    weak = materialize(between(judged.where("v = 1"), of), "weak-names")
    # a short name that fits several longer ones at its place, or anywhere, stays alone
    shared = together(weak, at).groupBy("s").agg(F.count("*").alias("k"), F.min("l").alias("l")).where("k = 1").select("s", "l")
    alone = weak.groupBy("s").agg(F.count("*").alias("k"), F.min("l").alias("l")).where("k = 1").join(owners, "l", "left_anti").select("s", "l")
    links = materialize(shared.union(alone).distinct(), "name-links")
    last = components(links, "s", "l")
    release(at, own, weak, links, merged_components)
    joined = last.select(F.col("node").alias("c"), F.col("component").alias("cluster"))
    clusters = of.join(joined, "c", "left").select("form", F.coalesce("cluster", "c").alias("cluster"))
    return stored.join(clusters, "form").select("name", "country", "cluster"), [parsed, of, last]


def variant_pairs(records: DataFrame, id_col: str, name: str, address: str, country: str) -> DataFrame:
    """Pairs of records whose names are variants of one business's name and not equal as stored: ``id_col_a, id_col_b``."""
    clusters, read = _clustered(records, name, address, country)
    grouped = materialize(clusters.select(text_key("country", "name").alias("key"), F.col("cluster").alias("group")), "name-clusters")
    release(*read)
    ids = records.select(F.col(id_col).alias("i"), F.col(name).cast("string").alias("n"), F.coalesce(F.col(country).cast("string"), F.lit("")).alias("country")).where("i is not null and n is not null")
    return pairs_of_records(grouped, ids.select("i", text_key("country", "n").alias("key")), id_col)
