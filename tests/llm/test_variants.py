"""Names that lack a word: which evidence joins them to a longer one."""

import random

import pytest

from kinloom.llm import matching, names, variants
from kinloom.llm.variants import name_clusters

HOT, OTHER = "12 Kelford Street, Brackton, TX 10000", "77 Wenlow Avenue, Minaville, TX 10400"


def clusters(spark, records):
    """The cluster of each name among many rows of common words, most of them at one hot address."""
    common = ["Trading Services", "Optics Bakery", "International Clinic", "Optics International", "Optics Trading"]
    rows = [(n, a, "US") for n, a in records] + [(common[k % 5], HOT if k % 10 else f"{k} Oakfield Road, Wenlow, TX 10400", "US") for k in range(3000)]
    df = spark.createDataFrame(rows, "n string, ad string, co string")
    return {r["name"]: r["cluster"] for r in name_clusters(df, "n", "ad", "co").collect()}


def test_a_hot_address_is_evidence(spark):
    got = clusters(spark, [("Vordutek Optics", HOT), ("Vordutek Optics International", HOT), ("Vordutek Optics Trading", OTHER)])
    assert got["Vordutek Optics"] == got["Vordutek Optics International"] != got["Vordutek Optics Trading"]


def test_the_only_choice_whatever_the_copies(spark):
    # one address has many names, so it is no name's own
    busy = [(n, HOT) for n in ("Alpnok", "Brivex", "Cludor", "Drofim", "Eskupa", "Fimgot", "Glevas", "Hubrik", "Ixtol", "Jorpam")]
    got = clusters(spark, [*busy, ("Vordutek Optics", OTHER), ("Vordutek Optics Inc", OTHER), ("Vordutek Optics International", HOT), ("Dolnonas Bakery", OTHER), ("Dolnonas Bakery Trading", "9 Kelmar Lane, Ondville, TX 10900")])
    assert got["Vordutek Optics"] == got["Vordutek Optics Inc"] == got["Vordutek Optics International"]
    # a place of its own speaks for another business
    assert got["Dolnonas Bakery"] != got["Dolnonas Bakery Trading"]


def test_alike_names_with_places_of_their_own_are_two(spark):
    got = clusters(spark, [("Vordutek Optics", OTHER), ("Vordurek Optics", "9 Kelmar Lane, Ondville, TX 10900"), ("Dolnonas Bakery", OTHER), ("Dolnonsa Bakery", None), ("Jorpamel Clinic", OTHER), ("Jorpamel Trading", OTHER), ("Brivexor Clinic", OTHER), ("Drivexor Clinic", HOT)])
    assert got["Vordutek Optics"] != got["Vordurek Optics"]
    # a name spelled differently without a place, or at the same one, is the same
    assert got["Dolnonas Bakery"] == got["Dolnonsa Bakery"]
    # one word differs at a place of their own
    assert got["Jorpamel Clinic"] == got["Jorpamel Trading"]
    # another first letter and no place in common
    assert got["Brivexor Clinic"] != got["Drivexor Clinic"]


def test_blocks_are_made_once_for_all_names_of_a_form(spark, monkeypatch):
    made = {}

    def noted(df, name="step"):
        made[name] = write(df, name)
        return made[name]

    write = variants.materialize
    monkeypatch.setattr(variants, "materialize", noted)
    spellings = ["Vordutek Optics", "VORDUTEK OPTICS", "Vordutek Optics Inc", "vordutek optics ltd."]
    got = clusters(spark, [(n, OTHER) for n in spellings] + [("Dolnonas Bakery", OTHER)])
    assert len({got[n] for n in spellings}) == 1
    forms = [r["parts"] for r in made["blocked-forms"].collect()]
    assert sorted(f for f in forms if "vordutek" in f) == ["vordutek|optics"] and len(forms) == len(set(forms)) == 7


def test_common_words_are_compared_only_where_they_can_tell(monkeypatch):
    def never(*words):
        raise AssertionError(words)

    monkeypatch.setattr(names, "shortens", never)
    assert names.same_name(["vordutek"], ["dent", "grp"], ["dolnonas"], ["dental", "group"]) == 0
    assert names.same_name(["vordutek", "brivexor", "cludorna"], ["dent"], ["vordutek", "dolnonas", "jorpamel"], ["dental"]) == 0


def test_edits_by_the_letters_between():
    """Against the whole table of distances, swaps of neighbours included."""

    def whole(a, b):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rng = random.Random(5)
    for _ in range(20_000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(2))
        for most in (1, 2, 3):
            assert matching.edits(a, b, most) == min(whole(a, b), most + 1)


def test_pairs_of_forms_in_slices(spark, monkeypatch):
    """A part of the blocks and of the pairs is on disk at a time; what is found is the same, and whole tables are not left there."""
    stems = ["Vordutek", "Vordurek", "Dolnonas", "Dolnonsa", "Jorpamel", "Jorpamle", "Brivexor", "Cludorna"]
    rows = [(f"{s} {c}", None, "US") for s in stems for c in ("Optics", "Bakery", "Optics Trading")]
    parsed = variants.parsed_names(spark.createDataFrame(rows, "name string, address string, country string"), "name", "country")
    forms = variants.blocked_forms(parsed)
    whole = sorted(map(tuple, variants.judged_pairs(forms).collect()))
    both = sorted(map(tuple, variants.judged_pairs(forms, forms).collect()))
    made = []

    def noted(df, name="step"):
        made.append((name, write(df, name)))
        return made[-1][1]

    write = variants.materialize
    monkeypatch.setattr(variants, "materialize", noted)
    monkeypatch.setattr(variants, "FORMS_PER_SLICE", 5)
    assert sorted(map(tuple, variants.judged_pairs(forms).collect())) == whole and len(whole) > 20
    blocks = [df for name, df in made if name == "blocked-pairs"]
    assert len(blocks) == 6 and [name for name, _ in made].count("name-pairs") == 5
    for df in blocks:
        with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
            spark.read.parquet(df._kinloom_path).count()
    assert sorted(map(tuple, variants.judged_pairs(forms, forms).collect())) == both and len(both) > len(whole)
