"""The operators against brute force, round trips and known cases."""

import itertools
import math
import random

import pytest

from kinloom.llm import addresses, lookalike, mixing, mojibake, names, packing
from kinloom.llm.matching import components, distance
from kinloom.llm.topn import top_n_by_bisection


def test_topn_against_sort(spark):
    rng = random.Random(1)
    rows = [(f"g{int(rng.random() ** 3 * 12)}", f"S{rng.choice('23')}-{rng.randrange(400):09d}", round(rng.random(), 1)) for _ in range(6000)]
    want = set()
    best = {}
    for g, i, s in rows:
        best[g, i] = max(best.get((g, i), -1), s)
    for g in {r[0] for r in rows}:
        own = sorted((-s, i) for (h, i), s in best.items() if h == g)
        want |= {(g, i) for _, i in own[:5]}
    df = spark.createDataFrame(rows, "g string, i string, s double")
    assert {(r["g"], r["i"]) for r in top_n_by_bisection(df, "g", "i", "s", 5).collect()} == want


def test_components_against_search(spark):
    rng = random.Random(2)
    edges = [(f"n{rng.randrange(300):03d}", f"n{rng.randrange(300):03d}") for _ in range(220)] + [(f"p{k:03d}", f"p{k + 1:03d}") for k in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    assert got == {n: root(n) for n in parent}


ADDRESSES = [
    ("12 Kelford Street, Suite 4, Brackton, TX 10000", "US", 0), ("12 KELFORD ST, BRACKTON", "US", 0), ("TX 10000, Brackton, # 12 Kelfrod Str", "US", 0), ("0012 Kelford Street #9 Brackton Texas 10000-1234 USA", "US", 0),
    ("13 Kelford Street, Brackton, TX 10000", "US", 1), ("12 Kelford Street, Wenlow, TX 10400", "US", 2), ("Plot No 7, Rose Nagar, Opp. Clock Tower, Minapur, Bihar 256555", "India", 3), ("H.No. 7 , Rose Ngr , Minapur , BR - 256555, भारत", "India", 3),
    ("1er étage, 48 Allée Calsarvek, 35656 Cicalville CEDEX 2", "France", 4), ("35656 cicalville, 48, all. calsarvek", "France", 4), ("N/A", "US", None), ("Main Street", "US", None),
]


def test_locations(spark):
    df = spark.createDataFrame([(f"i{k:02d}", a, c) for k, (a, c, _) in enumerate(ADDRESSES)], "id string, ad string, co string")
    want = {(f"i{a:02d}", f"i{b:02d}") for a, b in itertools.combinations(range(len(ADDRESSES)), 2) if ADDRESSES[a][2] is not None and ADDRESSES[a][2] == ADDRESSES[b][2]}
    assert {tuple(r) for r in addresses.same_location_pairs(df, "id", "ad", "co").collect()} == want


def test_one_street_name_in_two_towns_and_ranges(spark):
    same = [
        ("100 Martin Luther King Blvd, Dallas, TX 75215", "100 Martin Luther King Boulevard, Dallas", True), ("100 Martin Luther King Blvd, Dallas, TX 75215", "100 Martin Luther King Blvd, Houston, TX 77021", False),
        ("12 Old Mill Rd, Springfield, IL", "12 Old Mill Rd, Dayton, OH", False), ("12 Old Mill Rd, Springfield", "12 Old Mill Rd, Dayton", False), ("12 Old Mill Rd, Springfield, IL 62701", "12 Old Mill Rd, Springfield, IL 62710", True),
        ("12 Kelford Road, Brackton 10000", "12 Wenlow Road, Brackton 10000", False), ("7 Kelford Ct, Brackton, TX", "7 Kelford Court, Brackton", True), ("7 Kelford Street, Brackton, CT", "7 Kelford Street, Brackton, TX", False),
        ("12-14 Baker Street, Brackton", "14 Baker Street, Brackton", True), ("12-14 Baker Street, Brackton", "13 Baker Street, Brackton", False), ("12/14 Baker Street, Brackton", "12 Baker St., Brackton", True),
    ]
    for k, (x, y, one) in enumerate(same):
        a, b = addresses.parse_numbers(x, "US"), addresses.parse_numbers(y, "US")
        assert (bool({*a[0]} & {*b[0]}) and addresses.same_building(a[3], b[3], a[1], b[1], a[2], b[2]) == 2) == one, (k, a, b)
    rows = [("a", "12-14 Baker Street, Brackton"), ("b", "14 Baker St., Brackton"), ("c", "16 Baker Street, Brackton")]
    df = spark.createDataFrame([(*r, "US") for r in rows], "id string, ad string, co string")
    assert {tuple(r) for r in addresses.same_location_pairs(df, "id", "ad", "co").collect()} == {("a", "b")}


def test_prefix_filter_loses_nothing(spark):
    rng = random.Random(3)
    parts = ["kel", "tru", "vek", "mar", "lin", "bas", "os", "ri"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(2, 3)))
    forms = []
    for k in range(120):
        words = sorted({word(), word()})
        forms.append((f"f{k:03d}", "US", [str(rng.randint(1, 3))], "", "", words, addresses.grams(words)))
    df = spark.createDataFrame(forms, "form string, country string, numbers array<string>, postal string, state string, words array<string>, grams array<string>")
    w = addresses._weights(df)
    want = set()
    for x, y in itertools.combinations(forms, 2):
        if x[2] == y[2]:
            dot = sum(w[g] ** 2 for g in set(x[6]) & set(y[6]))
            if dot / math.sqrt(sum(w[g] ** 2 for g in x[6]) * sum(w[g] ** 2 for g in y[6])) >= 0.4:
                want.add((x[0], y[0]))
    got = {(r["a"], r["b"]) for r in addresses.candidate_forms(df, 0.4).select("a", "b").collect()}
    assert want and got == want


def test_large_blocks_are_cut(spark, monkeypatch):
    """Parts of a house number meet each other, ranges once; forms are shuffled, their pairs never."""
    rng = random.Random(4)
    words = ["kelford", "kelfrod", "wenlow", "brackton", "tovesu"]
    forms = [(f"f{k:03d}", "US", [str(n) for n in range(3, rng.choice([4, 4, 7]))], "", "", sorted(rng.sample(words, 2))) for k in range(60)]
    df = spark.createDataFrame(forms, "form string, country string, numbers array<string>, postal string, state string, words array<string>")
    whole = sorted(map(tuple, addresses.compared_forms(df).collect()))
    assert len({r[:2] for r in whole}) == len(whole) > 100 and {r[3] for r in whole} == {0, 2}
    monkeypatch.setattr(addresses, "FORMS_PER_PART", 7)
    cut = addresses.compared_forms(df)
    assert sorted(map(tuple, cut.collect())) == whole
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("MapInPandas")[0] and "SortMergeJoin" not in plan


def test_tables_are_released_once_read(spark):
    from kinloom.session import application_dir, hadoop_path

    fs, path = hadoop_path(spark, application_dir(spark))
    left = lambda: {p.getPath().getName() for p in fs.listStatus(path)} if fs.exists(path) else set()
    before = left()
    df = spark.createDataFrame([(f"i{k:02d}", a, c) for k, (a, c, _) in enumerate(ADDRESSES)], "id string, ad string, co string")
    addresses.same_location_pairs(df, "id", "ad", "co").collect()
    assert {x.rpartition("-")[0] for x in left() - before} == {"half-pairs"}


def test_names():
    v = names.Vocabulary({w: 10 for w in ("bakery", "clinic", "engineering", "international", "trading", "services", "national", "optics", "sons", "jewellers")})
    parts = lambda n: v.parts(*names.name_words(n))
    same = lambda a, b: names.same_name(*parts(a), *parts(b))
    assert same("William Kelfor Bakery", "KELFOR, BILL BAKERY Inc") >= 2
    assert same("Kelfor & Tovesu Engineering Works LLP", "tovesu and kelfor engrg works") >= 2
    assert same("M/s Kelfor National Optics", "kelfornationaloptics.example") >= 2
    assert same("Vordu Grp DBA Kelfor National Optics", "Kelfor Natl Optics #1234") >= 2
    assert same("केल्फोर सर्विसेज", "Kelfor Services Ltd") >= 2
    assert same("Kelfor Optics", "Kelfor Bakery") == -1 and same("Kelfor Tovesu Optics", "Kelfor Optics") == -1
    assert same("Kelfor Optics", "Belfar Bakery") == 0
    assert same("Kelfor Optics International", "Kelfor Optics") == 1
    assert same("William Kelfor Clinic", "Robert Kelfor Clinic") == 0
    assert names.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-5)
    assert distance("abcd", "acbd") == 1 and distance("abcd", "wxyz", 2) == 3


def test_lookalikes(spark):
    texts = {"Oakfield Bakery": "Oakfield Bakery", "Оаkfіеld Ваkеrу": "Oakfield Bakery", "Ｏａｋ　ﬁeld": "Oak field", "Oak​field Bakery": "Oakfield Bakery", "Café Oak": "Café Oak", "Café Oak": "Café Oak", "प्‍राकू Oak": "प्राकू Oak", "0akfie1d": "0akfie1d", "Кафе Москва": "Кафе Москва", "𝐎𝐚𝐤": "Oak"}
    df = spark.createDataFrame([(t,) for t in [*texts, *(["Oakfield Bakery and Cafe Society", "Bakery Oak Keller"] * 40)]], "n string")
    got = {r["n"]: (r["canonical"], r["affected"]) for r in lookalike.canonical_text(df, "n").collect()}
    assert {t: got[t][0] for t in texts} == texts
    assert {t for t in texts if got[t][1]} == set(texts) - {"Oakfield Bakery", "Caf\u00e9 Oak", "प्‍राकू Oak", "0akfie1d", "Кафе Москва"}


def test_lookalikes_both_ways(spark):
    texts = {"Москвa": "Москва", "Mосква": "Москва", "Ꭺpple": "Apple", "ꓮpple": "Apple", "Зum": "3um", "Москва": "Москва", "Αθήνα": "Αθήνα", "Aθήνα": "Αθήνα", "Кафе Mосква": "Кафе Москва", "Bar Москва": "Bar Москва"}
    filler = ["Oakfield Bakery and Cafe Society", "Apple Bakery Oak Keller", "Кафе Москва сова", "Αθήνα κήπος"]
    df = spark.createDataFrame([(t,) for t in [*texts, *(filler * 40)]], "n string")
    got = {r["n"]: (r["canonical"], r["affected"]) for r in lookalike.canonical_text(df, "n").collect()}
    assert {t: got[t][0] for t in texts} == texts
    assert all(got[t][1] == (t != to) for t, to in texts.items())


SENTENCES = ["Le gâteau aux pêches était déjà prêt, évidemment.", "Größere Übungen für die Kühlbox, schön leicht", "У меня задний тормоз снова почти новый", "मेरे यहाँ नया साइकिल बेकार निकला", "Don’t clamp it — “naïve” café… €5", "Não é fácil consertar a lâmpada sozinho, avião"]


def test_undo_is_a_round_trip():
    for sentence in SENTENCES:
        for k, chain in enumerate(mojibake.CHAINS[1:], 1):
            broken = sentence
            try:
                for wrong, true in reversed(chain):
                    broken = broken.encode(true).decode(wrong)
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
            if broken != sentence:
                assert " ".join(mojibake.undo(w, k) for w in broken.split(" ")) == sentence, (mojibake.NAMES[k], broken)


def test_garbled_lines_are_found_and_restored(spark):
    rng = random.Random(4)
    rows, want = [], {}
    breaks = [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("cp1251", "koi8-r"), ("cp1252", "cp850")]
    for k in range(600):
        lines = [rng.choice(SENTENCES) for _ in range(3)]
        text = "\n".join(lines)
        if k % 6 == 0:
            true, wrong = breaks[k // 6 % len(breaks)]
            n = rng.randrange(3)
            try:
                lines[n] = lines[n].encode(true).decode(wrong)
            except (UnicodeEncodeError, UnicodeDecodeError):
                pass
        rows.append((k, "\n".join(lines), "forum"))
        want[k] = (text, "\n".join(lines) != text)
    rows.append((600, "lost � here", "forum"))
    got = {r["id"]: r for r in mojibake.repair(spark.createDataFrame(rows, "id long, t string, s string"), "t", "s").collect()}
    broken = [k for k, (_, b) in want.items() if b]
    assert len(broken) > 50 and got[600]["garbled"]
    assert all(got[k]["garbled"] == b for k, (_, b) in want.items())
    assert sum(got[k]["repaired"] == want[k][0] for k in want) >= 0.99 * len(want)


def test_lines_damaged_in_several_ways_or_thrice(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice(SENTENCES), "forum") for k in range(400)]
    french = SENTENCES[0]
    thrice = french
    for _ in range(3):
        thrice = thrice.encode("utf-8").decode("latin-1")
    mixed = french.encode("utf-8").decode("cp1252") + " " + SENTENCES[1].encode("utf-8").decode("mac_roman")
    rows += [(500, thrice, "forum"), (501, mixed, "forum"), (502, "caf\ufffd noir", "forum")]
    rows += [(600 + k, s.encode("utf-8").decode("latin-1"), "forum") for k, s in enumerate(SENTENCES[:4] * 5)]
    got = {r["id"]: r for r in mojibake.repair(spark.createDataFrame(rows, "id long, t string, s string"), "t", "s").collect()}
    assert got[500]["repaired"] == french and got[501]["repaired"] == french + " " + SENTENCES[1]
    assert got[502]["chains"] == "lost" and got[502]["garbled"] and not any(got[k]["garbled"] for k in range(400))


def test_packing_is_whole_and_tight(spark):
    rng = random.Random(5)
    docs = [(k, " ".join(rng.choice(["oak", "plank", "drill", "kiln"]) for _ in range(int(rng.paretovariate(1.1) * 8)))) for k in range(1500)]
    kinds = spark.createDataFrame([("s", 64), ("m", 300)], "kind string, cap int")
    out = packing.pack(spark.createDataFrame(docs, "id long, t string"), "id", "t", kinds, "kind", "cap", group_items=100)
    rows = out.collect()
    fill, spans = {}, {}
    for r in rows:
        fill[r["pack_kind"], r["bin_id"]] = fill.get((r["pack_kind"], r["bin_id"]), 0) + r["token_to"] - r["token_from"]
        spans.setdefault((r["pack_kind"], r["id"]), []).append((r["token_from"], r["token_to"]))
    caps = {"s": 64, "m": 300}
    assert all(n <= caps[kind] for (kind, _), n in fill.items())
    for (kind, _), parts in spans.items():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert len(parts) == 1 or all(b - a == caps[kind] for a, b in parts[:-1]) and parts[-1][1] > caps[kind]
    assert all(len({i for (k, i) in spans if k == kind}) == 1500 for kind in caps)
    assert all(r["fill_share"] > 0.97 for r in packing.fill_report(out).collect())


def _share_out(total, nodes):
    """Budgets of (weight, capacity) by brute force: a shortage is spread over the open siblings by weight, again and again."""
    got = [0.0] * len(nodes)
    live = [i for i, (w, c) in enumerate(nodes) if w > 0 and c > 0]
    left = min(total, sum(nodes[i][1] for i in live))
    while live and left > 1e-9:
        per = left / sum(nodes[i][0] for i in live)
        full = [i for i in live if per * nodes[i][0] >= nodes[i][1] - got[i] - 1e-9]
        if not full:
            for i in live:
                got[i] += per * nodes[i][0]
            break
        for i in full:
            left -= nodes[i][1] - got[i]
            got[i] = nodes[i][1]
        live = [i for i in live if i not in full]
    return got


def test_budgets_against_brute_force(spark):
    rng = random.Random(7)
    leaves = [(d, la, s, round(rng.random(), 3) * (rng.random() > 0.1), float(rng.randint(0, 60))) for d in "ab" for la in ("en", "fr", "de") for s in "pqrst" if rng.random() > 0.2]
    for total in (0.0, 40.0, 200.0, 333.0, 10_000.0):
        want = {}
        domains = sorted({x[0] for x in leaves})
        sums = lambda rows: (sum(x[3] for x in rows), sum(x[4] for x in rows))
        per_domain = [[x for x in leaves if x[0] == d] for d in domains]
        for rows, of_domain in zip(per_domain, _share_out(total, [sums(r) for r in per_domain])):
            langs = [[x for x in rows if x[1] == la] for la in sorted({x[1] for x in rows})]
            for own, of_lang in zip(langs, _share_out(of_domain, [sums(r) for r in langs])):
                want |= {x[:3]: b for x, b in zip(own, _share_out(of_lang, [(x[3], x[4]) for x in own]))}
        got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, weight double, capacity double"), mixing.F.lit(total)).collect()}
        assert got == {k: pytest.approx(b, abs=1e-6) for k, b in want.items()}


def test_a_shortage_stays_in_its_language(spark):
    # in fr, source p can't hold its share: q in fr takes it, not p or q in en
    leaves = [("all", "en", "p", 0.25, 1000.0), ("all", "en", "q", 0.25, 1000.0), ("all", "fr", "p", 0.25, 5.0), ("all", "fr", "q", 0.25, 1000.0)]
    got = {(r["lang"], r["source"]): r["budget"] for r in mixing.budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, weight double, capacity double"), mixing.F.lit(100.0)).collect()}
    assert got == {("en", "p"): pytest.approx(25), ("en", "q"): pytest.approx(25), ("fr", "p"): pytest.approx(5), ("fr", "q"): pytest.approx(45)}


def test_mixture_does_not_depend_on_files(spark):
    rows = [(k, "word " * (1 + k % 30), "pq"[k % 2], "en") for k in range(600)]
    docs = spark.createDataFrame(rows, "id long, t string, source string, lang string")
    targets = spark.createDataFrame([("p", 0.7, 2), ("q", 0.3, 1)], "source string, target_share double, max_repeats int")
    one, two = ({tuple(r) for r in mixing.mix(d, "id", "t", "source", "lang", targets, total_tokens=5000)[0].collect()} for d in (docs, docs.repartition(7, "t")))
    assert one == two
    kinds = spark.createDataFrame([("s", 64)], "kind string, cap int")
    packs = []
    for d in (docs, docs.repartition(7, "t")):
        bins = {}
        for r in packing.pack(d, "id", "t", kinds, "kind", "cap", group_items=100).collect():
            bins.setdefault(r["bin_id"], set()).add((r["id"], r["part"]))
        packs.append({frozenset(b) for b in bins.values()})
    assert packs[0] == packs[1]


def test_mixture_reaches_its_shares(spark):
    rng = random.Random(6)
    rows = [(k, "word " * rng.randint(5, 40), s, rng.choice(["en", "fr", None])) for k, s in enumerate(["big"] * 3000 + ["mid"] * 600 + ["tiny"] * 20)]
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 3), ("tiny", 0.1, 2), ("absent", 0.1, 4)], "source string, target_share double, max_repeats int")
    docs = spark.createDataFrame(rows, "id long, t string, source string, lang string")
    chosen, report = mixing.mix(docs, "id", "t", "source", "lang", targets, total_tokens=40_000)
    r = {x["source"]: x for x in report.collect()}
    assert r["absent"]["reached_tokens"] == 0 and r["tiny"]["reached_tokens"] == 2 * r["tiny"]["available_tokens"]
    assert all(x["most_times"] <= x["max_repeats"] for x in r.values())
    assert all(abs(x["reached_tokens"] - x["budget_tokens"]) <= 3 * 40 for x in r.values())
    rest = 40_000 - r["tiny"]["reached_tokens"]
    assert r["big"]["reached_tokens"] == pytest.approx(rest * 5 / 8, rel=0.01)
    assert {tuple(x) for x in chosen.collect()} == {tuple(x) for x in mixing.mix(docs, "id", "t", "source", "lang", targets, total_tokens=40_000)[0].collect()}
