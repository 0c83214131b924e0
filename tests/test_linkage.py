"""Blocking selection, decision rules, siblings, checks and the stream, on small tables."""

import pytest

from kinloom.config import PRESETS, Blocking
from kinloom.functions.text import add_views
from kinloom.operators import aliases, blocking, decision, features, model, rules, siblings, stage2, validate
from kinloom.sources.files import write_id_lists
from kinloom.streaming.blocking_stream import run_to_folder, static_key_table

G = "source1_entity_id"
RAW = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def records(spark):
    clean = [("S1-1", "Alder Bakery LLC", "12 Main Street, Ford, TX 10000", "US"), ("S1-2", "Birch Clinic", "5 Oak Road, Lake, TX 20000", "US"), ("S1-3", "Cedar Optics Limited", "Plot No 8, Rose Nagar, Town, Bihar 300000", "India")]
    pool = [
        ("S2-1", "ALDER BAKERY", "12 Main St, Ford", "US"), ("S3-1", "Alder Bakry L.L.C.", "0012 main street ford texas", "US"), ("S2-2", "Birch Clinic Inc", "5 Oak Rd", "US"),
        ("S2-3", "Cedar Optics", "H.No. 8, Rose Ngr", "India"), ("S2-4", "सीडर ऑप्टिक्स", "8 Rose Nagar", "India"), ("S2-5", None, None, "US"), ("S2-6", "Alder Bakery", "13 Main Street, Ford", "US"),
    ]
    return add_views(spark.createDataFrame(clean, RAW)), add_views(spark.createDataFrame(pool, RAW))


@pytest.mark.parametrize("cfg", [*PRESETS.values(), Blocking(select="none"), Blocking(select="combo"), Blocking(select="rscore"), Blocking(weight="log")], ids=lambda c: f"{c.select}-{c.retrieve_k}-{c.reverse_k}")
def test_every_selection(records, cfg):
    got = {tuple(r) for r in blocking.generate_candidates(*records, cfg).select(G, "cand_id").collect()}
    assert {("S1-1", "S2-1"), ("S1-2", "S2-2"), ("S1-3", "S2-3")} <= got
    assert all(not b == "S2-5" for _, b in got)


def test_no_key_twice(records):
    keys = blocking.record_keys(records[0])
    assert keys.count() == keys.distinct().count() and keys.groupBy("id").count().agg({"count": "max"}).first()[0] <= 114


def test_features_complete(records):
    pairs = blocking.generate_candidates(*records, Blocking())
    a, b = (features.add_name_freq(d) for d in records)
    f = features.compute_features(pairs, a, b, features.token_idf(a, b))
    assert f.columns[4:] == list(features.FEATURES) and len(features.FEATURES) == 61
    assert f.count() == pairs.count() and f.dropna(subset=list(features.FEATURES)).count() == f.count()
    row = f.where("source1_entity_id = 'S1-1' and cand_id = 'S2-6'").first()
    assert row["num_conflict"] == 1 and row["num_delta_small"] == 1 and row["name_tset"] == 1


SCORES = [("S1-1", "S2-1", "US", 0.95), ("S1-1", "S3-1", "US", 0.8), ("S1-2", "S2-1", "US", 0.95), ("S1-2", "S2-2", "US", 0.7), ("S1-3", "S2-3", "India", 0.02), ("S1-1", "S2-6", "US", 0.92)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(SCORES, f"{G} string, cand_id string, country string, p double")


def test_decisions(spark, scored):
    own = {tuple(r)[:2] for r in decision.apply_exclusivity(scored).select(G, "cand_id").collect()}
    assert ("S1-1", "S2-1") in own and ("S1-2", "S2-1") not in own  # equal p: the smaller id
    chosen = decision.choose_by_threshold(scored, 0.7)
    lists = {r[G]: r["ids"] for r in decision.to_lists(chosen, spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], f"{G} string")).collect()}
    assert lists == {"S1-1": ["S2-1", "S2-6", "S3-1"], "S1-2": ["S2-2"], "S1-3": []}
    truth = spark.createDataFrame([("S1-1", ["S2-1"]), ("S1-2", ["S2-2"]), ("S1-3", [])], f"{G} string, matched array<string>")
    f = decision.f05_macro(decision.to_lists(chosen, truth), truth)
    assert f == pytest.approx((1.25 / 3 / (0.25 / 3 + 1) + 2) / 3)
    assert decision.tune_decision(scored, truth).count() == 26
    assert decision.choose_matches(scored, 0.3, 1.0).count() > 0


def test_rules(records, scored):
    numbers = rules.numbers_frame(records[0], G, "nums1"), rules.numbers_frame(records[1], "cand_id", "nums2")
    for variant in rules.VARIANTS:
        assert rules.apply_post(scored, *numbers, variant).count() == len(SCORES)
    zero = {tuple(r) for r in rules.apply_post(scored, *numbers, "conflict_p95").where("p = 0").select(G, "cand_id").collect()}
    assert ("S1-1", "S2-6") in zero
    q = {tuple(r)[:2]: r["p"] for r in rules.joint_probability(scored).select(G, "cand_id", "p").collect()}
    assert q["S1-1", "S2-1"] == pytest.approx(19 / 39) and q["S1-2", "S2-2"] == pytest.approx(0.7)
    for mode in ("strength", "explain"):
        kept = rules.reassign(scored, 0.5, mode, 0.1, *records)
        assert kept.count() == kept.select("cand_id").distinct().count()
    blended = rules.blend(scored, [scored.where("p > 0.9").selectExpr(G, "cand_id", "p / 2 as p")], None)
    assert {round(r["p"], 4) for r in blended.where("cand_id = 'S3-1'").collect()} == {0.8}


def test_stage2(records, scored):
    f = stage2.stage2_features(scored, *records)
    assert f.columns[2:] == list(stage2.STAGE2_FEATURES) and f.count() == 6 and f.dropna().count() == 6


def test_siblings_and_aliases(spark, records):
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-2"), ("S1-3", "S2-3"), ("S1-3", "S2-4")], f"{G} string, matched_id string")
    raw = records[1].select("entity_id", "business_name", "business_address", "country")
    made = siblings.make_siblings(records[0], raw, truth, 1.0).collect()
    assert made and all("-syn" in r["entity_id"] for r in made) and made == siblings.make_siblings(records[0], raw, truth, 1.0).collect()
    learned = aliases.learn_aliases(*records, truth, min_count=1)
    words = {r["src"]: r["dst"] for r in learned.collect()}
    assert set(words.values()) <= {"cedar", "optics"} and words
    renamed = aliases.apply_aliases(records[1], learned).where("entity_id = 'S2-4'").first()
    assert renamed["name_core"] == "cedar optics" and renamed["name_concat"] == "cedaroptics"


def test_model(spark):
    rows = [(f"S1-{k % 40}", f"S2-{k}", float(k % 7), float(k % 3), int(k % 7 > 3)) for k in range(400)]
    data = spark.createDataFrame(rows, f"{G} string, cand_id string, a double, b double, y int")
    oof = model.cross_validated(data, ("a", "b"), 2, params=model.Boosting(rounds=3, depth=3))
    assert oof.count() == 400 and model.auc(oof) > 0.95
    assert model.auc_by_ranks(oof).first()["auc"] == pytest.approx(model.auc(oof), abs=1e-3)


def test_result_files(spark, records, tmp_path):
    lists = spark.createDataFrame([("S1-1", ["S2-1", "S2-1"]), ("S1-2", []), ("S1-3", ["S2-3"])], f"{G} string, ids array<string>")
    path = str(tmp_path / "m.tsv")
    write_id_lists(lists, path, "matched_entity_ids")
    assert validate.validate_submission(spark, path, None, records[0], records[1]).errors == []
    bad = tmp_path / "bad.tsv"
    bad.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-1\tX-1\nS1-9\tS1-2,S2-99\nbroken\n", encoding="utf-8")
    found = validate.validate_submission(spark, str(bad), None, records[0], records[1])
    assert found.exit_code == 1 and len(found.errors) == 8
    comma = tmp_path / "c.tsv"
    comma.write_text("source1_entity_id,matched_entity_ids\n", encoding="utf-8")
    assert "commas" in validate.validate_submission(spark, str(comma), None, records[0]).errors[0]


def test_stream(spark, records, tmp_path):
    src = str(tmp_path / "in")
    records[1].select("entity_id", "business_name", "business_address", "country").write.json(src)
    stream = spark.readStream.schema(RAW).json(src)
    q = run_to_folder(stream, static_key_table(records[0], 100), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("cand_id", G).distinct().collect()}
    assert ("S2-1", "S1-1") in got and ("S2-2", "S1-2") in got
