"""Every operator on empty tables, nulls, ties, repeated rows, long texts and columns with clashing names."""

import pytest

from kinloom.llm.addresses import locate, same_location_pairs
from kinloom.llm.cascade import cascade
from kinloom.llm.lookalike import canonical_text
from kinloom.llm.mixing import mix
from kinloom.llm.mojibake import repair
from kinloom.llm.packing import fill_report, pack
from kinloom.llm.topn import top_n_by_bisection
from kinloom.llm.variants import name_clusters, variant_pairs

RECORD = "entity_id string, business_name string, business_address string, country string"
# columns that clash with names used inside the operators
EXTRA = ", a string, b string, form string, cluster string, location string, affected boolean, c double, g string, i string, s double, country2 string"
LONG = "Oakfield Bakery " * 4000


def _records(spark, rows, extra=False):
    pad = (None, "x", "y", "z", "w", True, 1.0, "g", "i", 2.0, "US") if extra else ()
    return spark.createDataFrame([(*r, *pad) for r in rows], RECORD + (EXTRA if extra else ""))


def _targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def _kinds(spark, rows):
    return spark.createDataFrame(rows, "pack_kind string, capacity_tokens int")


DOCS = "doc_id long, text string, source string, lang string"


def test_empty(spark):
    r = _records(spark, [])
    assert same_location_pairs(r, "entity_id", "business_address", "country").count() == 0
    assert locate(r, "entity_id", "business_address", "country").columns == ["address", "country", "location"]
    assert variant_pairs(r, "entity_id", "business_name", "business_address", "country").count() == 0
    assert canonical_text(r, "business_name").columns == [*r.columns, "canonical", "affected"]
    assert canonical_text(r, "business_name").count() == 0
    labels = spark.createDataFrame([], "l string, r string")
    assert cascade(r.withColumnRenamed("entity_id", "l"), r.withColumnRenamed("entity_id", "r"), labels, "l", "r", "business_name", "business_address", "country").count() == 0
    assert top_n_by_bisection(spark.createDataFrame([], "g string, i string, s float"), "g", "i", "s", 5).count() == 0
    docs = spark.createDataFrame([], DOCS)
    assert repair(docs, "text", "source").count() == 0
    assert pack(docs, "doc_id", "text", _kinds(spark, [("a", 10)]), "pack_kind", "capacity_tokens").count() == 0
    chosen, report = mix(docs, "doc_id", "text", "source", "lang", _targets(spark, [("x", 1.0, 2)]))
    assert chosen.count() == 0 and report.first()["reached_tokens"] == 0


@pytest.mark.parametrize("extra", [False, True])
def test_records(spark, extra):
    rows = [
        ("S2-1", "Oakfield Bakery LLC", "12 Main Street, Millford, TX 10000", "US"), ("S2-1", "Oakfield Bakery LLC", "12 Main Street, Millford, TX 10000", "US"),
        ("S3-1", "OAKFEILD BAKERY", "12 main st., Millford", "US"), ("S2-2", None, None, None), ("S2-3", "", "", ""), ("S2-4", "?!", "<NULL>", "US"),
        ("S2-5", LONG, LONG, "US"), (None, "Oakfield Bakery LLC", "12 Main Street, Millford, TX 10000", "US"), ("S2-6", "Wellbrook Clinic", "99 High Road, Millford, TX 10001", None),
    ]
    df = _records(spark, rows, extra)
    assert {tuple(r) for r in same_location_pairs(df, "entity_id", "business_address", "country").collect()} == {("S2-1", "S3-1")}
    assert {tuple(r) for r in variant_pairs(df, "entity_id", "business_name", "business_address", "country").collect()} >= {("S2-1", "S3-1")}
    assert name_clusters(df, "business_name", "business_address", "country").where("name is null").count() == 0
    canon = canonical_text(df, "business_name", "canonical", "affected")
    assert canon.count() == len(rows) and canon.where("affected").count() == 0
    left = _records(spark, [("S1-1", "Oakfield Bakery LLC", "12 Main Street, Millford, TX 10000", "US"), ("S1-2", None, None, None)], extra).withColumnRenamed("entity_id", "l")
    labels = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", None)], "l string, r string")
    got = cascade(left, df.withColumnRenamed("entity_id", "r"), labels, "l", "r", "business_name", "business_address", "country", 0.5)
    assert {(r["l"], r["r"]) for r in got.collect()} >= {("S1-1", "S2-1"), ("S1-1", "S3-1")}


def test_topn_nulls_and_ties(spark):
    rows = [("g", f"i{k:02d}", 1.0) for k in range(30)] + [("g", "i00", 1.0), ("g", None, 5.0), (None, "i", 5.0), ("h", "a", float("nan")), ("h", "b", None), ("k", "a", 1.0), ("k", "a", 3.0), ("k", "ab", 3.0), ("k", "b", float("inf")), ("k", "c", float("-inf"))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "g string, i string, s double, piece string, level int")
    got = {(r["g"], r["i"]): r["s"] for r in top_n_by_bisection(df, "g", "i", "s", 3).collect()}
    assert got == {("g", "i00"): 1.0, ("g", "i01"): 1.0, ("g", "i02"): 1.0, ("k", "b"): float("inf"), ("k", "a"): 3.0, ("k", "ab"): 3.0}
    with pytest.raises(ValueError):
        top_n_by_bisection(df, "g", "i", "s", 0)


def test_documents(spark):
    rows = [(1, "a short text", "x", "en"), (1, "a short text", "x", "en"), (None, "no id", "x", None), (2, None, "x", "en"), (3, "", "y", "en"), (4, LONG, "y", "fr"), (5, "kept apart", None, "en")]
    docs = spark.createDataFrame([(*r, "q", 3, 4) for r in rows], DOCS + ", kind string, n long, row long")
    fixed = repair(docs, "text", "source", "kind", "n", "chains")
    assert fixed.count() == 7 and fixed.where("n").count() == 0
    assert {r["kind"] for r in fixed.collect()} == {r[1] for r in rows}
    packed = pack(docs, "doc_id", "text", _kinds(spark, [("small", 64), ("none", None), ("zero", 0)]), "pack_kind", "capacity_tokens")
    per = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg({"part": "count"}).withColumnRenamed("count(part)", "n").collect()}
    assert set(per) == {1, None, 4, 5} and per[1] == 2 and per[4] > 100
    assert fill_report(packed).first()["fullest"] <= 64
    chosen, report = mix(docs, "doc_id", "text", "source", "lang", _targets(spark, [("x", 0.5, 2), ("y", 0.5, 1), ("z", 0.1, 3), ("w", None, None), (None, 1.0, 1)]))
    assert chosen.where("doc_id in (2, 3, 5)").count() == 0
    assert {r["source"]: r["reached_tokens"] for r in report.collect()}.keys() == {"x", "y", "z", "w"}
