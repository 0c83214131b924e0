"""Queries of the operators for training data, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.llm.addresses import locate, same_location_pairs
from kinloom.llm.cascade import cascade
from kinloom.llm.lookalike import canonical_text
from kinloom.llm.mixing import mix
from kinloom.llm.mojibake import repair
from kinloom.llm.packing import fill_report, pack
from kinloom.llm.topn import top_n_by_bisection
from kinloom.llm.variants import name_clusters, variant_pairs
from kinloom.sources.tables import table


def p4_top_candidates(spark: SparkSession, base: str) -> DataFrame:
    return top_n_by_bisection(table(spark, base, "candidate_pairs"), "source1_entity_id", "cand_id", "bscore", 5)


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return p4_top_candidates(spark, base).select("source1_entity_id", "cand_id")


def pool(spark: SparkSession, base: str) -> DataFrame:
    """The records of s2 and s3, each ``entity_id`` once."""
    cols = ["entity_id", "business_name", "business_address", "country"]
    s2, s3 = (table(spark, base, t).select(*cols) for t in ("s2", "s3"))
    return s2.unionByName(s3).dropDuplicates(["entity_id"])


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    return same_location_pairs(pool(spark, base), "entity_id", "business_address", "country")


def p2_locations(spark: SparkSession, base: str) -> DataFrame:
    """One row per differently written address with its location."""
    return locate(pool(spark, base), "entity_id", "business_address", "country")


def p3_matches(spark: SparkSession, base: str) -> DataFrame:
    """All matches of s1 and s2 with rule and confidence, the labelled ones included."""
    known = table(spark, base, "known_matches")
    labels = known.select("source1_entity_id", F.explode_outer(F.split("matched_entity_ids", ",")).alias("m")).select(
        "source1_entity_id", F.nullif(F.trim("m"), F.lit("")).alias("entity_id")
    )
    s1 = table(spark, base, "s1").withColumnRenamed("entity_id", "source1_entity_id")
    return cascade(s1, table(spark, base, "s2"), labels, "source1_entity_id", "entity_id", "business_name", "business_address", "country")


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    known = table(spark, base, "known_matches").select("source1_entity_id").distinct()
    return p3_matches(spark, base).join(known, "source1_entity_id", "left_anti").select("source1_entity_id", "entity_id").distinct()


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    return variant_pairs(pool(spark, base), "entity_id", "business_name", "business_address", "country")


def p5_name_clusters(spark: SparkSession, base: str) -> DataFrame:
    """One row per stored name with the cluster of names it belongs to."""
    return name_clusters(pool(spark, base), "business_name", "business_address", "country")


def p6_canonical_names(spark: SparkSession, base: str) -> DataFrame:
    names = pool(spark, base).select("entity_id", "business_name")
    return canonical_text(names, "business_name", "canonical_name", "affected")


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    return p6_canonical_names(spark, base).where("affected").select("entity_id")


def p7_packed(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    return pack(docs, "doc_id", "text", table(spark, base, "pack_sizes"), "pack_kind", "capacity_tokens")


def p7_fill_report(spark: SparkSession, base: str) -> DataFrame:
    return fill_report(p7_packed(spark, base))


def p7_checks(spark: SparkSession, base: str) -> DataFrame:
    """What must hold of containers, by kind: texts packed, tokens lost or doubled, containers over capacity, texts split without need."""
    d = p7_packed(spark, base)
    size = F.col("token_to") - F.col("token_from")
    bins = d.groupBy("pack_kind", "bin_id").agg(F.sum(size).alias("filled"), F.max("capacity").alias("cap")).groupBy("pack_kind").agg(F.count_if(F.col("filled") > F.col("cap")).alias("overfull"))
    # consecutive parts from 0: their sizes add up to the last end, and all but the last fill a container
    texts = d.groupBy("pack_kind", "doc_id").agg(F.sum(size).alias("tokens"), F.max("token_to").alias("last"), F.max("capacity").alias("cap"), F.count("*").alias("parts"), F.count_distinct("part").alias("numbers"))
    texts = texts.groupBy("pack_kind").agg(
        F.count("*").alias("n_texts"), F.count_if((F.col("tokens") != F.col("last")) | (F.col("parts") != F.col("numbers"))).alias("broken"), F.count_if(F.col("parts") != F.ceil(F.col("last") / F.col("cap"))).alias("split_without_need")
    )
    return bins.join(texts, "pack_kind")


def _mixed(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return mix(table(spark, base, "documents"), "doc_id", "text", "source", "lang", table(spark, base, "mix_targets"))


def p8_mixture(spark: SparkSession, base: str) -> DataFrame:
    return _mixed(spark, base)[0]


def p8_reached_shares(spark: SparkSession, base: str) -> DataFrame:
    return _mixed(spark, base)[1]


def p8_checks(spark: SparkSession, base: str) -> DataFrame:
    """What must hold of a mixture, by source: texts in it that are not of the source, repeats above the cap, texts without a target."""
    chosen, report = _mixed(spark, base)
    docs = table(spark, base, "documents").select("doc_id", F.col("source").alias("own"))
    wrong = chosen.join(docs, "doc_id", "left").where("own is null or own <> source").groupBy("source").agg(F.count("*").alias("wrong"))
    d = report.join(wrong, "source", "left")
    return d.select("source", "target_share", F.coalesce("wrong", F.lit(0)).alias("wrong"), (F.col("most_times") > F.col("max_repeats")).alias("over_cap"), (F.col("reached_tokens") > F.col("available_tokens") * F.col("max_repeats")).alias("over_size"))


def p9_repaired_documents(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text", "source")
    return repair(docs, "text", "source").select("doc_id", "source", "garbled", "chains", "repaired")


def p9_found(spark: SparkSession, base: str) -> DataFrame:
    return p9_repaired_documents(spark, base).where("garbled").select("doc_id")


_P4 = """
    FROM (SELECT source1_entity_id, cand_id, max(CAST(bscore AS DOUBLE)) AS bscore FROM candidate_pairs
          WHERE source1_entity_id IS NOT NULL AND cand_id IS NOT NULL AND bscore IS NOT NULL AND NOT isnan(bscore)
          GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY source1_entity_id ORDER BY bscore DESC, cand_id) <= 5"""

QUERIES = {
    "p2_found": p2_found,
    "p2_locations": p2_locations,
    "p3_found": p3_found,
    "p3_matches": p3_matches,
    "p4_found": p4_found,
    "p4_top_candidates": p4_top_candidates,
    "p5_found": p5_found,
    "p5_name_clusters": p5_name_clusters,
    "p6_found": p6_found,
    "p6_canonical_names": p6_canonical_names,
    "p7_packed": p7_packed,
    "p7_fill_report": p7_fill_report,
    "p7_checks": p7_checks,
    "p8_mixture": p8_mixture,
    "p8_reached_shares": p8_reached_shares,
    "p8_checks": p8_checks,
    "p9_found": p9_found,
    "p9_repaired_documents": p9_repaired_documents,
}
ORACLES = {
    "p4_found": "SELECT source1_entity_id, cand_id" + _P4,
    "p4_top_candidates": "SELECT source1_entity_id, cand_id, bscore" + _P4,
    "p7_checks": "SELECT pack_kind, 0 AS overfull, (SELECT count(*) FROM documents WHERE length(text) > 0) AS n_texts, 0 AS broken, 0 AS split_without_need FROM pack_sizes",
    "p8_checks": "SELECT source, target_share, 0 AS wrong, false AS over_cap, false AS over_size FROM mix_targets",
}
