"""Queries of problem 1: per-address results over a table whose addresses are badly skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.operators.skew import balanced_group_stats
from kinloom.sources.tables import table

HEAVY_SHARE = 0.01
FOUND_SHARE = 0.02


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    s2 = table(spark, base, "s2")
    stats = balanced_group_stats(s2, "business_address", "entity_id", "loaded_at", HEAVY_SHARE)
    least = FOUND_SHARE * s2.count()  # from the file footers
    return stats.where((F.col("business_address") != "") & (F.col("n_rows") >= least)).select("business_address")


def p1_address_results(spark: SparkSession, base: str) -> DataFrame:
    return balanced_group_stats(table(spark, base, "s2"), "business_address", "entity_id", "loaded_at", HEAVY_SHARE)


QUERIES = {"p1_found": p1_found, "p1_address_results": p1_address_results}
ORACLES = {
    "p1_found": """
        SELECT business_address FROM s2 WHERE business_address IS NOT NULL AND business_address <> ''
        GROUP BY 1 HAVING count(*) >= 0.02 * (SELECT count(*) FROM s2)""",
    "p1_address_results": """
        SELECT business_address, count(*) AS n_rows, count(DISTINCT entity_id) AS n_ids,
               min(loaded_at) AS first_at, max(loaded_at) AS last_at
        FROM s2 GROUP BY 1""",
}
