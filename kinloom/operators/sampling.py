"""Seeded samples that are the same in every run: membership and order follow from a hash of the id."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.config import SEED


def seeded_fraction(df: DataFrame, id_col: str, fraction: float, seed: int = SEED) -> DataFrame:
    """About ``fraction`` of the ids, with all their rows. A filter: nothing is moved."""
    return df.where(F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1_000_000)) < int(fraction * 1_000_000))


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows, those with the smallest hash of their id; each task keeps its ``n`` best before they are merged."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), id_col).limit(n)


def example_pairs(pairs: DataFrame, clean: DataFrame, pool: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """A sample of pairs with both records' raw fields, to read."""
    raw = ("business_name", "business_address")
    a = clean.select(F.col("entity_id").alias("source1_entity_id"), "country", *(F.col(c).alias(f"s1_{c}") for c in raw))
    b = pool.select(F.col("entity_id").alias("cand_id"), *raw)
    few = seeded_sample(pairs.withColumn("__kl_pair", F.concat_ws("|", "source1_entity_id", "cand_id")), "__kl_pair", n, seed).drop("__kl_pair")
    return few.join(a, "source1_entity_id").join(b, "cand_id")


def examples_by(pairs: DataFrame, label: str, labels: tuple[str, ...], n: int, seed: int = SEED) -> DataFrame:
    """``n`` pairs of each of a few labels, those with the smallest hash of their ids; each task keeps its ``n`` best of a label."""
    keyed = pairs.withColumn("__kl_pair", F.concat_ws("|", "source1_entity_id", "cand_id"))
    parts = [seeded_sample(keyed.where(F.col(label) == name), "__kl_pair", n, seed) for name in labels]
    return functools.reduce(DataFrame.unionByName, parts).drop("__kl_pair")
