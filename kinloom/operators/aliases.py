"""Spellings of name words learned from known matches, and the patching of views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinloom.functions.text import rebuilt_from_core

G = "source1_entity_id"


def learn_aliases(clean: DataFrame, pool: DataFrame, truth_pairs: DataFrame, min_count: int = 3, min_share: float = 0.5, max_clean_freq: int = 5) -> DataFrame:
    """``src, dst, n, total``: words of Indic-script names and what stands in their place in the clean name, where that is dominant and the
    word itself is rare among clean names. Words are aligned by position in names of as many words."""
    left = clean.select(F.col("entity_id").alias(G), F.col("name_core_tokens").alias("t1"))
    right = pool.where("name_has_indic").select(F.col("entity_id").alias("matched_id"), F.col("name_core_tokens").alias("t2"))
    pairs = truth_pairs.join(right, "matched_id").join(left, G).where((F.size("t1") == F.size("t2")) & (F.size("t1") > 0))
    aligned = pairs.select(F.explode(F.arrays_zip("t2", "t1")).alias("z")).select(F.col("z.t2").alias("src"), F.col("z.t1").alias("dst")).where("src <> dst")
    counts = aligned.groupBy("src", "dst").agg(F.count("*").alias("n"))
    by_src = Window.partitionBy("src")
    best = counts.withColumn("total", F.sum("n").over(by_src)).withColumn("r", F.row_number().over(by_src.orderBy(F.desc("n"), "dst"))).where("r = 1").drop("r")
    frequent = clean.select(F.explode("name_core_tokens").alias("src")).groupBy("src").agg(F.count("*").alias("f")).where(F.col("f") >= max_clean_freq)
    return best.where((F.col("n") >= min_count) & (F.col("n") / F.col("total") >= min_share)).join(frequent, "src", "left_anti")


def apply_aliases(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rewrite name words and the three views that follow from them; other views keep their values.

    The alias table is small but grows with the data, so the words are joined with it and the planner chooses how.
    """
    words = df.select("entity_id", F.posexplode("name_core_tokens").alias("pos", "src")).join(aliases.select("src", "dst"), "src", "left")
    lists = words.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("dst", "src").alias("w")))).alias("ws"))
    new = lists.select("entity_id", F.array_distinct(F.transform("ws", lambda x: x["w"])).alias("__kl_new"))
    joined = df.join(new, "entity_id", "left").withColumn("name_core_tokens", F.coalesce("__kl_new", "name_core_tokens")).drop("__kl_new")
    return rebuilt_from_core(joined).select(*df.columns)


def save_aliases(aliases: DataFrame, path: str) -> None:
    """One JSON object per line, sorted by word; written by the executors, as the table grows with the data."""
    aliases.select("src", "dst").orderBy("src").write.mode("overwrite").json(path)


def load_aliases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("src string, dst string").json(path)


def patch(old: DataFrame, new: DataFrame, key: str = "entity_id") -> DataFrame:
    """The rows of ``new``, and those of ``old`` whose key it lacks."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def affected_clean(cands: DataFrame, changed_clean: DataFrame, changed_pool: DataFrame) -> DataFrame:
    """Clean records to score again: changed themselves or with a changed candidate."""
    by_pool = cands.join(changed_pool.select(F.col("entity_id").alias("cand_id")), "cand_id", "left_semi").select(G)
    return by_pool.union(changed_clean.select(F.col("entity_id").alias(G))).distinct()
