"""Per-key results when a few keys hold most rows.

Heavy keys are found with a mergeable frequent-items sketch, processed apart by a broadcast join with an evenly spread
pre-aggregation, the remaining keys go through an ordinary shuffle, and both parts are united.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def heavy_counts(df: DataFrame, key: str, share: float) -> tuple[list[tuple], int]:
    """The non-null values of ``key`` that hold at least ``share`` of all rows, with their exact counts, and the number of all rows.

    A frequent-items sketch with ``16 / share`` counters has an error below ``share / 4`` of the rows, so every true
    heavy key is among its ``1 / (0.75 * share)`` largest estimates. Those few candidates are counted exactly in a second,
    map-side combined pass, and only the true ones are kept: at most ``1 / share``, whatever the size of the input.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    keys = df.select(F.col(key).alias("k"))
    at_most = math.ceil(4 / (3 * share)) + 1
    top = keys.where("k is not null").agg(F.expr(f"approx_top_k(k, {at_most}, {max(64, at_most, math.ceil(16 / share))})").alias("top"))
    likely = [(r["k"],) for r in top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("k")).collect()]
    if not likely:
        return [], 0
    # keys that are not likely share one group, so at most len(likely) + 1 partial rows leave a task
    candidates = F.broadcast(df.sparkSession.createDataFrame(likely, keys.schema).withColumnRenamed("k", "c"))
    counted = keys.join(candidates, F.col("k") == F.col("c"), "left").groupBy("c").count().collect()
    total = sum(r["count"] for r in counted)
    return [(r["c"], r["count"]) for r in counted if r["c"] is not None and r["count"] >= share * total], total


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Exactly the non-null values of ``key`` that hold at least ``share`` of all rows: one column ``key``, at most ``1 / share`` rows.

    Rows with a null key count among the rows. An empty table gives no rows.
    """
    keys = df.select(key)
    return df.sparkSession.createDataFrame([(k,) for k, _ in heavy_counts(df, key, share)[0]], keys.schema)


def balanced_group_stats(df: DataFrame, key: str, id_col: str, time_col: str, share: float = 0.01) -> DataFrame:
    """Rows, distinct ids, first and last time per value of ``key``, with the work evenly spread.

    Result: ``key, n_rows, n_ids, first_at, last_at``; one row per distinct key.

    * Heavy keys (at least ``share`` of the rows) are matched by a broadcast join with a table of at most
      ``1 / share + 1`` rows and aggregated first by (key, id): a hot key is spread over as many tasks as its ids
      give, and only one partial row per task and key reaches the second step.
    * All other keys take the ordinary shuffle by key.
    * A null key is a group of its own and always takes the heavy path. Null ids do not count as an id, null
      times are ignored (all null: null). The empty string is a key like any other. Repeated rows count in ``n_rows``
      and once in ``n_ids``. An empty table gives an empty result. Other columns of ``df`` are not read.
    """
    rows = df.select(F.col(key).alias("k"), F.col(id_col).alias("i"), F.col(time_col).alias("t"))
    heavy = heavy_keys(rows, "k", share)
    heavy = heavy.union(rows.sparkSession.createDataFrame([(None,)], heavy.schema)).withColumnRenamed("k", "hk")
    hot = rows.join(F.broadcast(heavy), F.col("k").eqNullSafe(F.col("hk")), "left_semi")
    # the id may itself be hot or null: a null id is spread by a salt taken from the row
    salt = F.when(F.col("i").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(64)))
    by_id = hot.withColumn("s", salt).groupBy("k", "i", "s").agg(
        F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("b")
    )
    heavy_part = by_id.groupBy("k").agg(
        F.sum("n").alias("n_rows"), F.count("i").alias("n_ids"), F.min("a").alias("first_at"), F.max("b").alias("last_at")
    )
    light_part = (
        rows.join(F.broadcast(heavy), F.col("k").eqNullSafe(F.col("hk")), "left_anti")
        .groupBy("k")
        .agg(F.count("*").alias("n_rows"), F.countDistinct("i").alias("n_ids"), F.min("t").alias("first_at"), F.max("t").alias("last_at"))
    )
    return heavy_part.unionByName(light_part).withColumnRenamed("k", key)


def salted(key: Column, heavy_flag: Column, spread: Column, salts: int) -> Column:
    """A salt in ``0..salts-1`` taken from ``spread`` for rows of heavy keys, 0 for all others."""
    return F.when(heavy_flag, F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0)).cast("int")


def spread_rank(df: DataFrame, group: list[str], score: str, tie: str, out: str, pieces: int = 64) -> DataFrame:
    """Add ``out``: the rank (from 1) within ``group`` by ``score``, highest first and nulls last, then by ``tie``.

    A hot group isn't ordered in one task: scores are cut at quantiles of the whole column, each piece of a group is ordered by itself, and the sizes of
    the pieces before it, at most ``pieces`` rows per group, are added. Where the cuts lie does not change the result. Only rows
    of one group with one score must be ordered together.
    """
    cuts = df.agg(F.percentile_approx(F.col(score).cast("double"), [k / pieces for k in range(1, pieces)], 1000).alias("q")).first()["q"] or []
    above = sum(((F.lit(float(c)) > F.col(score)).cast("int") for c in sorted(set(cuts))), F.lit(0))
    df = df.withColumn("__kl_piece", F.when(F.col(score).isNull(), len(cuts) + 1).otherwise(above))
    sizes = df.groupBy(*group, "__kl_piece").agg(F.count("*").alias("__kl_n"))
    before = F.sum("__kl_n").over(Window.partitionBy(*group).orderBy("__kl_piece").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*(F.col(c).alias(f"__kl_{c}") for c in group), F.col("__kl_piece").alias("__kl_p"), F.coalesce(before, F.lit(0)).alias("__kl_before"))
    same = [df[c].eqNullSafe(sizes[f"__kl_{c}"]) for c in group] + [df["__kl_piece"] == sizes["__kl_p"]]
    placed = df.join(sizes, same)
    rank = F.row_number().over(Window.partitionBy(*group, "__kl_piece").orderBy(F.desc_nulls_last(score), tie))
    return placed.withColumn(out, (F.col("__kl_before") + rank).cast("int")).select(*df.drop("__kl_piece").columns, out)
