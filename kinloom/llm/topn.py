"""The N best items of every group by simultaneous bisection of per-group cutoffs.

No group is ever sorted or gathered in one task. All groups refine their cutoff together: each round counts, per group,
the rows of the still open interval that lie above a set of midpoints, keeps the part that holds the N-th item and goes on.
The code that is bisected is the score first, then the identifier, six bytes at a time.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.operators.skew import heavy_counts
from kinloom.session import materialize

#: Bisection steps done in one pass over the data: 2**STEPS - 1 midpoints are counted at once.
STEPS = 5
BYTES = 6


def _id_code(item: Column, level: Column) -> Column:
    """Order-preserving number of the ``level``-th six bytes of the identifier (UTF-8), negated: smaller ids win."""
    part = F.hex(F.substring(item.cast("string").cast("binary"), level * F.lit(BYTES) + F.lit(1), F.lit(BYTES)))
    # 48 bits of text and 4 of its length fit a double exactly; the length puts a short identifier before its extensions
    return -(F.conv(F.rpad(part, 2 * BYTES, "0"), 16, 10).cast("double") * 16 + F.length(part))


def top_n_by_bisection(df: DataFrame, group: str, item: str, score: str, n: int) -> DataFrame:
    """The ``n`` items with the highest score of each group, equal scores by the smaller item.

    Result: ``group, item, score`` (as double), at most ``n`` rows per group, all rows of a group with fewer.

    * Rows with null group, null item, null or NaN score do not count. A group with no counting row is absent.
    * An item repeated in a group counts once with its highest score.
    * Ties are resolved by the bytes of the item's text, smaller first: the same result every time.
    * Infinite scores are ordinary extremes. Other columns are ignored, an empty table gives an empty result.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    score_col = F.col(score).cast("double")
    rows = (
        df.select(F.col(group).alias("g"), F.col(item).alias("i"), score_col.alias("s"))
        .where("g is not null and i is not null and s is not null and not isnan(s)")
        .groupBy("g", "i")
        .agg(F.max("s").alias("s"))
    )
    # infinities keep their order but leave room for finite midpoints
    rows = rows.withColumn("c", F.when(F.col("s") == float("inf"), 1.7e308).when(F.col("s") == float("-inf"), -1.7e308).otherwise(F.col("s")))
    rows = materialize(rows, "topn-rows")
    # a group of more than a quarter of a task's even share of the rows is cut into pieces of at most that size; its bounds are copied to each
    # piece. There are fewer such groups than four times the tasks
    share = 1 / (4 * max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    hot, total = heavy_counts(rows, "g", share)
    heavy = df.sparkSession.createDataFrame([(g, math.ceil(n / (share * total))) for g, n in hot], rows.select("g", F.lit(1).alias("pieces")).schema)
    heavy = F.broadcast(heavy)
    rows = rows.join(heavy, "g", "left").withColumn("piece", F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("i"), F.col("pieces"))).otherwise(0).cast("int")).drop("pieces")

    def on_pieces(bounds: DataFrame) -> DataFrame:
        return bounds.join(heavy, "g", "left").withColumn("piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))).drop("pieces")

    first = rows.groupBy("g").agg(F.count("*").alias("cnt"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    small = first.where(F.col("cnt") <= n).select("g")
    bounds = materialize(first.where(F.col("cnt") > n).select("g", F.lit(n).cast("long").alias("need"), "cnt", "lo", "hi", F.lit(0).alias("level")), "topn-bounds")
    taken = [rows.join(small, "g", "left_semi").select("g", "i", "s")]
    live = rows.select("g", "piece", "i", "s", "c")
    level = 0
    while not bounds.isEmpty():
        bounds, chosen, ties = _refine(live, bounds, on_pieces)
        taken.append(_above(live, chosen, on_pieces))
        if ties.isEmpty():
            break
        code = _id_code(F.col("i"), F.lit(level))
        live = materialize(
            live.join(on_pieces(ties), ["g", "piece"]).where(F.col("c") == F.col("cut")).select("g", "piece", "i", "s", code.alias("c"), "need"), "topn-ties"
        )
        level += 1
        bounds = materialize(
            live.groupBy("g").agg(F.max("need").alias("need"), F.count("*").alias("cnt"), F.min("c").alias("lo"), F.max("c").alias("hi")), "topn-bounds"
        )
        live = live.drop("need")
    return functools.reduce(DataFrame.unionByName, taken).select(F.col("g").alias(group), F.col("i").alias(item), F.col("s").alias(score))


def _above(live: DataFrame, chosen: DataFrame, on_pieces) -> DataFrame:
    """Rows at or above (``incl``) or strictly above the group's cutoff."""
    keep = (F.col("c") > F.col("cut")) | (F.col("incl") & (F.col("c") == F.col("cut")))
    return live.join(on_pieces(chosen), ["g", "piece"]).where(keep).select("g", "i", "s")


def _refine(live: DataFrame, bounds: DataFrame, on_pieces) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Narrow every group's interval until it holds exactly the needed rows or a single code.

    Returns (nothing left open), the cutoffs ``g, cut, incl`` by which rows are taken, and the ties ``g, cut, need``:
    groups whose cutoff code is shared by more rows than are still needed.
    """
    parts = 2**STEPS
    chosen: list[DataFrame] = []
    ties: list[DataFrame] = []
    while not bounds.isEmpty():
        width = (F.col("hi") / parts - F.col("lo") / parts)
        slot = F.least(F.lit(parts - 1), F.floor((F.col("c") - F.col("lo")) / F.when(width > 0, width))).cast("int")
        counted = (
            live.join(on_pieces(bounds), ["g", "piece"])
            .where((F.col("c") >= F.col("lo")) & (F.col("c") <= F.col("hi")))
            .withColumn("slot", F.coalesce(slot, F.lit(0)))
            .groupBy("g", "slot")
            .agg(F.count("*").alias("n"), F.min("c").alias("a"), F.max("c").alias("b"), F.max("need").alias("need"))
        )
        # at most 2**STEPS rows of counts per group
        parts_of = counted.groupBy("g").agg(F.max("need").alias("need"), F.sort_array(F.collect_list(F.struct("slot", "n", "a", "b")), False).alias("p"))
        total = F.aggregate(
            "p",
            F.struct(F.lit(0).cast("long").alias("above"), F.lit(None).cast("struct<slot:int,n:bigint,a:double,b:double>").alias("at")),
            lambda acc, x: F.when(acc["at"].isNotNull(), acc)
            .when(acc["above"] + x["n"] >= F.col("need"), F.struct(acc["above"].alias("above"), x.alias("at")))
            .otherwise(F.struct((acc["above"] + x["n"]).alias("above"), acc["at"].alias("at"))),
        )
        state = materialize(
            parts_of.withColumn("f", total).select(
                "g", (F.col("need") - F.col("f.above")).alias("need"), F.col("f.at.n").alias("cnt"), F.col("f.at.a").alias("lo"), F.col("f.at.b").alias("hi")
            ),
            "topn-state",
        )
        exact = state.where("need = cnt").select("g", F.col("lo").alias("cut"), F.lit(True).alias("incl"))
        single = state.where("need < cnt and lo = hi")
        chosen += [exact, single.select("g", F.col("lo").alias("cut"), F.lit(False).alias("incl"))]
        ties.append(single.select("g", F.col("lo").alias("cut"), "need"))
        bounds = state.where("need < cnt and lo < hi")
        # only rows of open intervals are looked at again: a small part of the rows of those groups
        if not bounds.isEmpty():
            inside = live.join(on_pieces(bounds.select("g", "lo", "hi")), ["g", "piece"]).where((F.col("c") >= F.col("lo")) & (F.col("c") <= F.col("hi")))
            live = materialize(inside.select(*live.columns), "topn-live")
    union = functools.partial(functools.reduce, DataFrame.unionByName)
    return bounds, union(chosen), union(ties)
