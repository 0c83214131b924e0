"""From pair probabilities to matches, and the score of matches against the truth.

Scored pairs have ``source1_entity_id, cand_id, p``. Every ranking has a total order: ties go to the smaller ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

G = "source1_entity_id"
TAUS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8)
MIN_PS = (0.1, 0.2, 0.3, 0.4, 0.5)
ALPHAS = (0.8, 1.0, 1.25, 1.5)


@dataclass(frozen=True)
class Rule:
    """``threshold`` with tau, or ``expected_f`` with min_p and alpha."""

    rule: str = "threshold"
    tau: float = 0.7
    min_p: float = 0.3
    alpha: float = 1.0


def apply_exclusivity(scored: DataFrame) -> DataFrame:
    """Each candidate only for the clean record with its highest probability. A maximum per key, so it combines before the shuffle."""
    best = scored.groupBy("cand_id").agg(F.max("p").alias("top"))
    owner = scored.join(best, "cand_id").where(F.col("p") == F.col("top")).groupBy("cand_id").agg(F.min(G).alias(G))
    return scored.join(owner, ["cand_id", G], "left_semi")


def choose_by_threshold(scored: DataFrame, tau: float, exclusive: bool = True) -> DataFrame:
    return (apply_exclusivity(scored) if exclusive else scored).where(F.col("p") >= tau).select(G, "cand_id")


def with_expected_f(scored: DataFrame, alpha: float | None = None) -> DataFrame:
    """Add ``k`` (rank by p), ``ek`` (expected F0.5 of the k best) and ``e0`` (probability that none is true). Without ``alpha`` a column of that name counts."""
    group = Window.partitionBy(G) if alpha is not None else Window.partitionBy(G, "alpha")
    order = group.orderBy(F.desc("p"), "cand_id")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = F.lit(alpha) if alpha is not None else F.col("alpha")
    return (
        scored.withColumn("k", F.row_number().over(order))
        .withColumn("cs", F.sum("p").over(running))
        .withColumn("total", F.sum("p").over(group))
        .withColumn("e0", F.exp(F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-9)))).over(group)))
        .withColumn("ek", 1.25 * F.col("cs") / (0.25 * a * F.col("total") + F.col("k")))
        .drop("cs", "total")
    )


def choose_matches(scored: DataFrame, min_p: float = 0.3, alpha: float = 1.0, exclusive: bool = True) -> DataFrame:
    """The number of best candidates with the highest expected F0.5, if that beats predicting nothing."""
    d = with_expected_f(apply_exclusivity(scored) if exclusive else scored, alpha)
    allowed = F.when(F.col("p") >= min_p, F.struct(F.round("ek", 9).alias("ek"), (-F.col("k")).alias("nk")))
    best = F.max(allowed).over(Window.partitionBy(G))
    return d.withColumn("best", best).where((F.col("best.ek") > F.col("e0")) & (F.col("k") <= -F.col("best.nk"))).select(G, "cand_id")


def decide(scored: DataFrame, rule: Rule) -> DataFrame:
    return choose_by_threshold(scored, rule.tau) if rule.rule == "threshold" else choose_matches(scored, rule.min_p, rule.alpha)


def to_lists(selected: DataFrame, all_ids: DataFrame) -> DataFrame:
    """One row for every clean record with its sorted, possibly empty, list of chosen ids."""
    lists = selected.groupBy(G).agg(F.array_sort(F.collect_set("cand_id")).alias("ids"))
    return all_ids.select(G).distinct().join(lists, G, "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))


def f05_per_entity(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """``pred``: (G, ids); ``truth``: (G, matched). Adds precision, recall, f05 and is_singleton."""
    d = truth.select(G, "matched").join(pred.select(G, "ids"), G, "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    tp = F.size(F.array_intersect("ids", "matched")).cast("double")
    n_pred, n_true = F.size("ids").cast("double"), F.size("matched").cast("double")
    precision, recall = tp / F.greatest(n_pred, F.lit(1.0)), tp / F.greatest(n_true, F.lit(1.0))
    f = F.when((n_true == 0) & (n_pred == 0), 1.0).when((n_true == 0) | (n_pred == 0) | (tp == 0), 0.0).otherwise(1.25 * precision * recall / (0.25 * precision + recall))
    return d.withColumns({"precision": precision, "recall": recall, "f05": f, "is_singleton": n_true == 0})


def f05_macro(pred: DataFrame, truth: DataFrame) -> float:
    return f05_per_entity(pred, truth).agg(F.avg("f05")).first()[0]


def macro_by(chosen: DataFrame, truth: DataFrame, settings: DataFrame, key: str) -> DataFrame:
    """``key, f05``: macro F0.5 of the pairs that each of a few ``settings`` chooses (``key, source1_entity_id, cand_id``). One job for all."""
    hits = chosen.join(truth.select(G, F.explode("matched").alias("cand_id")).withColumn("ok", F.lit(1)), [G, "cand_id"], "left")
    hits = hits.groupBy(key, G).agg(F.count("*").alias("n_pred"), F.count("ok").alias("tp"))
    per = truth.select(G, F.size("matched").alias("n_true")).crossJoin(F.broadcast(settings)).join(hits, [key, G], "left")
    n_pred, tp = F.coalesce("n_pred", F.lit(0)).cast("double"), F.coalesce("tp", F.lit(0)).cast("double")
    pr, rc = tp / F.greatest(n_pred, F.lit(1.0)), tp / F.greatest("n_true", F.lit(1))
    f = F.when((F.col("n_true") == 0) & (n_pred == 0), 1.0).when((F.col("n_true") == 0) | (n_pred == 0) | (tp == 0), 0.0).otherwise(1.25 * pr * rc / (0.25 * pr + rc))
    return per.withColumn("f", f).groupBy(key).agg(F.avg("f").alias("f05"))


def tune_decision(scored: DataFrame, truth: DataFrame) -> DataFrame:
    """Macro F0.5 of every rule of the grid, best first: ``rank, rule, tau, min_p, alpha, f05``. One job for the whole grid.

    The candidates are crossed with the 26 rows of the grid (a fixed number); ties go to the earlier row.
    """
    spark = scored.sparkSession
    exclusive = apply_exclusivity(scored)
    grid = [(i, "threshold", t, None, None) for i, t in enumerate(TAUS)]
    grid += [(len(grid) + i, "expected_f", None, m, a) for i, (m, a) in enumerate((m, a) for m in MIN_PS for a in ALPHAS)]
    grid_df = F.broadcast(spark.createDataFrame(grid, "g int, rule string, tau double, min_p double, alpha double"))
    simple = exclusive.crossJoin(grid_df.where("rule = 'threshold'")).where("p >= tau").select("g", G, "cand_id")
    d = with_expected_f(exclusive.crossJoin(F.broadcast(spark.createDataFrame([(a,) for a in ALPHAS], "alpha double"))))
    d = d.join(grid_df.where("rule = 'expected_f'").select("g", "alpha", "min_p"), "alpha")
    allowed = F.when(F.col("p") >= F.col("min_p"), F.struct(F.round("ek", 9).alias("ek"), (-F.col("k")).alias("nk")))
    d = d.withColumn("best", F.max(allowed).over(Window.partitionBy("g", G)))
    expected = d.where((F.col("best.ek") > F.col("e0")) & (F.col("k") <= -F.col("best.nk"))).select("g", G, "cand_id")
    chosen = simple.unionByName(expected)
    result = macro_by(chosen, truth, grid_df.select("g"), "g").withColumn("f05", F.round("f05", 9)).join(grid_df, "g")
    return result.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("f05"), "g"))).select("rank", "rule", "tau", "min_p", "alpha", "f05")
