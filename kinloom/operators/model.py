"""Gradient-boosted classification of pairs: training, prediction, importance, grouped cross-validation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinloom.config import SEED

G = "source1_entity_id"


@dataclass(frozen=True)
class Boosting:
    rounds: int = 60
    depth: int = 6
    step: float = 0.1
    rows_per_round: float = 0.8
    feature_share: str = "0.8"
    seed: int = SEED


def label_pairs(pairs: DataFrame, truth_pairs: DataFrame) -> DataFrame:
    """Add ``y``: 1 for a true pair, else 0."""
    true = truth_pairs.select(G, F.col("matched_id").alias("cand_id")).distinct().withColumn("y", F.lit(1))
    return pairs.join(true, [G, "cand_id"], "left").withColumn("y", F.coalesce("y", F.lit(0)))


def hash_order(id_col: str, seed: int = SEED) -> Column:
    """A seeded order that is the same in every run, whatever the partitioning."""
    return F.xxhash64(F.lit(seed), F.col(id_col))


def split_entities(ids: DataFrame, n_train: int, n_valid: int, id_col: str = G, seed: int = SEED) -> DataFrame:
    """``id_col, part`` (train, valid): the ids of the first part of a seeded hash range, and of the next; at most 80 % for training.

    The parts hold the wanted numbers up to chance; each id alone decides where it belongs, so no order over all ids is needed.
    """
    ids = ids.select(id_col).distinct()
    n = ids.count()
    n_train = min(n_train, int(n * 0.8))
    n_valid = min(n_valid, n - n_train)
    h = F.pmod(hash_order(id_col, seed), F.lit(2**40)) / F.lit(float(2**40))
    low, high = n_train / max(n, 1), (n_train + n_valid) / max(n, 1)
    return ids.withColumn("part", F.when(h < low, "train").when(h < high, "valid")).where("part is not null")


def train_classifier(data: DataFrame, features: tuple[str, ...], label: str = "y", valid: str | None = None, params: Boosting = Boosting()) -> PipelineModel:
    """Boosted trees over the features. ``valid``: a boolean column of rows on which the gain of further rounds is judged (early stopping)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=params.rounds, maxDepth=params.depth, stepSize=params.step, subsamplingRate=params.rows_per_round, featureSubsetStrategy=params.feature_share, seed=params.seed)
    if valid:
        gbt = gbt.setValidationIndicatorCol(valid)
    model = gbt.fit(assembler.transform(data.withColumn(label, F.col(label).cast("double"))))
    return PipelineModel([assembler, model])


def predict(model: PipelineModel, data: DataFrame, out: str = "p") -> DataFrame:
    scored = model.transform(data).withColumn(out, vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def importance(model: PipelineModel, features: tuple[str, ...]) -> dict[str, float]:
    values = model.stages[-1].featureImportances.toArray()
    return dict(sorted(zip(features, map(float, values)), key=lambda kv: (-kv[1], kv[0])))


def fold(id_col: str, k: int, seed: int = 5) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(k)).cast("int")


def cross_validated(data: DataFrame, features: tuple[str, ...], k: int = 3, label: str = "y", group: str = G, params: Boosting = Boosting()) -> DataFrame:
    """Out-of-fold probabilities ``p``; all rows of one group are in one fold, and no model sees the rows it scores.

    A fold whose complement has no rows to learn from gets a null ``p`` (as where all rows belong to one group).
    """
    data = data.withColumn("fold", fold(group, k))
    out = None
    for i in range(k):
        rest, own = data.where(F.col("fold") != i), data.where(F.col("fold") == i)
        if rest.select(label).distinct().limit(2).count() < 2:
            part = own.withColumn("p", F.lit(None).cast("double"))
        else:
            part = predict(train_classifier(rest, features, label, params=params), own)
        out = part if out is None else out.unionByName(part)
    return out


def numeric_features(df: DataFrame, leave_out: tuple[str, ...] = ()) -> tuple[str, ...]:
    """Columns of a numeric type, but for those named."""
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return tuple(c for c, kind in df.dtypes if (kind in kinds or kind.startswith("decimal")) and c not in leave_out)


def adversary(valid: DataFrame, test: DataFrame, features: tuple[str, ...] | None = None, k: int = 3, group: str = G, params: Boosting = Boosting()) -> tuple[DataFrame, PipelineModel]:
    """How well validation and test pairs can be told apart: (their out-of-fold probabilities to be of the test, the model on all of them).

    An AUC of a half means no shift. ``features``: by default all numeric columns that both tables have. The label is ``is_test``.
    """
    if features is None:
        features = tuple(c for c in numeric_features(valid, ("y", "p")) if c in numeric_features(test))
    # the same record may be on both sides; a group is a record of one side
    both = valid.select(group, *features).withColumn("is_test", F.lit(0)).unionByName(test.select(group, *features).withColumn("is_test", F.lit(1)))
    both = both.withColumn("side_group", F.concat_ws("|", "is_test", group))
    return cross_validated(both, features, k, "is_test", "side_group", params).select(group, "is_test", "p"), train_classifier(both, features, "is_test", params=params)


def auc(scored: DataFrame, label: str = "y", p: str = "p") -> float:
    return BinaryClassificationEvaluator(rawPredictionCol=p, labelCol=label).evaluate(scored.withColumn(label, F.col(label).cast("double")))


def auc_by_ranks(scored: DataFrame, label: str = "y", p: str = "p") -> DataFrame:
    """One row ``n_pos, n_neg, auc`` from rank sums; equal scores share their mean rank.

    Rows are first counted per distinct score, so the ordered window holds distinct scores, rounded to six places: at most a million.
    """
    per = scored.groupBy(F.round(F.col(p), 6).alias("v")).agg(F.sum(F.col(label).cast("double")).alias("pos"), F.count("*").cast("double").alias("n"))
    below = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    sums = per.withColumn("rank", below + (F.col("n") + 1) / 2).agg(F.sum(F.col("rank") * F.col("pos")).alias("r"), F.sum("pos").alias("n_pos"), F.sum(F.col("n") - F.col("pos")).alias("n_neg"))
    return sums.select("n_pos", "n_neg", F.round((F.col("r") - F.col("n_pos") * (F.col("n_pos") + 1) / 2) / F.greatest(F.col("n_pos") * F.col("n_neg"), F.lit(1.0)), 9).alias("auc"))
