"""Training classifiers with spark.ml: hit models, cross-validation that stops early, and models with their facts on disk."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.operators import evaluation

FEATURES = "_x"


def vectors(df: DataFrame, features: str = "features") -> DataFrame:
    return df.withColumn(FEATURES, array_to_vector(F.col(features)))


def train(df: DataFrame, features: str = "features", label: str = "label", positive_weight: float = 1.0, penalty: float = 0.01, steps: int = 100, lasso: float = 0.0) -> LogisticRegressionModel:
    """A logistic model of a 0/1 label; positive rows weigh ``positive_weight`` times as much. ``lasso``: the part of the penalty on absolute values."""
    rows = vectors(df, features).withColumn("_w", F.when(F.col(label) == 1, positive_weight).otherwise(1.0))
    return LogisticRegression(featuresCol=FEATURES, labelCol=label, weightCol="_w", regParam=penalty, elasticNetParam=lasso, maxIter=steps).fit(rows)


def scored(model: LogisticRegressionModel, df: DataFrame, features: str = "features", out: str = "p") -> DataFrame:
    """Add the probability of label 1, block by block as the rows come."""
    extra = [FEATURES, "rawPrediction", "probability", "prediction"]
    return model.transform(vectors(df, features)).withColumn(out, vector_to_array("probability")[1]).drop(*extra)


@dataclass(frozen=True)
class Fold:
    """The best step of a fold: its number among the penalties, the penalty, the AUC, and how many steps were tried."""

    fold: int
    step: int
    penalty: float
    auc: float
    tried: int


def cross_validated(df: DataFrame, fold: str, penalties: Sequence[float], patience: int, features: str = "features", label: str = "label", lasso: float = 0.0) -> list[tuple[Fold, LogisticRegressionModel]]:
    """For each fold the best model of the other folds' rows. Penalties are tried in order until ``patience`` of them in a row
    have not reached the best AUC so far; one that equals it counts as reaching it."""
    out = []
    for k in sorted(r[0] for r in df.select(fold).distinct().collect()):
        inside, outside = df.filter(F.col(fold) != k).drop(fold), df.filter(F.col(fold) == k).drop(fold)
        best, waited, tried = None, 0, 0
        for step, penalty in enumerate(penalties):
            model = train(inside, features, label, penalty=penalty, lasso=lasso)
            auc = evaluation.roc_auc(scored(model, outside, features), "p", label).first()["auc"]
            tried += 1
            if best is None or (auc or 0.0) >= best[0].auc:
                best, waited = (Fold(k, step, penalty, auc or 0.0, tried), model), 0
            else:
                waited += 1
                if waited >= patience:
                    break
        out.append((Fold(**(best[0].__dict__ | {"tried": tried})), best[1]))
    return out


def save(model: LogisticRegressionModel, path: str, facts: DataFrame) -> None:
    """A model and a table of facts about it, in one folder."""
    model.write().overwrite().save(f"{path}/model")
    facts.write.mode("overwrite").json(f"{path}/facts")


def load(spark: SparkSession, path: str) -> tuple[LogisticRegressionModel, DataFrame]:
    return LogisticRegressionModel.load(f"{path}/model"), spark.read.json(f"{path}/facts")


def focal_loss(p: Column, label: Column, gamma: float = 2.0, alpha: float = 0.25) -> Column:
    """The loss of a probability that counts well-classified rows less; a probability of 0 or 1 counts as 1e-7 from it."""
    p = F.greatest(F.lit(1e-7), F.least(F.lit(1 - 1e-7), p))
    right = F.when(label == 1, p).otherwise(1 - p)
    return -F.when(label == 1, alpha).otherwise(1 - alpha) * F.pow(1 - right, F.lit(gamma)) * F.log(right)
