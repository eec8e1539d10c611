"""Train, score, evaluate and gate a regression model with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split(df: DataFrame, keys: Sequence[str], train_percent: int = 80) -> DataFrame:
    """Adds ``is_train`` from a hash of the key: every run agrees, whatever the partitioning.

    MD5 rather than Spark's own hash, so that other tools can repeat the split.
    """
    digest = F.md5(F.concat_ws("-", *keys).cast("binary"))
    return df.withColumn("is_train", F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("long") % 100 < train_percent)


def train(df: DataFrame, features: Sequence[str], target: str, seed: int = 1,
          max_iter: int = 10, max_depth: int = 4) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    trees = GBTRegressor(featuresCol="_features", labelCol=target, predictionCol="prediction",
                         maxIter=max_iter, maxDepth=max_depth, seed=seed)
    return Pipeline(stages=[assembler, trees]).fit(df)


def score(model: PipelineModel, df: DataFrame, digits: int = 2) -> DataFrame:
    return model.transform(df).drop("_features").withColumn("prediction", F.round("prediction", digits))


def residuals(scored: DataFrame, target: str, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Rows, mean squared, mean absolute and root mean squared error, per split."""
    r = F.col(target) - F.col(prediction)
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(r * r).alias("mse"),
        F.avg(F.abs(r)).alias("mae"), F.sqrt(F.avg(r * r)).alias("rmse"))


def deploy(model: PipelineModel, metrics: DataFrame, path: str, metric: str = "rmse", limit: float = float("inf")) -> bool:
    """Save the model only if its metric (one row) is within the limit."""
    passed = metrics.where(F.col(metric) <= limit).limit(1).count() == 1
    if passed:
        model.write().overwrite().save(path)
    return passed


def feature_contract(df: DataFrame, required: Sequence[str], defaults: Mapping[str, float],
                     errors: str = "errors") -> DataFrame:
    """Numbers ready to score: defaults filled in, and a list of what is wrong with a row.

    A required feature that is missing, and any feature that is negative, is an error.
    """
    nothing = F.array().cast("array<string>")

    def note(test, text):
        return F.when(test, F.array(F.lit(text))).otherwise(nothing)

    filled = df.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})
    checks = [note(F.col(n).isNull(), f"missing:{n}") for n in required]
    checks += [note(F.coalesce(F.col(n) < 0, F.lit(False)), f"negative:{n}") for n in [*required, *defaults]]
    return filled.withColumn(errors, F.concat(nothing, *checks))
