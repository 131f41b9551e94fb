"""Churn scores for feature rows, in batch or on a stream."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.functions import has_nan, sql_double, zero_if_missing
from patronlens.operators.engineered import Thresholds, with_engineered_features


@dataclass(frozen=True)
class LinearModel:
    """A logistic model over the raw (unscaled) model inputs."""

    weights: tuple[float, ...]
    intercept: float

    def probability(self, inputs: list[Column]) -> Column:
        """``1 / (1 + exp(-(b + w.x)))`` as a plain expression, compiled into the scan's stage."""
        margin = F.lit(self.intercept)
        for weight, value in zip(self.weights, inputs, strict=True):
            margin = margin + F.lit(weight) * value
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))

    def sql_probability(self, names: list[str]) -> str:
        """The same expression as SQL text over double columns or arguments."""
        terms = [f"{sql_double(weight)} * {name}" for weight, name in zip(self.weights, names, strict=True)]
        return f"1D / (1D + exp(-({' + '.join([sql_double(self.intercept), *terms])})))"


@dataclass(frozen=True)
class ChurnModel:
    """What is needed to score: the fitted model, its type, its inputs in order and the thresholds."""

    model_type: str
    thresholds: Thresholds
    linear: LinearModel | None = None
    pipeline: PipelineModel | None = None
    feature_columns: list[str] = field(default_factory=lambda: list(C.MODEL_FEATURES))


def with_scores(inputs: DataFrame, model: ChurnModel) -> DataFrame:
    """Add ``churn_probability`` and ``churn_prediction`` to rows that carry the model inputs.

    Null inputs count as 0. A row with a NaN input cannot be scored: it gets 0.5, hence no predicted churn.
    The probability is computed once and the prediction compares it; nothing runs in Python.
    """
    names = model.feature_columns
    unscorable = has_nan(names)
    if model.linear is not None:
        probability = model.linear.probability([zero_if_missing(name) for name in names])
        scored = inputs.withColumn("churn_probability", F.when(unscorable, C.UNSCORABLE_PROBABILITY).otherwise(probability))
    else:
        clean = {f"_in_{name}": F.nanvl(zero_if_missing(name), F.lit(0.0)) for name in names}
        added = set(clean) | {"_features", "rawPrediction", "probability", "prediction", "_unscorable"}
        scored = model.pipeline.transform(inputs.withColumns(clean).withColumn("_unscorable", unscorable))
        probability = vector_to_array("probability")[1]
        scored = scored.withColumn(
            "churn_probability", F.when(F.col("_unscorable"), C.UNSCORABLE_PROBABILITY).otherwise(probability)
        ).drop(*added)
    return scored.withColumn("churn_prediction", F.col("churn_probability") > C.DECISION_THRESHOLD)


def score_features(features: DataFrame, model: ChurnModel, thresholds: Thresholds | None = None) -> DataFrame:
    """The feature rows as they are plus the two score columns. Works on batch and streaming frames alike.

    ``thresholds`` are those of the whole feature table as it is now, which batch jobs pass; without them the
    model's own, from when it was trained, are used, which is all that a stream has.
    """
    kept = features.columns
    scored = with_scores(with_engineered_features(features, thresholds or model.thresholds), model)
    return scored.select(*kept, "churn_probability", "churn_prediction")


def scoring_sample(predictions: DataFrame, rows: int = 10) -> DataFrame:
    """The first customers by id with their score next to the actual label."""
    return (
        predictions.select(
            "user_id",
            "age",
            "total_transactions",
            "total_spent",
            F.col("is_churned").alias("actual_churn"),
            "churn_probability",
            "churn_prediction",
        )
        .orderBy("user_id")
        .limit(rows)
    )


def prediction_summary(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if("churn_prediction").alias("predicted_churned"),
        F.count_if("is_churned").alias("actual_churned"),
        F.avg("churn_probability").alias("avg_churn_probability"),
    )
