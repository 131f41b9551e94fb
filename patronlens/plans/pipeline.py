"""The daily job: load, features, weekly training, scoring functions, stored scores, summary."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from patronlens.operators.engineered import Thresholds, threshold_table, thresholds_of
from patronlens.operators.features import user_features, with_churn_label
from patronlens.operators.incremental import user_features_of
from patronlens.operators.scoring import prediction_summary, score_features
from patronlens.plans.training import TrainingResult, TrainingSettings, train_churn_model
from patronlens.sources.feature_state import FeatureState
from patronlens.sources.model_store import ModelStore
from patronlens.sources.sql_functions import create_prediction_view, deploy_functions
from patronlens.sources.warehouse import Warehouse

MONDAY = 0


@dataclass(frozen=True)
class DailyRun:
    retrained: bool
    model_version: int | None
    features: DataFrame
    thresholds: Thresholds  # of the stored features
    predictions: DataFrame
    summary: DataFrame
    training: TrainingResult | None
    view: str  # the feature table as it is, scored by the model deployed last when it is read


def build_features(warehouse: Warehouse, as_of: dt.date | None = None) -> DataFrame:
    """Replace ``features.user_features`` from the raw tables, and ``features.thresholds`` with its percentiles.
    Returns the stored table: every later figure describes what was stored.

    Transactions that are appended to are read once: their customers' stored past is brought up to date and gives the features.
    A date before that of the stored past needs the whole table, as does one that is replaced by each load."""
    users = warehouse.table("raw_data", "raw_users")
    rows = warehouse.appended("raw_transactions")
    state = FeatureState(warehouse.spark, f"{warehouse.folder('features')}/_customer_state")
    if rows is not None and as_of is not None and (state.manifest().as_of or as_of) <= as_of:
        state.load(rows)
        state.fold(as_of)
        plain = user_features_of(users, state.read(), as_of)
    else:
        plain = user_features(users, warehouse.table("raw_data", "raw_transactions"), as_of)
    stored = warehouse.save(with_churn_label(plain), "features", "user_features")
    warehouse.save(threshold_table(stored), "features", "thresholds")
    return stored


def run_daily(
    warehouse: Warehouse,
    models: ModelStore,
    as_of: dt.date,
    landed: dict[str, str | list[str]] | None = None,
    retrain: bool | None = None,
    settings: TrainingSettings | None = None,
    append: bool = False,
) -> DailyRun:
    """One run for ``as_of``. ``landed`` maps raw tables to CSV paths to load first: each replaces its table, or with
    ``append`` adds the files of its folder that no run has loaded yet.

    Scores use the thresholds of today's features. Retrains on Mondays, when there is no model yet, or as ``retrain`` says. Any failing step raises; tables
    of earlier steps stay as written.
    """
    warehouse.create()
    for table, path in (landed or {}).items():
        if append:
            warehouse.append_csv(table, path)
        else:
            warehouse.load_csv(table, path)
    features = build_features(warehouse, as_of)

    model = models.latest()
    if retrain is None:
        retrain = as_of.weekday() == MONDAY or model is None
    version = training = None
    if retrain:
        training = train_churn_model(features, settings)
        if training.model is None:
            raise RuntimeError("no candidate model ranks churned customers above others")
        version = models.publish(training.model)
        model = training.model
    elif model is None:
        raise RuntimeError("there is no published model and training was switched off")

    schema, view = f"{warehouse.prefix}ml_models", warehouse.name("ml_models", "current_churn_predictions")
    tables = warehouse.name("features", "user_features"), warehouse.name("features", "thresholds")
    deploy_functions(warehouse.spark, schema, model)
    create_prediction_view(warehouse.spark, view, *tables, schema)
    thresholds = thresholds_of(warehouse.table("features", "thresholds"))
    scored = score_features(features, model, thresholds)
    predictions = warehouse.save(scored, "ml_models", "customer_churn_predictions")
    return DailyRun(
        retrain,
        version,
        features,
        thresholds,
        predictions,
        prediction_summary(predictions),
        training,
        view,
    )
