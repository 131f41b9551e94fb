"""Fitted models on shared storage, one folder per version, and the registry that lists them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from patronlens.operators.engineered import Thresholds
from patronlens.operators.scoring import ChurnModel, LinearModel
from patronlens.shared import create_once, exists

REGISTRY_SCHEMA = """
    version bigint, path string, model_type string, feature_columns array<string>,
    total_spent_p80 double, total_transactions_p80 double, weights array<double>, intercept double
"""


@dataclass(frozen=True)
class ModelStore:
    """``publish`` saves the model first and registers it last, so a failed run leaves no half model behind."""

    spark: SparkSession
    root: str

    @property
    def _registry(self) -> str:
        return f"{self.root}/registry"

    def _entries(self):
        if not exists(self.spark, self._registry):
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        return self.spark.read.schema(REGISTRY_SCHEMA).parquet(self._registry)

    def _new_version(self) -> int:
        """A number above all published ones that no other run can take: creating its marker file succeeds once."""
        version = (self._entries().agg(F.max("version")).first()[0] or 0) + 1
        while not create_once(self.spark, f"{self.root}/versions/{version}"):
            version += 1
        return version

    def publish(self, model: ChurnModel) -> int:
        version = self._new_version()
        path = None
        if model.pipeline is not None:
            path = f"{self.root}/models/{version}-{uuid.uuid4().hex}"
            model.pipeline.write().save(path)
        linear = model.linear
        entry = (
            version,
            path,
            model.model_type,
            list(model.feature_columns),
            model.thresholds.total_spent,
            model.thresholds.total_transactions,
            list(linear.weights) if linear else None,
            linear.intercept if linear else None,
        )
        self.spark.createDataFrame([entry], REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(self._registry)
        return version

    def latest(self) -> ChurnModel | None:
        entry = self._entries().orderBy(F.desc("version")).limit(1).first()
        if entry is None:
            return None
        linear = None if entry["weights"] is None else LinearModel(tuple(entry["weights"]), entry["intercept"])
        return ChurnModel(
            model_type=entry["model_type"],
            thresholds=Thresholds(entry["total_spent_p80"], entry["total_transactions_p80"]),
            linear=linear,
            pipeline=None if entry["path"] is None else PipelineModel.load(entry["path"]),
            feature_columns=list(entry["feature_columns"]),
        )
