"""Fitted regressors as data: stored, read back, and asked for forecasts."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from slotflow.models.design import Design, Scale, encoded

#: The module that forecasts with each kind of model.
MODULES = {"knn": "knn", "pls": "linear", "svm": "radial", "earth": "splines"}


@dataclass(frozen=True)
class Regressor:
    """A fit: the model matrix's levels, the scale, and the kind's own numbers; of neighbours also the training rows."""

    kind: str
    design: Design
    scale: Scale
    values: dict = field(default_factory=dict)
    rows: DataFrame | None = None

    def predict(self, features: DataFrame) -> DataFrame:
        """[prod_id, prediction] of every row of ``features``."""
        asked = encoded(features, self.design, self.scale)
        return import_module(f"slotflow.models.{MODULES[self.kind]}").predicted(self, asked)


def save_regressor(spark: SparkSession, model: Regressor, path: str) -> None:
    """Stores a fit, replacing what ``path`` holds: a row of numbers as text, and training rows as a table."""
    design, scale = model.design, model.scale
    text = {
        "kind": model.kind,
        "numbers": design.numbers,
        "dummies": design.dummies,
        "means": scale.means,
        "spreads": scale.spreads,
        "values": model.values,
    }
    spark.createDataFrame([(json.dumps(text),)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    if model.rows is not None:
        model.rows.select("id", "label", "x").write.mode("overwrite").parquet(f"{path}/rows")


def load_regressor(spark: SparkSession, path: str) -> Regressor:
    """A stored fit. Numbers come back as they were, so forecasts are the same."""
    found = json.loads(spark.read.parquet(f"{path}/model").first().model)
    design = Design(tuple(found["numbers"]), tuple(tuple(d) for d in found["dummies"]))
    scale = Scale(tuple(found["means"]), tuple(found["spreads"]))
    rows = spark.read.parquet(f"{path}/rows") if found["kind"] == "knn" else None
    return Regressor(found["kind"], design, scale, found["values"], rows)
