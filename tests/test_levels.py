"""Effects of very many levels against a dense ridge regression and the closed form of one factor."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotflow.models.levels import fit_levels, predict_levels


def dense(rows, numbers, factors, penalty):
    """Predictions by solving the whole normal equations."""
    texts = [rows[f].map(lambda v: "\0" if v is None else v) for f in factors]
    dummies = [(t == level).to_numpy(float) for t in texts for level in sorted(set(t))]
    x = np.column_stack([np.ones(len(rows)), *[rows[n] for n in numbers], *dummies])
    fine = np.diag([0.0] * (1 + len(numbers)) + [penalty] * len(dummies))
    return x @ np.linalg.solve(x.T @ x + fine, x.T @ rows["y"].to_numpy())


@pytest.mark.parametrize("penalty", [0.7, 5.0])
def test_equals_a_dense_ridge_regression(spark, penalty):
    random = np.random.default_rng(4)
    n = 400
    rows = pd.DataFrame(
        {
            "a": random.choice(["p", "q", "r", None, *map(str, range(20))], n), "b": random.choice(["x", "y", None], n, p=[0.6, 0.3, 0.1]),
            "u": random.normal(size=n), "_row": random.normal(3, 2, n),
        }
    )
    rows["y"] = 2 * rows["u"] - rows["_row"] + rows["a"].map(lambda v: len(v or "") * 3.0) + (rows["b"] == "x") + random.normal(size=n)
    df = spark.createDataFrame(rows, "a string, b string, u double, _row double, y double")
    fit = fit_levels(df, "y", ["u", "_row"], ["a", "b"], penalty, most_sweeps=40, tolerance=1e-7)
    assert fit.sweeps < 40
    found = predict_levels(fit, df)
    assert found.columns == [*df.columns, "prediction"]
    found = found.toPandas().sort_values("u")["prediction"].to_numpy()
    assert np.allclose(found, dense(rows, ["u", "_row"], ["a", "b"], penalty)[np.argsort(rows["u"].to_numpy())], atol=1e-4)


def test_a_hundred_thousand_levels_one_of_them_hot(spark):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100_000)
    df = spark.range(450_000).select(key.cast("string").alias("f"), (F.col("id") % 7 + key % 5).alias("y"))
    fit = fit_levels(df, "y", [], ["f"], penalty=2.0)
    found = fit.effects[0].toPandas().sort_values("level")
    rows = df.groupBy("f").agg(F.count("*").alias("n"), F.avg("y").alias("mean")).toPandas().sort_values("f")
    weight = rows["n"] * 2 / (rows["n"] + 2)
    mean = (weight * rows["mean"]).sum() / weight.sum()
    assert fit.sweeps == 1 and len(found) == len(rows) == 100_000 and abs(fit.slopes[0] - mean) < 1e-9
    assert found["level"].tolist() == rows["f"].tolist() and found["rows"].tolist() == rows["n"].tolist()
    assert np.allclose(found["effect"], rows["n"] * (rows["mean"] - mean) / (rows["n"] + 2))


def test_new_levels_missing_values_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 3.0), (None, 2.0, 5.0), ("a", 3.0, 8.0)], "f string, x double, y double")
    fit = fit_levels(df, "y", [], ["f"])
    unseen = predict_levels(fit, spark.createDataFrame([("zz",), (None,)], "f string")).collect()
    effect = {r.level: r.effect for r in fit.effects[0].collect()}
    assert {r.f: round(r.prediction, 9) for r in unseen} == {"zz": round(fit.slopes[0], 9), None: round(fit.slopes[0] + effect[None], 9)}
    with pytest.raises(Exception, match="missing value in x"):
        fit_levels(spark.createDataFrame([("a", None, 1.0)], "f string, x double, y double"), "y", ["x"], ["f"])
    with pytest.raises(ValueError, match="no rows"):
        fit_levels(df.limit(0), "y", [], ["f"])
