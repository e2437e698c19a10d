"""Calibrated probabilities of tote selection."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotflow.models import classifier


def chance(likelihood):
    return 1 / (1 + np.exp(-12 * (likelihood - 0.5)))


def totes(spark, n, seed, share=1.0):
    """Rows whose chance to move is known; of those that do not move only ``share`` is kept."""
    random = np.random.default_rng(seed)
    likelihood = random.random(n)
    move = (random.random(n) < chance(likelihood)).astype(int)
    rows = pd.DataFrame(
        {
            "insert_date": "2024-05-01", "licenceplate": [f"p{seed}-{i}" for i in range(n)], "item_number": "i", "locno": "l",
            "location": random.choice(["a", "b"], n), "z_pos": "1", "classification": "c", "directorate": "d", "hanging_garment": "Y",
            "sor_indicator": "S", "confirmed": "0", "item_group_name": "g", "quantity": random.integers(1, 9, n), "cumunits": 1.0,
            "itemrank": 1, "likelihood": likelihood, "exp_demand": random.random(n), "move": move,
        }
    )
    rows = rows[(rows["move"] == 1) | (random.random(n) < share)]
    return spark.createDataFrame(rows)


@pytest.fixture(scope="module")
def held(spark):
    return totes(spark, 3000, 2).cache()


@pytest.mark.parametrize("share", [1.0, 0.3])
def test_chances_are_calibrated(spark, held, tmp_path, share):
    rows = totes(spark, 3000, 1, share)
    model = classifier.tote_classifier(rows, trees=20, tries=("2",))
    model = classifier.calibrated(model, rows, trees=20, population=None if share == 1.0 else totes(spark, 3000, 1))
    classifier.save_model(model, str(tmp_path / "m"))
    scored = classifier.chances(classifier.load_model(str(tmp_path / "m")), held).cache()
    assert scored.columns == [*held.columns, "chance"] and scored.count() == held.count()
    low, high = scored.agg(F.min("chance"), F.max("chance")).first()
    assert 0 <= low < 0.1 and 0.7 < high <= 1
    table = classifier.calibration(scored).toPandas()
    assert table["rows"].sum() == held.count()
    error = (table["rows"] * (table["expected"] - table["observed"]).abs()).sum() / table["rows"].sum()
    assert error < 0.05
    assert ((table["low"] <= table["observed"]) & (table["observed"] <= table["high"])).all()
    # near the known chance, not just right on average
    off = scored.agg(F.avg(F.abs(F.col("chance") - 1 / (1 + F.exp(-12 * (F.col("likelihood") - 0.5)))))).first()[0]
    assert off < 0.12


def test_votes_alone_are_not_calibrated_for_a_sample_by_class(spark, held):
    rows = totes(spark, 3000, 1, 0.3)
    model = classifier.calibrated(classifier.tote_classifier(rows, trees=20, tries=("2",)), rows, trees=20)
    table = classifier.calibration(classifier.chances(model, held)).toPandas()
    error = (table["rows"] * (table["expected"] - table["observed"]).abs()).sum() / table["rows"].sum()
    assert error > 0.1


def test_a_larger_vote_is_no_smaller_chance(spark, held):
    rows = totes(spark, 2000, 3)
    model = classifier.calibrated(classifier.tote_classifier(rows, trees=10, tries=("2",)), rows, trees=10)
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(classifier.model_frame(held)).select(vector_to_array("probability")[1].alias("vote"), "chance").orderBy("vote").toPandas()
    assert scored["chance"].diff().dropna().min() >= -1e-12
