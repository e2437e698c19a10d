"""Tote features, move outcomes and scores."""

from __future__ import annotations

import math
from datetime import date, datetime

from slotflow.operators.outcomes import confusion_counts, confusion_matrix, evaluation_set, move_outcomes, rmse, tote_features

DAY, NEXT = date(2024, 4, 30), date(2024, 5, 1)


def test_tote_features(spark):
    stats = spark.createDataFrame(
        [(DAY, "A", "T1"), (DAY, "B", "T2"), (DAY, "C", "T3"), (DAY, "D", "T1")], "insert_date date, item_number string, licenceplate string"
    )
    transports = spark.createDataFrame([(NEXT, "T1", 2), (DAY, "T2", 1)], "insert_date date, licenceplate string, transport_orders long")
    sales = spark.createDataFrame(
        [("A", "SHOP", 0.3, 2.5), ("B", "SHOP", 0.12345, 2.5), ("C", "WEB", 0.9, 9.0)],
        "prod_id string, order_type string, likelihood double, exp_demand double",
    )
    confirmed = spark.createDataFrame([("A", 7)], "prod_id string, demand long")
    rows = tote_features(stats, transports, sales, confirmed).collect()
    found = {r.item_number: (r.likelihood, r.confirmed, r.exp_demand, r.move) for r in rows}
    assert found == {"A": (1.0, 1, 7, 1), "B": (0.1235, 0, 3, 0), "C": (0.0, 0, 0, 0), "D": (0.0, 0, 0, 1)}


def test_evaluation_leaves_out_one_group_and_incomplete_rows(spark):
    df = spark.createDataFrame([("a", "G1"), ("b", "KAB"), ("c", None), (None, "G1")], "k string, item_group_name string")
    assert [r.k for r in evaluation_set(df).collect()] == ["a"]


def test_move_outcomes_of_yesterday(spark):
    moves = spark.createDataFrame(
        [("T1", datetime(2024, 4, 30, 17, 15)), ("T2", datetime(2024, 4, 30, 0, 0)), ("T3", datetime(2024, 4, 29, 23, 59))],
        "licenceplate string, timestamp timestamp_ntz",
    )
    transports = spark.createDataFrame([(NEXT, "T1", 3), (DAY, "T2", 1)], "insert_date date, licenceplate string, transport_orders long")
    found = {r.licenceplate: r.transport_orders for r in move_outcomes(moves, transports, NEXT).collect()}
    assert found == {"T1": 3, "T2": None}


def test_confusion(spark):
    pairs = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 11
    df = spark.createDataFrame(pairs, "p long, o long")
    assert {(r.prediction, r.observed): r.n for r in confusion_counts(df, "p", "o").collect()} == {
        (1, 1): 6,
        (1, 0): 2,
        (0, 1): 1,
        (0, 0): 11,
    }
    row = confusion_matrix(df, "p", "o", 1).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (6, 2, 1, 11)
    assert math.isclose(row.accuracy, 17 / 20)
    assert math.isclose(row.sensitivity, 6 / 7) and math.isclose(row.specificity, 11 / 13)
    assert math.isclose(row.pos_pred_value, 6 / 8) and math.isclose(row.neg_pred_value, 11 / 12)
    chance = (8 * 7 + 12 * 13) / 400
    assert math.isclose(row.kappa, (17 / 20 - chance) / (1 - chance))
    assert math.isclose(row.balanced_accuracy, (6 / 7 + 11 / 13) / 2)
    assert math.isclose(row.prevalence, 7 / 20) and math.isclose(row.detection_rate, 6 / 20)


def test_a_rate_without_base_is_missing(spark):
    row = confusion_matrix(spark.createDataFrame([(0, 0), (1, 0)], "p long, o long"), "p", "o", 1).first()
    assert row.sensitivity is None and row.specificity == 0.5


def test_rmse_does_not_round(spark):
    df = spark.createDataFrame([(1.4, 1.0), (2.0, 2.3)], "p double, a double")
    assert math.isclose(rmse(df, "p", "a").first().rmse, math.sqrt((0.16 + 0.09) / 2))
