"""What happened to the totes, and how well it was foreseen."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from slotflow.functions.columns import half_up, within
from slotflow.functions.special import binomial_tail, chi_square_tail, exact_interval

# Sales channel of the averages, item group left out of an evaluation.
SHOP = "SHOP"
EXCLUDED_GROUP = "KAB"


def tote_features(
    stats: DataFrame, transports: DataFrame, average_sales: DataFrame, confirmed: DataFrame
) -> DataFrame:
    """Stock statistics with likelihood, confirmed, exp_demand, and whether the tote moved next day."""
    moved = transports.select(F.date_sub("insert_date", 1).alias("insert_date"), "licenceplate", "transport_orders")
    shop = average_sales.filter(F.col("order_type") == SHOP).select(
        F.col("prod_id").alias("item_number"),
        F.col("likelihood").alias("_likelihood"),
        F.col("exp_demand").alias("_average"),
    )
    sure = confirmed.select(F.col("prod_id").alias("item_number"), F.lit(1).alias("_sure"), F.col("demand").alias("_demand"))
    known = F.col("_sure").isNotNull()
    # the joins by item first: rows that come placed by item are shuffled for the plate alone, with what the item's columns come to
    items = stats.join(shop, "item_number", "left").join(sure, "item_number", "left")
    valued = items.select(
        *[F.col(c) for c in stats.columns],
        F.when(known, F.lit(1.0)).otherwise(F.coalesce(half_up(F.col("_likelihood"), 4), F.lit(0.0))).alias("likelihood"),
        F.when(known, 1).otherwise(0).cast("long").alias("confirmed"),
        F.coalesce(F.col("_demand"), half_up(F.col("_average")).cast("long"), F.lit(0)).alias("exp_demand"),
    )
    return valued.join(moved, ["insert_date", "licenceplate"], "left").select(
        *valued.columns, F.when(F.col("transport_orders").isNotNull(), 1).otherwise(0).cast("long").alias("move")
    )


def evaluation_set(features: DataFrame) -> DataFrame:
    """Complete rows outside the excluded item group."""
    return features.dropna("any").filter(F.col("item_group_name") != EXCLUDED_GROUP)


def move_outcomes(moves: DataFrame, transports: DataFrame, as_of: date) -> DataFrame:
    """Moves made the day before ``as_of``, with the transports of the day after the move."""
    yesterday = moves.filter(within(F.col("timestamp"), as_of, 1, 1)).select(
        "*", F.date_add(F.to_date("timestamp"), 1).alias("insert_date")
    )
    driven = transports.select("insert_date", "licenceplate", "transport_orders")
    return yesterday.join(driven, ["insert_date", "licenceplate"], "left").select(*moves.columns, "transport_orders")


def confusion_counts(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """[prediction, observed, n]."""
    return df.groupBy(F.col(prediction).alias("prediction"), F.col(label).alias("observed")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, prediction: str, label: str, positive) -> DataFrame:
    """One row: the four counts, the rates that follow from them, and how sure they are.

    ``accuracy_low`` and ``accuracy_high`` are the exact 95% interval of the accuracy, ``no_information_rate`` the share of the more
    frequent class, ``accuracy_p`` the chance that guessing it would do as well (one-sided binomial test), ``mcnemar_p`` that both
    kinds of error are as frequent (McNemar's test, corrected for continuity). A rate whose base is empty is NULL.
    """
    said, was = F.col(prediction) == F.lit(positive), F.col(label) == F.lit(positive)
    cells = {"tp": said & was, "fp": said & ~was, "fn": ~said & was, "tn": ~said & ~was}
    counts = df.agg(*[F.count(F.when(test, 1)).alias(name) for name, test in cells.items()])
    tp, fp, fn, tn = (F.col(c).cast("double") for c in cells)
    n = tp + fp + fn + tn

    def rate(part, whole):
        return F.when(whole != 0, part / whole)

    accuracy = rate(tp + tn, n)
    chance = rate((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    sensitivity, specificity = rate(tp, tp + fn), rate(tn, tn + fp)
    statistics = {
        "accuracy": accuracy,
        "kappa": rate(accuracy - chance, 1 - chance),
        "sensitivity": sensitivity,
        "specificity": specificity,
        "pos_pred_value": rate(tp, tp + fp),
        "neg_pred_value": rate(tn, tn + fn),
        "prevalence": rate(tp + fn, n),
        "detection_rate": rate(tp, n),
        "detection_prevalence": rate(tp + fp, n),
        "balanced_accuracy": (sensitivity + specificity) / 2,
    }
    right, most = tp + tn, F.greatest(tp + fn, tn + fp)
    low, high = exact_interval(right, n)
    uneven = F.when(fp == fn, 0.0).otherwise((F.abs(fp - fn) - 1) ** 2 / (fp + fn))
    tests = {
        "accuracy_low": low,
        "accuracy_high": high,
        "no_information_rate": rate(most, n),
        "accuracy_p": binomial_tail(right, n, most / n),
        "mcnemar_p": F.when(fp + fn > 0, chi_square_tail(uneven)),
    }
    statistics |= {name: F.when(n > 0, value) for name, value in tests.items()}
    return counts.select(*cells, *[value.alias(name) for name, value in statistics.items()])


def rmse(df: DataFrame, prediction: str, actual: str) -> DataFrame:
    """[rmse] of predictions as they are, not rounded."""
    return df.agg(F.sqrt(F.avg((F.col(prediction) - F.col(actual)) ** 2)).alias("rmse"))
