"""Demand the plan has to cover."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotflow.functions.checks import unique
from slotflow.functions.columns import half_even


def forecast_demand(predictions: DataFrame) -> DataFrame:
    """[prod_id, forecast]: whole units, half to even, positive ones only."""
    rounded = predictions.select("prod_id", half_even(F.col("prediction")).cast("long").alias("forecast"))
    return rounded.filter(F.col("forecast") > 0)


def expected_demand(confirmed: DataFrame, forecast: DataFrame, stock: DataFrame) -> DataFrame:
    """[prod_id, exp_demand], one row per product.

    Confirmed sales of stocked products count as they are; the others come from positive
    forecasts. A product given twice stops the job.
    """
    stocked = stock.select(F.col("item_number").alias("prod_id")).distinct()
    sure = confirmed.join(stocked, "prod_id", "left_semi").select(
        "prod_id", F.col("demand").alias("exp_demand")
    )
    likely = (
        forecast.filter(F.col("forecast") > 0)
        .join(sure, "prod_id", "left_anti")
        .select("prod_id", F.col("forecast").alias("exp_demand"))
    )
    return unique(sure.unionByName(likely), "prod_id")
