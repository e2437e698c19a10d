"""Models side by side on rows they have not seen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from slotflow.functions.columns import half_even
from slotflow.models.design import KEY, LABEL


def side_by_side(predictions: dict[str, DataFrame], actuals: DataFrame) -> DataFrame:
    """[prod_id, sold_rep_units, one column per model]."""
    renamed = [df.select(KEY, F.col("prediction").alias(name)) for name, df in predictions.items()]
    return reduce(lambda left, right: left.join(right, KEY), renamed, actuals.select(KEY, LABEL))


def rounded_predictions(joined: DataFrame, models: list[str]) -> DataFrame:
    """The same with whole, positive predictions, for reading."""
    rounded = [half_even(F.abs(F.col(m))).cast("long").alias(m) for m in models]
    return joined.select(KEY, LABEL, *rounded)


def model_comparison(predictions: dict[str, DataFrame], actuals: DataFrame) -> DataFrame:
    """[model, rmse] of unrounded predictions, each over the rows it covers."""
    named = [
        df.select(KEY, "prediction", F.lit(name).alias("model")) for name, df in sorted(predictions.items())
    ]
    stacked = reduce(DataFrame.unionByName, named)
    error = F.col("prediction") - F.col(LABEL)
    return (
        stacked.join(actuals.select(KEY, LABEL), KEY)
        .groupBy("model")
        .agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    )
