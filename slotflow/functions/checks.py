"""Checks that run inside the plan and stop the job."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` with one row per ``key``; a repeated key stops the job."""
    others = [c for c in df.columns if c != key]
    copies = F.count(F.lit(1)).alias("_copies")
    counted = df.groupBy(key).agg(copies, *[F.first(c).alias(c) for c in others])
    message = F.concat(F.lit(f"{key} occurs more than once: "), F.col(key).cast("string"))
    checked = F.when(F.col("_copies") > 1, F.raise_error(message).cast(df.schema[key].dataType))
    return counted.select(checked.otherwise(F.col(key)).alias(key), *others).select(*df.columns)
