"""Samples and splits that come out the same on every run.

Rows are ordered by the md5 of seed and key. The first hex digits of the hash cut a stratum
into 4,096 buckets of even size, so few that each task's counts are small, so that the cut-off is
found from bucket counts and one bucket of rows; no task sees a whole stratum, and the rows
themselves are not shuffled while the strata are few. Where rows share a key at the cut itself, no quota can hold: that stops the job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotflow.functions.columns import hash_number, key_hash
from slotflow.session import materialize

DIGITS = 3


def hash_cutoffs(df: DataFrame, stratum: str, key: Sequence[str], seed: int | str, quota: Callable) -> DataFrame:
    """[stratum, cutoff]: the hash of the last row within ``quota(rows)`` of each stratum."""
    hashed = df.select(F.col(stratum).alias("_stratum"), key_hash(seed, key).alias("_hash"))
    hashed = hashed.withColumn("_bucket", hash_number(F.col("_hash"), DIGITS))
    counts = hashed.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    inside = Window.partitionBy("_stratum").orderBy("_bucket")
    # The sum up to a bucket that reaches the quota first marks the bucket of the last row.
    placed = counts.select(
        "_stratum",
        "_bucket",
        F.sum("_rows").over(inside).alias("_upto"),
        "_rows",
        F.sum("_rows").over(Window.partitionBy("_stratum")).alias("_all"),
    )
    taken = F.least(quota(F.col("_all")), F.col("_all"))
    last = placed.select("*", (taken - (F.col("_upto") - F.col("_rows"))).alias("_left")).filter(
        (F.col("_left") > 0) & (F.col("_left") <= F.col("_rows"))
    )
    close = hashed.alias("h").join(
        materialize(last).alias("l"),
        F.col("h._stratum").eqNullSafe(F.col("l._stratum")) & (F.col("h._bucket") == F.col("l._bucket")),
    )
    order = Window.partitionBy(F.col("h._stratum")).orderBy(F.col("h._hash"))
    ranked = close.select(
        F.col("h._stratum").alias(stratum),
        F.col("h._hash").alias("cutoff"),
        F.col("l._left").alias("_left"),
        F.row_number().over(order).alias("_row"),
        F.lead("h._hash").over(order).alias("_next"),
    )
    tied = F.raise_error(F.lit(f"rows share the key {', '.join(key)} at the cut-off of a sample")).cast("string")
    cutoff = F.when(F.col("cutoff") == F.col("_next"), tied).otherwise(F.col("cutoff")).alias("cutoff")
    return ranked.filter(F.col("_row") == F.col("_left")).select(stratum, cutoff)


def _with_cutoff(df: DataFrame, stratum: str, cutoffs: DataFrame) -> DataFrame:
    marked = materialize(cutoffs.select(F.col(stratum).alias("_stratum"), "cutoff"))
    return df.join(marked, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")


def balanced_sample(
    df: DataFrame, label: str, n: int, key: Sequence[str], seed: int = 101, subset: Sequence[str] | None = None
) -> DataFrame:
    """The first ``n`` rows of each class, then without the incomplete ones.

    ``df`` is read three times: pass a stored table or a materialized frame.
    """
    cutoffs = hash_cutoffs(df, label, key, seed, lambda rows: F.lit(n).cast("long"))
    chosen = _with_cutoff(df, label, cutoffs).filter(key_hash(seed, key) <= F.col("cutoff"))
    return drop_incomplete(chosen.select(*df.columns), subset)


def stratified_split(
    df: DataFrame, stratum: str, p: float, key: Sequence[str], seed: int = 102
) -> DataFrame:
    """``df`` with ``in_train``: true for the share ``p`` of each stratum, rounded up."""

    def share(rows: Column) -> Column:
        return F.ceil(F.lit(p) * rows)

    cutoffs = hash_cutoffs(df, stratum, key, seed, share)
    chosen = F.coalesce(key_hash(seed, key) <= F.col("cutoff"), F.lit(False))
    return _with_cutoff(df, stratum, cutoffs).select(*df.columns, chosen.alias("in_train"))


def hash_folds(df: DataFrame, key: Sequence[str], folds: int, seed: int | str, name: str = "fold") -> DataFrame:
    """``df`` with a fold number from 0 to ``folds - 1``."""
    number = hash_number(key_hash(seed, key), 8) % folds
    return df.withColumn(name, number.cast("int"))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with every value present; NaN counts as missing."""
    return df.dropna("any", subset=list(subset) if subset else None)
