"""Running totals and row numbers over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotflow.session import materialize


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    value: str,
    total: str,
    rank: str,
    slices: int | None = None,
    copies: str | None = None,
) -> DataFrame:
    """Adds the running sum of ``value`` and the row number within ``group``, each group spread over many tasks.

    Rows with equal order keys share a sum; a NULL in the group is a group of its own. Copies of a row are
    counted first, unless ``copies`` names a column that does so already. The rest is range-partitioned on group and order into ``slices``, as many as shuffle
    partitions unless given, so a slice is a contiguous run of a group and equal keys never part. A slice's
    rows add up locally; what lies in the slices before it comes from one small row per group and slice.
    The placement is written to the shared folder: a lost task must not change slice numbers.
    """
    columns, keys = [c for c in df.columns if c != copies], [F.col(g) for g in group]
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = df.withColumnRenamed(copies, "_n") if copies else df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    # Stored first: the ranges are found on a sample, which would work out the rows once more. Sorted, copies of a group lie together
    # and take less room on disk and in the next shuffle.
    ranged = materialize(packed).repartitionByRange(slices, *keys, *order).sortWithinPartitions(*keys, *order)
    placed = materialize(ranged.withColumn("_slice", F.spark_partition_id()))

    # A struct equals another with the same nulls: a plain join on it keeps the placement of the windows, so rows are not shuffled again.
    placed = placed.select(F.struct(*keys).alias("_group"), "_slice", "_n", *[c for c in columns if c not in group])
    units = F.col(value) * F.col("_n")
    earlier = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_group", "_slice")
        .agg(F.sum(units).alias("_units"), F.sum("_n").alias("_rows"))
        .select(
            "_group",
            "_slice",
            F.sum("_units").over(earlier).alias("_units_before"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        )
    )

    inside = Window.partitionBy("_group", "_slice").orderBy(*order)
    local = placed.select(
        "*",
        F.sum(units).over(inside).alias("_units_here"),
        (F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_rows_here"),
    )
    here, before = F.col("_units_here"), F.col("_units_before")
    joined = local.join(offsets, ["_group", "_slice"]).select(
        *[F.col("_group")[c].alias(c) if c in group else F.col(c) for c in columns],
        F.coalesce(here + before, here, before).alias(total),
        (F.col("_rows_before") + F.col("_rows_here")).alias("_rows_ahead"),
        F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"),
    )
    return joined.select(*columns, total, (F.col("_rows_ahead") + F.col("_copy")).alias(rank))
