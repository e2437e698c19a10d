"""Daily outputs. Writing the same day twice leaves the same state."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed schema of the move table.
MOVE_TYPES = {
    "licenceplate": "string",
    "target_state_name": "string",
    "source_zone_name": "string",
    "timestamp": "timestamp_ntz",
    "status": "long",
}


def refresh_features(features: DataFrame, path: str) -> None:
    """Replaces the days that ``features`` holds; other days in ``path`` stay."""
    (
        features.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("insert_date")
        .parquet(path)
    )


def refresh_days(sums: DataFrame, path: str, day: str) -> None:
    """Replaces the days that ``sums`` holds, one folder each; other days in ``path`` stay, also those that ``sums`` has no row of."""
    sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def refresh_training(training: DataFrame, table: str, path: str | None = None) -> None:
    """Replaces the training table; ``path`` makes it an external one."""
    writer = training.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_moves(moves: DataFrame, path: str) -> None:
    """Replaces the move table, in its declared types."""
    moves.selectExpr(*[f"cast({c} as {t}) as {c}" for c, t in MOVE_TYPES.items()]).write.mode("overwrite").parquet(path)
