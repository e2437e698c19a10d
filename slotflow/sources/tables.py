"""Reading tables, merging the two order systems, picking a day's messages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.functions.columns import within

ORDER_TELEGRAM = "ORH"  # fixed value


def load(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A Parquet table of ``folder``, lazily. A given ``schema`` spares the look into the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def load_jdbc(
    spark: SparkSession, url: str, query: str, key: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """A table or parenthesized query of a database, read by ``parts`` tasks along a numeric ``key``.

    Credentials belong in ``options``, from the caller's secret store. Rows outside
    ``lower`` to ``upper`` are read as well, by the first and last task.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=query, **options)
    bounds = {"partitionColumn": key, "lowerBound": lower, "upperBound": upper, "numPartitions": parts}
    return reader.options(**bounds).load()


def merge_live_archive(
    headers_live: DataFrame,
    headers_archive: DataFrame,
    lines_live: DataFrame,
    lines_archive: DataFrame,
    dedupe_headers: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Headers and lines of both systems.

    A header in both stays twice, unless ``dedupe_headers``; a line in both is kept once,
    compared on all its columns.
    """
    headers = headers_live.unionByName(headers_archive)
    lines = lines_live.unionByName(lines_archive).distinct()
    return (headers.distinct() if dedupe_headers else headers), lines


def order_messages(events: DataFrame, as_of: date) -> DataFrame:
    """[raw_message] of order telegrams received the day before ``as_of``."""
    return (
        events.filter(F.col("telegram_type") == ORDER_TELEGRAM)
        .filter(within(F.col("creation_time"), as_of, 1, 1))
        .select("raw_message")
    )
