"""What the text operators share: tables in the shared folder, filters of fixed size, sums of arrays."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slotflow.session import configure, new_table_path

#: Rows handed to a Python worker at once: texts are long, so fewer than Spark's default.
ROWS_A_BATCH = 500


def prepare(spark: SparkSession) -> SparkSession:
    """The session settings of the library, and small batches for Python workers."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_A_BATCH))
    return spark


def store(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there: lineage ends, lost executors lose nothing."""
    spark = df.sparkSession
    path = new_table_path(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_filter(keys: DataFrame, key: str, bits: int = 21) -> Column | None:
    """A test on column ``_hash`` that is true for every value of ``keys[key]`` and for few others.

    ``key`` holds 64-bit hashes. The filter is a bitmap of 2**bits bits, so its size does not depend on
    the data; with more keys it lets more rows through and stays right. None if there are no keys.
    """
    place = F.col(key).bitwiseAND(2**bits - 1)
    words = (
        keys.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("bits"))
        .collect()
    )
    if not words:
        return None
    table = [0] * 2 ** (bits - 6)
    for row in words:
        table[row["word"]] = row["bits"]
    # from text: the optimizer folds it into one literal, where a list would be one expression an element
    bitmap = F.from_json(F.lit(json.dumps(table)), "array<bigint>")
    word = F.element_at(bitmap, (F.shiftright(F.col("_hash").bitwiseAND(2**bits - 1), 6) + 1).cast("int"))
    return F.getbit(word, F.col("_hash").bitwiseAND(63).cast("int")) == 1


def summed(rows: DataFrame, group: str, value: str, groups: int = 16) -> DataFrame:
    """Arrays of doubles in ``value`` added up in two steps: within ``groups`` residues of ``group``, so no task gets all."""
    import numpy as np
    import pandas as pd

    def add(batches):
        total = None
        for batch in batches:
            for array in batch[value]:
                total = array.copy() if total is None else total + array
        if total is not None:
            yield pd.DataFrame({value: [np.asarray(total)]})

    return rows.repartition(groups, F.col(group)).mapInPandas(add, f"{value} array<double>")


def row_hash(key: str, text: str) -> Column:
    """Of key and text, for filters; null text counts as empty."""
    return F.xxhash64(F.col(key), F.coalesce(F.col(text), F.lit("")))


def text_digest(text: Column) -> Column:
    """SHA-256 of the text as it is; null counts as empty. With the key it names a row, and all rows that repeat it."""
    return F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))


def without(docs: DataFrame, gone: DataFrame, key: str, text: str, again: DataFrame | None = None, keyless: bool = True) -> DataFrame:
    """``docs`` without the rows named in ``gone``, and with one row of each named in ``again``.

    Both tables name rows by ``key``, ``own`` (``text_digest``) and ``hash`` (``row_hash``); null keys are equal. With ``keyless``
    false, rows with a null key all stay. Rows that a filter of fixed size lets through are joined, the others stay where
    they are: what is not suspect is not shuffled. The columns of ``docs`` travel as one struct, so no name clashes.
    """
    left = docs.select(F.struct("*").alias("_row"), row_hash(key, text).alias("_hash"))
    row_key, own = F.col("_row").getField(key), text_digest(F.col("_row").getField(text))
    known = F.lit(True) if keyless else row_key.isNotNull()
    gone = store(gone.select(F.col("key").alias("_key"), F.col("own").alias("_own"), "hash").distinct())
    suspect = key_filter(gone, "hash")
    if suspect is not None:
        marked = left.withColumn("_suspect", F.coalesce(suspect, F.lit(False)) & known)
        held = marked.where("_suspect").withColumn("_digest", own)
        checked = held.join(gone, row_key.eqNullSafe(F.col("_key")) & (F.col("_digest") == F.col("_own")), "left_anti")
        left = marked.where("not _suspect").select("_row", "_hash").unionByName(checked.select("_row", "_hash"))
    repeated = None if again is None else key_filter(again, "hash")
    if repeated is not None:
        # what the filter lets through by mistake is not repeated
        marked = left.withColumn("_again", F.coalesce(repeated, F.lit(False)) & known)
        once = marked.where("_again").withColumn("_key", row_key).withColumn("_digest", own).dropDuplicates(["_key", "_digest"])
        left = marked.where("not _again").select("_row").unionByName(once.select("_row"))
    return left.select("_row.*")
