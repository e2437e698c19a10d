"""The table of pending moves: insert, delete, and the products behind each tote.

The ledger is stored as a log: each batch of insertions and each deletion is a folder of its own, written as a whole.
Running a batch again replaces it; nothing stored before is written anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

LEDGER = ["licenceplate", "target_state_name"]


def ledger_insert(ledger: DataFrame, moves: DataFrame) -> DataFrame:
    """The ledger with the instructions of ``moves`` added."""
    return ledger.select(*LEDGER).unionByName(moves.select(*LEDGER))


def ledger_delete(ledger: DataFrame, target_state: str | None = None) -> DataFrame:
    """The ledger without the instructions of one target state, or without any."""
    if target_state is None:
        return ledger.filter(F.lit(False))
    return ledger.filter(~F.col("target_state_name").eqNullSafe(target_state))


def commit_insert(moves: DataFrame, path: str, batch: int) -> None:
    """Store the instructions of ``moves`` as batch ``batch`` of the ledger at ``path``."""
    moves.select(*LEDGER).write.mode("overwrite").parquet(f"{path}/inserts/batch={batch}")


def commit_delete(spark: SparkSession, path: str, batch: int, target_state: str | None = None) -> None:
    """Store that batches before ``batch`` lose the instructions of one target state, or all."""
    row = spark.createDataFrame([(target_state, target_state is None)], "target_state_name string, everything boolean")
    row.write.mode("overwrite").parquet(f"{path}/deletes/batch={batch}")


def create_ledger(spark: SparkSession, path: str) -> None:
    """An empty ledger at ``path``."""
    commit_insert(spark.createDataFrame([], "licenceplate string, target_state_name string"), path, 0)
    none = spark.createDataFrame([], "target_state_name string, everything boolean")
    none.write.mode("overwrite").parquet(f"{path}/deletes/batch=0")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The instructions that no later deletion names. Deletions count from the last one of each target state."""
    inserts = spark.read.schema("licenceplate string, target_state_name string, batch long").parquet(f"{path}/inserts")
    deletes = spark.read.schema("target_state_name string, everything boolean, batch long").parquet(f"{path}/deletes")
    emptied = F.coalesce(deletes.filter("everything").agg(F.max("batch")).scalar(), F.lit(-1))
    last = deletes.filter("not everything").groupBy(F.col("target_state_name").alias("_state")).agg(F.max("batch").alias("_last"))
    left = inserts.filter(F.col("batch") > emptied).join(last, F.col("target_state_name").eqNullSafe(F.col("_state")), "left")
    return left.filter(F.col("batch") > F.coalesce("_last", F.lit(-1))).select(*LEDGER)


def tote_product_lookup(moves: DataFrame, stock: DataFrame) -> DataFrame:
    """[licenceplate, prod_ids], one row per instruction; the products are sorted.

    A tote is a box: its products are a short list, and repeats are dropped before the shuffle.
    """
    moved = stock.join(moves.select("licenceplate").distinct(), "licenceplate", "left_semi")
    listed = moved.groupBy("licenceplate").agg(F.sort_array(F.collect_set("item_number")).alias("prod_ids"))
    return moves.select("licenceplate").join(listed, "licenceplate", "left")
