"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a hash of everything.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotflow.llm.common import key_filter, row_hash, store, text_digest, without

#: The characters that do not count: space, and tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]"


def normalised(text: str):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, "")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = 64, digests: bool = False) -> DataFrame:
    """Groups of equal texts: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, a row per row of ``docs``.

    Texts are equal when identical without blanks; null counts as empty. Of equal texts the row with the most code
    points stays, then the smallest key; null keys come last. One row of each group is kept: of rows with the same key and number of
    code points, repeated ones among them, any one. Very long texts are hashed whole; an empty table gives no rows; other columns
    are not looked at.

    Lengths and hashes of beginnings are counted with map-side sums. What is not alone in both goes on: only its text
    is hashed as a whole, where the scan meets it, so no text is shuffled. The filter between the rounds has a fixed
    size; what it lets through by mistake turns out to be alone. ``text_sha256`` is null for the texts that are alone
    by length or beginning, unless ``digests`` asks for all.
    """
    members = hashed_rows(docs, key, text, prefix, digests)
    first = F.struct((-F.col("points")).alias("points"), F.col("id").isNull().alias("none"), "id", "row")
    groups = store(members.where("alive").groupBy("sha").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n")))
    stays = (F.col("row") == F.col("first.row")).alias("stays")
    shared = members.where("alive").join(groups, "sha").select("id", F.col("first.id").alias("keep"), "n", stays, "sha")
    alone = members.where("not alive").select("id", F.col("id").alias("keep"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("stays"), "sha")
    return shared.unionByName(alone).select(
        F.col("id").alias(key),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("stays").alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def hashed_rows(docs: DataFrame, key: str, text: str, prefix: int, digests: bool, names: bool = False) -> DataFrame:
    """Stored: ``row`` (a number), ``id``, ``points``, ``alive`` (not alone in length and beginning) and ``sha``, a row per row of ``docs``.

    With ``names`` also ``hash`` and ``own``, which name the row; ``own`` is null if the row is alone.
    """
    points = F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("points")
    plain = docs.select(F.col(key).alias("id"), normalised(text).alias("body"), points, F.col(text).alias("raw"))
    narrow = store(
        plain.select(F.char_length("body").alias("length"), F.xxhash64(F.char_length("body"), F.substring("body", 1, prefix)).alias("_hash"))
    )
    by_length = narrow.groupBy("length").count().where("count > 1").select(F.xxhash64("length").alias("key"))
    by_length = key_filter(by_length, "key")
    if by_length is None:
        survivors = None
    else:
        longer = narrow.select(F.xxhash64("length").alias("_hash"), F.col("_hash").alias("begin")).where(by_length)
        survivors = key_filter(longer.groupBy("begin").count().where("count > 1"), "begin")
    alive = F.lit(False) if survivors is None else survivors
    hashed = plain.withColumn("_hash", F.xxhash64(F.char_length("body"), F.substring("body", 1, prefix))).withColumn("alive", alive)
    whole = F.sha2(F.encode("body", "UTF-8"), 256)
    more = [row_hash("id", "raw").alias("hash"), F.when(F.col("alive"), text_digest(F.col("raw"))).alias("own")] if names else []
    number = F.monotonically_increasing_id().alias("row")
    return store(hashed.select(number, "id", "points", "alive", (whole if digests else F.when(F.col("alive"), whole)).alias("sha"), *more))


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", keyless: bool = False) -> DataFrame:
    """One row of each group of equal texts, all columns as they are.

    The row that stays has the most code points, then the smallest key, then the least digest; null keys come last. Rows are
    named by key and text, so other rows of the same key do not matter; of repeated rows one stays. Rows with a null key
    all stay, unless ``keyless`` asks to decide on them too.
    """
    alive = hashed_rows(docs, key, text, prefix=64, digests=False, names=True).where("alive")
    first = F.struct((-F.col("points")).alias("points"), F.col("id").isNull().alias("none"), "id", "own")
    groups = store(alive.groupBy("sha").agg(F.min(first).alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    kept = F.col("id").eqNullSafe(F.col("keep.id")) & (F.col("own") == F.col("keep.own"))
    found = store(alive.join(groups, "sha").select(F.col("id").alias("key"), "own", "hash", kept.alias("kept")))
    again = found.where("kept").groupBy("key", "own", "hash").count().where("count > 1")
    return without(docs, found.where("not kept"), key, text, again, keyless)
