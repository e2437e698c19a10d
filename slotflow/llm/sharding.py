"""Shards along a Hilbert curve through the metadata, so that a filter on any of its dimensions skips files.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from slotflow.functions.checks import unique
from slotflow.llm.common import store


def hilbert_index(point: Column, dimensions: int, bits: int) -> Column:
    """The place of a point on the Hilbert curve; ``point`` is an array of integers below 2**bits.

    From the highest bit down, each dimension whose bit is set reflects the first one's lower bits, else swaps them
    with its own. A running xor then undoes the Gray code, and the bits are interleaved.
    """
    high_bits = [1 << b for b in range(bits - 1, -1, -1)]

    def turn(x: Column, q: Column, i: Column) -> Column:
        first, own = F.element_at(x, 1), F.element_at(x, i + 1)
        is_set = own.bitwiseAND(q) != 0
        change = F.when(is_set, q - 1).otherwise(first.bitwiseXOR(own).bitwiseAND(q - 1))
        touched = lambda j: (j == 0) | (~is_set & (j == i))
        # with i = 0 and the bit not set, change is zero
        return F.transform(x, lambda v, j: F.when(touched(j), v.bitwiseXOR(change)).otherwise(v))

    axes = F.sequence(F.lit(0), F.lit(dimensions - 1))
    lower = F.lit(high_bits[:-1] or [1])
    x = F.aggregate(lower, point, lambda x, q: F.aggregate(axes, x, lambda y, i: turn(y, q, i)))
    grown = lambda done, v: F.concat(done, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)))))
    gray = F.aggregate(x, F.array().cast("array<int>"), grown)

    def interleave(x: Column) -> Column:
        last = F.element_at(x, -1)
        flip = F.aggregate(lower, F.lit(0), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        turned = F.transform(x, lambda v: v.bitwiseXOR(flip))
        step = lambda total, q: F.aggregate(turned, total, lambda t, v: t * 2 + F.when(v.bitwiseAND(q) != 0, 1).otherwise(0).cast("long"))
        return F.aggregate(F.lit(high_bits), F.lit(0).cast("long"), step)

    # the array is bound to a name by a lambda, so that it is worked out once a row
    return F.element_at(F.transform(F.array(gray), interleave), 1)


def level_cuts(docs: DataFrame, column: str, bits: int) -> list[tuple[object, int]]:
    """Where a column's levels begin: (least value, level), at most 2**bits of them, over all rows.

    A value's level is its rank, half by the rows and half by the distinct values before it: frequent values spread over the levels,
    and of up to 2**(bits-1) distinct values each has its own. Null is level 0 and not listed.

    Values are counted first, so a hot value is one row; the counts are added up range by range.
    """
    values = docs.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    spread = values.repartitionByRange("value").sortWithinPartitions("value")
    numbered = store(spread.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    # a row per range: as many as the shuffle had partitions
    found = numbered.groupBy(part.alias("part")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values")).orderBy("part").collect()
    if not found:
        return []
    rows, distinct = sum(r["n"] for r in found), sum(r["values"] for r in found)
    parts, rows_before, values_before, n, v = [], [], [], 0, 0
    for r in found:
        parts, rows_before, values_before = parts + [r["part"]], rows_before + [n], values_before + [v]
        n, v = n + r["n"], v + r["values"]
    place = F.array_position(F.lit(parts).cast("array<bigint>"), F.col("part")).cast("int")
    before = F.element_at(F.lit(rows_before).cast("array<bigint>"), place), F.element_at(F.lit(values_before).cast("array<bigint>"), place)
    running = F.sum("n").over(Window.partitionBy("part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    counted = numbered.withColumn("part", part).withColumn("own", F.coalesce(running, F.lit(0)))
    first_row, first_value = before[0] + F.col("own"), before[1] + F.col("_at").bitwiseAND(2**33 - 1)
    share = (first_row / rows + first_value / distinct) / 2
    levels = counted.select("value", F.floor(share * 2**bits).cast("int").alias("level"))
    return [(r["value"], r["level"]) for r in levels.groupBy("level").agg(F.min("value").alias("value")).orderBy("level").collect()]


def quantised(docs: DataFrame, column: str, bits: int) -> Column:
    """A metadata column as an integer below 2**bits, its level by ``level_cuts``; null is 0."""
    cuts = level_cuts(docs, column, bits)
    if not cuts:
        return F.lit(0)
    kind = docs.schema[column].dataType
    begins = F.array(*[F.lit(value).cast(kind) for value, _ in cuts])
    place = F.size(F.filter(begins, lambda begin: begin <= F.col(column)))
    return F.when(F.col(column).isNull(), 0).otherwise(F.element_at(F.lit([level for _, level in cuts]), place)).cast("int")


def hilbert_shards(
    docs: DataFrame, by: list[str], key: str = "doc_id", text: str = "text", shards: int = 16, bits: int = 6
) -> DataFrame:
    """Every row on one of ``shards`` shards whose counts differ by at most one, as runs of the curve.

    Returns ``key``, ``size`` (UTF-8 bytes of the text plus one), ``text_crc32``, ``curve``, ``shard`` and ``slot`` (the place
    within the shard, from 0). Ties on the curve go by checksum, then key, so equal texts with equal metadata are
    neighbours. A null or empty text has size 1 and checksum 0, a text of any length is read whole; null metadata is the lowest
    value. Repeated rows each take a slot; an empty table gives no rows. Of ``docs`` only the named columns are read.

    Metadata are quantised by rank, see ``level_cuts``. One shuffle of narrow rows: a range sort spreads any hot value by checksum and key. A row's global number is
    its place in its range plus the rows of the ranges before, so no task sorts or counts everything.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    point = F.array(*[quantised(docs, c, bits) for c in by])
    narrow = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        hilbert_index(point, len(by), bits).alias("curve"),
    )
    order = ["curve", "text_crc32", "_key"]
    sorted_rows = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    # monotonically_increasing_id is the partition's number in the high bits and the row's place in the low 33
    numbered = store(sorted_rows.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33).alias("part"), F.col("_at").bitwiseAND(2**33 - 1)
    # a row per range: as many as the shuffle had partitions
    before, total = [], 0
    for row in numbered.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        before.append((row["part"], total))
        total += row["n"]
    if not before:
        before = [(0, 0)]
    offsets = F.element_at(F.map_from_arrays(F.lit([p for p, _ in before]).cast("array<bigint>"), F.lit([n for _, n in before]).cast("array<bigint>")), F.shiftright("_at", 33))
    ranked = numbered.withColumn("_rank", offsets + place)
    # in whole numbers: shard s starts at the first rank r with r * shards >= s * total
    shard = F.expr(f"(_rank * {shards}) div {max(total, 1)}")
    start = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_rank") - start)
        .select(F.col("_key").alias(key), "size", "text_crc32", "curve", "shard", "slot")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, by: list[str], key: str = "doc_id", mode: str = "error") -> DataFrame:
    """Write ``docs`` as one folder a shard, in curve order, and return each shard's bounds for pruning.

    A repeated key stops the job, as its rows could not be told apart; null is a key like others. Columns of ``docs`` may have any
    names: the folders are named by the first of ``_shard``, ``_shard_`` and so on that is free. Each shard is cut into files by slot,
    so a large shard is not one task's work. An empty table has no bounds.
    """
    folder = "_shard"
    while folder in docs.columns:
        folder += "_"
    places = unique(placed.select(F.col(key).alias("_key"), "shard", "slot"), "_key")
    rows = docs.select(F.struct("*").alias("_row")).join(places, F.col("_row").getField(key).eqNullSafe(F.col("_key")))
    spread = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    spread.select("_row.*", F.col("shard").alias(folder)).write.mode(mode).partitionBy(folder).parquet(path)
    bounds = [f(c).alias(f"{name}_{c}") for c in by for name, f in (("min", F.min), ("max", F.max))]
    schema = StructType([*docs.schema.fields, StructField(folder, IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path).groupBy(F.col(folder).alias("shard")).agg(F.count(F.lit(1)).alias("rows"), *bounds)
