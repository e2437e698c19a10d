"""Sources mixed to target weights: how often each document is taken, so that every source's words come near its target.

Documents of a source start with one and the same fractional number of copies. Two of them at a time, mass (words times copies)
moves from one to the other, at random and without a drift, until one has a whole number of copies; the other goes on. That is
done in blocks, then among what is left of them, and so on up a tree: the words taken of a source stay what they were, but for
the one document left at the top. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from slotflow.llm.common import store

#: Documents of a block and children of a node. Another number draws other documents, with the same chances.
FAN = 128


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_count(text: str) -> Column:
    """Runs of other characters than space and tab to carriage return; null has none."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows``, stored, with ``_rank``, their place in the order, from 0.

    A range sort; a row's place is that within its range and the rows of the ranges before, a number per range. Rows that are
    equal in the order are parted at will, so a repeated row does not fill a range.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    order = (*order, F.col("_tie"))
    numbered = store(tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    # the partition's number is in the high bits, the row's place in the low 33
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(2**33 - 1)
    before, total = {}, 0
    for row in numbered.groupBy(part.alias("part")).count().orderBy("part").collect():
        before[row["part"]], total = total, total + row["count"]
    parts, numbers = (F.lit(list(values)).cast("array<bigint>") for values in (before.keys(), before.values()))
    return numbered.withColumn("_rank", F.element_at(F.map_from_arrays(parts, numbers), part) + place).drop("_at")


def targets(sources: DataFrame, share: float, most: int) -> DataFrame:
    """``sources`` with ``target``: ``share`` of all words by weight, at most ``most`` times a source's own words.

    What is above a source's most is shared again by weight among the others, until none is above. A step of that is one sum over
    the sources, of which the driver gets a row.
    """
    total = sources.agg(F.sum("own").alias("n")).first().n or 0
    level, full = None, -1
    while True:
        above = F.lit(False) if level is None else F.lit(level) * F.col("weight") > F.col("own") * most
        sums = sources.agg(
            F.sum(F.when(above, F.col("own") * most)).alias("full_words"), F.count_if(above).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("weight")
        ).first()
        if sums.full == full or not sums.weight:
            target = F.when(above, (F.col("own") * most).cast("double")).otherwise(F.lit(level or 0.0) * F.col("weight"))
            return sources.withColumn("target", target)
        level, full = (share * total - (sums.full_words or 0)) / sums.weight, sums.full


def chance(seed: int, *ranks: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the seed and the ranks."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *ranks), 11).cast("double") * 2.0**-53


def pivotal(members: Column, member_type: str, seed: int) -> Column:
    """Dependent rounding of ``members``, an array of (size, rank, id, x), sizes positive and x in [0, 1], one after the other.

    Returns ``done``, the members decided, with x 0 or 1, and ``carry``, the one left over (null if there are none). A step moves mass
    between carry and next member: towards the one or the other, with chances that keep every x as expected.
    """

    def with_x(member: Column, x: Column | float) -> Column:
        return F.struct(member["size"].alias("size"), member["rank"].alias("rank"), member["id"].alias("id"), F.lit(x).cast("double").alias("x"))

    def step(state: Column, m: Column) -> Column:
        c = state["carry"]
        held, own = c["x"] * c["size"], m["x"] * m["size"]
        room, own_room = (1 - c["x"]) * c["size"], (1 - m["x"]) * m["size"]
        to_carry, to_member = F.least(room, own), F.least(held, own_room)
        # towards the carry with the other way's share of both
        up = chance(seed, c["rank"], m["rank"]) * (to_carry + to_member) < to_member

        def result(decided: Column, left: Column) -> Column:
            return F.struct(left.alias("carry"), F.concat(state["done"], F.array(decided)).alias("done"))

        clipped = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
        moved = (
            F.when(up & (room <= own), result(with_x(c, 1.0), with_x(m, clipped(m["x"] - room / m["size"]))))
            .when(up, result(with_x(m, 0.0), with_x(c, clipped(c["x"] + own / c["size"]))))
            .when(held <= own_room, result(with_x(c, 0.0), with_x(m, clipped(m["x"] + held / m["size"]))))
            .otherwise(result(with_x(m, 1.0), with_x(c, clipped(c["x"] - own_room / c["size"]))))
        )
        return F.when(c.isNull(), F.struct(m.alias("carry"), state["done"].alias("done"))).otherwise(moved)

    empty = F.struct(F.lit(None).cast(member_type).alias("carry"), F.array().cast(f"array<{member_type}>").alias("done"))
    return F.aggregate(members, empty, step)


def rounded(rows: DataFrame, keep: Sequence[str], member_type: str, seed: int) -> DataFrame:
    """``keep``, ``source_no``, ``node``, ``done`` and ``carry`` of every node; ``rows`` have ``source_no``, ``node`` and ``member``.

    Larger documents come first: what is left at the end tends to be small.
    """
    members = F.sort_array(F.collect_list("member"), asc=False)
    nodes = rows.groupBy("source_no", "node", *keep).agg(members.alias("members"))
    return store(nodes.withColumn("state", pivotal(F.col("members"), member_type, seed)).select("source_no", "node", *keep, "state.done", "state.carry"))


def mixed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
    most: int = 2, seed: int = 12, fan: int = FAN,
) -> DataFrame:
    """``key``, ``size`` (words), ``source_size``, ``target`` and ``taken`` of every row: words that the mix takes, repeats counted.

    Sources by code point, null last, have the ``weights`` in turn. They share ``share`` times all words; a target is at most
    ``most`` times its source's words. A document is taken whole, as often as target by source words says, rounded down or up, so
    ``most`` times at most. The words taken of a source differ from its target by half a document at most, the one left at the top.

    Null and empty texts have no words and take none, whole texts are counted, repeated rows are documents of their own, an empty
    table gives no rows, and other columns are not looked at. The draw depends on the seed and the rows alone: reruns agree.

    Narrow rows are range-sorted by source and hash, so that a source of any size lies in many ranges, and cut into blocks of ``fan``.
    Each level of the tree has a row per block of the level below.
    """
    size = word_count(text)
    # stored, so that texts are counted once: the range sort reads its input twice
    narrow = store(docs.select(F.col(key).alias("id"), F.col(source).alias("source"), size.alias("size")))
    placed = ranked(narrow, F.col("source").asc_nulls_last(), F.xxhash64(F.lit(seed), "id", "size"), F.col("id").asc_nulls_last(), F.col("size"))
    sums = placed.groupBy("source").agg(F.sum("size").alias("own"), F.count(F.lit(1)).alias("n"), F.min("_rank").alias("start"))
    numbered = ranked(sums, F.col("start")).withColumnRenamed("_rank", "source_no")
    weight = F.element_at(F.lit([float(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    sources = store(targets(numbered.withColumn("weight", weight), share, most))
    times = F.coalesce(F.try_divide(F.col("target"), F.col("own")), F.lit(0.0))
    known = sources.select(
        F.col("source").alias("_source"), "own", "target", "start", "source_no", F.floor(times).alias("times"), (times - F.floor(times)).alias("x")
    )
    rows = placed.join(known, F.col("source").eqNullSafe(F.col("_source")))

    # what is whole already takes no part in the draw
    open_rows = (F.col("size") > 0) & (F.col("x") > 0)
    member = F.struct("size", F.col("_rank").alias("rank"), "id", "x").alias("member")
    leaves = rows.where(open_rows).select("source_no", F.floor((F.col("_rank") - F.col("start")) / fan).alias("node"), "own", "target", "times", member)
    member_type = leaves.schema["member"].dataType.simpleString()
    blocks = rounded(leaves, ["own", "target", "times"], member_type, seed)

    largest, height = sources.agg(F.max("n").alias("n")).first().n or 0, 1
    level, decided = blocks, []
    while fan**height < largest:
        above = level.select("source_no", F.floor(F.col("node") / fan).alias("node"), F.col("carry").alias("member"))
        level = rounded(above, [], member_type, seed + height)
        decided.append(level.select(F.explode("done").alias("m")))
        height += 1
    # the top's document has no partner: the nearer number brings its source nearest to the target
    decided.append(level.select(F.col("carry").alias("m")).withColumn("m", F.col("m").withField("x", F.rint(F.col("m.x")))))
    last = decided[0]
    for more in decided[1:]:
        last = last.unionByName(more)

    columns = [F.col("m.id").alias(key), F.col("m.size").alias("size"), F.col("own").alias("source_size"), "target"]
    taken = ((F.col("times") + F.col("m.x").cast("long")) * F.col("m.size")).alias("taken")
    settled = blocks.select("own", "target", "times", F.explode("done").alias("m")).select(*columns, taken)
    carried = blocks.select(F.col("carry.rank").alias("_carried"), "own", "target", "times")
    carried = carried.join(last, F.col("_carried") == F.col("m.rank")).select(*columns, taken)
    even = rows.where(~open_rows).select(
        F.col("id").alias(key), "size", F.col("own").alias("source_size"), "target", (F.col("times") * F.col("size")).alias("taken")
    )
    return settled.unionByName(carried).unionByName(even)
