"""Near duplicates by SimHash: generalised pigeonhole search for fingerprints that differ in few bits.

The 64 bits are dealt into partitions, bits that move together into the same one. Partition i gets a threshold t_i, with
sum(t_i + 1) = distance + 1: two fingerprints within the distance then differ in at most t_i bits of some
partition i (else they would differ in sum(t_i + 1) > distance bits). A threshold of -1 leaves a partition out. Dynamic
programming picks the thresholds with the fewest expected candidates, from how often each bit is set.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from slotflow.llm.common import row_hash, store, summed, text_digest, without
from slotflow.llm.components import components

BITS = 64


def fingerprint(text: str | None, words: int = 3, at_once: int = 1 << 16) -> int:
    """The SimHash of a text as a signed 64-bit number; zero if it has no words.

    A-Z are lower-cased, words are cut at space and tab to carriage return. Shingles count as often as they
    occur; a text with fewer words is one shingle. A bit is set if it is in more than half of the hashes.
    """
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    n = max(1, len(found) - words + 1)
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[-n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, n, at_once):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[i : i + at_once], stops[i : i + at_once])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, words: int, names: bool = False) -> DataFrame:
    """``key`` as text, and its fingerprint; a row per row of ``docs``. With ``names`` also what names the row: ``hash`` and ``own``."""
    more = [row_hash(key, text).alias("hash"), text_digest(F.col(text)).alias("own")] if names else []
    columns = ["key", "fp"] + ["hash", "own"] * names

    def run(batches) -> Iterator:
        for batch in batches:
            batch["fp"] = [fingerprint(t, words) for t in batch["text"]]
            yield batch[columns]

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), *more)
    return rows.mapInPandas(run, "key string, fp bigint" + ", hash bigint, own binary" * names)


def bit_moments(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many each pair of bits is set: one 64x64 sum."""

    def count(batches) -> Iterator:
        import pandas as pd

        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = np.unpackbits(batch["fp"].to_numpy("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            both += bits.T @ bits
            n += len(bits)
        yield pd.DataFrame({"part": [hash(both.tobytes()) % 1024], "sums": [np.append(both.ravel(), n)]})

    rows = summed(distinct.select("fp").mapInPandas(count, "part int, sums array<double>"), "part", "sums").collect()
    total = np.sum([np.asarray(r["sums"]) for r in rows], axis=0) if rows else np.zeros(BITS * BITS + 1)
    return int(total[-1]), total[:-1].reshape(BITS, BITS)


def grouped_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of about equal size. Each group grows by the free bit that moves most with it."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    moves = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    free, groups = set(range(BITS)), []
    for i in range(parts):
        room = (BITS * (i + 1)) // parts - (BITS * i) // parts
        start = max(free, key=lambda b: (moves[b, sorted(free - {b})].max(initial=0), -b))
        group = [start]
        free.remove(start)
        while len(group) < room:
            group.append(max(free, key=lambda b: (moves[b, group].mean(), -b)))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def allocate(n: int, both: np.ndarray, distance: int, most_parts: int = 4) -> list[tuple[list[int], int]]:
    """Partitions and thresholds with the least expected work, as (bits, threshold) for those in use.

    Two fingerprints differ in bit b with probability 2 p (1 - p); the distribution of the distance within a
    partition follows bit by bit. The expected candidates of a threshold are the pairs within it, plus the probes sent.
    """
    share = np.diag(both) / max(n, 1)
    differ = 2 * share * (1 - share)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(1, most_parts + 1):
        groups = grouped_bits(n, both, parts)
        costs = []
        for group in groups:
            exactly = np.array([1.0])
            for b in group:
                exactly = np.append(exactly * (1 - differ[b]), 0) + np.append(0, exactly * differ[b])
            within = np.cumsum(exactly)
            probes = np.cumsum([len(list(combinations(group, k))) if k <= 2 else 1e18 for k in range(min(len(group), distance) + 1)])
            costs.append([0.0] + [n * n / 2 * within[t] + 20 * n * probes[t] for t in range(len(probes))])
        # least[s]: cheapest way to spend s of the distance + 1 units on the groups so far
        least: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for spent, (total, units) in least.items():
                for unit, price in enumerate(cost):
                    if spent + unit <= distance + 1 and total + price < step.get(spent + unit, (np.inf,))[0]:
                        step[spent + unit] = (total + price, [*units, unit])
            least = step
        if distance + 1 in least and (best is None or least[distance + 1][0] < best[0]):
            total, units = least[distance + 1]
            best = (total, [(g, u - 1) for g, u in zip(groups, units) if u])
    return best[1]


def masks(bits: list[int], most: int) -> list[int]:
    """All ways to flip up to ``most`` of the bits, as signed 64-bit masks; zero first."""
    flips = [sum(1 << b for b in chosen) for k in range(most + 1) for chosen in combinations(bits, k)]
    return [m - 2**64 if m >= 2**63 else m for m in flips]


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(distinct: DataFrame, distance: int, bucket: int) -> DataFrame:
    """Edges ``a``, ``b`` that connect all fingerprints within ``distance`` bits; every edge is within it itself.

    A partition's value is a bucket. Buckets of up to ``bucket`` fingerprints are probed and verified pair by
    pair. Members of larger ones are many close fingerprints: they send themselves to all centres within half the
    distance and are linked to the least one there. Two fingerprints within an even distance share such a centre, so
    no link is lost, and a member costs a fixed number of rows however large its bucket is.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    n, both = bit_moments(distinct)
    if n < 2:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    plan = allocate(n, both, distance)

    def value(part: int, bits: list[int]) -> Column:
        mask = masks(bits, len(bits))[-1] if len(bits) <= 2 else sum(1 << b for b in bits)
        return F.struct(F.lit(part).alias("part"), F.col("fp").bitwiseAND(mask - 2**64 if mask >= 2**63 else mask).alias("value"))

    index = store(distinct.select("fp", F.explode(F.array(*[value(i, bits) for i, (bits, _) in enumerate(plan)])).alias("at")).select("fp", "at.*"))
    sizes = store(index.groupBy("part", "value").count().where(F.col("count") > bucket).drop("count"))
    small = index.join(sizes, ["part", "value"], "left_anti")
    probe = small
    if any(t > 0 for _, t in plan):
        flips = F.element_at(F.array(*[F.array(*map(F.lit, masks(bits, t))).cast("array<bigint>") for bits, t in plan]), F.col("part") + 1)
        probe = index.withColumn("flip", F.explode(flips)).select("fp", "part", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    left = probe.withColumnRenamed("fp", "b")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= distance
    same = (small["part"] == left["part"]) & (small["value"] == left["value"])
    pairs = small.join(left, same & (F.col("fp") < F.col("b")) & close).select(F.col("fp").alias("a"), "b")
    if any(t > 0 for _, t in plan):
        # with a radius, the larger one may be the one whose probe finds the smaller's bucket, or the other way round
        other = small.join(left, same & (F.col("fp") > F.col("b")) & close).select(F.col("b").alias("a"), F.col("fp").alias("b"))
        pairs = pairs.unionByName(other)
    crowded = index.join(sizes, ["part", "value"], "left_semi").select("fp").distinct()
    if any(t > 0 for _, t in plan):
        # a probe may reach a large bucket from outside: all whose probes do go by centres
        reach = left.join(sizes, ["part", "value"], "left_semi").select(F.col("b").alias("fp"))
        crowded = crowded.unionByName(reach).distinct()
    around = F.explode(F.array(*map(F.lit, masks(list(range(BITS)), distance // 2))).cast("array<bigint>"))
    sent = crowded.withColumn("flip", around).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    first = sent.groupBy("centre").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n"), F.collect_list("fp").alias("all"))
    star = first.where("n > 1").select("a", F.explode("all").alias("b")).where((F.col("a") != F.col("b")) & (differing("a", "b") <= distance))
    return pairs.unionByName(star).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2, bucket: int = 1000
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, a row per row of ``docs``.

    Documents are linked when their fingerprints differ in at most ``distance`` bits (an even number); the component is
    the smallest key that links reach, the row's own included. Equal fingerprints are one node, however many rows have
    it. Null, empty and blank texts have fingerprint zero and are linked like others. Null keys are kept and never name a
    component, unless all its keys are null. Keys compare in their own type; other columns are not looked at.
    """
    rows, by_node = grouped(docs, key, text, words, distance, bucket, F.col("key"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(by_node, "fp").select(F.col("key").alias(key), shown, F.col("least").alias("component_id"))


def grouped(
    docs: DataFrame, key: str, text: str, words: int, distance: int, bucket: int, order: Column, names: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``fingerprints``, and for each fingerprint the ``least`` value of ``order`` in its component."""
    kind = docs.schema[key].dataType
    rows = store(fingerprints(docs, key, text, words, names).withColumn("key", F.col("key").cast(kind)))
    nodes = store(rows.groupBy("fp").agg(F.min(order).alias("least")))
    roots = components(links(nodes.select("fp"), distance, bucket))
    named = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = store(named)
    least = named.groupBy("root").agg(F.min("least").alias("least"))
    return rows, store(named.drop("least").join(least, "root").select("fp", "least"))


def without_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2, bucket: int = 1000
) -> DataFrame:
    """One row of each component, all columns as they are: the smallest key, then the least text digest; null keys come last.

    Rows are named by key and text, so other rows of the same key do not matter; of repeated rows one stays.
    """
    order = F.struct(F.col("key").isNull().alias("none"), "key", "own")
    rows, by_node = grouped(docs, key, text, words, distance, bucket, order, names=True)
    kept = F.col("key").eqNullSafe(F.col("least.key")) & (F.col("own") == F.col("least.own"))
    found = store(rows.join(by_node, "fp").select("key", "own", "hash", kept.alias("kept")))
    again = found.where("kept").groupBy("key", "own", "hash").count().where("count > 1")
    return without(docs, found.where("not kept"), key, text, again)
