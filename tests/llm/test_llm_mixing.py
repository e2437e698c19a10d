"""The mix against a plain version of its targets and its draw."""

from __future__ import annotations

import math
import re
import struct
from collections import defaultdict

import pytest
import xxhash
from helpers import empty_docs, odd_docs
from pyspark.sql import functions as F

from slotflow.llm import mixing


def plain_targets(own, weights=(3, 1, 2), share=1.5, most=2):
    """Sharing again until no source is above its most."""
    names = sorted(own, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, room = {}, set(names), share * sum(own.values())
    while left:
        total = sum(weight[s] for s in left)
        above = {s for s in left if room * weight[s] / total > most * own[s]}
        if not above:
            out |= {s: room * weight[s] / total for s in left}
            break
        out |= {s: most * own[s] for s in above}
        room, left = room - sum(most * own[s] for s in above), left - above
    return out


def signed(h):
    return h - 2**64 if h >= 2**63 else h


def spark_hash(*values):
    """Spark's xxhash64 of 64-bit numbers; null is left out. The first is a 32-bit literal."""
    h = 42
    for i, v in enumerate(values):
        if v is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<i" if i == 0 else "<q", v), seed=h)
    return h


def plain_mix(rows, seed=12, fan=8):
    """[(key, size, own, target, taken)] by the same draws, with loops instead of a tree of tables."""
    sized = [(s, k, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, s, t in rows]
    own = defaultdict(int)
    for s, _, n in sized:
        own[s] += n
    target = plain_targets(own)
    order = sorted(sized, key=lambda r: (r[0] is None, r[0] or "", signed(spark_hash(seed, r[1], r[2])), r[1] is None, r[1] or 0, r[2]))
    out, start = [], {}
    ups = {}
    levels = defaultdict(list)
    for rank, (s, _, n) in enumerate(order):
        start.setdefault(s, rank)
        r = target[s] / own[s] if own[s] else 0.0
        if n and r > math.floor(r):
            levels[s, (rank - start[s]) // fan].append((n, rank, r - math.floor(r)))
    largest = max((len([1 for x in order if x[0] == s]) for s in start), default=0)
    level = 0
    while levels:
        carried = defaultdict(list)
        for (s, node), members in levels.items():
            carry = None
            for n, rank, x in sorted(members, reverse=True):
                if carry is None:
                    carry = [n, rank, x]
                    continue
                c, m = carry, [n, rank, x]
                up, down = min((1 - c[2]) * c[0], m[2] * m[0]), min(c[2] * c[0], (1 - m[2]) * m[0])
                u = (spark_hash(seed + level, c[1], m[1]) >> 11) * 2.0**-53
                if u * (up + down) < down:
                    if (1 - c[2]) * c[0] <= m[2] * m[0]:
                        ups[c[1]], m[2], carry = 1, min(max(m[2] - (1 - c[2]) * c[0] / m[0], 0), 1), m
                    else:
                        ups[m[1]], c[2] = 0, min(max(c[2] + m[2] * m[0] / c[0], 0), 1)
                elif c[2] * c[0] <= (1 - m[2]) * m[0]:
                    ups[c[1]], m[2], carry = 0, min(max(m[2] + c[2] * c[0] / m[0], 0), 1), m
                else:
                    ups[m[1]], c[2] = 1, min(max(c[2] - (1 - m[2]) * m[0] / c[0], 0), 1)
            carried[s, node // fan].append(tuple(carry))
        level += 1
        if fan**level >= largest:
            ups |= {rank: round(x) for members in carried.values() for _, rank, x in members}
            break
        levels = carried
    for rank, (s, k, n) in enumerate(order):
        times = math.floor(target[s] / own[s]) if own[s] else 0
        out.append((k, n, own[s], target[s], (times + ups.get(rank, 0)) * n))
    return out


def result(df, **options):
    return [tuple(r) for r in mixing.mixed(df, **options).collect()]


def same(found, wanted):
    rounded = lambda rows: sorted(((r[0] is None, r[0] or 0, r[1], r[2], round(r[3], 6), r[4]) for r in rows))
    return rounded(found) == rounded(wanted)


def sourced(spark):
    return odd_docs(spark).withColumn("source", F.when(F.length("text") % 3 == 0, "b").when(F.length("text") % 3 == 1, "a").when(F.length("text") == 2, ""))


@pytest.mark.parametrize("fan", [2, 8, 128])
def test_the_draw_is_that_of_the_plain_version(text_spark, fan):
    docs = text_spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    assert same(result(docs, fan=fan), plain_mix(rows, fan=fan))


def test_odd_rows(text_spark):
    docs = sourced(text_spark)
    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    found = result(docs, fan=2)
    assert len(found) == len(rows) and same(found, plain_mix(rows, fan=2))
    assert result(empty_docs(text_spark)) == []
    blank = docs.withColumn("text", F.when(F.col("doc_id") > 3, " "))
    assert {r[1:] for r in result(blank)} == {(0, 0, 0.0, 0)}


def test_taken_words_come_near_targets_whatever_the_partitions(text_spark):
    """A hot source, a source of copies of one row, and one of two long texts; twice, from other partitions."""
    base = text_spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 13).cast("string"))).alias("source"),
        F.expr("repeat('w ', 1 + cast(pmod(xxhash64(id), 60) as int) * if(pmod(id, 50) = 0, 20, 1))").alias("text"),
    )
    copies = text_spark.range(2000).selectExpr("7L as doc_id", "'copies' as source", "'five words are in here' as text")
    docs = base.unionByName(copies)
    found = result(docs.repartition(7))
    assert sorted(found) == sorted(result(docs.repartition(3, "source")))
    by_source = defaultdict(lambda: [0, 0, 0.0, 0])
    for _, size, own, target, taken in found:
        kept = by_source[own, target]
        kept[0] += taken
        kept[3] = max(kept[3], size)
        assert taken % max(size, 1) == 0 and taken <= 2 * size
    for (own, target), (taken, _, _, largest) in by_source.items():
        assert abs(taken - target) <= largest / 2 and target <= 2 * own + 1e-6
    # what is left at the top tends to be small: far nearer than the largest document
    assert sum(abs(t[0] - target) for (_, target), t in by_source.items()) / len(by_source) < 60


def test_every_document_has_its_chance(text_spark):
    """Over many seeds each member is taken as often as its number says, and mass stays what it was but for the carry."""
    given = [(1 + 7 * i % 11, i, (i * 37 % 100) / 100) for i in range(1, 30)]
    member = "struct<size: bigint, rank: bigint, id: bigint, x: double>"
    members = F.from_json(F.lit(str([{"size": n, "rank": r, "id": r, "x": x} for n, r, x in given]).replace("'", '"')), f"array<{member}>")
    seeds = text_spark.range(4000).select(members.alias("m"), F.col("id").alias("seed"))
    drawn = seeds.select(mixing.pivotal(F.col("m"), member, F.col("seed")).alias("s")).collect()
    mean = defaultdict(float)
    for (state,) in drawn:
        assert len(state.done) == len(given) - 1 and {m.x for m in state.done} <= {0.0, 1.0}
        assert abs(sum(m.size * m.x for m in [*state.done, state.carry]) - sum(n * x for n, _, x in given)) < 1e-9
        for m in [*state.done, state.carry]:
            mean[m.rank] += m.x / len(drawn)
    # 4,000 draws of spread at most a half: five times the error of the mean
    assert max(abs(mean[r] - x) for _, r, x in given) < 0.04


def test_targets_stop_at_their_most():
    assert plain_targets({"a": 10, "b": 1000, None: 10}) == {"a": 20, None: 20, "b": 1490.0}


def test_the_draw_runs_without_python(text_spark):
    plan = mixing.mixed(odd_docs(text_spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(mark in plan for mark in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
