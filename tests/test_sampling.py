"""Samples, splits and folds against sorting by the same hash."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from slotflow.operators.sampling import DIGITS, balanced_sample, drop_incomplete, hash_cutoffs, hash_folds, stratified_split


def md5(seed, *key):
    return hashlib.md5("|".join(map(str, (seed, *key))).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    return [(f"k{i}", "abc"[0 if i % 3 else i % 2 + 1], None if i % 11 == 0 else float(i)) for i in range(900)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, kind string, value double").repartition(5)


def by_kind(rows):
    kinds = defaultdict(list)
    for key, kind, value in rows:
        kinds[kind].append((md5(7, key), key, value))
    return {kind: sorted(members) for kind, members in kinds.items()}


@pytest.mark.parametrize("n", [1, 100, 149, 150, 151, 10_000])
def test_sample_takes_the_first_of_each_class_then_drops(frame, rows, n):
    want = {key for members in by_kind(rows).values() for _, key, value in members[:n] if value is not None}
    found = [r.key for r in balanced_sample(frame, "kind", n, ["key"], seed=7).collect()]
    assert len(found) == len(set(found)) and set(found) == want


@pytest.mark.parametrize("p", [0.0, 0.5, 0.75, 0.801, 1.0])
def test_split_takes_the_share_rounded_up(frame, rows, p):
    want = {key for members in by_kind(rows).values() for _, key, _ in members[: math.ceil(p * len(members))]}
    split = stratified_split(frame, "kind", p, ["key"], seed=7).collect()
    assert len(split) == len(rows)
    assert {r.key for r in split if r.in_train} == want


def test_a_missing_stratum_is_a_stratum(spark):
    df = spark.createDataFrame([(str(i), None if i < 10 else "x") for i in range(30)], "key string, kind string")
    split = stratified_split(df, "kind", 0.5, ["key"]).collect()
    assert Counter((r.kind, r.in_train) for r in split) == {(None, True): 5, (None, False): 5, ("x", True): 10, ("x", False): 10}


def test_folds_come_from_the_hash(frame, rows):
    found = {r.key: r.fold for r in hash_folds(frame, ["key"], 10, "7-1").collect()}
    assert found == {key: int(md5("7-1", key)[:8], 16) % 10 for key, _, _ in rows}


def test_nan_is_incomplete(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", float("nan")), ("c", None), (None, 2.0)], "k string, v double")
    assert [r.k for r in drop_incomplete(df).collect()] == ["a"]
    assert drop_incomplete(df, ["k"]).count() == 3


def test_a_repeated_key_at_the_cut_stops_the_job(spark):
    rows = [(f"k{i // 10}", "a", float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "key string, kind string, value double")
    with pytest.raises(Exception, match="share the key key"):
        balanced_sample(df, "kind", 105, ["key"]).collect()
    assert balanced_sample(df, "kind", 105, ["key", "value"]).count() == 105


def test_counts_by_bucket_are_few(spark):
    """A task counts many rows in few buckets, and the cut-off is that of sorting."""
    df = spark.range(0, 60_000, numPartitions=2).selectExpr("id", "id % 2 kind")
    cutoffs = {r.kind: r.cutoff for r in hash_cutoffs(df, "kind", ["id"], 7, lambda rows: F.lit(9_000).cast("long")).collect()}
    for kind in (0, 1):
        assert cutoffs[kind] == sorted(md5(7, i) for i in range(kind, 60_000, 2))[8_999]
    assert 16**DIGITS < 10_000
