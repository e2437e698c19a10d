"""Bounds of the exact neighbour search: they rule out much and lose nothing."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotflow.models import boxes, knn


def nearest(q, x, k, keep=None):
    far = np.round(np.sqrt(((q[:, None] - x[None]) ** 2).sum(2)), knn.DIGITS)
    if keep is not None:
        far[~keep] = np.inf
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), far.shape), far), axis=1)[:, :k]
    return np.take_along_axis(far, order, 1), order


@pytest.mark.parametrize("kind", ["spread", "copies", "one"])
def test_cells_give_the_nearest_of_all(kind):
    rng = np.random.default_rng(1)
    x = {"spread": rng.normal(size=(900, 4)), "copies": rng.integers(0, 3, (900, 4)) * 1.0, "one": np.ones((900, 4))}[kind]
    q = x[::7] + (rng.normal(size=(len(x[::7]), 4)) if kind == "spread" else 0)
    cells = boxes.leaves(x, 32)
    assert sorted(np.concatenate(cells)) == list(range(900)) and (kind == "one") == (len(cells) == 1)
    parts = list(boxes.search_leaves(q, x, cells, 5, np.full(len(q), np.inf), knn.DIGITS, 4000))
    far, place = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    want_far, want_place = nearest(q, x, 5)
    assert len(parts) > 1 and (far == want_far).all() and (place == want_place).all()


@pytest.mark.parametrize("many", [1, 9])
def test_all_problems_of_a_query_are_searched_at_once(monkeypatch, many):
    """One pass for problems that differ in scale and in the rows left out; there was one for each."""
    monkeypatch.setattr(boxes, "PAIRS_AT_ONCE", 100)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(800, 3)).round(1)
    held, problems = rng.integers(0, many + 1, 800), np.tile(np.arange(many + 1), (150, 1))
    scales = 1 + rng.random((many + 1, 3)) / 20
    met = []

    def measure(a, column, t):
        met.append(len(a))
        far = np.round(np.sqrt((((x[a] - x[t]) / scales[problems[a, column]]) ** 2).sum(1)), knn.DIGITS)
        return np.where(held[t] == problems[a, column], np.inf, far)

    flat, limits = x / scales.max(0), np.full((150, many + 1), np.inf)
    limits[:20, 0] = 0.2
    parts = list(boxes.search_problems(flat[:150], flat, boxes.leaves(flat, 32), 4, limits, measure, 4000))
    far, place = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    for p in range(many + 1):
        want_far, want_place = nearest(x[:150] / scales[p], x / scales[p], 4, np.broadcast_to(held != p, (150, 800)))
        near = want_far <= limits[:, [p]]
        assert (far[:, p] == np.where(near, want_far, np.inf)).all() and (place[:, p] == np.where(near, want_place, -1)).all()
    assert len(parts) > 1 and sum(met) < 150 * 800 * (many + 1) / 10


def test_few_rows_take_part():
    """Fewer than are asked for, behind many that are left out."""
    x = np.arange(300.0)[:, None]
    parts = list(boxes.search_problems(x[:40], x, boxes.leaves(x, 16), 3, np.full((40, 1), np.inf), lambda a, _, t: np.where(t > 297, np.abs(a - t) * 1.0, np.inf), 4000))
    assert all((place[:, 0] == [298, 299, -1]).all() for _, place in parts) and sum(len(p) for _, p in parts) == 40


def test_cuts_halve_a_sample():
    x = np.random.default_rng(2).normal(size=(1000, 3))
    cuts = boxes.fit_cuts(x, 4)
    assert set(np.bincount(cuts.cells(x), minlength=16)) <= {62, 63}
    assert set(boxes.fit_cuts(np.ones((50, 3)), 3).cells(np.ones((50, 3)))) == {0}


def test_queries_travel_only_where_something_can_be_near(spark, monkeypatch):
    """Rows in clusters: the search meets each query's own cluster, where all pairs of blocks and chunks met before."""
    for name, value in (("BLOCK_ROWS", 60), ("CHUNK_ROWS", 50), ("LEAF_ROWS", 16)):
        monkeypatch.setattr(knn, name, value)
    rng = np.random.default_rng(3)
    x = rng.integers(0, 8, 1200)[:, None] * 50 + rng.normal(size=(1200, 3))
    held = [[int(f), int(3 + g)] for f, g in rng.integers(0, 3, (1200, 2))]
    rows = [(f"{i:05d}", float(i % 13), [*map(float, v)], h) for i, (v, h) in enumerate(zip(x, held))]
    frame = spark.createDataFrame([*rows, (None, 1.0, [0.0] * 3, [0, 3])], "id string, label double, x array<double>, held array<int>")
    scales = {p: (np.full(3, 0.1 * p), np.array([1.0, 1.0 + p, 0.0])) for p in range(6)}
    met = []
    joined = knn._meeting

    def meeting(asked, rows, search, schema):
        met.append(asked.count())
        return joined(asked, rows, search, schema)

    monkeypatch.setattr(knn, "_meeting", meeting)
    found = knn.neighbours(frame, frame.withColumnRenamed("held", "problems"), 4, scales)
    got = {}
    for r in found.orderBy("problem", "query", "rank").collect():
        got.setdefault((r.problem, r.query), []).append((r.id, r.label, r.distance))
    marks = np.array(held)
    for p, scale in scales.items():
        scaled, mine = knn._scaled(x, *scale), np.flatnonzero((marks == p).any(axis=1))
        keep = np.broadcast_to(~(marks == p).any(axis=1), (len(mine), 1200))
        far, place = nearest(scaled[mine], scaled, 4, keep)
        for m, f, t in zip(mine, far, place):
            assert got.pop((p, f"{m:05d}")) == [(f"{i:05d}", float(i % 13), d) for i, d in zip(t, f)]
    assert not got and met[0] == 1200
    # of 20 blocks or more a query needs its own cluster's, about 4
    assert met[1] < 6 * 1200


def test_a_block_and_its_queries_meet_once_for_all_folds(spark, monkeypatch):
    """Every fold was searched by itself."""
    called = []
    search = boxes.search_problems
    monkeypatch.setattr(knn, "search_problems", lambda q, x, cells, k, limits, *rest: [called.append(limits.shape), *search(q, x, cells, k, limits, *rest)][1:])
    rows = [(f"{i:03d}", float(i), [float(i % 17), float(i % 5)], [i % 3, 3 + i % 4]) for i in range(60)]
    frame = spark.createDataFrame(rows, "id string, label double, x array<double>, held array<int>")
    scales = {p: (np.zeros(2), np.array([1.0 + p / 9, 1.0])) for p in range(7)}
    # the search runs here, not in a task
    monkeypatch.setattr(knn, "_meeting", lambda asked, rows, run, schema: spark.createDataFrame(run(asked.toArrow(), rows.toArrow())))
    found = knn.neighbours(frame, frame.withColumnRenamed("held", "problems"), 2, scales).collect()
    assert called == [(60, 2)] and len(found) == 60 * 2 * 2


def test_one_cell_of_copies_is_searched_in_shares(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 50)
    rows = spark.range(400).select(F.format_string("%05d", "id").alias("id"), F.col("id").cast("double").alias("label"), F.array(F.lit(2.0)).alias("x"))
    none, one = F.array().cast("array<int>").alias("held"), F.array(F.lit(0)).alias("problems")
    found = knn.neighbours(rows.select("*", none), rows.limit(20).select("id", "x", one), 3, {0: (np.zeros(1), np.ones(1))}).collect()
    assert len(found) == 60 and {r.id for r in found} == {"00000", "00001", "00002"}
