"""The resampled forests against plain splits and a known answer."""

from __future__ import annotations

import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from slotflow.models import classifier, resampling
from slotflow.plans import catalog


def plain_split(codes, y, weight, sizes):
    """The best split of one node by trying all."""
    best = (0.0, 0, 0)

    def purity(mask):
        n, yes = weight[mask].sum(), (weight * y)[mask].sum()
        return (yes**2 + (n - yes) ** 2) / max(n, 1)

    everything = np.ones(len(y), bool)
    for c, size in enumerate(sizes):
        for place in range(abs(size)):
            left = codes[:, c] <= place if size > 0 else codes[:, c] == place
            gain = purity(left) + purity(~left) - purity(everything)
            if gain > best[0] + 1e-9:
                best = (gain, c, place)
    return best


def test_histograms_give_the_best_split_of_every_node():
    random = np.random.default_rng(1)
    sizes = [7, -4, 3, -2]
    codes = np.stack([random.integers(0, abs(s), 300) for s in sizes], axis=1)
    y, node, weight = random.integers(0, 2, 300), random.integers(0, 5, 300), random.integers(0, 4, 300).astype(float)
    hist = [np.bincount((node * abs(s) + codes[:, c]) * 2 + y, weight, 5 * abs(s) * 2).reshape(5, abs(s), 2) for c, s in enumerate(sizes)]
    column, place, gain = resampling.best_splits(hist, sizes, resampling.split_columns(sizes), random)
    for n in range(5):
        mine = node == n
        wanted = plain_split(codes[mine], y[mine], weight[mine], sizes)
        assert np.isclose(gain[n], wanted[0]) and (column[n], place[n]) == wanted[1:]


def test_bins_are_counted_where_a_column_is_tried():
    random = np.random.default_rng(6)
    sizes = [6, -3, 5]
    codes = np.stack([random.integers(0, abs(s), 200) for s in sizes], axis=1)
    node, y = random.integers(0, 40, 200), random.integers(0, 2, 200)
    hist = [np.bincount((node * abs(s) + codes[:, c]) * 2 + y, None, 40 * abs(s) * 2).reshape(40, abs(s), 2).astype(float) for c, s in enumerate(sizes)]
    asked = []

    def counted(c, some):
        asked.append(len(some))
        return hist[c][some]

    want = resampling.best_splits(hist, sizes, 1, np.random.default_rng(7))
    got = resampling.best_splits(counted, sizes, 1, np.random.default_rng(7), hist[0].sum(axis=1))
    assert all((a == b).all() for a, b in zip(want, got))
    mixed = (hist[0].sum(axis=1) > 0).all(axis=1).sum()
    assert sum(asked) == mixed < 40


def test_few_columns_are_tried_at_random():
    random = np.random.default_rng(2)
    sizes = [4, -3, 5]
    hist = [random.integers(1, 20, (2000, abs(s), 2)).astype(float) for s in sizes]
    total = hist[0].sum(axis=1)
    hist = [h * (total[:, None] / h.sum(axis=1)[:, None]) for h in hist]
    column, _, _ = resampling.best_splits(hist, sizes, 1, random)
    # one of five columns of the model matrix: a number counts once, a factor once per level
    assert abs((column == 1).mean() - 3 / 5) < 0.05
    assert resampling.columns_to_try("2", 21) == 2 and resampling.columns_to_try("0.5", 21) == 11 and resampling.columns_to_try("1.0", 21) == 21


def test_votes_learn_and_see_no_held_out_row():
    random = np.random.default_rng(3)
    sizes = [16, 16, -3]
    codes = np.stack([random.integers(0, abs(s), 900) for s in sizes], axis=1)
    y = ((codes[:, 0] > 7) ^ (codes[:, 2] == 1)).astype(int)
    held = np.arange(900) % 5 == 0
    args = (held, sizes, 3, 15)
    yes = resampling.votes(codes, y, *args, np.random.default_rng(4), 30)
    assert ((2 * yes > 15) == (y[held] == 1)).mean() > 0.97
    turned = np.where(held, 1 - y, y)
    assert (resampling.votes(codes, turned, *args, np.random.default_rng(4), 30) == yes).all()
    # no depth: every tree says what its bootstrap has more of
    assert set(resampling.votes(codes, np.zeros(900, int), *args, np.random.default_rng(4), 0)) == {0.0}


def frame(spark, n, seed=5):
    random = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = float(random.integers(100)), None if i % 7 == 0 else "xyz"[random.integers(3)], float(random.normal())
        rows.append((i, a, c, b, int((a > 60) != (b == "x"))))
    return spark.createDataFrame(rows, "id long, a double, c double, b string, yes int")


def accuracy(spark, df, **options):
    found = resampling.resampled_accuracy(df, ["a", "c"], ["b"], "yes", 1, ["id"], ["1", "1.0"], trees=9, **options)
    return {r.columns: r for r in found.collect()}


def test_all_resamples_in_one_job(spark):
    df = frame(spark, 700)
    found = accuracy(spark, df, folds=5, repeats=3)
    assert {r.resamples for r in found.values()} == {15} and found["1.0"].place == 1
    assert found["1.0"].accuracy > 0.97 and found["1.0"].accuracy >= found["1"].accuracy > 0.6
    again = accuracy(spark, df.repartition(7), folds=5, repeats=3)
    assert all(np.isclose(again[k].accuracy, found[k].accuracy) for k in found)


def test_bounds_and_few_rows(spark):
    with pytest.raises(ValueError, match="more than 50"):
        accuracy(spark, frame(spark, 60), most_rows=50)
    # a fold without rows is no resample
    assert all(r.resamples <= 6 for r in accuracy(spark, frame(spark, 3), folds=3, repeats=2).values())
    assert accuracy(spark, frame(spark, 3).where("false"), folds=2, repeats=1) == {}


def test_there_is_room_for_a_task_per_resample(spark):
    """Hashes fill the partitions unevenly: with two to a core, the fullest kept the others waiting."""
    found = resampling.resampled_accuracy(frame(spark, 60), ["a"], ["b"], "yes", 1, ["id"], ["1"], trees=1, folds=10, repeats=3)
    assert re.search(r"hashpartitioning\(part#\d+, 30\)", found._jdf.queryExecution().executedPlan().toString())


def test_the_query_grows_whole_forests(spark, tmp_path, monkeypatch):
    """Twenty trees were grown for each of the reference's 500."""
    rows = frame(spark, 10).withColumn("in_train", F.lit(True))
    monkeypatch.setattr(catalog, "_facts", lambda site: rows)
    monkeypatch.setattr(catalog, "_split", lambda facts: facts)
    asked = []
    monkeypatch.setattr(classifier, "resampled_accuracy", lambda df, *args: asked.append(args))
    catalog.QUERIES["tote_resampling"](spark, str(tmp_path))
    tries, folds, repeats, trees = asked[0][5:9]
    assert (tries, folds, repeats, trees) == (("2", "0.5", "1.0"), 10, 10, 500)
