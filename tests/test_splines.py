"""The knot search against plain least squares."""

from __future__ import annotations

import numpy as np
from test_models import SCHEMA, make_rows
from test_radial import labelled

from slotflow.models import splines


def left_over(x, y, terms):
    w = np.column_stack([np.ones(len(x)), splines.hinges(x, terms)])
    return ((y - w @ np.linalg.lstsq(w, y, rcond=None)[0]) ** 2).sum()


def test_sums_judge_every_knot_like_least_squares():
    random = np.random.default_rng(1)
    x = random.normal(0, 1, (400, 3))
    x[:, 2] = x[:, 2] > 0
    y = np.maximum(x[:, 0] - 0.3, 0) * 4 + x[:, 2] + random.normal(0, 0.3, 400)
    grid = [np.quantile(x[:, 0], np.linspace(0, 1, 20)[:-1], method="lower"), np.quantile(x[:, 1], np.linspace(0, 1, 20)[:-1], method="lower"), np.array([0.0])]
    for terms in ([], [(0, float(grid[0][9]), 1), (0, float(grid[0][9]), -1)]):
        cells = sum(splines.step_sums(x[i::3], y[i::3], terms, grid) for i in range(3))
        column, knot, gain = splines.best_pair(cells, len(terms), grid)
        before, best = left_over(x, y, terms), None
        for c, knots in enumerate(grid):
            for t in knots:
                above = (x[:, c] > t).sum()
                if c == 2 or splines.END_ROWS <= above <= 400 - splines.END_ROWS:
                    gained = before - left_over(x, y, [*terms, (c, t, 1), (c, t, -1)])
                    best = max(best or (0, 0, 0), (gained, c, t))
        assert (int(column), knot) == best[1:] and np.isclose(gain * ((y - y.mean()) ** 2).sum(), best[0])


def test_planted_knots_are_found(spark):
    random = np.random.default_rng(4)
    x = random.uniform(-2, 2, (4000, 4))
    y = 5 * np.maximum(x[:, 1] - 0.7, 0) - 3 * np.maximum(-0.9 - x[:, 2], 0) + 2 * x[:, 3] + random.normal(0, 0.2, 4000)
    rows = labelled(spark, x, y).cache()
    grid = splines.knot_grid(rows, 4)
    assert all(60 <= len(knots) <= 65 for knots in grid)
    found = splines.knot_search(rows, [-1, 2], grid, pairs=4)
    for terms in found.values():
        knots = {column: knot for column, knot, side in reversed(terms) if side == 1}
        assert abs(knots[1] - 0.7) < 0.08 and abs(knots[2] + 0.9) < 0.08 and 3 in knots and 0 not in knots


def test_folds_are_searched_on_their_own_rows(spark):
    """A problem's knots are those of a search over its rows alone."""
    random = np.random.default_rng(5)
    x = random.normal(0, 1, (600, 2))
    y = np.abs(x[:, 0]) + random.normal(0, 0.1, 600)
    rows = labelled(spark, x, y, folds=3).cache()
    grid = splines.knot_grid(rows, 2)
    together = splines.knot_search(rows, [-1, 0, 1, 2], grid, pairs=2)
    alone = splines.knot_search(rows.filter("held[0] != 1"), [-1], grid, pairs=2)
    assert together[1] == alone[-1] and together[1] != []


def test_few_rows_and_flat_labels_give_the_mean(spark):
    flat = spark.createDataFrame([(*r[:-1], 7) for r in make_rows(40, 1, "t")], SCHEMA)
    model = splines.hinge_fit(flat, folds=3, repeats=1)
    assert model.values["terms"] == [] and abs(model.values["intercept"] - 7) < 1e-9
    assert {round(r.prediction, 6) for r in model.predict(flat).collect()} == {7.0}
    few = spark.createDataFrame(make_rows(5, 2, "t"), SCHEMA)
    assert splines.hinge_fit(few, folds=3, repeats=1).predict(few).count() == 5
