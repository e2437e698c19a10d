"""Adaptive splines: hinges whose knots are searched.

Forward, pairs of hinges are added one by one: the column and knot whose pair explains most of what is left. Backward, hinges are
dropped where that costs least; how many stay is tuned. A step judges all knots of all columns from sums per bin between
neighbouring knots: those of the rows above a knot are running sums over the bins, and with x, x * x and the products with the
present terms they give each hinge's products exactly. All resamples take each pass over the rows together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from slotflow.models.design import KEY, prepare_rows
from slotflow.models.fitted import Regressor
from slotflow.models.knn import fold_numbers
from slotflow.models.linear import held_out_error, term_coefficients
from slotflow.models.sums import problem_sums
from slotflow.session import materialize

TERMS = (2, 7, 13, 21)  # candidates for the number of hinges kept
GRID = 64  # knots per column
PAIRS = 10  # pairs added at most
LEAST_GAIN = 1e-3  # of the label's variance, for one more pair
END_ROWS = 12  # rows that a knot leaves on each side, at least

#: Column, knot and side: 1 for what is above, -1 for what is below.
Term = tuple[int, float, int]


def hinges(x: np.ndarray, terms: Sequence[Term]) -> np.ndarray:
    return np.column_stack([np.maximum(side * (x[:, column] - knot), 0) for column, knot, side in terms]) if terms else np.zeros((len(x), 0))


def knot_grid(rows: DataFrame, width: int, grid: int = GRID) -> list[np.ndarray]:
    """For each column up to ``grid`` of its values, evenly spread over the rows."""
    shares = F.array(*[F.lit((i + 1) / (grid + 1)) for i in range(grid)])
    # the least value as well: a hinge there is a straight line
    found = rows.agg(*[F.array_union(F.array(F.min(F.col("x")[i])), F.percentile_approx(F.col("x")[i], shares, 10_000)).alias(f"x{i}") for i in range(width)])
    row = found.first()
    return [np.array(sorted(set(row[i]))) if row[i] and row[i][0] is not None else np.zeros(0) for i in range(width)]


def bin_sums(values: np.ndarray, bins: np.ndarray, number: int) -> np.ndarray:
    """Per bin the sums of each column of ``values``."""
    columns = values.shape[1]
    cells = (bins[:, None] * columns + np.arange(columns)).ravel()
    return np.bincount(cells, values.ravel(), number * columns).reshape(number, columns)


def step_sums(x: np.ndarray, y: np.ndarray, terms: Sequence[Term], grid: list[np.ndarray]) -> np.ndarray:
    """What a step needs of some rows, as one array: products of (1, terms, label), then per column and bin their sums, those with x, and x * x."""
    w = np.column_stack([np.ones(len(x)), hinges(x, terms), y])
    out = [(w.T @ w).ravel()]
    for column, knots in enumerate(grid):
        own = x[:, [column]]
        # bin i holds what is above i of the knots
        out.append(bin_sums(np.hstack([w, own * w, own * own]), np.searchsorted(knots, x[:, column]), len(knots) + 1).ravel())
    return np.concatenate(out)


def best_pair(cells: np.ndarray, number: int, grid: list[np.ndarray]) -> np.ndarray:
    """Column, knot and relative gain of the best pair to add to ``number`` terms; gain 0 if there is none."""
    m = number + 1
    products, at = cells[: (m + 1) ** 2].reshape(m + 1, m + 1), (m + 1) ** 2
    inverse = np.linalg.pinv(products[:m, :m], rcond=1e-11, hermitian=True)
    with_y = products[:m, m]
    total = products[m, m] - products[0, m] ** 2 / max(products[0, 0], 1e-300)
    best = np.array([0.0, 0.0, 0.0])
    for column, knots in enumerate(grid):
        size = (len(knots) + 1) * (2 * m + 3)
        bins, at = cells[at : at + size].reshape(len(knots) + 1, 2 * m + 3), at + size
        if not len(knots):
            continue
        full = bins.sum(axis=0)
        above = np.cumsum(bins[::-1], axis=0)[::-1][1:]
        ones, xs, squares, t = above[:, : m + 1], above[:, m + 1 : 2 * m + 2], above[:, -1], knots
        # products of each hinge (x - t)+ with terms and label, itself and x, then of x
        hw = xs - t[:, None] * ones
        hh, hx = squares - 2 * t * xs[:, 0] + t * t * ones[:, 0], squares - t * xs[:, 0]
        xw, xx = full[m + 1 : 2 * m + 2], full[-1]
        # what the present terms leave of them
        h_left, x_left = hw[:, :m] @ inverse, xw[:m] @ inverse
        s_hh = hh - (h_left * hw[:, :m]).sum(axis=1)
        s_hx = hx - h_left @ xw[:m]
        s_xx = xx - x_left @ xw[:m]
        g_h, g_x = hw[:, m] - h_left @ with_y, xw[m] - x_left @ with_y
        straight = s_xx > 1e-9 * max(xx, 1e-300)
        line = g_x**2 / s_xx if straight else 0.0
        # the hinge beside the line, or alone where the line is there already
        left, pull = (s_hh - s_hx**2 / s_xx, g_h - s_hx * g_x / s_xx) if straight else (s_hh, g_h)
        counts = ones[:, 0]
        bends = (left > 1e-9 * np.maximum(hh, 1e-300)) & (counts >= END_ROWS) & (full[0] - counts >= END_ROWS)
        gains = line + np.where(bends, pull**2 / np.where(bends, left, 1), 0)
        found = int(gains.argmax())
        if gains[found] > best[2] * max(total, 1e-300):
            best = np.array([column, knots[found], gains[found] / max(total, 1e-300)])
    return best


def knot_search(rows: DataFrame, problems: Sequence[int], grid: list[np.ndarray], pairs: int = PAIRS) -> dict[int, list[Term]]:
    """For each problem, a fold left out or -1, the hinges found, in order."""
    terms: dict[int, list[Term]] = {p: [] for p in problems}
    going = set(problems)
    for _ in range(pairs):
        now = {p: list(terms[p]) for p in sorted(going)}

        def measure(x: np.ndarray, y: np.ndarray, held: np.ndarray, now=now) -> Iterator[tuple[int, np.ndarray]]:
            for p, own in now.items():
                mine = ~(held == p).any(axis=1)
                if mine.any():
                    yield p, step_sums(x[mine], y[mine], own, grid)

        found = problem_sums(rows, measure, lambda p, cells, now=now: best_pair(cells, len(now[p]), grid))
        for p in now:
            column, knot, gain = found.get(p, (0, 0, 0))
            if gain <= LEAST_GAIN:
                going.discard(p)
            else:
                terms[p] += [(int(column), float(knot), 1), (int(column), float(knot), -1)]
        if not going:
            break
    return terms


def hinge_fit(train: DataFrame, terms: Sequence[int] = TERMS, pairs: int = PAIRS, folds: int = 10, repeats: int = 3, seed: int = 101) -> Regressor:
    """Knots are searched, and hinges dropped, anew within each fold; how many stay is tuned by cross-validation."""
    problem = prepare_rows(train)
    rows = materialize(problem.train.withColumn("held", fold_numbers(folds, repeats, seed)))
    grid = knot_grid(rows, problem.design.width)
    problems = [-1, *(range(folds * repeats) if len(terms) > 1 else ())]
    found = knot_search(rows, problems, grid, pairs)

    def measure(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Products of (1, terms, label) over the rows of a problem, and after them those it leaves out."""
        for p, own in found.items():
            w = np.column_stack([np.ones(len(x)), hinges(x, own), y])
            out = (held == p).any(axis=1)
            yield p, np.concatenate([(w[~out].T @ w[~out]).ravel(), (w[out].T @ w[out]).ravel()])

    sums = {p: cells.reshape(2, len(found[p]) + 2, len(found[p]) + 2) for p, cells in problem_sums(rows, measure).items()}
    most = 2 * pairs + 1
    errors = {
        n: [held_out_error(held, *term_coefficients(own, n, most)) for p, (own, held) in sums.items() if p >= 0 and held[0, 0] and own[0, 0]] for n in terms
    }
    best = min(terms, key=lambda n: (np.mean(errors[n]) if errors[n] else 0.0, list(terms).index(n)))
    intercept, slopes = term_coefficients(sums[-1][0], best, most)
    kept = [[*term, float(slope)] for term, slope in zip(found[-1], slopes) if slope]
    return Regressor("earth", problem.design, problem.scale, {"intercept": float(intercept), "terms": kept})


def predicted(model: Regressor, asked: DataFrame) -> DataFrame:
    cells = [f"greatest({side} * (x[{column}] - ({knot!r}D)), 0D) * ({slope!r}D)" for column, knot, side, slope in model.values["terms"]]
    line = " + ".join([f"({model.values['intercept']!r}D)", *cells])
    return asked.select(F.col("id").alias(KEY), F.expr(line).alias("prediction"))


def hinge_forecast(train: DataFrame, features: DataFrame, **options) -> DataFrame:
    """[prod_id, prediction] by ``hinge_fit`` of ``train``."""
    return hinge_fit(train, **options).predict(features)
