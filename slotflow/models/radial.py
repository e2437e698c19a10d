"""A radial support-vector regression, fitted over tables.

Random Fourier features stand for the kernel. Errors within a tube cost nothing and beyond it in proportion, as in a support-vector
regression: far outliers pull with the same force as near ones. The fit is a row of weighted least squares: each round bounds the
cost of every row by a parabola that touches it at the present error, and the sum of the parabolas is minimised from normal
equations. The cost never rises from one round to the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from slotflow.functions.columns import key_hash
from slotflow.models.design import KEY, prepare_rows
from slotflow.models.fitted import Regressor
from slotflow.models.knn import fold_numbers
from slotflow.models.linear import fold_sums, held_out_error, ridge_coefficients
from slotflow.models.sums import problem_sums
from slotflow.session import materialize

COSTS = (0.25, 0.5, 1.0)  # fixed values: the candidates for the cost of an error
LOSSES = ("tube", "squares")  # candidates for the loss
TUBE = 0.1  # fixed value: half the width of the tube, in deviations of the label
SMOOTH = 1e-3  # errors of the parabolas are at least this large, in the same unit
ROUNDS, ENOUGH = 25, 1e-3  # rounds at most, and the relative gain that ends them
PAIR_ROWS = 2000  # rows whose pair distances give the kernel width


def pair_sample(rows: DataFrame, size: int = PAIR_ROWS, seed: int = 101) -> np.ndarray:
    """The ``size`` rows with the least hashes: of two parts' samples the least are that of both, so tasks send few rows."""
    found = rows.select("x", key_hash(seed, ["id"]).alias("at"), "id").orderBy("at", "id").limit(size).collect()
    return np.array([row.x for row in found], float)


def kernel_width(sample: np.ndarray) -> float:
    """The factor of squared distances in the kernel: the mean of the inverses of their 10% and 90% quantiles."""
    squares = (sample**2).sum(axis=1)
    far = (squares[:, None] + squares - 2 * sample @ sample.T)[np.triu_indices(len(sample), 1)]
    far = far[far > 1e-12]
    return float((1 / np.quantile(far, [0.1, 0.9])).mean()) if len(far) else 1.0


def waves(x: np.ndarray, size: int, gamma: float, seed: int) -> np.ndarray:
    """Random Fourier features of a radial kernel."""
    random = np.random.default_rng(seed)
    weights, shifts = random.normal(0, np.sqrt(2 * gamma), (x.shape[1], size)), random.uniform(0, 2 * np.pi, size)
    return np.sqrt(2 / size) * np.cos(x @ weights + shifts)


def tube_cost(errors: np.ndarray) -> np.ndarray:
    return np.maximum(np.abs(errors) - TUBE, 0)


def parabolas(errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight and centre of the parabola above the cost that touches it at each error.

    The cost is half the sum of the distances to both sides of the tube, less its half width, and each distance d is at most
    (d * d / s + s) / 2, with equality where s = d.
    """
    above = 1 / (4 * np.maximum(np.abs(errors - TUBE), SMOOTH))
    below = 1 / (4 * np.maximum(np.abs(errors + TUBE), SMOOTH))
    return above + below, TUBE * (above - below) / (above + below)


def weighted_fit(sums: np.ndarray, cost: float) -> np.ndarray:
    """Intercept and slopes that minimise cost times the weighted squares plus half the squared slopes."""
    penalty = np.eye(len(sums) - 1)
    penalty[0, 0] = 0
    return np.linalg.solve(2 * cost * sums[:-1, :-1] + penalty, 2 * cost * sums[:-1, -1])


def fitted_on(sums: dict[int, np.ndarray], fold: int, folds: int) -> np.ndarray:
    """Sums of the rows that a fit sees: all of them (-1), or those outside a fold."""
    whole = sum(s for f, s in sums.items() if f // folds == max(fold, 0) // folds)
    return whole if fold < 0 else whole - sums[fold]


def robust_lines(
    rows: DataFrame, problems: Sequence[tuple[int, float]], sums: dict[int, np.ndarray], folds: int, size: int, gamma: float, seed: int
) -> tuple[list[np.ndarray], list[list[float]]]:
    """For each problem (fold left out or -1, cost) its line, intercept first, and the total costs round by round.

    All problems take each pass over the rows together. They start from squared errors; labels are scaled by the problem's rows.
    """
    scales, lines = [], []
    for fold, cost in problems:
        own = fitted_on(sums, fold, folds)
        mean = own[0, -1] / own[0, 0]
        spread = float(np.sqrt(max((own[-1, -1] - own[0, 0] * mean**2) / max(own[0, 0] - 1, 1), 0))) or 1.0
        intercept, slopes = ridge_coefficients(own, cost)
        scales.append((mean, spread))
        lines.append(np.concatenate([[intercept - mean], slopes]) / spread)

    costs: list[list[float]] = [[] for _ in problems]
    going = set(range(len(problems)))
    for _ in range(ROUNDS):
        now = list(lines)

        def measure(x: np.ndarray, y: np.ndarray, held: np.ndarray, some=sorted(going), now=now) -> Iterator[tuple[int, np.ndarray]]:
            z = np.column_stack([np.ones(len(x)), waves(x, size, gamma, seed)])
            full = np.empty((len(z), size + 2))
            for p in some:
                fold, (mean, spread) = problems[p][0], scales[p]
                mine = ~(held == fold).any(axis=1)
                target = (y - mean) / spread
                errors = target - z @ now[p]
                weight, centre = parabolas(errors)
                # rows that are left out weigh nothing; roots of the weights make the product one of a matrix with itself, half the work
                root = np.sqrt(np.where(mine, weight, 0))
                np.multiply(z, root[:, None], out=full[:, :-1])
                full[:, -1] = (target - centre) * root
                yield p, np.append(full.T @ full, tube_cost(errors[mine]).sum())

        for p, cells in problem_sums(rows, measure).items():
            side, cost = size + 2, problems[p][1]
            total = cost * cells[-1] + 0.5 * (now[p][1:] ** 2).sum()
            if costs[p] and total > costs[p][-1] * (1 - ENOUGH):
                going.discard(p)
            costs[p].append(float(total))
            lines[p] = weighted_fit(cells[:-1].reshape(side, side), cost)
        if not going:
            break
    unscaled = [np.concatenate([[m + s * line[0]], s * line[1:]]) for line, (m, s) in zip(lines, scales)]
    return unscaled, costs


def rbf_fit(
    train: DataFrame, size: int = 200, gamma: float | None = None, costs: Sequence[float] = COSTS, losses: Sequence[str] = LOSSES,
    folds: int = 10, repeats: int = 1, seed: int = 101,
) -> Regressor:
    """Loss and cost are tuned together by cross-validation; ``gamma`` comes from a sample's pair distances unless given.

    "tube" is the loss of a support-vector regression, which aims at the middle of the labels and shrugs off outliers; "squares" aims
    at their mean, which is what counts where few products make most of the demand.
    """
    problem = prepare_rows(train)
    rows = materialize(problem.train.withColumn("held", fold_numbers(folds, repeats, seed)))
    gamma = kernel_width(pair_sample(rows, seed=seed)) if gamma is None else gamma
    sums = fold_sums(rows, folds, repeats, seed, lambda x: waves(x, size, gamma, seed))
    candidates = [(loss, cost) for loss in losses for cost in costs]
    best = candidates[0]
    if len(candidates) > 1:
        errors: dict[tuple[str, float], list[float]] = {c: [] for c in candidates}
        rest = {f: fitted_on(sums, f, folds) for f in sums}
        # a fold that holds all rows of a repeat leaves none to fit on
        problems = [(fold, cost) for cost in costs for fold in sums if rest[fold][0, 0] > 1.5]
        for fold, cost in problems:
            if "squares" in losses:
                errors["squares", cost].append(held_out_error(sums[fold], *ridge_coefficients(rest[fold], cost)))
        if "tube" in losses:
            for (fold, cost), line in zip(problems, robust_lines(rows, problems, sums, folds, size, gamma, seed)[0]):
                errors["tube", cost].append(held_out_error(sums[fold], line[0], line[1:]))
        best = min(candidates, key=lambda c: (np.mean(errors[c]) if errors[c] else 0.0, candidates.index(c)))
    loss, cost = best
    if loss == "tube":
        (line,), _ = robust_lines(rows, [(-1, cost)], sums, folds, size, gamma, seed)
    else:
        intercept, slopes = ridge_coefficients(fitted_on(sums, -1, folds), cost)
        line = np.concatenate([[intercept], slopes])
    values = {"line": line.tolist(), "gamma": gamma, "size": size, "seed": seed, "loss": loss, "cost": cost}
    return Regressor("svm", problem.design, problem.scale, values)


def predicted(model: Regressor, asked: DataFrame) -> DataFrame:
    values, line = model.values, np.array(model.values["line"])

    @F.pandas_udf("double")
    def predict(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        return pd.Series(line[0] + waves(np.stack(x.to_numpy()), values["size"], values["gamma"], values["seed"]) @ line[1:])

    return asked.select(F.col("id").alias(KEY), predict("x").alias("prediction"))


def rbf_forecast(train: DataFrame, features: DataFrame, **options) -> DataFrame:
    """[prod_id, prediction] by ``rbf_fit`` of ``train``."""
    return rbf_fit(train, **options).predict(features)
