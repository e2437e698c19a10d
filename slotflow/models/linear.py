"""Partial least squares, and what linear fits share: sums of products per fold, ridge, selection of terms.

A model is fitted and tuned from one pass over the training rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from slotflow.models.design import KEY, prepare_rows
from slotflow.models.fitted import Regressor
from slotflow.models.knn import fold_numbers

COMPONENTS = (1, 2, 3)  # fixed values: the candidates for the number of components

Line = tuple[float, np.ndarray]


def fold_sums(
    train: DataFrame, folds: int, repeats: int, seed: int, basis: Callable[[np.ndarray], np.ndarray] = lambda x: x
) -> dict[int, np.ndarray]:
    """Per fold the sums of products of (1, basis of x, label) over its rows.

    Each task adds up its own rows and sends a matrix per fold; a second step adds those of a fold, one after
    the other. The driver gets one matrix per fold.
    """

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.empty:
                continue
            x = basis(np.stack(batch["x"].to_numpy()))
            rows = np.column_stack([np.ones(len(batch)), x, batch["label"].to_numpy()])
            held = np.stack(batch["held"].to_numpy())
            for number in np.unique(held):
                mine = rows[(held == number).any(axis=1)]
                sums[int(number)] = sums.get(int(number), 0) + mine.T @ mine
        for number, matrix in sums.items():
            yield pd.DataFrame({"fold": [number], "cells": [matrix.ravel()]})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, cells in zip(batch["fold"], batch["cells"]):
                sums[int(number)] = sums.get(int(number), 0) + np.asarray(cells)
        for number, cells in sums.items():
            yield pd.DataFrame({"fold": [number], "cells": [cells]})

    schema = "fold int, cells array<double>"
    partial = train.select("x", "label", fold_numbers(folds, repeats, seed).alias("held")).mapInPandas(add_up, schema)
    rows = partial.repartition("fold").mapInPandas(meet, schema).collect()
    side = {r.fold: round(len(r.cells) ** 0.5) for r in rows}
    return {r.fold: np.array(r.cells).reshape(side[r.fold], side[r.fold]) for r in rows}


def _scaled(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations (1 for a constant column), and sums of products of the centred, scaled columns."""
    n, means = sums[0, 0], sums[0, 1:] / sums[0, 0]
    centred = sums[1:, 1:] - n * np.outer(means, means)
    squares = np.maximum(np.diag(centred), 0)
    varies = squares > 1e-10 * np.maximum(np.diag(sums)[1:], 1e-300)
    spreads = np.where(varies, np.sqrt(squares / max(n - 1, 1)), 1.0)
    spreads[-1] = 1.0
    centred = np.where(np.outer(varies, varies), centred, 0.0)
    return means, spreads, centred / np.outer(spreads, spreads)


def _line(means: np.ndarray, spreads: np.ndarray, slopes: np.ndarray) -> Line:
    slopes = slopes / spreads[:-1]
    return means[-1] - means[:-1] @ slopes, slopes


def pls_coefficients(sums: np.ndarray, components: int) -> Line:
    """Intercept and slopes from sums of products; columns are scaled by these rows.

    Partial least squares of one response is least squares within the space spanned by
    s, Gs, GGs, ... of the centred products G of the columns and s with the response.
    """
    means, spreads, centred = _scaled(sums)
    gram, s = centred[:-1, :-1], centred[:-1, -1]
    basis: list[np.ndarray] = []
    direction = s
    for _ in range(components):
        for b in basis + basis:
            direction = direction - b * (b @ direction)
        size = np.linalg.norm(direction)
        if size <= 1e-10 * max(1.0, np.linalg.norm(s)):
            break
        basis.append(direction / size)
        direction = gram @ basis[-1]
    if not basis:
        return means[-1], np.zeros(len(s))
    v = np.column_stack(basis)
    return _line(means, spreads, v @ np.linalg.lstsq(v.T @ gram @ v, v.T @ s, rcond=None)[0])


def ridge_coefficients(sums: np.ndarray, cost: float) -> Line:
    """Intercept and slopes that minimise cost times the squared errors plus half the squared slopes."""
    n, means = sums[0, 0], sums[0, 1:] / sums[0, 0]
    centred = sums[1:, 1:] - n * np.outer(means, means)
    slopes = np.linalg.solve(centred[:-1, :-1] + np.eye(len(means) - 1) / (2 * cost), centred[:-1, -1])
    return means[-1] - means[:-1] @ slopes, slopes


def term_path(sums: np.ndarray, most: int, least_gain: float = 1e-3) -> dict[int, list[int]]:
    """For each number of terms the ones kept: added one by one where they help most, then dropped where they help least."""
    _, _, centred = _scaled(sums)
    left, total, chosen = centred.copy(), centred[-1, -1], []
    while len(chosen) < min(most, len(centred) - 1):
        room = np.diag(left)[:-1]
        free = room > 1e-8 * np.maximum(np.diag(centred)[:-1], 1e-300)
        free[chosen] = False
        gains = np.where(free, left[:-1, -1] ** 2 / np.where(free, room, 1), -1)
        best = int(np.argmax(gains))
        if gains[best] <= least_gain * max(total, 1e-300):
            break
        chosen.append(best)
        left = left - np.outer(left[:, best], left[best]) / left[best, best]
    path = {len(chosen): list(chosen)}
    while chosen:
        inverse = np.linalg.pinv(centred[np.ix_(chosen, chosen)])
        slopes = inverse @ centred[chosen, -1]
        chosen.pop(int(np.argmin(slopes**2 / np.maximum(np.diag(inverse), 1e-300))))
        path[len(chosen)] = list(chosen)
    return path


def term_coefficients(sums: np.ndarray, terms: int, most: int = 21) -> Line:
    """Least squares on the ``terms`` selected columns; the others get a slope of 0."""
    means, spreads, centred = _scaled(sums)
    path = term_path(sums, most)
    kept = path[min(terms, max(path))]
    slopes = np.zeros(len(means) - 1)
    if kept:
        slopes[kept] = np.linalg.lstsq(centred[np.ix_(kept, kept)], centred[kept, -1], rcond=None)[0]
    return _line(means, spreads, slopes)


def held_out_error(sums: np.ndarray, intercept: float, slopes: np.ndarray) -> float:
    weights = np.concatenate([[-intercept], -slopes, [1.0]])
    return float(np.sqrt(max(0.0, weights @ sums @ weights) / sums[0, 0]))


def tuning(sums: dict[int, np.ndarray], folds: int, fit: Callable[[np.ndarray, float], Line], candidates: Sequence) -> dict:
    """Mean held-out error per candidate; training sums are the total less the fold."""
    totals: dict[int, np.ndarray] = {}
    for number, held in sums.items():
        totals[number // folds] = totals.get(number // folds, 0) + held
    errors = {}
    for candidate in candidates:
        scores = [
            held_out_error(held, *fit(totals[number // folds] - held, candidate))
            for number, held in sums.items()
            if held[0, 0] and (totals[number // folds] - held)[0, 0] > 0.5
        ]
        errors[candidate] = float(np.mean(scores)) if scores else float("inf")
    return errors


def _tuned(sums: dict[int, np.ndarray], folds: int, fit: Callable[[np.ndarray, float], Line], candidates: Sequence) -> Line:
    """The line of all rows, by the first of the candidates with the smallest error."""
    candidate = candidates[0]
    if len(candidates) > 1:
        errors = tuning(sums, folds, fit, candidates)
        candidate = min(candidates, key=lambda c: (errors[c], candidates.index(c)))
    return fit(sum(s for f, s in sums.items() if f < folds), candidate)


def pls_fit(train: DataFrame, components: int | None = None, folds: int = 10, repeats: int = 3, seed: int = 101) -> Regressor:
    """Partial least squares; without ``components`` they are tuned, scaled anew within each fold."""
    problem = prepare_rows(train)
    sums = fold_sums(problem.train, folds, repeats, seed)
    intercept, slopes = _tuned(sums, folds, pls_coefficients, COMPONENTS if components is None else (components,))
    return Regressor("pls", problem.design, problem.scale, {"intercept": float(intercept), "slopes": [float(b) for b in slopes]})


def predicted(model: Regressor, asked: DataFrame) -> DataFrame:
    slopes = model.values["slopes"]
    terms = " + ".join([f"({model.values['intercept']!r}D)"] + [f"x[{i}] * ({b!r}D)" for i, b in enumerate(slopes)])
    return asked.select(F.col("id").alias(KEY), F.expr(terms).alias("prediction"))


def pls_forecast(train: DataFrame, features: DataFrame, **options) -> DataFrame:
    """[prod_id, prediction] by ``pls_fit`` of ``train``."""
    return pls_fit(train, **options).predict(features)
