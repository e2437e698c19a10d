"""Ridge regression on factors of very many levels, by sweeps over the factors.

No model matrix and no list of levels: an effect per level is a row of a table, found by grouping and brought back by a join. Rows
shrink first to sums per combination of levels, so a hot combination is one row. Numbers and the mean are not penalised; they take
the normal equations of a few columns, which is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from slotflow.functions.joins import join_null_safe
from slotflow.session import materialize


@dataclass(frozen=True)
class LevelFit:
    """Mean and slopes of the numbers, and for each factor a table [level, rows, effect]."""

    numbers: tuple[str, ...]
    factors: tuple[str, ...]
    slopes: tuple[float, ...]
    effects: tuple[DataFrame, ...]
    sweeps: int


def _number(name: str) -> Column:
    """A missing number stops the job."""
    return F.expr(f"coalesce(cast(`{name}` as double), cast(raise_error('missing value in {name}') as double))")


def _total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns, F.lit(0.0))


def fit_levels(
    train: DataFrame, label: str, numbers: Sequence[str], factors: Sequence[str], penalty: float = 1.0, most_sweeps: int = 20, tolerance: float = 1e-6
) -> LevelFit:
    """The least squares with ``penalty`` times the squared effects, to ``tolerance`` in every effect or ``most_sweeps`` sweeps.

    A missing level is a level. In each sweep the slopes are solved given the effects, then each factor's effects, together with the
    mean, given the rest: with one factor and no numbers the first sweep is exact. A sweep shuffles the combinations once per factor.
    """
    if penalty <= 0 or not factors:
        raise ValueError("a positive penalty and at least one factor")
    width, names = len(numbers) + 1, [f"f{i}" for i in range(len(factors))]
    cells = [F.lit(1.0), *[_number(n) for n in numbers]]
    rows = train.select(
        _number(label).alias("y"), F.array(*cells).alias("z"), *[F.col(f).cast("string").alias(n) for f, n in zip(factors, names)]
    )
    sums = [F.sum(F.col("z")[i]).alias(f"z{i}") for i in range(width)]
    table = rows.groupBy(*names).agg(F.sum("y").alias("y"), F.array(*sums).alias("z"))
    table = materialize(table.select("*", *[F.lit(0.0).alias(f"e{i}") for i in range(len(names))]))
    if table.isEmpty():
        raise ValueError("no rows")
    products = [F.sum(F.col("z")[i] * F.col("z")[j]) for i in range(width) for j in range(width)]
    found = rows.agg(F.array(*products).alias("gram"), F.array(*[F.sum(F.col("z")[i] * F.col("y")) for i in range(width)]).alias("right")).first()
    gram, right = np.array(found["gram"]).reshape(width, width), np.array(found["right"])

    effects: list[DataFrame | None] = [None] * len(names)
    done = 0
    for sweep in range(most_sweeps):
        every = _total([F.col(f"e{i}") for i in range(len(names))])
        held = table.agg(F.array(*[F.sum(F.col("z")[i] * every) for i in range(width)]).alias("held")).first()["held"]
        slopes = np.linalg.lstsq(gram, right - np.array(held), rcond=None)[0]
        moved = 0.0
        for i, name in enumerate(names):
            others = _total([F.col(f"e{j}") for j in range(len(names)) if j != i])
            fitted = _total([F.col("z")[j] * float(s) for j, s in enumerate(slopes)])
            left = F.sum(F.col("y") - fitted - F.col("z")[0] * others).alias("left")
            n = F.sum(F.col("z")[0]).alias("n")
            levels = materialize(table.groupBy(name).agg(left, n, F.first(f"e{i}").alias("was")))
            # what the penalty keeps from the effects belongs to the mean
            share = F.lit(penalty) / (F.col("n") + penalty)
            shift = levels.agg(F.sum(share * F.col("left")) / F.sum(share * F.col("n"))).first()[0]
            slopes[0] += shift
            effect = ((F.col("left") - F.col("n") * shift) / (F.col("n") + penalty)).alias(f"e{i}")
            new = levels.select(name, effect, "was", "n")
            moved = max(moved, new.agg(F.max(F.abs(F.col(f"e{i}") - F.col("was")))).first()[0])
            effects[i] = new.select(F.col(name).alias("level"), F.col("n").cast("long").alias("rows"), F.col(f"e{i}").alias("effect"))
            table = join_null_safe(table.drop(f"e{i}"), new.select(name, f"e{i}"), [name])
            table = materialize(table)
        done = sweep + 1
        if moved <= tolerance or (len(names) == 1 and width == 1):
            break
    return LevelFit(tuple(numbers), tuple(factors), tuple(float(s) for s in slopes), tuple(effects), done)


def predict_levels(fit: LevelFit, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction``; a level that was not there to fit has no effect."""
    known = _total([F.lit(fit.slopes[0]), *[_number(n) * s for n, s in zip(fit.numbers, fit.slopes[1:])]])
    levels = [F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fit.factors)]
    rows = df.select(F.struct("*").alias("_row"), known.alias("_known"), *levels)
    for i, effects in enumerate(fit.effects):
        rows = join_null_safe(rows, effects.select(F.col("level").alias(f"f{i}"), F.col("effect").alias(f"e{i}")), [f"f{i}"], "left")
    total = F.col("_known") + _total([F.coalesce(F.col(f"e{i}"), F.lit(0.0)) for i in range(len(fit.factors))])
    return rows.select("_row.*", total.alias("prediction"))
