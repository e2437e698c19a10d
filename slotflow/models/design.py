"""Model matrix: dummies for factors, centred and scaled columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from slotflow.session import materialize

KEY, LABEL = "prod_id", "sold_rep_units"
FACTORS = ("directorate", "hanging_garment", "sor_indicator", "partner_discount")
NUMBERS = (
    "brom_size",
    "uplb",
    "volume",
    "current_stock",
    "avg_stock_lst7",
    "avg_stock_lst14",
    "avg_stock_lst30",
    "rep_orders_lst7",
    "rep_units_lst7",
    "avg_rep_orders_lst7",
    "avg_rep_units_lst7",
    "avg_rep_orders_lst14",
    "avg_rep_units_lst14",
    "avg_rep_orders_lst30",
    "avg_rep_units_lst30",
    "selling_price",
    "reduction",
)


@dataclass(frozen=True)
class Design:
    """Columns of a model matrix: one per number, one per factor level but the first."""

    numbers: tuple[str, ...]
    dummies: tuple[tuple[str, str], ...]

    @property
    def width(self) -> int:
        return len(self.numbers) + len(self.dummies)

    def row(self) -> Column:
        """The matrix row as an array of doubles. A missing number stops the job."""
        cells = [
            f"coalesce(cast({n} as double), cast(raise_error('missing value in {n}') as double))" for n in self.numbers
        ]
        cells += [f"if(cast({f} as string) <=> {_quoted(level)}, 1D, 0D)" for f, level in self.dummies]
        return F.expr(f"array({', '.join(cells)})")


@dataclass(frozen=True)
class Scale:
    """Centre and spread per column. A constant column has no spread and becomes 0."""

    means: tuple[float, ...]
    spreads: tuple[float, ...]

    def apply(self) -> Column:
        """``x``, centred and scaled."""
        cells = [
            f"(x[{i}] - ({m!r}D)) / {s!r}D" if s > 0 else "0D" for i, (m, s) in enumerate(zip(self.means, self.spreads))
        ]
        return F.expr(f"array({', '.join(cells)})")


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _level_order(level: str):
    try:
        return (0, float(level), level)
    except ValueError:
        return (1, 0.0, level)


def fit_design(
    train: DataFrame, numbers: Sequence[str] = NUMBERS, factors: Sequence[str] = FACTORS, most_levels: int | None = None
) -> Design:
    """Levels as found in ``train``; a level not seen there later counts as the first one.

    The models here hold a square matrix of all columns. A caller whose factors may have many levels can
    set the most that are allowed.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).cast("string").alias("level")) for f in factors]))
    found = train.select(pairs.alias("p")).select("p.*").dropna().distinct()
    found = (found if most_levels is None else found.limit(most_levels + 1)).collect()
    if most_levels is not None and len(found) > most_levels:
        raise ValueError(f"more than {most_levels} factor levels")
    dummies = []
    for factor in factors:
        levels = sorted((r.level for r in found if r.factor == factor), key=_level_order)
        dummies += [(factor, level) for level in levels[1:]]
    return Design(tuple(numbers), tuple(dummies))


def moments(width: int) -> list[Column]:
    """Aggregates ``means`` and ``spreads``, sample deviations, of the columns of ``x``."""
    means = ", ".join(f"avg(x[{i}])" for i in range(width))
    spreads = ", ".join(f"coalesce(stddev_samp(x[{i}]), 0D)" for i in range(width))
    return [F.expr(f"array({means})").alias("means"), F.expr(f"array({spreads})").alias("spreads")]


def fit_scale(matrix: DataFrame, width: int) -> Scale:
    """Centre and spread of every column, in one pass."""
    row = matrix.agg(*moments(width)).first()
    return Scale(tuple(row.means), tuple(row.spreads))


@dataclass(frozen=True)
class Problem:
    """A regression ready to fit: scaled training rows [id, label, x], and query rows [id, x] if there are any yet."""

    train: DataFrame
    design: Design
    scale: Scale
    queries: DataFrame | None = None


def encoded(features: DataFrame, design: Design, scale: Scale) -> DataFrame:
    """[id, x] of ``features``, in the columns and on the scale of a fit."""
    return features.select(F.col(KEY).alias("id"), design.row().alias("x")).withColumn("x", scale.apply())


def prepare_rows(train: DataFrame) -> Problem:
    """Encodes and scales the training rows."""
    train = materialize(train)
    design = fit_design(train)
    raw = train.select(F.col(KEY).alias("id"), F.col(LABEL).cast("double").alias("label"), design.row().alias("x"))
    scale = fit_scale(raw, design.width)
    return Problem(raw.withColumn("x", scale.apply()), design, scale)


def prepare(train: DataFrame, features: DataFrame) -> Problem:
    """Encodes and scales by the training rows."""
    rows = prepare_rows(train)
    return Problem(rows.train, rows.design, rows.scale, encoded(features, rows.design, rows.scale))
