"""Tails of distributions as column expressions: binomial, beta and chi-square."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Lanczos' coefficients of the gamma function for g = 7.
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905,
    -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)
TINY = 1e-300


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def log_gamma(z: Column) -> Column:
    """The logarithm of the gamma function of ``z`` of at least one half."""

    def at(x: Column) -> Column:
        series = F.lit(LANCZOS[0])
        for i, c in enumerate(LANCZOS[1:]):
            series = series + c / (x + i)
        t = x + 6.5
        return math.log(2 * math.pi) / 2 + (x - 0.5) * F.ln(t) - t + F.ln(series)

    return bind(z.cast("double"), at)


def _apart(value: Column) -> Column:
    return F.when(F.abs(value) < TINY, F.lit(TINY)).otherwise(value)


def _beta_fraction(a: Column, b: Column, x: Column, steps: Column) -> Column:
    """The continued fraction of the incomplete beta function, from its beginning (Lentz's method)."""

    def turn(s: Column, term: Column) -> Column:
        d = 1 / _apart(1 + term * s["d"])
        c = _apart(1 + term / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["f"] * c * d).alias("f"))

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return bind(turn(s, even), lambda half: turn(half, odd))

    first = 1 / _apart(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("f"))
    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda s: s["f"])


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function, of ``a`` and ``b`` of at least one half; ``x`` beyond 0 or 1 counts as these."""

    def inside(v: Column) -> Column:
        a, b, x = v["a"], v["b"], v["x"]
        # the fraction converges fast on one side only; it takes some root of the larger number of steps
        front = log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.log1p(-x)
        steps = (100 + 4 * F.sqrt(F.greatest(a, b))).cast("int")
        return F.when(x < (a + 1) / (a + b + 2), F.exp(front) * _beta_fraction(a, b, x, steps) / a).otherwise(
            1 - F.exp(front) * _beta_fraction(b, a, 1 - x, steps) / b
        )

    value = F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"), x.cast("double").alias("x"))
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(bind(value, inside))


def beta_quantile(share: float, a: Column, b: Column) -> Column:
    """Where the incomplete beta function reaches ``share``: Newton's steps, halving where one would leave what is still open."""
    whole = log_gamma(a + b) - log_gamma(a) - log_gamma(b)

    def step(s: Column, _: Column) -> Column:
        def narrowed(v: Column) -> Column:
            x, below = s["x"], v - share
            low, high = F.when(below < 0, x).otherwise(s["low"]), F.when(below < 0, s["high"]).otherwise(x)
            slope = F.exp(s["whole"] + (a - 1) * F.ln(x) + (b - 1) * F.log1p(-x))
            return F.struct(low.alias("low"), high.alias("high"), F.try_divide(below, slope).alias("step"))

        def moved(n: Column) -> Column:
            to = s["x"] - n["step"]
            inside = F.coalesce((to > n["low"]) & (to < n["high"]), F.lit(False))
            x = F.when(inside, to).otherwise((n["low"] + n["high"]) / 2)
            done = F.abs(x - s["x"]) <= 1e-15 * x
            return F.struct(n["low"].alias("low"), n["high"].alias("high"), x.alias("x"), s["whole"].alias("whole"), done.alias("done"))

        return F.when(s["done"], s).otherwise(bind(bind(incomplete_beta(a, b, s["x"]), narrowed), moved))

    start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"), (a / (a + b)).cast("double").alias("x"), whole.alias("whole"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, step, lambda s: s["x"])


def binomial_tail(hits: Column, n: Column, p: Column) -> Column:
    """The chance of at least ``hits`` among ``n`` where each has the chance ``p``."""
    return F.when(hits <= 0, 1.0).otherwise(incomplete_beta(hits, n - hits + 1, p))


def exact_interval(hits: Column, n: Column, confidence: float = 0.95) -> tuple[Column, Column]:
    """The exact interval of a share (Clopper and Pearson), from the tails of the binomial distribution."""
    out = (1 - confidence) / 2
    low = F.when(hits <= 0, 0.0).otherwise(beta_quantile(out, hits, n - hits + 1))
    high = F.when(hits >= n, 1.0).otherwise(beta_quantile(1 - out, hits + 1, n - hits))
    return low, high


def chi_square_tail(value: Column) -> Column:
    """The chance of at least ``value`` in a chi-square distribution with one degree of freedom."""

    def at(x: Column) -> Column:
        # upper incomplete gamma function of 1/2: its series near zero, its continued fraction beyond
        series = F.aggregate(
            F.sequence(F.lit(1), F.lit(100)),
            F.struct(F.lit(2.0).alias("term"), F.lit(2.0).alias("sum")),
            lambda s, i: bind(s["term"] * x / (i + 0.5), lambda t: F.struct(t.alias("term"), (s["sum"] + t).alias("sum"))),
            lambda s: 1 - s["sum"] * F.exp(-x) * F.sqrt(x) / math.sqrt(math.pi),
        )

        def turn(s: Column, i: Column) -> Column:
            term, base = -i * (i - 0.5), x + 0.5 + 2 * i
            d = 1 / _apart(term * s["d"] + base)
            c = _apart(base + term / s["c"])
            return F.struct(c.alias("c"), d.alias("d"), (s["f"] * c * d).alias("f"))

        first = 1 / (x + 0.5)
        start = F.struct(F.lit(1 / TINY).alias("c"), first.alias("d"), first.alias("f"))
        fraction = F.aggregate(F.sequence(F.lit(1), F.lit(200)), start, turn, lambda s: s["f"] * F.exp(-x) * F.sqrt(x) / math.sqrt(math.pi))
        return F.when(x <= 0, 1.0).when(x < 1.5, series).otherwise(fraction)

    return bind(value.cast("double") / 2, at)
