"""Tails of distributions against plain sums."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from slotflow.functions import special
from slotflow.operators.outcomes import confusion_matrix


def tail(k, n, p):
    """Exactly, in whole numbers and one division."""
    a, b = p.as_integer_ratio()
    return sum(math.comb(n, i) * a**i * (b - a) ** (n - i) for i in range(max(k, 0), n + 1)) / b**n


CASES = [(0, 10, 0.5), (10, 10, 0.5), (3, 10, 0.25), (700, 1000, 0.6875), (650, 1000, 0.6875), (1, 2000, 0.0009765625), (1990, 2000, 0.984375), (20, 20, 0.875)]


def test_binomial_tails(spark):
    df = spark.createDataFrame(CASES, "k long, n long, p double")
    found = df.select("k", "n", "p", special.binomial_tail(F.col("k"), F.col("n"), F.col("p")).alias("t")).collect()
    for r in found:
        assert math.isclose(r.t, tail(r.k, r.n, r.p), rel_tol=1e-9, abs_tol=1e-12), r


def test_gamma(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.0, 1.5, 2.0, 10.0, 123.4, 1e6, 1e9)], "v double")
    for r in df.select("v", special.log_gamma(F.col("v")).alias("g")).collect():
        assert math.isclose(r.g, math.lgamma(r.v), rel_tol=1e-12, abs_tol=1e-12)


def test_intervals_leave_out_a_fortieth_on_each_side(spark):
    pairs = [(0, 8), (8, 8), (3, 8), (1, 1000), (512, 1024), (1999, 2000)]
    low, high = special.exact_interval(F.col("k"), F.col("n"))
    for r in spark.createDataFrame(pairs, "k long, n long").select("k", "n", low.alias("low"), high.alias("high")).collect():
        assert r.low == 0 if r.k == 0 else math.isclose(tail(r.k, r.n, r.low), 0.025, rel_tol=1e-7)
        assert r.high == 1 if r.k == r.n else math.isclose(1 - tail(r.k + 1, r.n, r.high), 0.025, rel_tol=1e-7)


def test_large_numbers_stay_right(spark):
    """Half of ten million: the interval is that of the normal distribution."""
    n = 10**7
    row = spark.range(1).select(*special.exact_interval(F.lit(n // 2), F.lit(n))).first()
    width = 1.959963984540054 * 0.5 / math.sqrt(n)
    assert math.isclose(row[0], 0.5 - width, abs_tol=1e-7) and math.isclose(row[1], 0.5 + width, abs_tol=1e-7)


def test_chi_square_tails(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1e-6, 0.1, 1.0, 2.9, 3.1, 3.841458820694124, 10.0, 60.0, 900.0)], "v double")
    for r in df.select("v", special.chi_square_tail(F.col("v")).alias("t")).collect():
        assert math.isclose(r.t, math.erfc(math.sqrt(r.v / 2)), rel_tol=1e-9, abs_tol=1e-300), r


@pytest.mark.parametrize("cells", [(40, 10, 3, 47), (5, 0, 0, 5), (0, 4, 4, 0), (30, 12, 12, 50), (1, 0, 0, 0)])
def test_confusion_tests(spark, cells):
    tp, fp, fn, tn = cells
    pairs = [(1, 1)] * tp + [(1, 0)] * fp + [(0, 1)] * fn + [(0, 0)] * tn
    row = confusion_matrix(spark.createDataFrame(pairs, "p long, o long"), "p", "o", 1).first()
    n, right, most = sum(cells), tp + tn, max(tp + fn, tn + fp)
    assert math.isclose(row.no_information_rate, most / n) and math.isclose(row.detection_prevalence, (tp + fp) / n)
    assert math.isclose(row.accuracy_p, tail(right, n, most / n), rel_tol=1e-9)
    assert row.accuracy_low <= right / n <= row.accuracy_high
    if fp + fn:
        value = 0 if fp == fn else (abs(fp - fn) - 1) ** 2 / (fp + fn)
        assert math.isclose(row.mcnemar_p, math.erfc(math.sqrt(value / 2)), rel_tol=1e-9)
    else:
        assert row.mcnemar_p is None


def test_no_rows_have_no_statistics(spark):
    row = confusion_matrix(spark.createDataFrame([], "p long, o long"), "p", "o", 1).first()
    assert (row.tp, row.accuracy_low, row.accuracy_p, row.mcnemar_p, row.no_information_rate) == (0, None, None, None, None)
