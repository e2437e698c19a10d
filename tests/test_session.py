"""Session settings."""

from __future__ import annotations

import pytest

from slotflow.session import ADVISORY, MOST_BYTES, _bytes, configure


@pytest.mark.parametrize("size, number", [("64MB", 2**26), ("8m", 2**23), ("200KB", 204_800), ("1048576", 2**20), ("1048576b", 2**20), ("1g", 2**30)])
def test_sizes(size, number):
    assert _bytes(size) == number


@pytest.mark.parametrize("size, wanted", [("64MB", MOST_BYTES), ("8m", 2**23)])
def test_a_task_gets_no_more_than_the_bound(spark, size, wanted):
    before = spark.conf.get(ADVISORY)
    try:
        spark.conf.set(ADVISORY, size)
        configure(spark)
        assert _bytes(spark.conf.get(ADVISORY)) == wanted
    finally:
        spark.conf.set(ADVISORY, before)
