"""Lowest prices as stream state, and windows composed from stored days."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from slotflow.operators.prices import min_sale_price, price_lines
from slotflow.plans import catalog, jobs
from slotflow.sources.fixture import AS_OF, Fixture
from slotflow.streaming.messages import ingest_least_prices, ingest_messages, least_prices, stream_files
from tests.test_prices import record

EVENT = "telegram_type string, creation_time timestamp_ntz, raw_message string"


def event(product, price, hour=10, day=1, kind="ORH"):
    return (kind, datetime(2024, 5, day, hour), record(prodid=f"{product:08d}", price=f"{price:010d}"))


def streamed(spark, folder, files, delay="2 days", runs=1):
    """Files arrive one in a batch; with several ``runs`` the stream is stopped and started again in between."""
    inbox, seen, path = (str(folder / n) for n in ("inbox", "seen", "least"))
    for i in range(runs):
        for rows in files[i::runs]:
            spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(inbox)
        source = stream_files(spark, inbox, spark.createDataFrame([], EVENT).schema, "*.parquet", at_once=1)
        ingest_messages(source, seen, str(folder / "p1"), delay).awaitTermination()
        messages = stream_files(spark, seen, spark.createDataFrame([], "received timestamp, raw_message string").schema, "*.parquet", at_once=1)
        ingest_least_prices(messages, path, str(folder / "p2"), delay).awaitTermination()
    return sorted((r.day.day, r.prodid, r.saleprice, r.lines) for r in least_prices(spark, path).collect())


FILES = [
    [event(1, 300), event(2, 500), event(1, 200, day=2)],
    [event(1, 250, hour=11), event(1, 300), (None, None, None), ("ORH", None, record()), ("ORH", datetime(2024, 5, 1), None)],
    [event(2, 400, hour=9), event(1, 250, hour=11), event(1, 1, kind="XXX"), event(1, 250, hour=11)],
]
WANTED = [(1, "00000001", 2.5, 2), (1, "00000002", 4.0, 2), (2, "00000001", 2.0, 1)]


@pytest.mark.parametrize("order", list(permutations(range(3)))[::2])
def test_files_in_any_order_give_the_table_of_the_batch(spark, tmp_path, order):
    assert streamed(spark, tmp_path, [FILES[i] for i in order]) == WANTED
    rows = spark.createDataFrame([r for f in FILES for r in f if r[0] == "ORH" and r[1] and r[1].day == 1], EVENT)
    batch = min_sale_price(price_lines(rows.select("raw_message"))).collect()
    assert {r.prodid: r.saleprice for r in batch} == {p: s for d, p, s, _ in WANTED if d == 1}


def test_a_restart_goes_on_with_the_state(spark, tmp_path):
    assert streamed(spark, tmp_path, FILES, runs=3) == WANTED


def test_what_arrives_after_the_delay_is_dropped(spark, tmp_path):
    # a batch's times count for lateness from the batch after the next one on
    files = [[event(1, 300)], [event(1, 300, day=20)], [event(1, 280, day=20)], [event(1, 100)], [event(1, 90, day=19)]]
    assert streamed(spark, tmp_path, files) == [(1, "00000001", 3.0, 1), (19, "00000001", 0.9, 1), (20, "00000001", 2.8, 2)]


def test_digests_stay_out_of_the_shuffle_and_files_are_packed(spark, tmp_path):
    """Digests made up half of what was shuffled."""
    spark.createDataFrame(FILES[0], EVENT).coalesce(1).write.parquet(f"{tmp_path}/inbox")
    source = stream_files(spark, f"{tmp_path}/inbox", spark.createDataFrame([], EVENT).schema, "*.parquet")
    query = ingest_messages(source, f"{tmp_path}/seen", f"{tmp_path}/p")
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.count("Exchange") == 1 and "AS digest" in plan[: plan.index("Exchange")] and "AS digest" not in plan[plan.index("Exchange") :]
    files = list(tmp_path.glob("seen/*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)


def test_batches_do_not_grow_with_shuffle_partitions(spark, tmp_path, monkeypatch):
    lines = spark.range(60).selectExpr(
        "id * 5 l_orderkey", "id % 7 + 1 l_partkey", "id % 3 l_suppkey", "cast(id % 4 + 1 as int) l_linenumber", "cast(id % 9 as double) l_quantity",
        "1D l_extendedprice", "0D l_discount", "0D l_tax", "'N' l_returnflag", "'O' l_linestatus", "cast('1998-01-01' as timestamp_ntz) l_shipdate",
    )
    lines = lines.withColumn("l_orderkey", F.col("l_orderkey") + F.when(F.col("l_linenumber") > 1, 1).otherwise(0))  # of both days
    lines.coalesce(1).write.parquet(f"{tmp_path}/in/lineitem.parquet")
    monkeypatch.setattr(catalog, "_new_path", lambda site, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        found = sorted(map(tuple, catalog.QUERIES["least_prices_stream"](spark, f"{tmp_path}/in").collect()))
        site = Fixture(spark, f"{tmp_path}/in")
        want = price_lines(site.events().where(F.col("creation_time") == F.lit(AS_OF - timedelta(days=1))))
        want = want.groupBy("prodid").agg(F.min(F.col("saleprice") / 100), F.count(F.lit(1)))
        assert found and found == sorted(map(tuple, want.collect()))
        assert 1 < len(list(tmp_path.glob("least-*/batch=*"))) <= 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_thirty_daily_runs_equal_full_ones(spark, tmp_path):
    site, path = Fixture(spark, "/root/testdata/sf0.001"), str(tmp_path)
    first = AS_OF - timedelta(days=29)
    jobs.add_days(site, path, first, days=30)
    for back in range(28, -1, -1):
        as_of = AS_OF - timedelta(days=back)
        jobs.add_days(site, path, as_of)
        if back % 14 == 0:
            jobs.add_days(site, path, as_of)  # a second run of the day changes nothing
            stored, full = jobs.features_of_days(site, spark, path, as_of), jobs.features(site, as_of)
            assert stored.count() > 0 and stored.exceptAll(full).isEmpty() and full.exceptAll(stored).isEmpty()


def test_windows_read_only_their_days(spark, tmp_path):
    site, path = Fixture(spark, "/root/testdata/sf0.001"), str(tmp_path)
    jobs.add_days(site, path, AS_OF, days=31)
    plan = jobs.features_of_days(site, spark, path, AS_OF)._jdf.queryExecution().toString()
    assert "lineitem" not in plan and "l_orderkey" not in plan
    assert "PartitionFilters: [isnotnull(orderdate" in plan and "PartitionFilters: [isnotnull(snap_date" in plan


def test_lines_of_the_day_are_enough(spark, tmp_path):
    site = Fixture(spark, "/root/testdata/sf0.001")
    lines = site.lines_live().unionByName(site.lines_archive())
    headers = site.headers_live().unionByName(site.headers_archive())
    day = headers.where(F.to_date("creation_time") == F.lit(AS_OF - timedelta(days=1))).select(F.col("id").alias("originator_header_id"))
    jobs.add_days(site, f"{tmp_path}/all", AS_OF)
    jobs.add_days(site, f"{tmp_path}/day", AS_OF, lines=lines.join(day.distinct(), "originator_header_id", "left_semi"))
    a, b = (jobs.stored_days(spark, f"{tmp_path}/{n}")[0] for n in ("all", "day"))
    assert a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert [r.orderdate for r in a.select("orderdate").distinct().collect()] == [AS_OF - timedelta(days=1)] and isinstance(AS_OF, date)
