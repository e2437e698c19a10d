"""Windows, double headers, averages and labels of the demand features."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from slotflow.operators import demand as D
from slotflow.sources.tables import merge_live_archive

AS_OF = date(2024, 5, 1)
HEADERS = "id long, creation_time timestamp_ntz, order_type int"
LINES = "id long, originator_header_id long, item_id long, requested_quantity long"


def at(days, hour=0):
    return datetime(AS_OF.year, AS_OF.month, AS_OF.day, hour) - timedelta(days=days)


@pytest.fixture(scope="module")
def tables(spark):
    live = [(1, at(1, 23), 0), (2, at(30), 0), (3, at(31), 0), (4, at(0), 0), (5, at(2), 1)]
    archive = [(1, at(1, 23), 0), (6, at(8, 5), 0)]
    lines_live = [(10, 1, 100, 5), (11, 1, 100, 5), (12, 2, 100, 7), (13, 3, 100, 9), (14, 4, 100, 1), (15, 5, 100, 1)]
    lines_archive = [(10, 1, 100, 5), (16, 6, 101, 4)]
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((live, HEADERS), (archive, HEADERS), (lines_live, LINES), (lines_archive, LINES))]
    return frames, spark.createDataFrame([(100, "A"), (101, "A")], "id long, system_product_id string")


def days_and_units(daily):
    return {((AS_OF - r.orderdate).days, r.prod_id): (r.orders, r.units) for r in daily.collect()}


def test_a_header_in_both_systems_counts_once_and_doubles_units(tables):
    frames, products = tables
    daily = D.daily_orders(*merge_live_archive(*frames), products, AS_OF)
    # Two equal lines with ids of their own stay two; the one kept by both systems stays one.
    assert days_and_units(daily) == {(1, "A"): (1, 20), (30, "A"): (1, 7), (8, "A"): (1, 4)}
    deduped = D.daily_orders(*merge_live_archive(*frames, dedupe_headers=True), products, AS_OF)
    assert days_and_units(deduped)[1, "A"] == (1, 10)


def test_lag_moves_the_window(tables):
    frames, products = tables
    daily = D.daily_orders(*merge_live_archive(*frames), products, AS_OF, lag=1)
    assert set(days_and_units(daily)) == {(30, "A"), (31, "A"), (8, "A")}


def test_comparing_lines_after_the_join_gives_the_same(tables):
    (headers_live, headers_archive, lines_live, lines_archive), products = tables
    late = D.daily_orders(
        headers_live.unionByName(headers_archive), lines_live.unionByName(lines_archive), products, AS_OF, repeated_lines=True
    )
    early = D.daily_orders(*merge_live_archive(headers_live, headers_archive, lines_live, lines_archive), products, AS_OF)
    assert days_and_units(late) == days_and_units(early)


def test_orders_of_two_items_of_one_product_count_once(spark):
    headers = spark.createDataFrame([(1, at(3), 0)], HEADERS)
    lines = spark.createDataFrame([(1, 1, 100, 2), (2, 1, 101, 3)], LINES)
    products = spark.createDataFrame([(100, "A"), (101, "A")], "id long, system_product_id string")
    assert days_and_units(D.daily_orders(headers, lines, products, AS_OF)) == {(3, "A"): (1, 5)}


def daily_frame(spark, rows):
    dated = [(AS_OF - timedelta(days=age), 0, prod, orders, units) for age, prod, orders, units in rows]
    return spark.createDataFrame(dated, "orderdate date, order_type int, prod_id string, orders long, units long")


def test_order_averages_divide_by_the_window(spark):
    daily = daily_frame(spark, [(1, "A", 2, 10), (7, "A", 1, 4), (8, "A", 1, 3), (15, "A", 5, 50), (31, "B", 1, 1)])
    rows = D.order_features(daily, AS_OF).collect()
    assert [r.prod_id for r in rows] == ["A"]
    row = rows[0]
    assert (row.rep_orders_lst7, row.rep_units_lst7) == (3, 14)
    assert (row.avg_rep_orders_lst7, row.avg_rep_units_lst7) == (round(3 / 7, 4), 2.0)
    assert (row.avg_rep_orders_lst14, row.avg_rep_units_lst14) == (round(4 / 14, 4), round(17 / 14, 4))
    assert (row.avg_rep_orders_lst30, row.avg_rep_units_lst30) == (0.3, round(67 / 30, 4))


def snapshots(spark, rows):
    dated = [(AS_OF - timedelta(days=age), prod, units) for age, prod, units in rows]
    return spark.createDataFrame(dated, "snap_date date, prod_id string, units long")


def test_stock_averages_divide_by_days_present(spark):
    df = snapshots(spark, [(1, "A", 3), (1, "A", 3), (10, "A", 12), (20, "A", 30), (31, "A", 900), (20, "B", 4)])
    found = {r.prod_id: tuple(r)[1:] for r in D.stock_features(df, AS_OF).collect()}
    assert found == {"A": (16.0, 9.0, 16.0, 6), "B": (4.0, None, 4.0, 0)}
    fixed = {r.prod_id: tuple(r)[1:] for r in D.stock_features(df, AS_OF, fix_lst7=True).collect()}
    assert fixed == {"A": (6.0, 9.0, 16.0, 6), "B": (None, None, 4.0, 0)}
    lagged = {r.prod_id: r.current_stock for r in D.stock_features(df, AS_OF, lag=1).collect()}
    assert lagged == {"A": 0, "B": 0}


def test_daily_stock_is_a_snapshot_itself(spark):
    df = snapshots(spark, [(1, "A", 3), (1, "A", 3), (10, "A", 12), (31, "A", 900)])
    short = D.daily_stock(df, AS_OF, days=31)
    for lag in (0, 1):
        assert D.stock_features(short, AS_OF, lag).collect() == D.stock_features(df, AS_OF, lag).collect()


def product_tables(spark):
    products = spark.createDataFrame(
        [("A", "ECO-1", 100, 50, 10, 1, 999), ("B", "ECO-2", 1, 1, 50, 1, 500), ("C", "STA-3", 1, 1, 1, 1, 1), ("D", "ECO-4", 1, 1, 1, 0, 1)],
        "prod_id string, prod_code string, length int, width int, height int, state int, selling_price long",
    ).selectExpr("*", "'Y' hanging_garment", "3L brom_size", "'S' sor_indicator", "2L uplb")
    return products, spark.createDataFrame([("ECO", "HOME", 12)], "dissection string, directorate string, partner_discount long")


def test_features_keep_active_stocked_known_products(spark):
    orders = D.order_features(daily_frame(spark, [(1, "A", 2, 10)]), AS_OF)
    stock = D.stock_features(snapshots(spark, [(1, p, 5) for p in "ABCD"] + [(9, "E", 5)]), AS_OF)
    rows = {r.prod_id: r for r in D.demand_features(*product_tables(spark), orders, stock, AS_OF).collect()}
    assert sorted(rows) == ["A", "B"]
    assert list(rows["A"].asDict()) == D.FEATURE_COLUMNS
    assert (rows["A"].insert_date, rows["A"].volume, rows["A"].selling_price) == (AS_OF, 0.05, 9.99)
    # 50 / 1,000,000 ends on a tie and rounds away from zero.
    assert rows["B"].volume == 0.0001
    assert (rows["B"].rep_units_lst7, rows["B"].avg_rep_units_lst30, rows["A"].rep_units_lst7) == (0, 0.0, 10)


def test_training_label_is_the_day_left_free(spark):
    daily = daily_frame(spark, [(1, "A", 2, 10), (2, "A", 1, 4), (2, "B", 1, 1)])
    stock = D.stock_features(snapshots(spark, [(2, "A", 5), (2, "B", 5)]), AS_OF, lag=1)
    features = D.demand_features(*product_tables(spark), D.order_features(daily, AS_OF, 1), stock, AS_OF, 1)
    found = {r.prod_id: (r.insert_date, r.rep_units_lst7, r.sold_rep_units) for r in D.training_set(features, daily, AS_OF).collect()}
    yesterday = AS_OF - timedelta(days=1)
    assert found == {"A": (yesterday, 4, 10), "B": (yesterday, 1, 0)}


def test_average_sales(spark):
    daily = daily_frame(spark, [(1, "A", 2, 10), (2, "A", 1, 5)])
    row = D.average_daily_sales(daily).first()
    assert tuple(row) == ("A", "SHOP", round(2 / 30, 4), 0.5)


def test_repeated_lines_are_dropped_by_a_sort(spark):
    """What distinct gives, without a hash table of all lines of a task."""
    rows = [(1, None, 0.0), (1, None, -0.0), (1, None, None), (1, None, None), (None, "a", float("nan")), (None, "a", float("nan")), (2, "a", 1.5), (2, "b", 1.5)]
    df = spark.createDataFrame(rows, "k long, t string, x double").repartition(3, "k")
    found = D.without_repeats(df)
    assert found.columns == df.columns and found.count() == 5 and found.exceptAll(df.distinct()).isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("Exchange") == 1
