"""The daily jobs, from source tables to results."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial
from typing import Protocol

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.models import classifier
from slotflow.models.design import LABEL
from slotflow.models.knn import knn_forecast
from slotflow.models.linear import pls_forecast
from slotflow.models.radial import rbf_forecast
from slotflow.models.splines import hinge_forecast
from slotflow.operators import demand
from slotflow.operators.expected import expected_demand, forecast_demand
from slotflow.operators.moves import instructions, plan_moves
from slotflow.operators.outcomes import confusion_matrix, evaluation_set, tote_features
from slotflow.operators.prices import min_sale_price, price_lines, priced_features
from slotflow.operators.sampling import stratified_split
from slotflow.session import materialize, materialize_all
from slotflow.sources import sinks
from slotflow.sources.tables import merge_live_archive, order_messages


class Warehouse(Protocol):
    """The source tables of one site; each method reads one, lazily."""

    def headers_live(self) -> DataFrame: ...
    def headers_archive(self) -> DataFrame: ...
    def lines_live(self) -> DataFrame: ...
    def lines_archive(self) -> DataFrame: ...
    def products(self) -> DataFrame: ...
    def assortment(self) -> DataFrame: ...
    def dissections(self) -> DataFrame: ...
    def snapshots(self) -> DataFrame: ...
    def events(self) -> DataFrame: ...
    def confirmed(self) -> DataFrame: ...
    def transports(self) -> DataFrame: ...
    def average_sales(self) -> DataFrame: ...
    def tote_stock(self) -> DataFrame: ...


def merged_orders(site: Warehouse, dedupe_headers: bool = False) -> tuple[DataFrame, DataFrame]:
    """Headers and lines of both order systems."""
    return merge_live_archive(
        site.headers_live(), site.headers_archive(), site.lines_live(), site.lines_archive(), dedupe_headers
    )


def orders_by_day(site: Warehouse, as_of: date, lag: int = 0, days: int = demand.LONGEST) -> DataFrame:
    """Daily orders of both systems; lines are compared after the join with recent headers."""
    headers = site.headers_live().unionByName(site.headers_archive())
    lines = site.lines_live().unionByName(site.lines_archive())
    return demand.daily_orders(headers, lines, site.products(), as_of, lag, days, repeated_lines=True)


def _features(site: Warehouse, daily: DataFrame, snapshots: DataFrame, as_of: date, lag: int) -> DataFrame:
    orders = demand.order_features(daily, as_of, lag)
    stock = demand.stock_features(snapshots, as_of, lag)
    return demand.demand_features(site.assortment(), site.dissections(), orders, stock, as_of, lag)


def features(site: Warehouse, as_of: date, lag: int = 0) -> DataFrame:
    """Demand features of ``as_of``, or with ``lag=1`` those of the training set."""
    return _features(site, orders_by_day(site, as_of, lag), site.snapshots(), as_of, lag)


def training_data(site: Warehouse, as_of: date) -> DataFrame:
    """Features of the day before with the units sold that day."""
    daily = materialize(orders_by_day(site, as_of, days=demand.LONGEST + 1))
    return demand.training_set(_features(site, daily, site.snapshots(), as_of, 1), daily, as_of)


def add_days(site: Warehouse, path: str, as_of: date, days: int = 1, lines: DataFrame | None = None) -> None:
    """Stores sums by product of the ``days`` before ``as_of``; a day that is run again is replaced.

    A daily run reads the headers and snapshots of one day. ``lines`` are the order lines of both systems that may belong to these
    days, where a site can read them by date; otherwise all lines meet the day's headers.
    """
    headers = site.headers_live().unionByName(site.headers_archive())
    lines = site.lines_live().unionByName(site.lines_archive()) if lines is None else lines
    sinks.refresh_days(
        demand.daily_orders(headers, lines, site.products(), as_of, days=days, repeated_lines=True), f"{path}/orders", "orderdate"
    )
    sinks.refresh_days(demand.daily_stock(site.snapshots(), as_of, days=days), f"{path}/stock", "snap_date")


def stored_days(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The sums of orders and of stock that ``add_days`` stored; a window of days reads its folders only."""
    orders = spark.read.schema("order_type int, prod_id string, orders bigint, units bigint, orderdate date").parquet(f"{path}/orders")
    stock = spark.read.schema("prod_id string, units bigint, snap_date date").parquet(f"{path}/stock")
    return orders, stock


def features_of_days(site: Warehouse, spark: SparkSession, path: str, as_of: date, lag: int = 0) -> DataFrame:
    """``features`` with all windows composed from stored days: no order line and no snapshot is read."""
    orders, stock = stored_days(spark, path)
    return _features(site, orders, stock, as_of, lag)


def sale_prices(site: Warehouse, as_of: date) -> DataFrame:
    """Lowest sale price per product in the messages of the day before."""
    return min_sale_price(price_lines(order_messages(site.events(), as_of)))


def model_data(site: Warehouse, as_of: date) -> tuple[DataFrame, DataFrame]:
    """Priced training rows and priced feature rows.

    Orders, stock and prices shrink to a row per product and day once, for both.
    """
    daily, snapshots, prices = materialize_all(
        orders_by_day(site, as_of, days=demand.LONGEST + 1),
        demand.daily_stock(site.snapshots(), as_of, days=demand.LONGEST + 1),
        sale_prices(site, as_of),
    )
    train = demand.training_set(_features(site, daily, snapshots, as_of, 1), daily, as_of)
    today = _features(site, daily, snapshots, as_of, 0)
    return priced_features(train, prices), priced_features(today, prices)


def demand_forecast(site: Warehouse, as_of: date, forecaster: Callable = knn_forecast) -> DataFrame:
    """[prod_id, forecast] of the day."""
    train, today = model_data(site, as_of)
    return forecast_demand(forecaster(train, today))


def daily_move_plan(
    site: Warehouse, as_of: date, created_at: datetime, forecaster: Callable = knn_forecast, distinct: bool = False
) -> DataFrame:
    """The move instructions of the day, from the source tables."""
    stock = materialize(site.tote_stock())
    wanted = expected_demand(site.confirmed(), demand_forecast(site, as_of, forecaster), stock)
    return instructions(plan_moves(stock, materialize(wanted)), created_at, distinct)


def study_split(train: DataFrame, p: float = 0.75, seed: int = 102) -> tuple[DataFrame, DataFrame]:
    """Training and hold-out rows, each garment kind split alike."""
    split = materialize(stratified_split(materialize(train), "hanging_garment", p, ["prod_id"], seed))
    return tuple(split.filter(F.col("in_train") == side).drop("in_train") for side in (True, False))


# The study tunes nearest neighbours by a single cross-validation, the daily job by three.
FORECASTERS = {"earth": hinge_forecast, "knn": partial(knn_forecast, repeats=1), "pls": pls_forecast, "svm": rbf_forecast}


def model_study(site: Warehouse, as_of: date) -> tuple[dict[str, DataFrame], DataFrame]:
    """Predictions of the four regressors for the hold-out, and the hold-out itself."""
    train, held = study_split(model_data(site, as_of)[0])
    train = materialize(train)
    return {name: forecast(train, held.drop(LABEL)) for name, forecast in FORECASTERS.items()}, held


def tote_facts(site: Warehouse, statistics: DataFrame) -> DataFrame:
    """Tote features over stored stock statistics."""
    return tote_features(statistics, site.transports(), site.average_sales(), site.confirmed())


def back_test(model: PipelineModel, facts: DataFrame) -> DataFrame:
    """Confusion matrix of a stored classifier over all complete tote features of later days."""
    scored = classifier.classify(model, evaluation_set(facts))
    return confusion_matrix(scored, "predicted", classifier.LABEL, classifier.POSITIVE)
