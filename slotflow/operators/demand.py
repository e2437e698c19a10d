"""Daily demand features, training set and average sales.

Every window counts days back from ``as_of``. ``lag=1`` moves all of them one day further
back: those are the training features, whose label is the day the lag leaves free.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window, functions as F

from slotflow.functions.columns import half_up, within

# Fixed values.
REPLENISHMENT = 0
WINDOWS = (7, 14, 30)
LONGEST = 30
ACTIVE = 1

FEATURE_COLUMNS = [
    "insert_date",
    "prod_id",
    "directorate",
    "hanging_garment",
    "brom_size",
    "sor_indicator",
    "partner_discount",
    "uplb",
    "volume",
    "selling_price",
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
]


def without_repeats(df: DataFrame) -> DataFrame:
    """``df.distinct()`` by a sort.

    On rows that lie together already, ``distinct`` fills two hash tables with all of them in the same task; a sort holds them once.
    """
    same = Window.partitionBy(*df.columns).orderBy(F.lit(0))
    return df.select("*", F.row_number().over(same).alias("_repeat")).filter(F.col("_repeat") == 1).drop("_repeat")


def daily_orders(
    headers: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    as_of: date,
    lag: int = 0,
    days: int = LONGEST,
    repeated_lines: bool = False,
) -> DataFrame:
    """[orderdate, order_type, prod_id, orders, units] of replenishment orders in the last ``days`` days.

    A header kept by both systems counts once in ``orders`` and twice in ``units``. Its copies
    are counted before the join, so that lines are not doubled on the way.

    ``repeated_lines`` takes the lines of both systems as they are and drops repeated ones after
    the join: only lines of recent orders are compared, and the shuffle on the header serves both.
    """
    recent = (
        headers.filter(F.col("order_type") == REPLENISHMENT)
        .filter(within(F.col("creation_time"), as_of, days + lag, 1 + lag))
        .groupBy(F.col("id").alias("originator_header_id"), F.to_date("creation_time").alias("orderdate"), "order_type")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    ordered = lines.join(recent, "originator_header_id")
    if repeated_lines:
        ordered = without_repeats(ordered)
    named = products.select(F.col("id").alias("item_id"), F.col("system_product_id").alias("prod_id"))
    return (
        ordered.select("originator_header_id", "orderdate", "order_type", "copies", "item_id", "requested_quantity")
        .join(named, "item_id")
        .groupBy("orderdate", "order_type", "prod_id")
        .agg(
            F.count_distinct("originator_header_id").alias("orders"),
            F.sum(F.col("requested_quantity") * F.col("copies")).alias("units"),
        )
    )


def order_features(daily: DataFrame, as_of: date, lag: int = 0) -> DataFrame:
    """Totals of the last 7 days and daily averages of the last 7, 14 and 30, per product.

    An average divides by the days of its window, also where some had no order.
    """
    day = F.col("orderdate")
    daily = daily.filter(within(day, as_of, LONGEST + lag, 1 + lag))
    sums = {
        f"{kind}_{days}": F.sum(F.when(within(day, as_of, days + lag, 1 + lag), F.col(kind)).otherwise(0))
        for days in WINDOWS
        for kind in ("orders", "units")
    }
    averages = [
        half_up(F.col(name) / int(name.split("_")[1]), 4).alias("avg_rep_{}_lst{}".format(*name.split("_")))
        for name in sums
    ]
    return (
        daily.groupBy("prod_id")
        .agg(*[total.alias(name) for name, total in sums.items()])
        .select(
            "prod_id",
            F.col("orders_7").alias("rep_orders_lst7"),
            F.col("units_7").alias("rep_units_lst7"),
            *averages,
        )
    )


def daily_stock(snapshots: DataFrame, as_of: date, lag: int = 0, days: int = LONGEST) -> DataFrame:
    """[snap_date, prod_id, units] per day: snapshots in their shortest form."""
    day = F.col("snap_date")
    return (
        snapshots.filter(within(day, as_of, days + lag, 1 + lag))
        .groupBy(F.to_date(day).alias("snap_date"), "prod_id")
        .agg(F.sum("units").alias("units"))
    )


def stock_features(snapshots: DataFrame, as_of: date, lag: int = 0, fix_lst7: bool = False) -> DataFrame:
    """[prod_id, avg_stock_lst7/14/30, current_stock] from daily stock snapshots.

    Averages divide by the days a product was seen. The 7-day column averages over all 30
    days, as users of the feature know it; ``fix_lst7`` makes it seven.
    """
    day, daily = F.col("snap_date"), daily_stock(snapshots, as_of, lag)
    span = {7: 7 if fix_lst7 else LONGEST, 14: 14, 30: 30}
    averages = [
        half_up(F.avg(F.when(within(day, as_of, days + lag, 1 + lag), F.col("units"))), 4).alias(f"avg_stock_lst{name}")
        for name, days in span.items()
    ]
    latest = F.when(within(day, as_of, 1 + lag, 1 + lag), F.col("units")).otherwise(0)
    return daily.groupBy("prod_id").agg(*averages, F.max(latest).alias("current_stock"))


def demand_features(
    products: DataFrame,
    dissections: DataFrame,
    orders: DataFrame,
    stock: DataFrame,
    as_of: date,
    lag: int = 0,
) -> DataFrame:
    """The 22 feature columns, one row per active product in stock.

    ``orders`` and ``stock`` come from ``order_features`` and ``stock_features`` of the same
    ``as_of`` and ``lag``. The volume is worked out in decimals: it can end on a tie.
    """
    side = [F.col(c).cast("decimal(10,2)") for c in ("length", "width", "height")]
    volume = half_up(side[0] * side[1] * side[2] * F.lit("0.000001").cast("decimal(7,6)"), 4)
    active = products.filter(F.col("state") == ACTIVE).select(
        F.lit(as_of - timedelta(days=lag)).alias("insert_date"),
        "prod_id",
        F.substring("prod_code", 1, 3).alias("dissection"),
        "hanging_garment",
        "brom_size",
        "sor_indicator",
        "uplb",
        volume.cast("double").alias("volume"),
        (F.col("selling_price").cast("double") / 100).alias("selling_price"),
    )
    joined = (
        active.join(dissections.select("dissection", "directorate", "partner_discount"), "dissection")
        .join(stock.filter(F.col("current_stock") > 0), "prod_id")
        .join(orders, "prod_id", "left")
    )
    counted = [c for c in FEATURE_COLUMNS if c.startswith(("avg_", "rep_"))]
    return joined.fillna(0, counted).select(*FEATURE_COLUMNS)


def training_set(features: DataFrame, daily: DataFrame, as_of: date) -> DataFrame:
    """Features of lag 1 with ``sold_rep_units``: the units ordered the day before ``as_of``."""
    sold = (
        daily.filter(within(F.col("orderdate"), as_of, 1, 1))
        .groupBy("prod_id")
        .agg(F.sum("units").alias("sold_rep_units"))
    )
    return features.join(sold, "prod_id", "left").fillna(0, ["sold_rep_units"]).select(
        *features.columns, "sold_rep_units"
    )


def average_daily_sales(daily: DataFrame, order_type: str = "SHOP") -> DataFrame:
    """[prod_id, order_type, likelihood, exp_demand].

    The likelihood is the share of the 30 days with sales, the expected demand the mean of a
    selling day times that share.
    """
    sold = daily.groupBy("prod_id").agg(
        F.count_distinct("orderdate").alias("days"), F.sum("units").alias("units")
    )
    likelihood = F.col("days") / LONGEST
    return sold.select(
        "prod_id",
        F.lit(order_type).alias("order_type"),
        half_up(likelihood, 4).alias("likelihood"),
        half_up(F.col("units") / F.col("days") * likelihood, 4).alias("exp_demand"),
    )
