"""Plans with a key that holds a third of the rows, and with no table small enough to broadcast."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import Window, functions as F

from slotflow.operators import demand, moves, outcomes, stock
from slotflow.session import materialize
from slotflow.sources.fixture import AS_OF, Fixture
from slotflow.sources.tables import order_messages

DAY = date(2024, 5, 1)
ROWS = 300_000
TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(autouse=True)
def tight(spark):
    before = {key: spark.conf.get(key, None) for key in TIGHT}
    for key, value in TIGHT.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def hot(value, every=3):
    """``value`` on a third of the rows."""
    return F.when(F.col("id") % every == 0, F.lit(value))


@pytest.fixture(scope="module")
def located(spark):
    rows = spark.range(0, ROWS, numPartitions=8)
    return materialize(
        rows.select(
            F.when(F.col("id") % 2 == 0, "OSR").otherwise("ASRS").alias("location"),
            F.concat(F.lit("L"), hot("0", 6).otherwise((F.col("id") % 97).cast("string"))).alias("locno"),
            (F.col("id") % 3).alias("z_pos"),
            F.concat(F.lit("T"), F.col("id").cast("string")).alias("licenceplate"),
            hot("hot").otherwise((F.col("id") % 4000).cast("string")).alias("item_number"),
            (F.col("id") % 40 + 1).alias("quantity"),
        )
    )


def test_order_joins_split_a_hot_header_and_a_hot_item(spark):
    lines = spark.range(0, ROWS, numPartitions=8).select(
        "id",
        hot(1).otherwise(F.col("id") % 5000).cast("long").alias("originator_header_id"),
        F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 3000).cast("long").alias("item_id"),
        (F.col("id") % 9 + 1).alias("requested_quantity"),
    )
    headers = spark.range(5000).select(
        "id", F.date_sub(F.lit(DAY), (F.col("id") % 25 + 1).cast("int")).alias("creation_time"), F.lit(0).alias("order_type")
    )
    products = spark.range(3000).select("id", F.col("id").cast("string").alias("system_product_id"))
    repeated = lines.unionByName(lines.filter("id % 10 = 0"))
    daily = demand.daily_orders(headers, repeated, products, DAY, repeated_lines=True)
    assert daily.agg(F.sum("units")).first()[0] == lines.agg(F.sum("requested_quantity")).first()[0]
    assert final_plan(daily).count("SortMergeJoin(skew=true)") == 2


def test_a_hot_item_is_ranked_in_slices(located):
    ranked = materialize(stock.rank_stock(located))
    ordered = Window.partitionBy("item_number", "location").orderBy(
        F.desc("quantity"), F.desc("loccount"), "locno", "z_pos", "licenceplate"
    )
    plain = ranked.select("*", F.sum("quantity").over(ordered).alias("total"), F.row_number().over(ordered).alias("place"))
    assert ranked.count() == ROWS and plain.filter("cumunits <> total or itemrank <> place").isEmpty()


def test_move_join_splits_a_hot_item(spark, located):
    # Spread over many tasks, as a table of real size is: AQE splits a partition by the tasks that wrote it.
    ranked = materialize(stock.rank_stock(located).repartition(16))
    items = located.select(F.col("item_number").alias("prod_id")).distinct()
    wanted = items.withColumn("exp_demand", F.when(F.col("prod_id") == "hot", 100_000).otherwise(300).cast("long"))
    planned = moves.plan_moves(ranked, wanted)
    assert "SortMergeJoin(skew=true)" in final_plan(planned)
    left = ranked.filter("location = 'OSR' and item_number = 'hot'").agg(F.sum("quantity")).first()[0]
    left -= planned.filter("reason = 'surplus' and item_number = 'hot'").agg(F.sum("quantity")).first()[0]
    assert 100_000 <= left < 100_041
    nobody = moves.moves_no_demand(ranked, wanted.filter("prod_id <> 'hot'"))
    assert "SortMergeJoin(skew=true)" in final_plan(nobody)
    assert nobody.count() == located.filter("location = 'OSR' and item_number = 'hot'").count()


def test_tote_feature_joins_split_a_hot_item_and_a_hot_tote(spark):
    rows = spark.range(0, ROWS, numPartitions=8)
    stats = rows.select(
        F.lit(DAY).alias("insert_date"),
        hot("hot").otherwise((F.col("id") % 4000).cast("string")).alias("item_number"),
        F.concat(F.lit("T"), F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id")).cast("string")).alias("licenceplate"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    transports = spark.range(4000).select(
        F.date_add(F.lit(DAY), 1).alias("insert_date"), F.concat(F.lit("T"), F.col("id").cast("string")).alias("licenceplate"), F.lit(1).cast("long").alias("transport_orders")
    )
    items = spark.range(4000).select(F.col("id").cast("string").alias("prod_id")).union(spark.createDataFrame([("hot",)], "prod_id string"))
    sales = items.select("prod_id", F.lit("SHOP").alias("order_type"), F.lit(0.5).alias("likelihood"), F.lit(2.0).alias("exp_demand"))
    confirmed = items.select("prod_id", F.lit(3).cast("long").alias("demand"))
    facts = outcomes.tote_features(stats, transports, sales, confirmed)
    assert final_plan(facts).count("SortMergeJoin(skew=true)") >= 2
    assert facts.count() == ROWS and facts.filter("confirmed = 0").isEmpty()


def test_filters_and_columns_reach_the_scan(spark):
    site = Fixture(spark, "/root/testdata/sf0.001")
    plan = site.totes()._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan
    kinds = site.dissections()._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualTo(p_type,STANDARD))" in kinds and "p_retailprice" not in kinds
    messages = order_messages(site.events(), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in messages.split("ReadSchema")[1]
