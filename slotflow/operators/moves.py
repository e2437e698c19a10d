"""Which totes move between the zones.

The bulk zone is ASRS, the picking zone OSR. Two tables with a row per item carry the plan: the
units in OSR against the demand, and the first tote of each zone at which the running total
reaches what is needed. Both are aggregates, combined before the shuffle. Stock rows meet them
in joins whose other side is a stored table with unique items, which AQE can split on a hot
item; no step ranks a whole item in one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from slotflow.functions.checks import unique
from slotflow.session import materialize

# Fixed values of a move instruction.
TARGETS = {"no_demand": "Z-MOVE_ASRS", "surplus": "Z-MOVE_ASRS", "shortfall": "Z-MOVE_OSR", "absent": "Z-MOVE_OSR"}
SOURCE_ZONE = "Z-ABIN2BIN"
NEW = 10

ROW = ["item_number", "location", "locno", "licenceplate", "quantity"]


def _in_zone(name: str) -> Column:
    return F.col("location") == name


def _wanted(expected: DataFrame) -> DataFrame:
    """[item_number, exp_demand]. A demand that is NULL is none; a product listed twice stops the job."""
    known = unique(expected, "prod_id").filter(F.col("exp_demand").isNotNull())
    return known.select(F.col("prod_id").alias("item_number"), "exp_demand")


def item_positions(stock: DataFrame, expected: DataFrame) -> DataFrame:
    """[item_number, osr_rows, osr_units, exp_demand], one row per stocked item."""
    held = stock.groupBy("item_number").agg(
        F.count(F.when(_in_zone("OSR"), F.lit(1))).alias("osr_rows"),
        F.sum(F.when(_in_zone("OSR"), F.col("quantity"))).alias("osr_units"),
    )
    return held.join(_wanted(expected), "item_number", "left")


def plan_moves(stock: DataFrame, expected: DataFrame) -> DataFrame:
    """Every stock row that moves, with the reason.

    ``stock`` is read three times: pass a stored table or a materialized frame.
    """
    in_osr, place = _in_zone("OSR"), F.struct("cumunits", "itemrank")
    needed = F.col("exp_demand") - F.when(in_osr, 0).otherwise(F.coalesce("osr_units", F.lit(0)))
    reached = needed <= F.col("cumunits")

    positions = materialize(item_positions(stock, expected))
    crossing = (
        stock.join(positions, "item_number")
        .filter(reached)
        .groupBy("item_number")
        .agg(F.min(F.when(in_osr, place)).alias("first_osr"), F.min(F.when(~in_osr, place)).alias("first_asrs"))
    )
    facts = materialize(positions.join(crossing, "item_number", "left"))

    crosses = place == F.when(in_osr, F.col("first_osr")).otherwise(F.col("first_asrs"))
    wanted, covered = F.col("exp_demand").isNotNull(), F.col("osr_units") >= F.col("exp_demand")
    brought = ~reached | crosses
    reason = (
        F.when(in_osr & ~wanted, "no_demand")
        .when(in_osr & covered & reached & ~crosses, "surplus")
        .when(~in_osr & (F.col("osr_rows") > 0) & ~covered & brought, "shortfall")
        .when(~in_osr & wanted & (F.col("osr_rows") == 0) & brought, "absent")
    )
    # Rows without an item meet no facts: nobody asks for them.
    judged = stock.join(facts, "item_number", "left").select(*ROW, reason.alias("reason"))
    return judged.filter(F.col("reason").isNotNull())


def _branch(reason: str):
    def branch(stock: DataFrame, expected: DataFrame) -> DataFrame:
        return plan_moves(stock, expected).filter(F.col("reason") == reason).select(*ROW)

    return branch


def moves_no_demand(stock: DataFrame, expected: DataFrame) -> DataFrame:
    """OSR rows of items nobody asks for."""
    wanted = materialize(_wanted(expected))
    return stock.filter(_in_zone("OSR")).join(wanted, "item_number", "left_anti").select(*ROW)


moves_surplus = _branch("surplus")
moves_surplus.__doc__ = "OSR rows beyond the tote that reaches the demand, where OSR covers it."
moves_shortfall = _branch("shortfall")
moves_shortfall.__doc__ = "ASRS rows, up to the tote that covers what OSR lacks."
moves_absent = _branch("absent")
moves_absent.__doc__ = "ASRS rows, up to the tote that covers the demand, of items not in OSR."


def osr_shortfall(stock: DataFrame, expected: DataFrame) -> DataFrame:
    """[item_number, required]: what OSR lacks, for items it holds."""
    required = (F.col("exp_demand") - F.col("osr_units")).alias("required")
    positions = item_positions(stock.filter(_in_zone("OSR")), expected)
    return positions.select("item_number", required).filter(F.col("required") > 0)


def instructions(planned: DataFrame, created_at: datetime, distinct: bool = False) -> DataFrame:
    """[licenceplate, target_state_name, source_zone_name, timestamp, status] of planned rows.

    A tote with several affected items is repeated unless ``distinct``.
    """
    target = F.lit(None).cast("string")
    for reason, name in TARGETS.items():
        target = F.when(F.col("reason") == reason, name).otherwise(target)
    plates = planned.select("licenceplate", target.alias("target_state_name"))
    if distinct:
        plates = plates.distinct()
    return plates.select(
        "licenceplate",
        "target_state_name",
        F.lit(SOURCE_ZONE).alias("source_zone_name"),
        F.lit(created_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("timestamp"),
        F.lit(NEW).cast("long").alias("status"),
    )


def moves(stock: DataFrame, expected: DataFrame, created_at: datetime, distinct: bool = False) -> DataFrame:
    """All instructions of the day."""
    return instructions(plan_moves(stock, expected), created_at, distinct)


def moves_to_osr(stock: DataFrame, expected: DataFrame, created_at: datetime, distinct: bool = False) -> DataFrame:
    """Instructions into the picking zone."""
    planned = plan_moves(stock, expected).filter(F.col("reason").isin("shortfall", "absent"))
    return instructions(planned, created_at, distinct)


def moves_to_asrs(stock: DataFrame, expected: DataFrame, created_at: datetime, distinct: bool = False) -> DataFrame:
    """Instructions into the bulk zone."""
    planned = plan_moves(stock, expected).filter(F.col("reason").isin("no_demand", "surplus"))
    return instructions(planned, created_at, distinct)
