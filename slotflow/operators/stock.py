"""Stock per tote, ranked within item and zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotflow.operators.running import running_totals
from slotflow.session import materialize

# Location prefix of each zone, container type left out, domain kept.
ZONES = {"OSM": "OSR", "ASM": "ASRS"}
NO_CONTAINER = 0
STORAGE_DOMAIN = 2

# Items lie in so many buckets by hash; those of a bucket of more rows are ranked in slices.
BUCKETS = 8192
MOST_ROWS = 200_000

RANKED = ["location", "locno", "z_pos", "loccount", "licenceplate", "item_number", "quantity", "cumunits", "itemrank"]


def located_stock(
    stock: DataFrame,
    totes: DataFrame,
    items: DataFrame,
    locations: DataFrame,
    location_states: DataFrame,
    states: DataFrame,
) -> DataFrame:
    """One row per stock record in a zone: [location, locno, z_pos, licenceplate, item_number, quantity].

    The three location tables meet first, so that their filters reduce what totes and
    stock are joined with.
    """
    prefix = F.substring("locno", 1, 3)
    zone = F.lit(None).cast("string")
    for code, name in ZONES.items():
        zone = F.when(prefix == code, name).otherwise(zone)
    places = (
        locations.filter(prefix.isin(*ZONES))
        .select(F.col("id").alias("loc_id"), "locno", zone.alias("location"))
        .join(location_states.select("loc_id", "state_id"), "loc_id")
        .join(states.filter(F.col("domain_id") == STORAGE_DOMAIN).select(F.col("id").alias("state_id")), "state_id")
    )
    # stored, so that the planner knows how few they are: guessing high, it shuffles all totes to meet them, unless they happen to come first
    places = materialize(places)
    placed_totes = (
        totes.filter(F.col("cont_type_id") != NO_CONTAINER)
        .select(F.col("id").alias("cont_id"), "licenceplate", "z_pos", "loc_id")
        .join(places, "loc_id")
    )
    return (
        stock.select("cont_id", "item_id", F.col("act_quantity").alias("quantity"))
        .join(placed_totes, "cont_id")
        .join(items.select(F.col("id").alias("item_id"), "item_number"), "item_id")
        .select("location", "locno", "z_pos", "licenceplate", "item_number", "quantity")
    )


def _order() -> list[Column]:
    return [
        F.col("quantity").desc_nulls_first(),
        F.col("loccount").desc_nulls_first(),
        F.col("locno").asc_nulls_last(),
        F.col("z_pos").asc_nulls_last(),
        F.col("licenceplate").asc_nulls_last(),
    ]


def rank_stock(located: DataFrame, slices: int | None = None, most: int = MOST_ROWS) -> DataFrame:
    """Adds loccount, cumunits and itemrank; the largest totes of an item come first.

    Items whose bucket holds ``most`` rows or fewer are ranked where one shuffle by item puts them, and stay there for what is joined by item.
    The others are ranked in slices, so that no task sees a whole large item; with ``slices`` all items are. Rows without an item are ranked together.
    """
    located = materialize(located)
    if slices:
        return _rank_in_slices(located, slices)
    bucket = F.pmod(F.xxhash64("item_number"), F.lit(BUCKETS))
    sizes = located.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    large = [r["_bucket"] for r in sizes.filter(F.col("_rows") > most).collect()]
    if not large:
        return _rank_in_place(located)
    return _rank_in_place(located.filter(~bucket.isin(large))).unionByName(_rank_in_slices(located.filter(bucket.isin(large))))


def _rank_in_place(located: DataFrame) -> DataFrame:
    """Ranks of items that a task holds whole; copies of a row share a total, as in slices."""
    place, group = ["item_number", "location", "locno"], ["item_number", "location"]
    counted = located.repartition("item_number").withColumn("loccount", F.count(F.lit(1)).over(Window.partitionBy(*place)))
    ordered = Window.partitionBy(*group).orderBy(*_order())
    return counted.withColumns(
        {"cumunits": F.sum("quantity").over(ordered), "itemrank": F.row_number().over(ordered).cast("long")}
    ).select(*RANKED)


def _rank_in_slices(located: DataFrame, slices: int | None = None) -> DataFrame:
    """The count is an aggregate, stored so that the join with it can split, and the ranks come slice by slice."""
    place = ["item_number", "locno", "location"]
    # A struct equals another with the same nulls, and rows joined on it lie together for the count of their copies.
    placed = located.select(F.struct(*place).alias("_place"), *[c for c in located.columns if c not in place])
    counts = materialize(placed.groupBy("_place").agg(F.count(F.lit(1)).alias("loccount")))
    counted = placed.join(counts, "_place").groupBy("_place", "z_pos", "licenceplate", "quantity", "loccount").agg(F.count(F.lit(1)).alias("copies"))
    ranked = running_totals(
        counted.select("_place.*", *counted.columns[1:]),
        group=["item_number", "location"],
        order=_order(),
        value="quantity",
        total="cumunits",
        rank="itemrank",
        slices=slices,
        copies="copies",
    )
    return ranked.select(*RANKED)


def tote_stock(
    stock: DataFrame,
    totes: DataFrame,
    items: DataFrame,
    locations: DataFrame,
    location_states: DataFrame,
    states: DataFrame,
    slices: int | None = None,
) -> DataFrame:
    """Stock in both zones with ranks."""
    return rank_stock(located_stock(stock, totes, items, locations, location_states, states), slices)
