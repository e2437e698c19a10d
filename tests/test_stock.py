"""Ranked stock against a plain loop."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window, functions as F

from slotflow.operators.running import running_totals
from slotflow.operators.stock import located_stock, rank_stock, tote_stock
from slotflow.sources.fixture import Fixture

LOCATED = "location string, locno string, z_pos long, licenceplate string, item_number string, quantity long"


def low(value):
    return (value is None, value or 0 if not isinstance(value, str) else value)


def expected_ranks(rows):
    """(row, loccount, cumunits, itemrank), by sorting each group."""
    places = Counter((r[4], r[1], r[0]) for r in rows)
    groups = defaultdict(list)
    for r in rows:
        count = places[(r[4], r[1], r[0])]
        groups[(r[4], r[0])].append((-r[5], -count, r[1], r[2], r[3], r))
    out = []
    for members in groups.values():
        members.sort(key=lambda m: m[:5])
        for rank, m in enumerate(members, 1):
            total = sum(o[5][5] for o in members if o[:5] <= m[:5])
            out.append((*m[5], -m[1], total, rank))
    return Counter(out)


def found_ranks(df):
    columns = ["location", "locno", "z_pos", "licenceplate", "item_number", "quantity", "loccount", "cumunits", "itemrank"]
    return Counter(tuple(r) for r in df.select(*columns).collect())


def make_rows(n, items, seed):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["OSR", "ASRS"]),
            f"L{rng.randrange(5)}",
            rng.randrange(2),
            f"T{rng.randrange(n)}",
            f"I{rng.randrange(items)}",
            rng.randrange(1, 6),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("slices", [None, 1, 7])
def test_ranks_match_sorting(spark, slices, seed):
    rows = make_rows(400, 3, seed)
    assert found_ranks(rank_stock(spark.createDataFrame(rows, LOCATED).repartition(4), slices)) == expected_ranks(rows)


@pytest.mark.parametrize("slices", [1, 3])
def test_copies_share_a_total_and_have_their_own_rank(spark, slices):
    rows = [("OSR", "L1", 0, "T1", "I1", 5)] * 6 + [("OSR", "L1", 0, "T2", "I1", 5)]
    ranked = rank_stock(spark.createDataFrame(rows, LOCATED), slices)
    found = sorted((r.itemrank, r.licenceplate, r.cumunits) for r in ranked.collect())
    assert found == [(i, "T1", 30) for i in range(1, 7)] + [(7, "T2", 35)]


def test_a_hot_item_is_spread_over_slices(spark):
    rows = make_rows(3000, 1, 5)
    ranked = rank_stock(spark.createDataFrame(rows, LOCATED).repartition(4), slices=8)
    assert found_ranks(ranked) == expected_ranks(rows)


@pytest.mark.parametrize("slices", [1, 5])
def test_rows_without_an_item_or_a_place_stay(spark, slices):
    rows = make_rows(60, 2, 3)
    rows += [(zone, f"L{i % 2}" if i % 5 else None, i % 2, f"N{i}", None, i % 4 + 1) for i, zone in enumerate(["OSR", "ASRS"] * 15)]
    ranked = rank_stock(spark.createDataFrame(rows, LOCATED).repartition(3), slices)
    assert ranked.count() == len(rows)
    missing = [r for r in ranked.collect() if r.item_number is None]
    for zone in ("OSR", "ASRS"):
        mine = sorted((r for r in missing if r.location == zone), key=lambda r: r.itemrank)
        assert [r.itemrank for r in mine] == list(range(1, 16))
        assert mine[-1].cumunits == sum(r.quantity for r in mine)


def test_missing_quantity_comes_first(spark):
    rows = [("OSR", "L1", 0, "T1", "I1", None), ("OSR", "L1", 0, "T2", "I1", 4)]
    for slices in (1, 2):
        ranked = rank_stock(spark.createDataFrame(rows, LOCATED), slices)
        assert sorted((r.itemrank, r.licenceplate, r.cumunits) for r in ranked.collect()) == [(1, "T1", None), (2, "T2", 4)]


def source_tables(spark):
    return dict(
        stock=spark.createDataFrame(
            [("C1", 1, 5), ("C2", 1, 7), ("C3", 1, 9), ("C4", 1, 11), ("C5", 1, 13)], "cont_id string, item_id long, act_quantity long"
        ),
        totes=spark.createDataFrame(
            [("C1", "T1", 1, 1, 0), ("C2", "T2", 2, 1, 1), ("C3", "T3", 3, 1, 0), ("C4", "T4", 1, 0, 0), ("C5", "T5", 4, 1, 0)],
            "id string, licenceplate string, loc_id long, cont_type_id long, z_pos long",
        ),
        items=spark.createDataFrame([(1, "00000001")], "id long, item_number string"),
        locations=spark.createDataFrame(
            [(1, "OSM001"), (2, "ASM002"), (3, "XSM003"), (4, "OSM004")], "id long, locno string"
        ),
        location_states=spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 2)], "loc_id long, state_id long"),
        states=spark.createDataFrame([(1, 2), (2, 1)], "id long, domain_id long"),
    )


def test_other_prefixes_containers_and_domains_are_left_out(spark):
    found = located_stock(**source_tables(spark)).collect()
    assert sorted((r.licenceplate, r.location) for r in found) == [("T1", "OSR"), ("T2", "ASRS")]


def test_stock_from_source_tables(spark):
    ranked = tote_stock(**source_tables(spark)).collect()
    assert sorted((r.licenceplate, r.location, r.cumunits, r.itemrank) for r in ranked) == [("T1", "OSR", 5, 1), ("T2", "ASRS", 7, 1)]


def test_totals_are_joined_without_another_shuffle(spark):
    """Sums of earlier slices meet the rows where the windows left them: three of the four exchanges move sums alone."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(500).selectExpr("if(id % 5 = 0, null, id % 3) g", "id % 7 v", "id k")
        ranked = running_totals(rows, ["g"], [F.col("k").asc()], "v", "t", "r", slices=4)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 4, plan
        whole = Window.partitionBy("g").orderBy("k")
        assert ranked.exceptAll(rows.select("*", F.sum("v").over(whole).alias("t"), F.row_number().over(whole).cast("long").alias("r"))).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_totes_and_stock_meet_where_their_lines_were_placed(spark):
    """A shuffle of the lines each, none of totes and none for the join; their name is not shuffled."""
    site = Fixture(spark, "/root/testdata/sf0.001")
    stock, totes = site.stock(), site.totes()
    assert exchanges(stock) == exchanges(totes) == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(stock.join(totes.withColumnRenamed("id", "cont_id"), "cont_id")) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_are_worked_out_once_for_the_slices(spark):
    """The sample that finds the ranges reads stored rows."""
    seen = spark.sparkContext.accumulator(0)

    def looked(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 400, numPartitions=4).selectExpr("id % 3 g", "id k", "id % 7 v")
    running_totals(rows.mapInArrow(looked, rows.schema), ["g"], [F.col("k").asc()], "v", "t", "r", slices=4).count()
    assert seen.value == 400


@pytest.mark.parametrize("most", [0, 130, 400])
def test_items_are_ranked_in_place_or_in_slices(spark, most):
    """By the size of their bucket: all in slices, some, none."""
    rows = make_rows(300, 3, 4) + make_rows(40, 1, 6) * 2 + [("OSR", "L1", 0, f"N{i}", "I1", None) for i in range(3)]
    found = rank_stock(spark.createDataFrame(rows, LOCATED).repartition(4), most=most)
    assert found_ranks(found) == found_ranks(rank_stock(spark.createDataFrame(rows, LOCATED), slices=1))


def test_small_items_are_shuffled_once(spark):
    """Ranks and whatever is joined by item come from one shuffle of the stock."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = rank_stock(spark.createDataFrame(make_rows(200, 5, 7), LOCATED))
        assert exchanges(ranked) == 1
        items = spark.createDataFrame([(f"I{i}", i) for i in range(5)], "item_number string, kind long")
        assert exchanges(ranked.join(items, "item_number", "left")) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
