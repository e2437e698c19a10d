"""Move rules: hand-made cases, the four rules one by one, and properties."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime

import pytest

from slotflow.operators import moves as M
from slotflow.operators.expected import expected_demand, forecast_demand
from slotflow.operators.stock import rank_stock

LOCATED = "location string, locno string, z_pos long, licenceplate string, item_number string, quantity long"
WANTED = "prod_id string, exp_demand long"
AT = datetime(2024, 5, 1, 17, 15)


def ranked(spark, totes):
    """Stock of (zone, plate, item, quantity)."""
    rows = [(zone, f"L-{plate}", 0, plate, item, quantity) for zone, plate, item, quantity in totes]
    return rank_stock(spark.createDataFrame(rows, LOCATED), slices=2)


def planned(spark, totes, wanted):
    plan = M.plan_moves(ranked(spark, totes), spark.createDataFrame(wanted, WANTED))
    return sorted((r.licenceplate, r.item_number, r.reason) for r in plan.collect())


def test_exact_cover_moves_nothing(spark):
    assert planned(spark, [("OSR", "T1", "A", 5), ("ASRS", "T2", "A", 5)], [("A", 5)]) == []


def test_no_demand_leaves_the_picking_zone_only(spark):
    totes = [("OSR", "T1", "A", 5), ("OSR", "T2", "A", 3), ("ASRS", "T3", "A", 9)]
    assert planned(spark, totes, [("B", 4)]) == [("T1", "A", "no_demand"), ("T2", "A", "no_demand")]


def test_missing_demand_is_no_demand(spark):
    assert planned(spark, [("OSR", "T1", "A", 5), ("ASRS", "T2", "A", 5)], [("A", None)]) == [("T1", "A", "no_demand")]


def test_surplus_keeps_the_crossing_tote(spark):
    totes = [("OSR", "T1", "A", 6), ("OSR", "T2", "A", 5), ("OSR", "T3", "A", 4)]
    assert planned(spark, totes, [("A", 8)]) == [("T3", "A", "surplus")]


def test_demand_zero_still_keeps_one_tote(spark):
    totes = [("OSR", "T1", "A", 6), ("OSR", "T2", "A", 5), ("ASRS", "T3", "A", 5)]
    assert planned(spark, totes, [("A", 0)]) == [("T2", "A", "surplus")]


def test_shortfall_takes_totes_up_to_the_crossing_one(spark):
    totes = [("OSR", "T1", "A", 2), ("ASRS", "T2", "A", 4), ("ASRS", "T3", "A", 3), ("ASRS", "T4", "A", 1)]
    assert planned(spark, totes, [("A", 8)]) == [("T2", "A", "shortfall"), ("T3", "A", "shortfall")]


def test_demand_above_all_stock_takes_everything(spark):
    totes = [("OSR", "T1", "A", 2), ("ASRS", "T2", "A", 4), ("ASRS", "T3", "A", 3)]
    assert planned(spark, totes, [("A", 100)]) == [("T2", "A", "shortfall"), ("T3", "A", "shortfall")]


def test_absent_item_is_brought(spark):
    totes = [("ASRS", "T2", "A", 4), ("ASRS", "T3", "A", 3)]
    assert planned(spark, totes, [("A", 4)]) == [("T2", "A", "absent")]


def test_a_shared_tote_follows_each_item(spark):
    totes = [("OSR", "T1", "A", 4), ("OSR", "T1", "B", 4)]
    assert planned(spark, totes, [("B", 4)]) == [("T1", "A", "no_demand")]


def test_copies_of_a_stock_row_share_the_crossing_total(spark):
    totes = [("OSR", "T1", "A", 4)] * 3
    assert planned(spark, totes, [("A", 12)]) == [("T1", "A", "surplus")] * 2


def test_a_product_listed_twice_stops_the_job(spark):
    with pytest.raises(Exception, match="more than once"):
        planned(spark, [("OSR", "T1", "A", 4)], [("A", 4), ("A", 5)])


def four_rules(totes, wanted):
    """The plan rule by rule, with loops."""
    zones = defaultdict(list)
    for zone, plate, item, quantity in totes:
        zones[item, zone].append((quantity, plate))
    moves = []
    for (item, zone), held in zones.items():
        # Every tote has its own place here, so the count per place does not matter.
        held.sort(key=lambda t: (-t[0], t[1]))
        demand = wanted.get(item)
        osr = zones.get((item, "OSR"), [])
        total = sum(q for q, _ in osr)
        running, crossed = 0, False
        for quantity, plate in held:
            running += quantity
            if zone == "OSR":
                if demand is None:
                    moves.append((plate, item, "no_demand"))
                elif total >= demand and running >= demand:
                    if crossed:
                        moves.append((plate, item, "surplus"))
                    crossed = True
            elif demand is not None and (not osr or total < demand):
                if not crossed:
                    moves.append((plate, item, "shortfall" if osr else "absent"))
                crossed = crossed or running >= demand - total
    return Counter(moves)


@pytest.mark.parametrize("seed", range(3))
def test_one_pass_equals_the_rules(spark, seed):
    rng = random.Random(seed)
    totes = [
        (rng.choice(["OSR", "ASRS"]), f"T{i:04d}", f"I{rng.randrange(30)}", rng.randrange(1, 30)) for i in range(300)
    ]
    totes += [(rng.choice(["OSR", "ASRS"]), f"N{i:04d}", None, rng.randrange(1, 30)) for i in range(20)]
    wanted = {f"I{i}": rng.randrange(0, 200) for i in range(40) if rng.random() < 0.7}
    found = M.plan_moves(ranked(spark, totes), spark.createDataFrame(list(wanted.items()), WANTED)).collect()
    plan = Counter((r.licenceplate, r.item_number, r.reason) for r in found)
    assert plan == four_rules(totes, wanted)
    stock, asked = ranked(spark, totes), spark.createDataFrame(list(wanted.items()), WANTED)
    for reason in ("no_demand", "surplus", "shortfall", "absent"):
        rows = getattr(M, f"moves_{reason}")(stock, asked).collect()
        assert Counter((r.licenceplate, r.item_number, reason) for r in rows) == Counter(
            {k: n for k, n in plan.items() if k[2] == reason}
        )
    # After the moves every item is covered as far as stock reaches, and no brought tote is spare.
    quantity = {(plate, item): q for _, plate, item, q in totes}
    after = defaultdict(int)
    for zone, plate, item, q in totes:
        after[item] += q if zone == "OSR" else 0
    for plate, item, reason in plan:
        after[item] += quantity[plate, item] * (1 if reason in ("shortfall", "absent") else -1)
    for item, demand in wanted.items():
        everything = sum(q for _, _, i, q in totes if i == item)
        assert after[item] >= min(demand, everything)
        brought = [quantity[p, i] for p, i, reason in plan if i == item and reason in ("shortfall", "absent")]
        if brought and everything >= demand:
            assert after[item] - min(brought) < demand
    assert len({(p, i) for p, i, _ in plan}) == len(plan)


def test_shortfall_amounts(spark):
    totes = [("OSR", "T1", "A", 2), ("OSR", "T2", "A", 3), ("OSR", "T3", "B", 9), ("ASRS", "T4", "C", 9)]
    asked = spark.createDataFrame([("A", 8), ("B", 9), ("C", 1)], WANTED)
    found = M.osr_shortfall(ranked(spark, totes), asked).collect()
    assert [(r.item_number, r.required) for r in found] == [("A", 3)]


def test_instructions_repeat_a_tote_unless_distinct(spark):
    stock = ranked(spark, [("OSR", "T1", "A", 4), ("OSR", "T1", "B", 4), ("ASRS", "T2", "C", 1)])
    asked = spark.createDataFrame([("C", 1)], WANTED)
    everything = M.moves(stock, asked, AT).collect()
    assert sorted((r.licenceplate, r.target_state_name) for r in everything) == [
        ("T1", "Z-MOVE_ASRS"),
        ("T1", "Z-MOVE_ASRS"),
        ("T2", "Z-MOVE_OSR"),
    ]
    assert {(r.source_zone_name, r.timestamp, r.status) for r in everything} == {("Z-ABIN2BIN", AT, 10)}
    assert M.moves(stock, asked, AT, distinct=True).count() == 2
    assert [r.licenceplate for r in M.moves_to_osr(stock, asked, AT).collect()] == ["T2"]
    assert M.moves_to_asrs(stock, asked, AT).count() == 2


def test_confirmed_sales_win_only_where_stocked(spark):
    stock = ranked(spark, [("OSR", "T1", "A", 4), ("OSR", "T2", "C", 4)])
    confirmed = spark.createDataFrame([("A", 0), ("B", 5)], "prod_id string, demand long")
    forecast = spark.createDataFrame([("A", 9), ("B", 7), ("C", -2), ("D", 0), ("E", 3)], "prod_id string, forecast long")
    found = {r.prod_id: r.exp_demand for r in expected_demand(confirmed, forecast, stock).collect()}
    assert found == {"A": 0, "B": 7, "E": 3}


def test_forecasts_round_half_to_even_and_stay_positive(spark):
    rows = [("a", 0.5), ("b", 1.5), ("c", 2.5), ("d", -3.0), ("e", 0.4)]
    found = forecast_demand(spark.createDataFrame(rows, "prod_id string, prediction double")).collect()
    assert {r.prod_id: r.forecast for r in found} == {"b": 2, "c": 2}
