"""Record parsing and prices."""

from __future__ import annotations

from datetime import date

import pytest

from slotflow.operators.prices import min_sale_price, price_lines, priced_features
from slotflow.sources.tables import order_messages


def record(kind="ORL", prodid="00000001", max_qty="000005", price="0000000250", note="note", dc="0001"):
    return (
        "1".ljust(38)
        + kind.ljust(6)
        + "20240501"
        + "171500"
        + dc
        + "HO"
        + "77".ljust(20)
        + "00001"
        + prodid
        + max_qty
        + "000001"
        + "N"
        + note.ljust(50)
        + "REF001"
        + "REF2"
        + price
    )


def parse(spark, *messages, trim=False):
    return price_lines(spark.createDataFrame([(m,) for m in messages], "raw_message string"), trim).collect()


def test_fields_and_other_records(spark):
    rows = parse(spark, "|".join([record("ORH"), record(), record(prodid="00000002"), ""]))
    assert [r.prodid for r in rows] == ["00000001", "00000002"]
    first = rows[0]
    assert (first.seqno, first.recordid, first.date, first.time) == ("1".ljust(38), "ORL   ", "20240501", "171500")
    assert (first.dc, first.orderline, first.max_qty, first.min_qty, first.saleprice) == (1, 1, 5, 1, 250)
    assert (first.hostid, first.orderid, first.clearind, first.refno1, first.refno2) == ("HO", "77".ljust(20), "N", "REF001", "REF2")
    assert first.glmessage == "note".ljust(50)


@pytest.mark.parametrize("text", ["xxxxxxxxxx", "          ", "1d        ", "NaN       ", "Infinity  ", "0x10      ", "1 2       "])
def test_a_bad_number_drops_the_line(spark, text):
    assert parse(spark, record(price=text)) == []


@pytest.mark.parametrize("text, value", [("12.50     ", 12.5), ("      +7.0", 7.0), ("1e2       ", 100.0), (".5        ", 0.5), ("@000000042", 42.0)])
def test_numbers_that_count(spark, text, value):
    assert [r.saleprice for r in parse(spark, record(price=text))] == [value]


def test_only_the_first_mark_goes(spark):
    assert parse(spark, record(note="a@b@c"))[0].glmessage == "ab@c".ljust(49)


def test_blanks_stay_unless_trimmed(spark):
    message = record(prodid=" 12     ")
    assert parse(spark, message)[0].prodid == " 12     "
    assert parse(spark, message, trim=True)[0].prodid == "12"


def test_short_empty_and_missing_messages(spark):
    assert parse(spark, record()[:120], "", None, "|||") == []


def test_lowest_price_in_pounds(spark):
    lines = [record(price="0000000250"), record(price="0000000199"), record(prodid="00000002", price="0000000000")]
    found = min_sale_price(price_lines(spark.createDataFrame([("|".join(lines),)], "raw_message string"))).collect()
    assert {r.prodid: r.saleprice for r in found} == {"00000001": 1.99, "00000002": 0.0}


def test_price_fallback_and_reduction(spark):
    features = spark.createDataFrame([("a", 10.0, 1), ("b", 10.0, 2), ("c", 10.0, 3)], "prod_id string, selling_price double, uplb int")
    prices = spark.createDataFrame([("a", 7.5), ("b", 0.0)], "prodid string, saleprice double")
    priced = priced_features(features, prices)
    assert priced.columns == ["prod_id", "uplb", "selling_price", "reduction"]
    assert {r.prod_id: (r.selling_price, r.reduction) for r in priced.collect()} == {"a": (10.0, 2.5), "b": (10.0, 0.0), "c": (10.0, 0.0)}


def test_messages_of_the_day_before(spark):
    rows = [("ORH", "2024-04-30 23:59:59", "a"), ("ORH", "2024-05-01 00:00:00", "b"), ("XXX", "2024-04-30 10:00:00", "c"), ("ORH", "2024-04-30 00:00:00", "d")]
    events = spark.createDataFrame(rows, "telegram_type string, creation_time string, raw_message string")
    events = events.selectExpr("telegram_type", "cast(creation_time as timestamp_ntz) creation_time", "raw_message")
    assert sorted(r.raw_message for r in order_messages(events, date(2024, 5, 1)).collect()) == ["a", "d"]
