"""Sale prices out of order messages.

A message is a list of fixed-width records between pipes. All parsing is on columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from slotflow.functions.columns import to_number, without_first

# Name, first and last position of each field of a line record.
FIELDS = [
    ("seqno", 1, 38),
    ("recordid", 39, 44),
    ("date", 45, 52),
    ("time", 53, 58),
    ("dc", 59, 62),
    ("hostid", 63, 64),
    ("orderid", 65, 84),
    ("orderline", 85, 89),
    ("prodid", 90, 97),
    ("max_qty", 98, 103),
    ("min_qty", 104, 109),
    ("clearind", 110, 110),
    ("glmessage", 111, 160),
    ("refno1", 161, 166),
    ("refno2", 167, 170),
    ("saleprice", 171, 180),
]
NUMERIC = ("dc", "orderline", "max_qty", "min_qty", "saleprice")
LINE_RECORD = "ORL"
MARK = "@"


def price_lines(messages: DataFrame, trim: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """The 16 fields of every line record whose five numbers all parse, behind the columns ``keep`` of its message.

    The first ``@`` of a field is dropped. Blanks stay, unless ``trim``. Works row by row, so
    it takes a stream as well.
    """
    records = messages.select(*keep, F.explode(F.split("raw_message", r"\|")).alias("record"))
    lines = records.filter(F.substring("record", 39, 3) == LINE_RECORD)

    def field(name: str, first: int, last: int):
        text = F.substring("record", first, last - first + 1)
        text = without_first(F.trim(text) if trim else text, MARK)
        return (to_number(text) if name in NUMERIC else text).alias(name)

    # Text cut out of a record is never NULL, so only the numbers can be missing.
    parsed = lines.select(*keep, *[field(*spec) for spec in FIELDS])
    return parsed.filter(" and ".join(f"{name} is not null" for name in NUMERIC))


def min_sale_price(lines: DataFrame) -> DataFrame:
    """[prodid, saleprice]: the lowest price of each product, pence to pounds."""
    return lines.groupBy("prodid").agg(F.min(F.col("saleprice") / 100).alias("saleprice"))


def priced_features(features: DataFrame, prices: DataFrame) -> DataFrame:
    """Features with ``selling_price`` and ``reduction`` last.

    A product without a sale price, or with 0, sells at its selling price.
    """
    sale = F.col("saleprice")
    paid = F.when(sale.isNull() | (sale == 0), F.col("selling_price")).otherwise(sale)
    label = [c for c in features.columns if c == "sold_rep_units"]
    kept = [c for c in features.columns if c not in ("selling_price", *label)]
    return features.join(prices.withColumnRenamed("prodid", "prod_id"), "prod_id", "left").select(
        *kept, "selling_price", (F.col("selling_price") - paid).alias("reduction"), *label
    )
