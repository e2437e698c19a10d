"""The test tables read as a warehouse.

Each method derives one domain table from the star-schema Parquet files, whole, with the
expressions FIXTURES.md lists. Only tests, benchmarks and the registered queries use this.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slotflow.operators.stock import tote_stock
from slotflow.session import configure
from slotflow.sources.tables import load

AS_OF = date(1998, 7, 1)
CREATED_AT = datetime(1998, 6, 30, 17, 15)

SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
}


def pid(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 8, "0")


def requested() -> Column:
    """Units of an order line: some products are asked for in larger numbers, by kind."""
    part = F.col("l_partkey")
    base = F.col("l_quantity").cast("long") % 4 + 1
    return base + F.when(part % 4 == 0, 40).otherwise(0) + F.when(part % 3 == 0, 15).otherwise(0)


def days_before(day: date, key: str, cycle: int) -> Column:
    return F.date_sub(F.lit(day), (F.col(key) % cycle).cast("int"))


class Fixture:
    """Domain tables over one test folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def table(self, name: str) -> DataFrame:
        return load(self.spark, self.folder, name, SCHEMAS[name])

    # Orders: the live system holds the last twelve days, the archive what is older than ten.

    @staticmethod
    def _live(df: DataFrame, day: Column) -> DataFrame:
        return df.filter(day >= F.lit(AS_OF - timedelta(days=12)))

    @staticmethod
    def _archived(df: DataFrame, day: Column) -> DataFrame:
        return df.filter(day < F.lit(AS_OF - timedelta(days=10)))

    def _headers(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            days_before(AS_OF, "o_orderkey", 40).alias("creation_time"),
            F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("order_type"),
        )

    def headers_live(self) -> DataFrame:
        return self._live(self._headers(), F.col("creation_time"))

    def headers_archive(self) -> DataFrame:
        return self._archived(self._headers(), F.col("creation_time"))

    def _lines(self) -> DataFrame:
        return self.table("lineitem")

    def _line_columns(self, df: DataFrame) -> DataFrame:
        return df.select(
            F.col("l_orderkey").alias("originator_header_id"),
            F.col("l_linenumber").cast("long").alias("line_no"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_suppkey").alias("supp_id"),
            requested().alias("requested_quantity"),
            F.col("l_extendedprice").alias("ext"),
        )

    def lines_live(self) -> DataFrame:
        return self._line_columns(self._live(self._lines(), days_before(AS_OF, "l_orderkey", 40)))

    def lines_archive(self) -> DataFrame:
        return self._line_columns(self._archived(self._lines(), days_before(AS_OF, "l_orderkey", 40)))

    # Products and stock snapshots.

    def products(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("id"), pid("p_partkey").alias("system_product_id"))

    def assortment(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        return self.table("part").select(
            pid("p_partkey").alias("prod_id"),
            F.concat("p_type", F.lit("-"), key.cast("string")).alias("prod_code"),
            F.when(key % 4 == 0, "Y").otherwise("N").alias("hanging_garment"),
            size.cast("long").alias("brom_size"),
            F.when(key % 3 == 0, "S").otherwise("F").alias("sor_indicator"),
            (size % 12 + 1).cast("long").alias("uplb"),
            (size * 7).alias("length"),
            (size * 5).alias("width"),
            (size * 3).alias("height"),
            F.round(F.col("p_retailprice") * 100).cast("long").alias("selling_price"),
            F.when(key % 10 == 0, 0).otherwise(1).alias("state"),
        )

    def dissections(self) -> DataFrame:
        code = F.substring("p_type", 1, 3)
        kinds = self.table("part").filter(F.col("p_type") != "STANDARD").select(code.alias("dissection")).distinct()
        kind = F.col("dissection")
        return kinds.select(
            kind,
            F.when(kind.isin("ECO", "SMA"), "HOME").otherwise("FASHION").alias("directorate"),
            F.when(kind == "PRO", 25).otherwise(12).cast("long").alias("partner_discount"),
        )

    def snapshots(self) -> DataFrame:
        return self.table("lineitem").select(
            days_before(AS_OF - timedelta(days=1), "l_orderkey", 35).alias("snap_date"),
            pid("l_partkey").alias("prod_id"),
            F.col("l_quantity").cast("long").alias("units"),
        )

    # Totes.

    @staticmethod
    def _plate() -> Column:
        return F.concat(
            F.lit("T"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")
        )

    def _placed(self, *columns: str) -> DataFrame:
        """Order lines with their tote, placed by it once for the groups and for the join of stock with totes.

        The tote's name follows from its keys, so it is spelled out after the shuffle.
        """
        return self.table("lineitem").select(*columns).repartition(self._plate()).withColumn("cont_id", self._plate())

    def totes(self) -> DataFrame:
        lines = self._placed("l_orderkey", "l_suppkey", "l_linenumber")
        grouped = lines.groupBy("cont_id", "l_orderkey", "l_suppkey").agg(
            (F.min("l_linenumber") % 4).cast("long").alias("cont_type_id"),
            (F.max("l_linenumber") % 3).cast("long").alias("z_pos"),
        )
        return grouped.select(
            F.col("cont_id").alias("id"),
            F.col("cont_id").alias("licenceplate"),
            F.col("l_suppkey").alias("loc_id"),
            "cont_type_id",
            "z_pos",
        )

    def stock(self) -> DataFrame:
        lines = self._placed("l_orderkey", "l_suppkey", "l_partkey", "l_quantity")
        grouped = lines.groupBy("cont_id", "l_orderkey", "l_suppkey", "l_partkey")
        # Some products are known in one zone only: the other zone's records name no item.
        unknown = (F.col("l_partkey") % 16 == 5) & (F.col("l_suppkey") % 2 == 0)
        return grouped.agg(F.sum("l_quantity").cast("long").alias("act_quantity")).select(
            "cont_id", F.when(~unknown, F.col("l_partkey")).alias("item_id"), "act_quantity"
        )

    def items(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("id"), pid("p_partkey").alias("item_number"))

    def locations(self) -> DataFrame:
        key = F.col("s_suppkey")
        prefix = F.when(key % 5 == 4, "XSM").when(key % 2 == 0, "OSM").otherwise("ASM")
        return self.table("supplier").select(
            key.alias("id"), F.concat(prefix, F.lpad(key.cast("string"), 6, "0")).alias("locno")
        )

    def location_states(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("loc_id"), F.col("s_nationkey").alias("state_id"))

    def states(self) -> DataFrame:
        domain = F.when(F.col("n_regionkey") == 4, 1).otherwise(2)
        return self.table("nation").select(F.col("n_nationkey").alias("id"), domain.alias("domain_id"))

    def tote_stock(self) -> DataFrame:
        return tote_stock(
            self.stock(), self.totes(), self.items(), self.locations(), self.location_states(), self.states()
        )

    # Sales, transports and statistics.

    def confirmed(self) -> DataFrame:
        key = F.col("p_partkey")
        sold = self.table("part").filter(key % 7 == 0)
        return sold.select(pid("p_partkey").alias("prod_id"), (key * 37 % 400 + 1).alias("demand"))

    def forecast(self) -> DataFrame:
        key = F.col("p_partkey")
        foreseen = self.table("part").filter(key % 3 != 0)
        return foreseen.select(pid("p_partkey").alias("prod_id"), (key * 53 % 300 - 60).alias("forecast"))

    def average_sales(self) -> DataFrame:
        key = F.col("p_partkey")
        part, product = self.table("part"), pid("p_partkey").alias("prod_id")
        shop = part.filter(key % 2 == 0).select(
            product,
            F.lit("SHOP").alias("order_type"),
            ((key % 100).cast("double") / 128).alias("likelihood"),
            ((key % 9) * F.lit(0.75)).alias("exp_demand"),
        )
        web = part.filter(key % 3 == 0).select(
            product,
            F.lit("WEB").alias("order_type"),
            F.lit(0.5).alias("likelihood"),
            F.lit(99.0).alias("exp_demand"),
        )
        return shop.unionByName(web)

    def transports(self) -> DataFrame:
        """Full totes in OSR were driven, and every eleventh order does the opposite of the others.

        Each second tote that was driven has a transport of the day before as well.
        """
        totes = self.table("lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").alias("held"))
        likely = (F.col("held") >= 25) & (F.col("l_suppkey") % 2 == 0)
        driven = totes.filter(likely != (F.col("l_orderkey") % 11 == 0))
        days = F.when(F.col("l_orderkey") % 2 == 0, F.array(F.lit(AS_OF), F.lit(AS_OF - timedelta(days=1))))
        return driven.select(
            F.explode(days.otherwise(F.array(F.lit(AS_OF)))).alias("insert_date"),
            self._plate().alias("licenceplate"),
            (F.col("l_orderkey") % 3 + 1).alias("transport_orders"),
        )

    def statistics(self, stock: DataFrame) -> DataFrame:
        """Stock statistics of the day before, over the ranked stock."""
        item = F.col("item_number").cast("long")
        goods = self.assortment().select(
            F.col("prod_id").alias("item_number"),
            F.substring("prod_code", 1, 3).alias("dissection"),
            "hanging_garment",
            "sor_indicator",
        )
        kinds = self.dissections().select("dissection", "directorate")
        return (
            stock.join(goods, "item_number")
            .join(kinds, "dissection", "left")
            .select(
                F.lit(AS_OF - timedelta(days=1)).alias("insert_date"),
                "item_number",
                "licenceplate",
                "locno",
                "location",
                "z_pos",
                "quantity",
                "cumunits",
                "itemrank",
                F.when(F.col("cumunits") > 100, 1).otherwise(0).cast("long").alias("classification"),
                "directorate",
                "hanging_garment",
                "sor_indicator",
                F.when(item % 11 == 0, "KAB").otherwise(F.concat(F.lit("G"), (item % 5).cast("string"))).alias("item_group_name"),
            )
        )

    # Messages.

    def events(self) -> DataFrame:
        return message_events(self.table("lineitem"))


def message_events(lineitem: DataFrame) -> DataFrame:
    """[telegram_type, creation_time, raw_message]: a header and one or two line records per order line.

    One message per line, not per order: an order of any size then needs no gathering. Every third line has a
    second record, 5 pence dearer.
    """

    def digits(column: Column, width: int) -> Column:
        return F.lpad(column.cast("string"), width, "0")

    def padded(column: Column, width: int) -> Column:
        return F.rpad(column.cast("string"), width, " ")

    number, order, part = F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_partkey")

    def record(kind: str, dearer: int = 0) -> Column:
        price = F.when(number == 7, "x" * 10).otherwise(digits(part % 2000 * 5 + dearer, 10))
        return F.concat(
            padded(digits(number, 10), 38),
            padded(F.lit(kind), 6),
            F.lit("199806301715000001HO"),
            padded(order, 20),
            digits(number, 5),
            digits(part, 8),
            digits(F.col("l_quantity").cast("long"), 6),
            F.lit("000001N"),
            padded(F.lit("@note"), 50),
            F.lit("REF001REF2"),
            price,
        )

    return lineitem.select(
        F.lit("ORH").alias("telegram_type"),
        days_before(AS_OF, "l_orderkey", 5).alias("creation_time"),
        F.concat(
            record("ORH"), F.lit("|"), record("ORL"), F.lit("|"), F.when(number % 3 == 0, F.concat(record("ORL", 5), F.lit("|"))).otherwise("")
        ).alias("raw_message"),
    )
