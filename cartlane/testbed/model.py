"""The supplied tables in the shape of the retail tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlane.functions.times import as_of_column, plus_days
from cartlane.operators.promotions import with_campaign_window, with_discount_terms
from cartlane.schemas import TABLES
from cartlane.sources.tables import literal_rows, read_table, seed_table
from cartlane.streaming.envelope import encode

AS_OF = "2024-01-31 00:00:00"
SEED = "till"

# Which role each market segment stands for; which status name each order status letter.
SEGMENT_ROLES = {"MACHINERY": 2, "FURNITURE": 3}
CUSTOMER_ROLE = 4
STATUS_NAMES = {"P": "Pending", "O": "Processing", "F": "Delivered"}
EVENT_STATUS = {"signup": 1, "view": 2, "click": 3, "purchase": 4, "error": 5}
EVENT_OPS = {"signup": "c", "error": "d"}


class Model:
    """The retail tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.folder, name)
        return self._read[name]

    def seeds(self, name: str) -> DataFrame:
        return seed_table(self.spark, name)

    def users(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("username"),
            F.col("c_name").alias("street"),
            F.col("c_mktsegment").alias("unit"),
        )

    def role_user(self) -> DataFrame:
        role = F.lit(CUSTOMER_ROLE)
        for segment, role_id in SEGMENT_ROLES.items():
            role = F.when(F.col("c_mktsegment") == segment, F.lit(role_id)).otherwise(role)
        return self.raw("customer").select(role.cast("bigint").alias("role_id"), F.col("c_custkey").alias("user_id"))

    def addresses(self) -> DataFrame:
        """An address per urgent order, so some users have several and some none."""
        urgent = self.raw("orders").filter(F.col("o_orderpriority") == "1-URGENT")
        return urgent.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"))

    def cities(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("city_name"),
            F.col("n_regionkey").cast("bigint").alias("province_id"),
        )

    def products(self) -> DataFrame:
        size = F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast("decimal(15,2)").alias("product_price"),
            (size.cast("decimal(4,0)") * F.lit("0.4").cast("decimal(2,1)")).cast("decimal(4,2)").alias("product_tax"),
            F.greatest(size - 5, F.lit(0)).alias("product_quantity"),
        )

    def lines(self) -> DataFrame:
        """Order lines: quantity and tax rate of the line, price of the part."""
        lines = self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_tax").cast("decimal(4,2)") * 100).cast("decimal(4,2)").alias("product_tax"),
        )
        prices = self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_retailprice").cast("decimal(15,2)").alias("product_price")
        )
        return lines.join(prices, "product_id")

    def orders(self) -> DataFrame:
        letters = literal_rows(self.spark, ["o_orderstatus", "order_status_name"], list(STATUS_NAMES.items()))
        statuses = self.seeds("orderstatus").withColumnRenamed("id", "order_status_id")
        return (
            self.raw("orders")
            .join(letters, "o_orderstatus")
            .join(statuses, "order_status_name")
            .select(
                F.col("o_orderkey").alias("id"),
                F.col("o_custkey").alias("user_id"),
                F.col("o_totalprice").cast("decimal(15,2)").alias("total_amount"),
                "order_status_id",
                F.col("o_orderdate").alias("updated_at"),
            )
        )

    def campaigns(self) -> DataFrame:
        ids = self.raw("nation").select(F.col("n_nationkey").cast("bigint").alias("id"))
        return with_campaign_window(ids, ["id"], AS_OF, f"{SEED}-campaign")

    def discounts(self) -> DataFrame:
        ids = self.raw("supplier").select(F.col("s_suppkey").alias("id"))
        return with_discount_terms(ids, ["id"], self.campaigns(), AS_OF, f"{SEED}-terms")

    def given_discounts(self) -> DataFrame:
        """Suppliers as discounts: every other nation's are percentages."""
        key, percent = F.col("s_suppkey"), F.col("s_nationkey") % 2 == 0
        value = F.when(percent, F.col("s_nationkey") + 1).otherwise(F.abs("s_acctbal"))
        return self.raw("supplier").select(
            key.alias("id"),
            F.when(percent, "percent").otherwise("amount").alias("type"),
            value.cast("decimal(15,2)").alias("value"),
            plus_days(as_of_column(AS_OF), -(key % 30)).alias("started_at"),
            plus_days(as_of_column(AS_OF), key % 20 - 5).alias("expired_at"),
        )

    def picks(self) -> DataFrame:
        """Orders as requests that say what they want; every third one names a discount."""
        key, user = F.col("o_orderkey"), F.col("o_custkey")
        return self.raw("orders").select(
            key.alias("id"),
            user.alias("user_id"),
            (user % 7 + 1).alias("staff_id"),
            key.alias("address_id"),
            F.when(key % 3 == 0, user % 10).alias("discount_id"),
            (key % 5 + 1).alias("payment_method_id"),
            (user % 5 + 1).alias("shipping_method_id"),
        )

    def basket(self) -> DataFrame:
        """Lines as picked products; returned ones leave the quantity to the rule."""
        quantity = F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("int"))
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
        )

    def categories(self) -> DataFrame:
        """Parts as a tree in which part k hangs under part k/10."""
        key = F.col("p_partkey")
        return self.raw("part").select(
            key.alias("id"),
            F.col("p_name").alias("category_name"),
            F.when(key > 0, F.floor(key / 10)).alias("category_id"),
        )

    def flash_discounts(self) -> DataFrame:
        """Suppliers as discounts of some hours in one month, a few of them of ten days."""
        key = F.col("s_suppkey")
        began = F.timestamp_add("HOUR", key * 7919 % 720, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        hours = F.when(key % 50 == 0, F.lit(240)).otherwise(key % 6 + 1)
        return self.raw("supplier").select(
            key.alias("id"), began.alias("started_at"), F.timestamp_add("HOUR", hours, began).alias("expired_at")
        )

    def line_feed(self) -> DataFrame:
        """Events as change records of order lines: three records for a line, which moves between orders."""
        op = F.when(F.col("event_type") == "error", "d").otherwise("u")
        rows = self.raw("events").select(
            F.floor(F.col("event_id") / 3).alias("id"),
            F.col("user_id").alias("order_id"),
            (F.col("event_id") % 7 + 1).cast("int").alias("quantity"),
            F.col("value").cast("decimal(15,2)").alias("product_price"),
            (F.col("event_id") % 9).cast("decimal(15,2)").alias("product_tax"),
            "event_id",
            op.alias("op"),
            "ts",
        )
        return encode(rows, TABLES["orderdetails"], F.col("op"), F.col("event_id"), F.col("ts"))

    def reference_feed(self) -> DataFrame:
        """Customers as users and their orders, of which some change hands or go; every fifth user goes too."""
        at = as_of_column(AS_OF)
        users, orders = TABLES["users"], TABLES["orders"]
        people = self.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username"))
        made = self.raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"))
        moved = made.filter("id % 4 = 0").withColumn("user_id", F.col("user_id") + 1)
        steps = [
            (people, users, "c", 0),
            (made, orders, "c", 1),
            (moved, orders, "u", 2),
            (made.filter("id % 7 = 0").select("id"), orders, "d", 3),
            (people.filter("id % 5 = 0").select("id"), users, "d", 4),
        ]
        parts = [encode(rows, table, F.lit(op), F.col("id") + n * 1_000_000_000, at) for rows, table, op, n in steps]
        return reduce(DataFrame.unionByName, parts)

    def event_tags(self) -> DataFrame:
        """Events as (product, tag) pairs."""
        return self.raw("events").select(
            "event_id",
            "event_type",
            F.col("user_id").alias("product_id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("tag_id"),
        )

    def places(self) -> DataFrame:
        """Customers as rows of a file of cities."""
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state_name"))
        return self.raw("customer").join(nation, "c_nationkey").select(
            F.col("c_mktsegment").alias("city"),
            "state_name",
            (F.col("c_acctbal") / 1000).alias("lat"),
            F.col("c_custkey").cast("double").alias("lng"),
        )

    def feed(self) -> DataFrame:
        """Events as change records of orders, one order per user; an error deletes it."""
        op = F.lit("u")
        for event, letter in EVENT_OPS.items():
            op = F.when(F.col("event_type") == event, F.lit(letter)).otherwise(op)
        status = F.lit(None).cast("bigint")
        for event, number in EVENT_STATUS.items():
            status = F.when(F.col("event_type") == event, F.lit(number)).otherwise(status)
        rows = self.raw("events").select(
            F.col("user_id").alias("id"),
            status.alias("order_status_id"),
            F.col("value").cast("decimal(15,2)").alias("total_amount"),
            F.col("ts").alias("updated_at"),
            "event_id",
            op.alias("op"),
            "ts",
        )
        return encode(rows, TABLES["orders"], F.col("op"), F.col("event_id"), F.col("ts"))
