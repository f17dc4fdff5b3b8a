"""The pipeline's raw relations derived from the star-schema test tables.

``SQL`` holds the same derivation for an engine that has the tables registered as views.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The states that occur in this data, for accepted_values.
ORDER_STATUSES = ("F", "O", "P")


# Stated, so that reading a table starts no job to look at its files.
TABLES = {
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_extendedprice DOUBLE, l_tax DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_orderdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_brand STRING, p_type STRING, p_size INT",
    "region": "r_regionkey INT, r_name STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
}


class Relations(Mapping):
    """The raw relations by name, each put together when it is asked for first.

    Expressions are SQL text: building the same columns one by one took longer than many queries.
    """

    NAMES = (
        "orders", "order_items", "products", "sellers", "customers", "payments", "reviews",
        "category_translation",
    )

    def __init__(self, spark: SparkSession, sf_dir: str, state: str):
        self.spark, self.sf_dir, self.state = spark, sf_dir, state
        self.made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        return self._once(name, getattr(self, f"_{name}"))

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.made:
            self.made[name] = make()
        return self.made[name]

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self):
        return len(self.NAMES)

    def _table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        return self._once(path, lambda: self.spark.read.schema(TABLES[name]).parquet(path))

    def _places(self) -> DataFrame:
        nation, region = self._table("nation"), self._table("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))

    def _orders(self) -> DataFrame:
        shipped = self._table("lineitem").groupBy("l_orderkey").agg(
            F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
        )
        orders = self._table("orders")
        return orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "o_orderstatus AS order_status",
            "o_orderdate AS order_purchase_timestamp",
            "o_orderdate + INTERVAL '1' DAY AS order_approved_at",
            "first_ship AS order_delivered_carrier_date",
            "CASE WHEN o_orderstatus = 'F' THEN last_ship END AS order_delivered_customer_date",
            "o_orderdate + INTERVAL '30' DAY AS order_estimated_delivery_date",
        )

    def _order_items(self) -> DataFrame:
        return self._table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS order_item_id",
            "l_partkey AS product_id",
            "l_suppkey AS seller_id",
            "l_shipdate AS shipping_limit_date",
            "l_extendedprice AS price",
            "l_extendedprice * l_tax AS freight_value",
        )

    def _products(self) -> DataFrame:
        return self._table("part").selectExpr(
            "p_partkey AS product_id",
            "CASE WHEN p_brand <> 'Brand#1' THEN p_type END AS product_category_name",
            "p_size AS product_weight_g",
            "p_size + 1 AS product_length_cm",
            "p_size + 2 AS product_height_cm",
            "p_size + 3 AS product_width_cm",
        )

    def _category_translation(self) -> DataFrame:
        names = self._table("part").where("p_type <> 'PROMO'").selectExpr("p_type AS product_category_name")
        return names.distinct().selectExpr("*", "lower(product_category_name) AS product_category_name_english")

    def _customers(self) -> DataFrame:
        customers = self._table("customer").join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))
        return customers.selectExpr(
            "c_custkey AS customer_id",
            "CAST(floor(c_custkey / 3.0D) AS BIGINT) AS customer_unique_id",
            "n_name AS customer_city",
            f"{self.state} AS customer_state",
        )

    def _sellers(self) -> DataFrame:
        sellers = self._table("supplier").join(self._places(), F.col("s_nationkey") == F.col("n_nationkey"))
        return sellers.selectExpr("s_suppkey AS seller_id", "n_name AS seller_city", f"{self.state} AS seller_state")

    def _payments(self) -> DataFrame:
        events = self._table("events").where("event_type IN ('purchase', 'signup', 'error')")
        return events.selectExpr(
            "CAST(floor(event_id / 4.0D) AS BIGINT) AS order_id",
            "CAST(event_id % 4 + 1 AS INT) AS payment_sequential",
            "event_type AS payment_type",
            "CAST(user_id % 12 + 1 AS INT) AS payment_installments",
            "value AS payment_value",
        )

    def _reviews(self) -> DataFrame:
        return self._table("events").where("event_type IN ('click', 'view')").selectExpr(
            "CAST(floor(event_id / 4.0D) AS BIGINT) AS order_id",
            "event_id AS review_id",
            "CAST(event_id % 5 + 1 AS INT) AS review_score",
            "event_type AS review_comment_title",
            "props AS review_comment_message",
            "ts AS review_creation_date",
            "ts + INTERVAL '1' DAY AS review_answer_timestamp",
        )


def relations(spark: SparkSession, sf_dir: str, state: str = "r_name") -> Relations:
    """``state`` says how a region becomes a customer's or seller's state."""
    return Relations(spark, sf_dir, state)


# Common table expressions, named like the relations with the prefix raw_.
SQL: dict[str, str] = {
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL 1 DAY AS order_approved_at,
               first_ship AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' THEN last_ship END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
        FROM orders LEFT JOIN (
            SELECT l_orderkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
            FROM lineitem GROUP BY l_orderkey
        ) ON o_orderkey = l_orderkey""",
    "raw_order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
        FROM lineitem""",
    "raw_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_brand <> 'Brand#1' THEN p_type END AS product_category_name,
               p_size AS product_weight_g, p_size + 1 AS product_length_cm,
               p_size + 2 AS product_height_cm, p_size + 3 AS product_width_cm
        FROM part""",
    "raw_category_translation": """
        SELECT DISTINCT p_type AS product_category_name,
               lower(p_type) AS product_category_name_english
        FROM part WHERE p_type <> 'PROMO'""",
    "raw_customers": """
        SELECT c_custkey AS customer_id,
               CAST(floor(c_custkey / 3.0) AS BIGINT) AS customer_unique_id,
               n_name AS customer_city, r_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "raw_sellers": """
        SELECT s_suppkey AS seller_id, n_name AS seller_city, r_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "raw_payments": """
        SELECT CAST(floor(event_id / 4.0) AS BIGINT) AS order_id,
               CAST(event_id % 4 + 1 AS INTEGER) AS payment_sequential,
               event_type AS payment_type,
               CAST(user_id % 12 + 1 AS INTEGER) AS payment_installments,
               value AS payment_value
        FROM events WHERE event_type IN ('purchase', 'signup', 'error')""",
    "raw_reviews": """
        SELECT CAST(floor(event_id / 4.0) AS BIGINT) AS order_id, event_id AS review_id,
               CAST(event_id % 5 + 1 AS INTEGER) AS review_score,
               event_type AS review_comment_title, props AS review_comment_message,
               ts AS review_creation_date, ts + INTERVAL 1 DAY AS review_answer_timestamp
        FROM events WHERE event_type IN ('click', 'view')""",
}
