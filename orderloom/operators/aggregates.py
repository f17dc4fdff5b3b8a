"""Grouped aggregates of the marts.

All of them combine on the map side first, so one hot key reaches the shuffle as at most one row
per map task (or one per order where orders are counted distinct).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.measures import money_sum, partial_money_sum, split_amounts
from orderloom.session import started_partitions

# The attributes that an order or product is grouped by.
ORDER_ATTRIBUTES = [
    "order_id",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "customer_unique_id",
    "delivery_days",
    "estimated_vs_actual_days",
]

PRODUCT_ATTRIBUTES = [
    "product_id",
    "product_category_name",
    "product_category_name_english",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]

# Parts that the orders of one product are dealt to.
PRODUCT_PARTS = 8


def items_per_order(details: DataFrame, money_scale: int | None = None) -> DataFrame:
    """Item count and values per order.

    An order whose attributes differ between its items gives one row per variant.
    """
    details = split_amounts(details, ["price", "freight_value", "total_item_value"], money_scale)
    return details.groupBy(*ORDER_ATTRIBUTES).agg(
        F.count("*").alias("item_count"),
        money_sum("price", money_scale).alias("total_price"),
        money_sum("freight_value", money_scale).alias("total_freight"),
        money_sum("total_item_value", money_scale).alias("order_value"),
    )


def payments_per_order(payments: DataFrame, money_scale: int | None = None) -> DataFrame:
    payments = split_amounts(payments, ["payment_value"], money_scale)
    return payments.groupBy("order_id").agg(
        F.count("*").alias("payment_count"),
        money_sum("payment_value", money_scale).alias("total_payment_value"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("avg_review_score"))


def customer_metrics(details: DataFrame, money_scale: int | None = None) -> DataFrame:
    details = split_amounts(details, ["total_item_value"], money_scale)
    return details.groupBy("customer_unique_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        money_sum("total_item_value", money_scale).alias("lifetime_value"),
        F.min("order_purchase_timestamp").alias("first_order_at"),
        F.max("order_purchase_timestamp").alias("last_order_at"),
    )


def product_sales(details: DataFrame, money_scale: int | None = None) -> DataFrame:
    """Orders, revenue and average price per product with its attributes.

    Rows travel once, as they are: a product has few items of one order, so combining them before the
    shuffle would save nothing and hold all rows in a hash table. A product's orders go to so many
    parts that one product is not one task's work; each part counts its own orders.
    """
    # A number of partitions of its own keeps AQE from merging them, so hash tables stay small.
    partitions = started_partitions(details.sparkSession)
    items = details.where(F.col("product_id").isNotNull()).select(*PRODUCT_ATTRIBUTES, "order_id", "price")
    part = F.pmod(F.xxhash64("order_id"), F.lit(PRODUCT_PARTS)).alias("_part")
    dealt = items.select("*", part).repartition(partitions, "product_id", "_part")
    parts = (
        split_amounts(dealt, ["price"], money_scale)
        .groupBy(*PRODUCT_ATTRIBUTES, "_part")
        .agg(
            F.countDistinct("order_id").alias("_orders"),
            F.count("price").alias("_prices"),
            *partial_money_sum("price", money_scale),
        )
    )
    revenue = money_sum("price", money_scale)
    return parts.groupBy(*PRODUCT_ATTRIBUTES).agg(
        F.sum("_orders").alias("times_ordered"),
        revenue.alias("total_revenue"),
        F.try_divide(revenue, F.sum("_prices")).alias("avg_price"),
    )
