"""The equi-joins of the silver layer.

No join carries a broadcast hint: a side is broadcast when its measured size is below the session's
threshold. Beyond it both sides are shuffled, and AQE splits partitions that a hot key fills.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_orders(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Items, payments or reviews with their order; rows without an order are dropped."""
    return rows.join(orders, "order_id", "inner")


def with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_id", "inner")


def with_products(items: DataFrame, products: DataFrame) -> DataFrame:
    return items.join(products, "product_id", "left")


def with_translation(products: DataFrame, translation: DataFrame) -> DataFrame:
    return products.join(translation, "product_category_name", "left")


def with_sellers(items: DataFrame, sellers: DataFrame) -> DataFrame:
    return items.join(sellers, "seller_id", "left")
