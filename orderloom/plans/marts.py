"""The order fact and the customer and product dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.measures import money_sum, partial_money_sum, split_amounts
from orderloom.operators.aggregates import (
    ORDER_ATTRIBUTES,
    PRODUCT_ATTRIBUTES,
    customer_metrics,
    items_per_order,
    payments_per_order,
    product_sales,
    reviews_per_order,
)
from orderloom.operators.latest import latest_address, latest_address_aggregate

FCT_ORDERS_COLUMNS = [
    *ORDER_ATTRIBUTES,
    "item_count",
    "total_price",
    "total_freight",
    "order_value",
    "payment_count",
    "total_payment_value",
    "avg_review_score",
]

DIM_PRODUCTS_COLUMNS = [*PRODUCT_ATTRIBUTES, "times_ordered", "total_revenue", "avg_price"]


def fct_orders(
    details: DataFrame, payments: DataFrame, reviews: DataFrame, money_scale: int | None = None
) -> DataFrame:
    """One row per order with items.

    Payments and reviews are reduced to one row per order before they are joined, so they do not
    multiply each other. Orders without any keep NULL, not 0.
    """
    return (
        items_per_order(details, money_scale)
        .join(payments_per_order(payments, money_scale), "order_id", "left")
        .join(reviews_per_order(reviews), "order_id", "left")
        .select(*FCT_ORDERS_COLUMNS)
    )


def _is_repeat() -> Column:
    return F.when(F.col("total_orders") > 1, True).otherwise(False).alias("is_repeat_customer")


def _dim_customers_columns(city: str, state: str) -> list:
    return [
        "customer_unique_id",
        F.col(city).alias("customer_city"),
        F.col(state).alias("customer_state"),
        "total_orders",
        "lifetime_value",
        "first_order_at",
        "last_order_at",
        _is_repeat(),
    ]


def dim_customers(details: DataFrame, money_scale: int | None = None) -> DataFrame:
    """Customer metrics joined with the latest address, chosen by ``row_number``."""
    return (
        customer_metrics(details, money_scale)
        .join(latest_address(details), "customer_unique_id", "inner")
        .select(*_dim_customers_columns("customer_city", "customer_state"))
    )


def dim_customers_one_pass(details: DataFrame, money_scale: int | None = None) -> DataFrame:
    """The same result from one read of the order items, without the join.

    Items are reduced to orders first, in hash aggregates over numbers alone. Only orders meet the
    choice of the latest address, whose text no hash aggregate can hold.
    """
    known = details.where(F.col("customer_unique_id").isNotNull())
    orders = (
        split_amounts(known, ["total_item_value"], money_scale)
        .groupBy("customer_unique_id", "order_id", "order_purchase_timestamp", "customer_city", "customer_state")
        .agg(F.max("order_item_id").alias("order_item_id"), *partial_money_sum("total_item_value", money_scale))
    )
    return (
        orders.groupBy("customer_unique_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            money_sum("total_item_value", money_scale).alias("lifetime_value"),
            F.min("order_purchase_timestamp").alias("first_order_at"),
            F.max("order_purchase_timestamp").alias("last_order_at"),
            latest_address_aggregate().alias("address"),
        )
        .select(*_dim_customers_columns("address.customer_city", "address.customer_state"))
    )


def dim_products(details: DataFrame, money_scale: int | None = None) -> DataFrame:
    return product_sales(details, money_scale).select(*DIM_PRODUCTS_COLUMNS)


def build_marts(
    staging: Mapping[str, DataFrame], money_scale: int | None = None
) -> dict[str, DataFrame]:
    details = staging["stg_order_details"]
    return {
        "fct_orders": fct_orders(
            details, staging["stg_order_payments"], staging["stg_order_reviews"], money_scale
        ),
        "dim_customers": dim_customers_one_pass(details, money_scale),
        "dim_products": dim_products(details, money_scale),
    }
