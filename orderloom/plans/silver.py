"""Raw tables to the three silver tables.

Inputs are cut to the needed columns and cast before they are joined, so text timestamps are parsed
once per source row and shuffles carry narrow rows.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame

from orderloom.functions.casts import typed
from orderloom.functions.measures import days_from, item_value
from orderloom.operators import joins
from orderloom.schemas import RAW, SILVER, in_table_order

LEFT_JOIN_KEYS = {
    "products": "product_id",
    "category_translation": "product_category_name",
    "sellers": "seller_id",
}
ORDER_REFERENCE = ["order_id", "order_status", "order_purchase_timestamp"]


def order_details(
    order_items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    category_translation: DataFrame,
    sellers: DataFrame,
    columns: Collection[str] | None = None,
    unique_keys: Collection[str] = (),
) -> DataFrame:
    """One row per order item.

    Customers are joined to orders and translations to products before either meets the items, so
    the largest table takes part in three joins instead of five and never in the one on the
    category, whose few values would crowd a handful of partitions. Orders come last: they are the
    widest side, so the other shuffles stay narrow, and the items of an order end up next to each
    other, where the aggregates that follow combine them before their own shuffle.

    With ``columns`` only these are built. A left-joined table that gives none of them still has to
    be joined, because a repeated key would repeat items, unless ``unique_keys`` names it (products,
    category_translation, sellers): the caller vouches that its key is unique.
    """
    wanted = set(columns or SILVER["order_details"])

    def needed(table: str) -> bool:
        gives = set(RAW[table].fieldNames()) - {LEFT_JOIN_KEYS[table]}
        return table not in unique_keys or not wanted.isdisjoint(gives)

    items = typed(order_items, RAW["order_items"])
    named_products = typed(products, RAW["products"])
    if needed("category_translation"):
        named_products = joins.with_translation(
            named_products, typed(category_translation, RAW["category_translation"])
        )
    if needed("products") or needed("category_translation"):
        items = joins.with_products(items, named_products)
    if needed("sellers"):
        items = joins.with_sellers(items, typed(sellers, RAW["sellers"]))
    customer_orders = joins.with_customers(
        typed(orders, RAW["orders"]), typed(customers, RAW["customers"])
    )
    items = joins.with_orders(items, customer_orders)
    items = with_item_measures(items).drop("customer_id")
    return items.select(*columns) if columns else in_table_order(items, "order_details")


def with_item_measures(items: DataFrame) -> DataFrame:
    """Add total value, delivery time, and days ahead of the estimate (positive is early)."""
    purchase, delivered = "order_purchase_timestamp", "order_delivered_customer_date"
    return items.withColumns(
        {
            "total_item_value": item_value(),
            "delivery_days": days_from(purchase, delivered),
            "estimated_vs_actual_days": days_from(delivered, "order_estimated_delivery_date"),
        }
    )


def order_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment of a known order."""
    rows = joins.with_orders(
        typed(payments, RAW["payments"]), typed(orders, RAW["orders"]).select(*ORDER_REFERENCE)
    )
    return in_table_order(rows, "order_payments")


def order_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per review of a known order."""
    rows = joins.with_orders(
        typed(reviews, RAW["reviews"]), typed(orders, RAW["orders"]).select(*ORDER_REFERENCE)
    )
    return in_table_order(rows, "order_reviews")


def build_silver(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "order_details": order_details(
            raw["order_items"],
            raw["orders"],
            raw["customers"],
            raw["products"],
            raw["category_translation"],
            raw["sellers"],
        ),
        "order_payments": order_payments(raw["payments"], raw["orders"]),
        "order_reviews": order_reviews(raw["reviews"], raw["orders"]),
    }
