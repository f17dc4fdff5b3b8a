"""The column tests that follow every build."""

from __future__ import annotations

from orderloom.operators.expectations import Expectation

# The order states the fact table accepts.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)


def pipeline_suite(order_statuses: tuple[str, ...] = ORDER_STATUSES) -> list[Expectation]:
    # The tested tables and columns.
    not_null = [
        ("order_details", "order_id"),
        ("order_details", "order_item_id"),
        ("order_payments", "order_id"),
        ("order_payments", "payment_sequential"),
        ("order_reviews", "order_id"),
        ("order_reviews", "review_id"),
        ("stg_order_details", "order_id"),
        ("stg_order_details", "order_item_id"),
        ("stg_order_payments", "order_id"),
        ("stg_order_reviews", "order_id"),
        ("stg_order_reviews", "review_id"),
        ("fct_orders", "order_id"),
        ("fct_orders", "order_status"),
        ("dim_customers", "customer_unique_id"),
        ("dim_customers", "total_orders"),
        ("dim_products", "product_id"),
        ("dim_products", "times_ordered"),
    ]
    unique = [
        ("stg_order_reviews", "review_id"),
        ("fct_orders", "order_id"),
        ("dim_customers", "customer_unique_id"),
        ("dim_products", "product_id"),
    ]
    return [
        *[Expectation(table, column, "not_null") for table, column in not_null],
        Expectation("fct_orders", "total_payment_value", "not_null", severity="warn"),
        *[Expectation(table, column, "unique") for table, column in unique],
        Expectation("fct_orders", "order_status", "accepted_values", values=order_statuses),
    ]
