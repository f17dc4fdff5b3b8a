"""Staging projections over the silver tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# The columns of the staging views, in their order.
STAGING_COLUMNS: dict[str, list[str]] = {
    "stg_order_details": [
        "order_id", "order_item_id", "customer_unique_id", "product_id", "seller_id",
        "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date", "shipping_limit_date",
        "price", "freight_value", "total_item_value",
        "delivery_days", "estimated_vs_actual_days",
        "product_category_name", "product_category_name_english",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        "customer_city", "customer_state", "seller_city", "seller_state",
    ],
    "stg_order_payments": [
        "order_id", "order_status", "order_purchase_timestamp",
        "payment_sequential", "payment_type", "payment_installments", "payment_value",
    ],
    "stg_order_reviews": [
        "order_id", "review_id", "order_status", "order_purchase_timestamp",
        "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ],
}

STAGING_SOURCE = {name: name.removeprefix("stg_") for name in STAGING_COLUMNS}


def stage(silver: DataFrame, model: str) -> DataFrame:
    return silver.select(*STAGING_COLUMNS[model])


def build_staging(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {model: stage(silver[source], model) for model, source in STAGING_SOURCE.items()}


def view_sql(model: str, view: str, source_table: str) -> str:
    columns = ", ".join(STAGING_COLUMNS[model])
    return f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {source_table}"
