"""Column names and types of every layer.

``RAW`` lists the columns the silver layer takes from each raw table, with the type silver gives
them. String columns are passed through as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
}


def schema_of(**columns: str) -> StructType:
    return StructType([StructField(name, TYPES[kind]) for name, kind in columns.items()])


RAW: dict[str, StructType] = {
    "orders": schema_of(
        order_id="string",
        customer_id="string",
        order_status="string",
        order_purchase_timestamp="timestamp",
        order_approved_at="timestamp",
        order_delivered_carrier_date="timestamp",
        order_delivered_customer_date="timestamp",
        order_estimated_delivery_date="timestamp",
    ),
    "order_items": schema_of(
        order_id="string",
        order_item_id="int",
        product_id="string",
        seller_id="string",
        shipping_limit_date="timestamp",
        price="double",
        freight_value="double",
    ),
    "products": schema_of(
        product_id="string",
        product_category_name="string",
        product_weight_g="int",
        product_length_cm="int",
        product_height_cm="int",
        product_width_cm="int",
    ),
    "sellers": schema_of(
        seller_id="string",
        seller_city="string",
        seller_state="string",
    ),
    "customers": schema_of(
        customer_id="string",
        customer_unique_id="string",
        customer_city="string",
        customer_state="string",
    ),
    "payments": schema_of(
        order_id="string",
        payment_sequential="int",
        payment_type="string",
        payment_installments="int",
        payment_value="double",
    ),
    "reviews": schema_of(
        order_id="string",
        review_id="string",
        review_score="int",
        review_comment_title="string",
        review_comment_message="string",
        review_creation_date="timestamp",
        review_answer_timestamp="timestamp",
    ),
    "category_translation": schema_of(
        product_category_name="string",
        product_category_name_english="string",
    ),
}

# Column order, types and widths of the silver tables.
SILVER: dict[str, dict[str, str]] = {
    "order_details": {
        "order_id": "VARCHAR(50)",
        "order_item_id": "INT",
        "price": "DOUBLE",
        "freight_value": "DOUBLE",
        "shipping_limit_date": "TIMESTAMP",
        "order_status": "VARCHAR(30)",
        "order_purchase_timestamp": "TIMESTAMP",
        "order_approved_at": "TIMESTAMP",
        "order_delivered_carrier_date": "TIMESTAMP",
        "order_delivered_customer_date": "TIMESTAMP",
        "order_estimated_delivery_date": "TIMESTAMP",
        "customer_unique_id": "VARCHAR(50)",
        "customer_city": "VARCHAR(100)",
        "customer_state": "VARCHAR(5)",
        "product_id": "VARCHAR(50)",
        "product_category_name": "VARCHAR(100)",
        "product_weight_g": "INT",
        "product_length_cm": "INT",
        "product_height_cm": "INT",
        "product_width_cm": "INT",
        "product_category_name_english": "VARCHAR(100)",
        "seller_id": "VARCHAR(50)",
        "seller_city": "VARCHAR(100)",
        "seller_state": "VARCHAR(5)",
        "total_item_value": "DOUBLE",
        "delivery_days": "INT",
        "estimated_vs_actual_days": "INT",
    },
    "order_payments": {
        "order_id": "VARCHAR(50)",
        "order_status": "VARCHAR(30)",
        "order_purchase_timestamp": "TIMESTAMP",
        "payment_sequential": "INT",
        "payment_type": "VARCHAR(30)",
        "payment_installments": "INT",
        "payment_value": "DOUBLE",
    },
    "order_reviews": {
        "order_id": "VARCHAR(50)",
        "order_status": "VARCHAR(30)",
        "order_purchase_timestamp": "TIMESTAMP",
        "review_id": "VARCHAR(50)",
        "review_score": "INT",
        "review_comment_title": "VARCHAR(500)",
        "review_comment_message": "VARCHAR(5000)",
        "review_creation_date": "TIMESTAMP",
        "review_answer_timestamp": "TIMESTAMP",
    },
}


def silver_ddl(table: str) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in SILVER[table].items())


def in_table_order(df: DataFrame, table: str) -> DataFrame:
    """Columns of a silver table in their fixed order; a missing or additional name is an error."""
    expected = list(SILVER[table])
    if set(df.columns) != set(expected) or len(df.columns) != len(expected):
        raise ValueError(
            f"{table}: expected columns {sorted(expected)}, found {sorted(df.columns)}"
        )
    return df.select(*expected)
