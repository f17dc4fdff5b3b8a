"""Latest address per customer.

The newest order wins, an order without purchase time counts as newest, and ties go to the highest
order id, then the highest item id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_address(details: DataFrame) -> DataFrame:
    """One row per customer by ``row_number``.

    Spark keeps the first row per customer in every task before the shuffle (WindowGroupLimit), so
    a hot customer does not end up in one task.
    """
    newest_first = Window.partitionBy("customer_unique_id").orderBy(
        F.col("order_purchase_timestamp").desc_nulls_first(),
        F.col("order_id").desc(),
        F.col("order_item_id").desc(),
    )
    return (
        details.withColumn("row_num", F.row_number().over(newest_first))
        .where(F.col("row_num") == 1)
        .select("customer_unique_id", "customer_city", "customer_state")
    )


def latest_address_aggregate() -> Column:
    """The same choice as an aggregate: a struct of city and state, both from the chosen row."""
    newest = F.struct(
        F.col("order_purchase_timestamp").isNull(),
        "order_purchase_timestamp",
        "order_id",
        "order_item_id",
    )
    return F.max_by(F.struct("customer_city", "customer_state"), newest)
