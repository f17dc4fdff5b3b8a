"""One query per operator and plan, each over the whole test tables.

Money is added as decimals (``MONEY_SCALE``), so sums do not depend on the order of rows.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.casts import typed
from orderloom.functions.measures import days_from, item_value, money_sum, split_amounts
from orderloom.operators import aggregates, joins
from orderloom.operators.expectations import Expectation, run_suite
from orderloom.operators.latest import latest_address
from orderloom.parity.starschema import ORDER_STATUSES, Relations, relations
from orderloom.plans import marts, pipeline
from orderloom.plans.silver import build_silver, order_details, order_payments, order_reviews
from orderloom.plans.staging import build_staging, stage
from orderloom.plans.suite import pipeline_suite
from orderloom.schemas import RAW, schema_of
from orderloom.session import configure, scratch_dir, started_partitions
from orderloom.sources.files import delete_folder
from orderloom.sources.raw import ingest, missing_tables, read_snapshot, write_snapshot
from orderloom.sources.tables import (
    create_schema,
    create_silver_tables,
    load,
    save_bucketed,
    save_table,
    truncate,
    write_parquet,
)

MONEY_SCALE = 4
# From so many items on the silver tables are bucketed by order.
BUCKETED_ITEMS = 1_000_000
DAY_1 = datetime(2024, 5, 1, 6, tzinfo=timezone.utc)
DAY_2 = datetime(2024, 5, 2, 6, tzinfo=timezone.utc)

# The order item columns that the marts read.
ORDER_ITEM_COLUMNS = [
    *aggregates.ORDER_ATTRIBUTES, "price", "freight_value", "total_item_value",
]
CUSTOMER_COLUMNS = [
    "customer_unique_id", "customer_city", "customer_state", "order_id", "order_item_id",
    "order_purchase_timestamp", "total_item_value",
]
PRODUCT_COLUMNS = [*aggregates.PRODUCT_ATTRIBUTES, "order_id", "price"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _raw(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """These raw tables with the silver types."""
    source = relations(spark, sf_dir)
    return {name: typed(source[name], RAW[name]) for name in names}


def _buckets(source: Relations) -> int | None:
    """As many buckets as a shuffle has partitions: then the last join leaves each in one task."""
    large = source["order_items"].count() >= BUCKETED_ITEMS
    return started_partitions(source.spark) if large else None


def _order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = relations(spark, sf_dir)
    return order_payments(raw["payments"], raw["orders"])


def _order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = relations(spark, sf_dir)
    return order_reviews(raw["reviews"], raw["orders"])


def _details(raw: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Order items, in full or with what a mart reads.

    The test tables' keys are unique by construction.
    """
    return order_details(
        raw["order_items"],
        raw["orders"],
        raw["customers"],
        raw["products"],
        raw["category_translation"],
        raw["sellers"],
        columns=columns,
        unique_keys=("products", "category_translation", "sellers"),
    )


# Joins


@query
def join_items_orders_inner(spark, sf_dir):
    raw = _raw(spark, sf_dir, "order_items", "orders")
    return joins.with_orders(raw["order_items"], raw["orders"]).select(
        "order_id", "order_item_id", "price", "customer_id", "order_status",
        "order_purchase_timestamp",
    )


@query
def join_orders_customers_inner(spark, sf_dir):
    raw = _raw(spark, sf_dir, "orders", "customers")
    return joins.with_customers(raw["orders"], raw["customers"]).select(
        "order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state"
    )


@query
def join_products_left(spark, sf_dir):
    raw = _raw(spark, sf_dir, "order_items", "products")
    return joins.with_products(raw["order_items"], raw["products"]).select(
        "order_id", "order_item_id", "product_id", "product_category_name", "product_weight_g"
    )


@query
def join_translation_left(spark, sf_dir):
    raw = _raw(spark, sf_dir, "products", "category_translation")
    return joins.with_translation(raw["products"], raw["category_translation"]).select(
        "product_id", "product_category_name", "product_category_name_english"
    )


@query
def join_sellers_left(spark, sf_dir):
    raw = _raw(spark, sf_dir, "order_items", "sellers")
    return joins.with_sellers(raw["order_items"], raw["sellers"]).select(
        "order_id", "order_item_id", "seller_id", "seller_city", "seller_state"
    )


# Casts and computed columns


@query
def cast_columns(spark, sf_dir):
    """Text, some of it no number or time, and doubles cast to the silver types."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_linenumber").cast("string").alias("int_from_text"),
        F.col("l_quantity").cast("string").alias("int_from_decimal_text"),
        F.col("l_returnflag").alias("int_from_bad_text"),
        F.col("l_extendedprice").alias("int_from_double"),
        F.col("l_extendedprice").cast("string").alias("double_from_text"),
        F.col("l_linestatus").alias("double_from_bad_text"),
        F.col("l_shipdate").cast("string").alias("ts_from_text"),
        F.col("l_returnflag").alias("ts_from_bad_text"),
        F.col("l_shipdate").alias("ts_from_ts"),
    )
    target = schema_of(
        int_from_text="int",
        int_from_decimal_text="int",
        int_from_bad_text="int",
        int_from_double="int",
        double_from_text="double",
        double_from_bad_text="double",
        ts_from_text="timestamp",
        ts_from_bad_text="timestamp",
        ts_from_ts="timestamp",
    )
    return typed(lines, target)


@query
def computed_item_value(spark, sf_dir):
    items = _raw(spark, sf_dir, "order_items")["order_items"]
    return items.select(
        "order_id", "order_item_id", "price", "freight_value",
        item_value().alias("total_item_value"),
    )


@query
def delivery_day_metrics(spark, sf_dir):
    purchase, delivered = "order_purchase_timestamp", "order_delivered_customer_date"
    return _raw(spark, sf_dir, "orders")["orders"].select(
        "order_id",
        days_from(purchase, delivered).alias("delivery_days"),
        days_from(delivered, "order_estimated_delivery_date").alias("estimated_vs_actual_days"),
    )


# Silver and staging


@query
def silver_order_details(spark, sf_dir):
    return _details(relations(spark, sf_dir))


@query
def silver_order_payments(spark, sf_dir):
    return _order_payments(spark, sf_dir)


@query
def silver_order_reviews(spark, sf_dir):
    return _order_reviews(spark, sf_dir)


@query
def stg_order_details(spark, sf_dir):
    return stage(_details(relations(spark, sf_dir)), "stg_order_details")


@query
def stg_order_payments(spark, sf_dir):
    return stage(_order_payments(spark, sf_dir), "stg_order_payments")


@query
def stg_order_reviews(spark, sf_dir):
    return stage(_order_reviews(spark, sf_dir), "stg_order_reviews")


# Aggregates, window, marts


@query
def agg_items_per_order(spark, sf_dir):
    return aggregates.items_per_order(_details(relations(spark, sf_dir), ORDER_ITEM_COLUMNS), MONEY_SCALE)


@query
def agg_payments_per_order(spark, sf_dir):
    return aggregates.payments_per_order(_order_payments(spark, sf_dir), MONEY_SCALE)


@query
def agg_reviews_per_order(spark, sf_dir):
    return aggregates.reviews_per_order(_order_reviews(spark, sf_dir))


@query
def agg_customer_metrics(spark, sf_dir):
    return aggregates.customer_metrics(_details(relations(spark, sf_dir), CUSTOMER_COLUMNS), MONEY_SCALE)


@query
def latest_address_row_number(spark, sf_dir):
    return latest_address(_details(relations(spark, sf_dir), CUSTOMER_COLUMNS))


@query
def fct_orders(spark, sf_dir):
    raw = relations(spark, sf_dir)
    return marts.fct_orders(
        _details(raw, ORDER_ITEM_COLUMNS),
        order_payments(raw["payments"], raw["orders"]),
        order_reviews(raw["reviews"], raw["orders"]),
        MONEY_SCALE,
    )


@query
def fct_orders_double(spark, sf_dir):
    """The fact with plain double sums, as whole cents: their last digits depend on the row order.

    Amounts have four decimals, so cutting between two of those is the same for all orders.
    """
    raw = relations(spark, sf_dir)
    fact = marts.fct_orders(
        _details(raw, ORDER_ITEM_COLUMNS),
        order_payments(raw["payments"], raw["orders"]),
        order_reviews(raw["reviews"], raw["orders"]),
    )
    money = ["total_price", "total_freight", "order_value", "total_payment_value"]
    return fact.withColumns({c: F.floor((F.col(c) + 0.00005) * 100) for c in money})


@query
def dim_customers(spark, sf_dir):
    return marts.dim_customers(_details(relations(spark, sf_dir), CUSTOMER_COLUMNS), MONEY_SCALE)


@query
def dim_customers_one_pass(spark, sf_dir):
    return marts.dim_customers_one_pass(_details(relations(spark, sf_dir), CUSTOMER_COLUMNS), MONEY_SCALE)


@query
def dim_products(spark, sf_dir):
    return marts.dim_products(_details(relations(spark, sf_dir), PRODUCT_COLUMNS), MONEY_SCALE)


# Column tests

NOT_NULL_TESTS = [
    Expectation("order_details", "order_id", "not_null"),
    Expectation("order_details", "product_category_name", "not_null"),
    Expectation("order_details", "order_delivered_customer_date", "not_null", severity="warn"),
]
UNIQUE_TESTS = [
    Expectation("orders", "order_id", "unique"),
    Expectation("order_items", "order_id", "unique"),
    Expectation("customers", "customer_unique_id", "unique", severity="warn"),
    Expectation("products", "product_category_name", "unique"),
]
ACCEPTED_VALUES_TESTS = [
    Expectation("orders", "order_status", "accepted_values", values=ORDER_STATUSES),
    Expectation("orders", "order_status", "accepted_values", "warn", ("F", "O")),
    Expectation("products", "product_category_name", "accepted_values", values=("PROMO", "SMALL")),
]


@query
def dq_not_null(spark, sf_dir):
    tested = [test.column for test in NOT_NULL_TESTS]
    return run_suite({"order_details": _details(relations(spark, sf_dir), tested)}, NOT_NULL_TESTS)


@query
def dq_unique(spark, sf_dir):
    return run_suite(_raw(spark, sf_dir, "orders", "order_items", "customers", "products"), UNIQUE_TESTS)


@query
def dq_accepted_values(spark, sf_dir):
    return run_suite(_raw(spark, sf_dir, "orders", "products"), ACCEPTED_VALUES_TESTS)


@query
def dq_suite(spark, sf_dir):
    """The suite over silver and mart tables that are written first, as in the daily run."""
    folder = scratch_dir(spark, "dq")
    source, tables = relations(spark, sf_dir), {}
    buckets, schema = _buckets(source), f"dq_{uuid.uuid4().hex}"
    if buckets:
        create_schema(spark, schema, f"{folder}/{schema}")
        _drop_at_exit(spark, schema)
    for name, df in build_silver(source).items():
        if buckets:
            tables[name] = save_bucketed(df, f"{schema}.{name}", f"{folder}/{name}", buckets)
        else:
            tables[name] = _written(df, f"{folder}/{name}")
    tables |= build_staging(tables)
    for name, df in marts.build_marts(tables, MONEY_SCALE).items():
        tables[name] = _written(df, f"{folder}/{name}")
    return run_suite(tables, pipeline_suite(ORDER_STATUSES))


def _written(df: DataFrame, path: str) -> DataFrame:
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


# Raw snapshots, loading, CSV


def _two_days(spark, sf_dir) -> str:
    """Payments and orders landed on two days; the first day knew only the purchases."""
    folder = scratch_dir(spark, "raw")
    source = relations(spark, sf_dir)
    purchases = source["payments"].where(F.col("payment_type") == "purchase")
    write_snapshot(purchases, folder, "payments", DAY_1)
    write_snapshot(source["payments"], folder, "payments", DAY_2)
    write_snapshot(source["orders"], folder, "orders", DAY_1)
    write_snapshot(source["orders"], folder, "orders", DAY_2)
    return folder


def _payments_of(spark, sf_dir, snapshot: str) -> DataFrame:
    folder = _two_days(spark, sf_dir)
    return order_payments(
        read_snapshot(spark, folder, "payments", snapshot),
        read_snapshot(spark, folder, "orders", snapshot),
    )


@query
def snapshot_latest(spark, sf_dir):
    return _payments_of(spark, sf_dir, "latest")


@query
def snapshot_all(spark, sf_dir):
    return _payments_of(spark, sf_dir, "all")


@query
def raw_roundtrip(spark, sf_dir):
    """Landing the same day twice keeps one copy."""
    folder = scratch_dir(spark, "raw")
    items = relations(spark, sf_dir)["order_items"]
    write_snapshot(items, folder, "order_items", DAY_1)
    write_snapshot(items, folder, "order_items", DAY_1)
    return read_snapshot(spark, folder, "order_items")


@query
def raw_sellers(spark, sf_dir):
    """Sellers landed and read back."""
    folder = scratch_dir(spark, "raw")
    write_snapshot(relations(spark, sf_dir)["sellers"], folder, "sellers", DAY_1)
    return read_snapshot(spark, folder, "sellers")


@query
def raw_stamped(spark, sf_dir):
    """Two days of orders as they are stored: every row has the moment and the day of its run."""
    folder = scratch_dir(spark, "raw")
    orders = relations(spark, sf_dir)["orders"].select("order_id", "order_status")
    write_snapshot(orders.where("order_status = 'F'"), folder, "orders", DAY_1)
    write_snapshot(orders, folder, "orders", DAY_2)
    return spark.read.parquet(f"{folder}/orders")


@query
def ingest_report(spark, sf_dir):
    """A run over a good table, one whose files disagree, and one that is not there."""
    folder = scratch_dir(spark, "csv")
    source = relations(spark, sf_dir)
    _write_csv(source["payments"], f"{folder}/csv/payments.csv")
    for column in ("order_status", "customer_id"):
        part = source["orders"].select("order_id", column)
        part.write.mode("append").csv(f"{folder}/csv/orders.csv", header=True)
    landed = ingest(spark, f"{folder}/csv", f"{folder}/raw", DAY_1, retry_delay=0)
    missing = missing_tables(landed, ["payments", "orders", "sellers"])
    delete_folder(spark, f"{folder}/csv")
    lines = [(r.table, r.status, r.attempts, r.rows, r.table in missing) for r in landed]
    lines += [(t, "absent", 0, None, True) for t in missing if t not in {r.table for r in landed}]
    return spark.createDataFrame(
        lines, "table_name STRING, status STRING, attempts INT, landed_rows BIGINT, is_missing BOOLEAN"
    )


def _loaded_payments(spark, sf_dir, append: bool) -> DataFrame:
    folder = scratch_dir(spark, "load")
    schema = f"silver_{uuid.uuid4().hex}"
    write_parquet(_order_payments(spark, sf_dir), f"{folder}/order_payments")
    create_schema(spark, schema, f"{folder}/{schema}")
    _drop_at_exit(spark, schema)
    create_silver_tables(spark, schema)
    for _ in range(2):
        load(spark, f"{folder}/order_payments", schema, "order_payments", append=append)
    return spark.table(f"{schema}.order_payments")


def _drop_at_exit(spark: SparkSession, *schemas: str) -> None:
    """The result is read from the schema's tables, so they stay until the driver ends."""

    def drop() -> None:
        if spark.getActiveSession() is not None:
            for schema in schemas:
                spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")

    atexit.register(drop)


@query
def truncate_and_load(spark, sf_dir):
    """Loading twice with replacement keeps one copy."""
    return _loaded_payments(spark, sf_dir, append=False)


@query
def load_append(spark, sf_dir):
    """Loading twice without replacement keeps both copies."""
    return _loaded_payments(spark, sf_dir, append=True)


def _write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    df.write.csv(
        path,
        compression=compression,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


@query
def csv_ingest(spark, sf_dir):
    folder = scratch_dir(spark, "csv")
    _write_csv(relations(spark, sf_dir)["order_items"], f"{folder}/csv/order_items.csv")
    ingest(spark, f"{folder}/csv", f"{folder}/raw", DAY_1, required=["order_items"])
    delete_folder(spark, f"{folder}/csv")
    return typed(read_snapshot(spark, f"{folder}/raw", "order_items"), RAW["order_items"])


@query
def csv_ingest_free_text(spark, sf_dir):
    """Whole document texts, with their line breaks and quotes, through CSV and back."""
    folder = scratch_dir(spark, "csv")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    _write_csv(documents, f"{folder}/csv/documents.csv")
    ingest(spark, f"{folder}/csv", f"{folder}/raw", DAY_1, required=["documents"])
    delete_folder(spark, f"{folder}/csv")
    return read_snapshot(spark, f"{folder}/raw", "documents")


@query
def csv_ingest_inferred(spark, sf_dir):
    """A table without a known schema: types are taken from its values."""
    folder = scratch_dir(spark, "csv")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    _write_csv(customer, f"{folder}/csv/customer.csv")
    ingest(
        spark, f"{folder}/csv", f"{folder}/raw", DAY_1, required=["customer"], infer=["customer"]
    )
    delete_folder(spark, f"{folder}/csv")
    return read_snapshot(spark, f"{folder}/raw", "customer")


@query
def csv_inferred_ids(spark, sf_dir):
    """Ids of 18 to 20 digits: integers as far as they are exact, else text."""
    folder = scratch_dir(spark, "csv")
    key = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").cast("string"))
    ids = key.select(
        *[
            F.concat(F.lit("1"), F.lpad("o_orderkey", digits - 1, "0")).alias(f"id{digits}")
            for digits in (18, 19, 20)
        ]
    )
    _write_csv(ids, f"{folder}/csv/ids.csv")
    ingest(spark, f"{folder}/csv", f"{folder}/raw", DAY_1, required=["ids"], infer=["ids"])
    delete_folder(spark, f"{folder}/csv")
    return read_snapshot(spark, f"{folder}/raw", "ids")


@query
def csv_folder_headers(spark, sf_dir):
    """One table in files whose headers list the columns in three orders."""
    folder = scratch_dir(spark, "csv")
    items = relations(spark, sf_dir)["order_items"]
    for turn in range(3):
        part = items.where(F.pmod("order_item_id", F.lit(3)) == turn)
        columns = items.columns[turn:] + items.columns[:turn]
        part.select(*columns).write.mode("append").csv(f"{folder}/csv/order_items.csv", header=True)
    ingest(spark, f"{folder}/csv", f"{folder}/raw", DAY_1, required=["order_items"])
    delete_folder(spark, f"{folder}/csv")
    return typed(read_snapshot(spark, f"{folder}/raw", "order_items"), RAW["order_items"])


@query
def money_limits(spark, sf_dir):
    """Sums of amounts up to 1e15, one of them with a NaN, as whole tens of billions."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    amount = F.floor("l_extendedprice").cast("double") * F.pow(F.lit(10.0), F.col("l_linenumber") + 3)
    odd = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7)
    total = money_sum("amount", MONEY_SCALE)
    items = items.withColumn("amount", F.when(odd, F.lit(float("nan"))).otherwise(amount))
    return (
        split_amounts(items, ["amount"], MONEY_SCALE)
        .groupBy("l_returnflag")
        .agg(total.alias("total"))
        .select(
            "l_returnflag",
            F.isnan("total").alias("is_nan"),
            F.when(~F.isnan("total"), F.floor(F.col("total") / 1e10)).alias("tens_of_billions"),
        )
    )


@query
def truncate_table(spark, sf_dir):
    """Two loads, a truncation and one more load leave one copy."""
    folder = scratch_dir(spark, "load")
    schema = f"silver_{uuid.uuid4().hex}"
    write_parquet(_order_payments(spark, sf_dir), f"{folder}/order_payments")
    create_schema(spark, schema, f"{folder}/{schema}")
    _drop_at_exit(spark, schema)
    create_silver_tables(spark, schema)
    load(spark, f"{folder}/order_payments", schema, "order_payments")
    truncate(spark, schema, "order_payments")
    load(spark, f"{folder}/order_payments", schema, "order_payments", append=True)
    return spark.table(f"{schema}.order_payments")


@query
def mart_rebuild(spark, sf_dir):
    """A second build that fails leaves the first one."""
    folder = scratch_dir(spark, "marts")
    schema = f"marts_{uuid.uuid4().hex}"
    create_schema(spark, schema, f"{folder}/{schema}")
    _drop_at_exit(spark, schema)
    fact = QUERIES["fct_orders"](spark, sf_dir)
    save_table(fact, schema, "fct_orders")
    broken = fact.withColumn("item_count", F.raise_error(F.lit("broken")).cast("bigint"))
    try:
        save_table(broken, schema, "fct_orders")
    except Exception as error:  # the build's own message, from a task
        if "broken" not in str(error):
            raise
    return spark.table(f"{schema}.fct_orders")


def _daily_run(spark, sf_dir):
    """The daily run from CSV files to the marts, tests included: layout and test report."""
    folder = scratch_dir(spark, "run")
    # The silver tables hold codes of states, not their names.
    source = relations(spark, sf_dir, state="concat('R', r_regionkey)")
    for name, df in source.items():
        _write_csv(df, f"{folder}/csv/{name}.csv", compression="gzip")
    tag = uuid.uuid4().hex
    layout = pipeline.Layout(
        raw_path=f"{folder}/raw",
        silver_path=f"{folder}/silver",
        silver_schema=f"silver_{tag}",
        staging_schema=f"staging_{tag}",
        marts_schema=f"marts_{tag}",
        schema_root=f"{folder}/schemas",
        buckets=_buckets(source),
    )
    _drop_at_exit(spark, layout.silver_schema, layout.staging_schema, layout.marts_schema)
    done = pipeline.run(
        spark,
        f"{folder}/csv",
        layout,
        DAY_1,
        money_scale=MONEY_SCALE,
        order_statuses=ORDER_STATUSES,
    )
    for stage in ("csv", "raw"):
        delete_folder(spark, f"{folder}/{stage}")
    return layout, done.report


@query
def daily_run(spark, sf_dir):
    layout, _ = _daily_run(spark, sf_dir)
    return spark.table(f"{layout.marts_schema}.fct_orders")


@query
def daily_run_customers(spark, sf_dir):
    layout, _ = _daily_run(spark, sf_dir)
    return spark.table(f"{layout.marts_schema}.dim_customers")


@query
def daily_run_products(spark, sf_dir):
    layout, _ = _daily_run(spark, sf_dir)
    return spark.table(f"{layout.marts_schema}.dim_products")


@query
def daily_run_report(spark, sf_dir):
    _, report = _daily_run(spark, sf_dir)
    return report
