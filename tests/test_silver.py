import pytest
from pyspark.sql import functions as F

from orderloom.plans.silver import build_silver, order_details
from orderloom.plans.staging import STAGING_COLUMNS, STAGING_SOURCE
from orderloom.schemas import SILVER, in_table_order


def test_columns_and_types(build):
    tables = build()
    for name, columns in SILVER.items():
        assert tables[name].columns == list(columns)
    kinds = dict(tables["order_details"].dtypes)
    assert kinds["order_item_id"] == "int"
    assert kinds["price"] == "double"
    assert kinds["order_approved_at"] == "timestamp"
    assert kinds["product_weight_g"] == "int"
    assert kinds["delivery_days"] == "int"
    for model, source in STAGING_SOURCE.items():
        assert tables[model].columns == STAGING_COLUMNS[model]
        assert sorted(tables[model].columns) == sorted(tables[source].columns)


def test_one_full_row(build):
    row = build()["order_details"].first()
    assert (row.order_id, row.customer_unique_id, row.seller_city) == ("o1", "u1", "campinas")
    assert (row.product_category_name_english, row.product_weight_g) == ("books", 225)
    assert (row.price, row.freight_value, row.total_item_value) == (10.0, 2.5, 12.5)


@pytest.mark.parametrize(
    "purchase, delivered, estimated, days, early",
    [
        ("2018-01-01 23:59:59", "2018-01-02 00:00:01", "2018-01-05 12:00:00", 1, 3),
        ("2018-01-01 00:00:01", "2018-01-01 23:59:59", "2018-01-01 00:00:00", 0, 0),
        ("2018-01-05 10:00:00", "2018-01-03 10:00:00", "2018-01-01 10:00:00", -2, -2),
        ("2018-01-05 10:00:00", None, "2018-01-09 10:00:00", None, None),
        (None, "2018-01-05 10:00:00", None, None, None),
    ],
)
def test_days_count_calendar_days(build, purchase, delivered, estimated, days, early):
    order = {
        "order_purchase_timestamp": purchase,
        "order_delivered_customer_date": delivered,
        "order_estimated_delivery_date": estimated,
    }
    row = build(orders=[order])["order_details"].first()
    assert (row.delivery_days, row.estimated_vs_actual_days) == (days, early)


def test_null_price_makes_total_null(build):
    rows = [{"price": None, "freight_value": "5"}, {"order_item_id": "2"}]
    tables = build(order_items=rows)
    totals = {r.order_item_id: r.total_item_value for r in tables["order_details"].collect()}
    assert totals == {1: None, 2: 12.5}
    fact = tables["fct_orders"].first()
    assert (fact.item_count, fact.total_price, fact.total_freight) == (2, 10.0, 7.5)
    assert fact.order_value == 12.5
    assert tables["dim_products"].first().avg_price == 10.0


def test_item_without_product_or_seller_is_kept(build):
    items = [
        {"order_item_id": "1", "product_id": None, "seller_id": None},
        {"order_item_id": "2", "product_id": "unknown", "seller_id": "unknown"},
    ]
    tables = build(order_items=items)
    for row in tables["order_details"].collect():
        assert row.product_category_name is None
        assert row.seller_city is None
    assert [r.product_id for r in tables["dim_products"].collect()] == ["unknown"]


def test_null_category_matches_nothing(build):
    tables = build(
        products=[{"product_category_name": None}],
        category_translation=[
            {"product_category_name": None, "product_category_name_english": "none"}
        ],
    )
    rows = tables["order_details"].collect()
    assert [r.product_category_name_english for r in rows] == [None]


def test_rows_without_their_order_are_dropped(build):
    orphan = {"order_id": "nowhere"}
    tables = build(
        order_items=[{}, orphan], payments=[{}, orphan], reviews=[{}, {**orphan, "review_id": "r2"}]
    )
    for name in SILVER:
        assert tables[name].count() == 1


def test_order_without_customer_is_dropped(build):
    tables = build(orders=[{"customer_id": "gone"}])
    assert tables["order_details"].count() == 0
    assert tables["order_payments"].count() == 1


def test_order_without_items_has_payments_but_no_fact(build):
    tables = build(
        orders=[{}, {"order_id": "o2"}], payments=[{"order_id": "o2"}, {"order_id": "o1"}]
    )
    assert {r.order_id for r in tables["order_payments"].collect()} == {"o1", "o2"}
    assert [r.order_id for r in tables["fct_orders"].collect()] == ["o1"]


def test_duplicate_dimension_rows_repeat_items(build):
    assert build(products=[{}, {}], sellers=[{}, {}])["order_details"].count() == 4


def test_loaded_at_on_every_table_is_harmless(raw):
    tables = {n: df.withColumn("loaded_at", F.current_timestamp()) for n, df in raw().items()}
    assert build_silver(tables)["order_details"].count() == 1


def details(tables, **options):
    names = [
        "order_items", "orders", "customers", "products", "category_translation", "sellers"
    ]
    return order_details(*[tables[n] for n in names], **options)


ALL_KEYS = ("products", "category_translation", "sellers")


@pytest.mark.parametrize(
    "columns, joined",
    [
        (["order_id", "price"], 2),
        (["order_id", "seller_city"], 3),
        (["order_id", "product_weight_g"], 3),
        (["order_id", "product_category_name"], 3),
        (["order_id", "product_category_name_english"], 4),
        (list(SILVER["order_details"]), 5),
    ],
)
def test_joins_that_give_nothing_are_left_out(raw, columns, joined):
    tables = raw(order_items=[{}, {"product_id": None, "seller_id": "x", "order_item_id": "2"}])
    cut = details(tables, columns=columns, unique_keys=ALL_KEYS)
    full = details(tables).select(*columns)
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, full.collect()))
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == joined


def test_joins_are_kept_where_keys_may_repeat(raw):
    tables = raw(products=[{}, {}])
    assert details(tables, columns=["order_id"]).count() == 2


def test_in_table_order_rejects_other_columns(build):
    payments = build()["order_payments"]
    shuffled = payments.select(*reversed(payments.columns))
    assert in_table_order(shuffled, "order_payments").columns == payments.columns
    with pytest.raises(ValueError, match="order_payments"):
        in_table_order(payments.withColumn("more", F.lit(1)), "order_payments")
    with pytest.raises(ValueError, match="order_payments"):
        in_table_order(payments.drop("payment_type"), "order_payments")
