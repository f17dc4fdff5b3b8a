"""Each registered query against its SQL on the smallest test tables, and what must always hold."""

from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from orderloom.functions.measures import money_sum, split_amounts
from orderloom.parity.oracle import ORACLE
from orderloom.parity.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def comparable(value):
    return value.replace(tzinfo=None).isoformat() if isinstance(value, datetime) else repr(value)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(tuple(map(comparable, row)) for row in df.select(*columns).collect())
    expected = sorted(tuple(map(comparable, row)) for row in result.fetchall())
    assert expected
    assert got == expected


def test_invariants(spark):
    details = QUERIES["silver_order_details"](spark, SF_DIR)
    fact = QUERIES["fct_orders"](spark, SF_DIR)
    customers = QUERIES["dim_customers"](spark, SF_DIR)
    assert fact.agg(F.sum("item_count")).first()[0] == details.count()
    by_customer = split_amounts(customers, ["lifetime_value"], 4).agg(money_sum("lifetime_value", 4)).first()[0]
    known = details.where("customer_unique_id IS NOT NULL")
    assert by_customer == split_amounts(known, ["total_item_value"], 4).agg(
        money_sum("total_item_value", 4)
    ).first()[0]
    assert fact.select("order_id").distinct().count() == fact.count()
