import uuid
from pathlib import Path

import pytest

from orderloom.plans.marts import fct_orders
from orderloom.plans.staging import build_staging
from orderloom.schemas import SILVER
from orderloom.sources.tables import (
    create_schema,
    create_silver_tables,
    load,
    load_rows,
    save_table,
    table_location,
    truncate,
    write_parquet,
)


@pytest.fixture
def schema(spark):
    name = f"silver_{uuid.uuid4().hex}"
    create_schema(spark, name)
    create_schema(spark, name)
    create_silver_tables(spark, name)
    return name


def stored(tmp_path, tables):
    for name in SILVER:
        write_parquet(tables[name], f"{tmp_path}/{name}")
    return str(tmp_path)


def folders(spark, schema):
    """How many folders loads of order details have left."""
    location = table_location(spark, f"{schema}.order_details")
    root = Path(location.removeprefix("file:")).parent
    return len(list(root.glob("order_details-*")))


def test_create(spark, schema):
    for table, columns in SILVER.items():
        assert spark.table(f"{schema}.{table}").columns == list(columns)
    create_silver_tables(spark, schema, if_not_exists=True)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_silver_tables(spark, schema)


def test_load_replaces_append_adds_truncate_empties(spark, schema, build, tmp_path):
    folder = stored(tmp_path, build())
    for table in SILVER:
        name = f"{schema}.{table}"
        load(spark, f"{folder}/{table}", schema, table)
        load(spark, f"{folder}/{table}", schema, table)
        assert spark.table(name).count() == 1
        load(spark, f"{folder}/{table}", schema, table, append=True)
        assert spark.table(name).count() == 2
        truncate(spark, schema, table)
        assert spark.table(name).count() == 0
        load(spark, f"{folder}/{table}", schema, table)
        assert spark.table(name).count() == 1


def test_a_view_follows_the_load(spark, schema, build, tmp_path):
    spark.sql(f"CREATE VIEW {schema}.states AS SELECT customer_state FROM {schema}.order_details")
    for state in ("SP", "RJ"):
        folder = stored(tmp_path / state, build(customers=[{"customer_state": state}]))
        load(spark, f"{folder}/order_details", schema, "order_details")
        assert [r[0] for r in spark.table(f"{schema}.states").collect()] == [state]


def test_load_matches_columns_by_name(spark, schema, build, tmp_path):
    payments = build()["order_payments"]
    write_parquet(payments.select(*reversed(payments.columns)), f"{tmp_path}/p")
    load(spark, f"{tmp_path}/p", schema, "order_payments")
    assert spark.table(f"{schema}.order_payments").collect() == payments.collect()
    write_parquet(payments.withColumnRenamed("payment_type", "kind"), f"{tmp_path}/q")
    with pytest.raises(ValueError, match="order_payments"):
        load(spark, f"{tmp_path}/q", schema, "order_payments")


def test_text_longer_than_its_column_fails_and_keeps_the_table(spark, schema, build, tmp_path):
    load(spark, f"{stored(tmp_path / 'a', build())}/order_details", schema, "order_details")
    long = build(customers=[{"customer_state": "SAO PAULO"}])
    folder = stored(tmp_path / "b", long)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        load(spark, f"{folder}/order_details", schema, "order_details")
    assert [r.customer_state for r in spark.table(f"{schema}.order_details").collect()] == ["SP"]
    assert folders(spark, schema) == 1
    fixed = stored(tmp_path / "c", build(customers=[{"customer_state": "RJ"}]))
    load(spark, f"{fixed}/order_details", schema, "order_details")
    assert [r.customer_state for r in spark.table(f"{schema}.order_details").collect()] == ["RJ"]
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {schema}").collect()]
    assert sorted(tables) == sorted(SILVER)
    # The folder before stays for readers that began before the switch.
    assert folders(spark, schema) == 2
    load(spark, f"{fixed}/order_details", schema, "order_details")
    assert folders(spark, schema) == 2


def test_output_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8)
    write_parquet(df, f"{tmp_path}/t", output_files=2)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 2
    write_parquet(df.limit(10), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 10


def test_save_table_rebuilds(spark, schema):
    save_table(spark.range(3), schema, "mart")
    save_table(spark.range(2).withColumnRenamed("id", "other"), schema, "mart")
    assert spark.table(f"{schema}.mart").columns == ["other"]
    assert spark.table(f"{schema}.mart").count() == 2


def test_a_failed_build_keeps_the_mart(spark, schema):
    save_table(spark.range(3), schema, "mart")
    save_table(spark.range(5), schema, "mart")
    for rows in (
        spark.range(4).selectExpr("raise_error('broken') AS id").selectExpr("cast(id AS bigint) id"),
        spark.range(4).selectExpr("raise_error('broken') AS other"),
    ):
        with pytest.raises(Exception, match="broken"):
            save_table(rows, schema, "mart")
        assert spark.table(f"{schema}.mart").count() == 5
    open_reader = spark.table(f"{schema}.mart")
    save_table(spark.range(7), schema, "mart")
    assert open_reader.count() in (5, 7)
    save_table(spark.range(2).withColumnRenamed("id", "other"), schema, "mart")
    save_table(spark.range(9).withColumnRenamed("id", "other"), schema, "mart")
    assert spark.table(f"{schema}.mart").count() == 9


def test_a_reader_that_began_before_the_load_finishes(spark, schema, build, tmp_path):
    folder = stored(tmp_path, build())
    load(spark, f"{folder}/order_details", schema, "order_details")
    before = spark.table(f"{schema}.order_details")
    before.explain()
    load(spark, f"{folder}/order_details", schema, "order_details")
    assert len(before.collect()) == 1


def test_a_folder_of_the_caller_stays(spark, schema, build, tmp_path):
    """A table may stand on the folder that is loaded into it."""
    folder = stored(tmp_path, build())
    spark.sql(f"ALTER TABLE {schema}.order_payments SET LOCATION '{folder}/order_payments'")
    for _ in range(3):
        load(spark, f"{folder}/order_payments", schema, "order_payments")
    assert spark.read.parquet(f"{folder}/order_payments").count() == 1
    assert spark.table(f"{schema}.order_payments").count() == 1


def test_files_are_of_one_size_under_skew(spark, conf, tmp_path):
    """Nearly all rows in one partition: the files of a balanced write are within 2x of each other."""
    conf(adaptive__advisoryPartitionSizeInBytes="256k", adaptive__coalescePartitions__minPartitionSize="64k")
    rows = spark.range(0, 400_000, 1, 1).selectExpr("id", "xxhash64(id) AS h").union(
        spark.range(0, 10, 1, 10).selectExpr("id", "xxhash64(id) AS h")
    )

    def sizes(name, **kwargs):
        write_parquet(rows, f"{tmp_path}/{name}", **kwargs)
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == 400_010
        return sorted(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))

    skewed, balanced = sizes("skewed"), sizes("balanced", rebalance=True)
    assert skewed[-1] > 100 * skewed[0]
    assert len(balanced) > 4 and balanced[-1] < 2 * balanced[0]


def test_bucketed_silver_gives_the_order_fact_without_a_shuffle(spark, conf, build, tmp_path):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    items = [{"order_id": f"o{k}", "order_item_id": str(i)} for k in range(40) for i in range(3)]
    tables = build(
        orders=[{"order_id": f"o{k}"} for k in range(40)], order_items=items,
        payments=[{"order_id": f"o{k}"} for k in range(40)], reviews=[{"order_id": f"o{k}"} for k in range(40)],
    )
    facts = {}
    for buckets in (None, 4):
        name = f"silver_{uuid.uuid4().hex}"
        create_schema(spark, name)
        create_silver_tables(spark, name, buckets=buckets)
        for table in SILVER:
            for _ in range(2):  # the version of a load keeps the buckets
                load_rows(tables[table], name, table)
        staged = build_staging({t: spark.table(f"{name}.{t}") for t in SILVER})
        fact = fct_orders(*[staged[f"stg_order_{n}"] for n in ("details", "payments", "reviews")], money_scale=4)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        facts[buckets] = (sorted(fact.collect()), "Exchange" in plan)
    assert facts[None] == (facts[4][0], True)
    assert not facts[4][1] and len(facts[4][0]) == 40
    load_rows(tables["order_payments"], name, "order_payments", append=True)
    assert spark.table(f"{name}.order_payments").count() == 80
