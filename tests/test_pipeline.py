import csv
import uuid
from dataclasses import replace
from datetime import datetime, timezone

import pytest

from default_rows import DEFAULTS
from orderloom.operators.expectations import ExpectationsFailed
from orderloom.parallel import together
from orderloom.plans import pipeline
from orderloom.sources.raw import MissingTables

DAY_1 = datetime(2024, 5, 1, 6, tzinfo=timezone.utc)
DAY_2 = datetime(2024, 5, 2, 6, tzinfo=timezone.utc)


@pytest.fixture
def layout(tmp_path):
    tag = uuid.uuid4().hex
    return pipeline.Layout(
        raw_path=f"{tmp_path}/raw",
        silver_path=f"{tmp_path}/silver",
        silver_schema=f"silver_{tag}",
        staging_schema=f"staging_{tag}",
        marts_schema=f"marts_{tag}",
        schema_root=f"{tmp_path}/schemas",
    )


@pytest.fixture
def csv_dir(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()

    def write(**tables):
        for name, default in DEFAULTS.items():
            with open(folder / f"{name}.csv", "w", newline="") as f:
                out = csv.DictWriter(f, list(default))
                out.writeheader()
                out.writerows({**default, **row} for row in tables.get(name, [{}]))
        return str(folder)

    return write


def test_run(spark, layout, csv_dir):
    folder = csv_dir(
        order_items=[{"order_item_id": "1"}, {"order_item_id": "2", "price": "7"}],
        reviews=[{"review_comment_message": 'Chegou.\nMuito "bom", obrigado'}],
    )
    done = pipeline.run(spark, folder, layout, DAY_1)
    assert {r.status for r in done.landed} == {"landed"}
    assert {r.status for r in done.report.collect()} == {"pass"}
    (fact,) = spark.table(f"{layout.marts_schema}.fct_orders").collect()
    assert (fact.order_id, fact.item_count, fact.total_price) == ("o1", 2, 17.0)
    (customer,) = spark.table(f"{layout.marts_schema}.dim_customers").collect()
    assert (customer.total_orders, customer.is_repeat_customer) == (1, False)
    (product,) = spark.table(f"{layout.marts_schema}.dim_products").collect()
    assert (product.times_ordered, product.avg_price) == (1, 8.5)
    (review,) = spark.table(f"{layout.staging_schema}.stg_order_reviews").collect()
    assert review.review_comment_message == 'Chegou.\nMuito "bom", obrigado'


def test_second_day_and_repeated_day_count_nothing_twice(spark, layout, csv_dir):
    for day in (DAY_1, DAY_1, DAY_2):
        pipeline.run(spark, csv_dir(), layout, day)
    (fact,) = spark.table(f"{layout.marts_schema}.fct_orders").collect()
    assert (fact.item_count, fact.payment_count) == (1, 1)
    assert spark.table(f"{layout.silver_schema}.order_details").count() == 1


def test_all_snapshots_multiply_and_fail_the_review_test(spark, layout, csv_dir):
    pipeline.run(spark, csv_dir(), layout, DAY_1)
    with pytest.raises(ExpectationsFailed, match=r"unique\(stg_order_reviews.review_id\)"):
        pipeline.run(spark, csv_dir(), layout, DAY_2, snapshot="all")
    (fact,) = spark.table(f"{layout.marts_schema}.fct_orders").collect()
    assert (fact.item_count, fact.payment_count) == (2**6, 2**2)


def test_failed_tests_raise_after_the_marts_are_built(spark, layout, csv_dir):
    folder = csv_dir(orders=[{"order_status": "lost"}])
    with pytest.raises(ExpectationsFailed, match="accepted_values"):
        pipeline.run(spark, folder, layout, DAY_1)
    assert spark.table(f"{layout.marts_schema}.fct_orders").count() == 1
    done = pipeline.run(spark, folder, layout, DAY_1, raise_on_error=False)
    assert [r.column_name for r in done.report.collect() if r.status == "fail"] == ["order_status"]


def test_table_that_cannot_be_read(spark, layout, csv_dir, tmp_path):
    folder = csv_dir()
    pipeline.run(spark, folder, layout, DAY_1)
    (tmp_path / "csv" / "sellers.csv").unlink()
    with pytest.raises(MissingTables, match="sellers"):
        pipeline.run(spark, folder, layout, DAY_2)
    done = pipeline.run(spark, folder, layout, DAY_2, allow_missing=True)
    assert "sellers" not in {r.table for r in done.landed}
    (row,) = spark.table(f"{layout.silver_schema}.order_details").collect()
    assert row.seller_city == "campinas"


def test_table_nobody_reads_is_landed_too(spark, layout, csv_dir, tmp_path):
    folder = csv_dir()
    (tmp_path / "csv" / "places.csv").write_text("zip,lat\n01037,-23.5\n")
    pipeline.run(spark, folder, layout, DAY_1)
    place = spark.read.parquet(f"{layout.raw_path}/places").first()
    assert (place.zip, place.lat) == ("01037", -23.5)


def test_silver_tables_can_be_written_directly(spark, layout, csv_dir, tmp_path):
    direct = replace(layout, silver_path=None)
    for _ in range(2):
        done = pipeline.run(spark, csv_dir(), direct, DAY_1)
        assert {r.status for r in done.report.collect()} == {"pass"}
    assert spark.table(f"{layout.silver_schema}.order_details").count() == 1
    assert not (tmp_path / "silver").exists()


def test_nothing_to_ingest_writes_nothing(spark, layout, tmp_path):
    done = pipeline.run(spark, f"{tmp_path}/nowhere", layout, DAY_1)
    assert (done.landed, done.report) == ([], None)
    assert not (tmp_path / "raw").exists()
    assert not (tmp_path / "silver").exists()


def test_counts_on_the_write_agree_with_scans(spark, layout, csv_dir):
    """Row tests are counted by the writes of silver tables and marts; only `unique` reads tables."""
    folder = csv_dir(
        orders=[{"order_status": "lost"}, {"order_id": "o2", "order_status": None}],
        order_items=[{"order_item_id": "x"}, {"order_id": "o2", "order_item_id": None}, {"product_id": None}],
        payments=[],
        reviews=[{"review_id": None}, {}, {}],
    )
    done = pipeline.run(spark, folder, layout, DAY_1, raise_on_error=False)
    scanned = pipeline.quality_report(spark, layout)
    key = ["table_name", "column_name", "test_name"]
    assert sorted(done.report.collect()) == sorted(scanned.collect())
    assert {r.failures for r in done.report.collect()} >= {0, 1, 2}
    known = {t: 0 for t in pipeline.pipeline_suite() if t.test != "unique"}
    plan = pipeline.quality_report(spark, layout, known=known)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len({t for t in pipeline.pipeline_suite() if t.test == "unique"})
    assert len(done.report.select(*key).distinct().collect()) == len(known) + 4


def test_the_stages_can_be_run_apart(spark, layout, csv_dir):
    pipeline.ingest(spark, csv_dir(), layout.raw_path, DAY_1)
    pipeline.transform(spark, layout)
    assert spark.read.parquet(f"{layout.silver_path}/order_details").count() == 1
    for _ in range(2):
        pipeline.load_silver(spark, layout)
        pipeline.build_models(spark, layout)
    assert {r.status for r in pipeline.quality_report(spark, layout).collect()} == {"pass"}


def test_jobs_at_once_end_before_an_error_is_raised(spark):
    ended = []

    def job(name, fails):
        def run():
            count = spark.range(10).count()
            if fails:
                raise ValueError(name)
            ended.append(name)
            return count

        return run

    with pytest.raises(ValueError, match="b"):
        together(spark, {n: job(n, n == "b") for n in "abcdef"}, workers=2)
    assert sorted(ended) == list("acdef")
    assert together(spark, {"x": job("x", False)}) == {"x": 10}


def test_buckets_reach_the_marts(spark, conf, layout, csv_dir, monkeypatch):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    orders = [{"order_id": f"o{k}"} for k in range(20)]
    folder = csv_dir(orders=orders, order_items=orders, payments=orders, reviews=orders)
    built, build = {}, pipeline.build_marts
    monkeypatch.setattr(pipeline, "build_marts", lambda staging, scale: built.update(m := build(staging, scale)) or m)
    pipeline.run(spark, folder, replace(layout, buckets=8), DAY_1, money_scale=4, raise_on_error=False)
    plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in built.items()}
    assert "Exchange" not in plans["fct_orders"]
    assert plans["dim_customers"].count("Exchange") == 1
    assert spark.table(f"{layout.marts_schema}.fct_orders").count() == 20
