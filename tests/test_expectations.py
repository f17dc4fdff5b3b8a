import pytest

from orderloom.operators.expectations import (
    Expectation,
    ExpectationsFailed,
    raise_on_failure,
    run_suite,
)
from orderloom.plans.suite import ORDER_STATUSES, pipeline_suite


@pytest.fixture
def table(spark):
    rows = [("a", "delivered"), ("a", "lost"), ("b", "shipped"), (None, None), (None, "delivered")]
    return spark.createDataFrame(rows, "key STRING, state STRING")


def report(table, *tests):
    rows = run_suite({"t": table}, tests).collect()
    return {(r.test_name, r.column_name): (r.failures, r.status) for r in rows}


def test_failing(table):
    found = report(
        table,
        Expectation("t", "key", "not_null"),
        Expectation("t", "key", "unique"),
        Expectation("t", "state", "accepted_values", values=("delivered", "shipped")),
        Expectation("t", "state", "not_null", severity="warn"),
    )
    assert found == {
        ("not_null", "key"): (2, "fail"),
        ("unique", "key"): (1, "fail"),
        ("accepted_values", "state"): (1, "fail"),
        ("not_null", "state"): (1, "warn"),
    }


def test_passing(table):
    clean = table.where("key = 'b'")
    found = report(
        clean,
        Expectation("t", "key", "not_null"),
        Expectation("t", "key", "unique"),
        Expectation("t", "state", "accepted_values", values=("shipped",)),
    )
    assert set(found.values()) == {(0, "pass")}


def test_empty_table_passes(table):
    found = report(
        table.limit(0),
        Expectation("t", "key", "not_null"),
        Expectation("t", "key", "unique"),
        Expectation("t", "state", "accepted_values", values=("shipped",)),
    )
    assert set(found.values()) == {(0, "pass")}


def test_nulls_pass_unique_and_accepted_values(table):
    nulls = table.where("key IS NULL AND state IS NULL").unionAll(
        table.where("key IS NULL AND state IS NULL")
    )
    found = report(
        nulls,
        Expectation("t", "key", "unique"),
        Expectation("t", "state", "accepted_values", values=("shipped",)),
    )
    assert set(found.values()) == {(0, "pass")}


def test_only_errors_raise(table):
    warned = run_suite({"t": table}, [Expectation("t", "key", "not_null", severity="warn")])
    raise_on_failure(warned)
    failed = run_suite({"t": table}, [Expectation("t", "key", "unique")])
    with pytest.raises(ExpectationsFailed, match=r"unique\(t.key\): 1"):
        raise_on_failure(failed)


def test_unknown_tests_are_rejected():
    with pytest.raises(ValueError, match="unknown test"):
        Expectation("t", "key", "positive")
    with pytest.raises(ValueError, match="unknown severity"):
        Expectation("t", "key", "unique", severity="info")


def test_pipeline_suite():
    suite = pipeline_suite()
    kinds = [t.test for t in suite]
    assert len(suite) == 23
    assert (kinds.count("not_null"), kinds.count("unique")) == (18, 4)
    assert [t.column for t in suite if t.severity == "warn"] == ["total_payment_value"]
    (accepted,) = [t for t in suite if t.test == "accepted_values"]
    assert accepted.values == ORDER_STATUSES
    assert len(ORDER_STATUSES) == 8


def test_pipeline_suite_finds_each_kind_of_failure(build):
    good = run_suite(build(), pipeline_suite()).collect()
    assert {r.status for r in good} == {"pass"}
    bad = run_suite(
        build(
            orders=[{}, {"order_status": "lost"}],
            reviews=[{}, {}],
            payments=[{"payment_sequential": None}],
        ),
        pipeline_suite(),
    )
    failed = {
        (r.table_name, r.column_name, r.test_name, r.failures)
        for r in bad.collect()
        if r.status != "pass"
    }
    assert failed == {
        ("order_payments", "payment_sequential", "not_null", 2),
        ("stg_order_reviews", "review_id", "unique", 1),
        ("fct_orders", "order_id", "unique", 1),
        ("fct_orders", "order_status", "accepted_values", 1),
    }
    unpaid = run_suite(build(payments=[]), pipeline_suite())
    assert [r.column_name for r in unpaid.collect() if r.status == "warn"] == [
        "total_payment_value"
    ]
    raise_on_failure(unpaid)
