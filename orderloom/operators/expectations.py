"""Column tests: not_null, unique and accepted_values, reported as a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_TESTS = ("not_null", "accepted_values")


@dataclass(frozen=True)
class Expectation:
    table: str
    column: str
    test: str
    severity: str = "error"
    values: tuple = ()

    def __post_init__(self):
        if self.test not in (*ROW_TESTS, "unique"):
            raise ValueError(f"unknown test {self.test!r}")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"unknown severity {self.severity!r}")


class ExpectationsFailed(Exception):
    """At least one test of severity error failed."""


def _failing_rows(test: Expectation) -> Column:
    if test.test == "not_null":
        return F.count_if(F.col(test.column).isNull())
    # NULL is let through: NOT IN is NULL for it.
    return F.count_if(~F.col(test.column).isin(*test.values))


def _line(test: Expectation, failures: Column) -> Column:
    return F.struct(
        F.lit(test.table).alias("table_name"),
        F.lit(test.column).alias("column_name"),
        F.lit(test.test).alias("test_name"),
        F.lit(test.severity).alias("severity"),
        failures.alias("failures"),
    )


def _row_tests(df: DataFrame, tests: list[Expectation]) -> DataFrame:
    """All row-wise tests of a table in one scan."""
    counts = df.agg(*[_failing_rows(t).alias(f"t{i}") for i, t in enumerate(tests)])
    lines = F.array(*[_line(t, F.col(f"t{i}")) for i, t in enumerate(tests)])
    return counts.select(F.inline(lines))


def _unique_test(df: DataFrame, test: Expectation) -> DataFrame:
    """Counts the values that occur more than once; NULLs are not compared."""
    repeated = (
        df.where(F.col(test.column).isNotNull())
        .groupBy(test.column)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )
    return repeated.agg(F.count("*").alias("n")).select(F.inline(F.array(_line(test, F.col("n")))))


def row_test_counts(suite: Iterable[Expectation], table: str) -> dict[Expectation, Column]:
    """The row-wise tests of a table as aggregates, for a write that counts them on its way."""
    return {t: _failing_rows(t) for t in suite if t.table == table and t.test in ROW_TESTS}


def run_suite(
    tables: Mapping[str, DataFrame],
    suite: Iterable[Expectation],
    known: Mapping[Expectation, int] | None = None,
) -> DataFrame:
    """One row per test: table_name, column_name, test_name, severity, failures, status.

    Tests whose failures are ``known``, from the write of their table, need no scan.
    """
    known = known or {}
    by_table: dict[str, list[Expectation]] = {}
    parts, counted = [], []
    for test in suite:
        if test in known:
            counted.append(_line(test, F.lit(known[test]).cast("long")))
        else:
            by_table.setdefault(test.table, []).append(test)
    if counted:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.range(1).select(F.inline(F.array(*counted))))
    for table, tests in by_table.items():
        row_tests = [t for t in tests if t.test in ROW_TESTS]
        if row_tests:
            parts.append(_row_tests(tables[table], row_tests))
        parts += [_unique_test(tables[table], t) for t in tests if t.test == "unique"]
    if not parts:
        raise ValueError("the suite holds no tests")
    status = (
        F.when(F.col("failures") == 0, "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("fail")
    )
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def raise_on_failure(report: DataFrame) -> None:
    """Raise when a test of severity error failed. The report has one row per test, no more."""
    failed = report.where(F.col("status") == "fail").collect()
    if failed:
        raise ExpectationsFailed(
            "; ".join(f"{r.test_name}({r.table_name}.{r.column_name}): {r.failures}" for r in failed)
        )
