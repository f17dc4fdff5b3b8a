"""The daily run: ingest, silver, load, staging and marts, tests."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from orderloom.operators.expectations import Expectation, raise_on_failure, row_test_counts, run_suite
from orderloom.parallel import together
from orderloom.plans.marts import build_marts
from orderloom.plans.silver import build_silver
from orderloom.plans.staging import STAGING_SOURCE, build_staging, view_sql
from orderloom.plans.suite import ORDER_STATUSES, pipeline_suite
from orderloom.schemas import RAW, SILVER
from orderloom.session import configure
from orderloom.sources.raw import Landed, csv_tables, ingest, read_raw, record_run, require
from orderloom.sources.tables import (
    create_schema,
    create_silver_tables,
    load,
    load_rows,
    save_table,
    write_parquet,
)

MARTS = ("fct_orders", "dim_customers", "dim_products")


@dataclass(frozen=True)
class Layout:
    """Where a run reads and writes.

    ``names`` maps a table to the name of its CSV file. ``silver_path`` is where the files of the
    silver tables lie, by default the schema's folder. With ``buckets`` these tables are bucketed and
    sorted by order, so that the order fact joins and groups them without a shuffle.
    """

    raw_path: str
    silver_path: str | None = None
    silver_schema: str = "silver"
    staging_schema: str = "staging"
    marts_schema: str = "marts"
    schema_root: str | None = None
    names: Mapping[str, str] = field(default_factory=dict)
    buckets: int | None = None

    def raw_name(self, table: str) -> str:
        return self.names.get(table, table)


@dataclass(frozen=True)
class Run:
    """What a run did; ``report`` is None when there was nothing to ingest."""

    landed: list[Landed]
    report: DataFrame | None


def transform(
    spark: SparkSession, layout: Layout, snapshot: str = "latest", output_files: int | None = None
) -> None:
    """Raw snapshots to silver Parquet folders below ``silver_path``, for ``load_silver``."""
    raw = read_raw(spark, layout.raw_path, snapshot, layout.names)
    for table, df in build_silver(raw).items():
        write_parquet(df, f"{layout.silver_path}/{table}", output_files)


def load_silver(spark: SparkSession, layout: Layout) -> None:
    """Silver Parquet folders to the silver tables, replacing their content."""
    _create_silver(spark, layout)
    for table in SILVER:
        load(spark, f"{layout.silver_path}/{table}", layout.silver_schema, table)


def build_silver_tables(
    spark: SparkSession, layout: Layout, snapshot: str = "latest", output_files: int | None = None,
    suite: Sequence[Expectation] = (),
) -> dict[Expectation, int]:
    """Both in one: raw snapshots straight to the silver tables, whose files are written once.

    Row tests of the suite are counted on the way, also those of the staging views, which show the
    same columns. Returned are the failures of each.
    """
    raw = read_raw(spark, layout.raw_path, snapshot, layout.names)
    _create_silver(spark, layout)
    silver = build_silver(raw)

    def write(table: str) -> Callable[[], dict[Expectation, int]]:
        rows = silver[table].repartition(output_files) if output_files else silver[table]
        counts = row_test_counts(suite, table)
        for model, source in STAGING_SOURCE.items():
            if source == table:
                counts |= row_test_counts(suite, model)
        return lambda: load_rows(rows, layout.silver_schema, table, root=layout.silver_path, counts=counts)

    return _merged(together(spark, {table: write(table) for table in silver}))


def _merged(counted: Mapping[str, dict[Expectation, int]]) -> dict[Expectation, int]:
    return {test: n for counts in counted.values() for test, n in counts.items()}


def _create_silver(spark: SparkSession, layout: Layout) -> None:
    _schema(spark, layout, layout.silver_schema)
    create_silver_tables(spark, layout.silver_schema, if_not_exists=True, buckets=layout.buckets)


def build_models(
    spark: SparkSession, layout: Layout, money_scale: int | None = None,
    suite: Sequence[Expectation] = (),
) -> dict[Expectation, int]:
    """Staging views over the silver tables, then the mart tables, all at once.

    Row tests of the suite on the marts are counted as they are written; returned are the failures.
    """
    _schema(spark, layout, layout.staging_schema)
    _schema(spark, layout, layout.marts_schema)
    for model, source in STAGING_SOURCE.items():
        view = f"{layout.staging_schema}.{model}"
        spark.sql(view_sql(model, view, f"{layout.silver_schema}.{source}"))
    # The views' own columns, without the casts from VARCHAR of a view, which hide the tables' buckets.
    staging = build_staging({t: spark.table(f"{layout.silver_schema}.{t}") for t in SILVER})

    def write(mart: str, df: DataFrame) -> Callable[[], dict[Expectation, int]]:
        return lambda: save_table(df, layout.marts_schema, mart, row_test_counts(suite, mart))

    marts = build_marts(staging, money_scale)
    return _merged(together(spark, {mart: write(mart, df) for mart, df in marts.items()}))


def quality_report(
    spark: SparkSession, layout: Layout, order_statuses: tuple[str, ...] = ORDER_STATUSES,
    known: Mapping[Expectation, int] | None = None,
) -> DataFrame:
    """The suite over the tables as they were built; what their writes have counted is ``known``."""
    tables = {
        **{t: spark.table(f"{layout.silver_schema}.{t}") for t in SILVER},
        **{m: spark.table(f"{layout.staging_schema}.{m}") for m in STAGING_SOURCE},
        **{m: spark.table(f"{layout.marts_schema}.{m}") for m in MARTS},
    }
    return run_suite(tables, pipeline_suite(order_statuses), known)


def run(
    spark: SparkSession,
    csv_dir: str,
    layout: Layout,
    run_ts: datetime | None = None,
    *,
    snapshot: str = "latest",
    output_files: int | None = None,
    money_scale: int | None = None,
    order_statuses: tuple[str, ...] = ORDER_STATUSES,
    allow_missing: bool = False,
    set_aside: bool = False,
    raise_on_error: bool = True,
) -> Run:
    """All stages in order.

    A folder without CSV files ends the run before anything is written. A table that cannot be read
    fails the run unless ``allow_missing``; then its snapshot of the run before is used. Tables the silver layer
    does not read are landed too, with inferred types. Failed tests raise after the marts are built,
    which stay as they are. With ``set_aside`` files that cannot be read do not cost their table.
    """
    configure(spark)
    run_ts = run_ts or datetime.now(timezone.utc)
    needed = [layout.raw_name(t) for t in RAW]
    others = set(csv_tables(spark, csv_dir)) - set(needed)
    landed = ingest(spark, csv_dir, layout.raw_path, run_ts, infer=others, set_aside=set_aside)
    if not any(r.status == "landed" for r in landed):
        return Run(landed, None)
    if not allow_missing:
        require(landed, needed)
    if snapshot == "latest":
        # What lands from now on, from another run, is not mixed in.
        snapshot = f"run:{record_run(spark, layout.raw_path, run_ts, landed, needed)}"
    suite = pipeline_suite(order_statuses)
    known = build_silver_tables(spark, layout, snapshot, output_files, suite)
    known |= build_models(spark, layout, money_scale, suite)
    report = quality_report(spark, layout, order_statuses, known)
    # One row per test: keep the outcome rather than run the tests again for each look at it.
    report = spark.createDataFrame(report.collect(), report.schema)
    if raise_on_error:
        raise_on_failure(report)
    return Run(landed, report)


def _schema(spark: SparkSession, layout: Layout, schema: str) -> None:
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    on_cluster = not spark.sparkContext.master.startswith("local")
    if on_cluster and not layout.schema_root and warehouse.startswith("file:"):
        raise ValueError("set schema_root: the warehouse is a folder of the driver's machine")
    create_schema(
        spark, schema, f"{layout.schema_root}/{schema}" if layout.schema_root else None
    )
