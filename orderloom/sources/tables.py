"""Parquet folders and catalog tables that results are written to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Mapping
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from orderloom.schemas import SILVER, in_table_order, silver_ddl
from orderloom.sources.files import data_files, delete_folder, qualified
from orderloom.sources.versions import Version, VersionLog

T = TypeVar("T", bound=Hashable)

BUCKET_KEY = "order_id"
SETTLE_ATTEMPTS = 20
# What Spark says when an entry of the catalog has changed under it.
CATALOG_RACES = ("TABLE_OR_VIEW_NOT_FOUND", "TABLE_OR_VIEW_ALREADY_EXISTS", "NoSuchTable", "TableAlreadyExists")


def write_parquet(
    df: DataFrame, path: str, output_files: int | None = None, rebalance: bool = False
) -> None:
    """Replace a Parquet folder.

    Without ``output_files`` AQE decides how many tasks write. With it rows are redistributed, which
    unlike ``coalesce`` leaves the parallelism of the stages before the write alone. With
    ``rebalance`` AQE splits large partitions and merges small ones, so that every file comes from
    about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` of rows, however skewed they were.
    """
    if output_files:
        df = df.repartition(output_files)
    elif rebalance:
        df = df.hint("rebalance")
    df.write.mode("overwrite").parquet(path)


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write a table whose files are bucketed and sorted by order, as the silver tables can be.

    Rows that a join by order has dealt to as many partitions are not shuffled again.
    """
    rows = df.repartition(buckets, BUCKET_KEY).write.mode("overwrite").option("path", path)
    rows.format("parquet").bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY).saveAsTable(table)
    return df.sparkSession.table(table)


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}{place}")


def create_silver_tables(
    spark: SparkSession, schema: str = "silver", if_not_exists: bool = False,
    buckets: int | None = None,
) -> None:
    """The three silver tables. Text longer than a column's width is an error when it is loaded.

    With ``buckets`` their files are bucketed and sorted by order: what joins and groups them by order
    needs no shuffle. A bucket is one file and one task, so there should be one per few hundred MB.
    """
    guard = "IF NOT EXISTS " if if_not_exists else ""
    layout = f" CLUSTERED BY ({BUCKET_KEY}) SORTED BY ({BUCKET_KEY}) INTO {buckets} BUCKETS" if buckets else ""
    for table in SILVER:
        spark.sql(f"CREATE TABLE {guard}{schema}.{table} ({silver_ddl(table)}) USING parquet{layout}")


def _buckets(spark: SparkSession, target: str) -> int | None:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").where("col_name = 'Num Buckets'").first()
    return int(described["data_type"]) if described else None


def truncate(spark: SparkSession, schema: str, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {schema}.{table}")


def load(
    spark: SparkSession, path: str, schema: str, table: str, append: bool = False,
    load_id: str | None = None,
) -> None:
    """Load a silver Parquet folder into its table."""
    load_rows(spark.read.parquet(path), schema, table, append, load_id)


def load_rows(
    rows: DataFrame, schema: str, table: str, append: bool = False, load_id: str | None = None,
    root: str | None = None, counts: Mapping[T, Column] | None = None,
) -> dict[T, int]:
    """Load rows into a silver table.

    Columns are matched by name. The default replaces the table's content: the new rows are written
    to a folder of their own, which becomes the table's next version when all are there. That moves
    no data, and a load that fails or dies changes nothing. The version before stays, so that readers
    that began before the switch can finish. Loads may run at once: the one that ends last wins, and
    none takes another's files. Rows that are read from the table's own folder may be loaded into it.

    With ``append`` the rows are added to the current version, all of them or none. An append with a
    ``load_id`` that was loaded before adds nothing. A replacement that ends while an append is under
    way replaces the appended rows too.

    New files lie below ``root``, by default in the schema's folder. The aggregates in ``counts`` are
    worked out on the way, and their values returned.
    """
    spark, target = rows.sparkSession, f"{schema}.{table}"
    rows = in_table_order(rows, table)
    if buckets := _buckets(spark, target):
        # One file per bucket, not one per task and bucket.
        rows = rows.repartition(buckets, BUCKET_KEY)
    rows, counted = _counting(rows, counts)
    settle(spark, schema, table)
    log = _log(spark, schema, table)
    current = table_location(spark, target)
    folder = f"{qualified(spark, root) if root else log.parent}/{table}-{uuid.uuid4().hex}"
    loading = f"{schema}.{table}_loading_{uuid.uuid4().hex}"
    lease = log.lease(folder)
    # The table's folder is leased too while files are added to it.
    held = log.lease(current, own=False) if append else None
    try:
        spark.sql(f"CREATE TABLE {loading} LIKE {target} USING parquet LOCATION '{folder}'")
        rows.write.insertInto(loading)
    except Exception:
        log.abort(lease, folder)
        if held:
            log.release(held)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {loading}")
    if not held:
        _switch(spark, schema, table, log, lease, folder, current, _ddl(spark.table(target)))
        return counted()
    names = [file.rsplit("/", 1)[1] for file in data_files(spark, folder)]
    if not log.record_append(load_id or uuid.uuid4().hex, folder, current, names):
        delete_folder(spark, folder)
    log.finish_appends()
    log.release(held)
    log.release(lease)
    spark.catalog.refreshTable(target)
    return counted()


def _counting(
    rows: DataFrame, counts: Mapping[T, Column] | None
) -> tuple[DataFrame, Callable[[], dict[T, int]]]:
    """Rows that count on their way to a write, and what gives the counts when it is done."""
    if not counts:
        return rows, dict
    seen = Observation()
    named = {f"c{k}": key for k, key in enumerate(counts)}
    rows = rows.observe(seen, *[counts[key].alias(name) for name, key in named.items()])
    return rows, lambda: {key: seen.get[name] for name, key in named.items()}


def save_table(
    df: DataFrame, schema: str, table: str, counts: Mapping[T, Column] | None = None
) -> dict[T, int]:
    """Rebuild a table in full, whatever its columns were; it comes into being at the first build.

    Rows go to a folder of their own that becomes the table's next version: a build that fails or
    dies leaves the table as it was, and builds may run at once, as in ``load_rows``. The files are
    never the catalog's to delete. ``counts`` as in ``load_rows``.
    """
    spark, columns = df.sparkSession, _ddl(df)
    df, counted = _counting(df, counts)
    settle(spark, schema, table)
    log = _log(spark, schema, table)
    target = f"{schema}.{table}"
    current = table_location(spark, target) if spark.catalog.tableExists(target) else None
    folder = f"{log.parent}/{table}-{uuid.uuid4().hex}"
    lease = log.lease(folder)
    try:
        df.write.parquet(folder)
    except Exception:
        log.abort(lease, folder)
        raise
    _switch(spark, schema, table, log, lease, folder, current, columns)
    return counted()


def _switch(
    spark: SparkSession, schema: str, table: str, log: VersionLog, lease: str, folder: str,
    current: str | None, columns: str,
) -> None:
    if current and log.latest() is None:
        log.publish(current, columns)
    log.commit(lease, folder, columns)
    try:
        settle(spark, schema, table)
        log.clean()
    except Exception as error:
        # The version stands; the next load, build or call of settle brings the table forward.
        raise TableBehind(f"{schema}.{table} does not show its newest version yet") from error


class TableBehind(Exception):
    """A version was committed, but the catalog could not be pointed to it."""


def settle(spark: SparkSession, schema: str, table: str) -> None:
    """Make the catalog show the table's newest version, and finish appends of loads that died.

    Checked again after every change: of several loads that end together, the last to look sees the
    newest version. A table without versions is left alone.
    """
    log, target = _log(spark, schema, table), f"{schema}.{table}"
    log.finish_appends()
    for _ in range(SETTLE_ATTEMPTS):
        version = log.latest()
        if version is None or _shows(spark, target, version):
            return
        try:
            _show(spark, schema, table, log, version)
        except Exception as error:
            # Another load may be changing the entry at this moment.
            if not any(mark in str(error) for mark in CATALOG_RACES):
                raise
    if not _shows(spark, target, log.latest()):
        raise RuntimeError(f"{target} could not be pointed to its newest version")


def _shows(spark: SparkSession, target: str, version: Version) -> bool:
    if not spark.catalog.tableExists(target):
        return False
    location = qualified(spark, table_location(spark, target))
    return (location, _ddl(spark.table(target))) == (qualified(spark, version.folder), version.columns)


def _show(spark: SparkSession, schema: str, table: str, log: VersionLog, version: Version) -> None:
    target = f"{schema}.{table}"
    exists = spark.catalog.tableExists(target)
    if exists and _ddl(spark.table(target)) == version.columns:
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{version.folder}'")
        return
    # Other columns: an entry of its own is made first, so that only names change hands at the end.
    staged = f"{schema}.{table}_next_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {staged} ({version.columns}) USING parquet LOCATION '{version.folder}'")
    try:
        if exists:
            # Dropping a managed table would delete its files, which readers may have open.
            spark.sql(f"ALTER TABLE {target} SET LOCATION '{log.root}/none'")
            spark.sql(f"DROP TABLE {target}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise


def _log(spark: SparkSession, schema: str, table: str) -> VersionLog:
    """Versions and their folders lie in the schema's folder."""
    return VersionLog(spark, _home(spark, schema), table)


def _home(spark: SparkSession, schema: str) -> str:
    described = spark.sql(f"DESCRIBE DATABASE {schema}")
    return qualified(spark, described.where("info_name = 'Location'").first()["info_value"])


def _ddl(df: DataFrame) -> str:
    names = [f.name.replace("`", "``") for f in df.schema]
    kinds = [f.dataType.simpleString() for f in df.schema]
    return ", ".join(f"`{name}` {kind}" for name, kind in zip(names, kinds, strict=True))


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.where("col_name = 'Location'").first()["data_type"]
