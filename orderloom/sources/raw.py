"""Raw layer: one Parquet folder per table, partitioned by the day of ingestion."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from orderloom.parallel import WORKERS, together
from orderloom.schemas import RAW
from orderloom.sources.csv_read import read_csv
from orderloom.sources.files import child_names, data_files, delete_folder, read_text, write_text

STAMP = "loaded_at"
DAY = "ingest_date"
SUFFIX = ".csv"
RUNS = "_runs"

# What a column's values must look like to give it a type other than string, first match first.
VALUE_PATTERNS = {
    "boolean": r"^(True|TRUE|true|False|FALSE|false)$",
    "long": r"^[+-]?(0|[1-9]\d{0,18})$",
    # Whole numbers only as far as a double keeps all their digits: longer ones may be ids.
    "double": r"^[+-]?((0|[1-9]\d{0,14})|((0|[1-9]\d*)\.\d*|\.\d+)([eE][+-]?\d+)?"
    r"|(0|[1-9]\d*)[eE][+-]?\d+)$",
}

# What Spark says when a check of the content has failed.
CONTENT_ERRORS = ("USER_RAISED_EXCEPTION", "MALFORMED_CSV_RECORD")


@dataclass(frozen=True)
class Landed:
    """Outcome for one table of an ingestion run; ``set_aside`` are files left out, and why."""

    table: str
    status: str
    attempts: int
    rows: int | None = None
    error: str | None = None
    set_aside: tuple[tuple[str, str], ...] = ()


class MissingTables(Exception):
    """Tables the silver layer needs were not landed."""


def csv_tables(spark: SparkSession, csv_dir: str) -> dict[str, str]:
    """Table name to path, for each entry of the folder whose name ends in ``.csv``."""
    return {
        name.replace(SUFFIX, ""): f"{csv_dir.rstrip('/')}/{name}"
        for name in child_names(spark, csv_dir)
        if name.endswith(SUFFIX)
    }


def ingest(
    spark: SparkSession,
    csv_dir: str,
    raw_path: str,
    run_ts: datetime | None = None,
    *,
    max_retries: int = 3,
    retry_delay: float = 2,
    required: Iterable[str] = (),
    infer: Iterable[str] = (),
    read: Callable[[SparkSession, str | Sequence[str]], DataFrame] = read_csv,
    workers: int = WORKERS,
    set_aside: bool = False,
) -> list[Landed]:
    """Land every CSV table of a folder as today's snapshot, some at once, and report on each.

    A table that fails ``max_retries`` times is skipped and the run goes on; at the end a skipped
    or absent table named in ``required`` raises. Columns stay strings, except in the tables named
    in ``infer``. With ``set_aside`` a table whose content cannot be read as a whole is landed from
    those of its files that can, with the columns that most of them have; the report names the others.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    infer = set(infer)

    def land(table: str, path: str | Sequence[str]) -> int:
        rows = read(spark, path)
        if table not in infer:
            return write_snapshot(rows, raw_path, table, run_ts)
        # The text is parsed once: what types its columns have is found while it is stored.
        landing = f"{raw_path.rstrip('/')}/_landing/{table}-{uuid.uuid4().hex}"
        try:
            return write_snapshot(stored_with_types(rows, landing), raw_path, table, run_ts)
        finally:
            delete_folder(spark, landing)

    def attempt(table: str, path: str) -> Callable[[], Landed]:
        def run() -> Landed:
            whole = _with_retries(table, lambda: land(table, path), max_retries, retry_delay)
            files = data_files(spark, path)
            if not set_aside or whole.status == "landed" or len(files) < 2:
                return whole
            good, bad = _sort_out(spark, files, read, workers)
            if not good or not bad:
                return whole
            part = _with_retries(table, lambda: land(table, good), max_retries, retry_delay)
            return replace(part, set_aside=tuple(sorted(bad.items())))

        return run

    tables = csv_tables(spark, csv_dir)
    report = list(together(spark, {t: attempt(t, path) for t, path in tables.items()}, workers).values())
    require(report, required)
    return report


def _sort_out(
    spark: SparkSession, files: list[str], read: Callable[[SparkSession, Sequence[str]], DataFrame], workers: int
) -> tuple[list[str], dict[str, str]]:
    """Files that can be read and agree on their columns, and the others with what is wrong."""

    def look(file: str) -> Callable[[], frozenset[str] | str]:
        def run():
            try:
                rows = read(spark, [file])
                rows.write.format("noop").mode("overwrite").save()
                return frozenset(rows.columns)
            except Exception as e:  # whatever it is, it concerns this file
                return _first_line(e)

        return run

    seen = together(spark, {file: look(file) for file in files}, workers)
    columns = Counter(found for found in seen.values() if not isinstance(found, str))
    if not columns:
        return [], {file: str(error) for file, error in seen.items()}
    # Of two equally frequent sets of columns, that of the first file.
    usual = columns.most_common(1)[0][0]
    good = [file for file, found in seen.items() if found == usual]
    bad = {
        file: found if isinstance(found, str) else "other columns than most files"
        for file, found in seen.items()
        if found != usual
    }
    return good, bad


def _first_line(error: Exception) -> str:
    return f"{type(error).__name__}: {error}".splitlines()[0]


def missing_tables(report: list[Landed], tables: Iterable[str]) -> list[str]:
    """Those of the tables that were not landed."""
    return sorted(set(tables) - {r.table for r in report if r.status == "landed"})


def require(report: list[Landed], tables: Iterable[str]) -> None:
    """Raise unless all of these tables were landed."""
    if missing := missing_tables(report, tables):
        errors = {r.table: r.error for r in report if r.error}
        raise MissingTables(", ".join(f"{t} ({errors.get(t, 'no such file')})" for t in missing))


def _with_retries(
    table: str, action: Callable[[], int], max_retries: int, retry_delay: float
) -> Landed:
    for attempt in range(1, max_retries + 1):
        try:
            return Landed(table, "landed", attempt, rows=action())
        except Exception as e:  # any failure of one table leaves the others unaffected
            error = _first_line(e)
            if isinstance(e, ValueError) or any(mark in str(e) for mark in CONTENT_ERRORS):
                break  # malformed content stays malformed
            if attempt < max_retries:
                time.sleep(retry_delay)
    return Landed(table, "skipped", attempt, error=error)


def _type_checks(rows: DataFrame) -> dict[tuple[str, str], Column]:
    """For each string column and type: whether all its values are of that type."""

    def holds_only(name: str, pattern: str) -> Column:
        column = F.col(_quoted(name))
        fits = column.rlike(pattern)
        if pattern == VALUE_PATTERNS["long"]:
            fits = fits & (column.isNull() | column.try_cast("long").isNotNull())
        return F.coalesce(F.bool_and(fits), F.lit(False))

    names = [f.name for f in rows.schema if isinstance(f.dataType, StringType)]
    return {(n, kind): holds_only(n, p) for n in names for kind, p in VALUE_PATTERNS.items()}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def stored_with_types(rows: DataFrame, path: str) -> DataFrame:
    """Store rows as they are, and read them with string columns that hold only truth values or
    numbers as boolean, long or double.

    The values of each split are checked as they are written; the checks' results combine to those of
    the table. Codes with leading zeros stay strings, and so do columns without any value and whole
    numbers that neither type would keep exactly.
    """
    seen, checks = Observation(), _type_checks(rows)
    named = {f"c{k}": key for k, key in enumerate(checks)}
    if named:
        rows = rows.observe(seen, *[checks[key].alias(name) for name, key in named.items()])
    rows.write.parquet(path)
    found = {key for name, key in named.items() if seen.get[name]}

    def as_found(name: str) -> Column:
        for kind in VALUE_PATTERNS:
            if (name, kind) in found:
                return F.col(_quoted(name)).cast(kind).alias(name)
        return F.col(_quoted(name))

    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return stored.select(*[as_found(name) for name in rows.columns])


def write_snapshot(rows: DataFrame, raw_path: str, table: str, run_ts: datetime) -> int:
    """Write one day's snapshot and return its number of rows.

    It replaces the same day and leaves the other days alone. The stored files of that day are
    replaced when the write commits.
    """
    folder = f"{raw_path.rstrip('/')}/{table}"
    day = run_ts.strftime("%Y-%m-%d")
    written = Observation()
    stamped = rows.withColumn(STAMP, F.lit(run_ts)).observe(
        written, F.count(F.lit(1)).alias("rows")
    )
    (
        stamped.withColumn(DAY, F.lit(day).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(folder)
    )
    if written.get["rows"] == 0:
        # Without rows the write above touches no day, so the empty day is written by its name.
        stamped.limit(0).write.mode("overwrite").parquet(f"{folder}/{DAY}={day}")
    return written.get["rows"]


def snapshots(spark: SparkSession, raw_path: str, table: str) -> dict[str, str]:
    """Day to path of a table's snapshots, oldest first.

    Besides the day folders written here, a day may be one file named ``<table>_<day>.parquet``.
    """
    folder = f"{raw_path.rstrip('/')}/{table}"
    day = r"\d{4}-\d{2}-\d{2}"
    name = re.compile(rf"(?:{DAY}=({day})|{re.escape(table)}_({day})\.parquet)")
    found = {}
    for child in child_names(spark, folder):
        if match := name.fullmatch(child):
            found[match[1] or match[2]] = f"{folder}/{child}"
    return dict(sorted(found.items()))


def record_run(
    spark: SparkSession, raw_path: str, run_ts: datetime, landed: Iterable[Landed], tables: Iterable[str]
) -> str:
    """Note which day of each table belongs to a run, and return the run's name.

    A landed table has the run's day. Another keeps the day that the run before names, or without
    one its newest day until then, so a table that was skipped is not read at a later day.
    """
    day, name = run_ts.strftime("%Y-%m-%d"), run_ts.strftime("%Y-%m-%dT%H%M%S.%f")
    before = [r for r in runs(spark, raw_path) if r < name]
    days = run_days(spark, raw_path, before[-1]) if before else {}
    for table in tables:
        if table not in days:
            known = [d for d in snapshots(spark, raw_path, table) if d <= day]
            days |= {table: known[-1]} if known else {}
    days |= {r.table: day for r in landed if r.status == "landed"}
    write_text(spark, f"{raw_path.rstrip('/')}/{RUNS}/{name}.json", json.dumps(days))
    return name


def runs(spark: SparkSession, raw_path: str) -> list[str]:
    """Names of the recorded runs, oldest first."""
    names = child_names(spark, f"{raw_path.rstrip('/')}/{RUNS}")
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json"))


def run_days(spark: SparkSession, raw_path: str, run: str) -> dict[str, str]:
    """The day of each table in a run."""
    return json.loads(read_text(spark, f"{raw_path.rstrip('/')}/{RUNS}/{run}.json"))


def read_snapshot(
    spark: SparkSession, raw_path: str, table: str, snapshot: str = "latest"
) -> DataFrame:
    """A raw table without its ingestion columns.

    ``latest`` reads only the newest day of this table. ``all`` is the union of all days, which
    repeats every row that several days contain. A day ``YYYY-MM-DD`` reads that one.
    """
    days = snapshots(spark, raw_path, table)
    if not days:
        raise FileNotFoundError(f"no snapshot of {table} below {raw_path}")
    if snapshot == "all":
        paths = list(days.values())
    else:
        day = max(days) if snapshot == "latest" else snapshot
        if day not in days:
            raise FileNotFoundError(f"no snapshot {day} of {table}; there are {', '.join(days)}")
        paths = [days[day]]
    return spark.read.option("mergeSchema", "false").parquet(*paths).drop(STAMP, DAY)


def read_raw(
    spark: SparkSession,
    raw_path: str,
    snapshot: str = "latest",
    names: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The eight tables of the silver layer. ``names`` maps a table to its folder name.

    ``run:`` and a run's name reads each table at the day that this run names.
    """
    names = names or {}
    run = snapshot.removeprefix("run:") if snapshot.startswith("run:") else None
    days = run_days(spark, raw_path, run) if run else {}
    return {
        t: read_snapshot(spark, raw_path, names.get(t, t), days.get(names.get(t, t), "latest") if run else snapshot)
        for t in RAW
    }
