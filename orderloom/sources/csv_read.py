"""CSV files as DataFrames of strings, split between tasks also where fields hold line breaks.

Spark's own reader splits a CSV file only when no field contains a line break. With ``multiLine`` it
gives a whole file to one task, which does not work for one huge file per table. Such files are read
as lines here, and lines are joined to records in the task that reads them (``records``). Files
without such fields go through Spark's reader. Both parse by the same rules.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.sources.csv_lines import join_lines, settle_splits, sum_up_splits
from orderloom.sources.files import data_files, first_line, from_uri, qualified
from orderloom.functions.text import (
    ends_inside_quotes,
    holds_carriage_return,
    missing_to_null,
    outside_quotes,
    without_line_end,
)

QUOTING = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_malformed"}
RECORD_OPTIONS = {**QUOTING, "multiLine": "true"}


def read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All columns as strings, named by the header; missing-value tokens become NULL.

    The input is a file, a folder or a list of files. A folder may hold files whose headers list the same columns in another order: each file is read
    by its own header. Other columns are an error. A name that repeats gets a number (``a``,
    ``a.1``). A row with fewer fields than the header is filled with NULL; one with more is an
    error, whichever columns are asked for.
    """
    paths = [path] if isinstance(path, str) else list(path)
    files = [file for p in paths for file in data_files(spark, p)]
    by_header: dict[str, list[str]] = {}
    if len(files) > 1:
        for file in files:
            by_header.setdefault(first_line(spark, file), []).append(file)
    if len(by_header) <= 1:
        return _read_alike(spark, paths)
    parts = [_read_alike(spark, group) for group in by_header.values()]
    for part, group in zip(parts, by_header.values(), strict=True):
        if set(part.columns) != set(parts[0].columns):
            raise ValueError(f"{group[0]} has other columns than {files[0]}")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _read_alike(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files with the same header."""

    def lines_of(files: list[str]) -> DataFrame:
        return spark.read.option("lineSep", "\n").text(files)

    lines = lines_of(paths)
    names = _header_names(lines)
    schema = _string_columns([*names, "_malformed"])
    line = F.col("value")
    # One row per file, of those with a field over several lines or a bare carriage return.
    found = lines.where(ends_inside_quotes(line) | holds_carriage_return(line))
    broken = {
        from_uri(spark, row[0]) for row in found.select("_metadata.file_path").distinct().collect()
    }
    whole = [] if not broken else [f for path in paths for f in data_files(spark, path)]
    whole = paths if not broken else [f for f in whole if qualified(spark, f) not in broken]
    parts = []
    if whole:
        parts.append(spark.read.csv(whole, schema=schema, header=True, enforceSchema=True, **QUOTING))
    if broken:
        parsed = F.from_csv(F.col("record"), schema, RECORD_OPTIONS)
        parts.append(records(lines_of(sorted(broken))).select(parsed.alias("row")).select("row.*"))
    rows = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    # The condition names every column, so that none is pruned: then Spark would not see a long row.
    # It holds for all rows, or is an error.
    seen = F.xxhash64(*[F.col(_quoted(n)) for n in names]) == 0
    rows = rows.where(F.col("_malformed").isNull() | _is_short(names) | seen).drop("_malformed")
    return missing_to_null(rows)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _string_columns(names: list[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` STRING" for name in names)


def _header_names(lines: DataFrame) -> list[str]:
    first = lines.first()
    if first is None or not first.value.strip():
        raise ValueError("the CSV input does not begin with a header line")
    if first.value.count('"') % 2:
        raise ValueError("column names with line breaks are not supported")
    names = next(csv.reader([first.value.rstrip("\r")]))
    taken: dict[str, int] = {}
    out = []
    for name in names:
        number = taken.get(name.lower(), 0)
        out.append(f"{name}.{number}" if number else name)
        taken[name.lower()] = number + 1
    return out


def _is_short(names: list[str]) -> Column:
    """True for rows with too few fields, an error for rows with too many.

    Spark calls both malformed. Parsed with one more column, only long rows fill that column.
    """
    widened = F.from_csv(
        F.col("_malformed"), _string_columns([*names, "_surplus"]), RECORD_OPTIONS
    )
    message = F.concat(F.lit("row has more fields than the header: "), F.col("_malformed"))
    return F.assert_true(widened["_surplus"].isNull(), message).isNull()


def records(lines: DataFrame) -> DataFrame:
    """CSV records, as column ``record``, of the lines that Spark's ``text`` source reads.

    Each line knows whether it ends inside quotes if it begins outside (``opens``) or inside
    (``stays``). A split does not know how its own first line begins, so a first pass sums it up under
    both assumptions; these few numbers per split settle, file by file, which of them holds. Each line
    that begins outside quotes begins a record. A second pass joins the lines of a record where they
    are read. Only the pieces of records that a split cuts are sent anywhere. The first record of a
    file is its header.

    A file that ends inside quotes is an error, and so is a carriage return alone outside quotes,
    which could be meant as a line end.
    """
    has_quote = F.contains("value", F.lit('"'))
    lines = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        ends_inside_quotes(F.col("value")).alias("opens"),
        F.when(has_quote, ends_inside_quotes(F.concat(F.lit('"'), F.col("value"))))
        .otherwise(True)
        .alias("stays"),
        F.col("value").alias("line"),
    )
    summary = lines.drop("line").mapInArrow(
        sum_up_splits,
        "path string, split long, opens boolean, stays boolean, begins boolean, begins_inside boolean",
    )
    begun_in = settle_splits(summary.toArrow().to_pylist())
    spark = lines.sparkSession
    found = lines.mapInArrow(
        join_lines(spark.sparkContext.broadcast(begun_in)),
        "path string, begun_in long, split long, record string",
    )
    # The pieces of a cut record are as many as the splits it lies in.
    pieces = F.sort_array(F.collect_list(F.struct("split", "record")))
    cut = (
        found.where("path IS NOT NULL")
        .groupBy("path", "begun_in")
        .agg(F.array_join(F.transform(pieces, lambda piece: piece["record"]), "\n").alias("record"))
        .select("record")
    )
    return (
        found.where("path IS NULL")
        .select("record")
        .union(cut)
        .select(without_line_end(F.col("record")).alias("record"))
        .where(F.btrim("record", F.lit(" \t")) != "")
        .select(
            F.when(
                holds_carriage_return(F.col("record"))
                & holds_carriage_return(outside_quotes(F.col("record"))),
                F.raise_error(F.lit("carriage return without line feed outside quotes")),
            )
            .otherwise(F.col("record"))
            .alias("record")
        )
    )
