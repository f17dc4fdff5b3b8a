"""Text expressions for CSV input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Field texts that CSV ingestion reads as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def missing_to_null(df: DataFrame) -> DataFrame:
    """Replace missing-value tokens in every string column by NULL."""
    columns = {f.name: F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema}
    return df.select(
        *[
            F.when(~columns[f.name].isin(MISSING_TOKENS), columns[f.name]).alias(f.name)
            if isinstance(f.dataType, StringType)
            else columns[f.name]
            for f in df.schema
        ]
    )


def outside_quotes(line: Column) -> Column:
    """A line of CSV without its complete quoted fields.

    A quote opens a field only at the field's start and ``""`` inside one is a literal quote.
    """
    return F.regexp_replace(line, r'"(?<=(?:^|,)")[^"]*+(?:""[^"]*+)*+"', "")


def ends_inside_quotes(line: Column) -> Column:
    """Whether a quoted field is still open at the end of a line that starts outside quotes.

    A quote left at a field's start when all complete fields are cut out belongs to an open one.
    """
    rest = outside_quotes(line)
    is_open = F.startswith(rest, F.lit('"')) | F.contains(rest, F.lit(',"'))
    return F.contains(line, F.lit('"')) & is_open


def holds_carriage_return(line: Column) -> Column:
    """Whether a line holds a carriage return that does not belong to its line end."""
    return F.contains(line, F.lit("\r")) & line.rlike(r"\r[\s\S]")


def without_line_end(line: Column) -> Column:
    """A line without the carriage return that precedes its line feed."""
    return F.when(F.endswith(line, F.lit("\r")), F.left(line, F.length(line) - 1)).otherwise(line)
