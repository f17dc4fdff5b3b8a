"""Casts that turn text they cannot read into NULL, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, IntegerType, StringType, StructType

# A suffix such as the d of '12d', which Java reads as a double, does not count.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DECIMALS = r"(?<=\d)\.\d*\s*$"


def lenient_cast(name: str, have: DataType, want: DataType) -> str:
    """The cast as SQL text, which is quicker to build than columns are."""
    if have == want or isinstance(want, StringType):
        return name
    kind = want.simpleString()
    cast = f"try_cast({name} AS {kind})"
    if isinstance(have, StringType) and isinstance(want, IntegerType):
        # Text such as '12.0' counts as the integer 12. What only a double reads ('1e3', '.5') is
        # cut as one.
        exact = f"try_cast(regexp_replace({name}, r'{DECIMALS}', '') AS {kind})"
        cut = f"CASE WHEN {name} RLIKE r'{NUMBER}' THEN try_cast(try_cast({name} AS DOUBLE) AS {kind}) END"
        cast = f"coalesce({exact}, {cut})"
    return f"{cast} AS {name}"


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, cast to its types; string columns keep their type."""
    have = {f.name: f.dataType for f in df.schema}
    return df.selectExpr(*[lenient_cast(f.name, have[f.name], f.dataType) for f in schema])
