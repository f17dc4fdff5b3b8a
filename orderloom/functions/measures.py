"""Measures computed per row and per group."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def item_value(price: str = "price", freight: str = "freight_value") -> Column:
    """Price plus freight; NULL when either is NULL."""
    return F.col(price) + F.col(freight)


def days_from(start: str, end: str) -> Column:
    """Whole calendar days from start to end, negative when end comes first."""
    return F.datediff(F.col(end), F.col(start))


# Exact sums add whole units of 10^-scale in two limbs of 64 bits, which Spark's hash aggregate keeps as
# plain numbers: BITS of an amount, and all above.
BITS = 26
# Below PLAIN units, ``value * 10^scale`` is off by less than TIE of a unit.
PLAIN, TIE = 2.0**40, 2.0**-10
# Digits of the largest amount. With more decimals than this a sum could not be told exactly.
DIGITS, MOST_DECIMALS = 26, 6


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def split_amounts(df: DataFrame, names: Sequence[str], scale: int | None = None) -> DataFrame:
    """Add the limbs of these double columns, which ``money_sum`` adds up.

    An amount of ordinary size that is not about half way between two units is rounded as a double;
    the others take the way over a decimal, halves away from zero. Without ``scale`` nothing is added.
    """
    if scale is None:
        return df
    if not 0 <= scale <= MOST_DECIMALS:
        raise ValueError(f"exact sums have 0 to {MOST_DECIMALS} decimals")
    return df.select("*", *[F.expr(limb) for name in names for limb in _limbs(name, scale)])


def _limbs(name: str, scale: int) -> tuple[str, str]:
    """As SQL text, which is quicker to build than columns are."""
    value = _quoted(name)
    scaled = f"({value} * {10**scale}D)"
    is_plain = f"abs({scaled}) < {PLAIN}D AND abs({scaled} - floor({scaled}) - 0.5D) > {TIE}D"
    # Null and NaN, which Spark orders after infinity, have no limbs.
    is_number = f"abs({value}) < double('infinity')"
    amount = (
        f"CASE WHEN abs({value}) < 1E{DIGITS - scale}D THEN CAST({value} AS DECIMAL({DIGITS},{scale})) "
        f"ELSE CAST(raise_error(concat('amount out of range: ', {value})) AS DECIMAL({DIGITS},{scale})) END"
    )
    exact = f"CAST({amount} * {10**scale}BD AS DECIMAL(38,0))"
    plain = f"CAST(rint({scaled}) AS BIGINT)"

    def limb(of_plain: str, of_exact: str, end: str) -> str:
        case = f"CASE WHEN {is_plain} THEN {of_plain} WHEN {is_number} THEN {of_exact} END"
        return f"{case} AS {_quoted(f'_{name}_{end}')}"

    return (
        limb(f"{plain} & {2**BITS - 1}L", f"CAST({exact} % {2**BITS}BD AS BIGINT)", "low"),
        limb(f"shiftright({plain}, {BITS})", f"{exact} div {2**BITS}BD", "high"),
    )


def money_sum(name: str, scale: int | None = None) -> Column:
    """Sum of a double column.

    With ``scale`` (0 to 6, the same as for ``split_amounts``) the values are rounded to that many
    decimals and added exactly, so the result does not depend on the order in which rows arrive from a
    shuffle. A value of more than 26 digits or a sum beyond the limbs is an error, with ANSI mode on or
    off. NaN and infinity make the sum what they make of a sum of doubles.
    """
    if scale is None:
        return F.sum(name)
    value = _quoted(name)
    low, high = f"sum({_quoted(f'_{name}_low')})", f"try_sum({_quoted(f'_{name}_high')})"
    units = f"CAST({high} AS DECIMAL(20,0)) * {2**BITS}BD + CAST({low} AS DECIMAL(20,0))"
    total = f"CAST(CAST({units} AS DECIMAL(38,0)) * {Decimal(1).scaleb(-scale):f}BD AS DOUBLE)"
    lost = "CAST(raise_error('sum of amounts out of range') AS DOUBLE)"
    small = f"abs({high}) < {2**BITS} AND abs({low}) < {2 ** (2 * BITS)}"
    # A sum of few units is exact as a double, and one division rounds it as the decimal would be.
    return F.expr(
        f"CASE WHEN sum(CASE WHEN abs({value}) >= double('infinity') THEN {value} END) IS NOT NULL "
        f"THEN sum(CASE WHEN abs({value}) >= double('infinity') THEN {value} END) "
        f"WHEN {small} THEN CAST({high} * {2**BITS}L + {low} AS DOUBLE) / {10**scale}D "
        f"WHEN {low} IS NOT NULL THEN coalesce({total}, {lost}) END"
    )


def partial_money_sum(name: str, scale: int | None = None) -> list[Column]:
    """Aggregates that ``money_sum`` of the same name adds up at the next level of grouping."""
    if scale is None:
        return [F.sum(name).alias(name)]
    value, limbs = _quoted(name), [_quoted(f"_{name}_{end}") for end in ("low", "high")]
    odd = f"sum(CASE WHEN abs({value}) >= double('infinity') THEN {value} END) AS {value}"
    return [F.expr(odd), *[F.expr(f"sum({limb}) AS {limb}") for limb in limbs]]
