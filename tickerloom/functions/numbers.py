"""Numeric conversions, each independent of the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.text import WHITESPACE

# Whole numbers up to here are exact as doubles, so one IEEE division rounds correctly.
EXACT_DOUBLE = 2**53
INFINITE = "an infinite number has no place in a histogram"


def whole_number(text: Column, decoded: Column | None = None) -> Column:
    """Digits as bigint: blank is 0, anything else that is no integer is null.

    ``decoded`` is the same text with its blanks readable, where ``text`` holds
    raw bytes; only what is no plain number is looked at there.
    """
    bare = F.btrim(text if decoded is None else decoded, F.lit(WHITESPACE))
    # An empty text becomes 0 without naming it twice: a scan repeats this for every field.
    return F.coalesce(text.try_cast("bigint"), F.regexp_replace(bare, "^$", "0").try_cast("bigint"))


def cents_to_units(cents: Column, digits: int = 18) -> Column:
    """Integer cents of at most so many digits as a double amount, rounded once."""
    if digits <= 15:
        return cents.cast("double") / F.lit(100.0)
    exact = (cents.cast("decimal(18,0)") / F.lit(100)).cast("double")
    return F.when(F.abs(cents) <= EXACT_DOUBLE, cents.cast("double") / F.lit(100.0)).otherwise(
        exact
    )


def number_or_null(value: Column) -> Column:
    """Value as double; unparsable text and NaN become null."""
    number = value.try_cast("double")
    return F.when(F.isnan(number), F.lit(None).cast("double")).otherwise(number)


def number_or_error(value: Column) -> Column:
    """Value as double; text that is no number fails the job."""
    number = value.try_cast("double")
    problem = F.concat(F.lit("not a number: "), value.cast("string"))
    return F.when(value.isNull() | number.isNotNull(), number).otherwise(
        F.raise_error(problem).cast("double")
    )


def rounded_shares(value: Column, dtype: T.DataType) -> Column:
    """Share counts as bigint, halves to even; integral input is kept exact."""
    if isinstance(dtype, T.IntegralType):
        return value.cast("bigint")
    return F.bround(number_or_null(value), 0).cast("bigint")


def magnitude_label(value: Column) -> Column:
    """Order of magnitude of a number as ``1e<k>``, or ``<=0``; infinity fails the job."""
    power = F.floor(F.log10(value)).cast("string")
    infinite = F.raise_error(F.lit(INFINITE)).cast("string")
    return (
        F.when(value <= 0, F.lit("<=0"))
        .when(value == float("inf"), infinite)
        .otherwise(F.concat(F.lit("1e"), power))
    )


def is_missing(name: str, dtype: T.DataType, number: bool = False) -> Column:
    """Whether a column is null, or NaN where its type has NaN.

    ``number``: text that is not a number, ``NaN`` included, is missing as well.
    """
    column = F.col(name)
    if number and isinstance(dtype, T.StringType):
        return number_or_null(column).isNull()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()
