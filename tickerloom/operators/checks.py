"""Pass/fail checks over a consolidated table."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.dates import day_or_null
from tickerloom.functions.numbers import is_missing, number_or_error
from tickerloom.operators.equities import require_columns

CORE_COLUMNS = ("date", "asset", "close", "volume")

# The names of the checks in a report.
PRICES_CHECK = "precos_positivos"
MISSING_CHECK = "sem_nulos_nucleares"
ASSETS_CHECK = "ativos_disponiveis"


class QualityError(Exception):
    """A table failed one of its quality checks."""


def _all_positive(name: str) -> Column:
    price = number_or_error(F.col(name))
    # NaN counts as greater than any number in Spark, and null would be skipped.
    positive = F.coalesce((price > 0) & ~F.isnan(price), F.lit(False))
    return F.coalesce(F.bool_and(positive), F.lit(True))


def _none_missing(df: DataFrame, names: Sequence[str], numbers: Sequence[str] = ()) -> Column:
    if not names:
        return F.bool_and(F.lit(True)) | F.lit(True)
    flags = [is_missing(name, df.schema[name].dataType, number=name in numbers) for name in names]
    return F.coalesce(~F.bool_or(reduce(lambda a, b: a | b, flags)), F.lit(True))


def prices_positive(df: DataFrame) -> DataFrame:
    """One row ``ok``: every ``close`` is above zero; missing ones are not, text fails the job."""
    require_columns(df, "close")
    return df.agg(_all_positive("close").alias("ok"))


def no_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``ok``: no null or NaN in any of ``columns``."""
    require_columns(df, *columns)
    return df.agg(_none_missing(df, columns).alias("ok"))


CHECKS = (PRICES_CHECK, MISSING_CHECK, ASSETS_CHECK)


def check_flags(df: DataFrame) -> list[Column]:
    """The checks as aggregates.

    In a table read as text a volume or date that cannot be read is missing, and
    so is ``NaN``; a price that cannot be read fails the job.
    """
    require_columns(df, *CORE_COLUMNS)
    missing = _none_missing(df, CORE_COLUMNS, numbers=("close", "volume"))
    if isinstance(df.schema["date"].dataType, T.StringType):
        missing = missing & F.coalesce(F.bool_and(day_or_null(F.col("date")).isNotNull()), F.lit(True))
    return [
        _all_positive("close").alias(PRICES_CHECK),
        missing.alias(MISSING_CHECK),
        (F.count("asset") > 0).alias(ASSETS_CHECK),
    ]


def quality_checks(df: DataFrame) -> DataFrame:
    """The three checks of a report as rows ``check, ok``, from a single aggregate."""
    pairs = [F.struct(F.lit(name).alias("check"), F.col(name).alias("ok")) for name in CHECKS]
    return df.agg(*check_flags(df)).select(F.inline(F.array(*pairs)))


def is_bare(df: DataFrame) -> bool:
    """Whether a table that lacks core columns has no rows either."""
    return not set(CORE_COLUMNS) <= set(df.columns) and df.isEmpty()


def require_quality(df: DataFrame) -> DataFrame:
    """The table itself, or ``QualityError`` naming the failed checks.

    An empty table passes with a warning, whatever its columns.
    """
    if is_bare(df):
        warnings.warn("empty table, nothing to check", stacklevel=2)
        return df
    row = df.agg(F.count(F.lit(1)).alias("rows"), *check_flags(df)).first().asDict()
    if row.pop("rows") == 0:
        warnings.warn("empty table, nothing to check", stacklevel=2)
        return df
    failed = [name for name, ok in row.items() if not ok]
    if failed:
        raise QualityError(f"failed checks: {', '.join(failed)}")
    return df
