"""Counts over a consolidated table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.dates import day_or_null
from tickerloom.functions.numbers import number_or_null
from tickerloom.operators.equities import require_columns


def summary_columns() -> list[Column]:
    """The aggregates of a summary; unparsable dates are ignored."""
    day = day_or_null(F.col("date"))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("asset").alias("assets"),
        F.min(day).alias("date_min"),
        F.max(day).alias("date_max"),
    ]


def summary(df: DataFrame) -> DataFrame:
    """One row: ``rows, assets, date_min, date_max``; unparsable dates are ignored."""
    require_columns(df, "asset", "date")
    return df.agg(*summary_columns())


def asset_counts(df: DataFrame) -> DataFrame:
    """Rows per asset, without the null asset."""
    require_columns(df, "asset")
    return (
        df.where(F.col("asset").isNotNull())
        .groupBy("asset")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def top_assets(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` assets with most rows, ties by name."""
    return asset_counts(df).orderBy(F.desc("count"), "asset").limit(n)


def zero_activity(
    df: DataFrame, totneg_field: str = "TOTNEG", volume_field: str = "volume"
) -> DataFrame:
    """Rows without activity per asset, most first.

    The number of trades decides if that column exists, else the volume; zero,
    missing and unreadable values count as no activity.
    """
    require_columns(df, "asset")
    field = next((name for name in (totneg_field, volume_field) if name in df.columns), None)
    if field is None:
        raise KeyError(f"neither {totneg_field!r} nor {volume_field!r} is a column")
    idle = F.coalesce(number_or_null(F.col(field)), F.lit(0.0)) == 0
    return asset_counts(df.where(idle)).orderBy(F.desc("count"), "asset")
