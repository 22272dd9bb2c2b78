"""Histograms of prices and volumes."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.numbers import INFINITE, magnitude_label, number_or_null
from tickerloom.functions.text import quoted
from tickerloom.operators.equities import require_columns

HISTOGRAM_SCHEMA = "bin int, lower double, upper double, label string, count bigint"
# The lowest edge lies this share of the range below the minimum.
EDGE_MARGIN = 0.001
LABEL_DECIMALS = 3


def _rounded(value: float, decimals: int) -> float:
    """Round as labels do, halves of the scaled number to even.

    Numbers below one keep ``decimals`` significant digits.
    """
    if value == 0:
        return value
    if abs(value) < 1:
        decimals += -math.floor(math.log10(abs(value))) - 1
    scale = 10.0**decimals
    return round(value * scale) / scale


def _labels(edges: list[float]) -> list[str]:
    """``(lower, upper]`` with as many decimals as keep all edges apart.

    The first lower edge is shown one last decimal lower.
    """
    decimals = next(
        (
            d
            for d in range(LABEL_DECIMALS, 20)
            if len({_rounded(edge, d) for edge in edges}) == len(edges)
        ),
        LABEL_DECIMALS,
    )
    shown = [_rounded(edge, decimals) for edge in edges]
    shown[0] -= 10.0**-decimals
    return [f"({low}, {high}]" for low, high in zip(shown, shown[1:])]


def _bin_of(value: Column, low: float, step: float, bins: int) -> Column:
    """Number of the right-closed bin of a value.

    Division finds the bin or, by rounding, a neighbour; the edges next to it,
    computed as the labels' edges are, decide.
    """
    guess = F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((value - low) / step).cast("int")))
    below = (guess > 1) & (value <= (guess - 1) * F.lit(step) + low)
    above = (guess < bins) & (value > guess * F.lit(step) + low)
    return F.when(below, guess - 1).when(above, guess + 1).otherwise(guess)


class PriceRange(NamedTuple):
    low: float | None
    high: float | None
    count: int


def price_range() -> list[Column]:
    """Aggregates of ``close`` that make a ``PriceRange``."""
    close = number_or_null(F.col("close"))
    return [F.min(close).alias("low"), F.max(close).alias("high"), F.count(close).alias("count")]


def close_histogram(df: DataFrame, bins: int = 5, known: PriceRange | None = None) -> DataFrame:
    """Closing prices in ``bins`` equal intervals: ``bin, lower, upper, label, count``.

    Intervals are closed on the right and empty ones are kept.  A single
    distinct price gives one bar, no price none, an infinite one is an error.
    The range is looked up first (one aggregated row) unless it is ``known``; its
    edges are then literals of the counting query.
    """
    require_columns(df, "close")
    if bins < 1:
        raise ValueError("bins must be at least 1")
    spark = df.sparkSession
    prices = df.select(number_or_null(F.col("close")).alias("close")).where("close is not null")
    low, high, count = known or PriceRange(*df.agg(*price_range()).first())
    if count == 0:
        return spark.createDataFrame([], HISTOGRAM_SCHEMA)
    if math.isinf(low) or math.isinf(high):
        raise ValueError(INFINITE)
    if low == high:
        return spark.createDataFrame([(1, low, high, f"{low:.2f}", count)], HISTOGRAM_SCHEMA)

    step = (high - low) / bins
    inner = [i * step + low for i in range(1, bins)]
    edges = [low - EDGE_MARGIN * (high - low), *inner, high]
    names = spark.createDataFrame(
        list(zip(range(1, bins + 1), edges, edges[1:], _labels(edges))),
        "bin int, lower double, upper double, label string",
    )
    counts = prices.groupBy(_bin_of(F.col("close"), low, step, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    # One row per bin at most, so the counts can always be broadcast.
    return names.join(F.broadcast(counts), "bin", "left").fillna(0, subset=["count"]).orderBy("bin")


def volume_magnitude(df: DataFrame, volume_field: str = "volume") -> DataFrame:
    """Rows per order of magnitude of the volume: ``label, count``, labels sorted as text."""
    require_columns(df, volume_field)
    volume = number_or_null(F.col(quoted(volume_field)))
    return (
        df.select(volume.alias("volume"))
        .where("volume is not null")
        .groupBy(magnitude_label(F.col("volume")).alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("label")
    )
