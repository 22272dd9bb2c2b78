"""Prices restated for splits, dividends and currency changes by dated factors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.dates import day_or_error, with_quote_day
from tickerloom.functions.text import quoted
from tickerloom.operators.equities import require_columns


def adjustment_windows(factors: DataFrame) -> DataFrame:
    """Periods ``asset, since, until`` between the dated factors of an asset, with the ``factor`` of their prices.

    A price is multiplied by every factor dated after it.  Prices from the last
    factor's day on need none, so the last period is left open.
    """
    require_columns(factors, "asset", "date", "factor")
    days = factors.select("asset", day_or_error(F.col("date")).alias("date"), "factor")
    dated = days.where("asset IS NOT NULL AND date IS NOT NULL AND factor IS NOT NULL")
    events = dated.groupBy("asset", "date").agg(F.product("factor").alias("factor"))
    forwards = Window.partitionBy("asset").orderBy("date")
    backwards = Window.partitionBy("asset").orderBy(F.desc("date"))
    return events.select(
        "asset",
        F.coalesce(F.lag("date").over(forwards), F.lit("0001-01-01").cast("date")).alias("since"),
        F.date_sub("date", 1).alias("until"),
        F.product("factor").over(backwards).alias("factor"),
    )


def adjust_prices(quotes: DataFrame, factors: DataFrame, columns: Sequence[str] = ("close",)) -> DataFrame:
    """``quotes`` with ``date`` and the prices in ``columns`` restated to the terms of the last factor.

    ``factors`` has ``asset, date, factor``: prices before ``date`` are multiplied
    by ``factor``, several of one day by all of them.  Assets without factors and
    null assets keep their prices.  No quote is lost or repeated; a quote of an
    asset meets its periods by an equi-join on the asset, with the days as
    residual, in which adaptive execution can split a hot asset.
    """
    require_columns(quotes, "asset", *columns)
    dated = with_quote_day(quotes).alias("q")
    periods = adjustment_windows(factors).alias("f")
    inside = (F.col("q.asset") == F.col("f.asset")) & F.col("q.date").between(F.col("f.since"), F.col("f.until"))
    factor = F.coalesce(F.col("f.factor"), F.lit(1.0))
    return dated.join(periods, inside, "left").select(
        *(
            (F.col(f"q.{quoted(name)}") * factor).alias(name) if name in columns else F.col(f"q.{quoted(name)}")
            for name in dated.columns
        )
    )
