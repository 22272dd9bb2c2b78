"""The consolidated table: quotes of index members on the days they were members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.functions.dates import with_quote_day
from tickerloom.functions.numbers import number_or_null, rounded_shares
from tickerloom.operators.equities import equity_filter, require_columns
from tickerloom.operators.validity import BROADCAST_BYTES, measure_windows, validity_join
from tickerloom.scratch import saved
from tickerloom.sources.fixed_width import scan_quotes
from tickerloom.sources.layout import QUOTE_LAYOUT, Layout
from tickerloom.sources.membership import scan_members

VOLUME_FIELDS = ("volume_brl", "volume_shares")


def _check_volume_field(volume_field: str) -> None:
    if volume_field not in VOLUME_FIELDS:
        raise ValueError(f"volume_field must be one of {VOLUME_FIELDS}, got {volume_field!r}")


# Rows come with the partition they were found in.  As the last key of a shuffle or
# sort it lets any number of equal rows go to different tasks.
ORIGIN = "_origin"


def consolidate(
    quotes: DataFrame,
    members: DataFrame,
    volume_field: str = "volume_brl",
    broadcast_bytes: int = BROADCAST_BYTES,
    ordered: bool = True,
    from_text: bool = False,
) -> DataFrame:
    """``date, asset, close, volume`` of regular equities while in the index.

    ``volume`` is the money volume as double or the share volume as bigint.
    Rows are sorted by asset and date, ties by close and volume; pass
    ``ordered=False`` when the table goes to a writer with an order of its own.

    A sort runs its input twice, first to sample the ranges.  ``from_text`` says
    that reading the inputs is dear: the result of a broadcast join, narrow rows
    of members only, is then shuffled before, so that the quotes are parsed once.
    A shuffled join looks at its sides several times; from text they are written
    as narrow tables first.
    """
    _check_volume_field(volume_field)
    equities = equity_filter(quotes)
    require_columns(equities, "close", volume_field)
    windows = members.select("asset", "start", "end")
    size = measure_windows(windows)
    if size.rows == 0:
        raise ValueError("the membership table is empty")
    if from_text and not size.fits(broadcast_bytes):
        # The day is made from the table: with it and its range, the code of the scan gets too long to be compiled.
        days = [name for name in ("date", "date_raw") if name in equities.columns]
        narrow = equities.select("asset", *days, "close", volume_field)
        equities, windows = saved(narrow, "equities"), saved(windows, "windows")
    joined = validity_join(with_quote_day(equities), windows, size, broadcast_bytes)
    if volume_field == "volume_shares":
        volume = rounded_shares(F.col(volume_field), joined.schema[volume_field].dataType)
    else:
        volume = number_or_null(F.col(volume_field))
    rows = joined.select(
        "date", "asset", "close", volume.alias("volume"), F.spark_partition_id().alias(ORIGIN)
    )
    if ordered:
        if from_text and size.fits(broadcast_bytes):
            rows = rows.repartition("asset", "date", ORIGIN)
        rows = rows.orderBy("asset", "date", "close", "volume", ORIGIN)
    return rows.drop(ORIGIN)


def build_dataset(
    spark: SparkSession,
    quotes_dir: str,
    members_dir: str,
    volume_field: str = "volume_brl",
    layout: Layout = QUOTE_LAYOUT,
    mode: str = "FAILFAST",
    broadcast_bytes: int = BROADCAST_BYTES,
    ordered: bool = True,
) -> DataFrame:
    """The consolidated table straight from a quote and a portfolio directory.

    Bad arguments, missing files and an empty membership fail at once; bad
    lines and dates fail the job that reads them.
    """
    _check_volume_field(volume_field)
    quotes = scan_quotes(spark, quotes_dir, layout, mode)
    members = scan_members(spark, members_dir, infer_types=False)
    return consolidate(quotes, members, volume_field, broadcast_bytes, ordered, from_text=True)
