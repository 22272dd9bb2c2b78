"""The quality report of a consolidated table."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.operators.checks import CHECKS, QualityError, check_flags, is_bare
from tickerloom.operators.histograms import PriceRange, close_histogram, price_range, volume_magnitude
from tickerloom.operators.profile import summary_columns, top_assets, zero_activity
from tickerloom.plans.tables import read_table_csv


SUMMARY_SCHEMA = "rows bigint, assets bigint, date_min date, date_max date"


def _warn_of_empty() -> None:
    warnings.warn("empty table, nothing to check", stacklevel=3)


@dataclass(frozen=True)
class QualityReport:
    """All parts of a report, and its verdict; only ``summary`` where an empty table lacks core columns."""

    rows: int
    failed: tuple[str, ...]
    summary: DataFrame
    checks: DataFrame | None = None
    zero_activity: DataFrame | None = None
    close_histogram: DataFrame | None = None
    volume_magnitude: DataFrame | None = None
    top_assets: DataFrame | None = None

    @property
    def ok(self) -> bool:
        return not self.failed

    def require(self) -> QualityReport:
        """The report itself, or ``QualityError`` naming the failed checks."""
        if self.failed:
            raise QualityError(f"failed checks: {', '.join(self.failed)}")
        return self


def quality_report(table: DataFrame, bins: int = 5, top: int = 10) -> QualityReport:
    """Summary, checks and the range of prices from one aggregate, run at once; every other part is one pass.

    An empty table passes with a warning, whatever its columns.
    """
    spark = table.sparkSession
    if is_bare(table):
        _warn_of_empty()
        return QualityReport(0, (), spark.createDataFrame([(0, 0, None, None)], SUMMARY_SCHEMA))
    measured = [*summary_columns(), *check_flags(table), *price_range()]
    row = table.agg(*measured).first().asDict()
    if row["rows"] == 0:
        _warn_of_empty()
    summary = (row["rows"], row["assets"], row["date_min"], row["date_max"])
    return QualityReport(
        rows=row["rows"],
        failed=tuple(name for name in CHECKS if row["rows"] and not row[name]),
        summary=spark.createDataFrame([summary], SUMMARY_SCHEMA),
        checks=spark.createDataFrame([(name, row[name]) for name in CHECKS], "check string, ok boolean"),
        zero_activity=zero_activity(table),
        close_histogram=close_histogram(table, bins, PriceRange(row["low"], row["high"], row["count"])),
        volume_magnitude=volume_magnitude(table),
        top_assets=top_assets(table, top),
    )


def validate(spark: SparkSession, path: str) -> QualityReport:
    """Report on a consolidated CSV, its verdict included; ``.require()`` raises on a failed check."""
    return quality_report(read_table_csv(spark, path))
