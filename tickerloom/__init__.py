"""Exchange quote history as Spark DataFrames.

Fixed-width daily quote files and period-stamped index portfolios go in; a
consolidated ``date, asset, close, volume`` table and its quality report come
out.  Every function takes and returns DataFrames built from column
expressions; only the ``write_*`` functions, ``require_quality``, the reports,
the size check of the validity join and the range lookup of the histogram run
jobs.
"""

from tickerloom.operators.adjust import adjust_prices
from tickerloom.operators.checks import (
    QualityError,
    no_missing,
    prices_positive,
    quality_checks,
    require_quality,
)
from tickerloom.operators.equities import asset_classes, equity_filter
from tickerloom.operators.histograms import close_histogram, volume_magnitude
from tickerloom.operators.profile import asset_counts, summary, top_assets, zero_activity
from tickerloom.operators.validity import validity_join
from tickerloom.plans.consolidate import build_dataset, consolidate
from tickerloom.plans.report import QualityReport, quality_report, validate
from tickerloom.plans.tables import (
    publish_view,
    read_consolidated_csv,
    read_table_csv,
    read_year_table,
    save_table,
    ticker_history,
    write_csv,
    write_parquet_by_year,
)
from tickerloom.sources.fixed_width import (
    malformed_lines,
    parse_lines,
    quote_file_report,
    scan_quote_file,
    scan_quotes,
)
from tickerloom.sources.layout import QUOTE_LAYOUT, Field, Layout
from tickerloom.sources.listing import list_files, list_quote_files
from tickerloom.sources.membership import scan_members, scan_portfolio

__all__ = [
    "Field",
    "Layout",
    "QUOTE_LAYOUT",
    "QualityError",
    "QualityReport",
    "adjust_prices",
    "asset_classes",
    "asset_counts",
    "build_dataset",
    "close_histogram",
    "consolidate",
    "equity_filter",
    "list_files",
    "list_quote_files",
    "malformed_lines",
    "no_missing",
    "parse_lines",
    "prices_positive",
    "publish_view",
    "quality_checks",
    "quality_report",
    "quote_file_report",
    "read_consolidated_csv",
    "read_table_csv",
    "read_year_table",
    "require_quality",
    "save_table",
    "scan_members",
    "scan_portfolio",
    "scan_quote_file",
    "scan_quotes",
    "summary",
    "ticker_history",
    "top_assets",
    "validate",
    "validity_join",
    "volume_magnitude",
    "write_csv",
    "write_parquet_by_year",
    "zero_activity",
]
