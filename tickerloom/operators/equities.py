"""Choosing instruments by market code."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.text import normalize_asset, strip

# The market code of regular equities and the depositary-receipt mark.
# Suspended papers carry code 96 and so never pass the test for 02.
EQUITY_CODE = "02"
RECEIPT_SPEC = "BDR"


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")


def equity_filter(quotes: DataFrame) -> DataFrame:
    """Regular equities only, with normalised tickers.

    Keeps market code 02 and drops depositary receipts; a missing ``spec``
    column or a null ``spec`` keeps the row.
    """
    require_columns(quotes, "BDI", "asset")
    keep = strip(F.col("BDI").cast("string")) == EQUITY_CODE
    if "spec" in quotes.columns:
        spec = strip(F.col("spec").cast("string"))
        keep = keep & (F.coalesce(spec, F.lit("")) != RECEIPT_SPEC)
    return quotes.where(keep).withColumn("asset", normalize_asset(F.col("asset")))


def asset_classes(
    quotes: DataFrame, classes: Mapping[str, str], default: str | None = None
) -> DataFrame:
    """Quotes with ``asset_class`` looked up from their market code.

    The codes have two characters, so the mapping is a small literal in the
    plan and no join is needed.
    """
    require_columns(quotes, "BDI")
    code = strip(F.col("BDI").cast("string"))
    if not classes:
        return quotes.withColumn("asset_class", F.lit(default).cast("string"))
    table = F.create_map(*[F.lit(item) for item in chain.from_iterable(classes.items())])
    known = F.try_element_at(table, code)
    return quotes.withColumn("asset_class", F.coalesce(known, F.lit(default).cast("string")))
