"""Text clean-up: stripping, ticker normalisation, column labels."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

LATIN1_WHITESPACE = "".join(mark for mark in WHITESPACE if ord(mark) < 256)


def strip(text: Column, blanks: str = WHITESPACE) -> Column:
    """Remove leading and trailing white space, no-break and other Unicode blanks included.

    Plain blanks go first: that is quick and leaves little for the longer list.
    """
    return F.btrim(F.trim(text), F.lit(blanks))


def normalize_asset(asset: Column) -> Column:
    """Ticker in capitals without any blanks; null stays null."""
    return F.upper(F.replace(strip(asset.cast("string")), F.lit(" "), F.lit("")))


def normalize_label(label: str) -> str:
    """Column label in lower case without accents and blanks (plan-time metadata)."""
    return re.sub("[\u0300-\u036f ]", "", unicodedata.normalize("NFKD", label)).lower()


def quoted(name: str) -> str:
    """Column name safe for ``F.col`` even with dots, blanks or backticks in it."""
    return "`" + name.replace("`", "``") + "`"
