"""Index portfolios: delimited files whose validity period is in the file name."""

from __future__ import annotations

import logging
import re
from collections import defaultdict
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.text import normalize_asset, normalize_label, quoted
from tickerloom.sources.listing import Entry, entries, first_lines

log = logging.getLogger(__name__)

# Portfolio file names, the label of the ticker column once
# normalised, and the delimiters looked for in a header, first match wins.
PORTFOLIO_FILES = "IBOV_*.csv"
PORTFOLIO_NAME = r"/IBOV_(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})\.csv$"
ASSET_LABEL = "codigo"
DELIMITERS = (",", "\t", ";", " ", ":")

# A portfolio may also be a directory of part files, as Spark writes them.
PORTFOLIO_PATH = PORTFOLIO_NAME.replace("$", "(?:/[^/]*)?$")

EMPTY_SCHEMA = "asset string, start date, end date"


def _check_period(start: date, end: date) -> None:
    if start > end:
        raise ValueError(f"start {start} is after end {end}")


def _delimiter(header: str) -> str:
    bare = re.sub(r'"(?:[^"]|"")*"', "", header)  # marks inside quotes separate nothing
    return next((mark for mark in DELIMITERS if mark in bare), ",")


def _headers(spark: SparkSession, portfolios: list[Entry]) -> dict[str, list[str]]:
    """Paths of portfolios by header line; of a folder of part files, all must have the same.

    Of every file only the start is read.  A portfolio without a header is left out.
    """
    files = [
        (unit.path, part.path)
        for unit in portfolios
        for part in (entries(spark, unit.path) if unit.folder else [unit])
        if not (part.folder or part.length == 0)
    ]
    seen: dict[str, set[str]] = defaultdict(set)
    for (unit, _), header in zip(files, first_lines(spark, [path for _, path in files]), strict=True):
        if header is not None:
            seen[unit].add(header)
    groups: dict[str, list[str]] = defaultdict(list)
    for unit, headers in sorted(seen.items()):
        if len(headers) > 1:
            raise ValueError(f"part files of {unit} have different headers")
        groups[headers.pop()].append(unit)
    return groups


def _asset_column(columns: list[str], where: str) -> str:
    for name in columns:
        if normalize_label(name) == ASSET_LABEL:
            return name
    raise ValueError(f"no ticker column in {where}: {columns}")


def _read_dialect(
    spark: SparkSession,
    paths: list[str],
    header: str,
    start: Column,
    end: Column,
    infer_types: bool,
) -> DataFrame:
    """Files that share one header line, with asset and period in front."""
    table = spark.read.csv(paths, sep=_delimiter(header), header=True, inferSchema=infer_types)
    ticker = _asset_column(table.columns, paths[0])
    own = ("asset", "start", "end")
    rest = [F.col(quoted(name)) for name in table.columns if name.lower() not in own]
    return table.select(
        normalize_asset(F.col(quoted(ticker))).alias("asset"),
        start.alias("start"),
        end.alias("end"),
        *rest,
    )


def _union_by_name(tables: list[DataFrame]) -> DataFrame:
    """Union of differing columns, missing ones null.

    A column that is numeric in one table and text in another becomes text.
    Spark matches the names without regard to case.
    """
    kinds: dict[str, set[bool]] = defaultdict(set)
    for table in tables:
        for field in table.schema.fields:
            kinds[field.name.lower()].add(isinstance(field.dataType, T.NumericType))
    mixed = {name for name, seen in kinds.items() if len(seen) > 1}

    def aligned(table: DataFrame) -> DataFrame:
        present = [name for name in table.columns if name.lower() in mixed]
        return table.withColumns({name: F.col(quoted(name)).cast("string") for name in present})

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [aligned(t) for t in tables]
    )


def scan_portfolio(
    spark: SparkSession, path: str, start: date, end: date, infer_types: bool = False
) -> DataFrame:
    """One portfolio file: ``asset, start, end`` and the file's own columns, as text unless types are inferred."""
    _check_period(start, end)
    folder, _, name = path.rstrip("/").rpartition("/")
    found = entries(spark, folder or "/", name) if folder or path.startswith("/") else entries(spark, ".", name)
    if not found:
        raise FileNotFoundError(f"no portfolio file at {path}")
    headers = _headers(spark, found)
    if not headers:
        raise ValueError(f"portfolio file {path} is empty")
    (header,) = headers
    period = [F.lit(start).cast("date"), F.lit(end).cast("date")]
    return _read_dialect(spark, [path], header, *period, infer_types)


def _named_period(unit: str) -> tuple[date, date] | None:
    match = re.search(PORTFOLIO_NAME, unit)
    if match is None:
        return None
    start, end = (date.fromisoformat(text) for text in match.groups())
    _check_period(start, end)
    return start, end


def scan_members(spark: SparkSession, directory: str, infer_types: bool = False) -> DataFrame:
    """All portfolio files of a directory, one row per asset and validity period.

    The period comes from the file name (or from the directory name, for a
    portfolio written by Spark as part files), the delimiter from the header.
    Files with the same header are read by one scan, and only once: the files' own
    columns are text.  ``infer_types`` types them, at the price of a pass over
    them.  Names that do not fit are skipped with a warning.
    """
    root = directory.rstrip("/")
    found = entries(spark, root, PORTFOLIO_FILES)
    if found is None:
        raise FileNotFoundError(f"no portfolio directory {directory}")
    named = []
    for entry in found:
        if _named_period(f"/{entry.name}") is None:
            log.warning("skipping %s: no validity period in its name", f"{root}/{entry.name}")
        else:
            named.append(entry)
    if not named:
        return spark.createDataFrame([], EMPTY_SCHEMA)
    headers = _headers(spark, named)
    missing = {entry.path for entry in named}.difference(*headers.values())
    if missing:
        raise ValueError(f"portfolios without a header: {sorted(path.rsplit('/', 1)[-1] for path in missing)}")

    start, end = (F.regexp_extract("_metadata.file_path", PORTFOLIO_PATH, group).cast("date") for group in (1, 2))
    return _union_by_name(
        [
            _read_dialect(spark, paths, header, start, end, infer_types)
            for header, paths in headers.items()
        ]
    )
