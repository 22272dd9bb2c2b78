"""Fixed-width quote files as typed DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.functions.numbers import cents_to_units, whole_number
from tickerloom.functions.text import LATIN1_WHITESPACE, strip
from tickerloom.sources.layout import QUOTE_LAYOUT, Field, Layout
from tickerloom.sources.listing import QUOTE_FILES, path_missing

CHARSET = "ISO-8859-1"
MODES = ("FAILFAST", "DROPMALFORMED")


def _bytes(field: Field) -> Column:
    # One ISO-8859-1 character is one byte, so positions are byte offsets and the
    # line never has to be decoded as a whole; Spark's own text would be UTF-8.
    return F.substring(F.col("value").cast("binary"), field.position, field.width)


def _text(field: Field) -> Column:
    return strip(F.decode(_bytes(field), CHARSET), LATIN1_WHITESPACE)


def _digits(field: Field) -> Column:
    return whole_number(_bytes(field).cast("string"), F.decode(_bytes(field), CHARSET))


def _value(field: Field) -> Column:
    if field.kind in ("code", "text"):
        return _text(field)
    if field.kind == "whole":
        return _digits(field)
    return cents_to_units(_digits(field), field.width)


def _is_quote(layout: Layout) -> Column:
    return _bytes(layout.record_type) == F.lit(layout.quote_type).cast("binary")


def _defects(layout: Layout) -> tuple[Column, Column, Column, Column]:
    """Whether a line is too short, and what to say; whether a quote has a bad number, and what to say."""
    size = F.octet_length("value")
    too_short = F.concat(
        F.lit("length "),
        size.cast("string"),
        F.lit(f" is below the {layout.min_length} characters of a record"),
    )
    numeric = [field for field in layout.fields if field.is_number]
    bad = reduce(lambda a, b: a | b, [_digits(field).isNull() for field in numeric], F.lit(False))
    return size < layout.min_length, too_short, bad, F.lit("a numeric field is not a whole number")


def _defect(layout: Layout) -> Column:
    """What is wrong with a line, null if nothing is."""
    short, too_short, bad, no_number = _defects(layout)
    return F.when(short, too_short).when(_is_quote(layout) & bad, no_number)


def parse_lines(
    lines: DataFrame,
    layout: Layout = QUOTE_LAYOUT,
    mode: str = "FAILFAST",
    file: Column | None = None,
) -> DataFrame:
    """Quote records of a DataFrame of text lines (column ``value``).

    Lines of other record types are dropped.  A line that is too short, or a
    quote with a bad number, fails the job naming the line and its file
    (``FAILFAST``) or is left out (``DROPMALFORMED``; see ``malformed_lines``).
    The check sits in the filter, where column pruning cannot remove it.
    ``file`` adds a column with the origin of each row.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    short, too_short, bad, no_number = _defects(layout)

    def fail(defect: Column) -> Column:
        line = F.decode(F.col("value").cast("binary"), CHARSET)
        problem = F.concat(
            F.lit("bad quote line in "), F.input_file_name(), F.lit(": "), defect, F.lit(": "), line
        )
        return F.raise_error(problem).cast("boolean")

    # Every field is named once here: the JVM does not compile a scan whose code gets too long.
    if mode == "FAILFAST":
        quote = _is_quote(layout)
        keep = F.when(short, fail(too_short)).when(quote & bad, fail(no_number)).otherwise(quote)
    else:
        keep = ~short & _is_quote(layout) & ~bad
    columns = [_value(field).alias(field.name) for field in layout.fields]
    if file is not None:
        columns.append(file.alias("file"))
    return lines.where(keep).select(*columns)


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.text(path)
    except AnalysisException as error:
        if path_missing(error):
            raise FileNotFoundError(f"no quote file at {path}") from error
        raise


def _read_directory(spark: SparkSession, directory: str) -> DataFrame:
    # A match may be a file, or a directory of part files written by Spark.
    return _read_lines(spark, f"{directory.rstrip('/')}/{QUOTE_FILES}")


def _unit_name() -> Column:
    """Name of the quote file a line comes from (the directory, for part files)."""
    return F.regexp_extract("_metadata.file_path", r"/(COTAHIST[^/]*\.TXT)(?:/[^/]*)?$", 1)


def scan_quote_file(
    spark: SparkSession, path: str, layout: Layout = QUOTE_LAYOUT, mode: str = "FAILFAST"
) -> DataFrame:
    """Quotes of one file, whatever its name."""
    return parse_lines(_read_lines(spark, path), layout, mode)


def scan_quotes(
    spark: SparkSession,
    directory: str,
    layout: Layout = QUOTE_LAYOUT,
    mode: str = "FAILFAST",
    with_file: bool = False,
) -> DataFrame:
    """Quotes of all quote files of a directory in one splittable scan."""
    file = _unit_name() if with_file else None
    return parse_lines(_read_directory(spark, directory), layout, mode, file)


def malformed_lines(
    spark: SparkSession, directory: str, layout: Layout = QUOTE_LAYOUT
) -> DataFrame:
    """The lines a strict scan would fail on: ``file, defect, line``."""
    return (
        _read_directory(spark, directory)
        .select(
            _unit_name().alias("file"),
            _defect(layout).alias("defect"),
            F.decode(F.col("value").cast("binary"), CHARSET).alias("line"),
        )
        .where(F.col("defect").isNotNull())
    )


def quote_file_report(
    spark: SparkSession, directory: str, layout: Layout = QUOTE_LAYOUT
) -> DataFrame:
    """Lines and quote records per quote file, sorted by file name."""
    return (
        _read_directory(spark, directory)
        .select(_unit_name().alias("file"), _is_quote(layout).alias("quote"))
        .groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if("quote").alias("records"),
        )
        .orderBy("file")
    )
