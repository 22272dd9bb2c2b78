"""Writing and reading the consolidated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.text import quoted
from tickerloom.operators.equities import require_columns
from tickerloom.sources.listing import path_missing


# Assets of a year are dealt to so many buckets, each one file or more.
ASSET_BUCKETS = 16


def _plain_number(value: Column) -> Column:
    """Double as text without an exponent where two decimals hold it, NaN as missing."""
    money = value.try_cast("decimal(20,2)")
    text = F.when(money.cast("double") == value, money.cast("string")).otherwise(
        value.cast("string")
    )
    return F.when(~F.isnan(value), text)


def write_csv(table: DataFrame, path: str) -> str:
    """Write CSV part files with a header each, replacing what is there.

    Part files follow the order of the rows.  Every number reads back as the
    same double.  An empty table leaves one file with just the header.
    """
    columns = [
        _plain_number(F.col(quoted(field.name))).alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType))
        else F.col(quoted(field.name))
        for field in table.schema.fields
    ]
    table.select(*columns).write.mode("overwrite").csv(path, header=True)
    return path


def _by_year(table: DataFrame) -> DataFrameWriter:
    """Writer of Snappy-compressed Parquet, one directory per year.

    One shuffle, by year and bucket of assets, without a pass to sample ranges;
    adaptive execution cuts large partitions, a hot asset's too, and joins small
    ones.  A year has few files, each sorted by asset, so that a lookup of one
    asset skips most row groups and pages.
    """
    require_columns(table, "date", "asset")
    bucket = F.pmod(F.xxhash64("asset"), F.lit(ASSET_BUCKETS))
    return (
        table.withColumn("year", F.year("date"))
        .withColumn("_bucket", bucket)
        .hint("rebalance", "year", "_bucket")
        .drop("_bucket")
        .sortWithinPartitions("year", "asset", "date")
        .write.mode("overwrite")
        .partitionBy("year")
        .option("compression", "snappy")
    )


def write_parquet_by_year(table: DataFrame, path: str) -> str:
    """Write a table as Parquet by year, replacing what is there."""
    _by_year(table).parquet(path)
    return path


def read_table_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or directory with a header, every column as text."""
    try:
        return spark.read.csv(path, header=True)
    except AnalysisException as error:
        if path_missing(error):
            raise FileNotFoundError(f"no table at {path}") from error
        raise


def read_consolidated_csv(
    spark: SparkSession, path: str, volume_type: str = "double"
) -> DataFrame:
    """A consolidated CSV table with its types, without a pass to infer them."""
    schema = f"date date, asset string, close double, volume {volume_type}"
    try:
        return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")
    except AnalysisException as error:
        if path_missing(error):
            raise FileNotFoundError(f"no table at {path}") from error
        raise


def read_year_table(
    spark: SparkSession, path: str, years: int | Sequence[int] | None = None
) -> DataFrame:
    """A Parquet table written by year; only the directories of ``years`` are read."""
    table = spark.read.parquet(path)
    if years is None:
        return table
    wanted = [years] if isinstance(years, int) else list(years)
    return table.where(F.col("year").isin(wanted))


def ticker_history(table: DataFrame, asset: str | Column) -> DataFrame:
    """The rows of one asset, by date; rows of one day may be sorted by several tasks."""
    rows = table.where(F.col("asset") == asset).withColumn("_origin", F.spark_partition_id())
    return rows.orderBy("date", "_origin").drop("_origin")


def publish_view(table: DataFrame, name: str) -> str:
    """Make a table known to ``spark.sql`` under ``name`` for this session."""
    table.createOrReplaceTempView(name)
    return name


def save_table(table: DataFrame, name: str) -> str:
    """Store a table in the catalog as Parquet by year, for SQL across sessions."""
    _by_year(table).format("parquet").saveAsTable(name)
    return name
