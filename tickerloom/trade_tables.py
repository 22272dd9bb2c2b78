"""Quotes and index portfolios derived from order-line and part tables.

There are no quote files among the test tables, so ``lineitem`` stands in for
the quotes and ``part`` for the index members, whole tables each.  The same
rows can be written as fixed-width files and portfolio files and scanned back.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.scratch import scratch_path
from tickerloom.sources.layout import QUOTE_LAYOUT, Layout

LINE_WIDTH = 245
YEARS = range(1995, 2002)
# A task that writes quote files has so many of them open, one a year; only beyond that it sorts its lines.
OPEN_FILES = 64
# Lines of a compressed part file, which one task reads whole.
PACKED_LINES = 1_000_000
# Start, end and the part type that is not in the index, per term; the last two overlap.
TERMS = (
    ("01-02", "04-02", "PROMO"),
    ("05-02", "08-02", "SMALL"),
    ("07-02", "12-02", "LARGE"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes as a scan gives them: untidy tickers, market codes, receipts, null specs."""
    ticker = F.col("l_partkey").cast("string")
    untidy = F.concat(F.lit(" p "), ticker, F.lit(" "))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.when(F.col("l_returnflag") == "N", "96").otherwise("02").alias("BDI"),
        F.when(F.col("l_linestatus") == "F", untidy)
        .otherwise(F.concat(F.lit("P"), ticker))
        .alias("asset"),
        F.when(F.col("l_linenumber") == 3, " BDR ")
        .when(F.col("l_linenumber") != 5, "ON      NM")
        .alias("spec"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume_shares"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("volume_brl"),
    )


def tidy_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per order line, ``asset, date, close, volume``."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("asset"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("close"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("volume"),
    )


def skewed_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``tidy_quotes``, but one asset holds a third of all rows."""
    hot = F.when(F.col("l_returnflag") == "R", F.lit(0).cast("bigint")).otherwise(
        F.col("l_partkey")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), hot.cast("string")).alias("asset"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("close"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three validity windows a year for each part, but for the type left out of the term."""
    terms = F.array(
        *[
            F.struct(
                F.lit(f"{year}-{start}").cast("date").alias("start"),
                F.lit(f"{year}-{end}").cast("date").alias("end"),
                F.lit(left_out).alias("left_out"),
            )
            for year in YEARS
            for start, end, left_out in TERMS
        ]
    )
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", "p_type", F.explode(terms).alias("term"))
        .where(F.col("p_type") != F.col("term.left_out"))
        .select(
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("asset"),
            "term.start",
            "term.end",
        )
    )


def _cents(amount: str) -> Column:
    return (F.col(amount) * 100 + 0.5).cast("bigint")


def quote_lines(spark: SparkSession, sf_dir: str, layout: Layout = QUOTE_LAYOUT) -> DataFrame:
    """Order lines as fixed-width quote records: ``year, value`` with ISO-8859-1 bytes.

    Headers and trailers of each year are among them.  Share volumes of the
    seventh lines are left blank, which a scan reads as zero.
    """
    quotes = table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    ticker = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    shares = F.col("l_quantity").cast("bigint")
    values = {
        "record_type": F.lit(layout.quote_type),
        "date_raw": F.replace(
            F.col("l_shipdate").cast("date").cast("string"), F.lit("-"), F.lit("")
        ),
        "BDI": F.when(F.col("l_returnflag") == "N", "96").otherwise("02"),
        "asset": F.when(F.col("l_linestatus") == "F", F.lower(ticker)).otherwise(ticker),
        "spec": F.when(F.col("l_linenumber") == 3, "BDR").otherwise("PNÃ  N1"),
        "close": _cents("l_extendedprice"),
        "volume_shares": F.when(F.col("l_linenumber") != 7, shares),
        "volume_brl": _cents("l_extendedprice") * shares,
    }
    # Joined as bytes: one per character, so that only texts need encoding.
    pieces, at = [], 1
    for field in sorted((layout.record_type, *layout.fields), key=lambda f: f.position):
        if field.position > at:
            pieces.append(F.lit(" " * (field.position - at)).cast("binary"))
        value = values[field.name]
        if field.is_number:
            digits = F.substring((value + 10**field.width).cast("string"), 2, field.width)
            pieces.append(F.coalesce(digits, F.lit(" " * field.width)).cast("binary"))
        elif field.kind == "code":
            pieces.append(value.cast("binary"))
        else:
            pieces.append(F.encode(F.rpad(value, field.width, " "), "ISO-8859-1"))
        at = field.last + 1
    pieces.append(F.lit(" " * (LINE_WIDTH + 1 - at)).cast("binary"))
    records = quotes.select(year.alias("year"), F.concat(*pieces).cast("string").alias("value"))

    edges = F.array(*[F.rpad(F.lit(kind), LINE_WIDTH, " ") for kind in ("00", "99")])
    frames = spark.range(YEARS.start, YEARS.stop).select(
        F.col("id").cast("int").alias("year"), F.explode(edges).alias("value")
    )
    return records.unionByName(frames)


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """Writes inside keep a file a partition open instead of sorting, and so spilling, whole lines."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _write_lines(lines: DataFrame, path: str, compression: str) -> str:
    named = lines.select(F.concat(F.col("year").cast("string"), F.lit(".TXT")).alias("COTAHIST_A"), "value")
    writer = named.write.partitionBy("COTAHIST_A").option("compression", compression)
    if compression != "none":
        writer = writer.option("maxRecordsPerFile", PACKED_LINES)
    with _open_files(lines.sparkSession):
        writer.text(path)
    return path


def write_quote_files(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    """One quote file a year, each a directory of part files; the directory holding them.

    A line is mostly blanks and zeros: packed, its files are a fraction of the size.
    """
    return _write_lines(quote_lines(spark, sf_dir), scratch_path(spark, "quotes"), compression)


def write_portfolio_files(spark: SparkSession, sf_dir: str) -> str:
    """Portfolios in two dialects, one with a quoted header, next to a file whose name does not fit and nested folders."""
    path = scratch_path(spark, "portfolios")
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("asset"),
        "p_type",
        "p_size",
        "p_retailprice",
    )

    def write(year: int, number: int) -> None:
        start, end, left_out = TERMS[number]
        inside = parts.where(F.col("p_type") != left_out)
        untidy = F.concat(F.lit(" "), F.lower("asset"), F.lit(" "))
        if number == 1:
            sep, listed = ";", inside.select(untidy.alias("Codigo"), F.col("p_size").alias("Peso, kg"))
        else:
            sep, listed = ",", inside.select(
                F.col("asset").alias("Código"),
                F.col("p_type").alias("Tipo"),
                F.col("p_size").alias("Qtde Teorica"),
                F.col("p_retailprice").alias("Part %"),
            )
        listed.write.csv(
            f"{path}/IBOV_{year}-{start}_{year}-{end}.csv", header=True, sep=sep,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, quoteAll=number == 1,
        )

    # A folder for each portfolio is a write of its own; they run side by side.
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, *zip(*((year, number) for year in YEARS for number in range(len(TERMS))))))
    parts.limit(0).select("asset").write.csv(f"{path}/IBOV_draft.csv", header=True)
    parts.groupBy("p_type").count().write.partitionBy("p_type").csv(f"{path}/notes")
    return path


def defective_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote lines of which some are cut short and some have letters in their share volume, by the last digit of the money volume."""
    layout = {field.name: field for field in QUOTE_LAYOUT.fields}
    shares, brl = layout["volume_shares"], layout["volume_brl"]
    line = F.col("value").cast("binary")

    def part(start: int, length: int) -> Column:
        return F.substring(line, start, length)

    spoiled = F.concat(
        part(1, shares.position - 1), F.rpad(F.lit("many"), shares.width, " ").cast("binary"),
        part(brl.position, LINE_WIDTH - shares.last),
    )
    last = part(brl.last, 1).cast("string")
    value = F.when(last == "3", part(1, 100)).when(last == "5", spoiled).otherwise(line)
    return quote_lines(spark, sf_dir).select("year", value.cast("string").alias("value"))


def write_defective_files(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    """Quote files of which some lines are bad; the directory holding them."""
    return _write_lines(defective_lines(spark, sf_dir), scratch_path(spark, "defective"), compression)


def dirty_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes with volumes as text: fractions, words, blanks, ``NaN`` and missing ones."""
    number = (F.col("l_quantity") * F.col("l_extendedprice") / 8).cast("string")
    text = (
        F.when(F.col("l_linenumber") == 2, "n/a")
        .when(F.col("l_linenumber") == 4, "NaN")
        .when(F.col("l_linenumber") == 5, "  ")
        .when(F.col("l_linenumber") != 6, number)
    )
    return table(spark, sf_dir, "lineitem").select(
        F.lit("02").alias("BDI"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("asset"),
        F.lit("ON").alias("spec"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("close"),
        text.alias("volume_brl"),
        (F.col("l_quantity") / 2).alias("volume_shares"),
    )


def hot_day_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of which one asset on one day holds a third."""
    hot = F.col("l_returnflag") == "R"
    return table(spark, sf_dir, "lineitem").select(
        F.when(hot, "P1").otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("asset"),
        F.when(hot, F.lit("1997-02-03").cast("date")).otherwise(F.col("l_shipdate").cast("date")).alias("date"),
        F.col("l_extendedprice").alias("close"),
    )


def price_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dated factors for small parts, one for the others but the promoted ones."""
    parts = table(spark, sf_dir, "part")
    event = F.array(
        F.struct(F.lit("1997-03-01").cast("date").alias("date"), F.lit(0.5).alias("factor")),
        F.struct(
            F.lit("1999-07-01").cast("date").alias("date"),
            F.when(F.col("p_size") < 20, F.lit(0.25)).alias("factor"),
        ),
    )
    return parts.where("p_type <> 'PROMO'").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("asset"), F.inline(event)
    )


def report_csv(spark: SparkSession, sf_dir: str) -> str:
    """A consolidated CSV with ``NaN``, empty and unreadable values; its path."""
    day = F.col("l_shipdate").cast("date").cast("string")
    volume = F.col("l_quantity").cast("bigint").cast("string")
    path = scratch_path(spark, "report_csv")
    (
        table(spark, sf_dir, "lineitem")
        .select(
            F.when(F.col("l_linenumber") == 6, "some day").otherwise(day).alias("date"),
            F.when(F.col("l_linenumber") != 7, F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("asset"),
            F.when(F.col("l_linenumber") == 5, "NaN")
            .when(F.col("l_linenumber") != 4, F.col("l_extendedprice").cast("string"))
            .alias("close"),
            F.when(F.col("l_linenumber") == 2, "many")
            .when(F.col("l_linenumber") == 3, "0")
            .when(F.col("l_linenumber") != 1, volume)
            .alias("volume"),
        )
        .write.csv(path, header=True)
    )
    return path
