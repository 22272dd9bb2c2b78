"""

``queries()`` runs the package's operators over whole tables; ``oracle_sql()``
states the expected rows independently for DuckDB.  Queries that scan files
first write them from the tables into the session's scratch folder.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The driver may load this file from another folder.
sys.path.insert(0, str(Path(__file__).resolve().parent))

import tickerloom as tl  # noqa: E402
from tickerloom import trade_tables as tables  # noqa: E402
from tickerloom.scratch import scratch_path  # noqa: E402

try:  # The corpus operators come with their own folder and can be left out.
    import corpus_pipeline
    from tickerloom.llm import queries as corpus_queries
except ModuleNotFoundError as missing:
    if not f"{missing.name}.".startswith(("corpus_pipeline.", "tickerloom.llm.")):
        raise
    corpus_pipeline = corpus_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Quote files that are written to be scanned; those whose sizes are reported stay plain.
PACKED = "lz4"

CLASSES = {"02": "round lot", "96": "odd lot"}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the consolidated table by money volume."""
    return consolidated_brl(spark, SMOKE_DIR)


# --- scans ---------------------------------------------------------------------------


def fixed_width_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = tl.scan_quotes(spark, tables.write_quote_files(spark, sf_dir, PACKED), with_file=True)
    return quotes.withColumn("file", F.regexp_extract("file", r"(\d{4})\.TXT$", 1))


def fixed_width_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.parse_lines(tables.quote_lines(spark, sf_dir).select("value"))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.write_quote_files(spark, sf_dir)
    report = tl.quote_file_report(spark, path)
    unit = F.regexp_extract("path", r"/(COTAHIST[^/]*\.TXT)(?:/[^/]*)?$", 1)
    sizes = (
        spark.read.format("binaryFile")
        .load(f"{path}/COTAHIST*.TXT")
        .groupBy(unit.alias("file"))
        .agg(F.sum("length").alias("bytes"))
    )
    return report.join(sizes, "file").withColumn(
        "file", F.regexp_extract("file", r"(\d{4})\.TXT$", 1)
    )


def membership_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tl.scan_members(spark, tables.write_portfolio_files(spark, sf_dir))
    return rows.select(
        "asset",
        "start",
        "end",
        F.col("`Peso, kg`").cast("bigint").alias("peso"),
        F.col("Tipo").alias("tipo"),
        F.col("`Qtde Teorica`").cast("bigint").alias("qtde"),
        F.col("`Part %`").cast("double").alias("part"),
    )


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a folder that also holds folders, one of them laid out like a partition."""
    path = scratch_path(spark, "listing")
    parts = tables.table(spark, sf_dir, "part").select("p_name").coalesce(1)
    parts.write.text(path)
    parts.write.text(f"{path}/year=1")
    parts.write.text(f"{path}/plain")
    listed = tl.list_files(spark, path, "*.txt")
    return listed.select(F.regexp_extract("name", r"^(part)-.*\.(txt)$", 2).alias("kind"), "length")


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = tl.malformed_lines(spark, tables.write_defective_files(spark, sf_dir, PACKED))
    return bad.select(F.regexp_extract("file", r"(\d{4})\.TXT$", 1).alias("file"), "defect", F.trim("line").alias("line"))


def fixed_width_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.scan_quotes(spark, tables.write_defective_files(spark, sf_dir, PACKED), mode="DROPMALFORMED")


def layout_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan with two more fields of the user's: slices that other fields have as well."""
    layout = tl.QUOTE_LAYOUT.with_fields(
        tl.Field("year", 3, 4, "whole"), tl.Field("ticker", 13, 4), tl.Field("cents", 109, 13, "whole")
    )
    quotes = tl.scan_quotes(spark, tables.write_quote_files(spark, sf_dir, PACKED), layout)
    return quotes.select("year", "ticker", "cents", "asset", "close")


# --- filters and joins ---------------------------------------------------------------


def equity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.equity_filter(tables.raw_quotes(spark, sf_dir))


def asset_class_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = tl.asset_classes(tables.raw_quotes(spark, sf_dir), CLASSES, default="other")
    return classified.groupBy("asset_class").agg(
        F.count(F.lit(1)).alias("quotes"),
        F.sum("volume_shares").alias("shares"),
        F.min("close").alias("close_min"),
        F.max("close").alias("close_max"),
    )


def validity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.validity_join(tables.tidy_quotes(spark, sf_dir), tables.members(spark, sf_dir))


def validity_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join as for windows too large to broadcast, one asset holding a third of the quotes."""
    return tl.validity_join(
        tables.skewed_quotes(spark, sf_dir),
        tables.members(spark, sf_dir),
        broadcast_bytes=0,
        rows_per_task=500,
    )


def validity_join_hot_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled join with a third of the quotes on one asset and one day."""
    return tl.validity_join(
        tables.hot_day_quotes(spark, sf_dir),
        tables.members(spark, sf_dir),
        broadcast_bytes=0,
        rows_per_task=500,
    )


# --- composite jobs ------------------------------------------------------------------


def consolidated_brl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.consolidate(tables.raw_quotes(spark, sf_dir), tables.members(spark, sf_dir))


def consolidated_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.consolidate(
        tables.raw_quotes(spark, sf_dir), tables.members(spark, sf_dir), "volume_shares"
    )


def consolidated_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.build_dataset(
        spark,
        tables.write_quote_files(spark, sf_dir, PACKED),
        tables.write_portfolio_files(spark, sf_dir),
        "volume_shares",
    )


def adjusted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.adjust_prices(tables.tidy_quotes(spark, sf_dir), tables.price_factors(spark, sf_dir))


def consolidated_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable volumes are missing."""
    return tl.consolidate(tables.dirty_quotes(spark, sf_dir), tables.members(spark, sf_dir))


def consolidated_half_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share volumes with a half go to the even number."""
    return tl.consolidate(tables.dirty_quotes(spark, sf_dir), tables.members(spark, sf_dir), "volume_shares")


# --- sinks ---------------------------------------------------------------------------


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tl.write_csv(consolidated_brl(spark, sf_dir), scratch_path(spark, "consolidated_csv"))
    return tl.read_consolidated_csv(spark, path)


def _year_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tl.consolidate(
        tables.raw_quotes(spark, sf_dir), tables.members(spark, sf_dir), ordered=False
    )
    path = tl.write_parquet_by_year(rows, scratch_path(spark, "consolidated_by_year"))
    return tl.read_year_table(spark, path)


def parquet_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _year_table(spark, sf_dir)


def year_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the years; the folders of the others are not read."""
    rows = tl.consolidate(
        tables.raw_quotes(spark, sf_dir), tables.members(spark, sf_dir), ordered=False
    )
    path = tl.write_parquet_by_year(rows, scratch_path(spark, "consolidated_by_year"))
    return tl.read_year_table(spark, path, [1995, 1998])


def year_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year-by-year summary in SQL over the published view."""
    view = tl.publish_view(_year_table(spark, sf_dir), "consolidated")
    return spark.sql(
        f"""
        SELECT year, count(*) AS quotes, count(DISTINCT asset) AS assets,
               min(close) AS close_min, max(close) AS close_max, max(volume) AS volume_max
        FROM {view} GROUP BY year
        """
    )


def ticker_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All quotes of the asset that has most of them."""
    quotes = tables.tidy_quotes(spark, sf_dir)
    busiest = tl.top_assets(quotes, 1).select("asset").scalar()
    return tl.ticker_history(quotes, busiest)


# --- reports -------------------------------------------------------------------------


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.summary(tables.tidy_quotes(spark, sf_dir))


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.quality_checks(tables.tidy_quotes(spark, sf_dir))


def quality_checks_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as quotes: balances below zero, and no volume for one segment."""
    customers = tables.table(spark, sf_dir, "customer").select(
        F.lit("1996-01-02").cast("date").alias("date"),
        F.col("c_name").alias("asset"),
        F.col("c_acctbal").alias("close"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal")).alias("volume"),
    )
    return tl.quality_checks(customers)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts of the report of a failing CSV as rows ``part, name, value``."""
    report = tl.validate(spark, tables.report_csv(spark, sf_dir))
    summary = report.summary.select(
        F.lit("summary").alias("part"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("value"))
                    for name in report.summary.columns
                ]
            )
        ),
    )

    def listed(part: str, rows: DataFrame, name: str, value: str) -> DataFrame:
        return rows.select(F.lit(part).alias("part"), F.col(name).alias("name"), F.col(value).cast("string").alias("value"))

    parts = [
        listed("check", report.checks, "check", "ok"),
        listed("zero", report.zero_activity, "asset", "count"),
        listed("close", report.close_histogram, "label", "count"),
        listed("volume", report.volume_magnitude, "label", "count"),
        listed("top", report.top_assets, "asset", "count"),
    ]
    for rows in parts:
        summary = summary.unionByName(rows)
    return summary


def prices_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = tables.table(spark, sf_dir, "supplier")
    return tl.prices_positive(suppliers.withColumnRenamed("s_acctbal", "close"))


def no_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.no_missing(tables.raw_quotes(spark, sf_dir), ["asset", "close", "spec"])


def zero_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines without a discount, or of the one flag whose discount is taken as unknown."""
    lines = tables.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("asset"),
        F.when(F.col("l_returnflag") != "R", F.col("l_discount")).alias("volume"),
    )
    return tl.zero_activity(lines)


def zero_activity_totneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("asset"),
        F.col("l_tax").alias("TOTNEG"),
        F.col("l_quantity").alias("volume"),
    )
    return tl.zero_activity(lines)


def close_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.close_histogram(tables.tidy_quotes(spark, sf_dir))


def close_histogram_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.table(spark, sf_dir, "orders")
    return tl.close_histogram(orders.withColumnRenamed("o_totalprice", "close"), bins=100)


def close_histogram_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as text with missing, unreadable and ``NaN`` ones among them."""
    price = (
        F.when(F.col("l_linenumber") == 1, "NaN")
        .when(F.col("l_linenumber") == 2, "n/a")
        .when(F.col("l_linenumber") != 3, F.col("l_extendedprice").cast("string"))
    )
    return tl.close_histogram(tables.table(spark, sf_dir, "lineitem").select(price.alias("close")), bins=7)


def volume_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.volume_magnitude(tables.tidy_quotes(spark, sf_dir))


def volume_magnitude_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.volume_magnitude(tables.table(spark, sf_dir, "customer"), "c_acctbal")


def top_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.top_assets(tables.tidy_quotes(spark, sf_dir))


def asset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.asset_counts(tables.tidy_quotes(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or job; each takes ``(spark, sf_dir)``."""
    registered = (
        fixed_width_scan,
        fixed_width_parse,
        file_inventory,
        file_listing,
        malformed_lines,
        fixed_width_lenient,
        layout_fields,
        membership_scan,
        equity_filter,
        asset_class_split,
        validity_join,
        validity_join_shuffled,
        validity_join_hot_day,
        adjusted_prices,
        consolidated_brl,
        consolidated_shares,
        consolidated_dirty,
        consolidated_half_shares,
        consolidated_from_files,
        csv_round_trip,
        parquet_by_year,
        year_slice,
        year_totals,
        ticker_history,
        summary,
        quality_report,
        quality_checks,
        quality_checks_failing,
        prices_positive,
        no_missing,
        zero_activity,
        zero_activity_totneg,
        close_histogram,
        close_histogram_fine,
        close_histogram_gaps,
        volume_magnitude,
        volume_magnitude_signed,
        top_assets,
        asset_counts,
    )
    named = {query.__name__: query for query in registered}
    if corpus_queries is not None:
        named |= corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return named


# --- expected rows -------------------------------------------------------------------

_TIDY = """
    tidy AS (
        SELECT 'P' || l_partkey AS asset, CAST(l_shipdate AS DATE) AS date,
               l_extendedprice AS close, l_extendedprice * l_quantity AS volume
        FROM lineitem
    )"""

_EQUITIES = """
    equities AS (
        SELECT CAST(l_shipdate AS DATE) AS date, 'P' || l_partkey AS asset,
               l_extendedprice AS close, CAST(l_quantity AS BIGINT) AS volume_shares,
               l_extendedprice * l_quantity AS volume_brl, l_linenumber
        FROM lineitem
        WHERE l_returnflag <> 'N' AND l_linenumber <> 3
    )"""

_MEMBERS_OF = """
    terms AS (
        SELECT CAST(y || '-' || s AS DATE) AS start, CAST(y || '-' || e AS DATE) AS "end",
               left_out, s
        FROM range({first}, {past}) AS years(y),
             (VALUES ('01-02', '04-02', 'PROMO'),
                     ('05-02', '08-02', 'SMALL'),
                     ('07-02', '12-02', 'LARGE')) AS t(s, e, left_out)
    ),
    members AS (
        SELECT 'P' || p_partkey AS asset, start, "end", s, p_type, p_size, p_retailprice
        FROM part JOIN terms ON p_type <> left_out
    )"""

_MEMBERS = _MEMBERS_OF.format(first=1995, past=2002)

_CONSOLIDATED = f"""
    WITH {_EQUITIES}, {{members}}
    SELECT q.date, q.asset, q.close, {{volume}} AS volume {{extra}}
    FROM equities q JOIN members m
      ON q.asset = m.asset AND q.date BETWEEN m.start AND m."end"
"""

_QUOTE_RECORDS = """
    SELECT strftime(l_shipdate, '%Y%m%d') AS date_raw,
           CASE WHEN l_returnflag = 'N' THEN '96' ELSE '02' END AS "BDI",
           CASE WHEN l_linestatus = 'F' THEN 'p' ELSE 'P' END || l_partkey AS asset,
           CASE WHEN l_linenumber = 3 THEN 'BDR' ELSE 'PNÃ  N1' END AS spec,
           l_extendedprice AS close,
           CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS volume_shares,
           CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) AS DOUBLE)
               / CAST(100 AS DOUBLE) AS volume_brl
"""


def _histogram_sql(source: str, bins: int) -> str:
    return f"""
    WITH prices AS ({source}),
    span AS (
        SELECT min(close) AS low, max(close) AS high, (max(close) - min(close)) / {bins} AS step
        FROM prices
    ),
    bars AS (
        SELECT CAST(n AS INTEGER) AS bin,
               CASE WHEN n = 1 THEN low - CAST(0.001 AS DOUBLE) * (high - low)
                    ELSE (n - 1) * step + low END AS lower,
               CASE WHEN n = {bins} THEN high ELSE n * step + low END AS upper
        FROM range(1, {bins} + 1) AS r(n), span
    )
    SELECT bin, lower, upper,
           '(' || CASE WHEN bin = 1 THEN round_even(lower, 3) - CAST(0.001 AS DOUBLE)
                       ELSE round_even(lower, 3) END
               || ', ' || round_even(upper, 3) || ']' AS label,
           count(close) AS count
    FROM bars LEFT JOIN prices ON close > lower AND close <= upper
    GROUP BY bin, lower, upper
    """


_MAGNITUDE = """
    SELECT CASE WHEN {v} <= 0 THEN '<=0' ELSE '1e' || CAST(floor(log10({v})) AS BIGINT) END AS label,
           count(*) AS count
    FROM {table} GROUP BY 1
"""


# Lines with the last digit of the money volume, which tells what is wrong with them, and their text up to there.
_DEFECTIVE = """
    SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) % 10 AS digit,
           rpad('01' || strftime(l_shipdate, '%Y%m%d') || CASE WHEN l_returnflag = 'N' THEN '96' ELSE '02' END
                || CASE WHEN l_linestatus = 'F' THEN 'p' ELSE 'P' END || l_partkey, 39, ' ')
               || CASE WHEN l_linenumber = 3 THEN 'BDR' ELSE 'PNÃ  N1' END AS head
    FROM lineitem
"""

_REPORT_CSV = """
    csv AS (
        SELECT CASE WHEN l_linenumber <> 6 THEN CAST(l_shipdate AS DATE) END AS date,
               CASE WHEN l_linenumber <> 7 THEN 'P' || l_partkey END AS asset,
               CASE WHEN l_linenumber NOT IN (4, 5) THEN l_extendedprice END AS close,
               CASE WHEN l_linenumber = 3 THEN CAST(0 AS BIGINT)
                    WHEN l_linenumber NOT IN (1, 2) THEN CAST(l_quantity AS BIGINT) END AS volume
        FROM lineitem
    )"""


def oracle_sql() -> dict[str, str]:
    """The expected rows of each query in SQL."""
    brl = _CONSOLIDATED.format(members=_MEMBERS, volume="q.volume_brl", extra="")
    skewed = """
        SELECT 'P' || CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_partkey END AS asset,
               CAST(l_shipdate AS DATE) AS date, l_extendedprice AS close
        FROM lineitem
    """
    corpus = {}
    if corpus_queries is not None:
        corpus = dict(corpus_queries.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL is not None:
            corpus["pipeline"] = corpus_pipeline.ORACLE_SQL
    return corpus | {
        "fixed_width_scan": _QUOTE_RECORDS
        + ", CAST(year(l_shipdate) AS VARCHAR) AS file FROM lineitem",
        "fixed_width_parse": _QUOTE_RECORDS + " FROM lineitem",
        "file_inventory": """
            SELECT CAST(year(l_shipdate) AS VARCHAR) AS file, count(*) + 2 AS lines,
                   count(*) AS records, CAST((count(*) + 2) * 246 AS BIGINT) AS bytes
            FROM lineitem GROUP BY 1
        """,
        "membership_scan": f"""
            WITH {_MEMBERS}
            SELECT asset, start, "end",
                   CASE WHEN s = '05-02' THEN CAST(p_size AS BIGINT) END AS peso,
                   CASE WHEN s <> '05-02' THEN p_type END AS tipo,
                   CASE WHEN s <> '05-02' THEN CAST(p_size AS BIGINT) END AS qtde,
                   CASE WHEN s <> '05-02' THEN p_retailprice END AS part
            FROM members
        """,
        "file_listing": """
            SELECT 'txt' AS kind, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS length FROM part
        """,
        "malformed_lines": f"""
            SELECT CAST(year(l_shipdate) AS VARCHAR) AS file,
                   CASE WHEN digit = 3 THEN 'length 100 is below the 188 characters of a record'
                        ELSE 'a numeric field is not a whole number' END AS defect,
                   CASE WHEN digit = 3 THEN head
                        ELSE rpad(head, 108, ' ') || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR), 13, '0')
                             || repeat(' ', 31) || rpad('many', 18, ' ')
                             || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) AS VARCHAR),
                                     18, '0') END AS line
            FROM ({_DEFECTIVE}) WHERE digit IN (3, 5)
        """,
        "fixed_width_lenient": _QUOTE_RECORDS + f" FROM ({_DEFECTIVE}) WHERE digit NOT IN (3, 5)",
        "layout_fields": """
            SELECT CAST(year(l_shipdate) AS BIGINT) AS year,
                   CASE WHEN l_linestatus = 'F' THEN 'p' ELSE 'P' END || substr(CAST(l_partkey AS VARCHAR), 1, 3) AS ticker,
                   CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
                   CASE WHEN l_linestatus = 'F' THEN 'p' ELSE 'P' END || l_partkey AS asset, l_extendedprice AS close
            FROM lineitem
        """,
        "validity_join_hot_day": f"""
            WITH quotes AS (
                SELECT CASE WHEN l_returnflag = 'R' THEN 'P1' ELSE 'P' || l_partkey END AS asset,
                       CASE WHEN l_returnflag = 'R' THEN DATE '1997-02-03' ELSE CAST(l_shipdate AS DATE) END AS date,
                       l_extendedprice AS close
                FROM lineitem
            ), {_MEMBERS}
            SELECT q.asset, q.date, q.close, m.start, m."end"
            FROM quotes q JOIN members m
              ON q.asset = m.asset AND q.date >= m.start AND q.date <= m."end"
        """,
        "adjusted_prices": f"""
            WITH {_TIDY}
            SELECT t.asset, date, volume,
                   close * CASE WHEN p_type <> 'PROMO' AND date < DATE '1997-03-01' THEN CAST(0.5 AS DOUBLE) ELSE 1 END
                         * CASE WHEN p_type <> 'PROMO' AND p_size < 20 AND date < DATE '1999-07-01'
                                THEN CAST(0.25 AS DOUBLE) ELSE 1 END AS close
            FROM tidy t JOIN part ON t.asset = 'P' || p_partkey
        """,
        "consolidated_dirty": f"""
            WITH {_MEMBERS}
            SELECT CAST(l_shipdate AS DATE) AS date, m.asset, l_extendedprice AS close,
                   CASE WHEN l_linenumber NOT IN (2, 4, 5, 6) THEN l_quantity * l_extendedprice / 8 END AS volume
            FROM lineitem JOIN members m
              ON m.asset = 'P' || l_partkey AND CAST(l_shipdate AS DATE) BETWEEN m.start AND m."end"
        """,
        "consolidated_half_shares": f"""
            WITH {_MEMBERS}
            SELECT CAST(l_shipdate AS DATE) AS date, m.asset, l_extendedprice AS close,
                   CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS volume
            FROM lineitem JOIN members m
              ON m.asset = 'P' || l_partkey AND CAST(l_shipdate AS DATE) BETWEEN m.start AND m."end"
        """,
        "year_slice": _CONSOLIDATED.format(
            members=_MEMBERS,
            volume="q.volume_brl",
            extra=", CAST(year(q.date) AS INTEGER) AS year",
        )
        + " WHERE year(q.date) IN (1995, 1998)",
        "quality_report": f"""
            WITH {_REPORT_CSV}, bars AS ({_histogram_sql("SELECT close FROM csv WHERE close IS NOT NULL", 5)}),
            top AS (
                SELECT asset, count(*) AS n FROM csv WHERE asset IS NOT NULL GROUP BY asset ORDER BY n DESC, asset LIMIT 10
            )
            SELECT 'summary' AS part, 'rows' AS name, CAST(count(*) AS VARCHAR) AS value FROM csv
            UNION ALL SELECT 'summary', 'assets', CAST(count(DISTINCT asset) AS VARCHAR) FROM csv
            UNION ALL SELECT 'summary', 'date_min', CAST(min(date) AS VARCHAR) FROM csv
            UNION ALL SELECT 'summary', 'date_max', CAST(max(date) AS VARCHAR) FROM csv
            UNION ALL SELECT 'check', 'precos_positivos', 'false'
            UNION ALL SELECT 'check', 'sem_nulos_nucleares', 'false'
            UNION ALL SELECT 'check', 'ativos_disponiveis', 'true'
            UNION ALL SELECT 'zero', asset, CAST(count(*) AS VARCHAR) FROM csv
                WHERE asset IS NOT NULL AND coalesce(volume, 0) = 0 GROUP BY asset
            UNION ALL SELECT 'close', label, CAST(count AS VARCHAR) FROM bars
            UNION ALL SELECT 'volume',
                CASE WHEN volume <= 0 THEN '<=0' ELSE '1e' || CAST(floor(log10(volume)) AS BIGINT) END,
                CAST(count(*) AS VARCHAR) FROM csv WHERE volume IS NOT NULL GROUP BY 2
            UNION ALL SELECT 'top', asset, CAST(n AS VARCHAR) FROM top
        """,
        "close_histogram_gaps": _histogram_sql(
            "SELECT l_extendedprice AS close FROM lineitem WHERE l_linenumber > 3", 7
        ),
        "equity_filter": """
            SELECT CAST(l_shipdate AS DATE) AS date, '02' AS "BDI", 'P' || l_partkey AS asset,
                   CASE WHEN l_linenumber <> 5 THEN 'ON      NM' END AS spec,
                   l_extendedprice AS close, CAST(l_quantity AS BIGINT) AS volume_shares,
                   l_extendedprice * l_quantity AS volume_brl
            FROM lineitem WHERE l_returnflag <> 'N' AND l_linenumber <> 3
        """,
        "asset_class_split": """
            SELECT CASE WHEN l_returnflag = 'N' THEN 'odd lot' ELSE 'round lot' END AS asset_class,
                   count(*) AS quotes, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS shares,
                   min(l_extendedprice) AS close_min, max(l_extendedprice) AS close_max
            FROM lineitem GROUP BY 1
        """,
        "validity_join": f"""
            WITH {_TIDY}, {_MEMBERS}
            SELECT q.asset, q.date, q.close, q.volume, m.start, m."end"
            FROM tidy q JOIN members m
              ON q.asset = m.asset AND q.date >= m.start AND q.date <= m."end"
        """,
        "validity_join_shuffled": f"""
            WITH quotes AS ({skewed}), {_MEMBERS}
            SELECT q.asset, q.date, q.close, m.start, m."end"
            FROM quotes q JOIN members m
              ON q.asset = m.asset AND q.date >= m.start AND q.date <= m."end"
        """,
        "consolidated_brl": brl,
        "consolidated_shares": _CONSOLIDATED.format(
            members=_MEMBERS, volume="q.volume_shares", extra=""
        ),
        "consolidated_from_files": _CONSOLIDATED.format(
            members=_MEMBERS,
            volume="CASE WHEN q.l_linenumber = 7 THEN 0 ELSE q.volume_shares END",
            extra="",
        ),
        "csv_round_trip": brl,
        "parquet_by_year": _CONSOLIDATED.format(
            members=_MEMBERS,
            volume="q.volume_brl",
            extra=", CAST(year(q.date) AS INTEGER) AS year",
        ),
        "year_totals": f"""
            SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS quotes,
                   count(DISTINCT asset) AS assets, min(close) AS close_min,
                   max(close) AS close_max, max(volume) AS volume_max
            FROM ({brl}) GROUP BY 1
        """,
        "ticker_history": f"""
            WITH {_TIDY}
            SELECT * FROM tidy WHERE asset = (
                SELECT asset FROM tidy GROUP BY asset ORDER BY count(*) DESC, asset LIMIT 1
            )
        """,
        "summary": f"""
            WITH {_TIDY}
            SELECT count(*) AS rows, count(DISTINCT asset) AS assets,
                   min(date) AS date_min, max(date) AS date_max
            FROM tidy
        """,
        "quality_checks": f"""
            WITH {_TIDY},
            flags AS (
                SELECT bool_and(close > 0) AS prices,
                       count(*) = count(date) AND count(*) = count(asset)
                           AND count(*) = count(close) AND count(*) = count(volume) AS filled,
                       count(DISTINCT asset) > 0 AS assets
                FROM tidy
            )
            SELECT 'precos_positivos' AS "check", prices AS ok FROM flags
            UNION ALL SELECT 'sem_nulos_nucleares', filled FROM flags
            UNION ALL SELECT 'ativos_disponiveis', assets FROM flags
        """,
        "quality_checks_failing": """
            WITH flags AS (
                SELECT bool_and(c_acctbal > 0) AS prices,
                       count(*) = count(CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END)
                           AS filled,
                       count(DISTINCT c_name) > 0 AS assets
                FROM customer
            )
            SELECT 'precos_positivos' AS "check", prices AS ok FROM flags
            UNION ALL SELECT 'sem_nulos_nucleares', filled FROM flags
            UNION ALL SELECT 'ativos_disponiveis', assets FROM flags
        """,
        "prices_positive": "SELECT bool_and(s_acctbal > 0) AS ok FROM supplier",
        "no_missing": """
            SELECT count(*) = count(CASE WHEN l_linenumber <> 5 THEN 1 END) AS ok FROM lineitem
        """,
        "zero_activity": """
            SELECT 'P' || l_partkey AS asset, count(*) AS count
            FROM lineitem WHERE l_returnflag = 'R' OR l_discount = 0 GROUP BY 1
        """,
        "zero_activity_totneg": """
            SELECT 'S' || l_suppkey AS asset, count(*) AS count
            FROM lineitem WHERE l_tax = 0 GROUP BY 1
        """,
        "close_histogram": _histogram_sql("SELECT l_extendedprice AS close FROM lineitem", 5),
        "close_histogram_fine": _histogram_sql("SELECT o_totalprice AS close FROM orders", 100),
        "volume_magnitude": _MAGNITUDE.format(v="l_extendedprice * l_quantity", table="lineitem"),
        "volume_magnitude_signed": _MAGNITUDE.format(v="c_acctbal", table="customer"),
        "top_assets": f"""
            WITH {_TIDY}
            SELECT asset, count(*) AS count FROM tidy
            GROUP BY asset ORDER BY count DESC, asset LIMIT 10
        """,
        "asset_counts": f"""
            WITH {_TIDY} SELECT asset, count(*) AS count FROM tidy GROUP BY asset
        """,
    }
