"""From files to the consolidated table."""

from datetime import date
from pathlib import Path

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tickerloom as tl
from tests.helpers import SAMPLE_LINES, SAMPLE_PERIOD, SAMPLE_PORTFOLIO, quote_line, rows, write_lines, write_text


# What the made-up week leaves: regular market, no receipts, members only.
BRL = [
    (date(2031, 5, 15), "FOZ11", 44.0, 220.0),
    (date(2031, 5, 14), "LUMI3", 150.25, 1803.0),
    (date(2031, 5, 14), "SOLA4", 8.7, 348.0),
]


@pytest.fixture
def folders(tmp_path):
    write_lines(tmp_path / "quotes" / "COTAHIST.A2031.TXT", SAMPLE_LINES)
    write_text(tmp_path / "members" / SAMPLE_PERIOD, SAMPLE_PORTFOLIO)
    return str(tmp_path / "quotes"), str(tmp_path / "members")


@pytest.mark.parametrize(
    ("field", "kind", "volumes"),
    [("volume_brl", "double", [220.0, 1803.0, 348.0]), ("volume_shares", "bigint", [5, 12, 40])],
)
def test_either_volume(spark, folders, field, kind, volumes):
    table = tl.build_dataset(spark, *folders, volume_field=field)
    assert table.columns == ["date", "asset", "close", "volume"] and dict(table.dtypes)["volume"] == kind
    assert rows(table) == [(*row[:3], volume) for row, volume in zip(BRL, volumes)]


def test_windows_too_big_to_broadcast(spark, folders):
    assert rows(tl.build_dataset(spark, *folders, broadcast_bytes=0)) == BRL


def test_a_shuffled_join_parses_the_files_once(spark, folders):
    table = tl.build_dataset(spark, *folders, volume_field="volume_shares", broadcast_bytes=0)
    read = table.inputFiles()
    assert read and not any(path.endswith((".TXT", ".csv")) for path in read)
    assert rows(table) == [(*row[:3], volume) for row, volume in zip(BRL, [5, 12, 40])]


def test_unordered(spark, folders):
    assert sorted(rows(tl.build_dataset(spark, *folders, ordered=False))) == sorted(BRL)


def test_the_volume_field_is_checked_first(spark):
    with pytest.raises(ValueError):
        tl.build_dataset(spark, "/none", "/none", volume_field="invalid")


def test_missing_inputs(spark, folders, tmp_path):
    quotes, members = folders
    with pytest.raises(FileNotFoundError):
        tl.build_dataset(spark, str(tmp_path / "none"), members)
    with pytest.raises(FileNotFoundError):
        tl.build_dataset(spark, quotes, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        tl.build_dataset(spark, str(tmp_path / "empty"), members)
    with pytest.raises(ValueError):
        tl.build_dataset(spark, quotes, str(tmp_path / "empty"))
    write_text(tmp_path / "bare" / SAMPLE_PERIOD, "Codigo;Peso\n")
    with pytest.raises(ValueError):
        tl.build_dataset(spark, quotes, str(tmp_path / "bare"))


def test_only_dates_of_equities_are_checked(spark, folders):
    quotes, members = folders
    write_lines(Path(quotes) / "COTAHIST_B.TXT", [quote_line(date="99999999", bdi="96")])
    assert rows(tl.build_dataset(spark, quotes, members)) == BRL
    write_lines(Path(quotes) / "COTAHIST_C.TXT", [quote_line(date="99999999")])
    with pytest.raises(PySparkException, match="invalid date"):
        tl.build_dataset(spark, quotes, members).collect()


def test_bad_lines_fail_the_build(spark, folders):
    quotes, members = folders
    write_lines(Path(quotes) / "COTAHIST_B.TXT", ["01short"])
    with pytest.raises(PySparkException, match="COTAHIST_B.TXT"):
        tl.build_dataset(spark, quotes, members).count()
    assert rows(tl.build_dataset(spark, quotes, members, mode="DROPMALFORMED")) == BRL


def test_sorted_with_ties(spark):
    quotes = spark.createDataFrame(
        [("02", asset, date(2024, 1, day), float(close), volume)
         for asset in ("B", "A") for day in (3, 1, 2) for close in (2, 1) for volume in (7.0, 7.0, 5.0)],
        "BDI string, asset string, date date, close double, volume_brl double",
    )
    members = spark.createDataFrame(
        [("A", date(2024, 1, 1), date(2024, 1, 3)), ("B", date(2024, 1, 1), date(2024, 1, 2))],
        "asset string, start date, end date",
    )
    found = [(row["asset"], row["date"], row["close"], row["volume"])
             for row in tl.consolidate(quotes, members).collect()]
    assert len(found) == 30 and found == sorted(found)


def test_volume_coercion(spark):
    day = date(2024, 1, 1)
    members = spark.createDataFrame([("A", day, day)], "asset string, start date, end date")
    quotes = spark.createDataFrame(
        [("02", "A", day, 1.0, text, number) for text, number in
         [("12.5", 2.5), ("n/a", 3.5), (None, float("nan")), ("nan", None)]],
        "BDI string, asset string, date date, close double, volume_brl string, volume_shares double",
    )
    brl = sorted(rows(tl.consolidate(quotes, members).select("volume")), key=str)
    assert brl == [(12.5,), (None,), (None,), (None,)]
    shares = sorted(rows(tl.consolidate(quotes, members, "volume_shares").select("volume")), key=str)
    assert shares == [(2,), (4,), (None,), (None,)]


def test_missing_volume_column(spark):
    day = date(2024, 1, 1)
    members = spark.createDataFrame([("A", day, day)], "asset string, start date, end date")
    quotes = spark.createDataFrame([("02", "A", day, 1.0)], "BDI string, asset string, date date, close double")
    with pytest.raises(KeyError):
        tl.consolidate(quotes, members)


def test_plan(spark, folders):
    table = tl.build_dataset(spark, *folders)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "EvalPython" not in plan
    assert "rangepartitioning(asset" in plan
    # The file columns that the result does not need are never read.
    assert "Peso" not in plan


def test_one_shuffle_from_text_to_parquet(spark, folders):
    """The sink owns the only exchange; the quote files are read once."""
    from tickerloom.plans import tables

    table = tl.build_dataset(spark, *folders, ordered=False)
    assert " Exchange " not in table._jdf.queryExecution().executedPlan().toString()
    dealt = table.withColumn("year", F.year("date")).hint("rebalance", "year")
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan text") == 1
    assert tables.ASSET_BUCKETS > 1


# --- sinks ---------------------------------------------------------------------------


def test_csv(spark, folders, tmp_path):
    path = tl.write_csv(tl.build_dataset(spark, *folders), str(tmp_path / "new" / "out"))
    assert rows(tl.read_consolidated_csv(spark, path).orderBy("asset")) == BRL
    text = "".join(sorted(p.read_text() for p in Path(path).glob("*.csv")))
    assert "1803.00" in text and "150.25" in text
    parts = pd.concat(pd.read_csv(p) for p in sorted(Path(path).glob("*.csv")))
    assert parts["volume"].tolist() == [220.0, 1803.0, 348.0]
    assert parts["date"].tolist() == ["2031-05-15", "2031-05-14", "2031-05-14"]
    tl.write_csv(tl.build_dataset(spark, *folders).limit(1), path)
    assert tl.read_consolidated_csv(spark, path).count() == 1


def test_csv_numbers_survive(spark, tmp_path):
    values = [0.0, 0.1, 1 / 3, 1e-9, 12345678.9, 123456789.125, 9.99e17, 1e300, -2.5, float("nan"), None]
    table = spark.createDataFrame(
        [(date(2024, 1, 1), f"A{n}", 1.0, value) for n, value in enumerate(values)],
        "date date, asset string, close double, volume double",
    )
    path = tl.write_csv(table, str(tmp_path / "out"))
    back = {row["asset"]: row["volume"] for row in tl.read_consolidated_csv(spark, path).collect()}
    expected = values[:-2] + [None, None]
    assert [back[f"A{n}"] for n in range(len(values))] == expected


def test_empty_csv_has_a_header(spark, folders, tmp_path):
    empty = tl.build_dataset(spark, *folders).where("asset = 'none'")
    path = tl.write_csv(empty, str(tmp_path / "out"))
    files = list(Path(path).glob("*.csv"))
    assert [p.read_text().strip() for p in files] == ["date,asset,close,volume"]
    assert tl.read_consolidated_csv(spark, path).isEmpty()


def test_missing_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tl.read_consolidated_csv(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        tl.read_table_csv(spark, str(tmp_path / "none"))


@pytest.fixture
def long_table(spark):
    return spark.range(0, 4000).select(
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 1000).cast("int")).alias("date"),
        F.concat(F.lit("T"), (F.col("id") % 13).cast("string")).alias("asset"),
        F.col("id").cast("double").alias("close"),
        (F.col("id") * 10).cast("double").alias("volume"),
    )


def test_parquet_by_year(spark, long_table, tmp_path):
    path = tl.write_parquet_by_year(long_table, str(tmp_path / "years"))
    assert {p.name for p in Path(path).glob("year=*")} == {"year=2022", "year=2023", "year=2024"}
    assert all(".snappy." in p.name for p in Path(path).glob("year=*/*.parquet"))
    back = tl.read_year_table(spark, path)
    assert sorted(rows(back.select("date", "asset", "close", "volume"))) == sorted(rows(long_table))

    one = tl.read_year_table(spark, path, 2023)
    assert one.count() == long_table.where("year(date) = 2023").count()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "2023" in plan
    both = tl.read_year_table(spark, path, [2022, 2024])
    assert both.count() + one.count() == 4000


def test_ticker_history_reaches_the_scan(spark, long_table, tmp_path):
    path = tl.write_parquet_by_year(long_table, str(tmp_path / "years"))
    history = tl.ticker_history(tl.read_year_table(spark, path), "T4")
    found = [row["date"] for row in history.collect()]
    assert len(found) == long_table.where("asset = 'T4'").count() and found == sorted(found)
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(asset), EqualTo(asset,T4)]" in plan


def test_sql(spark, long_table):
    name = tl.publish_view(long_table, "quotes_view")
    assert spark.sql(f"SELECT count(*) FROM {name} WHERE asset = 'T0'").first()[0] == 308
    tl.save_table(long_table, "quotes_table")
    try:
        found = spark.sql("SELECT year, count(*) FROM quotes_table GROUP BY year ORDER BY year")
        assert [row[0] for row in found.collect()] == [2022, 2023, 2024]
    finally:
        spark.sql("DROP TABLE quotes_table")
