"""Checks, counts and histograms."""

import math
import random
from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException

import tickerloom as tl
from tests.helpers import rows, write_text

NAN = float("nan")


def closes(spark, values, kind="double"):
    return spark.createDataFrame([(value,) for value in values], f"close {kind}")


@pytest.mark.parametrize(
    "values, ok",
    [
        ([1.0, 2.5, 3.1], True),
        ([1.0, -0.1], False),
        ([1.0, 0.0], False),
        ([1.0, None], False),
        ([1.0, NAN], False),
        ([], True),
    ],
)
def test_prices_positive(spark, values, ok):
    assert rows(tl.prices_positive(closes(spark, values))) == [(ok,)]


def test_prices_as_text(spark):
    assert rows(tl.prices_positive(closes(spark, ["1", " 2.5"], "string"))) == [(True,)]
    with pytest.raises(PySparkException, match="not a number"):
        tl.prices_positive(closes(spark, ["1", "abc"], "string")).collect()


def test_prices_need_a_close(spark):
    with pytest.raises(KeyError):
        tl.prices_positive(closes(spark, [1.0]).withColumnRenamed("close", "price"))


def test_no_missing(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "PETR4", 1.0), (None, "VALE3", NAN)], "date string, asset string, close double"
    )
    assert rows(tl.no_missing(df, ["asset"])) == [(True,)]
    assert rows(tl.no_missing(df, ["date", "asset"])) == [(False,)]
    assert rows(tl.no_missing(df, ["close"])) == [(False,)]
    assert rows(tl.no_missing(df, [])) == [(True,)]
    assert rows(tl.no_missing(df.limit(0), ["date"])) == [(True,)]
    with pytest.raises(KeyError):
        tl.no_missing(df, ["volume"])


def test_summary(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "PETR4"), ("2024-01-05", "VALE3"), ("not a date", None), (None, "VALE3")],
        "date string, asset string",
    )
    assert rows(tl.summary(df.limit(2))) == [(2, 2, date(2024, 1, 1), date(2024, 1, 5))]
    assert rows(tl.summary(df)) == [(4, 2, date(2024, 1, 1), date(2024, 1, 5))]
    assert rows(tl.summary(df.limit(0))) == [(0, 0, None, None)]
    assert rows(tl.summary(df.where("date = 'not a date'"))) == [(1, 0, None, None)]
    stamps = spark.createDataFrame([(datetime(2024, 1, 1, 17), "A")], "date timestamp, asset string")
    assert rows(tl.summary(stamps)) == [(1, 1, date(2024, 1, 1), date(2024, 1, 1))]
    for name in ("asset", "date"):
        with pytest.raises(KeyError):
            tl.summary(df.drop(name))


def test_zero_activity_prefers_trades(spark):
    """Where trades are counted the volume doesn't matter, zero or not."""
    data = [("SOLA4", trades, volume) for trades in (0, 3) for volume in (0, 70)]
    data += [("LUMI3", 0, 9)] * 3 + [("FOZ11", 8, 0)]
    df = spark.createDataFrame(data, "asset string, TOTNEG int, volume int")
    assert rows(tl.zero_activity(df)) == [("LUMI3", 3), ("SOLA4", 2)]


def test_zero_activity_by_volume(spark):
    df = spark.createDataFrame(
        [("PETR4", "0"), ("VALE3", "0"), ("VALE3", "10"), ("VALE3", None), ("VALE3", "n/a"),
         ("ABEV3", "NaN"), (None, "0"), ("ITUB4", "1")],
        "asset string, volume string",
    )
    assert rows(tl.zero_activity(df)) == [("VALE3", 3), ("ABEV3", 1), ("PETR4", 1)]
    assert rows(tl.zero_activity(df.withColumnRenamed("volume", "v"), volume_field="v")) == [
        ("VALE3", 3), ("ABEV3", 1), ("PETR4", 1),
    ]
    with pytest.raises(KeyError):
        tl.zero_activity(df.drop("volume"))
    with pytest.raises(KeyError):
        tl.zero_activity(df.drop("asset"))


def test_counts_and_top(spark):
    df = spark.createDataFrame([(f"A{n % 12:02d}",) for n in range(30)] + [(None,)] * 9, "asset string")
    top = rows(tl.top_assets(df))
    assert top == [(f"A{n:02d}", 3) for n in range(6)] + [(f"A{n:02d}", 2) for n in range(6, 10)]
    assert rows(tl.top_assets(df, 2)) == top[:2]
    assert tl.asset_counts(df).count() == 12
    assert "TakeOrderedAndProject" in tl.top_assets(df)._jdf.queryExecution().executedPlan().toString()


# --- histograms ----------------------------------------------------------------------


def pandas_bars(values, bins):
    cut = pd.cut(pd.Series(values, dtype="float64").dropna(), bins=bins, include_lowest=True)
    return [(str(interval), int(count)) for interval, count in cut.value_counts().sort_index().items()]


def test_two_bins(spark):
    bars = rows(tl.close_histogram(closes(spark, [1, 2, 3, 4, 5], "int"), bins=2))
    assert [(bar[3], bar[4]) for bar in bars] == [("(0.995, 3.0]", 3), ("(3.0, 5.0]", 2)]
    assert [(bar[0], bar[1], bar[2]) for bar in bars] == [(1, 0.996, 3.0), (2, 3.0, 5.0)]


@pytest.mark.parametrize("seed", range(6))
def test_histogram_like_pandas(spark, seed):
    pick = random.Random(seed)
    scale = 10 ** pick.randint(-4, 6)
    values = [round(pick.gauss(0, 1) * scale, 3 + seed) for _ in range(500)]
    values += [None, NAN] + values[:50]
    bins = pick.choice([1, 2, 5, 10, 33])
    bars = rows(tl.close_histogram(closes(spark, values), bins))
    expected = pandas_bars(values, bins)
    assert [bar[4] for bar in bars] == [count for _, count in expected]
    assert [bar[3] for bar in bars] == [label for label, _ in expected]


def test_values_on_the_edges(spark):
    values = list(np.linspace(0.0, 0.7, 8)) * 3
    bars = rows(tl.close_histogram(closes(spark, [float(v) for v in values]), 7))
    assert [bar[4] for bar in bars] == [count for _, count in pandas_bars(values, 7)]


def test_empty_bins_are_kept(spark):
    bars = rows(tl.close_histogram(closes(spark, [1.0, 1.1, 100.0])))
    assert [bar[4] for bar in bars] == [2, 0, 0, 0, 1]


def test_single_price_and_none(spark):
    assert rows(tl.close_histogram(closes(spark, [2.5, 2.5, None]))) == [(1, 2.5, 2.5, "2.50", 2)]
    for values in ([], [None, NAN]):
        bars = tl.close_histogram(closes(spark, values))
        assert bars.isEmpty() and bars.columns == ["bin", "lower", "upper", "label", "count"]
    assert tl.close_histogram(closes(spark, ["x"], "string")).isEmpty()


def test_histogram_arguments(spark):
    with pytest.raises(KeyError):
        tl.close_histogram(closes(spark, [1.0]).withColumnRenamed("close", "price"))
    with pytest.raises(ValueError):
        tl.close_histogram(closes(spark, [1.0]), bins=0)


def test_magnitudes(spark):
    """Each power of ten and the numbers next to it."""
    edges = [v for k in (1, 2, 4) for v in (10**k - 1, 10**k, 10**k + 1)]
    df = spark.createDataFrame([(v,) for v in (*edges, -7, 0)], "volume int")
    assert rows(tl.volume_magnitude(df)) == [("1e0", 1), ("1e1", 3), ("1e2", 2), ("1e3", 1), ("1e4", 2), ("<=0", 2)]


def test_magnitudes_of_odd_values(spark):
    values = [str(10.0**k) for k in range(-5, 19)] + ["-3", "0", None, "NaN", "x", "9.99", "0.5"]
    df = spark.createDataFrame([(v,) for v in values], "volume string")
    expected = {f"1e{k}": 1 for k in range(-5, 19)} | {"<=0": 2}
    expected["1e0"] += 1
    expected["1e-1"] += 1
    found = rows(tl.volume_magnitude(df))
    assert dict(found) == expected
    assert [label for label, _ in found] == sorted(expected)
    with pytest.raises(KeyError):
        tl.volume_magnitude(df, "other")
    assert tl.volume_magnitude(df.limit(0)).isEmpty()


def test_magnitude_matches_log10(spark):
    pick = random.Random(3)
    values = [10 ** pick.uniform(-8, 17) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "volume double")
    expected = pd.Series([f"1e{math.floor(math.log10(v))}" for v in values]).value_counts()
    assert dict(rows(tl.volume_magnitude(df))) == expected.to_dict()


# --- report --------------------------------------------------------------------------

GOOD = "date,asset,close,volume\n2024-01-02,PETR4,37.5,100\n2024-01-03,VALE3,70.0,0\n"


def test_checks(spark, tmp_path):
    table = tl.read_table_csv(spark, str(write_text(tmp_path / "t.csv", GOOD)))
    checks = tl.quality_checks(table)
    assert checks.columns == ["check", "ok"]
    assert rows(checks) == [
        ("precos_positivos", True), ("sem_nulos_nucleares", True), ("ativos_disponiveis", True),
    ]
    with pytest.raises(KeyError):
        tl.quality_checks(table.drop("volume"))


def test_validate(spark, tmp_path):
    report = tl.validate(spark, str(write_text(tmp_path / "t.csv", GOOD)))
    assert report.ok and report.require() is report and report.rows == 2
    assert rows(report.summary) == [(2, 2, date(2024, 1, 2), date(2024, 1, 3))]
    assert rows(report.zero_activity) == [("VALE3", 1)]
    assert [bar[4] for bar in rows(report.close_histogram)] == [1, 0, 0, 0, 1]
    assert rows(report.volume_magnitude) == [("1e2", 1), ("<=0", 1)]
    assert rows(report.top_assets) == [("PETR4", 1), ("VALE3", 1)]


@pytest.mark.parametrize(
    "line, failed",
    [
        ("2024-01-04,ABEV3,-1,5", ["precos_positivos"]),
        ("2024-01-04,ABEV3,,5", ["precos_positivos", "sem_nulos_nucleares"]),
        (",ABEV3,1,5", ["sem_nulos_nucleares"]),
        ("2024-01-04,ABEV3,1,", ["sem_nulos_nucleares"]),
        ("2024-01-04,ABEV3,1,NaN", ["sem_nulos_nucleares"]),
        ("2024-01-04,ABEV3,1,many", ["sem_nulos_nucleares"]),
        ("some day,ABEV3,1,5", ["sem_nulos_nucleares"]),
        ("2024-01-04,ABEV3,NaN,5", ["precos_positivos", "sem_nulos_nucleares"]),
    ],
)
def test_failing_tables(spark, tmp_path, line, failed):
    path = write_text(tmp_path / "t.csv", GOOD + line + "\n")
    report = tl.validate(spark, str(path))
    assert not report.ok and list(report.failed) == failed
    assert [name for name, ok in rows(report.checks) if not ok] == failed
    assert report.summary.first()["rows"] == 3 and report.top_assets.count() == 3
    assert report.close_histogram.count() == 5 and report.zero_activity.count() >= 1
    with pytest.raises(tl.QualityError) as error:
        report.require()
    assert str(error.value) == f"failed checks: {', '.join(failed)}"
    with pytest.raises(tl.QualityError):
        tl.require_quality(tl.read_table_csv(spark, str(path)))


def test_no_assets(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", "date,asset,close,volume\n2024-01-04,,1,5\n")
    with pytest.raises(tl.QualityError, match="ativos_disponiveis"):
        tl.validate(spark, str(path)).require()


def test_empty_table_passes(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", "date,asset,close,volume\n")
    with pytest.warns(UserWarning, match="empty"):
        report = tl.validate(spark, str(path))
    assert report.ok and report.close_histogram.isEmpty()


def test_empty_table_without_core_columns_passes(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", "date,asset\n")
    with pytest.warns(UserWarning, match="empty"):
        assert tl.validate(spark, str(path)).ok
    with pytest.warns(UserWarning, match="empty"):
        tl.require_quality(tl.read_table_csv(spark, str(path)))
    with pytest.raises(KeyError):
        tl.validate(spark, str(write_text(tmp_path / "u.csv", "date,asset\n2024-01-02,PETR4\n")))


def test_report_reads_the_table_once_per_part(spark, tmp_path):
    table = tl.read_table_csv(spark, str(write_text(tmp_path / "t.csv", GOOD)))
    report = tl.quality_report(table)
    for part in (report.summary, report.checks):
        assert "FileScan" not in part._jdf.queryExecution().executedPlan().toString()
    for part in (report.zero_activity, report.close_histogram, report.volume_magnitude, report.top_assets):
        assert part._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_infinite_numbers_are_one_stated_error(spark):
    with pytest.raises(ValueError, match="infinite"):
        tl.close_histogram(closes(spark, [1.0, float("inf")]))
    with pytest.raises(PySparkException, match="infinite"):
        tl.volume_magnitude(closes(spark, [float("inf")]), "close").collect()


@pytest.mark.parametrize("bins", [3, 7, 50, 1000])
def test_every_edge_falls_into_its_own_bin(spark, bins):
    low, high = 0.1, 97.3
    step = (high - low) / bins
    edges = [i * step + low for i in range(1, bins)]
    values = sorted({low, high, *edges, *(math.nextafter(e, 0) for e in edges), *(math.nextafter(e, 1e9) for e in edges)})
    found = {row[0]: row[4] for row in rows(tl.close_histogram(closes(spark, values), bins))}
    want = {}
    for v in values:
        number = next((i + 1 for i, e in enumerate(edges) if v <= e), bins)
        want[number] = want.get(number, 0) + 1
    assert {k: n for k, n in found.items() if n} == want


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tl.validate(spark, str(tmp_path / "none.csv"))


def test_require_quality_gives_the_table(spark, tmp_path):
    table = tl.read_table_csv(spark, str(write_text(tmp_path / "t.csv", GOOD)))
    assert tl.require_quality(table) is table
