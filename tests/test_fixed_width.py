"""Fixed-width quote files."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tickerloom as tl
from tests.helpers import SAMPLE_LINES, quote_line, rows, write_lines
from tickerloom.functions.numbers import cents_to_units, whole_number

COLUMNS = ["date_raw", "BDI", "asset", "spec", "close", "volume_shares", "volume_brl"]


KINDS = ["string"] * 4 + ["double", "bigint", "double"]


def test_every_field_of_every_record_type(spark, tmp_path):
    """A file of headers and trailers only has the same columns as one with quotes."""
    frame = [quote_line(record="00"), quote_line(record="99")]
    for lines, found in ((frame, []), ([frame[0], *SAMPLE_LINES, frame[1]], SAMPLE_LINES)):
        quotes = tl.scan_quote_file(spark, str(write_lines(tmp_path / f"q{len(lines)}.txt", lines)))
        assert [(f.name, f.dataType.simpleString()) for f in quotes.schema] == list(zip(COLUMNS, KINDS))
        got = rows(quotes.orderBy("date_raw", "asset", "BDI"))
        want = sorted(
            (
                line[2:10], line[10:12], line[12:24].strip(), line[39:49].strip(), int(line[108:121]) / 100,
                int(line[152:170]), int(line[170:188]) / 100,
            )
            for line in found
        )
        assert got == sorted(want, key=lambda r: (r[0], r[2], r[1]))


@pytest.mark.parametrize("blank", ["\t \t", "\xa0" * 18, "\x1c\x85 "])
def test_any_blanks_are_zero_and_are_stripped(spark, tmp_path, blank):
    lines = [quote_line(shares=blank, bdi="2\xa0"), quote_line(shares="\xa0\t 41 ")]
    path = write_lines(tmp_path / "q.txt", lines)
    # Some of these characters end a line for text readers that split on them; Spark's does not.
    assert rows(tl.scan_quote_file(spark, str(path)).select("volume_shares", "BDI")) == [(0, "2"), (41, "02")]


def test_missing_file_and_directory(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tl.scan_quote_file(spark, str(tmp_path / "none.txt"))
    with pytest.raises(FileNotFoundError):
        tl.scan_quotes(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        tl.scan_quotes(spark, str(tmp_path))


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_line_ends(spark, tmp_path, newline):
    path = write_lines(tmp_path / "q.txt", SAMPLE_LINES, newline)
    assert tl.scan_quote_file(spark, str(path)).count() == 7


def test_accented_bytes_do_not_shift_fields(spark, tmp_path):
    lines = [quote_line(asset="AÇÃO3", spec="ÉÊÍ ÓÚ  N1"), quote_line(spec="\xa0ON\t")]
    path = write_lines(tmp_path / "q.txt", lines)
    found = rows(tl.scan_quote_file(spark, str(path)).select("asset", "spec", "close", "volume_brl"))
    assert found == [
        ("AÇÃO3", "ÉÊÍ ÓÚ  N1", 20.5, 635.5),
        ("QUAR3", "ON", 20.5, 635.5),
    ]


def test_blank_numbers_are_zero_and_padding_is_ignored(spark, tmp_path):
    lines = [quote_line(close="", shares="   12", brl=""), quote_line(close="      -150")]
    path = write_lines(tmp_path / "q.txt", lines)
    found = rows(tl.scan_quote_file(spark, str(path)).select("close", "volume_shares", "volume_brl"))
    assert found == [(0.0, 12, 0.0), (-1.5, 31, 635.5)]


def test_cents_round_once(spark):
    random.seed(1)
    cents = [random.randrange(10**random.randint(1, 18)) for _ in range(5000)]
    cents += [10**18 - 1, 2**53, 2**53 + 1, 2**53 + 3, 0]
    df = spark.createDataFrame([(f"{value:018d}",) for value in cents], "t string")
    found = df.select(cents_to_units(whole_number(F.col("t")))).collect()
    assert [row[0] for row in found] == [value / 100 for value in cents]


@pytest.mark.parametrize(
    "bad",
    [
        "01 too short",
        "",
        "99" + " " * 100,
        quote_line(close="12A4"),
        quote_line(shares="1_0"),
        quote_line(brl="1.5"),
    ],
)
def test_bad_lines_fail_even_when_only_counted(spark, tmp_path, bad):
    write_lines(tmp_path / "COTAHIST_A2024.TXT", [quote_line(), bad])
    with pytest.raises(PySparkException, match="COTAHIST_A2024.TXT"):
        tl.scan_quotes(spark, str(tmp_path)).count()
    dropped = tl.scan_quotes(spark, str(tmp_path), mode="DROPMALFORMED")
    assert dropped.count() == 1
    report = tl.malformed_lines(spark, str(tmp_path)).collect()
    assert [(row["file"], row["line"]) for row in report] == [("COTAHIST_A2024.TXT", bad)]
    assert report[0]["defect"]


def test_numbers_of_other_records_are_not_checked(spark, tmp_path):
    write_lines(tmp_path / "COTAHIST_1.TXT", [quote_line(record="99", close="n/a"), quote_line()])
    assert tl.scan_quotes(spark, str(tmp_path)).count() == 1
    assert tl.malformed_lines(spark, str(tmp_path)).isEmpty()


def test_unknown_mode(spark, tmp_path):
    write_lines(tmp_path / "COTAHIST_1.TXT", [quote_line()])
    with pytest.raises(ValueError):
        tl.scan_quotes(spark, str(tmp_path), mode="PERMISSIVE")


def test_directory_scan_takes_only_quote_files(spark, tmp_path):
    write_lines(tmp_path / "COTAHIST.A2024.TXT", SAMPLE_LINES)
    write_lines(tmp_path / "COTAHIST_A2025.TXT", [quote_line()])
    write_lines(tmp_path / "cotahist_a2023.txt", [quote_line()])
    write_lines(tmp_path / "notes.TXT", ["notes"])
    quotes = tl.scan_quotes(spark, str(tmp_path), with_file=True)
    assert sorted(rows(quotes.groupBy("file").count())) == [
        ("COTAHIST.A2024.TXT", 7), ("COTAHIST_A2025.TXT", 1),
    ]


def test_file_report_and_listing(spark, tmp_path):
    write_lines(tmp_path / "COTAHIST_B.TXT", [quote_line(record="00"), *SAMPLE_LINES])
    write_lines(tmp_path / "COTAHIST_A.TXT", [quote_line()])
    write_lines(tmp_path / "other.csv", ["a"])
    (tmp_path / "folder").mkdir()
    write_lines(tmp_path / "year=2024" / "COTAHIST_C.TXT", [quote_line()])
    assert rows(tl.quote_file_report(spark, str(tmp_path))) == [
        ("COTAHIST_A.TXT", 1, 1), ("COTAHIST_B.TXT", 8, 7),
    ]
    listed = tl.list_quote_files(spark, str(tmp_path)).select("name", "length")
    assert rows(listed) == [("COTAHIST_A.TXT", 246), ("COTAHIST_B.TXT", 8 * 246)]
    names = [row["name"] for row in tl.list_files(spark, str(tmp_path)).collect()]
    assert names == ["COTAHIST_A.TXT", "COTAHIST_B.TXT", "other.csv"]
    assert tl.list_files(spark, f"file://{tmp_path}/").count() == 3
    write_lines(tmp_path / "plain" / "b.csv", ["b"])
    assert tl.list_files(spark, str(tmp_path)).count() == 3


def test_listing_a_missing_directory_is_empty(spark, tmp_path):
    assert tl.list_files(spark, str(tmp_path / "none")).isEmpty()
    assert tl.list_quote_files(spark, str(tmp_path / "none")).columns == [
        "name", "path", "length", "modified",
    ]


def test_layout_takes_further_fields(spark, tmp_path):
    line = quote_line()
    line = line[:56] + f"{1230000:013d}" + line[69:]
    path = write_lines(tmp_path / "q.txt", [line])
    layout = tl.QUOTE_LAYOUT.with_fields(tl.Field("open", 57, 13, "cents"))
    quotes = tl.scan_quote_file(spark, str(path), layout)
    assert rows(quotes.select("open", "close")) == [(12300.0, 20.5)]
    with pytest.raises(ValueError):
        tl.Field("open", 57, 13, "price")


def test_no_python_in_the_scan(spark, tmp_path):
    write_lines(tmp_path / "COTAHIST_1.TXT", SAMPLE_LINES)
    plan = tl.scan_quotes(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "*(1)" in plan
