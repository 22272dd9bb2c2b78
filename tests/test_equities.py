"""Market-code filters."""

import pytest

import tickerloom as tl
from tests.helpers import rows


def test_keeps_regular_equities(spark):
    """One row for each reason to go, and every tidy-up of a ticker."""
    kept = {"\tsola 4": "SOLA4", "Lumi3": "LUMI3", "FOZ 11 ": "FOZ11"}
    data = [("02", ticker, spec) for ticker, spec in zip(kept, ("PN  EJ  N2", "ON", "UNT     N1"))]
    data += [("78", "MARE3", "ON"), ("12", "NORD4", "PN"), ("02", "QUAR34", "BDR")]
    quotes = spark.createDataFrame(data, "BDI string, asset string, spec string")
    assert sorted(row["asset"] for row in tl.equity_filter(quotes).collect()) == sorted(kept.values())


def test_nulls_and_blanks(spark):
    quotes = spark.createDataFrame(
        [
            (" 02 ", "a b c 3", None),
            ("02", None, "ON"),
            (None, "X", "ON"),
            ("02", "Y", " BDR "),
            ("02", "Z", "BDR N1"),
            ("2", "W", "ON"),
            ("02", "\xa0açã3\t", "bdr"),
        ],
        "BDI string, asset string, spec string",
    )
    found = {row["asset"] for row in tl.equity_filter(quotes).collect()}
    assert found == {"ABC3", None, "Z", "AÇÃ3"}


def test_spec_is_optional(spark):
    quotes = spark.createDataFrame([("02", "x")], "BDI string, asset string")
    assert rows(tl.equity_filter(quotes)) == [("02", "X")]


@pytest.mark.parametrize("schema", ["asset string", "BDI string"])
def test_required_columns(spark, schema):
    with pytest.raises(KeyError):
        tl.equity_filter(spark.createDataFrame([("x",)], schema))


def test_asset_classes(spark):
    quotes = spark.createDataFrame([("02",), (" 96",), ("12",), (None,)], "BDI string")
    table = {"02": "round lot", "96": "odd lot"}
    assert [row["asset_class"] for row in tl.asset_classes(quotes, table, "other").collect()] == [
        "round lot", "odd lot", "other", "other",
    ]
    assert tl.asset_classes(quotes, {}).where("asset_class is null").count() == 4
    with pytest.raises(KeyError):
        tl.asset_classes(quotes.drop("BDI"), table)
