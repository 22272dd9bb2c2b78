"""Dated price factors, against a plain loop."""

from datetime import date, timedelta

import pytest

import tickerloom as tl
from tests.helpers import rows

DAY = date(2030, 1, 1)


def test_prices_take_every_later_factor(spark):
    quotes = [(f"A{n % 3}", DAY + timedelta(n), 64.0 + n, n) for n in range(60)] + [(None, DAY, 1.0, 99), ("B", None, 2.0, 98)]
    factors = [
        ("A0", DAY + timedelta(10), 0.5), ("A0", DAY + timedelta(30), 0.25), ("A0", DAY + timedelta(30), 2.0),
        ("A1", DAY + timedelta(12), 4.0), (None, DAY, 9.0), ("A1", None, 9.0), ("A1", DAY, None), ("C", DAY, 3.0),
    ]
    found = tl.adjust_prices(
        spark.createDataFrame(quotes, "asset string, date date, close double, id int"),
        spark.createDataFrame(factors, "asset string, date date, factor double"),
    )
    want = []
    for asset, day, close, number in quotes:
        for other, since, factor in factors:
            if asset is not None and asset == other and None not in (day, since, factor) and day < since:
                close *= factor
        want.append((asset, day, close, number))
    assert found.columns == ["asset", "date", "close", "id"]
    assert sorted(rows(found), key=lambda r: r[3]) == sorted(want, key=lambda r: r[3])


def test_columns_and_empty_tables(spark):
    quotes = spark.createDataFrame([("A", "20300101", 2.0, 3.0)], "asset string, date_raw string, close double, open double")
    factors = spark.createDataFrame([("A", "2030-02-01", 0.5)], "asset string, date string, factor double")
    assert rows(tl.adjust_prices(quotes, factors, ["close", "open"])) == [("A", "20300101", 1.0, 1.5, DAY)]
    assert rows(tl.adjust_prices(quotes, factors.limit(0))) == [("A", "20300101", 2.0, 3.0, DAY)]
    assert tl.adjust_prices(quotes.limit(0), factors).isEmpty()
    with pytest.raises(KeyError):
        tl.adjust_prices(quotes, factors.drop("factor"))
    with pytest.raises(KeyError):
        tl.adjust_prices(quotes, factors, ["high"])
