"""Quote files written from the tables, and what scanning them costs."""

import re
from datetime import datetime

import pytest

import __spark_entry__ as entry_point
import tickerloom as tl
from tests.helpers import rows
from tickerloom import trade_tables as tables

JIT_LIMIT = 8000  # bytes of a method from which the JVM only interprets it


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    lines = [
        (k % 9, datetime(1995 + k % 7, 1 + k % 12, 3), "NAR"[k % 3], "FO"[k % 2], 1 + k % 7, 100 + k * 1.37, float(1 + k % 50))
        for k in range(400)
    ]
    kinds = "l_partkey bigint, l_shipdate timestamp, l_returnflag string, l_linestatus string, l_linenumber int"
    kinds += ", l_extendedprice double, l_quantity double"
    spark.createDataFrame(lines, kinds).repartition(3).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def _method_size(spark, df):
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
    found = debug.codegenString(df._jdf.queryExecution().executedPlan())
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", found)))


def test_lines_are_not_sorted_to_be_written(spark, sf_dir):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    tables.write_quote_files(spark, sf_dir)
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    plan = done.apply(done.size() - 1).physicalPlanDescription()
    assert "InsertIntoHadoopFsRelationCommand" in plan and "Sort" not in plan
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_years_beyond_the_open_files(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(tables, "OPEN_FILES", 2)
    quotes = tl.scan_quotes(spark, tables.write_quote_files(spark, sf_dir), with_file=True)
    assert quotes.count() == 400 and quotes.select("file").distinct().count() == 7


def test_packed_files_hold_the_same_quotes(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(tables, "PACKED_LINES", 20)
    plain, packed = (
        tl.scan_quotes(spark, tables.write_quote_files(spark, sf_dir, codec), with_file=True) for codec in ("none", "lz4")
    )
    assert all(path.endswith(".txt") for path in plain.inputFiles())
    assert len(packed.inputFiles()) > len(plain.inputFiles())
    assert sorted(rows(plain)) == sorted(rows(packed)) and packed.count() == 400


@pytest.mark.parametrize("query", ["fixed_width_scan", "layout_fields", "fixed_width_lenient", "malformed_lines"])
def test_scans_of_packed_files(spark, sf_dir, query):
    found = entry_point.queries()[query](spark, sf_dir)
    assert all(path.endswith(".txt.lz4") for path in found.inputFiles())
    assert _method_size(spark, found) < JIT_LIMIT
    bad = sum((round((100 + k * 1.37) * 100) * (1 + k % 50)) % 10 in (3, 5) for k in range(400))
    assert found.count() == {"fixed_width_lenient": 400 - bad, "malformed_lines": bad}.get(query, 400)


def test_a_null_line_is_no_quote(spark):
    lines = spark.createDataFrame([(None,)], "value string")
    for mode in ("FAILFAST", "DROPMALFORMED"):
        assert rows(tl.parse_lines(lines, mode=mode)) == []
