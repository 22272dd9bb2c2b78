"""Index portfolio files."""

import gzip
from datetime import date

import pytest

import tickerloom as tl
from tests.helpers import SAMPLE_PERIOD, SAMPLE_PORTFOLIO, rows, write_text
from tickerloom.sources import listing

START, END = date(2033, 2, 1), date(2033, 5, 30)


def test_tickers_and_blank_lines(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", SAMPLE_PORTFOLIO)
    table = tl.scan_portfolio(spark, str(path), START, END, infer_types=True)
    assert table.columns == ["asset", "start", "end", "Peso", "Codigo"]
    assert rows(table.select("asset", "Peso", "start", "end").orderBy("Peso")) == [
        ("MARE3", 1, START, END), ("SOLA4", 3, START, END), ("FOZ11", 6, START, END), ("LUMI3", 9, START, END),
    ]


def test_marks_inside_quotes_do_not_separate(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", '"Codigo";"Peso, kg: ""net"""\nSOLA4;"1;5"\n')
    table = tl.scan_portfolio(spark, str(path), START, END)
    assert table.columns == ["asset", "start", "end", "Codigo", 'Peso, kg: "net"'] or len(table.columns) == 5
    assert rows(table.select("asset")) == [("SOLA4",)]


@pytest.mark.parametrize("mark", [",", ";", "\t", " ", ":"])
def test_delimiters(spark, tmp_path, mark):
    path = write_text(tmp_path / "p.csv", f"Peso{mark}Código\n10{mark}PETR4\n")
    table = tl.scan_portfolio(spark, str(path), START, END, infer_types=True)
    assert rows(table.select("asset", "Peso")) == [("PETR4", 10)]


def test_first_delimiter_of_the_list_wins(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", "Codigo,Qtde Teorica,Part %\nPETR4,4347501920,4.8429\n")
    table = tl.scan_portfolio(spark, str(path), START, END, infer_types=True)
    assert rows(table.select("asset", "`Qtde Teorica`", "`Part %`")) == [
        ("PETR4", 4347501920, 4.8429)
    ]


@pytest.mark.parametrize("label", ["CÓDIGO", "codigo", " Co digo"])
def test_label_of_the_ticker_column(spark, tmp_path, label):
    path = write_text(tmp_path / "p.csv", f"Peso;{label}\n1;PETR4\n")
    assert tl.scan_portfolio(spark, str(path), START, END).first()["asset"] == "PETR4"


@pytest.mark.parametrize(
    ("text", "period", "kind"),
    [
        ("Papel;Peso\nQuartzo;1\n", (START, END), ValueError),
        ("Codigo\nSOLA4\n", (END, START), ValueError),
        ("\n \n", (START, END), ValueError),
        (None, (START, END), FileNotFoundError),
    ],
    ids=["no ticker column", "inverted period", "blank file", "no file"],
)
def test_unfit_files(spark, tmp_path, text, period, kind):
    path = tmp_path / "p.csv"
    if text is not None:
        write_text(path, text)
    with pytest.raises(kind):
        tl.scan_portfolio(spark, str(path), *period)


def test_periods_come_from_names(spark, tmp_path, caplog):
    folder = tmp_path / "some folder"
    write_text(folder / SAMPLE_PERIOD, SAMPLE_PORTFOLIO)
    write_text(folder / "IBOV_2031-08-30_2031-12-30.csv", "Codigo;Peso\nNORD3;2\n")
    write_text(folder / "IBOV_draft.csv", "Codigo;Peso\nKILO3;2\n")
    write_text(folder / "IBOV_2031-08-30.csv", "Codigo;Peso\nKILO4;2\n")
    write_text(folder / "notes" / "y=1" / "a.txt", "x")
    write_text(folder / "more" / "b.txt", "x")
    found = rows(tl.scan_members(spark, str(folder)).select("asset", "start", "end"))
    first = (date(2031, 5, 1), date(2031, 8, 29))
    assert sorted(found) == [
        ("FOZ11", *first), ("LUMI3", *first), ("MARE3", *first), ("NORD3", date(2031, 8, 30), date(2031, 12, 30)),
        ("SOLA4", *first),
    ]
    assert "IBOV_draft.csv" in caplog.text and "IBOV_2031-08-30.csv" in caplog.text


def test_mixed_headers(spark, tmp_path):
    write_text(tmp_path / "IBOV_2024-01-02_2024-04-02.csv", "Codigo,Tipo,Peso\r\nPETR4,PN,3\r\n")
    write_text(tmp_path / "IBOV_2024-05-02_2024-08-02.csv", "Codigo;Peso;Extra.1\nVALE3;alto;2\n")
    write_text(tmp_path / "IBOV_2024-09-02_2024-12-02.csv", "Codigo;Peso;Extra.1\nITUB4;5;\n")
    table = tl.scan_members(spark, str(tmp_path), infer_types=True)
    assert sorted(rows(table.select("asset", "Tipo", "Peso", "`Extra.1`")), key=str) == [
        ("ITUB4", None, "5", None), ("PETR4", "PN", "3", None), ("VALE3", None, "alto", 2),
    ]


def test_text_only_scan(spark, tmp_path):
    write_text(tmp_path / "IBOV_2024-01-02_2024-04-02.csv", "Codigo,Peso\nPETR4,03\n")
    table = tl.scan_members(spark, str(tmp_path))
    assert rows(table.select("asset", "Peso")) == [("PETR4", "03")]


def test_headers_are_read_alone(spark, tmp_path, monkeypatch):
    """No Spark job runs before the table is used; a compressed part and an empty one are read as well."""
    folder = tmp_path / "IBOV_2033-02-01_2033-05-30.csv"
    folder.mkdir()
    (folder / "part-0.csv.gz").write_bytes(gzip.compress(b"\n \nCodigo;Peso\nSOLA4;3\n"))
    write_text(folder / "part-1.csv", "Codigo;Peso\nLUMI3;4\n")
    write_text(folder / "part-2.csv", "")
    write_text(folder / "below" / "part-3.csv", "Codigo\nNORD3\n")
    seen = listing.first_lines(spark, [str(folder / name) for name in ("part-0.csv.gz", "part-1.csv", "part-2.csv")])
    assert seen == ["Codigo;Peso", "Codigo;Peso", None]
    monkeypatch.setattr(type(spark.read), "text", None)
    found = tl.scan_members(spark, str(tmp_path))
    assert sorted(rows(found.select("asset", "Peso"))) == [("LUMI3", "4"), ("SOLA4", "3")]


def test_listing_needs_a_classic_session():
    with pytest.raises(RuntimeError, match="Connect"):
        listing.entries(object(), "/tmp")


@pytest.mark.parametrize(
    ("files", "kind"),
    [
        (None, FileNotFoundError),
        ({"IBOV_2031-02-02_2031-01-02.csv": "Codigo\nSOLA4\n"}, ValueError),
        ({"IBOV_2031-02-30_2031-03-30.csv": "Codigo\nSOLA4\n"}, ValueError),
        ({SAMPLE_PERIOD: SAMPLE_PORTFOLIO, "IBOV_2031-09-01_2031-12-30.csv": ""}, ValueError),
    ],
    ids=["no folder", "inverted", "no such day", "blank"],
)
def test_unfit_folders(spark, tmp_path, files, kind):
    for name, text in (files or {}).items():
        write_text(tmp_path / "in" / name, text)
    with pytest.raises(kind):
        tl.scan_members(spark, str(tmp_path / "in"))


def test_part_files(spark, tmp_path):
    folder = tmp_path / "with blank" / "IBOV_2024-01-02_2024-04-02.csv"
    write_text(folder / "part-0.csv", "Codigo,Peso\nPETR4,3\n")
    write_text(folder / "part-1.csv", "Codigo,Peso\nVALE3,4\n")
    write_text(folder / "_SUCCESS", "")
    table = tl.scan_members(spark, str(tmp_path / "with blank"), infer_types=True)
    assert sorted(rows(table.select("asset", "start", "Peso"))) == [
        ("PETR4", date(2024, 1, 2), 3), ("VALE3", date(2024, 1, 2), 4),
    ]
    write_text(folder / "part-2.csv", "Codigo,Tipo\nITUB4,PN\n")
    with pytest.raises(ValueError):
        tl.scan_members(spark, str(tmp_path / "with blank"))


def test_no_portfolio_is_an_empty_table(spark, tmp_path):
    write_text(tmp_path / "README.txt", "ignore")
    table = tl.scan_members(spark, str(tmp_path))
    assert table.columns == ["asset", "start", "end"] and table.isEmpty()


def test_own_columns_named_like_ours(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", "Codigo;asset;Start\nPETR4;other;x\n")
    table = tl.scan_portfolio(spark, str(path), START, END)
    assert rows(table) == [("PETR4", START, END, "PETR4")]
