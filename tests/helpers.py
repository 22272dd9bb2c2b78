"""Builders of small inputs."""

from __future__ import annotations

from pathlib import Path

import tickerloom as tl

LINE_WIDTH = 245
DEFAULTS = {
    "date_raw": "20310514", "BDI": "02", "asset": "QUAR3", "spec": "ON      N2", "close": 2050, "volume_shares": 31,
    "volume_brl": 63550,
}
SHORT = {"date": "date_raw", "bdi": "BDI", "shares": "volume_shares", "brl": "volume_brl"}


def quote_line(record: str = "01", **given: object) -> str:
    """A record laid out as ``QUOTE_LAYOUT`` says; numbers are zero-padded, texts put in as they are."""
    values = DEFAULTS | {SHORT.get(name, name): value for name, value in given.items()}
    line = record.ljust(LINE_WIDTH)
    for field in tl.QUOTE_LAYOUT.fields:
        value = values[field.name]
        text = str(value).rjust(field.width, "0") if isinstance(value, int) else str(value).ljust(field.width)
        before, after = field.position - 1, field.last
        line = line[:before] + text[: field.width] + line[after:]
    return line


# A week of made-up quotes: members, a paper outside the regular market, a receipt, two non-members.
SAMPLE_LINES = [
    quote_line(asset="SOLA4", spec="PN      N2", close=870, shares=40, brl=34800),
    quote_line(asset="LUMI3", close=15025, shares=12, brl=180300),
    quote_line(asset="LUMI3", bdi="78", close=14000, shares=1, brl=14000),
    quote_line(date="20310515", asset="FOZ11", spec="UNT     N2", close=4400, shares=5, brl=22000),
    quote_line(date="20310515", asset="NORD3", close=99, shares=1000, brl=99000),
    quote_line(date="20310515", asset="MARE3", spec="BDR", close=6200, shares=3, brl=18600),
    quote_line(date="20310516", asset="VALE9", close=77, shares=8, brl=616),
]

SAMPLE_PORTFOLIO = "Peso;Codigo\n3;sola4\n9;LUMI3\n\n6; foz11\n1;MARE3\n"
SAMPLE_PERIOD = "IBOV_2031-05-01_2031-08-29.csv"


def write_lines(path: Path, lines: list[str], newline: str = "\n") -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("".join(line + newline for line in lines).encode("latin-1"))
    return path


def write_text(path: Path, text: str) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8"))
    return path


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]
