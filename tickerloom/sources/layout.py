"""Positions of the fields in a fixed-width quote record."""

from __future__ import annotations

from dataclasses import dataclass

KINDS = ("code", "text", "whole", "cents")


@dataclass(frozen=True)
class Field:
    """A slice of the line: 1-based position, width and kind.

    ``code`` is an ASCII token, ``text`` any ISO-8859-1 text, ``whole`` an
    integer and ``cents`` an amount in hundredths.
    """

    name: str
    position: int
    width: int
    kind: str = "text"

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown field kind {self.kind!r}")

    @property
    def is_number(self) -> bool:
        return self.kind in ("whole", "cents")

    @property
    def last(self) -> int:
        return self.position + self.width - 1


@dataclass(frozen=True)
class Layout:
    """Record layout; further fields (open, high, low, ...) are added by the user."""

    fields: tuple[Field, ...]
    record_type: Field
    quote_type: str

    @property
    def min_length(self) -> int:
        return max(field.last for field in self.fields)

    def with_fields(self, *extra: Field) -> Layout:
        return Layout(self.fields + extra, self.record_type, self.quote_type)


# The exchange's quote record (type 01), ISO-8859-1.
QUOTE_LAYOUT = Layout(
    fields=(
        Field("date_raw", 3, 8, "code"),
        Field("BDI", 11, 2, "code"),
        Field("asset", 13, 12),
        Field("spec", 40, 10),
        Field("close", 109, 13, "cents"),
        Field("volume_shares", 153, 18, "whole"),
        Field("volume_brl", 171, 18, "cents"),
    ),
    record_type=Field("record_type", 1, 2, "code"),
    quote_type="01",
)
