"""Token counts by the whole-token shortcut (operator 6).

A sentencepiece BPE model whose pieces hold the blank mark at their start only
never merges across the end of a word, and a character that no piece holds
(the line end) never merges at all.  So a text falls into units, a run of
blanks with the word after it, whose counts add up.  Both facts are proved from
the vocabulary when the model is loaded.  Then every vocabulary string is
encoded alone: those that give one token make the table of whole tokens, and
units found there count one without any merging.  Only the rest go through the
library's merges, and a bounded memo keeps their counts.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import column

BLANK = "▁"
UNIT = re.compile(r"\n| *[^ \n]+| +")
#: Counts kept by a worker besides the whole tokens, and the longest unit kept.
MEMO_ENTRIES = 400_000
MEMO_CHARS = 64


class UnitCounter:
    """Counts the tokens of texts as one sentencepiece model does."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = range(self.model.get_piece_size())
        plain = [
            self.model.id_to_piece(i)
            for i in ids
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))
        ]
        self.by_unit = (
            not any(BLANK in piece.lstrip(BLANK) or "\n" in piece for piece in plain)
            and self._keeps_text()
        )
        self.whole = {}
        if self.by_unit:
            for piece in plain:
                unit = piece.replace(BLANK, " ")
                if UNIT.fullmatch(unit) and len(self._encoded([unit])[0]) == 1:
                    self.whole[unit] = 1
            self.whole["\n"] = len(self.model.encode("\n")) - 1  # less the blank put in front
        self.memo = dict(self.whole)

    def _keeps_text(self) -> bool:
        """The model neither folds nor trims: probes with blanks, line ends and compatibility forms."""
        probes = ("  a  b ", "a\nb", "ﬁ½ é", "A\tb c", "　x", "K")
        return all(self.model.decode(self.model.encode(f"\n{p}")) == f"\n{p}" for p in probes)

    def _encoded(self, units: list[str]) -> list[list[int]]:
        """The units without the blank that the model puts before a text."""
        head = len(self.model.encode("\n"))
        return [ids[head:] for ids in self.model.encode([f"\n{u}" for u in units], num_threads=1)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.by_unit:
            return len(self.model.encode(text))
        units = UNIT.findall(" " + text.replace(BLANK, " "))
        memo = self.memo
        try:
            return sum(map(memo.__getitem__, units))
        except KeyError:
            pass
        new = list({unit for unit in units if unit not in memo})
        counts = dict(zip(new, map(len, self._encoded(new)), strict=True))
        total = sum(memo[unit] if unit in memo else counts[unit] for unit in units)
        if len(memo) + len(new) > MEMO_ENTRIES:
            memo = self.memo = dict(self.whole)
        memo.update((unit, n) for unit, n in counts.items() if len(unit) <= MEMO_CHARS)
        return total


_counters: dict[str, UnitCounter] = {}


def unit_counter(model_path: str) -> UnitCounter:
    """One counter per worker process and model."""
    if model_path not in _counters:
        _counters[model_path] = UnitCounter(model_path)
    return _counters[model_path]


def token_count(text: Column, model_path: str) -> Column:
    """Tokens of a text column; null counts as empty."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        counter = unit_counter(model_path)
        return pa.array([counter.count(text.as_py()) for text in texts], pa.int64())

    return count(text)


def token_counts(
    docs: DataFrame, model_path: str, *, text: str = "text", id: str = "doc_id", limit: int = 4096
) -> DataFrame:
    """Per row its id, UTF-8 bytes, tokens and whether they exceed ``limit``.

    Null and empty texts have no bytes and no tokens.  Rows are taken as they
    are: repeated rows and null ids come out as often as they went in, other
    columns are left out, and an empty table gives an empty one.
    """
    whole = F.coalesce(column(docs, text), F.lit(""))
    counted = docs.select(
        column(docs, id).alias("doc_id"),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        token_count(whole, model_path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
