"""Quality scores from compressed sizes (operator 10).

Two zstandard dictionaries are trained, one from good and one from bad labelled
texts.  A text that shares the habits of one side compresses better with that
side's dictionary.  The difference of the two sizes over their sum, and how far
the text shrinks without any dictionary (text that repeats itself shrinks far
under both), are turned into a probability by a logistic curve fitted on
labelled texts that went into neither dictionary.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import column, fit_logistic, is_held_out, labelled_sample, sigmoid

LEVEL = 3
#: Long texts are compressed piece by piece, so that the dictionary serves all of the text.
PIECE_BYTES = 16_384
#: Prose keeps at least this share of its bytes when compressed alone.
ORDINARY = 0.3


@dataclass(frozen=True)
class CompressionModel:
    """What scoring needs; 2 * ``dictionary_bytes`` and three numbers."""

    good: bytes
    bad: bytes
    weights: tuple[float, float]
    intercept: float

    def score(self, features: tuple[float, float]) -> float:
        return sigmoid(sum(w * x for w, x in zip(self.weights, features, strict=True)) + self.intercept)


class Sizes:
    """Compressed sizes under the two dictionaries and none."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self.sides = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(raw),
                write_content_size=False,
                write_dict_id=False,
            )
            for raw in (good, bad)
        ]
        self.sides.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))

    def features(self, text: str | None) -> tuple[float, float]:
        """100 * (bad - good) / (bad + good) and 10 * the shrinking beyond ``ORDINARY``; 0 for no text."""
        raw = (text or "").encode()
        if not raw:
            return 0.0, 0.0
        pieces = [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]
        good, bad, alone = (sum(len(side.compress(piece)) for piece in pieces) for side in self.sides)
        return 100 * (bad - good) / (bad + good), 10 * max(0.0, ORDINARY - alone / len(raw))


def _dictionary(texts: list[str], size: int) -> bytes:
    import zstandard

    pieces = [raw[i : i + PIECE_BYTES] for raw in map(str.encode, texts) for i in range(0, len(raw), PIECE_BYTES)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(pieces)[:size]


def fit_compression(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    rows_per_class: int = 3000,
    max_bytes: int = 65_536,
    dictionary_bytes: int = 65_536,
) -> CompressionModel:
    """Trains on a bounded sample (see ``labelled_sample``); held-out ids are never read.

    Half of each class makes its dictionary, the other half the curve, weighted
    to the shares of the labels in the whole table.  Without an example of both
    labels the score is the share of label 1 among the training labels.
    """
    sample, share = labelled_sample(docs, labels, label, rows_per_class, max_bytes)
    side = {mark: [text for text, m in sample if m == mark and text] for mark in (0, 1)}
    if min(map(len, side.values())) < 2:
        odds = min(max(share, 1e-3), 1 - 1e-3)
        return CompressionModel(b"", b"", (0.0, 0.0), float(np.log(odds / (1 - odds))))
    good, bad = (_dictionary(side[mark][::2], dictionary_bytes) for mark in (1, 0))
    sizes = Sizes(good, bad)
    rest = [(sizes.features(text), mark) for mark in (0, 1) for text in side[mark][1::2]]
    x = np.array([features for features, _ in rest])
    y = np.array([mark for _, mark in rest], float)
    prior = {1: share, 0: 1 - share}
    weight = np.array([prior[m] * len(rest) / (len(side[m][1::2])) for _, m in rest])
    *weights, intercept = map(float, fit_logistic(x, y, weight))
    return CompressionModel(good, bad, tuple(weights), intercept)


_sizes: dict[str, Sizes] = {}


def compression_score(text: Column, model: CompressionModel) -> Column:
    """The probability of label 1 for a text column; null scores as empty."""
    key = hashlib.sha1(model.good + b"|" + model.bad).hexdigest()

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not model.good:
            return pa.array([model.score((0.0, 0.0))] * len(texts), pa.float64())
        if key not in _sizes:
            _sizes.clear()
            _sizes[key] = Sizes(model.good, model.bad)
        sizes = _sizes[key]
        return pa.array([model.score(sizes.features(t.as_py())) for t in texts], pa.float64())

    return score(text)


def quality_scores(
    docs: DataFrame, model: CompressionModel, *, text: str = "text", id: str = "doc_id", at: float = 0.5
) -> DataFrame:
    """Per row its id, whether it is held out, the score and the label predicted at ``at``.

    Null and empty texts get the score of no evidence.  Repeated rows and null
    ids (never held out) stay, other columns are left out, and an empty table
    gives an empty one.
    """
    scored = docs.select(
        column(docs, id).alias("doc_id"),
        is_held_out(column(docs, id)).alias("held_out"),
        compression_score(column(docs, text), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= at).cast("int"))
