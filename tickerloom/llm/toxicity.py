"""Toxicity scores from a weighted lexicon (operator 3).

Texts are folded first: compatibility and look-alike letters become Latin ones,
and digits and signs that stand for letters inside a word become these letters.
One Aho-Corasick automaton then finds the words of the lexicon and the
exception phrases in a single pass; a word inside an exception phrase does not
count.  The summed weights, plain and relative to the length, go through a
logistic curve.  An entry is a word or a stem, which matches the beginning of a longer
word.  Lexicon, weights, curve and the exceptions beyond a few fixed ones are
learned from labelled texts: a hit together with the word before or after it is
an exception if clean texts have it again and again and toxic ones hardly do.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import column, fit_logistic, is_held_out, labelled_sample, sigmoid

# Letters that look like Latin ones, in pairs.
_LOOK_ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s",
    "ј": "j", "к": "k", "м": "m", "т": "t", "н": "h", "в": "b", "ԁ": "d", "ո": "n", "ց": "g",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u",
    "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ⅼ": "l",
}
# Signs that stand for letters inside a word.
_STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

_FOLD = str.maketrans(_LOOK_ALIKE)
_SIGNS = str.maketrans(_STANDS_FOR)
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
# A stretch of letters and such signs that begins and ends like a word and has a letter in it.
_MIXED = re.compile(r"(?<![^\W_])(?=[0134578@$]*[a-z])[a-z0134578@$]*[0134578@$][a-z0134578@$]*(?<![$@])(?![^\W_])")
_BEYOND_LATIN = re.compile("[^\x00-\u02ff]")
_TOKEN = re.compile(r"[^\W\d_]{2,}")
# The rest of a word, and the words next to one, a blank apart.
_REST = re.compile(r"[^\W_]*")
_BEFORE = re.compile(r"(?<![^\W_])([^\W_]+) $")
_AFTER = re.compile(r" ([^\W_]+)")

DEFAULT_EXCEPTIONS = (
    "clown fish", "trash can", "trash bag", "trash bin", "sore loser", "idiot proof", "not stupid",
)


def fold(text: str) -> str:
    """Lower case, with look-alikes and stand-in signs replaced by the letters they mean."""
    if not text.isascii():
        if _BEYOND_LATIN.search(text):
            text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
            text = text.lower().translate(_FOLD)
        elif "\u00ad" in text:
            text = text.replace("\u00ad", "")
    text = text.lower()
    return _MIXED.sub(lambda m: m.group().translate(_SIGNS), text)


class Matcher:
    """Weighted hits of a lexicon in folded texts."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        entries: dict[str, dict[bool, float | None]] = {}
        for word, weight in lexicon.items():
            entries.setdefault(word.removesuffix("*"), {})[word.endswith("*")] = weight
        for phrase in exceptions:
            entries.setdefault(fold(phrase), {})[False] = None
        for word, kinds in entries.items():
            self.automaton.add_word(word, (len(word), tuple(kinds.items())))
        self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, end and weight of the words and stems found outside exception phrases."""
        hits, spared = [], []
        for last, (length, kinds) in self.automaton.iter(folded):
            start, end = last + 1 - length, last + 1
            if start and folded[start - 1].isalnum():
                continue
            inside = folded[end : end + 1].isalnum()
            for stem, weight in kinds:
                if stem != inside:  # a stem goes on, a word ends
                    continue
                if weight is None:
                    spared.append((start, end))
                else:
                    hits.append((start, end, weight))
        if spared:
            spared.sort()
            kept, at, reach = [], 0, -1
            for start, end, weight in sorted(hits):
                while at < len(spared) and spared[at][0] <= start:
                    reach = max(reach, spared[at][1])
                    at += 1
                if end > reach:
                    kept.append((start, end, weight))
            hits = kept
        return hits

    def total(self, folded: str) -> float:
        """Sum of the weights of the hits."""
        return math.fsum(weight for _, _, weight in self.hits(folded))

    def features(self, text: str | None) -> tuple[float, float]:
        """Hit weight, damped; and hit weight per square root of the length in words of six letters."""
        if not text:
            return 0.0, 0.0
        total = self.total(fold(text))
        return math.log1p(total), total / math.sqrt(10 + len(text) / 6)


@dataclass(frozen=True)
class ToxicityModel:
    """A lexicon of at most ``max_words`` words and stems (ending in ``*``), the exception phrases and three numbers."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...]
    weights: tuple[float, float]
    intercept: float

    def digest(self) -> str:
        """Tells models of different entries apart."""
        return hashlib.sha1(repr((sorted(self.lexicon.items()), self.exceptions)).encode()).hexdigest()

    def score(self, features: tuple[float, float]) -> float:
        return sigmoid(sum(w * x for w, x in zip(self.weights, features, strict=True)) + self.intercept)


def _entries(text: str) -> set[str]:
    """The words of a folded text and their beginnings of 4 to 8 letters, marked by a star."""
    found = set(_TOKEN.findall(text))
    stems = {f"{word[:n]}*" for word in found for n in range(4, min(9, len(word)))}
    return found | stems


def _learn_lexicon(toxic: list[str], clean: list[str], max_words: int, min_share: float) -> dict[str, float]:
    """Words and stems far more frequent in toxic texts, picked greedily by the toxic texts not yet explained.

    The texts are folded.  The weight is the log odds of a text with the entry;
    an entry must be in ``min_share`` of the toxic texts and add as much to those
    explained.  Only entries that can still be picked are kept per text.
    """
    least = max(2, math.ceil(min_share * len(toxic)))
    inside = Counter()
    for text in toxic:
        inside.update(_entries(text))
    inside = {entry: n for entry, n in inside.items() if n >= least}
    outside = Counter()
    for text in clean:
        outside.update(entry for entry in _entries(text) if entry in inside)
    weights = {
        entry: math.log((n + 0.5) / (len(toxic) + 1)) - math.log((outside[entry] + 0.5) / (len(clean) + 1))
        for entry, n in inside.items()
    }
    weights = {entry: w for entry, w in weights.items() if w > math.log(8)}
    texts_of: dict[str, set[int]] = {entry: set() for entry in weights}
    for i, text in enumerate(toxic):
        for entry in _entries(text):
            if entry in weights:
                texts_of[entry].add(i)
    found = Counter()
    picked: dict[str, float] = {}
    while len(picked) < max_words and texts_of:
        # A text counts fully while no picked word is in it, then less and less.
        gain = {word: sum(0.6 ** found[i] for i in ids) * weights[word] for word, ids in texts_of.items()}
        word = min(gain, key=lambda w: (-gain[w], w))
        ids = texts_of.pop(word)
        if sum(0.6 ** found[i] for i in ids) < least:
            continue
        picked[word] = round(weights[word], 6)
        found.update(ids)
    return picked


def _learn_exceptions(
    matcher: Matcher, toxic: list[str], clean: list[str], max_phrases: int, least: int = 3
) -> tuple[str, ...]:
    """Hits with the word before or after them that ``least`` clean texts have, and ten times the share of toxic ones.

    The texts are folded.  Phrases in most clean texts come first, equal ones by name.
    """
    counts = []
    for texts in (clean, toxic):
        inside = Counter()
        for text in texts:
            phrases = set()
            for start, end, _ in matcher.hits(text):
                word = text[start : end + len(_REST.match(text, end).group())]
                if before := _BEFORE.search(text, max(0, start - 40), start):
                    phrases.add(f"{before[1]} {word}")
                if after := _AFTER.match(text, start + len(word)):
                    phrases.add(f"{word} {after[1]}")
            inside.update(phrases)
        counts.append(inside)
    clean_of, toxic_of = counts
    learned = [
        phrase
        for phrase, n in clean_of.items()
        if n >= least and n / len(clean) >= 10 * toxic_of[phrase] / len(toxic)
    ]
    return tuple(sorted(learned, key=lambda phrase: (-clean_of[phrase], phrase))[:max_phrases])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    rows_per_class: int = 3000,
    max_bytes: int = 65_536,
    max_words: int = 256,
    min_share: float = 0.01,
    exceptions: tuple[str, ...] = DEFAULT_EXCEPTIONS,
    max_exceptions: int = 64,
) -> ToxicityModel:
    """Trains on a bounded sample (see ``labelled_sample``); held-out ids are never read.

    Up to ``max_exceptions`` phrases are learned besides the given ``exceptions``.

    The curve is fitted on the same texts, weighted to the shares of the labels
    in the whole table.  Without an example of both labels the score is the
    share of label 1 among the training labels.
    """
    sample, share = labelled_sample(docs, labels, label, rows_per_class, max_bytes)
    side = {mark: [text for text, m in sample if m == mark] for mark in (0, 1)}
    odds = min(max(share, 1e-3), 1 - 1e-3)
    none = ToxicityModel({}, (), (0.0, 0.0), math.log(odds / (1 - odds)))
    if not (side[0] and side[1]):
        return none
    toxic, clean = ([fold(text) for text in side[mark]] for mark in (1, 0))
    lexicon = _learn_lexicon(toxic, clean, max_words, min_share)
    if not lexicon:
        return none
    learned = _learn_exceptions(Matcher(lexicon, exceptions), toxic, clean, max_exceptions)
    exceptions = (*exceptions, *(phrase for phrase in learned if phrase not in exceptions))
    matcher = Matcher(lexicon, exceptions)
    rows = [(matcher.features(text), mark) for mark in (0, 1) for text in side[mark]]
    x = np.array([features for features, _ in rows])
    y = np.array([mark for _, mark in rows], float)
    prior = {1: share, 0: 1 - share}
    weight = np.array([prior[m] * len(rows) / len(side[m]) for _, m in rows])
    *weights, intercept = map(float, fit_logistic(x, y, weight, ridge=1e-1))
    return ToxicityModel(lexicon, exceptions, tuple(weights), intercept)


_matchers: dict[str, Matcher] = {}


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """The probability of label 1 for a text column; null scores as empty."""
    key = model.digest()

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not model.lexicon:
            return pa.array([model.score((0.0, 0.0))] * len(texts), pa.float64())
        if key not in _matchers:
            _matchers.clear()
            _matchers[key] = Matcher(model.lexicon, model.exceptions)
        matcher = _matchers[key]
        return pa.array([model.score(matcher.features(t.as_py())) for t in texts], pa.float64())

    return score(text)


def toxicity_scores(
    docs: DataFrame, model: ToxicityModel, *, text: str = "text", id: str = "doc_id", at: float = 0.7
) -> DataFrame:
    """Per row its id, whether it is held out, the score and the label predicted at ``at``.

    Null and empty texts get the score of a text without hits.  Repeated rows
    and null ids (never held out) stay, other columns are left out, and an empty
    table gives an empty one.
    """
    scored = docs.select(
        column(docs, id).alias("doc_id"),
        is_held_out(column(docs, id)).alias("held_out"),
        toxicity_score(column(docs, text), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= at).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, *, text: str = "text", at: float = 0.7) -> DataFrame:
    """The rows, all columns as they are, that score below ``at``.

    Null and empty texts score as texts without hits; repeated rows go or stay
    together; an empty table gives an empty one.
    """
    return docs.filter(toxicity_score(column(docs, text), model) < at)
