"""Quality rules as one projection (operator 1).

A table of thresholds over ratios of length, symbols, stop words and lines is
compiled into a single expression next to the counts it uses.  All of it is
built-in functions on one row at a time: no shuffle, no user functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import column, fresh

SPACES = " \t\n\x0b\x0c\r"
GAPS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on", "with", "be", "as", "by", "are",
    "this", "at", "from", "or", "an", "have", "not", "which",
    "de", "la", "le", "les", "et", "des", "en", "un", "une", "du", "que", "qui", "dans", "par", "pour", "est", "sur",
    "pas", "au", "avec",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "ist", "im", "dem", "nicht", "ein", "eine",
    "als", "auch", "es",
    "el", "los", "las", "y", "del", "se", "por", "con", "no", "una", "su", "para", "al", "lo", "como", "o", "si",
)


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; an open end is None."""

    measure: str
    low: float | None = None
    high: float | None = None


#: Production thresholds. The measures are defined in ``quality_measures``.
RULES = (
    Rule("mean_word_chars", 1.5, 20.0),
    Rule("symbols_per_word", None, 0.3),
    Rule("stop_word_share", 0.02, None),
    Rule("dup_line_share", None, 0.5),
    Rule("bullet_line_share", None, 0.9),
    Rule("ellipsis_line_share", None, 0.3),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pairs(hashes: Column, step: int) -> Column:
    """Hashes of windows twice as long, from those of windows ``step`` long."""
    n = F.size(hashes) - step
    return F.zip_with(
        F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(step + 1), n), lambda x, y: F.xxhash64(x, y)
    )


def repeated_window_words(words: Column, n_words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text, each word once.

    Windows are compared by 64-bit hashes; only texts with an equal pair sort them.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    eights = let(hashes, lambda h: let(_pairs(h, 1), lambda h2: let(_pairs(h2, 2), lambda h4: _pairs(h4, 4))))

    def covered(windows: Column) -> Column:
        placed = F.sort_array(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        twice = let(
            placed,
            lambda s: F.filter(
                s,
                lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
            ),
        )
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        steps = let(
            starts,
            lambda p: F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    counted = let(
        eights,
        lambda h8: F.when(F.size(F.array_distinct(h8)) == F.size(h8), F.lit(0).cast("long")).otherwise(covered(h8)),
    )
    return F.when(n_words < 2 * 1 + WINDOW - 1, F.lit(0).cast("long")).otherwise(counted)


def quality_measures(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the struct column ``m`` of counts and ratios of the text; null counts as empty.

    Counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines
    (with a word), n_stop_words.  Ratios of nothing are 0.
    """
    body, words, part = (fresh([*docs.columns, "m"], name) for name in ("_body", "_words", "_part"))
    whole = F.coalesce(text, F.lit(""))
    bare = docs.withColumn(body, whole).withColumn(words, F.split(F.btrim(body, F.lit(SPACES)), GAPS))
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    n_words = F.when(F.btrim(body, F.lit(SPACES)) == "", 0).otherwise(F.size(words))

    def line_counts(found: Column) -> Column:
        return F.struct(
            F.size(found).alias("n"),
            (F.size(found) - F.size(F.array_distinct(found))).alias("dup"),
            F.size(F.filter(found, lambda x: F.btrim(x, F.lit(SPACES)).rlike(r"^[-*•‣◦·]"))).alias("bullet"),
            F.size(F.filter(found, lambda x: F.btrim(x, F.lit(SPACES)).rlike(r"(\.\.\.|…)$"))).alias("ellipsis"),
        )

    counted = bare.withColumn(
        part,
        F.struct(
            n_words.cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            repeated_window_words(column(bare, words), n_words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            let(lines, line_counts).alias("lines"),
        ),
    )
    p = column(counted, part)

    def ratio(over: Column, under: Column) -> Column:
        return F.when(under > 0, over / under).otherwise(0.0)

    measures = F.struct(
        p["n_words"].alias("n_words"),
        p["word_chars"].alias("word_chars"),
        p["n_symbols"].alias("n_symbols"),
        p["lines"]["dup"].cast("long").alias("n_dup_lines"),
        p["n_repeat_words"].alias("n_repeat_words"),
        p["lines"]["n"].cast("long").alias("n_lines"),
        p["n_stop_words"].alias("n_stop_words"),
        ratio(p["word_chars"], p["n_words"]).alias("mean_word_chars"),
        ratio(p["n_symbols"], p["n_words"]).alias("symbols_per_word"),
        ratio(p["n_stop_words"], p["n_words"]).alias("stop_word_share"),
        ratio(p["lines"]["dup"], p["lines"]["n"]).alias("dup_line_share"),
        ratio(p["lines"]["bullet"], p["lines"]["n"]).alias("bullet_line_share"),
        ratio(p["lines"]["ellipsis"], p["lines"]["n"]).alias("ellipsis_line_share"),
    )
    return counted.withColumn("m", measures).drop(body, words, part)


def compile_rules(measures: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules as one boolean expression."""
    passed = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            passed = passed & (measures[rule.measure] >= rule.low)
        if rule.high is not None:
            passed = passed & (measures[rule.measure] <= rule.high)
    return passed


def quality_verdicts(
    docs: DataFrame, *, text: str = "text", id: str = "doc_id", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Per row its id, the counts, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 20 words, or over 30 of 100 words in repeated
    windows.  ``kept`` also needs every rule.  Null and empty texts fail;
    repeated rows and null ids stay; other columns are left out; an empty table
    gives an empty one.
    """
    narrow = docs.select(column(docs, id).alias("doc_id"), column(docs, text).alias("text"))
    m = F.col("m")
    measured = quality_measures(narrow, F.col("text")).drop("text")
    failed = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
    return measured.select(
        "doc_id",
        *(m[name].alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        failed.alias("base_failed"),
        (~failed & compile_rules(m, rules)).alias("kept"),
        *(m[rule.measure].alias(rule.measure) for rule in rules),
    )
