"""Line deduplication by winnowing over line hashes (operator 4).

A document is read as the sequence of hashes of its lines that hold a word.  A
window is a shortest run of lines with at least ``min_words`` words, from each
line forwards and from each line backwards.  Every window selects its least line
hash, of equal ones the last.  Equal windows select the same line, so the
selected lines, far fewer than the windows, are fingerprints that no repeated
window escapes.  They are written with their surroundings: the lines that a
window around them can reach.

Positions are joined on the selected hash, and those whose hash stands in one
place alone go.  The others are extended both ways, line by line, to the windows
that selected them, and each extended window is compared by a hash of all its
lines.  Extended against the first place alone, a run would be missed whose lines
occurred before, but not there, since a line often stands in several
surroundings; against all places, a common line would give pairs in the square
of its places.  Grouped by the window they extend to, each surrounding has a
first place of its own, and the work is linear in the positions.  Overlapping
matched windows make the repeated run.  Its lines are deleted everywhere but in
the first place (by document id, then position).

So a line goes exactly if it lies in a run of at least ``min_words`` words that
has occurred before, and every deleted line has an equal one that stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import column, fresh, saved
from tickerloom.llm.quality_rules import GAPS, SPACES, let

MIN_WORDS = 50
#: Repeated fingerprints that are broadcast at most; more are joined by shuffling.
BROADCAST_ROWS = 1_000_000


def _lines(text: Column) -> Column:
    """The lines with a word: place p, words w, hash h."""
    placed = F.transform(
        F.split(text, "\n"),
        lambda line, p: let(
            F.btrim(line, F.lit(SPACES)),
            lambda bare: F.struct(
                p.alias("p"),
                F.when(bare == "", 0).otherwise(F.size(F.split(bare, GAPS))).alias("w"),
                F.xxhash64(bare).alias("h"),
            ),
        ),
    )
    return F.filter(placed, lambda line: line["w"] > 0)


def _shortest(lines: Column, first: Column, min_words: int, step: int) -> Column:
    """How many lines from the one at ``first`` (0-based), taken in direction ``step``, hold ``min_words`` words; 0: none.

    Every line has a word, so no more than ``min_words`` lines are looked at.
    """
    ahead = F.size(lines) - 1 - first if step > 0 else first
    reached = F.aggregate(
        F.sequence(F.lit(0), F.least(F.lit(min_words - 1), ahead)),
        F.struct(F.lit(0).alias("w"), F.lit(0).alias("n")),
        lambda got, k: F.when(got["w"] >= min_words, got).otherwise(
            F.struct(
                (got["w"] + F.get(lines, first + step * k)["w"]).alias("w"),
                (got["n"] + 1).alias("n"),
            )
        ),
    )
    return let(reached, lambda got: F.when(got["w"] >= min_words, got["n"]).otherwise(0))


def _windows(lines: Column, min_words: int) -> Column:
    """The distinct windows of a document: fingerprint f, hash g of all lines, first and last place."""

    def cut(start: Column, n: Column) -> Column:
        return let(
            F.slice(lines, start + 1, n),
            lambda part: F.struct(
                F.array_min(F.transform(part, lambda x: x["h"])).alias("f"),
                F.xxhash64(F.transform(part, lambda x: x["h"])).alias("g"),
                F.get(part, F.lit(0))["p"].alias("a"),
                F.get(part, n - 1)["p"].alias("b"),
            ),
        )

    none = F.lit(None).cast("struct<f:bigint,g:bigint,a:int,b:int>")

    def at(i: Column) -> Column:
        forwards = let(_shortest(lines, i, min_words, 1), lambda n: F.when(n > 0, cut(i, n)).otherwise(none))
        backwards = let(
            _shortest(lines, i, min_words, -1), lambda n: F.when(n > 1, cut(i - n + 1, n)).otherwise(none)
        )
        return F.array(forwards, backwards)

    everywhere = F.flatten(F.transform(lines, lambda _, i: at(i)))
    enough = F.aggregate(lines, F.lit(0), lambda total, x: total + x["w"]) >= min_words
    return F.when(enough, F.array_distinct(F.filter(everywhere, lambda w: w.isNotNull())))


def _selected(lines: Column, min_words: int) -> Column:
    """The distinct indices of the lines that windows select."""

    def least(start: Column, n: Column) -> Column:
        hashes = F.transform(F.slice(lines, start + 1, n), lambda x, k: F.struct(x["h"].alias("h"), (-k).alias("k")))
        return F.when(n > 0, start - F.array_min(hashes)["k"])

    def at(i: Column) -> Column:
        forwards = let(_shortest(lines, i, min_words, 1), lambda n: least(i, n))
        backwards = let(_shortest(lines, i, min_words, -1), lambda n: least(i - n + 1, n))
        return F.array(forwards, backwards)

    everywhere = F.flatten(F.transform(lines, lambda _, i: at(i)))
    return F.array_distinct(F.filter(everywhere, lambda i: i.isNotNull()))


def _anchor(lines: Column, at: Column, min_words: int) -> Column:
    """A selected line's hash f and place p, and the lines around it that a window with it can hold."""
    last = F.size(lines) - 1
    before = F.when(at > 0, _shortest(lines, at - 1, min_words, -1)).otherwise(0)
    after = F.when(at < last, _shortest(lines, at + 1, min_words, 1)).otherwise(0)
    # Up to the lines that complete a window without the selected one: no window with it reaches further.
    first = let(before, lambda n: F.when(n > 0, at - n).otherwise(0))
    stop = let(after, lambda n: F.when(n > 0, at + n).otherwise(last))

    def around(part: Column) -> Column:
        return F.struct(
            F.get(lines, at)["h"].alias("f"),
            F.get(lines, at)["p"].alias("p"),
            F.transform(part, lambda x: x["p"]).alias("ps"),
            F.transform(part, lambda x: x["w"]).alias("ws"),
            F.transform(part, lambda x: x["h"]).alias("hs"),
        )

    return let(first, lambda lo: let(stop, lambda hi: let(F.slice(lines, lo + 1, hi - lo + 1), around)))


def line_anchors(docs: DataFrame, id: Column, text: Column, min_words: int = MIN_WORDS) -> DataFrame:
    """Per selected line ``id``, ``key`` (hash of the text), hash ``f``, place ``p``, and its surroundings ``ps``, ``ws``, ``hs``."""
    read = docs.select(id.alias("id"), text.alias("text")).filter(F.col("text").isNotNull())
    lined = read.select("id", F.xxhash64("text").alias("key"), _lines(F.col("text")).alias("lines"))
    lines = F.col("lines")
    enough = F.aggregate(lines, F.lit(0), lambda total, x: total + x["w"]) >= min_words
    anchors = let(_selected(lines, min_words), lambda some: F.transform(some, lambda at: _anchor(lines, at, min_words)))
    return lined.filter(enough).select("id", "key", F.explode(anchors).alias("x")).select("id", "key", "x.*")


def repeated_runs(docs: DataFrame, id: Column, text: Column, min_words: int = MIN_WORDS) -> DataFrame:
    """Matched windows that have an earlier copy: ``id``, ``key`` (hash of the text), places ``a`` to ``b``."""
    anchors = saved(line_anchors(docs, id, text, min_words), "line_anchors")
    # Aggregates combine within tasks first, so a passage shared by very many documents is no hot key.
    place = F.struct("id", "key", "p")
    several = saved(
        anchors.groupBy("f")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("f"),
        "repeated_fingerprints",
    )
    few = several.count() <= BROADCAST_ROWS
    met = anchors.join(F.broadcast(several) if few else several, "f", "left_semi")
    lines = F.arrays_zip(F.col("ps").alias("p"), F.col("ws").alias("w"), F.col("hs").alias("h"))
    extended = met.select("id", "key", "f", "p", F.explode(let(lines, lambda x: _windows(x, min_words))).alias("w"))
    selecting = (F.col("w.f") == F.col("f")) & F.col("p").between(F.col("w.a"), F.col("w.b"))
    windows = saved(extended.filter(selecting).select("id", "key", "f", "w.g", "w.a", "w.b"), "line_windows")
    windows = windows.withColumn("place", F.struct("id", "key", "a"))
    matches = (
        windows.groupBy("f", "g").agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select(F.col("f").alias("mf"), F.col("g").alias("mg"), "first")
    )
    same = (F.col("f") == F.col("mf")) & (F.col("g") == F.col("mg"))
    # Both sides are tables, so that adaptive execution can split a window that very many documents share.
    matches = saved(matches, "repeated_windows")
    return windows.join(matches, same & (F.col("place") > F.col("first"))).select("id", "key", "a", "b")


def _kept_places(lines: Column, runs: Column) -> Column:
    """The places of the lines outside all runs, in order; overlapping runs are fine."""
    cut = F.flatten(F.transform(runs, lambda run: F.sequence(run["a"], run["b"])))
    return F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut)


def dedup_lines(
    docs: DataFrame, *, text: str = "text", id: str = "doc_id", min_words: int = MIN_WORDS, removed: str | None = None
) -> DataFrame:
    """``docs`` with repeated runs cut from the text, all columns and rows kept in form.

    ``removed`` names a column to add: the number of lines cut.  Null and empty
    texts and texts under ``min_words`` words stay as they are.  Rows with equal
    id and text count as one place, so both keep or lose the same lines; rows of
    equal id and other text are places of their own, ordered by a hash of the
    text.  A null id comes first.  Other columns may have any names.  An empty
    table gives an empty one.
    """
    runs = repeated_runs(docs, column(docs, id), column(docs, text), min_words)
    cuts = runs.groupBy("id", "key").agg(F.collect_set(F.struct("a", "b")).alias("runs"))
    names = [fresh(docs.columns, name) for name in ("_cut_id", "_cut_key", "_cut_runs")]
    cuts = cuts.toDF(*names)
    whole = column(docs, text)
    # Only the rows of one text meet: the texts are shuffled once, the cuts are narrow.
    joined = docs.join(
        cuts, column(docs, id).eqNullSafe(cuts[names[0]]) & (F.xxhash64(whole) == cuts[names[1]]), "left"
    )
    left = fresh([*docs.columns, *names], "_left")
    parts = F.split(whole, "\n")
    rest = let(
        parts,
        lambda lines: let(
            _kept_places(lines, F.col(names[2])),
            lambda places: F.struct(
                F.array_join(F.transform(places, lambda p: F.get(lines, p)), "\n").alias("text"),
                (F.size(lines) - F.size(places)).alias("lost"),
            ),
        ),
    )
    joined = joined.withColumn(left, F.when(F.col(names[2]).isNotNull(), rest))
    result = [
        F.coalesce(F.col(left)["text"], whole).alias(name) if name == text else column(docs, name)
        for name in docs.columns
    ]
    if removed is not None:
        result.append(F.coalesce(F.col(left)["lost"], F.lit(0)).cast("long").alias(removed))
    return joined.select(*result)
