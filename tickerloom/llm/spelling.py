"""Spelling variants of words, found with k-d trees over letter-count vectors (operator 12).

A word's vector counts each of its letters.  One replaced letter moves two counts
by one, so words of equal length that are one edit apart lie at an L1 distance of
two; one letter more moves one count.  Range searches of that radius, for each
pair of lengths, therefore find all candidates, and letter order is verified after.

A k-d tree for every length, cut on a bounded sample of the words, divides the
words into cells.  A word stands in its own cell and is sent, as a query, to the
cells whose box a near word can lie in.  Large cells are laid out over a grid of
blocks of words and parts of queries, in which each pair meets once.  Every block
has a k-d tree of its own, searched by all its queries together.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import column, saved

#: Fixed value: the letters of a word, in order, by code point; A-Z count as a-z.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
#: Words that a task counts before it passes them on.
COUNTED = 300_000
#: Words whose vectors cut the cells, at most, and the longest of them; longer words have one cell for each length.
SAMPLE_ROWS = 100_000
SAMPLE_CHARS = 64
#: Words of a cell, as the sample tells; of a block; queries of a part.
CELL = 32_768
BLOCK = 65_536
PART = 100_000
#: Queries of a block that are answered together; fewer if they are long.
ASKED = 65_536
#: Words in a leaf of a block's own tree; more have equal vectors, and beyond the second number variants are looked up.
LEAF = 16
LOOKED_UP = 256
#: Letters compared at a time.
AT_ONCE = 1 << 23

_LOWER = {upper: upper + 32 for upper in range(65, 91)}
_DIMENSION = np.zeros(0x100, np.int64)
_DIMENSION[LETTERS] = np.arange(len(LETTERS))


def word_counts(
    docs: DataFrame, *, text: str = "text", id: str = "doc_id", least_chars: int = 7, drop_every: int | None = 31
) -> DataFrame:
    """``word`` and ``n`` for the runs of letters in all texts that have ``least_chars`` code points.

    A-Z are lower-cased.  With ``drop_every``, a run loses the code point
    ``h % length`` where h, the crc32 of ``<id>:<run>``, is divisible by it.  A
    null id counts as empty; null texts have no words.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_chars)
        tally: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(tally.keys(), pa.string()), pa.array(tally.values(), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for doc_id, one in zip(batch.column(0), batch.column(1)):
                if not one.is_valid:
                    continue
                seed = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
                found: Counter[str] = Counter()
                for run, n in Counter(runs.findall(one.as_py())).items():
                    found[run.translate(_LOWER)] += n
                for run, n in found.items():
                    if drop_every:
                        h = zlib.crc32(run.encode(), seed)
                        if h % drop_every == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < least_chars:
                                continue
                    tally[run] += n
                if len(tally) >= COUNTED:
                    yield rows()
                    tally.clear()
        if tally:
            yield rows()

    read = docs.select(column(docs, id).cast("string"), column(docs, text))
    return read.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points, of which none is over 255."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each row; cut off at 255, which brings no two vectors further apart."""
    out = np.empty((len(codes), len(LETTERS)), np.uint8)
    step = max(1, AT_ONCE // max(1, codes.shape[1]))
    for at in range(0, len(codes), step):
        some = _DIMENSION[codes[at : at + step]]
        some += np.arange(len(some))[:, None] * len(LETTERS)
        counts = np.bincount(some.ravel(), minlength=len(codes[at : at + step]) * len(LETTERS))
        out[at : at + step] = np.minimum(counts, 255).reshape(-1, len(LETTERS))
    return out


def odd_letters(rows: np.ndarray) -> np.ndarray:
    """Bits of the first 64 letters that occur an odd number of times."""
    return np.packbits(rows[:, :64] & 1, axis=1).view(np.uint64).ravel()


class Tree:
    """A k-d tree whose leaves hold at most ``capacity`` of the given vectors, unless these are all equal."""

    def __init__(self, rows: np.ndarray, capacity: float, *, tight: bool = False):
        #: The box that is searched: of these vectors alone, or of any.
        self.least = rows.min(axis=0) if tight else np.zeros(rows.shape[1], np.uint8)
        self.most = rows.max(axis=0) if tight else np.full(rows.shape[1], 255, np.uint8)
        #: Per inner node the dimension, the last count of its low side, and its children; leaves are ~number.
        self.nodes: list[tuple[int, int, int, int]] = []
        #: The given rows of each leaf.
        self.leaves: list[np.ndarray] = []
        self.root = self._cut(rows, np.arange(len(rows)), capacity)

    def _cut(self, rows: np.ndarray, some: np.ndarray, capacity: float) -> int:
        if len(some) > capacity:
            own = rows[some]
            spread = own.var(axis=0, dtype=np.float32)
            dim = int(spread.argmax())
            if spread[dim] > 0:
                values = np.sort(own[:, dim])
                cut = int(values[(len(values) - 1) // 2])
                if cut == values[-1]:
                    cut = int(values[np.searchsorted(values, cut) - 1])
                low = own[:, dim] <= cut
                at = len(self.nodes)
                self.nodes.append((dim, cut, 0, 0))
                children = self._cut(rows, some[low], capacity), self._cut(rows, some[~low], capacity)
                self.nodes[at] = (dim, cut, *children)
                return at
        self.leaves.append(some)
        return ~(len(self.leaves) - 1)

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls into."""
        out = np.zeros(len(rows), np.int64)
        stack = [(self.root, np.arange(len(rows)))]
        while stack:
            node, some = stack.pop()
            if node < 0:
                out[some] = ~node
            elif len(some):
                dim, cut, low, high = self.nodes[node]
                below = rows[some, dim] <= cut
                stack += [(low, some[below]), (high, some[~below])]
        return out

    def reached(self, rows: np.ndarray, over: int, under: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, with the vectors that exceed their box by ``over`` at most and fall short by ``under`` at most.

        Together these are the L1 distance from the box, kept up to date along
        the one dimension that a step down the tree narrows.
        """
        more = np.maximum(rows, self.most) - self.most
        less = np.maximum(rows, self.least) - rows
        more, less = more.sum(axis=1, dtype=np.int16), less.sum(axis=1, dtype=np.int16)
        some = np.flatnonzero((more <= over) & (less <= under))
        stack = [(self.root, some, more[some], less[some], self.least.astype(np.int16), self.most.astype(np.int16))]
        while stack:
            node, some, more, less, lo, hi = stack.pop()
            if node < 0:
                if len(some):
                    yield ~node, some
                continue
            dim, cut, low, high = self.nodes[node]
            at = rows[some, dim].astype(np.int16)
            top = hi.copy()
            top[dim] = min(hi[dim], cut)
            moved = more + np.maximum(at - top[dim], 0) - np.maximum(at - hi[dim], 0)
            keep = moved <= over
            if keep.any():
                stack.append((low, some[keep], moved[keep], less[keep], lo, top))
            bottom = lo.copy()
            bottom[dim] = max(lo[dim], cut + 1)
            moved = less + np.maximum(bottom[dim] - at, 0) - np.maximum(lo[dim] - at, 0)
            keep = moved <= under
            if keep.any():
                stack.append((high, some[keep], more[keep], moved[keep], bottom, hi))


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Per pair of rows of code points: exactly one replaced, or with a longer second word one inserted."""
    size = short.shape[1]
    if long.shape[1] == size:
        return (short != long).sum(axis=1) == 1
    head = np.cumprod(short == long[:, :size], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    tail = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return head + tail >= size


class Block:
    """Words of one length, searched by words of that length or one letter less."""

    def __init__(self, words: list[str]):
        self.words = words
        self.codes = letters(words)
        self.rows = vectors(self.codes)
        self.tree = Tree(self.rows, LEAF, tight=True)
        self.odd = odd_letters(self.rows)
        self.places: dict[int, dict[str, int]] = {}

    def _by_lookup(self, leaf: int, query: str, row: np.ndarray) -> list[int]:
        """Near words in a leaf of equal vectors: the letter that comes and the one that goes are known."""
        if leaf not in self.places:
            self.places[leaf] = {self.words[k]: k for k in self.tree.leaves[leaf]}
        change = self.rows[self.tree.leaves[leaf][0]].astype(np.int64) - row
        comes, goes = np.flatnonzero(change > 0), np.flatnonzero(change < 0)
        if change[comes].sum() != 1 or -change[goes].sum() != (len(query) == self.codes.shape[1]):
            return []
        new = chr(LETTERS[comes[0]])
        if len(goes):
            old = chr(LETTERS[goes[0]])
            made = {query[:i] + new + query[i + 1 :] for i, letter in enumerate(query) if letter == old}
        else:
            made = {query[:i] + new + query[i:] for i in range(len(query) + 1)}
        return [self.places[leaf][word] for word in made if word in self.places[leaf]]

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query, by its place, and a word of this block one edit away."""
        codes = letters(queries)
        rows = vectors(codes)
        odd = odd_letters(rows)
        equal = codes.shape[1] == self.codes.shape[1]
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []
        for leaf, some in self.tree.reached(rows, int(equal), 1):
            held = self.tree.leaves[leaf]
            if len(held) > LOOKED_UP or codes.shape[1] * len(held) > AT_ONCE:
                for query in some:
                    found = self._one_by_one(leaf, held, queries[query], rows[query])
                    left.append(np.full(len(found), query))
                    right.append(np.array(found, np.int64))
                continue
            step = max(1, AT_ONCE // (len(held) * codes.shape[1]))
            for at in range(0, len(some), step):
                asked = some[at : at + step]
                a, b = np.repeat(asked, len(held)), np.tile(held, len(asked))
                # Letters that occur an odd number of times: at most two differ.
                close = np.bitwise_count(odd[a] ^ self.odd[b]) <= 2
                a, b = a[close], b[close]
                good = one_edit(codes[a], self.codes[b])
                left.append(a[good])
                right.append(b[good])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(left), np.concatenate(right)

    def _one_by_one(self, leaf: int, held: np.ndarray, query: str, row: np.ndarray) -> list[int]:
        if len(query) < 255:
            return self._by_lookup(leaf, query, row)
        # Of long words, counts cut off at 255 don't say which letter changes, and the words to look up are many.
        code = letters([query])
        return [int(k) for k in held if one_edit(code, self.codes[k : k + 1])[0]]


def _cells(words: DataFrame, sample_rows: int, cell: int) -> dict[int, Tree]:
    """A tree for each length with more words than a cell holds, cut on a sample that is picked by hash."""
    short = words.filter(F.col("chars") <= SAMPLE_CHARS)
    totals = dict(short.groupBy("chars").agg(F.count(F.lit(1))).collect())  # SAMPLE_CHARS rows at most
    large = [chars for chars, n in totals.items() if n > cell]
    if not large:
        return {}
    sample = short.filter(F.col("chars").isin(large)).orderBy(F.xxhash64("word"), "word").limit(sample_rows)
    by_length: dict[int, list[str]] = {}
    for row in sample.select("chars", "word").collect():
        by_length.setdefault(row["chars"], []).append(row["word"])
    share = sum(map(len, by_length.values())) / sum(totals[chars] for chars in large)
    return {
        chars: Tree(vectors(letters(sorted(some))), max(1.0, share * cell)) for chars, some in by_length.items()
    }


def _routed(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Every word as an entry of its cell, and as a query of the cells that a near word can stand in.

    Of two cells of one length the words of the first are sent to the second;
    words are sent to the cells of the next length, not back.
    """
    # The leaves' rows of the sample aren't needed to find the way.
    for tree in trees.values():
        tree.leaves = []

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars = batch.column("chars").to_numpy()
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

            def put(rows: np.ndarray, cells: np.ndarray, query: bool, home: bool) -> None:
                out.append((rows, cells, np.full(len(rows), query), np.full(len(rows), home)))

            for size in np.unique(chars).tolist():
                own = np.flatnonzero(chars == size)
                tree, longer = trees.get(size), trees.get(size + 1)
                base, above = size << 24, (size + 1) << 24
                if tree or longer:
                    found = vectors(letters(batch.column("word").take(pa.array(own)).to_pylist()))
                leaf = tree.leaf_of(found) if tree else np.zeros(len(own), np.int64)
                put(own, base + leaf, False, True)
                put(own, base + leaf, True, True)
                if tree:
                    for other, some in tree.reached(found, 1, 1):
                        some = some[leaf[some] < other]
                        put(own[some], np.full(len(some), base + other), True, False)
                if longer:
                    for other, some in longer.reached(found, 0, 1):
                        put(own[some], np.full(len(some), above + other), True, False)
                else:
                    put(own, np.full(len(own), above), True, False)
            rows, cells, query, home = (np.concatenate(x) for x in zip(*out, strict=True))
            for at in range(0, len(rows), 10_000):
                some = slice(at, at + 10_000)
                taken = batch.take(pa.array(rows[some]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[some]), pa.array(query[some]), pa.array(home[some]), taken.column("word"), taken.column("n")],
                    names=["cell", "query", "home", "word", "n"],
                )

    return words.select("word", "n", "chars").mapInArrow(
        sent, "cell bigint, query boolean, home boolean, word string, n bigint"
    )


def _met(block: Block, counts: np.ndarray, queries: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways, of a block's words and of queries to it."""
    rows = pa.Table.from_batches(queries)
    words = np.array(rows.column("word").to_pylist(), object)
    chars = np.array([len(word) for word in words])
    own_counts, home = rows.column("n").to_numpy(), rows.column("home").to_numpy()
    names = np.array(block.words, object)
    for size in np.unique(chars):
        same = np.flatnonzero(chars == size)
        step = max(1, AT_ONCE // int(size))
        for at in range(0, len(same), step):
            own = same[at : at + step]
            a, b = block.near(words[own].tolist())
            a = own[a]
            left, right = words[a], names[b]
            once = ~home[a] | (left < right)  # in its own cell a pair is met from both sides
            left, right, n, m = left[once], right[once], own_counts[a][once], counts[b][once]
            if len(left):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([left, right]), pa.string()),
                        pa.array(np.concatenate([right, left]), pa.string()),
                        pa.array(np.concatenate([m, n]), pa.int64()),
                    ],
                    names=["word", "near", "near_n"],
                )


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways, from rows sorted by cell, block and part, entries before queries."""
    key, size = None, 0
    held: list[pa.RecordBatch] = []
    asked: list[pa.RecordBatch] = []
    block = None

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal block, size
        if asked and held:
            if block is None:
                n = np.concatenate([x.column("n").to_numpy() for x in held])
                block = Block([word for x in held for word in x.column("word").to_pylist()]), n
            yield from _met(*block, asked)
        asked.clear()
        size = 0

    for batch in batches:
        if not batch.num_rows:
            continue
        cell, number, part, query = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "block", "part", "query"))
        turn = np.zeros(len(cell), bool)
        for values in (cell, number, part, query):
            turn[1:] |= values[1:] != values[:-1]
        edges = [0, *np.flatnonzero(turn).tolist(), len(cell)]
        for lo, hi in zip(edges, edges[1:]):
            if key != (now := (cell[lo], number[lo], part[lo])):
                yield from flush()
                key, held, block = now, [], None
            rows = batch.slice(lo, hi - lo)
            if not query[lo]:
                held.append(rows)
                continue
            asked.append(rows)
            size += len(rows) * max(1, int(cell[lo] >> 24) // SAMPLE_CHARS)
            if size >= ASKED:
                yield from flush()
    yield from flush()


def near_words(
    words: DataFrame, *, sample_rows: int = SAMPLE_ROWS, cell: int = CELL, block: int = BLOCK, part: int = PART
) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for all ordered pairs of ``words`` (``word``, ``n``, distinct) one edit apart.

    The words must be made of ``LETTERS``.  ``sample_rows``, ``cell``, ``block``
    and ``part`` say how the work is laid out, not which pairs come out.
    """
    sized = words.select("word", "n", F.length("word").alias("chars")).filter("chars > 0")
    routed = saved(_routed(sized, _cells(sized, sample_rows, cell)), "routed_words")
    counted = routed.groupBy("cell").agg(
        F.sum(F.when(F.col("query"), 0).otherwise(1)).alias("entries"),
        F.sum(F.when(F.col("query"), 1).otherwise(0)).alias("queries"),
    )
    # One row per cell, so no more than leaves and lengths.
    cells = saved(
        counted.filter("entries > 0 AND queries > 0").select(
            "cell",
            # A block of long words holds fewer of them.
            F.ceil(F.col("entries") * F.greatest(F.lit(1.0), F.shiftright("cell", 24) / SAMPLE_CHARS) / block)
            .cast("int")
            .alias("blocks"),
            F.ceil(F.col("queries") / part).cast("int").alias("parts"),
        ),
        "word_cells",
    )
    salt = F.xxhash64("word")
    own_block, own_part = F.pmod(salt, F.col("blocks")).cast("int"), F.pmod(salt, F.col("parts")).cast("int")
    grid = F.when(F.col("query"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("parts") - 1)
    )
    laid = (
        routed.join(cells, "cell")
        .withColumn("other", F.explode(grid))
        .select(
            "cell",
            F.when(F.col("query"), F.col("other")).otherwise(own_block).alias("block"),
            F.when(F.col("query"), own_part).otherwise(F.col("other")).alias("part"),
            "query",
            "home",
            "word",
            "n",
        )
    )
    # So many tasks that few groups share one, as their work goes by queries rather than bytes.
    groups = cells.agg(F.sum(F.col("blocks") * F.col("parts"))).first()[0] or 1
    tasks = min(groups, 4 * int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = laid.repartition(tasks, "cell", "block", "part").sortWithinPartitions("cell", "block", "part", "query")
    return met.mapInArrow(_searched, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for links ``word``, ``form`` without a cycle: where following the links ends.

    Every round doubles the steps that a link spans, and is written.
    """
    state = saved(forms.select("word", F.col("form").alias("root")), "word_links")
    while True:
        further = state.select(F.col("word").alias("via"), F.col("root").alias("end"))
        if not state.join(further, state["root"] == further["via"], "left_semi").limit(1).count():
            return state
        joined = state.join(further, state["root"] == further["via"], "left")
        state = saved(joined.select("word", F.coalesce("end", "root").alias("root")), "word_links")


def variant_groups(
    docs: DataFrame,
    *,
    text: str = "text",
    id: str = "doc_id",
    least_chars: int = 7,
    least_count: int = 2,
    ratio: int = 10,
    drop_every: int | None = 31,
) -> DataFrame:
    """Per word of the texts ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are the runs of letters with ``least_chars`` code points that occur
    ``least_count`` times over all texts.  A word's ``form`` is the near word
    (one edit away) that occurs most, of equal ones the first in code-point
    order, if it occurs ``ratio`` times as often as the word; ``root`` is where
    the forms end.  Null and empty texts have no words, repeated rows count each
    time, a null id counts as empty, other columns are left out, and an empty
    table gives an empty one.
    """
    counts = word_counts(docs, text=text, id=id, least_chars=least_chars, drop_every=drop_every)
    words = saved(counts.filter(F.col("n") >= least_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    holds = -F.col("best.less") >= ratio * F.col("n")
    described = saved(
        joined.select(
            "word",
            F.when(holds, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(holds, -F.col("best.less")).alias("form_n"),
        ),
        "word_forms",
    )
    ends = roots(described.filter(F.col("form").isNotNull()).select("word", "form"))
    return described.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
