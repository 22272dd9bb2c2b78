"""Packing token pieces into sequences by vector best fit (operator 2).

A piece asks for a vector: its tokens, one document, and the square of its
tokens as attention cost.  A sequence has a capacity in each.  Pieces go, longest
first, to the open sequence whose remaining capacities fit best: the smallest
weighted norm of what would remain, or the largest weighted dot product of
remaining capacity and demand.  Pieces that fit nowhere open new sequences.

A demand depends on the length alone, and there are no more lengths than
tokens in a sequence.  So the choice needs only the number of pieces of each
length, counted by Spark over all pieces, and moves whole groups of sequences in
the same state at once.  Its result says, per length, which ranks go where; each
piece looks its place up by its rank among the pieces of its length.  No piece
passes through the driver, and packing is best fit over the whole corpus.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import column, give_back, saved, small_batches

#: Pieces of one length are ranked in buckets of about so many.
RANKED_TOGETHER = 100_000
#: Words and parts of words a worker keeps ids of, and the longest it keeps: some 250 bytes each, next to an
#: executor's heap, which may have grown to its limit.
MEMO_ENTRIES = 800_000
MEMO_CHARS = 64
#: Characters of text, and then parts of words, that are looked up together.
CHARS_AT_ONCE = 2 << 20
PARTS_AT_ONCE = 200

# Fixed value: how the tokenizer file cuts lower-case text; a file with another pattern is used as a whole.
_SIGNS = ".,;:!?"
_PLAIN = bytes([*range(0x09, 0x0E), *range(0x20, 0x7F)])
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordTokenizer:
    """Token ids as little-endian unsigned 32-bit bytes, exactly as the library gives them.

    The library normalises, lower-cases and cuts text into parts that it encodes
    apart.  Blanks always cut.  Text of Latin letters and plain signs, which
    normalising leaves alone, is therefore looked up word by word in a bounded
    memo, and only new parts go to the library; any other text goes there whole.
    The memo has two halves: a full one becomes the old one, and words in use move
    on to the new one.
    """

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        import json

        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        steps = [step.get("type") for step in (made.get("normalizer") or {}).get("normalizers", [])]
        cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [cut.get("type") for cut in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": _PATTERN}
            and cuts[0]["behavior"] == "Removed"
            and not cuts[1]["add_prefix_space"]
            and made["model"]["type"] == "BPE"
        )
        self.special = [token["content"] for token in made.get("added_tokens", [])]
        self.parts = regex.compile(_PATTERN)
        self.beyond = re.compile("[^\t-\r\x20-\x7e\xa0-\u012f\u0131-\u024f\u2010-\u2026\u20ac]")
        self.memo_entries = memo_entries
        self.forget()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(found.ids, "<u4").tobytes()
            for found in self.library.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _encoded_parts(self, parts: list[str]) -> list[bytes]:
        """Each part alone; many go to the library as one text, cut again after the ids that end a word."""
        groups = [parts[i : i + PARTS_AT_ONCE] for i in range(0, len(parts), PARTS_AT_ONCE)]
        out: list[bytes] = []
        for group, ids in zip(groups, self._encoded([" ".join(group) for group in groups]), strict=True):
            last = np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 1
            if len(last) != len(group):
                out += self._encoded(group)
                continue
            edges = [0, *(4 * last).tolist()]
            out += [ids[i:j] for i, j in zip(edges, edges[1:])]
        return out

    def forget(self) -> None:
        self.memo: dict[str, bytes] = {}  # a part is a word, too, and has the same ids
        self.old: dict[str, bytes] = {}

    def _cut(self, word: str) -> list[str]:
        if word.isalpha():
            return [word]
        # A plain sign after a word of letters, which is most of what isn't letters alone.
        if word[-1:] in _SIGNS and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.parts.findall(word)

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that the newer half of the memo does not have; it keeps them and their parts."""
        memo, old = self.memo, self.old
        found = {word: old[word] for word in words if word in old}
        cut = {word: self._cut(word) for word in words if word not in found}
        order = list({part for parts in cut.values() for part in parts if part not in memo and part not in old})
        found.update(zip(order, self._encoded_parts(order), strict=True))
        for word, parts in cut.items():
            if word not in found:
                found[word] = b"".join(
                    [found[part] if part in found else memo[part] if part in memo else old[part] for part in parts]
                )
        if len(memo) + len(found) > self.memo_entries // 2:
            self.old, self.memo = memo, {}
        self.memo.update((word, ids) for word, ids in found.items() if len(word) <= MEMO_CHARS)
        return found

    def _look_up(self, places: list[int], texts: list[str], out: list[bytes]) -> None:
        """Every distinct word of the texts is looked up once; their ids are then gathered by its number."""
        words = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
        coded = words.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.memo.get, names))
        new = [k for k, ids in enumerate(known) if ids is None]
        if new:
            found = self._learn([names[k] for k in new])
            for k in new:
                known[k] = found[names[k]]
        codes = coded.indices.to_numpy()
        # A character gives a few ids at most, so only a very long text needs wide numbers.
        wide = np.int32 if sum(map(len, texts)) < 1 << 28 else np.int64
        sizes = np.fromiter(map(len, known), wide, len(known)) // 4
        pool = np.frombuffer(b"".join(known), "<u4")
        lengths = sizes[codes]
        ends = np.cumsum(lengths, dtype=wide)
        # Every id of the result, by its place in the pool.
        shift = (np.cumsum(sizes, dtype=wide) - sizes)[codes] - (ends - lengths)
        at = np.repeat(shift, lengths)
        at += np.arange(len(at), dtype=wide)
        ids = pool[at]
        edges = np.concatenate([np.zeros(1, wide), ends])[words.offsets.to_numpy()].tolist()
        for place, lo, hi in zip(places, edges, edges[1:]):
            out[place] = ids[lo:hi].tobytes()

    def _plain(self, text: str) -> bool:
        """Whether normalising leaves the text alone, but for case, and no special token is in it."""
        if text.isascii():
            if text.encode().translate(None, _PLAIN):
                return False
        elif self.beyond.search(text):
            return False
        return not any(token in text for token in self.special)

    def ids_of(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text; null has none."""
        out = [b""] * len(texts)
        places: list[int] = []
        plain: list[str] = []
        size = 0
        for at, text in enumerate(texts):
            if not text:
                continue
            if not self.by_word or not self._plain(text):
                out[at] = self._encoded([text])[0]
                continue
            places.append(at)
            plain.append(text)
            size += len(text)
            if size >= CHARS_AT_ONCE:
                self._look_up(places, plain, out)
                places, plain, size = [], [], 0
        if plain:
            self._look_up(places, plain, out)
        return out

    def ids(self, text: str | None) -> bytes:
        return self.ids_of([text])[0]


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str, memo_entries: int = MEMO_ENTRIES) -> WordTokenizer:
    """One tokenizer per worker process and file, with a memo as the caller wants it."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    _tokenizers[path].memo_entries = memo_entries
    return _tokenizers[path]


def tokenized(
    docs: DataFrame,
    path: str,
    *,
    text: str = "text",
    id: str = "doc_id",
    capacity: int = 2048,
    end: int = 0,
    memo_entries: int = MEMO_ENTRIES,
    forget: bool = False,
) -> DataFrame:
    """Per piece ``doc_id``, ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit).

    A document is its ids with ``end`` after them, cut into pieces of
    ``capacity``; a null text is an empty one.  The ids of about ``CHARS_AT_ONCE``
    characters are in memory at a time, besides the batch that was read.
    ``memo_entries`` bounds the tokenizer's memo, and ``forget`` gives it up after
    every task, for jobs that need the workers' memory more than the time.  What a
    task needed besides goes back to the machine at its end.
    """
    rows = docs.select(column(docs, id).alias("doc_id"), column(docs, text).alias("text"))
    last = np.array([end], "<u4").tobytes()
    step = 4 * capacity

    def cut(doc_ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        found = [ids + last for ids in word_tokenizer(path, memo_entries).ids_of(texts.to_pylist())]
        of = [k for k, ids in enumerate(found) for _ in range(0, len(ids), step)]
        parts = [ids[i : i + step] for ids in found for i in range(0, len(ids), step)]
        number = np.array([i for ids in found for i in range(-(-len(ids) // step))], np.int32)
        return pa.RecordBatch.from_arrays(
            [
                doc_ids.take(pa.array(of, pa.int64())),
                pa.array(number),
                pa.array(number.astype(np.int64) * capacity),
                pa.array([len(part) // 4 for part in parts], pa.int64()),
                pa.array(parts, pa.binary()),
            ],
            names=["doc_id", "piece", "start", "length", "ids"],
        )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(texts):
                done = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, done + CHARS_AT_ONCE)))
                yield cut(doc_ids.slice(at, to - at), texts.slice(at, to - at))
                at = to
        if forget:
            _tokenizers.pop(path, None)
        give_back()

    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return rows.mapInArrow(pieces, schema)


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds, how much each capacity weighs, and the rule that compares (``norm`` or ``dot``).

    By default neither the documents nor the attention cost can run out before
    the tokens do.
    """

    tokens: int = 2048
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    def vector(self) -> np.ndarray:
        return np.array(
            [self.tokens, self.documents or self.tokens, self.cost or self.tokens**2], np.int64
        )


def best_fit(counts: dict[int, int], capacities: Capacities) -> np.ndarray:
    """Where the pieces of each length go, by their rank.

    Rows of (length, first rank, first sequence, pieces per sequence, offset):
    from the first rank on, every run of ``pieces per sequence`` pieces goes to
    the next sequence, from ``offset`` on.  ``counts`` has pieces per length.
    """
    full = capacities.vector()
    weights = np.array(capacities.weights)
    placed: list[tuple[int, int, int, int, int]] = []
    # Open sequences by state: what remains, and the ranges of sequence numbers in that state.
    states = np.zeros((64, 3), np.int64)
    ranges: list[list[tuple[int, int]]] = []
    number: dict[tuple[int, int, int], int] = {}
    opened = 0

    def put(left: np.ndarray, lo: int, hi: int) -> None:
        nonlocal states
        if lo == hi or not left[0] or not left[1] or not left[2]:
            return
        k = number.setdefault(tuple(int(x) for x in left), len(ranges))
        if k == len(ranges):
            ranges.append([])
            if k == len(states):
                states = np.vstack([states, np.zeros_like(states)])
        states[k] = left
        ranges[k].append((lo, hi))

    for length in sorted(counts, reverse=True):
        count, rank = counts[length], 0
        demand = np.array([length, 1, length * length], np.int64)
        if (demand > full).any():
            raise ValueError(f"a piece of {length} tokens does not fit into an empty sequence")
        while rank < count:
            left = states[: len(ranges)]
            fits = np.flatnonzero((left >= demand).all(axis=1))
            if len(fits):
                if capacities.rule == "norm":
                    score = (((left[fits] - demand) / full) ** 2) @ weights
                else:
                    score = -((left[fits] / full) * (demand / full)) @ weights
                k = int(fits[np.argmin(score)])
                state = states[k].copy()
                lo, hi = ranges[k].pop()
                if not ranges[k]:
                    states[k] = 0  # fits nothing until a sequence comes back into this state
            else:
                state, k = full.copy(), -1
            # What a sequence can take of this length; by dot product the next piece may prefer another one.
            each = int((state // demand).min()) if capacities.rule == "norm" else 1
            rest = count - rank
            if k < 0:
                lo = opened
                hi = opened = opened + -(-rest // each)
            many, odd = divmod(rest, each)
            used = min(hi - lo, many)
            offset = int(full[0] - state[0])
            placed.append((length, rank, lo, each, offset))
            put(state - each * demand, lo, lo + used)
            rank += used * each
            lo += used
            if lo < hi and odd and rank < count:
                # The last few pieces share one sequence.
                put(state - odd * demand, lo, lo + 1)
                rank += odd
                lo += 1
            if k >= 0:
                put(state, lo, hi)
    return np.array(sorted(placed), np.int64).reshape(-1, 5)


def _ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """``pieces`` with ``rank``, from 0, among the pieces of their length, by ``row``.

    Ranks are counted within buckets, so that one length may hold most pieces.
    """
    buckets = max(8, rows // RANKED_TOGETHER)
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    before = F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    heads = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    heads = heads.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("head"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    numbered = bucketed.withColumn("within", within)
    return numbered.join(heads, ["length", "bucket"]).withColumn("rank", F.col("head") + F.col("within"))


def pack(pieces: DataFrame, capacities: Capacities = Capacities()) -> DataFrame:
    """``pieces``, which have ``length``, with ``sequence_id`` and ``offset`` added.

    Pieces may repeat.  The rows are written once to number them; only one count
    per length comes to the driver.
    """
    numbered = saved(pieces.withColumn("row", F.monotonically_increasing_id()), "token_pieces")
    counts = {row["length"]: row["n"] for row in numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit(counts, capacities)
    base = 1 << 50  # ranks stay below it, lengths below 2 ** 13

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = (np.asarray(x.to_numpy(zero_copy_only=False), np.int64) for x in (length, rank))
        at = np.searchsorted(plan[:, 0] * base + plan[:, 1], length * base + rank, side="right") - 1
        _, first, sequence, each, offset = plan[at].T
        turn = rank - first
        return pa.StructArray.from_arrays(
            [pa.array(sequence + turn // each), pa.array(offset + turn % each * length)],
            names=["sequence_id", "offset"],
        )

    ranked = _ranked(numbered, sum(counts.values()))
    found = ranked.withColumn("place", place(F.col("length"), F.col("rank")))
    return found.select(
        *(F.col(name) for name in pieces.columns),
        F.col("place.sequence_id").alias("sequence_id"),
        F.col("place.offset").alias("offset"),
    )


def packed_sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves from packed pieces with ``ids``: ``sequence_id``, ``length``, ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_, part: F.concat(all_, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def pack_documents(
    docs: DataFrame,
    path: str,
    *,
    text: str = "text",
    id: str = "doc_id",
    capacities: Capacities = Capacities(),
    with_ids: bool = False,
    memo_entries: int = MEMO_ENTRIES,
    forget: bool = False,
) -> DataFrame:
    """Per piece ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``; ``ids`` on demand.

    Null and empty texts are one piece of the end id.  Repeated rows are packed
    one by one; null ids stay; other columns are left out; an empty table gives
    an empty one.  Sequence numbers and offsets are the same in every run that
    reads the table in the same splits.
    """
    found = tokenized(
        docs, path, text=text, id=id, capacity=capacities.tokens, memo_entries=memo_entries, forget=forget
    )
    found = found.withColumn("ids_crc32", F.crc32("ids"))
    with small_batches(docs.sparkSession):  # the texts are read while ``pack`` saves the pieces
        return pack(found if with_ids else found.drop("ids"), capacities)
