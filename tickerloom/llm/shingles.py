"""Hashes of word shingles, and signatures of shingle sets by universe partitioning.

Plain numpy on one text or one set at a time; ``jaccard_join`` does the rest in Spark.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Texts are hashed in stretches of about so many bytes, cut between words.
STRETCH = 1 << 20
#: Bits of a signature that name its size band.
BAND_BITS = 7
#: Parts of the universe that a sketch counts, and how many of them a coarse look adds up.
SKETCH = 256
COARSE = 8

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_ONE = np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD1342543DE82EF95)

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _powers = np.concatenate([[_ONE], np.cumprod(np.full(size - 1, _BASE, np.uint64), dtype=np.uint64)])
        back = np.uint64(pow(_BASE, -1, 1 << 64))
        _inverse = np.concatenate([[_ONE], np.cumprod(np.full(size - 1, back, np.uint64), dtype=np.uint64)])
    return _powers, _inverse


def _word_hashes(raw: bytes) -> np.ndarray:
    """One hash per word of a stretch: a polynomial in its bytes, mixed."""
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    powers, inverse = _grown(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + _ONE) * powers[: len(data)])])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words between blanks, A-Z in lower case, in order."""
    raw = text.encode().translate(_LOWER)
    if len(raw) <= STRETCH:
        return _word_hashes(raw)
    parts, at = [], 0
    while at < len(raw):
        end = at + STRETCH
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        parts.append(_word_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; all words as one if there are fewer; empty without words."""
    hashes = word_hashes(text or "")
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    n = len(hashes) - size + 1
    rolled = np.full(n, size, np.uint64)
    for k in range(size):
        rolled = mixed(rolled * _STEP + hashes[k : k + n])
    return np.unique(rolled)


def class_of(found: np.ndarray) -> int:
    """A signed 64-bit number for a set; equal sets have equal numbers."""
    total = int(mixed(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) + len(found) * int(_STEP)
    return int(mixed(np.array([total % (1 << 64)], np.uint64)).astype(np.int64)[0])


def sketch(found: np.ndarray) -> bytes:
    """Counts of the set in ``SKETCH`` parts of the universe, cut off at 255; never further apart than the sets are."""
    counts = np.bincount((mixed(found) >> np.uint64(56)).astype(np.int64), minlength=SKETCH)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct hashes."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # merges two sorted runs
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


@dataclass(frozen=True)
class Band:
    """Sizes ``low`` to ``high``; segments of the universe; whether one-deletion neighbours are indexed."""

    number: int
    low: int
    high: int
    segments: int
    deletions: bool


@dataclass(frozen=True)
class Bands:
    """Size bands for one threshold, with segments allotted by cost.

    Linked sets r and s differ in at most (|r| + |s|) * (100 - percent) /
    (100 + percent) shingles.  With more segments than that, one segment is
    equal in both.  With one-deletion neighbours half as many do: one segment
    then differs by a single shingle at most.

    Segments that hold one shingle or none are shared by many sets by chance.  A
    band without deletions gets so many segments more that its sets can do
    without those (see ``spare``).  Where that does not work out, or costs more
    index rows, the band takes deletions; a light segment there counts as
    ``LIGHT`` rows.
    """

    percent: int

    GROWTH = 1.5
    LIGHT = 20

    def differ(self, total: int) -> int:
        return total * (100 - self.percent) // (100 + self.percent)

    def _largest(self, size: int, high: int) -> int:
        """The largest set in a band up to ``high`` that a set of this size can be linked to."""
        return min(high, 100 * size // self.percent)

    def table(self) -> list[Band]:
        def light(size: int, segments: int) -> float:
            return segments * math.exp(-size / segments) * (1 + size / segments)

        def enough(size: int, segments: int) -> bool:
            few = light(size, segments)
            return segments - few - 2 * math.sqrt(few) >= self.differ(size + self._largest(size, high)) + 1

        bands, low = [], 1
        ratio = max(self.GROWTH, 100 / self.percent)
        while low < 1 << 31:
            high = max(low, math.ceil(low * ratio) - 1)
            needed = self.differ(2 * high) + 1
            halves = (needed + 1) // 2
            cost_halves = halves + high + self.LIGHT * light(low, halves)
            for step in range(16):
                whole = needed + needed * step // 20
                if enough(low, whole) and enough(high, whole):
                    break
            else:
                whole = needed
            cost_whole = whole + self.LIGHT * max(0.0, light(low, whole) - (whole - needed))
            deletions = cost_halves < cost_whole
            bands.append(Band(len(bands), low, high, halves if deletions else whole, deletions))
            low = high + 1
        return bands

    def of(self, size: int, table: list[Band]) -> list[Band]:
        """The bands that hold the size of a set or of a larger set linked to it; none if that must be equal."""
        return [
            band
            for band in table
            if band.high >= size and band.low * self.percent <= 100 * size and self.differ(2 * band.high) > 0
        ]

    def spare(self, size: int, band: Band) -> int:
        """How many segments of a set of this size can be left out in the band without missing a link."""
        if band.deletions:
            return 0
        return max(0, band.segments - self.differ(size + self._largest(size, band.high)) - 1)


def signatures(found: np.ndarray, bands: list[Band]) -> np.ndarray:
    """The signed index keys of a set in the given bands.

    A segment is a stretch of the hash range, so in the sorted set its shingles
    are neighbours.  Its key is a hash of their sum, the segment and the band;
    a one-deletion neighbour has the key of the sum less one shingle.  The
    lowest bits name the band.
    """
    keys = []
    parts = mixed(found + _STEP)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(parts)])
    high = found >> np.uint64(32)
    for band in bands:
        segment = ((high * np.uint64(band.segments)) >> np.uint64(32)).astype(np.int64)
        edges = np.searchsorted(segment, np.arange(band.segments + 1))
        totals = sums[edges[1:]] - sums[edges[:-1]]
        salt = mixed(np.arange(band.segments, dtype=np.uint64) + np.uint64(band.number << 40) + _ONE)
        made = [totals * _STEP + salt]
        if band.deletions:
            made.append((totals[segment] - parts) * _STEP + salt[segment])
        key = mixed(np.concatenate(made)) >> np.uint64(BAND_BITS) << np.uint64(BAND_BITS)
        keys.append(key | np.uint64(band.number))
    return np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
