"""Secret scans by a battery of randomness tests (operator 8).

Fixed patterns give the base spans.  Besides, every long run of key characters
is a candidate, and so are its pieces (see ``forms``), since a name or a path
may be joined to a secret and a secret may be written in groups: the encoding is
inferred from the characters, and a candidate stays only if chi-squared, runs
and serial-correlation tests do not contradict a random string in that encoding.
How surprising it would be in ordinary text, where neighbouring characters
seldom change between small letters, capitals and digits, is its p-value.
Benjamini and Hochberg's procedure, applied to each band of lengths over the
whole corpus and to all forms tested, decides which candidates are strong enough;
of those that overlap the widest is reported.

Letters of one case without a digit show no change between kinds, so this null
hypothesis cannot tell them from a word, and they are never candidates.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import column, saved

KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
NAMED = re.compile(r"[^=]+")
STRETCH = re.compile(r"[^=/_-]+")
_KEYWORDS = ("passw", "secret", "token", "api")

#: Lower ends of the length bands that are decided apart.
BANDS = (16, 20, 24, 32, 48, 64, 128)
#: Pieces of up to so many stretches between signs are tested, none longer than it needs to have ``WIDE`` characters.
GROUPS = 8
WIDE = 128
#: p-values are kept as whole numbers of -log10, up to this one.
TOP = 99
#: Chance that two neighbours in ordinary text differ in kind, and in a run with digits or signs.
CHANGES = 0.05
#: Each test of randomness rejects at this level.
REJECT = 0.001

# The alphabets of the encodings, smallest first, with the sizes of their classes.
_ENCODINGS = (
    ("hex", frozenset("0123456789abcdef"), 16),
    ("HEX", frozenset("0123456789ABCDEF"), 16),
    ("base32", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567="), 32),
    ("upper36", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 36),
    ("lower36", frozenset("abcdefghijklmnopqrstuvwxyz0123456789"), 36),
    ("base62", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), 62),
    ("base64", None, 64),
)
_GROUP = {
    **dict.fromkeys("abcdefghijklmnopqrstuvwxyz", 0),
    **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1),
    **dict.fromkeys("0123456789", 2),
}


def _chi2_tail(x: float, df: int) -> float:
    """P(chi-squared with ``df`` >= x), by Wilson and Hilferty's approximation."""
    if x <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _binomial_tail(n: int, p: float, least: int) -> float:
    """P(Binomial(n, p) >= least)."""
    if least <= 0:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
        for k in range(least, n + 1)
    ]
    top = max(logs)
    return math.exp(top) * math.fsum(math.exp(x - top) for x in logs)


def infer_encoding(run: str) -> tuple[str, int] | None:
    """The smallest alphabet that holds the run; none for runs of one kind of character."""
    kinds = {_GROUP.get(c, 3) for c in run.rstrip("=")}
    if len(kinds) < 2 or kinds <= {2, 3} or kinds <= {0, 3} or kinds <= {1, 3}:
        return None
    letters = set(run)
    for name, alphabet, size in _ENCODINGS:
        if alphabet is None or letters <= alphabet:
            return name, size
    return None


def looks_random(run: str, size: int) -> bool:
    """Chi-squared, runs and serial-correlation tests, none of which rejects a random string."""
    body = run.rstrip("=")
    n = len(body)
    counts = Counter(body)
    expected = n / size
    # Uniform alphabet: the spread of the counts, the characters not seen included.
    spread = sum((k - expected) ** 2 for k in counts.values()) / expected + (size - len(counts)) * expected
    if expected < 2:
        # Few characters a cell: compare the number of equal pairs with its own mean and variance.
        pairs = sum(k * (k - 1) // 2 for k in counts.values())
        mean = n * (n - 1) / 2 / size
        uniform = 0.5 * math.erfc((pairs - mean - 0.5) / math.sqrt(2 * mean * (1 - 1 / size)))
    else:
        uniform = _chi2_tail(spread, size - 1)
    if uniform < REJECT:
        return False
    # Shares of small letters, capitals, digits and signs.
    share = {16: (6, 0, 10, 0), 32: (0, 26, 6, 0), 36: (0, 26, 10, 0), 62: (26, 26, 10, 0), 64: (26, 26, 10, 2)}[size]
    kinds = [_GROUP.get(c, 3) for c in body]
    got = Counter(kinds)
    if size == 16 and got[1] or size == 36 and got[0]:
        share = (share[1], share[0], share[2], share[3])
        share = share if size == 36 else (0, 6, 10, 0)
    spread, cells = 0.0, 0
    for kind, part in enumerate(share):
        if part > 2:
            spread += (got[kind] - n * part / size) ** 2 / (n * part / size)
            cells += 1
    if cells > 1 and _chi2_tail(spread, cells - 1 if size < 64 else cells) < REJECT:
        return False
    # Runs above and below the median of the alphabet's order.
    values = [ord(c) for c in body]
    middle = sorted(values)[n // 2]
    above = [v >= middle for v in values]
    a = sum(above)
    b = n - a
    if a and b:
        runs = 1 + sum(x != y for x, y in zip(above, above[1:]))
        mean = 1 + 2 * a * b / n
        var = max(1e-9, (mean - 1) * (mean - 2) / max(1, n - 1))
        if _two_sided((abs(runs - mean) - 0.5) / math.sqrt(var)) < REJECT and abs(runs - mean) > 0.5:
            return False
    # Serial correlation of neighbours.
    mean = sum(values) / n
    var = sum((v - mean) ** 2 for v in values)
    if var:
        r = sum((x - mean) * (y - mean) for x, y in zip(values, values[1:])) / var
        if _two_sided((r + 1 / n) * math.sqrt(n)) < REJECT:
            return False
    return True


def surprise(run: str, parts: list[str] | None = None) -> int:
    """-log10, rounded down, of the chance of so many changes of kind in ordinary text; 0 for no candidate.

    With ``parts`` only changes within these count, for ordinary text changes at a sign.
    """
    found = infer_encoding(run)
    if found is None or not looks_random(run, found[1]):
        return 0
    changes = neighbours = 0
    for part in parts or [run.rstrip("=")]:
        kinds = [_GROUP.get(c, 3) for c in part]
        changes += sum(x != y for x, y in zip(kinds, kinds[1:]))
        neighbours += len(kinds) - 1
    p = _binomial_tail(neighbours, CHANGES, changes)
    return TOP if p <= 10.0**-TOP else max(0, math.floor(-math.log10(p)))


def forms(run: str) -> Iterator[tuple[int, int, str, list[str] | None]]:
    """What is tested of a run: start, end, characters and, but for the run as it is, its stretches.

    The run as it is comes first.  Pieces are the run, what is left of it when it
    is cut at ``=``, and in each of these the rows of stretches between the signs
    ``/``, ``_`` and ``-``.  Each is tested with its signs and without.
    """
    yield 0, len(run), run, None
    cuts = [m.span() for m in STRETCH.finditer(run)]
    if not cuts:
        return
    pieces = {(0, len(cuts) - 1): None}  # first and last stretch, in the order of the tests
    named = []
    for m in NAMED.finditer(run):
        low = bisect.bisect_left(cuts, (m.start(), 0))
        high = bisect.bisect_left(cuts, (m.end(), 0)) - 1
        if low <= high:
            named.append((low, high))
            pieces[low, high] = None
    for low, high in named:
        for i in range(low, high + 1):
            size = 0
            for j in range(i, min(high + 1, i + GROUPS)):
                size += cuts[j][1] - cuts[j][0]
                pieces[i, j] = None
                if size >= WIDE:
                    break
    for i, j in pieces:
        parts = [run[a:b] for a, b in cuts[i : j + 1]]
        bare = "".join(parts)
        if len(bare) < BANDS[0]:
            continue
        start, end = cuts[i][0], cuts[j][1]
        if end - start < len(run):
            yield start, end, run[start:end], parts
        if end - start > len(bare):
            yield start, end, bare, parts


def widest(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of spans that overlap only the widest, the first of equally wide ones; in order."""
    kept: list[tuple[int, int]] = []
    for start, end in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
        at = bisect.bisect_left(kept, (end, 0))
        if not at or kept[at - 1][1] <= start:
            kept.insert(at, (start, end))
    return kept


def band_of(length: int) -> int:
    return sum(length >= low for low in BANDS) - 1


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]], list[int]]:
    """Base spans (start, kind, end), candidates (start, end, band, surprise) and forms tested per band."""
    base: list[tuple[int, int, int]] = []
    candidates: list[tuple[int, int, int, int]] = []
    tested = [0] * len(BANDS)
    if text:
        low = text.lower()
        if any(word in low for word in _KEYWORDS):
            base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
        if "AKIA" in text:
            base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        for m in RUN.finditer(text):
            start, end = m.span()
            if end - start >= 24:
                base += [(start + h.start(), 2, start + h.end()) for h in HEX.finditer(m.group())]
            for low, high, tried, parts in forms(m.group()):
                band = band_of(len(tried))
                tested[band] += 1
                if strength := surprise(tried, parts):
                    candidates.append((start + low, start + high, band, strength))
                    if strength == TOP and high - low == end - start:
                        break  # always strong enough, and nothing is wider
        base.sort()
    return base, candidates, tested


_FOUND = pa.struct(
    [
        ("base", pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))),
        (
            "candidates",
            pa.list_(
                pa.struct([("start", pa.int64()), ("end", pa.int64()), ("band", pa.int32()), ("strength", pa.int32())])
            ),
        ),
        ("tested", pa.list_(pa.int64())),
    ]
)
_FOUND_TYPE = (
    "struct<base:array<struct<start:bigint,kind:int,end:bigint>>,"
    "candidates:array<struct<start:bigint,end:bigint,band:int,strength:int>>,tested:array<bigint>>"
)


def _scanned(text: Column) -> Column:
    @F.arrow_udf(_FOUND_TYPE)
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            base, candidates, tested = scan(text.as_py())
            rows.append(
                {
                    "base": [{"start": s, "kind": k, "end": e} for s, k, e in base],
                    "candidates": [{"start": s, "end": e, "band": b, "strength": x} for s, e, b, x in candidates],
                    "tested": tested,
                }
            )
        return pa.array(rows, _FOUND)

    return found(text)


def needed_strength(found: DataFrame, rate: float) -> DataFrame:
    """Per band the least surprise that keeps the false-discovery rate below ``rate``.

    A table of at most ``len(BANDS)`` rows from counts over all documents: with
    m forms tested and R candidates of at least a surprise of t, t suffices if
    10^-t <= rate * R / m.
    """
    tested = found.select(F.posexplode("tested").alias("band", "n")).groupBy("band").agg(F.sum("n").alias("m"))
    counts = (
        found.select(F.explode("candidates").alias("c"))
        .groupBy(F.col("c.band").alias("band"), F.col("c.strength").alias("strength"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most len(BANDS) * TOP rows on either side.
    left, right = counts.alias("a"), counts.alias("b")
    reached = (
        left.join(F.broadcast(right), F.expr("a.band = b.band AND b.strength >= a.strength"))
        .groupBy(F.col("a.band").alias("band"), F.col("a.strength").alias("strength"))
        .agg(F.sum("b.n").alias("r"))
    )
    return (
        reached.join(F.broadcast(tested), "band")
        .filter(F.pow(F.lit(10.0), -F.col("strength")) <= rate * F.col("r") / F.col("m"))
        .groupBy("band")
        .agg(F.min("strength").alias("least"))
    )


def _chosen(candidates: Column, least: dict[int, int]) -> Column:
    """The widest of the candidates that are strong enough."""

    @F.arrow_udf("array<struct<start:bigint,end:bigint>>")
    def found(rows: pa.Array) -> pa.Array:
        chosen = []
        for row in rows:
            strong = [
                (c["start"], c["end"]) for c in row.as_py() if c["strength"] >= least.get(c["band"], TOP + 1)
            ]
            chosen.append([{"start": s, "end": e} for s, e in widest(strong)])
        return pa.array(chosen, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return found(candidates)


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(spans)
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ","
    )


def find_secrets(
    docs: DataFrame, *, text: str = "text", id: str = "doc_id", rate: float = 0.001
) -> DataFrame:
    """Per row its id and ``spans``: an array of (start, kind, end) with kinds indexing ``KINDS``; also ``base``.

    Offsets are code points of the whole text.  Null and empty texts have no
    spans; repeated rows and null ids stay; other columns are left out; an empty
    table gives an empty one.  Of overlapping candidates the widest is reported; one
    equal to a base span is not repeated.
    """
    found = saved(
        docs.select(column(docs, id).alias("doc_id"), _scanned(column(docs, text)).alias("f")).select(
            "doc_id", "f.base", "f.candidates", "f.tested"
        ),
        "secret_candidates",
    )
    least = {row["band"]: row["least"] for row in needed_strength(found, rate).collect()}  # one per band
    extra = F.transform(
        "chosen",
        lambda c: F.struct(
            c["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), c["end"].alias("end")
        ),
    )
    new = F.filter(
        extra, lambda s: ~F.exists("base", lambda b: (b["start"] == s["start"]) & (b["end"] == s["end"]))
    )
    chosen = found.select("doc_id", "base", _chosen(F.col("candidates"), least).alias("chosen"))
    return chosen.select("doc_id", "base", F.concat("base", new).alias("spans"))


def secret_digest(secrets: DataFrame) -> DataFrame:
    """Counts per base kind, the checksum of the base spans and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return secrets.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
