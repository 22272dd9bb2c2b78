"""Small tables with awkward rows, and plain versions of what the operators compute."""

import random
import re
from collections import Counter

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, key string, n long, size string, target string, row string, _words string, m string, id string"
)
BASIC = "doc_id long, text string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

VOCABULARY = [
    f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ne", "tu") for b in ("ra", "so", "vi") for c in ("", "n", "st", "x")
]
STOPS = "the of and to in is that it for was".split()


def prose(seed: int, words: int, per_line: int = 12) -> str:
    rng = random.Random(seed)
    out = [rng.choice(VOCABULARY) if rng.random() < 0.7 else rng.choice(STOPS) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + per_line]) for i in range(0, words, per_line))


def awkward_texts() -> list[tuple]:
    """(doc_id, text, source): nulls, blanks, repeats, ties, very long texts and words."""
    return [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n\r\x0b\x0c ", None),
        (4, prose(1, 60), "a"),
        (5, prose(1, 60), "a"),
        (5, prose(1, 60), "a"),
        (None, prose(1, 60), "b"),
        (None, prose(2, 40), None),
        (6, prose(3, 30_000), "b"),
        (7, "w" * 200_000, "b"),
        (8, "one", "c"),
        (9, "one two", "c"),
        (10, "Àé ÇÖ ñandú ß İ Σας 日本語 \U0001f600 é", "c"),
        (11, prose(4, 30) + "\n" + prose(1, 60), "a"),
        (-12, prose(5, 80), "a"),
    ]


def table(spark, rows=None):
    """Rows of (doc_id, text, source) under columns whose names operators might use."""
    rows = awkward_texts() if rows is None else rows
    full = [
        (i, t, "en", s, None if t is None else len(t), 0.5, "k", 1, "s", "t", "r", "w", "m", "i") for i, t, s in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def words_of(text):
    return WORD.findall(text or "")


def repeated_words(words):
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    return len({i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(8)})


def shingles_of(text, k):
    raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(raw)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def component_ids(rows, k, percent):
    """Least id reachable by links, per row of (doc_id, text)."""
    sets = [shingles_of(text, k) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [
        (doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)
    ]


def deduplicated(rows, min_words=50):
    """Texts without the lines of runs of ``min_words`` words that occurred before; rows of (doc_id, text) by id."""
    seen, cut = {}, {}
    order = sorted({r for r in rows if r[1] is not None}, key=lambda r: r[0])
    spans = []
    for doc_id, text in order:
        lines = [(p, line.strip(" \t\n\x0b\x0c\r")) for p, line in enumerate(text.split("\n"))]
        lines = [(p, line, len(WORD.findall(line))) for p, line in lines if WORD.search(line)]
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                inside = sum(w for _, _, w in lines[i : j + 1])
                if inside >= min_words:
                    shortest = inside - lines[j][2] < min_words or inside - lines[i][2] < min_words
                    if shortest:
                        spans.append((tuple(line for _, line, _ in lines[i : j + 1]), doc_id, lines[i][0], lines[j][0]))
                    if inside - lines[i][2] >= min_words and inside - lines[j][2] >= min_words:
                        break
    for run, doc_id, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if run in seen and seen[run] != (doc_id, a):
            cut.setdefault(doc_id, set()).update(range(a, b + 1))
        seen.setdefault(run, (doc_id, a))
    return {
        (doc_id, text): "\n".join(
            line for p, line in enumerate(text.split("\n")) if p not in cut.get(doc_id, ())
        )
        for doc_id, text in order
    }
