"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import awkward_texts, table
from tickerloom.llm import spelling


def counted(rows, least=7, every=31):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= least:
                counts[word] += 1
    return counts


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def described(counts):
    words = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def texts():
    """Words with chains of ever rarer variants, anagrams, accents, and long words."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    words += ["".join(rng.sample("abcdefg", 7)) for _ in range(150)]
    words += ["Ñandú" + "x" * k for k in range(2, 30)] + ["ÀÉÎÕÜÿ÷×", "àéîõüÿ÷×", "aaaaaaa", "aaaaaaaa", "aaaaaab"]
    words += ["q" * 300, "q" * 301, "q" * 150 + "r" + "q" * 150, "q" * 299 + "r" + "q", "p" * 70, "p" * 69]
    chain = ["kalorisu", "kalorisa", "kalorina", "kaloina", "kaloine"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60)), "a") for i in range(40)]
    rows += [(100 + i, " ".join(w for k, w in enumerate(chain) for _ in range(2 * 10**k if k < 4 else 9000)), "a") for i in (0,)]
    rows += [(200, "nearly1nearly-words nearly WORDSES wordses", "a"), (200, "nearly WORDSES", "a")]
    return rows + awkward_texts()


@pytest.mark.parametrize("layout", [{}, {"sample_rows": 60, "cell": 12, "block": 5, "part": 9}])
def test_against_brute_force(spark, monkeypatch, layout):
    if layout:
        monkeypatch.setattr(spelling, "COUNTED", 50)
        near = spelling.near_words
        monkeypatch.setattr(spelling, "near_words", lambda words: near(words, **layout))
    rows = texts()
    found = spelling.variant_groups(table(spark, rows))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = described(counted(rows))
    assert sorted(tuple(r) for r in found.collect()) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # chains of forms


def test_without_dropped_letters_and_other_limits(spark):
    rows = texts()
    found = spelling.variant_groups(table(spark, rows), drop_every=None, least_chars=8)
    assert sorted(tuple(r) for r in found.collect()) == described(counted(rows, 8, None))


def test_empty_tables(spark):
    for rows in ([], [(1, None, "a"), (2, "", "a"), (3, "short words", None)]):
        assert spelling.variant_groups(table(spark, rows)).collect() == []


def test_boxes_lose_no_near_vector():
    rng = np.random.default_rng(2)
    words = list({"".join(rng.choice(list("abcdef"), 8)) for _ in range(800)})
    rows = spelling.vectors(spelling.letters(words))
    for tight in (False, True):
        tree = spelling.Tree(rows, 10, tight=tight)
        assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(len(words)))
        met = {(int(q), int(p)) for leaf, some in tree.reached(rows, 1, 1) for q in some for p in tree.leaves[leaf]}
        apart = rows.astype(int)[:, None] - rows.astype(int)[None]
        near = np.argwhere(np.abs(apart).sum(axis=2) <= 2)
        assert all((a, b) in met for a, b in near.tolist())
        assert len(met) < len(words) ** 2 / 2


def test_many_anagrams_are_looked_up(monkeypatch):
    monkeypatch.setattr(spelling, "LOOKED_UP", 3)
    rng = random.Random(3)
    words = sorted({"".join(rng.sample("aabbcd", 6)) for _ in range(200)})
    asked = sorted({"".join(rng.sample("aabbce", 6)) for _ in range(200)} | {"".join(rng.sample("aabbc", 5)) for _ in range(60)})
    block = spelling.Block(words)
    for size in (5, 6):
        some = [w for w in asked if len(w) == size]
        a, b = block.near(some)
        want = {(q, w) for q in some for w in words if one_edit(q, w)}
        assert {(some[i], words[j]) for i, j in zip(a, b)} == want and len(a) == len(want)
