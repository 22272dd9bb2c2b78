"""Quality rules and line deduplication against plain versions."""

import random

from tests.llm.helpers import awkward_texts, deduplicated, prose, repeated_words, table, words_of
from tickerloom.llm import line_dedup, quality_rules


def test_rules_on_awkward_rows(spark):
    again = "a b c d e f g h i j " * 6
    rows = awkward_texts() + [(20, again, "a"), (21, "x " * 40 + "\n" + "x " * 40, "a"), (22, "# " * 30 + prose(9, 30), "a")]
    found = quality_rules.quality_verdicts(table(spark, rows)).collect()
    got = sorted((r.doc_id or -99, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    want = []
    for doc_id, text, _ in rows:
        words = words_of(text)
        lines = [x for x in (text or "").split("\n") if words_of(x)]
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        want.append(
            (doc_id or -99, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated_words(words))
        )
    assert got == sorted(want)
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id: r.kept for r in found}
    assert kept[4] and kept[6] and not kept[1] and not kept[22] and not kept[20]


def test_rules_of_nothing(spark):
    assert quality_rules.quality_verdicts(table(spark, [])).collect() == []


def test_line_runs_against_plain_version(spark):
    rng = random.Random(3)
    passages = [prose(100 + k, rng.choice([30, 55, 70, 130]), rng.choice([7, 12, 60])) for k in range(8)]
    rows = []
    for doc_id in range(40):
        parts = [rng.choice(passages) if rng.random() < 0.5 else prose(1000 + doc_id * 9 + k, 25) for k in range(5)]
        if rng.random() < 0.3:
            parts.insert(1, "")
        rows.append((doc_id, "\n".join(parts), "a"))
    rows += [(50, "same ten words in a line and again and again\n" * 20, "a")]
    want = deduplicated([r[:2] for r in rows])
    found = line_dedup.dedup_lines(table(spark, rows), removed="gone")
    assert found.columns == [*table(spark, []).columns, "gone"]
    got = {r.doc_id: (r.text, r.gone) for r in found.collect()}
    for (doc_id, text), left in want.items():
        lost = len(text.split("\n")) - (len(left.split("\n")) if got[doc_id][1] < len(text.split("\n")) else 0)
        assert got[doc_id] == (left, lost)
    assert sum(gone > 0 for _, gone in got.values()) > 10


def test_a_run_that_repeats_a_later_place_of_its_lines_is_cut(spark):
    """The lines of every document are the first one's, in another order for the last two only."""
    lines = prose(1, 120).split("\n")
    rows = [(1, "\n".join(lines), "a"), (2, "\n".join(lines[::-1]), "a"), (3, "\n".join(lines[::-1]), "a")]
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(table(spark, rows)).collect()}
    assert found == {1: rows[0][1], 2: rows[1][1], 3: ""}


def test_line_runs_on_awkward_rows(spark):
    found = line_dedup.dedup_lines(table(spark)).collect()
    assert len(found) == len(awkward_texts())
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r.text)
    assert by_id[1] == [None] and by_id[2] == [""] and by_id[7] == ["w" * 200_000]
    # A null id comes first, so its copy is the one that stays.
    assert prose(1, 60) in by_id[None] and by_id[4] == [""] and by_id[5] == ["", ""]
    assert by_id[11] == [prose(4, 30)] and by_id[-12] == [prose(5, 80)]
    assert line_dedup.dedup_lines(table(spark, [])).collect() == []


def winnowed(hashes, words, min_words):
    """Places that windows select: the last of the least hashes in each shortest run of lines, from either end."""
    out, windows = set(), set()
    for i in range(len(hashes)):
        for step in (1, -1):
            total, j = 0, i
            while 0 <= j < len(hashes):
                total += words[j]
                if total >= min_words:
                    a, b = min(i, j), max(i, j)
                    windows.add((a, b))
                    out.add(max(range(a, b + 1), key=lambda k: (-hashes[k], k)))
                    break
                j += step
    return out, windows


def test_anchors_are_window_minima(spark):
    """Few lines are written, the minima of the windows, each with all that a window around it can hold."""
    rows = [(1, prose(31, 3000, 9), "a"), (2, prose(32, 700, 30) + "\n\n" + prose(31, 200, 9), "a"), (3, prose(33, 40), "a")]
    docs = table(spark, rows)
    found = line_dedup.line_anchors(docs, docs["doc_id"], docs["text"]).collect()
    total = 0
    for doc_id, text, _ in rows:
        mine = [r for r in found if r.id == doc_id]
        lines = [(p, line.strip()) for p, line in enumerate(text.split("\n")) if line.strip()]
        hashes = [r[0] for r in spark.createDataFrame(lines, "p int, line string").orderBy("p").selectExpr("xxhash64(line)").collect()]
        words = [len(line.split()) for _, line in lines]
        selected, windows = winnowed(hashes, words, 50)
        assert {(r.p, r.f) for r in mine} == {(lines[i][0], hashes[i]) for i in selected}
        total += len(windows)
        at = {lines[i][0]: i for i in selected}
        for r in mine:
            held = [w for w in windows if w[0] <= at[r.p] <= w[1]]
            around = [[p for p, _ in lines].index(p) for p in r.ps]
            assert around == list(range(around[0], around[-1] + 1))
            assert around[0] <= min(a for a, _ in held) and max(b for _, b in held) <= around[-1]
            assert r.hs == [hashes[i] for i in around] and r.ws == [words[i] for i in around]
    assert len(found) < total / 2


def test_fingerprints_that_do_not_fit_a_broadcast(spark, monkeypatch):
    rows = [(k, prose(40, 120) + "\n" + prose(41 + k, 90), "a") for k in range(5)]
    want = sorted(tuple(r) for r in line_dedup.dedup_lines(table(spark, rows)).select("doc_id", "text").collect())
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    got = sorted(tuple(r) for r in line_dedup.dedup_lines(table(spark, rows)).select("doc_id", "text").collect())
    assert got == want and sum(len(t) for _, t in got) < sum(len(t) for _, t, _ in rows) - 2000
