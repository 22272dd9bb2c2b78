"""The Jaccard join and the nearest-neighbour search against brute force."""

import math
import random

import numpy as np
import pytest

from tests.llm.helpers import awkward_texts, component_ids, prose, table
from tickerloom.llm import jaccard_join, multi_index, shingles


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_components_against_brute_force(spark, words, percent):
    rng = random.Random(percent)
    rows = awkward_texts()
    for family in range(12):
        base = prose(500 + family, rng.choice([6, 15, 40, 120, 300])).split(" ")
        for copy in range(rng.randint(2, 9)):
            changed = [rng.choice(["changed", "words", w]) if rng.random() < 0.03 * copy / 4 else w for w in base]
            rows.append((100 + 20 * family + copy, " ".join(changed), "a"))
    rows += [(400, rows[-1][1].upper(), "a"), (401, prose(77, 200) + " tail", "a"), (402, prose(77, 200), "a")]
    found = jaccard_join.jaccard_components(table(spark, rows), words=words, percent=percent)
    got = sorted(((r.doc_id or -99), r.n_shingles, r.component_id) for r in found.collect())
    want = sorted((d or -99, n, c) for d, n, c in component_ids([r[:2] for r in rows], words, percent))
    assert got == want


def test_large_buckets_are_searched_without_losing_links(spark, monkeypatch):
    """A chain of texts, each a few words off the one before, and a passage that all share."""
    monkeypatch.setattr(jaccard_join, "COMMON", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    words = prose(9, 200).split(" ")
    rows = []
    for step in range(60):
        words[step * 3 % len(words)] = f"step{step}"
        rows.append((step, " ".join(words), "a"))
    shared = prose(10, 12)
    rows += [(100 + k, shared + " " + prose(200 + k, 30 + k % 3), "a") for k in range(60)]
    found = jaccard_join.jaccard_components(table(spark, rows), words=3, percent=90)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert got == sorted(component_ids([r[:2] for r in rows], 3, 90))


def test_one_row_of_each_component_stays(spark):
    docs = table(spark)
    kept = jaccard_join.one_per_component(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # 4, 5, 5 and one of the null ids are copies; a null id that stands alone stays.
    want = [1, 2, 3, 4, 6, 7, 8, 9, 10, 11, -12]
    assert got == sorted([(False, d) for d in want] + [(True, 0)])


def test_components_of_one_least_id_all_keep_a_row(spark):
    """Different texts with null ids, and different texts under one id, are components of their own."""
    one, two, three = (prose(900 + k, 40) for k in range(3))
    rows = [(None, one, "a"), (None, two, "b"), (None, two, "b"), (7, prose(910, 40), "a"), (7, prose(911, 40), "b")]
    rows += [(None, three, "a"), (8, three, "b"), (9, prose(911, 40), "c"), (7, prose(910, 40), "a")]
    kept = jaccard_join.one_per_component(table(spark, rows))
    got = sorted(((r.doc_id or 0), r.text) for r in kept.collect())
    assert got == sorted([(0, one), (0, two), (7, prose(910, 40)), (7, prose(911, 40)), (8, three)])


def test_join_of_nothing(spark):
    assert jaccard_join.jaccard_components(table(spark, [])).collect() == []
    assert jaccard_join.one_per_component(table(spark, [])).collect() == []
    lone = table(spark, [(1, None, "a"), (2, "", "a")])
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(lone).collect()) == [
        (1, 0, 1),
        (2, 0, 2),
    ]


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    bands = shingles.Bands(percent)
    band_table = bands.table()
    links = 0
    for _ in range(600):
        a = np.unique(rng.integers(0, 2**64, int(np.exp(rng.uniform(0, 6.5))), dtype=np.uint64))
        kept = a[rng.random(len(a)) > rng.random() * 0.15]
        b = np.unique(np.concatenate([kept, rng.integers(0, 2**64, len(a) // 20, dtype=np.uint64)]))
        if len(b) and shingles.linked(a, b, percent) and shingles.class_of(a) != shingles.class_of(b):
            links += 1
            one, two = (set(shingles.signatures(x, bands.of(len(x), band_table)).tolist()) for x in (a, b))
            assert one & two
            counts = [np.frombuffer(shingles.sketch(x), np.uint8).astype(int) for x in (a, b)]
            assert np.abs(counts[0] - counts[1]).sum() * (100 + percent) <= (len(a) + len(b)) * (100 - percent)
    assert links > 20


def test_long_texts_hash_alike_in_stretches(monkeypatch):
    text = prose(1, 5000) + " " + "x" * 3000 + " end"
    whole = shingles.shingle_set(text, 3)
    monkeypatch.setattr(shingles, "STRETCH", 100)
    assert (shingles.shingle_set(text, 3) == whole).all()


def _vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, key string"
    )


def _brute(rows, every, n):
    clean = {}
    for i, v in rows:
        if i is not None and v and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            clean[i] = np.array(v, np.float32).astype(float)
    out = []
    for q in clean:
        if q % every == 0:
            near = sorted((-multi_index.cosine(clean[q], v), i) for i, v in clean.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:n])]
    return sorted(out)


def test_search_is_exact_when_everything_is_seen(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).round(3).tolist()) for i in range(300)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300, 420)]  # a large group of equal vectors, with queries in it
    rows += [
        (500, None), (501, []), (502, [0.0] * 4), (503, [1.0, None, 2.0, 3.0]), (504, [math.nan, 1.0, 1.0, 1.0]),
        (505, [math.inf, 1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (550, [1.0, 2.0]), (600, [-0.0, 0.0, 0.0, 1.0]),
        (600, [-0.0, 0.0, 0.0, 1.0]),
    ]
    found = multi_index.nearest(_vectors(spark, rows), recall=1.0, sample_rows=50).collect()
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)
    assert got == _brute(rows, 50, 5)


def test_search_finds_nine_of_ten(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(3000)]
    found = {(r.query_id, r.vec_id) for r in multi_index.nearest(_vectors(spark, rows)).collect()}
    x = np.array([v for _, v in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        near = x @ x[q]
        near[q] = -2
        hits += sum((q, int(v)) in found for v in np.argsort(-near)[:5])
    assert hits >= 0.9 * 5 * 60


def test_search_of_few(spark):
    assert multi_index.nearest(_vectors(spark, [])).collect() == []
    assert multi_index.nearest(_vectors(spark, [(0, [1.0, 0.0])])).collect() == []
    two = multi_index.nearest(_vectors(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])])).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in two] == [(0, 1, 1, 0.0)]


def test_cells_come_in_the_order_of_distance():
    rng = np.random.default_rng(1)
    one, two = rng.random(9), rng.random(9)
    sizes = rng.integers(0, 4, 81)
    cells, last = multi_index.visited(one, two, sizes, sizes.sum() + 1)
    summed = (one[:, None] + two[None]).ravel()
    assert sorted(cells) == list(range(81))
    assert (np.diff(summed[cells]) >= 0).all() and last == summed[cells[-1]]
    cells, _ = multi_index.visited(one, two, sizes, 20)
    assert sizes[cells].sum() >= 20 > sizes[cells[:-1]].sum()


def test_one_id_with_several_vectors(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.1, 0.9]), (3, [0.7, 0.7])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = [(r.query_id, r["rank"], r.vec_id) for r in multi_index.nearest(docs).collect()]
    assert sorted(found) == [(50, 1, 1), (50, 1, 2), (50, 2, 3), (50, 2, 3), (50, 3, 1), (50, 3, 2)]


def test_many_unlinked_near_copies_make_few_links(spark, monkeypatch):
    """A group of near copies, most pairs of which are not linked: links and checked sets stay linear."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    rng = random.Random(21)
    base = prose(55, 90).split()
    rows = []
    for k in range(1000):
        words = list(base)
        for at in rng.sample(range(90), rng.choice([1, 2, 3, 5, 8])):
            words[at] = f"w{rng.randrange(10**6)}"
        rows.append((k, " ".join(words), "a"))
    seen = {}
    for name in ("_open", "_joined"):
        inner = getattr(jaccard_join, name)

        def counted(frame, percent, inner=inner, name=name):
            out = jaccard_join.saved(inner(frame, percent), name)
            seen[name] = out.count()
            return out

        monkeypatch.setattr(jaccard_join, name, counted)
    found = jaccard_join.jaccard_components(table(spark, rows), words=3, percent=90)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert got == sorted(component_ids([r[:2] for r in rows], 3, 90))
    # Without the joining there are tens of thousands of open pairs.
    assert seen["_joined"] < 1000 and seen["_open"] < 20_000


def test_which_of_equal_rows_stays(spark):
    """Rows equal in id and text, but not in all columns: the first by all columns as JSON."""
    text = prose(12, 40)
    rows = [(1, text, "b"), (1, text, "a"), (2, text, "a"), (3, prose(13, 40), "c")]
    kept = jaccard_join.one_per_component(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.source) for r in kept) == [(1, "a"), (3, "c")]

