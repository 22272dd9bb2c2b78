"""Mixing against plain sums, and the pipeline stage by stage."""

import random
from collections import defaultdict
from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.helpers import awkward_texts, component_ids, deduplicated, prose, shingles_of, table, words_of
from tickerloom.llm import mixture
from tickerloom.scratch import discard, saved, scratch_root, scratch_run


def _targets(sizes, shares=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: shares[k % len(shares)] for k, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        pull = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and most * sizes[s] <= left * weight[s] / pull + 1e-9}
        if not over:
            return {s: most * sizes[s] if s in full else left * weight[s] / pull for s in names}
        full |= over


def _check(rows, found):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words_of(text))
    targets = _targets(sizes)
    source_of = {(i, len(words_of(t))): s for i, t, s in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        source = source_of[r.doc_id, r.size]
        assert r.source_size == sizes[source] and abs(r.target - targets[source]) < 1e-6 * max(1, r.target)
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for source, words in taken.items():
        assert abs(words - targets[source]) <= 2 * largest[source]


def test_taken_words_come_near_the_targets(spark):
    rng = random.Random(1)
    rows = []
    for k, (source, n) in enumerate([("a", 300), ("b", 5), ("é", 40), ("z", 3), (None, 60), ("empty", 2)]):
        for i in range(n):
            text = "" if source == "empty" else prose(100 * k + i, rng.randint(1, 60))
            rows.append((1000 * k + i, text, source))
    first = mixture.mix(table(spark, rows)).collect()
    _check(rows, first)
    again = mixture.mix(table(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str)
    small = [r for r in first if r.doc_id // 1000 in (1, 3)]
    assert all(r.copies == 3 for r in small)


def test_heavier_documents_come_first(spark):
    plain = [(i, prose(i, 20), "a") for i in range(200)]
    marked = [(1000 + i, prose(i, 20).replace(" ", " # "), "a") for i in range(200)]
    rows = plain + marked + [(5000 + i, prose(i, 20), "b") for i in range(400)]
    found = {r.doc_id: r.copies for r in mixture.mix(table(spark, rows)).collect()}
    assert sum(found[i] for i in range(200)) > 1.5 * sum(found[1000 + i] for i in range(200))


def test_one_slice_is_sorted_only(spark, monkeypatch):
    rows = [(i, prose(i, 10), "ab"[i % 2]) for i in range(120)]
    for slices in (1, 7):
        monkeypatch.setattr(mixture, "SLICES", slices)
        monkeypatch.setattr(mixture, "BROADCAST_SOURCES", 0)
        _check(rows, mixture.mix(table(spark, rows)).collect())


def test_slices_are_narrow_for_any_weight(spark):
    rows = [(i, "## ## ## ## " + str(i) if i % 3 else prose(i, 20), "ab"[i % 2]) for i in range(6000)]
    keyed = mixture.keyed_documents(table(spark, rows), text="text", id="doc_id", source="source", seed=42)
    sizes = keyed.groupBy("source", mixture._slice(keyed["key"]).alias("slice")).count()
    assert max(r["count"] for r in sizes.collect()) <= 15  # of 3000, 1.1 expected at most
    _check(rows, mixture.mix(table(spark, rows)).collect())


def test_mix_of_awkward_rows_and_nothing(spark):
    docs = table(spark)
    found = mixture.mix(docs).collect()
    assert len(found) == len(awkward_texts())
    _check(awkward_texts(), found)
    repeated = mixture.mixed_documents(docs)
    assert repeated.columns == docs.columns
    got = defaultdict(int)
    for r in repeated.collect():
        got[r.doc_id, len(words_of(r.text))] += 1
    want = defaultdict(int)
    for r in found:
        want[r.doc_id, r.size] += r.copies
    assert got == {k: n for k, n in want.items() if n}
    assert mixture.mix(table(spark, [])).collect() == []
    assert mixture.mixed_documents(table(spark, [])).collect() == []
    lone = mixture.mix(table(spark, [(1, None, None), (2, "", None)])).collect()
    assert all((r.target, r.taken) == (0.0, 0) for r in lone)


def test_pipeline_stages_on_planted_cases(spark, tmp_path):
    rows = [(i, prose(i, 70), "s" + str(i % 4)) for i in range(120)]
    passage = prose(999, 66, 11)
    copied = prose(500, 90)
    near = copied.split(" ")
    near[40] = "other"
    rows += [(200, copied, "s1"), (201, copied, "s1"), (202, " ".join(near).replace("\n", " "), "s2")]
    rows += [(300 + k, prose(600 + k, 30) + "\n" + passage + "\n" + prose(700 + k, 30), "s3") for k in range(5)]
    toxic = [(400 + i, prose(800 + i, 40) + " idiot idiot moron", "s0") for i in range(60)]
    rows += toxic
    documents = table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    labels = [(i, 1, int(i >= 400)) for i, _, _ in rows if i < 120 or i >= 400]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    documents.write.parquet(f"{tmp_path}/documents.parquet")

    kept, steps = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = saved(stage(spark, kept, str(tmp_path)), name)
        steps[name] = (before.collect(), kept.collect())
        if name != "packing":
            assert kept.columns == documents.columns

    clean = {r.doc_id for r in steps["toxicity"][1]}
    assert clean == {i for i, _, _ in rows if i < 400}

    before, after = steps["line_dedup"]
    want = deduplicated([(r.doc_id, r.text) for r in before])
    left = {(r.doc_id): want[r.doc_id, r.text] for r in before if words_of(want[r.doc_id, r.text])}
    assert {r.doc_id: r.text for r in after} == left
    assert all(r.n_chars == len(r.text) for r in after)
    assert 201 not in left and passage in left[300] and all(passage not in left[300 + k] for k in range(1, 5))

    before, after = steps["jaccard_join"]
    pairs = [(r.doc_id, r.text) for r in before]
    heads = {c for (_, _, c) in component_ids(pairs, 5, 80)}
    assert {r.doc_id for r in after} == heads and 202 not in heads and shingles_of(copied, 5)

    before, after = steps["mixture"]
    _check(
        [(r.doc_id, r.text, r.source) for r in before],
        mixture.mix(spark.createDataFrame(before, documents.schema)).collect(),
    )
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}

    before, after = steps["packing"]
    ends = [r for r in after if r.start + r.length and r.piece == 0]
    assert sorted(r.doc_id for r in ends) == sorted(r.doc_id for r in before)
    assert sum(r.length for r in after) >= sum(len(words_of(r.text)) for r in before)

    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in after)
    # What the run saved on its way is gone; its result alone is left.
    scratch = Path(scratch_root(spark).removeprefix("file:")) / "tickerloom"
    before = {p.name for p in scratch.iterdir()}
    out = corpus_pipeline.run(spark, str(tmp_path))
    left = [p for p in scratch.iterdir() if p.name not in before]
    tables = {p.relative_to(q).parts[0] for q in left for p in q.rglob("*.parquet")}
    assert tables == {"packing"} and out.count() == len(after)


def test_pipeline_of_nothing(spark, tmp_path):
    """No documents; then documents, an empty and a null text among them, without labels."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/a/labels.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").collect() == []
    rows = [(1, prose(1, 30), "en", "s", 3), (2, None, "en", "s", None), (3, "", None, None, 0), (None, prose(2, 30), "en", "s", 1)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/b/labels.parquet")
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/b").collect()} >= {1, None}


def test_only_tables_of_ones_own_are_discarded(spark, tmp_path):
    with pytest.raises(ValueError, match="scratch"):
        discard(spark, str(tmp_path))
    with scratch_run(spark) as path:
        inside = saved(spark.range(3), "numbers").inputFiles()
        assert all(path in name for name in inside)
    outside = saved(spark.range(3), "numbers")
    assert outside.count() == 3 and not Path(path.removeprefix("file:")).exists()


def test_handed_weights(spark):
    """Documents with a high score are taken before others; nulls last."""
    docs = spark.createDataFrame(
        [(i, prose(i, 10), "ab"[i % 2], 0.9 if i < 300 else 0.01 if i < 600 else None) for i in range(900)],
        "doc_id long, text string, source string, score double",
    )
    found = {r.doc_id: r.copies for r in mixture.mix(docs, weight="score").collect()}
    more = [max(found.values()) == found[i] for i in range(900)]
    assert sum(more[:300]) > 1.4 * sum(more[300:600]) and sum(more[600:]) <= sum(more[300:600])
    taken = defaultdict(int)
    for r in mixture.mixed_documents(docs, weight="score").collect():
        taken[r.doc_id] += 1
    assert taken == {i: n for i, n in found.items() if n}


def test_documents_without_words_come_no_more_than_the_epochs(spark):
    rows = [(i, "", "a") for i in range(60)] + [(100, "one two", "a")] + [(200 + i, prose(i, 50), "b") for i in range(40)]
    copies = defaultdict(int)
    for r in mixture.mixed_documents(table(spark, rows)).collect():
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 3
