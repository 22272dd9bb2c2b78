"""Token counts and packing against the libraries."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tests.llm.helpers import awkward_texts, prose, table
from tickerloom.llm import packing, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "  a  b ", "\n", " \n\n x", "a\nb\n", "▁x▁▁y", "\t\r\n é", "\x00 a", "日本 語\n", "ſ K Å ﬁ ½", "<s> </s> <unk>",
    "It's I'LL we'd!'s ''s x²½ªº ÀÉ — “q” …", "a\x85b\xa0c\x1cd", "Σίσυφος ΟΔΟΣ", "<|endoftext|>x <|startoftext|>",
    "İstanbul ıI", "é ö", "​zero﻿", "x" * 5000, "www.example.com/a?b=c&d=e", "😀😀 👍🏽",
]


def _texts():
    rng = random.Random(2)
    letters = "aeionrst AEIO.,'’-\n\t  éß0123½²…€"
    return [t for _, t, _ in awkward_texts()] + ODD + ["".join(rng.choices(letters, k=200)) for _ in range(60)]


def test_counts_match_the_library():
    counter = token_counts.UnitCounter(PIECES)
    assert counter.by_unit and len(counter.whole) > 30_000
    for text in _texts():
        assert counter.count(text) == (len(counter.model.encode(text)) if text else 0), text


def test_every_whole_token_encodes_alone():
    counter = token_counts.UnitCounter(PIECES)
    for unit in random.Random(1).sample(sorted(counter.whole), 500):
        assert len(counter.model.encode("\n" + unit)) == len(counter.model.encode("\n")) + 1


def test_count_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_ENTRIES", 50)
    counter = token_counts.UnitCounter(PIECES)
    for k in range(30):
        text = prose(k, 80)
        assert counter.count(text) == len(counter.model.encode(text))
    assert len(counter.memo) < len(counter.whole) + 400


def test_count_rows(spark):
    found = token_counts.token_counts(table(spark), PIECES, limit=100).collect()
    assert len(found) == len(awkward_texts())
    counter = token_counts.UnitCounter(PIECES)
    want = sorted(
        (i or -99, len((t or "").encode()), len(counter.model.encode(t)) if t else 0) for i, t, _ in awkward_texts()
    )
    assert sorted((r.doc_id or -99, r.n_bytes, r.n_tokens) for r in found) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in found)
    assert token_counts.token_counts(table(spark, []), PIECES).collect() == []


def test_ids_match_the_library():
    tokenizer = packing.WordTokenizer(WORDS)
    assert tokenizer.by_word
    for text in _texts():
        want = tokenizer.library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(tokenizer.ids(text), "<u4").tolist() == want, text


def test_id_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 40)
    tokenizer = packing.WordTokenizer(WORDS)
    for k in range(30):
        text = prose(k, 60)
        assert np.frombuffer(tokenizer.ids(text), "<u4").tolist() == tokenizer.library.encode(text).ids
    assert len(tokenizer.memo) <= 300
    texts = _texts()
    want = [tokenizer.library.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in tokenizer.ids_of(texts)] == want


def _fill(counts, capacities):
    """Sequences as lists of (offset, length) from a plan, checked for gaps and capacities."""
    plan = packing.best_fit(counts, capacities).tolist()
    held = {}
    for at, (length, first, sequence, each, offset) in enumerate(plan):
        last = plan[at + 1][1] if at + 1 < len(plan) and plan[at + 1][0] == length else counts[length]
        for rank in range(first, last):
            turn = rank - first
            held.setdefault(sequence + turn // each, []).append((offset + turn % each * length, length))
    tokens, documents, cost = capacities.vector().tolist()
    for pieces in held.values():
        pieces.sort()
        at = 0
        for offset, length in pieces:
            assert offset == at
            at += length
        assert at <= tokens and len(pieces) <= documents and sum(n * n for _, n in pieces) <= cost
    assert sum(map(len, held.values())) == sum(counts.values())
    return held


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(None, None), (3, None), (None, 2500), (2, 3000)])
def test_best_fit_keeps_every_capacity(rule, limits):
    rng = random.Random(4)
    for _ in range(20):
        counts = {rng.randint(1, 50): rng.randint(1, 40) for _ in range(rng.randint(1, 30))}
        caps = packing.Capacities(tokens=50, documents=limits[0], cost=limits[1], rule=rule)
        if limits[1]:
            counts = {n: c for n, c in counts.items() if n * n <= limits[1]}
        _fill(counts, caps)


def _least_sequences(lengths, capacity):
    """A bound from below: large pieces need a sequence each, the rest at least the room that those leave."""
    best = -(-int(lengths.sum()) // capacity)
    for small in range(capacity // 2 + 1):
        alone = int((lengths > capacity - small).sum())
        large = lengths[(lengths > capacity // 2) & (lengths <= capacity - small)]
        rest = int(lengths[(lengths >= small) & (lengths <= capacity // 2)].sum())
        room = len(large) * capacity - int(large.sum())
        best = max(best, alone + len(large) + max(0, -(-(rest - room) // capacity)))
    return best


@pytest.mark.parametrize("most", [300, 1000, 2048])
def test_best_fit_is_near_the_bound(most):
    rng = np.random.default_rng(most)
    lengths = rng.integers(1, most + 1, 20_000)
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    held = _fill(counts, packing.Capacities())
    assert len(held) <= 1.003 * _least_sequences(lengths, 2048)


def test_best_fit_of_one_length_and_of_nothing():
    assert len(_fill({7: 1000}, packing.Capacities(tokens=50))) == -(-1000 // 7)
    assert len(packing.best_fit({}, packing.Capacities())) == 0
    with pytest.raises(ValueError, match="51 tokens"):
        packing.best_fit({51: 1}, packing.Capacities(tokens=50))


def test_sequences_hold_the_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 5)
    capacities = packing.Capacities(tokens=128)
    packed = packing.pack_documents(table(spark), WORDS, capacities=capacities, with_ids=True).cache()
    sequences = {r.sequence_id: r for r in packing.packed_sequences(packed).collect()}
    assert all(len(r.ids) == 4 * r.length <= 512 for r in sequences.values())
    texts = {}
    tokenizer = packing.WordTokenizer(WORDS)
    whole = {}
    for r in packed.collect():
        part = bytes(sequences[r.sequence_id].ids)[4 * r.offset : 4 * (r.offset + r.length)]
        assert part == bytes(r.ids) and r.ids_crc32 == zlib.crc32(part) and r.start == 128 * r.piece
        whole.setdefault((r.doc_id, r.piece), []).append(part)
    for doc_id, text, _ in awkward_texts():
        texts.setdefault(doc_id, []).append(tokenizer.ids(text) + b"\0\0\0\0")
    for doc_id, all_ids in texts.items():
        for piece in range(-(-max(map(len, all_ids)) // 512)):
            want = sorted(ids[512 * piece : 512 * (piece + 1)] for ids in all_ids if len(ids) > 512 * piece)
            assert sorted(whole[doc_id, piece]) == want
    assert sum(r.length for r in sequences.values()) == sum(len(x) // 4 for ids in texts.values() for x in ids)


def test_texts_are_packed_in_small_batches(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(name), []

    def pack(pieces, capacities):
        seen.append(int(spark.conf.get(name)))
        raise RuntimeError("far enough")

    monkeypatch.setattr(packing, "pack", pack)
    with pytest.raises(RuntimeError, match="far enough"):
        packing.pack_documents(table(spark), WORDS)
    assert seen == [8 << 20] and spark.conf.get(name) == before


def test_packing_nothing(spark):
    assert packing.pack_documents(table(spark, []), WORDS).collect() == []


def plain_best_fit(lengths, capacities):
    """Longest first, one piece at a time, into the open sequence that fits best; how full the sequences get."""
    full = capacities.vector()
    weights = np.array(capacities.weights)
    left = []
    for length in sorted(lengths, reverse=True):
        demand = np.array([length, 1, length * length])
        fits = [k for k, x in enumerate(left) if (x >= demand).all()]
        if not fits:
            left.append(full - demand)
            continue
        if capacities.rule == "norm":
            score = [float((((left[k] - demand) / full) ** 2) @ weights) for k in fits]
        else:
            score = [-float((left[k] / full * (demand / full)) @ weights) for k in fits]
        k = fits[int(np.argmin(score))]
        left[k] = left[k] - demand
    return sorted(tuple(int(x) for x in one) for one in left)


@pytest.mark.parametrize(
    "capacities",
    [
        packing.Capacities(tokens=100),
        packing.Capacities(tokens=100, documents=3),
        packing.Capacities(tokens=100, cost=4000),
        packing.Capacities(tokens=64, documents=5, cost=1500, weights=(1.0, 1.0, 1.0)),
    ],
)
def test_groups_are_packed_like_single_pieces(capacities):
    """Moving whole groups of sequences at once gives as many sequences as piece by piece, filled within all capacities."""
    rng = random.Random(capacities.tokens)
    most = min(capacities.tokens, int((capacities.cost or 10**6) ** 0.5))
    for _ in range(20):
        lengths = [min(most, 1 + int(rng.expovariate(1 / 20))) for _ in range(rng.randint(1, 300))]
        counts = dict(Counter(lengths))
        plan = packing.best_fit(counts, capacities)
        used = {}
        for length, n in counts.items():
            rows = plan[plan[:, 0] == length]
            for rank in range(n):
                _, first, sequence, each, _ = rows[np.searchsorted(rows[:, 1], rank, side="right") - 1]
                at = int(sequence + (rank - first) // each)
                used.setdefault(at, np.zeros(3, int))
                used[at] += [length, 1, length * length]
        assert all((x <= capacities.vector()).all() for x in used.values())
        want = plain_best_fit(lengths, capacities)
        assert len(used) <= 1.02 * len(want) + 1

