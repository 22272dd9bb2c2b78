"""Whitening against numpy's eigenvectors."""

import math

import numpy as np
import pytest

from tickerloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, id string, n int, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2, "c") for i, v in rows], SCHEMA)


def check(spark, rows, k=16):
    got = whitening.whitened(table(spark, rows)).collect()
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    whole = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for _, v in usable]
    fit = np.array(sorted(set(whole)), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    covariance = centred.T @ centred / n
    e, vectors = np.linalg.eigh(covariance)
    e, vectors = e[::-1], vectors[:, ::-1]
    rank = min(k, int((e > 1e-12 * e[0]).sum()))
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert len(got) == rank * len(usable)
    assert all(r.n == n for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    signs = {}
    for (i, _), x in zip(usable, whole):
        assert set(by_id[i]) == set(range(1, rank + 1))
        exact = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        for c, found in by_id[i].items():
            assert {r.deviation for r in found} == {exact}
            assert found[0].explained == pytest.approx(e[c - 1] / e.sum(), rel=1e-9)
            want = ((n * np.array(x) - sums) / n) @ vectors[:, c - 1] / math.sqrt(e[c - 1])
            if abs(want) > 1e-6:
                sign = signs.setdefault(c, math.copysign(1, want * found[0].whitened))
            assert found[0].whitened == pytest.approx(want * signs.get(c, 1), abs=1e-6)


def test_against_eigenvectors(spark):
    rng = np.random.default_rng(3)
    spread = rng.standard_normal((300, 24)) @ np.diag(np.linspace(3, 0.2, 24)) @ rng.standard_normal((24, 24))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(spread)]
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1001, rows[0][1]), (1002, None), (1003, []), (1004, [math.nan] * 24)]
    rows += [(1005, [math.inf] + [0.0] * 23), (1006, [None] + [0.0] * 23), (1007, [c + 1e-6 for c in rows[1][1]])]
    check(spark, rows)


def test_more_dimensions_than_steps(spark):
    """The largest components settle before the recurrence has run through all dimensions."""
    rng = np.random.default_rng(4)
    strong = rng.standard_normal((400, 18)) * np.linspace(60, 15, 18)
    mixed = strong @ np.linalg.qr(rng.standard_normal((120, 18)))[0].T + 0.05 * rng.standard_normal((400, 120))
    check(spark, [(i, [float(c) for c in v]) for i, v in enumerate(mixed)])


def test_low_rank_and_equal_eigenvalues(spark):
    rng = np.random.default_rng(5)
    flat = np.round(rng.standard_normal((60, 3)) * 64) / 64
    rows = [(i, [float(c) for c in np.concatenate([v, v[:2], [0.5]])]) for i, v in enumerate(flat)]
    check(spark, rows)
    corners = [(i, [1.0 if j == i // 2 and i % 2 else -1.0 if j == i // 2 else 0.0 for j in range(5)]) for i in range(10)]
    got = whitening.whitened(table(spark, corners)).collect()
    assert len(got) == 50 and got[0].identity_error <= 1e-9  # five equal eigenvalues, any basis
    assert {round(r.explained, 9) for r in got} == {0.2}
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, []).append(r.whitened)
    assert all(np.dot(v, v) == pytest.approx(5) for v in by_row.values())


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None), (2, [])], [(1, [0.5, 1.0])], [(1, [0.5]), (2, [0.5]), (None, [0.5])]):
        found = whitening.whitened(table(spark, rows))
        assert found.collect() == []
        assert found.columns[:3] == ["vec_id", "component", "n"]


def test_null_ids_and_wrong_lengths(spark):
    got = whitening.whitened(table(spark, [(None, [0.0]), (None, [1.0]), (3, [1.0])])).collect()
    assert sorted(round(r.whitened, 9) for r in got) in ([-1, 1, 1], [-1, -1, 1])
    with pytest.raises(ValueError, match="entries"):
        whitening.whitened(table(spark, [(1, [0.0]), (2, [1.0, 2.0])]))


def test_sums_beyond_64_bits_are_exact():
    x = np.array([[1 << 40, 5]])
    assert whitening._differences(x, 1 << 30, [3, 4]).tolist() == [[(1 << 70) - 3, 5 * (1 << 30) - 4]]
