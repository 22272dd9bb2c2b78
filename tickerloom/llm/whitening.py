"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation (operator 13).

Entries become integers, so that sums and deviations from the mean are exact, and
every distinct vector counts once.  With X the centred distinct vectors, the
recurrence alternates products X v and X' u and builds orthonormal u's and v's in
which X is a small upper bidiagonal matrix.  The singular values and right vectors
of that matrix give the components and their deviations.

Rows stay where they are.  A left vector u has an entry per row and lies in the
range of X, so it is kept as the p with u = X p, and a scan makes its entries again
wherever it needs them.  One scan per step forms w = X q, the products of w with all
earlier left vectors and with X; w is made orthogonal with these, and scanned anew
if much had to be taken off.  A scan returns a few numbers per dimension, added up
by Spark.  Right vectors have an entry per dimension and live on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import column, saved

#: Entries of vectors that a task multiplies at a time.
ENTRIES_AT_ONCE = 1 << 20
#: Singular values under this share of the largest are taken for zero.
RANK = 1e-11
#: What a component may be off by, as a share of the largest singular value.
RESIDUAL = 1e-14


def whole_vectors(embeddings: DataFrame, *, vector: str, id: str, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``id`` and ``x``, floor(scale * entry) + shift for each entry, of rows whose vector and entries are finite."""
    entry = column(embeddings, vector)

    def unusable(value: Column) -> Column:
        value = value.cast("double")
        return value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))

    usable = entry.isNotNull() & ~F.exists(entry, unusable)
    whole = F.transform(entry, lambda value: F.floor(value.cast("double") * scale).cast("long") + shift)
    return embeddings.filter(usable).select(column(embeddings, id).alias("id"), whole.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], at: int, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of batches with their integer vectors as rows."""
    step = max(1, ENTRIES_AT_ONCE // dims)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            some = batch.slice(start, step)
            yield some, some.column(at).flatten().to_numpy().reshape(-1, dims)


def _summed(fit: DataFrame, dims: int, width: int, of: Callable[[np.ndarray], np.ndarray], kind: type) -> list:
    """The sum over all vectors of ``of(vectors)``, which has ``width`` numbers; integers are summed exactly."""
    whole = kind is int

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object if whole else float)
        for _, x in _matrices(batches, 0, dims):
            total = total + of(x)
        if whole:
            values = pa.array([int(value) for value in total], pa.decimal128(38, 0))
        else:
            values = pa.array(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), values], names=["place", "value"])

    value = "decimal(38,0)" if whole else "double"
    rows = fit.select("x").mapInArrow(partial, f"place bigint, value {value}")
    sums = {r["place"]: r["s"] for r in rows.groupBy("place").agg(F.sum("value").alias("s")).collect()}
    return [sums.get(place, 0) for place in range(width)]


class Fit:
    """What whitening needs: ``n``, exact ``sums``, unit ``components`` as columns, eigenvalues ``e`` and their ``trace``."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, e: np.ndarray, trace: float):
        self.n, self.sums, self.components, self.e, self.trace = n, sums, components, e, trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.components) / np.sqrt(self.e)


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit where that holds every number, else as Python's integers."""
    most = n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums), default=0)
    if most < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _differences(x, n, sums).astype(float) / n


def _bidiagonal(
    scan: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]], dims: int, wanted: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (as columns) and singular values of X, the largest ``wanted``, falling.

    ``scan(q, p)`` gives, for w = X q and U = X p, the square of |w|, U'w and X'w.
    """
    rng = np.random.default_rng(seed)
    right = np.zeros((dims, 0))
    left = np.zeros((dims, 0))  # u = X p for the columns p
    back = np.zeros((dims, 0))  # X'u
    diagonal: list[float] = []
    above: list[float] = []

    def apart(vector: np.ndarray) -> np.ndarray:
        for _ in range(2):
            vector = vector - right @ (right.T @ vector)
        return vector

    largest, beta = 0.0, 0.0
    v = rng.standard_normal(dims)
    v /= np.linalg.norm(v)
    while True:
        right = np.column_stack([right, v])
        q = v - beta * left[:, -1] if beta else v
        for _ in range(4):
            square, along, z = scan(q, left)
            q = q - left @ along
            z = z - back @ along
            off = float(along @ along)
            # Enough was left of it: what was taken off is no larger than rounding makes it.
            if off <= 1e-24 * max(square, (1e-2 * largest) ** 2):
                break
        alpha = float(np.sqrt(max(square - off, 0.0)))
        largest = max(largest, alpha)
        if alpha > RANK * max(largest, 1e-300):
            left, back = np.column_stack([left, q / alpha]), np.column_stack([back, z / alpha])
            following = apart(back[:, -1] - alpha * v)
        else:
            # X v lies among the left vectors there are: no new one, and a zero.
            alpha = 0.0
            left, back = np.column_stack([left, np.zeros(dims)]), np.column_stack([back, np.zeros(dims)])
            following = np.zeros(dims)
        diagonal.append(alpha)
        size = len(diagonal)
        beta = float(np.linalg.norm(following))
        largest = max(largest, beta)
        small = np.diag(diagonal) + np.diag(above, 1)
        u, s, vt = np.linalg.svd(small)
        if size == dims:
            break
        if beta > RANK * largest:
            # The last entries of the left vectors tell how far the values still are from settled.
            if size > wanted and beta * np.abs(u[-1, :wanted]).max() <= RESIDUAL * s[0]:
                break
            v = following / beta
        else:
            # A space that X maps into itself is used up; another one may hold more, or an equal value again.
            beta = 0.0
            v = apart(rng.standard_normal(dims))
            v /= np.linalg.norm(v)
        above.append(beta)
    keep = [k for k in range(min(wanted, len(s))) if s[k] > RANK * max(s[0], 1e-300)]
    return right @ vt.T[:, keep], s[keep]


def fit_whitening(vectors: DataFrame, *, components: int = 16, seed: int = 7) -> tuple[Fit | None, float | None]:
    """The fit on the distinct ``x`` of ``vectors``, and the identity error; None without vectors.

    The identity error is the largest entry of the whitened vectors' covariance
    less the identity; null without a component.  It is an error if the vectors'
    lengths differ.
    """
    fit = saved(vectors.select("x").filter(F.size("x") > 0).distinct(), "distinct_vectors")
    n, dims, other = fit.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return None, None
    if dims != other:
        raise ValueError(f"vectors of {dims} and of {other} entries")
    sums = [int(s) for s in _summed(fit, dims, dims, lambda x: x.astype(object).sum(axis=0), int)]
    total = _summed(fit, dims, 1, lambda x: np.array([(_centred(x, n, sums) ** 2).sum()]), float)[0]

    def scan(q: np.ndarray, p: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        both = np.column_stack([q, p])

        def products(x: np.ndarray) -> np.ndarray:
            y = _centred(x, n, sums)
            w = y @ both
            return np.concatenate([w.T @ w[:, 0], y.T @ w[:, 0]])

        found = np.array(_summed(fit, dims, both.shape[1] + dims, products, float))
        return float(found[0]), found[1 : both.shape[1]], found[both.shape[1] :]

    if not total:  # all vectors are equal
        return Fit(n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0), None
    right, s = _bidiagonal(scan, dims, components, seed)
    right = right * np.where(right[np.abs(right).argmax(axis=0), np.arange(right.shape[1])] < 0, -1.0, 1.0)
    made = Fit(n, sums, right, s**2 / n, total / n)

    def moments(x: np.ndarray) -> np.ndarray:
        white = made.whitened(x)
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    k = len(s)
    found = np.array(_summed(fit, dims, k + k * k, moments, float)) / n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    return made, float(np.abs(covariance - np.eye(k)).max())


def whitened(
    embeddings: DataFrame, *, id: str = "vec_id", vector: str = "embedding", components: int = 16
) -> DataFrame:
    """Per row and component the id under its name, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows with a null vector, or null or non-finite entries, are left out.
    Repeated rows and null ids stay; other columns go.  There are as many
    components as the distinct vectors have rank, up to ``components``: none for
    an empty table, for empty vectors, or where all vectors are equal.  Equal
    eigenvalues keep an arbitrary basis of their space.  A deviation that no long
    holds is an error, and so are vectors of different lengths.
    """
    read = whole_vectors(embeddings, vector=vector, id=id)
    fit, error = fit_whitening(read, components=components)
    schema = T.StructType(
        [
            T.StructField(id, embeddings.schema[id].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if fit is None or not len(fit.e):
        return embeddings.sparkSession.createDataFrame([], schema)
    made, k, dims = fit, len(fit.e), len(fit.sums)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, x in _matrices(batches, 1, dims):
            apart = _differences(x, made.n, made.sums)
            if apart.dtype != object and dims * max(int(apart.max()), -int(apart.min())) ** 2 < 1 << 63:
                deviation = (apart * apart).sum(axis=1)
            else:
                deviation = (apart.astype(object) ** 2).sum(axis=1)  # beyond a long, Arrow raises an error
            take = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0).take(take),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, made.n)),
                    pa.array([int(d) for d in deviation], pa.int64()).take(take),
                    pa.array(made.whitened(x).ravel()),
                    pa.array(np.tile(made.e / made.trace, len(x))),
                    pa.array(np.full(len(x) * k, error)),
                ],
                names=schema.names,
            )

    return read.filter(F.size("x") > 0).select("id", "x").mapInArrow(rows, schema)
