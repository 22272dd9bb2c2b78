"""Approximate nearest neighbours by an inverted multi-index (operator 5).

Vectors are scaled to length one and cut into halves; each half is quantised by
its own centroids, so a pair of centroids names one of k * k cells.  For a query
the pairs are visited in the order of their summed distance, with a heap, until
the cells seen hold a given share of all vectors.  The vectors of these cells
are then ranked by the exact cosine of the original vectors.

Equal vectors are one entry with the least of their ids, as many as a result can
show.  Entries lie in shards of bounded size; queries are streamed past the
shards that hold a cell they want.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import column, saved

#: Entries in a shard, queries that pass one copy of it, and queries multiplied at a time.
SHARD = 8192
STREAM = 100_000
STEP = 128
#: Scores from a matrix product are compared with this much room, then computed again exactly.
ROOM = 1e-9


@dataclass(frozen=True)
class MultiIndex:
    """Centroids of both halves (k by half the dimensions) and the share of entries a query looks at."""

    first: np.ndarray
    second: np.ndarray
    share: float

    @property
    def k(self) -> int:
        return len(self.first)

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the halves of unit vectors to the centroids."""
        cut = self.first.shape[1]
        return _squared(unit[:, :cut], self.first), _squared(unit[:, cut:], self.second)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        one, two = self.distances(unit)
        return one.argmin(axis=1).astype(np.int64) * self.k + two.argmin(axis=1)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1), 0)


def _centroids(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """k-means; a centroid that loses all its points stays where it was."""
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        nearest = _squared(x, c).argmin(axis=1)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, nearest, x)
        c[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return c


def visited(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, budget: float) -> tuple[list[int], float]:
    """Cells in the order of summed distance until they hold ``budget`` entries, and the last distance.

    ``one`` and ``two`` are a query's distances to the centroids of the halves.
    A pair is put on the heap when the pairs before it in both orders are done.
    """
    k = len(one)
    a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    first, second = one[a].tolist(), two[b].tolist()
    reached = [-1] * k  # how far the second order is done, per place in the first
    heap = [(first[0] + second[0], 0, 0)]
    cells: list[int] = []
    held, last = 0, 0.0
    while heap and held < budget:
        last, i, j = heapq.heappop(heap)
        reached[i] = j
        cell = int(a[i]) * k + int(b[j])
        cells.append(cell)
        held += int(sizes[cell])
        if j + 1 < k and (i == 0 or reached[i - 1] >= j + 1):
            heapq.heappush(heap, (first[i] + second[j + 1], i, j + 1))
        if i + 1 < k and reached[i + 1] == j - 1:
            heapq.heappush(heap, (first[i + 1] + second[j], i + 1, j))
    return cells, last


def fit_index(sample: np.ndarray, entries: int, *, k: int | None, max_k: int, recall: float, seed: int) -> MultiIndex:
    """Centroids from a sample of unit vectors, and the share that finds ``recall`` of its neighbours.

    The share is measured on the sample: for up to 200 of its vectors, how much
    of the sample must be seen until a true neighbour's cell is reached.
    """
    rng = np.random.default_rng(seed)
    k = k or max(2, min(max_k, math.ceil(math.sqrt(entries / 16)), max(2, len(sample) // 8)))
    half = max(1, sample.shape[1] // 2)
    index = MultiIndex(_centroids(sample[:, :half], k, rng), _centroids(sample[:, half:], k, rng), 1.0)
    if len(sample) < 64:
        return index
    cells = index.cells(sample)
    sizes = np.bincount(cells, minlength=k * k)
    needed = []
    for q in rng.choice(len(sample), min(200, len(sample)), replace=False):
        near = sample @ sample[q]
        near[q] = -2
        nearest = np.argpartition(-near, 5)[:5]
        one, two = (d[0] for d in index.distances(sample[q : q + 1]))
        summed = (one[:, None] + two[None]).ravel()
        for v in nearest:
            needed.append(sizes[summed <= summed[cells[v]]].sum() / len(sample))
    return MultiIndex(index.first, index.second, float(min(1.0, np.quantile(needed, recall))))


def _doubles(raw: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in raw), "<f8").reshape(len(raw), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine in double precision, sums rounded once."""
    return math.fsum(a * b) / (math.sqrt(math.fsum(a * a)) * math.sqrt(math.fsum(b * b)))


def _packed(vector: Column) -> Column:
    """Vectors as bytes of doubles; null if null, empty, zero or not finite."""

    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        out = []
        for vector in vectors:
            values = vector.as_py()
            if not values or None in values:
                out.append(None)
                continue
            x = np.array(values, "<f8") + 0.0  # no negative zeros
            out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
        return pa.array(out, pa.binary())

    return pack(vector)


def _entries(rows: DataFrame, shown: int) -> DataFrame:
    """Distinct vectors with their ``shown`` least ids; the rank filter also limits each task's rows before the shuffle."""
    turn = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    few = rows.withColumn("turn", turn).filter(F.col("turn") <= shown)
    return few.groupBy("key").agg(F.first("vec").alias("vec"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _wanted(index: MultiIndex, sizes: np.ndarray, budget: float, shard_of: np.ndarray, shards_in: np.ndarray):
    """Per query vector the distance up to which cells count, and the shards to visit."""

    @F.arrow_udf("struct<reach:double,shards:array<int>>")
    def want(vectors: pa.Array) -> pa.Array:
        rows = []
        if len(vectors):
            unit = _unit(_doubles(vectors))
            one, two = index.distances(unit)
            for i in range(len(unit)):
                cells, reach = visited(one[i], two[i], sizes, budget)
                held = [c for c in cells if sizes[c]]
                shards = sorted({int(shard_of[c]) + s for c in held for s in range(int(shards_in[c]))})
                rows.append({"reach": reach, "shards": shards})
        return pa.array(rows, pa.struct([("reach", pa.float64()), ("shards", pa.list_(pa.int32()))]))

    return want


def _best(index: MultiIndex, shown: int):
    """Streams queries past the entries of their shard; partitions are sorted by place, entries first."""

    def score(entries: dict, queries: pa.Table) -> Iterator[pa.RecordBatch]:
        vectors = _doubles(queries.column("vec").combine_chunks())
        reach = queries.column("reach").to_numpy()
        keys = queries.column("key").to_pylist()
        for lo in range(0, len(vectors), STEP):
            x = vectors[lo : lo + STEP]
            unit = _unit(x)
            one, two = index.distances(unit)
            summed = one[:, entries["a"]] + two[:, entries["b"]]
            near = unit @ entries["unit"].T
            near[summed > reach[lo : lo + STEP, None] + 1e-12] = -3
            rows = []
            for i in range(len(x)):
                seen = near[i]
                # ``shown`` ids may come from as many entries.
                least = np.partition(seen, -shown)[-shown] if len(seen) > shown else -2
                for v in np.flatnonzero((seen >= least - ROOM) & (seen > -2)):
                    rows.append((keys[lo + i], entries["ids"][v], cosine(x[i], entries["raw"][v])))
            if rows:
                key, ids, scores = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.binary()), pa.array(ids, pa.list_(pa.int64())), pa.array(scores, pa.float64())],
                    names=["key", "ids", "score"],
                )

    def loaded(rows: list[pa.Table]) -> dict:
        table = pa.concat_tables(rows)
        raw = _doubles(table.column("vec").combine_chunks())
        cell = table.column("cell").to_numpy()
        return {
            "raw": raw, "unit": _unit(raw), "a": cell // index.k, "b": cell % index.k,
            "ids": table.column("ids").to_pylist(),
        }

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, entries, waiting = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            places = table.column("place").to_numpy()
            for lo, hi in zip(
                starts := np.flatnonzero(np.diff(places, prepend=places[0] - 1)), [*starts[1:], len(places)]
            ):
                part = table.slice(lo, hi - lo)
                if places[lo] != place:
                    place, entries, waiting = places[lo], None, []
                query = part.column("query").to_numpy(zero_copy_only=False)
                cut = int(np.argmax(query)) if query.any() else len(query)
                if cut:
                    waiting.append(part.slice(0, cut))
                if cut < len(query):
                    if entries is None and waiting:
                        entries, waiting = loaded(waiting), []
                    if entries is not None:
                        yield from score(entries, part.slice(cut))

    return scan


def nearest(
    vectors: DataFrame,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    every: int = 50,
    neighbours: int = 5,
    recall: float = 0.97,
    sample_rows: int = 20_000,
    k: int | None = None,
    max_k: int = 256,
    seed: int = 11,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: per query the nearest other rows found, by cosine.

    Queries are the rows whose id is divisible by ``every``.  The index is fitted
    on at most ``sample_rows`` vectors picked by a hash; all are indexed.  Vectors
    that are null, zero or hold null or non-finite components take no part,
    neither do null ids and vectors of another length than the most frequent one
    (the longer of two).  Rows with equal id and vector are one.  Rows of one id
    with different vectors are queries of their own, with a list each, and never
    neighbours of one another.  Equal scores go by id.  An empty table, or one row, gives an empty result.
    """
    shown = neighbours + 1
    read = vectors.select(column(vectors, id).cast("long").alias("vec_id"), _packed(column(vectors, vector)).alias("vec"))
    read = read.filter("vec_id IS NOT NULL AND vec IS NOT NULL").withColumn("key", F.unhex(F.sha1("vec")))
    rows = saved(read, "vectors")
    lengths = rows.groupBy(F.octet_length("vec").alias("bytes")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("bytes")).first()
    if usual is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.octet_length("vec") == usual["bytes"])
    entries = saved(_entries(rows.dropDuplicates(["vec_id", "key"]), shown), "entries")
    count = entries.count()
    sample = entries.orderBy(F.xxhash64("key"), "key").limit(sample_rows).select("vec").collect()
    unit = _unit(np.frombuffer(b"".join(row["vec"] for row in sample), "<f8").reshape(len(sample), -1))
    index = fit_index(unit, count, k=k, max_k=max_k, recall=recall, seed=seed)

    @F.arrow_udf("long")
    def cell_of(packed: pa.Array) -> pa.Array:
        return pa.array(index.cells(_unit(_doubles(packed))) if len(packed) else [], pa.int64())

    placed = saved(entries.withColumn("cell", cell_of("vec")), "placed")
    # At most max_k * max_k numbers.
    sizes = np.zeros(index.k**2, np.int64)
    for cell, n in placed.groupBy("cell").count().collect():
        sizes[cell] = n
    # Cells fill shards in order; a cell larger than a shard is spread over shards of its own.
    shard_of, shards_in = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    shard, filled = 0, 0
    for cell, n in enumerate(sizes.tolist()):
        if filled and filled + n > SHARD:
            shard, filled = shard + 1, 0
        shard_of[cell] = shard
        if n > SHARD:
            shards_in[cell] = -(-n // SHARD)
            shard, filled = shard + int(shards_in[cell]), 0
        else:
            filled += n

    @F.arrow_udf("int")
    def shard_at(cells: pa.Array, salt: pa.Array) -> pa.Array:
        cell = cells.to_numpy(zero_copy_only=False)
        return pa.array((shard_of[cell] + salt.to_numpy(zero_copy_only=False) % shards_in[cell]).astype(np.int32))

    asked = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "key").distinct()
    streams = max(1, math.ceil(asked.count() / STREAM))
    budget = max(64.0, index.share * count)
    want = _wanted(index, sizes, budget, shard_of, shards_in)
    queries = (
        placed.join(asked.select("key").distinct(), "key", "left_semi")
        .withColumn("want", want(F.col("vec")))
        .select("key", "vec", "want.reach", F.explode("want.shards").alias("shard"))
    )
    stream = F.pmod(F.xxhash64("key"), F.lit(streams)).cast("int")
    none = F.lit(None)
    passing = queries.select(
        F.xxhash64("shard", stream).alias("place"), F.lit(True).alias("query"), "key", "vec", "reach",
        none.cast("long").alias("cell"), none.cast("array<bigint>").alias("ids"),
    )
    sharded = placed.withColumn("shard", shard_at(F.col("cell"), F.pmod(F.xxhash64("key"), F.lit(1 << 30))))
    standing = sharded.withColumn("stream", F.explode(F.sequence(F.lit(0), F.lit(streams - 1)))).select(
        F.xxhash64("shard", "stream").alias("place"), F.lit(False).alias("query"), none.cast("binary").alias("key"),
        "vec", none.cast("double").alias("reach"), "cell", "ids",
    )
    met = passing.unionAll(standing).repartition("place").sortWithinPartitions("place", "query")
    found = met.mapInArrow(_best(index, shown), "key binary, ids array<bigint>, score double")
    listed = found.select("key", "score", F.explode("ids").alias("vec_id"))
    order = [F.desc("score"), F.asc("vec_id")]
    top = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    best = listed.withColumn("place", top).filter(F.col("place") <= shown).drop("place")
    answers = asked.withColumnRenamed("vec_id", "query_id").join(best, "key").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(*order))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= neighbours).select(
        "query_id", "rank", "vec_id", "score"
    )
