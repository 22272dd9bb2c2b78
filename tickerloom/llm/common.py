"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.scratch import saved

__all__ = ["column", "fit_logistic", "fresh", "give_back", "is_held_out", "labelled_sample", "saved", "sigmoid", "small_batches", "table"]


#: Distinct texts of one id that are examples.
TEXTS_PER_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, or a variant that no column of ``taken`` has (Spark ignores case)."""
    lower = {column.lower() for column in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def column(df: DataFrame, name: str) -> Column:
    """A column by its literal name, dots and back ticks included."""
    return df["`" + name.replace("`", "``") + "`"]


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows_per_class: int,
    max_bytes: int,
    seed: int = 17,
) -> tuple[list[tuple[str, int]], float]:
    """Distinct training texts with their label, and the share of label 1 among all training labels.

    Only ids that are not held out take part, and of these at most
    ``rows_per_class`` per label, picked by a hash of the id; texts over
    ``max_bytes`` are passed over.  Of an id that repeats, the ``TEXTS_PER_ID``
    distinct texts with the least hashes count.  So at most
    ``2 * rows_per_class * TEXTS_PER_ID * max_bytes`` bytes come to the driver,
    however often ids and texts repeat.  An id with two different labels is no
    example.
    """
    marks = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("mark"))
        .filter(F.col("doc_id").isNotNull() & F.col("mark").isin(0, 1) & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("mark").alias("mark"), F.max("mark").alias("other"))
        .filter(F.col("mark") == F.col("other"))
        .select("doc_id", "mark")
    )
    counts = dict(marks.groupBy("mark").count().collect())  # two rows at most
    total = sum(counts.values())
    order = F.xxhash64(F.lit(seed), "doc_id")
    picked = None
    for mark in (0, 1):
        some = marks.filter(F.col("mark") == mark).orderBy(order, "doc_id").limit(rows_per_class)
        picked = some if picked is None else picked.unionAll(some)
    texts = docs.select("doc_id", F.col("text")).filter(F.octet_length("text") <= max_bytes)
    # 2 * rows_per_class narrow rows: a bounded broadcast.
    found = texts.join(F.broadcast(picked), "doc_id").withColumn("hash", F.xxhash64("text"))
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("hash"))
    few = found.dropDuplicates(["doc_id", "hash"]).withColumn("turn", turn).filter(F.col("turn") <= TEXTS_PER_ID)
    rows = few.select("doc_id", "text", "mark").collect()
    first: dict[str, tuple[int, int]] = {}
    for doc_id, text, mark in sorted(rows):
        first.setdefault(text, (doc_id, mark))
    sample = [(text, mark) for text, (_, mark) in first.items()]
    return sample, (counts.get(1, 0) / total if total else 0.5)


def give_back() -> None:
    """Returns a worker's free memory to the machine: workers live on from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


@contextmanager
def small_batches(spark: SparkSession, max_bytes: int = 8 << 20) -> Iterator[None]:
    """For jobs run inside, bounds the bytes that the JVM and a Python worker exchange at a time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last is the intercept."""
    design = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(design.shape[1])
    keep = ridge * np.eye(design.shape[1])
    keep[-1, -1] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + keep @ beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + keep
        step = np.linalg.solve(hessian, gradient)
        beta -= step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-7:
            break
    return beta
