"""From raw documents to packed token sequences; every stage is one operator of ``tickerloom.llm``.

A stage takes the documents that its predecessor kept, with all their columns,
and its result is written as Parquet and read again before the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import jaccard_join, line_dedup, mixture, packing, toxicity
from tickerloom.llm.common import fresh, table
from tickerloom.scratch import discard, scratch_path, scratch_run

#: Bytes that the JVM and a Python worker exchange at a time. Every batch is held several times
#: over, next to an executor's heap, which by the later stages has grown to its limit.
BATCH_BYTES = 8 << 20
#: Words that the tokenizer remembers; the query of its own has more memory to spare.
MEMO_ENTRIES = 200_000


def _small_batches(spark: SparkSession) -> None:
    """For this job, as its result is computed after the stage has returned."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go. The model is learned from the labelled rows of the input.

    Null and empty texts score as texts without hits; without labels all score alike.
    """
    _small_batches(spark)
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that occurred before are cut; a document that loses its last word goes; ``n_chars`` is renewed.

    Null and empty texts stay; rows of one id and text are one place.
    """
    lost = fresh(docs.columns, "_lost")
    cut = line_dedup.dedup_lines(docs, removed=lost)
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = cut.filter((F.col(lost) == 0) | worded)
    if "n_chars" in docs.columns:
        chars = F.when(F.col(lost) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", chars)
    return kept.drop(lost)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five-word shingles the one with the least id stays.

    Null and empty texts all stay; a null id stays only where a group has no other.
    """
    _small_batches(spark)
    return jaccard_join.one_per_component(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, three times at most; a null source is one of its own."""
    return mixture.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their place in sequences of 2048 tokens; a null text is an empty one."""
    _small_batches(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, path, with_ids=True, memo_entries=MEMO_ENTRIES, forget=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("mixture", mix_sources),
    ("packing", pack),
]

#: The toxicity model and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each result written and read again.

    What a stage saves on its way, and its input if that is a stage's result, is
    deleted once its result is written.  An empty table gives an empty one.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_run(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
