"""Where intermediate tables go, and when they go away."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_owner: ContextVar[str | None] = ContextVar("scratch_owner", default=None)


def scratch_root(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: the one the session names in ``spark.checkpoint.dir``.

    Only where all work runs in one process, and that setting is missing, a folder
    in the warehouse takes its place; on a cluster it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one table; never shared between two runs."""
    return f"{_owner.get() or f'{scratch_root(spark)}/tickerloom'}/{uuid.uuid4().hex}/{name}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table in the scratch folder: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table or folder that ``scratch_path`` named, and nothing else."""
    if not path.startswith(f"{scratch_root(spark)}/tickerloom/"):
        raise ValueError(f"not in the scratch folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Owns the tables that are saved inside, and deletes them at the end: write what is to stay before, elsewhere."""
    path = scratch_path(spark, "run")
    token = _owner.set(path)
    try:
        yield path
    finally:
        _owner.reset(token)
        discard(spark, path)
