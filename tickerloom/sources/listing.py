"""File inventories, through Hadoop's file systems so that any store works.

They run in the driver and list one folder, never what is below it.  They need
the JVM of a classic session; under Spark Connect there is none, and they say so.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: names of the quote files in their directory.
QUOTE_FILES = "COTAHIST*.TXT"


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


@dataclass(frozen=True)
class Entry:
    """A file or folder: its size in bytes and its time in milliseconds."""

    name: str
    path: str
    folder: bool
    length: int
    modified: int


def _hadoop_path(spark: SparkSession, *parts: str):
    """A Hadoop path, its file system and the JVM."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        raise RuntimeError("files are listed through the session's JVM, which Spark Connect does not give access to")
    path = jvm.org.apache.hadoop.fs.Path(parts[0])
    for part in parts[1:]:
        path = jvm.org.apache.hadoop.fs.Path(path, part)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm


def entries(spark: SparkSession, directory: str, pattern: str | None = None) -> list[Entry] | None:
    """Files and folders directly in ``directory`` by name; None if there is no such directory.

    ``pattern`` is a case-sensitive glob.  Hidden ones (leading ``.`` or ``_``) are left out.
    """
    root, system, _ = _hadoop_path(spark, directory)
    if not system.exists(root):
        return None
    found = system.listStatus(root) if pattern is None else system.globStatus(_hadoop_path(spark, directory, pattern)[0])
    listed = [
        Entry(one.getPath().getName(), one.getPath().toString(), one.isDirectory(), one.getLen(), one.getModificationTime())
        for one in found or []  # a name without wildcards that is not there gives null
    ]
    return sorted((one for one in listed if one.name[0] not in "._"), key=lambda one: one.name)


def first_lines(spark: SparkSession, paths: Iterable[str]) -> list[str | None]:
    """The first line of each file that isn't blank, None without one; nothing after it is read, but for a buffer."""

    def first(name: str) -> str | None:
        path, system, jvm = _hadoop_path(spark, name)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
        stream = system.open(path)
        try:
            plain = stream if codec is None else codec.createInputStream(stream)
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
            while (line := reader.readLine()) is not None:
                if line.strip():
                    return line
            return None
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(first, paths))


def list_files(spark: SparkSession, directory: str, pattern: str | None = None) -> DataFrame:
    """Files directly in ``directory`` sorted by name; empty when there is no such directory.

    Only names, sizes and times are read, never contents, and nothing below the
    directory.  ``pattern`` is a case-sensitive glob.  Hidden files (leading ``.``
    or ``_``) are left out.
    """
    found = entries(spark, directory, pattern) or []
    rows = [(one.name, one.path, one.length, one.modified) for one in found if not one.folder]
    listed = spark.createDataFrame(rows, "name string, path string, length bigint, modified bigint")
    return listed.withColumn("modified", F.timestamp_millis("modified")).orderBy("name")


def list_quote_files(spark: SparkSession, directory: str) -> DataFrame:
    """The quote files of a directory, sorted by name."""
    return list_files(spark, directory, QUOTE_FILES)
