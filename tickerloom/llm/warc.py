r"""WARC archives: whole-file gzip streams rewritten with one member per record, and an offset index (operator 11).

Spark's text writer ends every row with a separator.  With ``\r\n\r\n``, which
ends a WARC record, and its gzip codec a table of records becomes archives that
are one gzip stream each.  The normaliser reads these through Spark's text reader,
which inflates a stream once and never holds more than a piece of it, cuts records
by their ``Content-Length``, and compresses each as a member of its own.  It starts
a new archive after ``archive_bytes`` of records, so that archives stay small
enough to be read whole, however large the stream was.

Members and index lines are written by one job: the same commit makes both
visible, and a task that is run again repeats both.  The text writer passes bytes
through; its separator is the zero byte in which the size at the end of a member
ends, so a file is nothing but members, one after the other.  They lie under
``part=records/archive=NAME``, the index under ``part=index/archive=NAME`` with a
JSON line, ended by a zero byte, per record.  Nothing but Spark opens a file, so
any store will do.
"""

from __future__ import annotations

import gzip
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import column, saved
from tickerloom.scratch import scratch_path

END = "\r\n\r\n"
#: Payloads from this size on are written once.
LEAST_REVISITED = 1000
#: Uncompressed bytes of records after which an archive ends.
ARCHIVE_BYTES = 32 << 20
#: Repeated payloads, and index entries, that are broadcast at most; more are joined by shuffling.
BROADCAST_ROWS = 500_000
#: Bytes of payloads that leave Python together.
BYTES_AT_ONCE = 8 << 20

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-row"
_EMPTY = gzip.compress(b"", mtime=0)


def _named(id: Column) -> Column:
    """A record id that tells the row's; without a colon for null."""
    return F.concat(F.lit(f"<{_ID}"), F.coalesce(F.concat(F.lit(":"), F.url_encode(id.cast("string"))), F.lit("")), F.lit(">"))


def _row_id(record_id: Column) -> Column:
    """The row's id, as text, from a record id."""
    inside = F.regexp_extract(record_id, f"^<{_ID}(:.*)>$", 1)
    return F.when(inside != "", F.url_decode(F.substring(inside, 2, 1 << 30)))


def records(
    pages: DataFrame,
    *,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = LEAST_REVISITED,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    r"""``record``: a WARC record per row, as text without the ``\r\n\r\n`` at its end.

    Of rows with equal payloads of ``least`` bytes the one with the largest id is
    a response and the others are revisits of it: the HTTP head alone, with the
    payload's length and digest.  Rows that repeat the largest id are responses,
    all of them; a null id is less than any, and rows with null ids alone are
    responses.  Equality is that of SHA-1 digests.  A null payload is empty; a null
    url is left out, and line ends in one are percent-encoded.
    """
    taken = F.coalesce(column(pages, payload), F.lit("")).cast("binary")
    rows = pages.select(
        column(pages, id).alias("id"),
        F.regexp_replace(F.regexp_replace(column(pages, url), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce(column(pages, payload), F.lit("")).alias("payload"),
        F.octet_length(taken).cast("long").alias("size"),
        F.sha1(taken).alias("digest"),
    )
    several = F.count(F.lit(1)) > 1
    heads = (
        rows.filter(F.col("size") >= least)
        .groupBy(F.unhex("digest").alias("same"))
        .agg(F.max("id").alias("head"), several.alias("several"))
        .filter(F.col("several") & F.col("head").isNotNull())
        .drop("several")
    )
    heads = saved(heads, "repeated_payloads")
    few = heads.count() <= BROADCAST_ROWS
    long = F.col("size") >= least
    joined = rows.join(F.broadcast(heads) if few else heads, long & (F.unhex("digest") == F.col("same")), "left")
    revisit = F.col("head").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("head")))

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END)
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _named(F.col("id"))),
        line("WARC-Date", date),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            revisit, F.concat(line("WARC-Profile", PROFILE), line("WARC-Refers-To", _named(F.col("head"))))
        ).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "),
        F.octet_length(block),
    )
    return joined.select(F.concat(head, F.lit(END), block).alias("record"))


def write_monoliths(rows: DataFrame, path: str) -> None:
    """``rows``, as of ``records``, as archives under ``path`` that are one gzip stream each, one for each task."""
    rows.select("record").write.option("compression", "gzip").option("lineSep", END).text(path)


def fields(head: bytes) -> dict[str, str]:
    """The named fields of a record's or an HTTP head, names in lower case, without its first line."""
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


class Cutter:
    """Cuts a stream, fed piece by piece, into records by their length."""

    def __init__(self, name: str):
        self.name, self.held, self.head, self.end = name, bytearray(), None, 0

    def fed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        """The records that the piece completes: fields, and all bytes with the end."""
        self.held += piece
        while True:
            if self.head is None:
                at = self.held.find(END.encode())
                if at < 0:
                    return
                head = bytes(self.held[:at])
                self.head = fields(head)
                if not head.startswith(b"WARC/") or not self.head.get("content-length", "").isdecimal():
                    raise ValueError(f"no WARC record: {head[:80]!r} in {self.name}")
                self.end = at + 4 + int(self.head["content-length"])
            if len(self.held) < self.end + 4:
                return
            if self.held[self.end : self.end + 4] != END.encode():
                raise ValueError(f"a record's length is wrong in {self.name}: {self.head.get('warc-record-id')}")
            yield self.head, bytes(self.held[: self.end + 4])
            del self.held[: self.end + 4]
            self.head = None

    def done(self) -> None:
        """At the end of the stream: the reader ends a last piece that has no end, so that much may be left."""
        if self.held not in (b"", END.encode()):
            raise ValueError(f"the last record is cut off in {self.name}")


def normalise(spark: SparkSession, source: str, target: str, *, archive_bytes: int = ARCHIVE_BYTES, level: int = 6) -> None:
    """Rewrites the gzip archives under ``source`` to ``target``, a member per record, with an offset index.

    An archive may be one stream, or members already.  It is an error if a record
    is malformed or cut off.  One task reads an archive, in constant memory but
    for the largest record; ``target`` must not exist.
    """
    text = spark.read.option("lineSep", END).text(source)
    pieces = text.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, str, int, bytes]] = []
        size = number = offset = full = 0
        name, cutter, archive = None, None, ""

        def batch_of() -> pa.RecordBatch:
            part, archives, numbers, values = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(archives), pa.array(numbers, pa.int64()), pa.array(values, pa.binary())],
                names=["part", "archive", "number", "value"],
            )

        for batch in batches:
            for file, piece in zip(batch.column(0), batch.column(1)):
                if (file := file.as_py()) != name:
                    if cutter:
                        cutter.done()
                    name, cutter, number = file, Cutter(file), 0
                    stem = re.sub("[^A-Za-z0-9_-]", "_", file.rsplit("/", 1)[-1].split(".")[0])
                    stem = f"{stem}-{zlib.crc32(file.encode()):08x}"
                    archive, offset, full = f"{stem}-{number:05d}", 0, 0
                for found, record in cutter.fed(piece.as_py() + END.encode()):
                    if full and full + len(record) > archive_bytes:
                        number += 1
                        archive, offset, full = f"{stem}-{number:05d}", 0, 0
                    member = gzip.compress(record, level, mtime=0)
                    entry = {"offset": offset, "length": len(member), "type": found.get("warc-type")}
                    entry |= {"id": found.get("warc-record-id"), "digest": found.get("warc-payload-digest")}
                    entry |= {"uri": found.get("warc-target-uri")}
                    # A member ends with its record's size; from 16 MB on, an empty member brings the zero byte.
                    placed = member if member[-1] == 0 else member + _EMPTY
                    out.append(("records", archive, offset, placed[:-1]))
                    out.append(("index", archive, offset, json.dumps(entry).encode()))
                    offset, full = offset + len(placed), full + len(record)
                    size += len(placed)
                    if size >= BYTES_AT_ONCE:
                        yield batch_of()
                        out, size = [], 0
        if cutter:
            cutter.done()
        if out:
            yield batch_of()

    rows = pieces.mapInArrow(rewritten, "part string, archive string, number bigint, value binary")
    (
        rows.sortWithinPartitions("part", "archive", "number")
        .select(F.col("value").cast("string").alias("value"), "part", "archive")
        .write.partitionBy("part", "archive")
        .option("lineSep", "\0")
        .text(target)
    )


_INDEX = "offset long, length long, type string, id string, digest string, uri string"
_RECORD = "archive string, offset long, type string, id string, refers_to string, digest string, uri string, size long, payload binary"


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """``archive`` and, per record, ``offset``, ``length``, ``type``, ``id``, ``digest``, ``uri``."""
    lines = spark.read.schema("value string, part string, archive string").option("lineSep", "\0").text(target)
    found = lines.filter(F.col("part") == "index").select("archive", F.from_json("value", _INDEX).alias("entry"))
    return found.select("archive", "entry.*")


def read_records(spark: SparkSession, target: str, index: DataFrame | None = None) -> DataFrame:
    """The records that ``index`` lists, by default all: each member is inflated alone, at its offset.

    ``archive``, ``offset``, ``type``, ``id``, ``refers_to``, ``digest``, ``uri``,
    ``size`` (the payload's, by its HTTP head) and ``payload`` (of a revisit, empty).
    """
    index = read_index(spark, target) if index is None else index
    count = index.count()
    if not count:
        return spark.createDataFrame([], _RECORD)
    places = index.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("places"))
    files = spark.read.format("binaryFile").load(target).filter(F.col("part") == "records").select("archive", "content")
    # An archive is as large as archive_bytes allows, and so is its list of places.
    met = files.join(F.broadcast(places) if count <= BROADCAST_ROWS else places, "archive")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _RECORD.split(", ")])

        for batch in batches:
            for archive, content, places in zip(*(batch.column(c) for c in ("archive", "content", "places"))):
                name, whole = archive.as_py(), memoryview(content.as_buffer())
                for place in places.as_py():
                    offset = place["offset"]
                    stream = zlib.decompressobj(31)
                    record = stream.decompress(whole[offset : offset + place["length"]])
                    if not stream.eof or stream.unused_data:
                        raise ValueError(f"no member of its own at {offset} in {name}")
                    head, _, block = record.removesuffix(END.encode()).partition(END.encode())
                    http, _, payload = block.partition(END.encode())
                    found, sent = fields(head), fields(http)
                    length = sent.get("content-length", "")
                    out.append(
                        (
                            name,
                            offset,
                            found.get("warc-type"),
                            found.get("warc-record-id"),
                            found.get("warc-refers-to"),
                            found.get("warc-payload-digest"),
                            found.get("warc-target-uri"),
                            int(length) if length.isdecimal() else None,
                            payload,
                        )
                    )
                    size += len(payload) + 200
                    if size >= BYTES_AT_ONCE:
                        yield batch_of()
                        out, size = [], 0
        if out:
            yield batch_of()

    return met.select("archive", "content", "places").mapInArrow(read, _RECORD)


def normalised_pages(
    pages: DataFrame,
    *,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = LEAST_REVISITED,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Pages written as whole-file gzip archives, normalised, and read back by the offset index.

    Per row the id under its name, ``payload_bytes``, ``payload_digest`` (SHA-1 of
    what was read, of a revisit as its record states it), ``record_type`` and
    ``refers_to``, the id that a revisit refers to.  Repeated rows come back as
    often; see ``records`` for nulls and ties.  Other columns are left out, and an
    empty table gives an empty one.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_monoliths(records(pages, id=id, url=url, payload=payload, least=least), f"{folder}/streams")
    normalise(spark, f"{folder}/streams", f"{folder}/records", archive_bytes=archive_bytes)
    read = read_records(spark, f"{folder}/records")
    response = F.col("type") == "response"
    kind = pages.schema[id].dataType
    return read.select(
        _row_id(F.col("id")).cast(kind).alias(id),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.substring("digest", 6, 40)).alias("payload_digest"),
        F.col("type").alias("record_type"),
        _row_id(F.col("refers_to")).cast(kind).alias("refers_to"),
    )
