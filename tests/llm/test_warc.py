"""WARC archives: writing, normalising, the offset index, and reading back."""

import glob
import gzip
import hashlib
import random
import zlib

import pytest

from tests.llm.helpers import prose
from tickerloom.llm import warc

SCHEMA = "page_id long, url string, html string, id string, payload string, size long, record string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", 3, "z") for i, u, h in rows], SCHEMA)


def awkward():
    rng = random.Random(5)
    big = prose(1, 400)
    line_ends = "".join(rng.choice(["\r", "\n", "\r\n", "\r\n\r\n", "a"]) for _ in range(3000))
    return [
        (1, "http://a/1", None),
        (2, None, ""),
        (3, "http://a/\r\nX: y", "short"),
        (4, "http://a/4", "short"),
        (5, "http://ä/ü", big),
        (6, "http://a/6", big),
        (6, "http://a/6", big),
        (-7, "", big),
        (None, "n", big),
        (None, "n", prose(2, 300)),
        (None, "n", prose(2, 300)),
        (8, "e", "é" * 499 + "x"),
        (9, "e", "é" * 499 + "x"),
        (10, "e", "é" * 500),
        (11, "e", "é" * 500),
        (12, "l", line_ends),
        (13, "l", "\r\n\r\n"),
        (14, "l", "x\r\n"),
        (15, "l", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        (16, "m", "\0日本\U0001f600" * 100_000),
    ]


def expected(rows, least=1000):
    out = []
    data = [(i, (h or "").encode()) for i, _, h in rows]
    for i, payload in data:
        equal = [j for j, other in data if other == payload and j is not None]
        head = max(equal, default=None) if len(payload) >= least else None
        revisit = head is not None and (i is None or i < head)
        out.append(
            (i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", head if revisit else None)
        )
    return out


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("few", [True, False])
def test_pages_come_back(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    found = warc.normalised_pages(pages(spark, awkward()), archive_bytes=5000)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert order(tuple(r) for r in found.collect()) == order(expected(awkward()))


def test_empty_table(spark):
    found = warc.normalised_pages(pages(spark, []))
    assert found.collect() == []
    assert dict(found.dtypes)["page_id"] == "bigint"


def test_text_ids_and_other_names(spark):
    rows = [("a b/ü", "x" * 1200), ("z>", "x" * 1200), ("", "y")]
    docs = spark.createDataFrame(rows, "`my id` string, body string").withColumnRenamed("my id", "key")
    docs = docs.selectExpr("key", "body", "'u' AS url")
    found = {r.key: (r.record_type, r.refers_to) for r in warc.normalised_pages(docs, id="key", payload="body").collect()}
    assert found == {"a b/ü": ("revisit", "z>"), "z>": ("response", None), "": ("response", None)}


def test_every_record_is_a_member_at_its_offset(spark, tmp_path):
    rows = awkward()
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    warc.write_monoliths(warc.records(pages(spark, rows)).coalesce(2), source)
    streams = glob.glob(f"{source}/*.gz")
    assert len(streams) == 2
    before = []
    for name in streams:
        with open(name, "rb") as file:
            stream = zlib.decompressobj(31)
            before.append(stream.decompress(file.read()))
            assert stream.eof and not stream.unused_data  # one stream for the whole file
    warc.normalise(spark, source, target, archive_bytes=20_000)
    index = warc.read_index(spark, target).collect()
    assert len(index) == len(rows)
    seen = {}
    for entry in sorted(index, key=lambda e: (e.archive, e.offset)):
        (name,) = glob.glob(f"{target}/part=records/archive={entry.archive}/part-*")
        with open(name, "rb") as file:
            file.seek(entry.offset)
            member = file.read(entry.length)
        stream = zlib.decompressobj(31)
        record = stream.decompress(member)
        assert stream.eof and not stream.unused_data
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert f"WARC-Record-ID: {entry.id}\r\n".encode() in record
        seen.setdefault(entry.archive, []).append((entry.offset, entry.length, record))
    for archive, members in seen.items():
        (name,) = glob.glob(f"{target}/part=records/archive={archive}/part-*")
        with open(name, "rb") as file:
            data = file.read()
        # Nothing lies between members, and any gzip reader reads the whole.
        assert [o for o, _, _ in members] == [sum(n for _, n, _ in members[:k]) for k in range(len(members))]
        assert len(data) == sum(n for _, n, _ in members)
        assert gzip.decompress(data) == b"".join(record for _, _, record in members)
        assert len(members) == 1 or sum(len(r) for _, _, r in members) <= 20_000
    assert len(seen) > 2
    assert sorted(b"".join(before)) == sorted(b"".join(r for m in seen.values() for _, _, r in m))
    # Members are normalised to the same members.
    again = str(tmp_path / "again")
    (tmp_path / "gz").mkdir()
    for k, archive in enumerate(seen):
        (name,) = glob.glob(f"{target}/part=records/archive={archive}/part-*")
        with open(name, "rb") as file:
            (tmp_path / "gz" / f"{k}.warc.gz").write_bytes(file.read())
    warc.normalise(spark, str(tmp_path / "gz"), again)
    assert sorted(e.id for e in warc.read_index(spark, again).collect()) == sorted(e.id for e in index)
    # Any part of the index reads its records alone.
    some = warc.read_index(spark, target).filter("type = 'revisit'")
    assert {r.type for r in warc.read_records(spark, target, some).collect()} == {"revisit"}


def test_a_record_over_16_mb_keeps_its_member(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(1, "u", "x" * (17 << 20)), (2, "u", "y")]
    warc.write_monoliths(warc.records(pages(spark, rows)).coalesce(1), source)
    warc.normalise(spark, source, target)
    read = warc.read_records(spark, target).selectExpr("id", "octet_length(payload) n").collect()
    assert sorted((r.id, r.n) for r in read) == [("<urn:x-row:1>", 17 << 20), ("<urn:x-row:2>", 1)]


@pytest.mark.parametrize("damage", [lambda b: b[:-6], lambda b: b[:-5] + b"!" + b[-4:] + b"more", lambda b: b"no " + b])
def test_damaged_archives_are_refused(spark, tmp_path, damage):
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(damage(record * 2)))
    with pytest.raises(Exception, match="record"):
        warc.normalise(spark, str(tmp_path / "x.warc.gz"), str(tmp_path / "out"))
