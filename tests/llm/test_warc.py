"""WARC archives: exact round trip, and the file format read by hand."""

import hashlib
import os
import struct

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from basketry.llm import catalog, warc
from basketry.llm.common import shared_folder, ship_package

SCHEMA = "page_id long, url string, html string, file string, records string, first_id string"
LONG = "<p>" + "payload " * 40
ROWS = (
    [(i, f"http://h{i % 3}.net/{i}", f"<html>{'text ' * (i % 50)}{i}</html>") for i in range(120)]
    + [(500 - i, "u", LONG) for i in range(40)]
    + [(600, None, None), (601, "http://x/\r\nWARC-Type: revisit", ""), (602, "", "short"), (603, "", "short"), (604, "ü", "é" * 60), (605, "ü", "é" * 60),
       (None, "n", "null id " * 30), (None, "n", LONG), (461, "u", LONG), (606, "z", "body\r\n\r\nWARC/1.1\r\n" * 5000), (607, "z", "x" * 99), (608, "z", "x" * 99)]
)


@pytest.fixture(scope="module")
def make_pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "f", "r", "i") for r in rows], SCHEMA).repartition(3)


def brute(rows):
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if i is not None and len(body) >= 100:
            first[body] = min(i, first.get(body, i))
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = first.get(body)
        to = None if to == i else to
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(make_pages):
    got = warc.warc_round_trip(make_pages(ROWS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS)


def test_small_archives_and_file_format(spark, make_pages, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    folder = shared_folder(spark, "warc-test")
    pages = make_pages(ROWS).coalesce(1)
    name, records = warc._write(folder, warc.train_dictionary(warc.plan_records(pages))), 0
    batches = warc.plan_records(pages).select("page_id", "url", "html", "payload_digest", "first_id").toArrow().to_batches()

    class Context:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(warc.TaskContext, "get", classmethod(lambda cls: Context))
    files = [r for b in name(iter(batches)) for r in b.to_pylist()]
    assert len(files) > 1 and sum(f["records"] for f in files) == len(ROWS)
    for f in files:
        raw = open(os.path.join(folder.removeprefix("file:"), f["file"]), "rb").read()
        magic, size = struct.unpack("<II", raw[:8])
        assert magic == 0x184D2A5D
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size]))
        rest = raw[8 + size :]
        while rest:
            frame = reader.decompressobj()
            assert frame.decompress(rest).startswith(b"WARC/1.1\r\nWARC-Type: ")
            rest, records = frame.unused_data, records + 1
    assert records == len(ROWS)


def test_few_records_and_empty(make_pages):
    assert warc.warc_round_trip(make_pages([])).collect() == []
    rows = [(1, None, None)]
    assert [tuple(r) for r in warc.warc_round_trip(make_pages(rows)).collect()] == brute(rows)


def test_parse_refuses_a_changed_payload():
    raw = warc.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None, False)
    assert warc.parse(raw)["payload_bytes"] == 3
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"abc", b"abd"))


def test_archives_are_read_in_many_tasks(spark):
    """Eight archives, with adaptive execution on: the tasks that read them are counted."""
    folder = shared_folder(spark, "warc-tasks")
    ship_package(spark)
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>", "f", "r", "i") for i in range(400)]
    files = warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(8), folder)
    assert files.count() == 8 and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    read = warc.read_archives(files, folder).withColumn("task", F.spark_partition_id())
    assert read.count() == 400 and read.select("task").distinct().count() > 3


def test_null_ids_against_the_sql(spark, make_pages):
    rows = [*ROWS, (None, "n", None), (5, "x", LONG)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    columns = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    want = con.execute(f"SELECT {columns} FROM ({catalog.OP9_SQL})").fetchall()
    got = warc.warc_round_trip(make_pages(rows)).selectExpr(*columns.split(", ")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) == brute(rows)


def test_dictionary_learns_from_archived_payloads_only(spark, make_pages, monkeypatch):
    """Slices lie anywhere in a payload; revisits give none."""
    seen = []
    monkeypatch.setattr(warc.zstandard, "train_dictionary", lambda size, sample: seen.extend(sample) or zstandard.ZstdCompressionDict(b"x" * 100))
    monkeypatch.setattr(warc, "SAMPLE_CHARS", 50)
    rows = [(i, "u", "".join(f"<{j}>" for j in range(i * 40, i * 40 + 200))) for i in range(30)] + [(100 + i, "u", LONG) for i in range(50)]
    warc.train_dictionary(warc.plan_records(make_pages(rows)))
    assert len(seen) == 31
    starts = [rows[i][2].find(s.partition(b"\r\n\r\n")[2].partition(b"\r\n\r\n")[2][:50].decode()) for i in range(30) for s in seen if f"page:{i}>".encode() in s]
    assert len(starts) == 30 and min(starts) >= 0 and max(starts) > 300
