"""Dictionary-compressed WARC archives.

A Zstandard dictionary is trained on a bounded sample of the records to archive.
Every archive starts with the dictionary in a skippable frame (magic 0x184D2A5D,
then its length), so the file alone can be read; every record is a frame of its
own, so one record can be read without the others. Records with a payload that
an earlier page holds are written as revisits without the payload.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import dealt, materialise, shared_folder, ship_package, small
from basketry.llm.token_counts import filesystem
from basketry.session import delete_path

#: payloads from this size on are written once
MIN_REVISIT_BYTES = 100
DICTIONARY_BYTES = 64 << 10
#: the dictionary is trained on at most so many records, on a slice of at most so many characters of each
SAMPLE_RECORDS = 1000
SAMPLE_CHARS = 16 << 10
#: an archive is closed beyond this size
ARCHIVE_BYTES = 64 << 20
_LEVEL = 3

# fixed values of the formats
_DICTIONARY_MAGIC = 0x184D2A5D
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"  # the pages carry no time


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit carries the length of the payload it leaves out."""
    block = _HTTP if revisit else _HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:  # a line break would end the header
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Payload-Length: {len(payload)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The row that :func:`record` was made from, lengths and digest taken from
    the payload itself where the record holds it."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    number = lambda name: int(x) if (x := fields[name].removeprefix("<urn:page:").removesuffix(">")) else None
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "revisit":
        size, digest, refers_to = int(fields["WARC-Payload-Length"]), stated, number("WARC-Refers-To")
    else:
        payload = block.partition(b"\r\n\r\n")[2]
        size, digest, refers_to = len(payload), hashlib.sha256(payload).hexdigest(), None
        if digest != stated:
            raise ValueError("payload does not match its digest")
    return {
        "page_id": number("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": refers_to, "url": fields.get("WARC-Target-URI"),
    }


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, payload_digest, first_id``: ``first_id`` is the page
    that holds an equal payload of at least ``MIN_REVISIT_BYTES`` first, if any."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("payload_digest"))
    long_ = rows.where(F.octet_length("html") >= MIN_REVISIT_BYTES)
    first = long_.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    repeated = materialise(first.where("n > 1 and first_id is not null").select("payload_digest", "first_id"))
    return rows.join(small(repeated), "payload_digest", "left")


def train_dictionary(planned: DataFrame) -> bytes:
    """A dictionary from at most ``SAMPLE_RECORDS`` of the payloads to archive (no
    revisits), chosen by a hash of page id; of a long payload a slice at a hashed
    offset. The raw sample itself where it is too small to train on."""
    kept = planned.where("page_id is not null and (first_id is null or first_id = page_id)")
    ids = kept.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_RECORDS)
    ids = F.broadcast(materialise(ids.distinct()))
    start = F.pmod(F.xxhash64("page_id", "payload_digest"), F.greatest(F.length("html") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    picked = kept.join(ids, "page_id", "left_semi").select("page_id", "url", F.substring(F.col("html"), start.cast("int"), F.lit(SAMPLE_CHARS)).alias("html"))
    sample = [record(r.page_id, r.url, r.html.encode(), "0" * 64, None, False) for r in picked.limit(SAMPLE_RECORDS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sample)[-DICTIONARY_BYTES:]


def _write(folder: str, dictionary: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        packer = zstandard.ZstdCompressor(level=_LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        part, done, out, size, records = TaskContext.get().partitionId(), [], None, 0, 0
        try:
            for b in batches:
                cols = [b.column(n) for n in ("page_id", "url", "html", "payload_digest", "first_id")]
                for page_id, url, html, digest, first in zip(*cols):
                    page_id, url, digest, first = page_id.as_py(), url.as_py(), digest.as_py(), first.as_py()
                    if out is None:
                        # only files that a successful task lists are read
                        name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.zst"
                        out, size, records = fs.open_output_stream(f"{path}/{name}", compression=None), 0, 0
                        out.write(struct.pack("<II", _DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                    revisit = first is not None and first != page_id
                    frame = packer.compress(record(page_id, url, html.as_buffer().to_pybytes(), digest, first, revisit))
                    out.write(frame)
                    size, records = size + len(frame), records + 1
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        done.append((name, records))
                        out = None
        finally:
            if out is not None:
                out.close()
                done.append((name, records))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["file", "records"])

    return write


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages as archives under ``folder``; returns ``file, records`` of each.

    An empty table writes no archive.
    """
    rows = plan_records(pages).select(F.col("page_id").cast("long"), "url", "html", "payload_digest", F.col("first_id").cast("long"))
    return materialise(rows.mapInArrow(_write(folder, train_dictionary(rows)), "file string, records long"))


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of one archive, read piece by piece."""
    magic, length = struct.unpack("<II", stream.read(8))
    if magic != _DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    raw = bytes(stream.read(length))
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    pending = bytes(stream.read(chunk))
    while pending:
        frame, found = reader.decompressobj(), []
        while not frame.eof:
            if not pending and not (pending := bytes(stream.read(chunk))):
                raise ValueError("archive ends inside a record")
            found.append(frame.decompress(pending))
            pending = frame.unused_data
        yield b"".join(found)
        pending = pending or bytes(stream.read(chunk))


_ROW = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
])
ROW_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for raw in frames(stream):
                        rows.append(parse(raw))
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, _ROW)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ROW)

    return read


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives listed in ``files``: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to, url``."""
    return dealt(files.select("file"), "file").mapInArrow(_read(folder), ROW_SCHEMA)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back.

    A null html is an empty payload, a null url leaves its header out, null page
    ids stay null. Of equal payloads the smallest id is the response; a row that
    repeats this id is a response too. An empty table gives an empty result; other
    columns are not read. A payload is compressed and read back in one piece, in
    memory with some three times its size. The archives are removed at the end.
    """
    spark: SparkSession = pages.sparkSession
    ship_package(spark)
    folder = shared_folder(spark, "warc")
    found = materialise(read_archives(write_archives(pages, folder), folder).drop("url"))
    delete_path(spark, folder)
    return found
