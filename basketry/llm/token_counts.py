"""Token counts of documents from flat token files, by a separator scan.

``write_token_files`` puts documents one after the other into flat files of
fixed-width ids, each document followed by the end-of-document id; the files have
no index. ``separator_scan`` finds the documents again: files are read in blocks
of equal size, each block is searched for the end id as one vector, and documents
that cross blocks are stitched by a prefix scan over the blocks (how many
documents ended before this block, and where the last one did).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import dealt, materialise, shared_folder, ship_package
from basketry.llm.tokens import VOCABULARY, encoder
from basketry.session import delete_path

END_TOKEN = "<|endoftext|>"
BLOCK_IDS = 1 << 21
# blocks per group of the two-level prefix scan
GROUP_BLOCKS = 1024


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of the shared folder, which may be local or a cluster store."""
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _write(folder: str, vocabulary: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        end = encode.special[END_TOKEN]
        dtype = "<u2" if encode.n_ids <= 1 << 16 else "<u4"
        part = TaskContext.get().partitionId()
        # another attempt of the task writes another file; only the successful one's is listed
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        n = ordinal = 0
        with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
            for b in batches:
                ids = b.column(0).to_pylist()
                for text in b.column(1):
                    found = encode.ids(text.as_py() or "", special=False)
                    out.write(np.append(found, np.uint32(end)).astype(dtype).tobytes())
                    n += len(found) + 1
                k = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * k, pa.int32()), pa.array(range(ordinal, ordinal + k), pa.int64()), pa.array(ids, pa.int64()),
                     pa.nulls(k, pa.string()), pa.nulls(k, pa.int64())],
                    names=["part", "ordinal", "doc_id", "file", "n_ids"],
                )
                ordinal += k
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "ordinal": -1, "doc_id": None, "file": name, "n_ids": n}],
            schema=pa.schema([("part", pa.int32()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("file", pa.string()), ("n_ids", pa.int64())]),
        )

    return write


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """Write one flat token file per partition under ``folder``.

    Returns ``part, file, n_ids`` of the files and ``part, ordinal, doc_id`` of the
    documents in the order they were written.
    """
    written = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _write(folder, vocabulary), "part int, ordinal long, doc_id long, file string, n_ids long"
    )
    written = materialise(written)
    return written.where("ordinal < 0").select("part", "file", "n_ids"), written.where("ordinal >= 0").select("part", "ordinal", "doc_id")


def _search(folder: str, vocabulary: str, block_ids: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        end = encode.special[END_TOKEN]
        dtype = np.dtype("<u2" if encode.n_ids <= 1 << 16 else "<u4")
        fs, path = filesystem(folder)
        for b in batches:
            for row in b.to_pylist():
                with fs.open_input_file(f"{path}/{row['file']}") as f:
                    f.seek(row["block"] * block_ids * dtype.itemsize)
                    ids = np.frombuffer(f.read(block_ids * dtype.itemsize), dtype)
                ends = np.flatnonzero(ids == end) + 1 + row["block"] * block_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]], pa.int32()), pa.array([row["block"]], pa.int64()), pa.array([len(ends)], pa.int64()),
                     pa.array([int(ends[-1]) if len(ends) else None], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    names=["part", "block", "docs", "last_end", "ends"],
                )

    return search


def prefix_scan(blocks: DataFrame) -> DataFrame:
    """Add to each block of a file ``docs_before`` and ``end_before``: the
    documents that ended in earlier blocks and where the last of them did.

    Two levels, so that no task holds all blocks of a huge file: inside groups of
    consecutive blocks, then over the groups.
    """
    grouped = blocks.withColumn("group", F.floor(F.col("block") / GROUP_BLOCKS))
    totals = grouped.groupBy("part", "group").agg(F.sum("docs").alias("docs"), F.max("last_end").alias("last_end"))
    up_to = lambda *by: Window.partitionBy("part", *by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    over_groups = up_to("group")
    totals = totals.select("part", "group", zero(F.sum("docs").over(over_groups)).alias("g_docs"), zero(F.max("last_end").over(over_groups)).alias("g_end"))
    inside = up_to("group", "block")
    grouped = grouped.withColumns({"i_docs": zero(F.sum("docs").over(inside)), "i_end": zero(F.max("last_end").over(inside))})
    joined = grouped.join(totals, ["part", "group"])
    return joined.select(
        *blocks.columns, (F.col("g_docs") + F.col("i_docs")).alias("docs_before"), F.greatest("g_end", "i_end").alias("end_before")
    )


def separator_scan(files: DataFrame, folder: str, vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``part, ordinal, start, n_tokens`` of every document in the token files
    (``part, file, n_ids``): its position in its file and its ids without the end id.

    An empty file has no documents. Ids after a file's last end id belong to no document.
    """
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_ids") - 1) / block_ids))
    blocks = files.where("n_ids > 0").select("part", "file", F.explode(numbers).alias("block"))
    # one block is the unit of work
    found = dealt(blocks, "part", "block").mapInArrow(_search(folder, vocabulary, block_ids), "part int, block long, docs long, last_end long, ends array<long>")
    found = materialise(found)
    scanned = prefix_scan(found.drop("ends")).select("part", "block", "docs_before", "end_before")
    ends = found.select("part", "block", "ends").join(scanned, ["part", "block"])
    starts: Column = F.concat(F.array("end_before"), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))))
    rows = ends.where(F.size("ends") > 0).select("part", "docs_before", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))).alias("i", "doc"))
    return rows.select(
        "part", (F.col("docs_before") + F.col("i")).alias("ordinal"), F.col("doc.start").alias("start"),
        (F.col("doc.end") - F.col("doc.start") - 1).alias("n_tokens"),
    )


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, part, start``.

    A null or empty text has 0 tokens. The end token's name inside a text is
    ordinary text. Repeated rows are documents of their own, null ids stay null,
    an empty table gives an empty result; other columns are not read. A text's ids
    are held once while it is written; the scan never holds more than a block,
    however long a document. The token files are temporary.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = shared_folder(spark, "token-files")
    files, order = write_token_files(docs, folder, vocabulary)
    counted = materialise(separator_scan(files, folder, vocabulary, block_ids))
    delete_path(spark, folder)
    return order.join(counted, ["part", "ordinal"]).select("doc_id", "n_tokens", "part", "start")
