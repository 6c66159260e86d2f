"""A file sink whose commit files are the truth, as a Python data source.

``committed_files`` writes every task's rows as a file under a fresh name and, when
all tasks of a batch are done, one commit file that lists them. Readers see the
files that a commit lists and no others, so

* a task that ran twice or failed leaves nothing to be read,
* a batch that is run again after a crash is not added again: its commit file is
  there already, and the files of the second run are removed,
* a query with another checkpoint has another id and adds its own run behind the
  earlier ones; it never replaces their batches.

It serves as a streaming sink (``df.writeStream.format(NAME)``) and inside
``foreachBatch``, where one result goes to several sinks (``write_batch``).
Layout under the path: ``files/*.parquet``, ``commits/run=<n>-<query>/<batch>.json``.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from basketry.session import ship_package

NAME = "committed_files"
#: columns a reader may ask for: the run and the batch that wrote a row
RUN, BATCH = "_run", "_batch"
_READ_TASKS, _LIVE_TASKS = 1000, 16
# the local property in which Spark names the streaming query of a task
_QUERY = "sql.streaming.queryId"


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote (no file if it had no rows)."""

    query: str | None
    file: str | None
    rows: int


def _runs(path: str) -> dict[str, int]:
    """Query id -> number of its run, in the order they first committed."""
    fs, root = _store(path)
    found = fs.get_file_info(pyarrow.fs.FileSelector(f"{root}/commits", allow_not_found=True))
    return {q: int(n) for n, q in (f.base_name.removeprefix("run=").split("-", 1) for f in found if f.base_name.startswith("run="))}


def _write(path: str, batches: Iterator[pa.RecordBatch]) -> Written:
    fs, root = _store(path)
    query = TaskContext.get().getLocalProperty(_QUERY)
    writer, name, rows = None, None, 0
    try:
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                name = f"{uuid.uuid4().hex}.parquet"
                fs.create_dir(f"{root}/files", recursive=True)
                writer = pq.ParquetWriter(f"{root}/files/{name}", b.schema, filesystem=fs)
            writer.write_batch(b)
            rows += b.num_rows
    finally:
        if writer is not None:
            writer.close()
    return Written(query, name, rows)


def _remove(path: str, messages: list[Written | None]) -> None:
    fs, root = _store(path)
    for m in messages:
        if m is not None and m.file:
            fs.delete_file(f"{root}/files/{m.file}")


def _commit(path: str, query: str, batch: int, messages: list[Written | None]) -> None:
    done = [m for m in messages if m is not None and m.file]
    if not done:
        return
    fs, root = _store(path)
    runs = _runs(path)
    run = runs.get(query, max(runs.values(), default=-1) + 1)
    folder = f"{root}/commits/run={run:06d}-{query}"
    target = f"{folder}/{batch:012d}.json"
    if fs.get_file_info(target).type != pyarrow.fs.FileType.NotFound:
        _remove(path, done)
        return
    fs.create_dir(folder, recursive=True)
    draft = f"{root}/commits/{uuid.uuid4().hex}.draft"
    with fs.open_output_stream(draft) as out:
        out.write(json.dumps({"run": run, "batch": batch, "files": [[m.file, m.rows] for m in done]}).encode())
    fs.move(draft, target)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.path, iterator)

    def commit(self, messages, batchId: int) -> None:
        query = next((m.query for m in messages if m is not None and m.query), None)
        _commit(self.path, query or "unnamed", batchId, messages)

    def abort(self, messages, batchId: int) -> None:
        _remove(self.path, messages)


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, path: str, query: str, batch: int):
        self.path, self.query, self.batch = path, query, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.path, iterator)

    def commit(self, messages) -> None:
        _commit(self.path, self.query, self.batch, messages)

    def abort(self, messages) -> None:
        _remove(self.path, messages)


def _listed(path: str, task: int = 0, tasks: int = 1) -> list[tuple[str, int, int]]:
    """(file, run, batch) of all commits, or of every commit dealt to ``task``."""
    fs, root = _store(path)
    found = fs.get_file_info(pyarrow.fs.FileSelector(f"{root}/commits", allow_not_found=True, recursive=True))
    files = []
    for f in sorted((f for f in found if f.base_name.endswith(".json")), key=lambda f: f.path):
        if zlib.crc32(f.path.encode()) % tasks == task:
            with fs.open_input_stream(f.path) as stream:
                commit = json.loads(stream.read())
            files += [(name, commit["run"], commit["batch"]) for name, _ in commit["files"]]
    return files


class _Files(InputPartition):
    """The files of a task, or (``live``) its share of the commits there are when it runs."""

    def __init__(self, files: list[tuple[str, int, int]] | None, task: int = 0, tasks: int = 1):
        self.files, self.task, self.tasks = files, task, tasks


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, live: bool):
        self.path, self.schema, self.live = path, schema, live

    def partitions(self) -> list[InputPartition]:
        if self.live:
            return [_Files(None, i, _LIVE_TASKS) for i in range(_LIVE_TASKS)]
        files = _listed(self.path)
        n = min(len(files), _READ_TASKS)
        return [_Files(files[i::n]) for i in range(n)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        fs, root = _store(self.path)
        schema = to_arrow_schema(self.schema)
        files = _listed(self.path, partition.task, partition.tasks) if partition.files is None else partition.files
        for name, run, batch in files:
            with fs.open_input_file(f"{root}/files/{name}") as source:
                for b in pq.ParquetFile(source).iter_batches():
                    own = {RUN: pa.array([run] * b.num_rows, pa.int64()), BATCH: pa.array([batch] * b.num_rows, pa.int64())}
                    columns = [own[f.name] if f.name in own else b.column(f.name).cast(f.type) for f in schema]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)


class CommittedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema, self.options.get("live") == "true")

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _BatchWriter(self.options["path"], self.options["query"], int(self.options["batch"]))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    ship_package(spark)
    spark.dataSource.register(CommittedFiles)


def write_batch(df: DataFrame, path: str, batch_id: int, query: str | None = None) -> None:
    """Add one batch of a query. In ``foreachBatch`` the query is the running one;
    a batch that was added before stays as it is."""
    spark = df.sparkSession
    register(spark)
    query = query or spark.sparkContext.getLocalProperty(_QUERY) or "unnamed"
    df.write.format(NAME).mode("append").option("path", path).option("query", query).option("batch", str(batch_id)).save()


def read(spark: SparkSession, path: str, schema: T.StructType | str, live: bool = False) -> DataFrame:
    """All committed rows with their run and batch. The commits are listed once,
    when the frame is first planned; with ``live`` each time it is run, so that a
    frame joined to a stream is new for every micro-batch. (A commit that comes in
    meanwhile is seen whole or not at all.)"""
    register(spark)
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    schema = T.StructType([*schema.fields, T.StructField(RUN, T.LongType()), T.StructField(BATCH, T.LongType())])
    return spark.read.format(NAME).schema(schema).option("path", path).option("live", str(live).lower()).load()
