"""Micro-batch sinks: committed message files, keyed upserts, fan-out.

Structured Streaming runs a micro-batch again after a failure, with the same
batch id. The file sinks here commit a batch of a query once (``committed``), so
a batch that runs twice is read once, and a query with a new checkpoint adds to
what earlier ones wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketry import schemas
from basketry.operators.common import latest_per_key
from basketry.streaming import committed

BatchSink = Callable[[DataFrame, int], None]


def table(path: str) -> BatchSink:
    """Each batch's rows, committed once."""

    def sink(df: DataFrame, batch_id: int) -> None:
        committed.write_batch(df, path, batch_id)

    return sink


def json_messages(path: str) -> BatchSink:
    """Message-sink stand-in: the batch's ``timestamp, value`` rows, committed once."""
    write = table(path)
    return lambda df, batch_id: write(df.select(*schemas.MESSAGE.fieldNames()), batch_id)


def messages(spark: SparkSession, path: str) -> DataFrame:
    """The messages that ``json_messages`` has committed (``value, timestamp``)."""
    return committed.read(spark, path, schemas.MESSAGE).select(*schemas.MESSAGE.fieldNames())


def console(rows: int = 20) -> BatchSink:
    """Print a preview of each batch. Bounded, as printing brings rows to the
    driver; the whole result goes to the other sinks."""

    def sink(df: DataFrame, batch_id: int) -> None:
        print(f"-- batch {batch_id}, preview of at most {rows} rows")
        df.show(rows, truncate=False)

    return sink


def kafka(bootstrap_servers: str, topic: str) -> BatchSink:
    """Batch write to a topic (``key``/``value`` columns). At-least-once: a
    replayed batch is sent again; use a keyed topic or the file sinks when
    duplicates matter. Needs the spark-sql-kafka package; untested here."""

    def sink(df: DataFrame, batch_id: int) -> None:
        (
            df.write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", topic)
            .save()
        )

    return sink


def fan_out(*sinks: BatchSink) -> BatchSink:
    """One result to several sinks: the batch is computed once (persisted,
    spilling to disk if large), written to each sink, then released."""

    def run(df: DataFrame, batch_id: int) -> None:
        if len(sinks) == 1:
            sinks[0](df, batch_id)
            return
        df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(df, batch_id)
        finally:
            df.unpersist()

    return run


def upserts(spark: SparkSession, path: str, schema: T.StructType | str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The current rows of a keyed table written by ``table``: per key the row of
    the newest batch of the newest run, and of its rows the one with the greatest
    ``order``. Writers give the *complete* current rows of every key they touch,
    so a late update of an older window never replaces a newer one. Batches are
    ordered by run and batch id, never by a clock.

    As from a topic that keeps the last record per key, nothing older is seen; to
    start a small table from it, write this frame to a new path as batch 0.
    """
    rows = committed.read(spark, path, schema)
    return latest_per_key(rows, key, [committed.RUN, committed.BATCH, *order]).drop(committed.RUN, committed.BATCH)
