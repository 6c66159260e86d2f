"""Readers for the record sources: text files, CSV tables and message topics.

Batch and streaming readers return the same column shapes so the operators
downstream work unchanged on either:

* text line sources -> one ``value`` string column;
* message sources   -> ``value`` string plus ``timestamp`` (record time).

The Kafka factories need the ``spark-sql-kafka`` package on the cluster's
class path; the tests drive the same code through file streams holding
``value, timestamp`` records (see ``message_file_stream``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.functions import parse


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Bounded scan of a text file, one record per line (column ``value``)."""
    return spark.read.text(path)


def text_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded scan of a folder of text files, one record per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def csv_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    on_error: str = "drop",
) -> DataFrame:
    """CSV file as a typed table with a declared schema, one record per line.

    ``on_error``: ``fail`` raises on a malformed line, ``drop`` leaves it out
    (the tolerant table source), ``quarantine`` keeps it with null fields and
    the raw line in ``_corrupt_record``. Lines are judged as a whole, so which
    rows there are does not depend on the columns a query uses (the CSV reader's
    own modes only look at those).
    """
    return parse.csv_fields(text_lines(spark, path), schema, on_error=on_error, what="csv")


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
) -> DataFrame:
    """Value-only topic scan: ``value`` as UTF-8 text and the record timestamp."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
        .select(F.col("value").cast("string").alias("value"), F.col("timestamp"))
    )


def kafka_batch(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
) -> DataFrame:
    """Bounded read of a whole topic (earliest to latest) in the same shape."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
        .select(F.col("value").cast("string").alias("value"), F.col("timestamp"))
    )


def message_file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """File-backed stand-in for a topic: files of ``value, timestamp`` rows."""
    reader = spark.readStream.format(fmt).schema(schemas.MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
