"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import checkpoint_root, ship_package  # noqa: F401

# ASCII white space, as one character class of Java's and Python's regex
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

# rows of a side that may be broadcast after it has been counted
MAX_BROADCAST_ROWS = 500_000
# tasks of one stage; beyond it a task takes several rows of work
MAX_TASKS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there:
    it is computed once, and a lost executor takes nothing of it along."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` (already materialised) with a broadcast hint if it has at most
    ``max_rows`` rows; else unhinted, for a shuffled join with skew splitting."""
    return F.broadcast(df) if df.count() <= max_rows else df


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """``df`` (already materialised, few rows of much work each) dealt over tasks
    by ``by``: about one task a row. The number is given, as adaptive execution
    would merge the small rows into one task."""
    return df.repartition(max(1, min(df.count(), MAX_TASKS)), *[F.col(c) for c in by])


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, all other characters unchanged."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
