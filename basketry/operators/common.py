"""Shared DataFrame building blocks: size-checked broadcast, top-k per group,
latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest side (rows, and bytes of its values) that is hinted for broadcast.
# Above it the join is left to the planner: sort-merge, with AQE splitting
# skewed partitions and still switching to broadcast if the runtime size turns
# out small.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20

# First-stage groups per key in ``first_distinct``.
FIRST_DISTINCT_SALTS = 16


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows and ``max_bytes`` bytes.

    A plain count: one number per task crosses the network, and as it needs no
    column, the scan of a parquet dimension reads row counts from file metadata
    only (``ReadSchema: struct<>``). Only a side that passes it is measured:
    the bytes of its text and binary values plus eight for any other column.
    """
    rows = df.count()
    if rows > max_rows:
        return False
    wide = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    size = 8 * rows * (len(df.columns) - len(wide))
    if wide and size <= max_bytes:
        each = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in wide])
        size += df.agg(F.sum(each)).first()[0] or 0
    return size <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint ``df`` for broadcast only after ``fits_broadcast``.

    Streaming frames and ``max_rows=None`` are returned unhinted.
    """
    if max_rows is None or df.isStreaming:
        return df
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def top_k(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    k: int,
    rank_col: str = "rn",
) -> DataFrame:
    """The first ``k`` rows of each group under a total order.

    ``row_number() <= k`` is planned by Spark as a WindowGroupLimit that keeps
    at most ``k`` rows per group in each map task *before* the shuffle, so a
    hot group sends at most ``k`` rows per task, never the whole group.
    """
    _check_k(df, k)
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def _check_k(df: DataFrame, k: int) -> None:
    """``k`` must be one that Spark cuts per map task."""
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if not 1 <= k <= limit:
        raise ValueError(
            f"k must be from 1 to spark.sql.optimizer.windowGroupLimitThreshold ({limit}), not {k}: "
            "beyond it whole groups would be shuffled"
        )


def first_distinct(
    df: DataFrame,
    partition_by: Sequence[str],
    order_col: str,
    k: int,
) -> DataFrame:
    """The rows holding the ``k`` smallest distinct values of ``order_col``
    in each group, de-duplicated.

    Two stages, both ``dense_rank() <= k``, which Spark cuts per map task before
    the shuffle (partial WindowGroupLimit): first per (group, salt), where the
    salt is the map partition, then per group. Rows tied at one of the values all
    pass a rank, so without the first stage every copy of a hot group's tied rows
    would meet in one task; with it, copies are removed in up to
    ``FIRST_DISTINCT_SALTS`` tasks per group, and at most ``k`` values from each
    of them reach the second stage. Neither ``distinct()`` needs an exchange: the
    rows are already clustered by a subset of its keys.
    """
    _check_k(df, k)
    group = list(partition_by)

    def cut(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc())
        return rows.withColumn("_dr", F.dense_rank().over(w)).where(F.col("_dr") <= k).drop("_dr").distinct()

    salted = df.withColumn("_salt", F.spark_partition_id() % FIRST_DISTINCT_SALTS)
    return cut(cut(salted, [*group, "_salt"]).drop("_salt"), group)


def latest_per_key(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_by`` tuple.

    An aggregate (``max_by`` over a struct of the row), so each task combines
    its own rows before the shuffle: a key holding a third of the data sends
    one partial row per task.
    """
    key = list(key)
    values = [c for c in df.columns if c not in key]
    order = F.struct(*[F.col(c) for c in order_by])
    latest = df.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in values]), order).alias("_row"))
    return latest.select(*key, *[F.col(f"_row.{c}").alias(c) for c in values])
