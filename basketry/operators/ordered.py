"""Operations along an order, for keys too large for one task.

A window over ``partitionBy(key).orderBy(time)`` sorts all rows of a key in one
task. Here the rows are range-partitioned by (key, time), so that a key with a third
of all rows spans a third of the tasks; each task scans its own range, and what
the earlier ranges of a key hold (one row per range and key) is carried into it.
The ranged rows are written to the shared checkpoint folder: the carried values
and the scan must see the same ranges, also after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.common import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded
from basketry.session import checkpoint_root

_RANGE = "_range"


def ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` in ranges of (keys, order), numbered in ``_range``. Rows equal in all
    of these lie in one range: end ``order`` with a column that tells them apart."""
    checkpoint_root(df.sparkSession)
    return df.repartitionByRange(*keys, *order).withColumn(_RANGE, F.spark_partition_id()).checkpoint()


def _carried(ranged: DataFrame, keys: Sequence[str], own: Column, over_earlier, name: str) -> DataFrame:
    """``ranged`` with ``name``: ``over_earlier`` of the ``own`` aggregates of the key's earlier ranges."""
    earlier = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(_RANGE, *keys).agg(own.alias("_own"))
    parts = parts.select(_RANGE, *keys, over_earlier(F.col("_own")).over(earlier).alias(name))
    # a range holds many keys or a part of one: at most ranges + keys rows, of which
    # only those with something to carry are needed
    parts = parts.where(F.col(name).isNotNull()).select(*[F.col(c).alias(f"_c_{c}") for c in (_RANGE, *keys)], name)
    parts = broadcast_if_bounded(parts.checkpoint(), DEFAULT_MAX_BROADCAST_ROWS)
    same = F.col(_RANGE) == F.col(f"_c_{_RANGE}")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    return ranged.join(parts, same, "left").drop(*[f"_c_{c}" for c in (_RANGE, *keys)])


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "prefix") -> DataFrame:
    """Each row with the sum of ``value`` over the key's rows up to and with it."""
    joined = _carried(ranges(df, keys, order), keys, F.sum(value), F.sum, "_before")
    up_to = Window.partitionBy(_RANGE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = F.coalesce(F.sum(value).over(up_to), F.lit(0))
    return joined.withColumn(name, F.coalesce("_before", F.lit(0)) + inside).drop("_before", _RANGE)


def carry_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Each row with the last value of ``value`` that is not null, of the key's
    rows up to and with it."""
    place = F.struct(*order)
    own = F.max_by(F.when(F.col(value).isNotNull(), F.col(value)), F.when(F.col(value).isNotNull(), place))
    joined = _carried(ranges(df, keys, order), keys, own, lambda c: F.last(c, ignorenulls=True), "_before")
    up_to = Window.partitionBy(_RANGE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = F.last(value, ignorenulls=True).over(up_to)
    return joined.withColumn(name, F.coalesce(inside, F.col("_before"))).drop("_before", _RANGE)


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    time: str,
    valid_from: str,
    version_order: Sequence[str] = (),
) -> DataFrame:
    """``rows`` with ``version``: a struct of the key's last version with
    ``valid_from`` at or before the row's ``time`` (of equal times the last by
    ``version_order``), null if there is none. Rows with a null key or time have
    none. One sorted union of both sides, no pairs.
    """
    whole = F.struct(*[F.col(c) for c in versions.columns])
    place = F.struct(*[F.col(c) for c in version_order]) if version_order else F.lit(None).cast("int")
    known = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_time"), F.lit(0).alias("_kind"), place.alias("_tie"),
        F.lit(0).cast("long").alias("_hash"), whole.alias("_version"),
    )
    row = F.struct(*[F.col(c) for c in rows.columns])
    asked = rows.select(
        F.col(key).alias("_key"), F.col(time).alias("_time"), F.lit(1).alias("_kind"),
        # rows of one key and time may be many: the hash parts them
        F.xxhash64(*[F.col(c) for c in rows.columns]).alias("_hash"), row.alias("_row"),
    )
    both = known.unionByName(asked, allowMissingColumns=True)
    found = carry_last(both, ["_key"], ["_time", "_kind", "_tie", "_hash"], "_version", "_found").where("_kind = 1")
    # nulls sort first: a null key or time stands before every version of its key
    version = F.when(F.col("_key").isNotNull() & F.col("_time").isNotNull(), F.col("_found"))
    return found.select("_row.*", version.alias("version"))


def trailing_sums(df: DataFrame, key: str, time: str, value: str, interval: str, name: str) -> DataFrame:
    """``key, time, name`` for every distinct time of a key: the sum of ``value``
    over the key's rows from ``interval`` before it to it, both included.

    The difference of two prefix sums: up to the time, and up to just before its
    interval. Rows are summed per (key, time) first, in each task before the
    shuffle, and every time adds a probe where its interval starts.
    """
    sums = df.where(F.col(time).isNotNull()).groupBy(key, time).agg(F.sum(value).alias("_value"))
    events = sums.select(key, F.col(time).alias("_at"), F.lit(1).alias("_kind"), F.col(time).alias("_of"), "_value")
    starts = F.expr(f"`{time}` - INTERVAL {interval}")
    # a probe stands before the rows of its own instant
    probes = sums.select(key, starts.alias("_at"), F.lit(0).alias("_kind"), F.col(time).alias("_of"), F.lit(0).cast("long").alias("_value"))
    summed = prefix_sums(events.unionByName(probes), [key], ["_at", "_kind", "_of"], "_value", "_prefix")
    signed = F.when(F.col("_kind") == 1, F.col("_prefix")).otherwise(-F.col("_prefix"))
    return summed.groupBy(key, F.col("_of").alias(time)).agg(F.sum(signed).cast("long").alias(name))
