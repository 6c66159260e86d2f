"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words. Within a source, documents stand in
order of size (ties by a seeded hash), each with the same expected number of
copies; the running sum of the expected copies plus one random offset per source
crosses an integer boundary once per copy taken. Because neighbours have nearly
the same size, the words taken differ from the target by at most about one
large document.

The running sum is a distributed prefix scan: rows are range-partitioned by
(source, size, hash), so a source with a third of all rows spans many
partitions; per (partition, source) row counts give each partition its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import WORD, materialise, small, text_or_empty

# contract: weights repeat along the ordered sources; at most so many times a source
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3.0
SEED = 17


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``source, docs, source_size, target`` from one row per document.

    All sizes are shared out by weight; a target stops at ``max_repeat`` times
    its source's size and the excess is shared again by weight among the rest.
    Resharing until none is above equals one common level: target = min(cap,
    level * weight). Capped are the sources with the smallest cap per weight, so
    the level follows from running sums along that order.
    """
    by_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    # from here one row per source
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place % len(weights) + 1).cast("int"))
    t = by_source.withColumn("weight", w).withColumn("cap", F.col("source_size") * float(max_repeat))
    t = t.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    t = t.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(onward),
    )
    # later rows pass the test too, at lower levels: the first one holds
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return t.select("source", "docs", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_repeat: float = MAX_REPEAT,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken, version``.

    ``size`` counts words (null text: 0), ``copies`` says how often the document
    is taken (0 to ceil(max_repeat)), ``taken`` = size * copies, ``version`` is a
    hash of the text (with id and source it names a row). Null is a source
    of its own, placed last. A source without words has target 0 and no copies.
    Repeated rows are documents of their own. The result depends on the rows and
    the seed only, not on partitions. An empty table gives an empty result; other
    columns are not read. A text of any length is counted whole.
    """
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    # the hash spreads documents of one size; the id and the text settle what remains
    tie = F.xxhash64(F.lit(seed), "doc_id")
    version = F.xxhash64(text_or_empty())
    rows = materialise(docs.select("doc_id", "source", size.alias("size"), tie.alias("tie"), version.alias("version")))
    targets = materialise(source_targets(rows, weights, max_repeat))

    keys = ["source", "size", "tie", "doc_id", "version"]
    ranged = materialise(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()))
    # per partition and source: rows, then the rows in all earlier partitions
    counts = ranged.groupBy("part", "source").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "source", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    s = targets.withColumnRenamed("source", "t_source")
    offsets = offsets.join(small(s), F.col("source").eqNullSafe(F.col("t_source")))
    offsets = materialise(offsets.drop("t_source")).withColumnsRenamed({"part": "o_part", "source": "o_source"})

    # ranges are contiguous, so there are at most partitions + sources offsets
    joined = ranged.join(
        small(offsets), (F.col("part") == F.col("o_part")) & F.col("source").eqNullSafe(F.col("o_source"))
    )
    local = F.row_number().over(Window.partitionBy("part", "source").orderBy(*keys[1:]))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull()), F.lit(1 << 30)) / float(1 << 30)
    rank = F.col("offset") + local
    joined = joined.withColumns({"rank": rank, "each": each, "start": start})
    crossed = F.floor(F.col("rank") * F.col("each") + F.col("start")) - F.floor((F.col("rank") - 1) * F.col("each") + F.col("start"))
    copies = F.least(crossed, F.ceil("each")).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "version"
    )


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken, columns unchanged.

    Rows are found again by id, source and text. Identical rows stand in for each
    other: one of them is taken as often as all of them together.
    """
    key = ["doc_id", "source", "version"]
    taken = mix(docs, seed=seed).groupBy(*key).agg(F.sum("copies").alias("m_copies"), F.count(F.lit(1)).alias("m_rows"))
    taken = materialise(taken.where("m_copies > 0").withColumnsRenamed({k: f"m_{k}" for k in key}))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), "doc_id", "source", F.xxhash64(text_or_empty()).alias("version"))
    same = [rows[k].eqNullSafe(taken[f"m_{k}"]) for k in key]
    found = rows.join(taken, same[0] & same[1] & same[2]).select("row", *key, "m_copies", "m_rows")
    if not taken.where("m_rows > 1").isEmpty():
        several = found.where("m_rows > 1").groupBy(*key, "m_copies").agg(F.first("row").alias("row"))
        found = found.where("m_rows = 1").select("row", "m_copies").unionByName(several.select("row", "m_copies"))
    copies = F.explode(F.sequence(F.lit(1), F.col("m_copies").cast("int"))).alias("copy")
    return found.select("row", copies).select("row.*")
