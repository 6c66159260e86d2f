"""Exact de-duplication with counting quotient filters.

1. Every text is normalised (each run of ASCII white space becomes one space)
   and gets a 64-bit fingerprint and its SHA-256. These narrow keys are written
   to the shared folder.
2. Each partition builds a counting quotient filter over its fingerprints: the
   high bits (quotient) address a run, the low bits (remainder) are kept sorted
   in it with a counter. A fingerprint that a third of all rows share is one
   remainder with a large counter.
3. The runs of one quotient from all partitions are merged by their sorted
   remainders, adding counters. Nothing is lost: quotient and remainder together
   are the fingerprint.
4. Only texts whose fingerprint has a count above one are compared byte by byte:
   they are grouped by the text itself, combined on the map side first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import SPACE, materialise, ship_package, small, text_or_empty

# a merged run of a quotient holds about so many fingerprints
RUN_ROWS = 1 << 16
_MIN_QUOTIENT_BITS = 6


def normalised(name: str = "text"):
    """The text with each run of ASCII white space replaced by one space."""
    return F.regexp_replace(text_or_empty(name), f"[{SPACE}]+", " ")


def _build_filter(bits: int):
    """Per partition: (quotient, sorted remainders, counters) of its fingerprints."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches if b.num_rows]
        if not found:
            return
        prints, counts = np.unique(np.concatenate(found), return_counts=True)
        quotients = (prints >> np.uint64(64 - bits)).astype(np.int64)
        remainders = prints & np.uint64((1 << (64 - bits)) - 1)
        starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]])
        ends = np.r_[starts[1:], len(prints)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(quotients[starts]),
                pa.array([remainders[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                pa.array([counts[a:b].astype(np.uint64).tobytes() for a, b in zip(starts, ends)], pa.binary()),
            ],
            names=["quotient", "remainders", "counters"],
        )

    return build


def _merge_runs(bits: int):
    """All runs of one quotient -> its fingerprints with a count above one."""

    def merge(key: tuple, runs: pd.DataFrame) -> pd.DataFrame:
        remainders = np.concatenate([np.frombuffer(x, np.uint64) for x in runs["remainders"]])
        counters = np.concatenate([np.frombuffer(x, np.uint64) for x in runs["counters"]])
        order = np.argsort(remainders, kind="stable")
        remainders, counters = remainders[order], counters[order]
        starts = np.flatnonzero(np.r_[True, remainders[1:] != remainders[:-1]])
        sums = np.add.reduceat(counters, starts)
        many = sums > 1
        prints = (np.uint64(key[0]) << np.uint64(64 - bits)) | remainders[starts][many]
        return pd.DataFrame({"fp": prints.view(np.int64), "n": sums[many].astype(np.int64)})

    return merge


def repeated_fingerprints(keys: DataFrame) -> DataFrame:
    """``fp, n`` of the 64-bit ``fp`` values that occur more than once in ``keys``."""
    ship_package(keys.sparkSession)
    rows = keys.count()
    bits = max(_MIN_QUOTIENT_BITS, int(rows / RUN_ROWS).bit_length())
    runs = keys.select("fp").mapInArrow(
        _build_filter(bits), "quotient long, remainders binary, counters binary"
    )
    return runs.groupBy("quotient").applyInPandas(_merge_runs(bits), "fp long, n long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after white-space normalisation; a null text
    equals the empty one. Of each group the row with the smallest id stays; null
    ids come last (a group of null ids only has a null ``keep_id``). Of repeated
    rows with the same smallest id exactly one is kept. An empty table gives an
    empty result; other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm"))
    texts = texts.withColumn("fp", F.xxhash64("norm"))
    keys = materialise(
        texts.select(
            F.monotonically_increasing_id().alias("uid"), "doc_id", "fp", F.unhex(F.sha2("norm", 256)).alias("sha")
        )
    )
    repeated = materialise(repeated_fingerprints(keys).select("fp"))
    routed = small(repeated)

    # byte verification: equal fingerprints are split by the whole text
    verified = (
        texts.join(routed, "fp", "left_semi")
        .groupBy("fp", "norm")
        .agg(F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select("fp", F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size")
    )
    verified = materialise(verified)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")).alias("first")
    firsts = (
        keys.join(small(verified.select("fp", "sha", "group_size")), ["fp", "sha"])
        .groupBy("fp", "sha", "group_size")
        .agg(first, F.count(F.lit(1)).alias("n"))
        .select(
            "fp", "sha",
            F.when(F.col("n") == F.col("group_size"), F.col("group_size"))
            .otherwise(F.raise_error(F.lit("two texts share fingerprint and SHA-256"))).alias("group_size"),
            F.col("first.doc_id").alias("keep_id"), F.col("first.uid").alias("keep_uid"),
        )
    )
    firsts = materialise(firsts)
    single = F.col("keep_uid").isNull()
    return keys.join(small(firsts), ["fp", "sha"], "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(single, F.lit(1).cast("long")).otherwise(F.col("group_size")).alias("group_size"),
        (single | (F.col("keep_uid") == F.col("uid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that :func:`exact_dedup` keeps, with all their columns.

    Rows are found again by id. Where one id stands on several rows, those rows
    are first reduced to one per (id, normalised text).
    """
    decided = materialise(exact_dedup(docs, id_col, text_col).select("doc_id", "kept", "text_sha256"))
    dropped = materialise(decided.where(~F.col("kept")).select("doc_id", "text_sha256"))
    ids = materialise(decided.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    out = small(dropped)
    if ids.isEmpty():
        return docs.join(out, docs[id_col].eqNullSafe(out["doc_id"]), "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), F.col(id_col).alias("doc_id"), F.sha2(normalised(text_col), 256).alias("text_sha256"))
    kept = materialise(decided.where("kept").select("doc_id", "text_sha256"))
    kept = small(kept)
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["text_sha256"] == kept["text_sha256"])
    rows = rows.join(kept, same, "left_semi")
    return rows.groupBy("doc_id", "text_sha256").agg(F.first("row").alias("row")).select("row.*")
