"""Filter audit: what each filter removes in every order of applying them.

Every document gets a bit mask of the filters it fails. Documents of one part
with the same mask fare alike in every order, so Spark first sums them per part
and mask. For K filters there are K! orders; the inverse of an order holds the
position of every filter in it. The step at which a mask goes is the minimum over
its filters of their positions (a min-plus product: the mask matrix holds 0 where
a filter fails and infinity elsewhere). Scattering the sums of the masks to
(order, step) gives what is removed; what is kept, redundant or removed over all
orders follows from the same steps.

Equality of whole texts is decided by SHA-256: per digest the smallest id, and
only the digests found twice or more meet the documents again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialise, ship_package, small
from basketry.llm.repetition import code_points

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
# fixed values
_MARKS = b"#$%&*|"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))

AUDIT_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_failures(raw: bytes) -> int:
    """Bits of the filters that a text fails by itself: A 1, B 2, C 4, D 8."""
    words = raw.split()  # at exactly the six ASCII space characters
    mask = int(len(words) < MIN_WORDS)
    mask |= (100 * len(set(words)) < MIN_DISTINCT * len(words)) << 1
    mask |= (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > MAX_CAPITALS * code_points(raw)) << 2
    return mask | (len(raw.translate(None, _MARKS)) < len(raw)) << 3


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        masks, digests = [], []
        for text in b.column(2):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            masks.append(text_failures(raw))
            digests.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], names=["part", "doc_id", "mask", "digest"]
        )


def failures(docs: DataFrame) -> DataFrame:
    """``part, doc_id, mask`` of every document, bits as in :func:`text_failures`
    and 16 for E, a text that a row with a smaller id holds too."""
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    rows = docs.select(part.alias("part"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    judged = materialise(rows.mapInArrow(_judge, "part string, doc_id long, mask int, digest binary"))
    first = judged.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    repeated = materialise(first.where("first_id < last_id").select("digest", "first_id"))
    later = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)).cast("int") * 16
    return judged.join(small(repeated), "digest", "left").select("part", "doc_id", (F.col("mask") + later).alias("mask"))


def mask_sums(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those labelled good and toxic."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    marked = failed.join(small(materialise(marks.where("good + toxic > 0"))), "doc_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), total("good"), total("toxic"))


def positions(filters: str = FILTERS) -> tuple[list[str], np.ndarray]:
    """All orders of the filters, and per order the step (from 1) of each filter."""
    orders = np.array(list(permutations(range(len(filters)))), np.int64).reshape(-1, len(filters))
    return ["".join(filters[f] for f in o) for o in orders], np.argsort(orders, axis=1) + 1


def removal_steps(fails: np.ndarray, position: np.ndarray) -> np.ndarray:
    """(masks, orders): the step at which each mask goes, one past the last if never."""
    never = position.shape[1] + 1
    cost = np.where(fails, 0, never)  # 0 or "infinity"; the product is cut at ``never``
    return np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2, initial=never), never)


def audit_part(part: str, masks: np.ndarray, weights: np.ndarray, filters: str = FILTERS) -> pd.DataFrame:
    """The rows of one part from its masks and their sums (columns n, good, toxic)."""
    k = len(filters)
    names, position = positions(filters)
    fails = (masks[:, None] >> np.arange(k) & 1).astype(bool)
    step = removal_steps(fails, position)
    orders = np.arange(len(names))
    lost = np.zeros((len(names), k + 2, 3), np.int64)  # by order, step and weight
    np.add.at(lost, (orders[None, :], step), weights[:, None, :])
    lost = lost[:, 1:]  # steps from 1; the last is "never"
    kept = lost[:, ::-1, 0].cumsum(axis=1)[:, ::-1][:, 1:]
    removed = lost[:, :k]
    at = np.argsort(position, axis=1)  # the filter of each step
    failing = (weights[:, :1] * fails).sum(axis=0)
    alone = (weights[:, :1] * (fails & (fails.sum(axis=1) == 1)[:, None])).sum(axis=0)
    by_filter = np.zeros(k, np.int64)
    np.add.at(by_filter, at, removed[:, :, 0])
    flat = {
        "kept": kept, "removed": removed[:, :, 0], "redundant": failing[at] - removed[:, :, 0], "unique_fails": alone[at],
        "good_lost": removed[:, :, 1], "toxic_lost": removed[:, :, 2], "shapley": by_filter[at],
    }
    head = {"part": part, "filter_order": np.repeat(names, k), "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(names))}
    return pd.DataFrame(head | {name: x.ravel() for name, x in flat.items()})


def audit(sums: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step, from ``part, mask, n, good, toxic``: at
    most 2 ** K rows of a part come together."""

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return audit_part(key[0], rows["mask"].to_numpy(np.int64), rows[["n", "good", "toxic"]].to_numpy(np.int64), filters)

    return sums.groupBy("part").applyInPandas(one, AUDIT_SCHEMA)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs``, per ``lang``.

    A null lang is the part of the empty string, a null text is empty. A null id
    is neither smaller nor larger than any: such a row never fails E and makes no
    other fail it. Rows that repeat an id and its text do not fail E for each
    other and count each. A document is good or toxic if any of its label rows
    says so; labels of a null id, null labels and labels without a document count
    for nothing. An empty table gives an empty result. A text of any length is
    read whole, in memory with some 20 times its bytes at most. Other columns are
    not read, whatever their names.
    """
    ship_package(docs.sparkSession)
    return audit(mask_sums(failures(docs), labels))
