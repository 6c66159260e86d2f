"""Connected components of a graph given as a DataFrame of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import MAX_BROADCAST_ROWS, materialise

#: links a task takes in the rounds, and the fewest tasks of a round
TASK_LINKS = 20_000
MIN_TASKS = 8


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of a link ``a, b`` (longs); the component
    is the smallest node reachable.

    Each task first replaces its links by a forest with the same components (at
    most one link a node), then the forests are joined in distributed rounds.
    """
    n = link_tasks(links.count())
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    ends = ends.coalesce(n).mapInArrow(_forest, "a long, b long").distinct()
    return distributed_components(materialise(ends.coalesce(n)))


def link_tasks(links: int) -> int:
    """Tasks of a round over so many links: the rounds are many short stages, and with
    one task a shuffle partition the driver would keep the books of many empty tasks."""
    return max(MIN_TASKS, -(-links // TASK_LINKS))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task -> one link from each node to the smallest of its component there."""
    links = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if b.num_rows]
    if not links:
        return
    nodes, ends = np.unique(np.concatenate(links, axis=1), return_inverse=True)
    a, b = ends.reshape(2, -1)
    root = np.arange(len(nodes))
    while True:
        # the larger of two roots hooks to the smaller one, then all hooks are followed
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            break
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]
    other = root != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[root[other]])], names=["a", "b"])


def distributed_components(ends: DataFrame) -> DataFrame:
    """The same from materialised links ``a > b``.

    Each round hooks every node to its smallest neighbour, follows the hooks to
    their roots, and keeps only the links between different roots, now between
    the roots themselves. Links shrink with every round; all state is distributed,
    over as many tasks as the links ask for.
    """
    labels, tasks = None, None
    while count := ends.count():
        n = link_tasks(count)
        tasks = tasks or n
        hooks = ends.coalesce(n).groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("root"))
        roots = _follow(hooks, n, count)
        if labels is None:
            labels = roots
        else:
            moved = labels.select(F.col("root").alias("old"), F.col("node").alias("n"))
            moved = moved.join(_few(roots, count), moved["old"] == roots["node"], "left").select(F.col("n").alias("node"), F.coalesce("root", "old").alias("root"))
            labels = materialise(moved.unionByName(roots).coalesce(tasks))
        ends = materialise(_between(ends.coalesce(n), roots, n, count))
    if labels is None:
        none = ends.select(F.col("a").alias("node"), F.col("b").alias("component"))
        return none
    return _with_roots(labels, tasks)


def _few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most ``rows`` rows with a broadcast hint if these are few: else adaptive
    execution shuffles it first and reads it for a broadcast with a task a shuffle partition."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def _follow(hooks: DataFrame, tasks: int, rows: int) -> DataFrame:
    """Hooks (each to a smaller node, at most ``rows``) followed to nodes without a hook,
    written to the shared folder."""
    hooks = materialise(hooks.coalesce(tasks))
    while True:
        nxt = hooks.select(F.col("node").alias("via"), F.col("root").alias("further"))
        jumped = hooks.join(_few(nxt, rows), hooks["root"] == nxt["via"], "left")
        jumped = jumped.select("node", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        jumped = materialise(jumped.coalesce(tasks))
        hooks = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return hooks


def _between(ends: DataFrame, roots: DataFrame, tasks: int, rows: int) -> DataFrame:
    """The links between different roots, as links of the roots."""
    for side in ("a", "b"):
        r = roots.select(F.col("node").alias("n"), F.col("root").alias("r"))
        other = "b" if side == "a" else "a"
        ends = ends.join(_few(r, rows), ends[side] == r["n"], "left").select(F.coalesce("r", side).alias(side), other).coalesce(tasks)
    ends = ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    return ends.distinct().coalesce(tasks)


def _with_roots(labels: DataFrame, tasks: int) -> DataFrame:
    found = labels.groupBy("node").agg(F.min("root").alias("component")).coalesce(tasks)
    own = labels.select(F.col("root").alias("node"), F.col("root").alias("component"))
    return found.unionByName(own).groupBy("node").agg(F.min("component").alias("component")).coalesce(tasks)
