"""Approximate nearest neighbours with learned partitions.

1. *Fit*, on a bounded sample (``SAMPLE`` vectors): the exact neighbour graph of
   the sample is cut into balanced parts (recursive spectral bisection at the
   median, then swaps of nodes across each cut while they lower it), and a small
   classifier (one hidden layer) learns in which parts a vector's neighbours lie.
   The number of parts a query visits is the smallest that reaches
   ``TARGET_RECALL`` on the sample. A part with more than ``SPLIT_ROWS`` vectors is
   fitted again on a sample of its own, in a task of its own, and so on: the parts
   grow in number with the rows, not in size, up to ``LEVELS`` levels.
2. *Index*: every vector goes to its most probable part. Parts are stored as
   blocks of about ``BLOCK_ROWS`` vectors, so a part with a third of all rows (of
   equal vectors, say, which no router can split) is many blocks, spread by a hash.
3. *Search*: queries go to their most probable parts; each (block, block of
   queries) is one matrix product. The best of each block are scored again in
   double precision, summed in component order, so equal vectors tie exactly.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialise, ship_package

K = 20
QUERY_EVERY = 20
PARTS = 16
SAMPLE = 4096
GRAPH_K = 10
TARGET_RECALL = 0.97
#: parts of more rows are split again, at most so many levels deep (each costs some recall)
SPLIT_ROWS, LEVELS = 65_536, 3
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
_HIDDEN = 128
_SEED = 5


# -- fit, on the sample only


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` largest inner products of each row with the others."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for a in range(0, len(x), 512):
        scores = x[a : a + 512] @ x.T
        scores[np.arange(len(scores)), np.arange(a, a + len(scores))] = -np.inf
        out[a : a + 512] = np.argsort(-scores, axis=1, kind="stable")[:, : out.shape[1]]
    return out


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of each node of a neighbour graph; part sizes differ by a few nodes at
    most. ``parts`` is a power of two."""
    n = len(graph)
    part = np.zeros(n, np.int64)
    rows = np.repeat(np.arange(n), graph.shape[1])
    both = np.concatenate([np.stack([rows, graph.ravel()]), np.stack([graph.ravel(), rows])], axis=1)
    rng = np.random.default_rng(_SEED)
    for _ in range(parts.bit_length() - 1):
        part *= 2
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            inside = both[:, (place[both[0]] >= 0) & (place[both[1]] >= 0)]
            part[nodes] += _bisect(place[inside[0]], place[inside[1]], len(nodes), rng)
    return part


def _bisect(a: np.ndarray, b: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """0 or 1 per node, half of the nodes each, with few edges (a, b) across."""
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    scale = 1 / np.sqrt(degree)
    top = np.sqrt(degree) / np.linalg.norm(np.sqrt(degree))
    v = rng.standard_normal(n)
    for _ in range(60):  # power iteration for the second eigenvector
        v -= top * (top @ v)
        v = v + np.bincount(a, weights=(scale * v)[b], minlength=n) * scale
        v /= np.linalg.norm(v) or 1.0
    side = np.zeros(n, np.int64)
    side[np.argsort(v * scale, kind="stable")[n // 2 :]] = 1
    for _ in range(20):  # swap the nodes that gain most, in pairs
        across = np.bincount(a, weights=side[a] != side[b], minlength=n)
        gain = 2 * across - np.bincount(a, minlength=n)
        left, right = (nodes[np.argsort(-gain[nodes], kind="stable")] for nodes in (np.flatnonzero(side == 0), np.flatnonzero(side == 1)))
        m = min(len(left), len(right))
        good = int(np.sum(gain[left[:m]] + gain[right[:m]] > 2)) // 4
        if not good:
            break
        side[left[:good]], side[right[:good]] = 1, 0
    return side


class Router:
    """A classifier from a vector to probabilities of the parts."""

    def __init__(self, x: np.ndarray, target: np.ndarray, epochs: int = 60):
        rng = np.random.default_rng(_SEED)
        self.weights = [
            rng.standard_normal((x.shape[1], _HIDDEN)) * np.sqrt(2 / x.shape[1]), np.zeros(_HIDDEN),
            rng.standard_normal((_HIDDEN, target.shape[1])) * np.sqrt(1 / _HIDDEN), np.zeros(target.shape[1]),
        ]
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 128):
                t += 1
                rows = order[a : a + 128]
                for w, g, m, s in zip(self.weights, self._gradient(x[rows], target[rows]), first, second):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    w -= 0.003 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)

    def _gradient(self, x: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        w1, b1, w2, b2 = self.weights
        hidden = np.maximum(x @ w1 + b1, 0)
        off = (self._softmax(hidden @ w2 + b2) - target) / len(x)
        back = (off @ w2.T) * (hidden > 0)
        return [x.T @ back, back.sum(0), hidden.T @ off, off.sum(0)]

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        w1, b1, w2, b2 = self.weights
        return self._softmax(np.maximum(x / np.where(norm > 0, norm, 1) @ w1 + b1, 0) @ w2 + b2)


def fit(x: np.ndarray, parts: int = PARTS, k: int = K, target_recall: float = TARGET_RECALL) -> tuple[Router, int]:
    """The router and the number of parts to visit, from sample vectors ``x``."""
    parts = 1 << max(0, min(parts, len(x) // 64).bit_length() - 1)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    unit = x / np.where(norm > 0, norm, 1)
    if parts == 1:
        return Router(unit, np.ones((len(x), 1)), epochs=0), 1
    graph = neighbours(unit, GRAPH_K)
    part = balanced_parts(graph, parts)
    target = np.zeros((len(x), parts))
    for column in range(graph.shape[1]):
        np.add.at(target, (np.arange(len(x)), part[graph[:, column]]), 1 / graph.shape[1])
    router = Router(unit, target)
    p = router.probabilities(x)
    home, order = p.argmax(axis=1), np.argsort(-p, axis=1, kind="stable")
    # how many of the true neighbours lie in the first 1, 2, ... parts
    near = home[neighbours(x, k)]
    rank = np.argsort(order, axis=1)
    found = np.take_along_axis(rank, near, axis=1)
    recall = [(found < visit).mean() for visit in range(1, parts + 1)]
    return router, 1 + int(np.argmax(np.array(recall) >= target_recall))


# -- index and search


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``uid, vec_id, v`` (array of double): rows that take part; ``uid`` numbers them.

    Left out are null ids, null or empty vectors, zero vectors, those with null or
    non-finite components, and those of another length than most rows. Rows that
    repeat an id are rows of their own.
    """
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size("v") == (common["size"] if common else 0))
    return rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "v")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


#: node of the tree of routers -> its router and the number of parts a query visits
Tree = dict[int, tuple[Router, int]]


def descend(tree: Tree, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf): for each vector its most probable leaf, or all that a query visits."""
    rows, nodes, found = np.arange(len(x)), np.zeros(len(x), np.int64), []
    while len(rows):
        inner = np.isin(nodes, list(tree))
        found.append((rows[~inner], nodes[~inner]))
        rows, nodes = rows[inner], nodes[inner]
        below = []
        for node in np.unique(nodes):
            router, visit = tree[int(node)]
            own = rows[nodes == node]
            order = np.argsort(-router.probabilities(x[own]), axis=1, kind="stable")[:, : visit if query else 1]
            below.append((np.repeat(own, order.shape[1]), (node * (PARTS + 1) + 1 + order).ravel()))
        rows, nodes = (np.concatenate(z) for z in zip(*below)) if below else (rows, nodes)
    return tuple(np.concatenate(z) for z in zip(*found)) if found else (rows, nodes)


def _route(tree: Tree, query_every: int | None):
    """Vectors -> one row for the index and, unless ``query_every`` is None, one for each leaf a query visits."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            uids, ids, x = b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(b.column(2))
            raw = [row.tobytes() for row in x]
            rows, parts = descend(tree, x, False)
            query = np.zeros(len(rows), bool)
            if query_every is not None:
                asks = np.flatnonzero(ids % query_every == 0)
                visits, leaves = descend(tree, x[asks], True)
                rows, parts = np.concatenate([rows, asks[visits]]), np.concatenate([parts, leaves])
                query = np.r_[query, np.ones(len(visits), bool)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids[rows]), pa.array(ids[rows]), pa.array(parts), pa.array(query), pa.array([raw[i] for i in rows], pa.binary())],
                names=["uid", "vec_id", "part", "query", "v"],
            )

    return route


_ROUTED = "uid long, vec_id long, part long, query boolean, v binary"


def _fit_part(k: int):
    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(rows.sort_values("uid")["v"]), np.float64).reshape(len(rows), -1)
        return pd.DataFrame({"part": [key[0]], "router": [pickle.dumps(fit(x, PARTS, k))]})

    return one


def grow(rows: DataFrame, tree: Tree, k: int) -> Tree:
    """Split the leaves of more than ``SPLIT_ROWS`` rows, level by level. A sample of
    about ``SAMPLE`` rows per leaf is taken by a hash; the counts and the routers
    that come to the driver are one for so many rows each."""
    for _ in range(LEVELS - 1):
        placed = rows.mapInArrow(_route(tree, None), _ROUTED)
        large = materialise(placed.groupBy("part").count().where(f"count > {SPLIT_ROWS}"))
        if large.isEmpty():
            break
        share = F.pmod(F.xxhash64(F.lit(_SEED), "uid"), F.col("count"))
        sample = placed.join(F.broadcast(large), "part").where(share < SAMPLE).select("part", "uid", "v")
        fitted = sample.groupBy("part").applyInPandas(_fit_part(k), "part long, router binary").collect()
        # a sample that cannot be split (a single part) stays a leaf
        found = {f.part: pickle.loads(f.router) for f in fitted}
        tree = tree | {part: (router, visit) for part, (router, visit) in found.items() if router.weights[3].size > 1}
    return tree


def _block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    ids = rows[["uid", "vec_id"]].to_numpy(np.int64)
    return pd.DataFrame({"part": [key[0]], "ids": [np.ascontiguousarray(ids).tobytes()], "vs": [b"".join(rows["v"])]})


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``part, ids, vs``: the rows of each part in blocks of about ``size``."""
    counts = F.broadcast(materialise(rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / size).alias("salts"))))
    salted = rows.join(counts, "part").withColumn("salt", F.pmod(F.xxhash64("uid"), F.col("salts")))
    return salted.groupBy("part", "salt").applyInPandas(_block, "part long, ids binary, vs binary")


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed in component order."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * x[:, d]
    return total


def best(q_uids: np.ndarray, q: np.ndarray, uids: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vec id, score) of the ``k`` nearest rows of each query, its own row left out."""
    out = []
    lengths = np.linalg.norm(x, axis=1).max(initial=0)
    step = max(1, (1 << 21) // max(len(x), 1))
    for a in range(0, len(q), step):
        part = q[a : a + step]
        scores = part @ x.T
        scores[q_uids[a : a + step, None] == uids[None, :]] = -np.inf
        # all that may belong to the first k; rounding differs between matrix product and sum
        kth = np.partition(scores, max(0, len(x) - k), axis=1)[:, max(0, len(x) - k)]
        slack = 1e-12 * lengths * np.linalg.norm(part, axis=1)
        r, c = np.nonzero((scores >= (kth - slack)[:, None]) & (scores > -np.inf))
        exact = exact_products(part[r], x[c])
        order = np.lexsort((ids[c], -exact, r))
        r, c, exact = r[order], c[order], exact[order]
        starts = np.searchsorted(r, r, side="left")
        keep = np.arange(len(r)) - starts < k
        out.append((a + r[keep], ids[c[keep]], exact[keep]))
    return tuple(np.concatenate(z) for z in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q_ids, q, ids, x in zip(*(b.column(n) for n in ("q_ids", "q_vs", "ids", "vs"))):
                q_ids, ids = (np.frombuffer(z.as_buffer(), np.int64).reshape(-1, 2) for z in (q_ids, ids))
                q, x = (np.frombuffer(z.as_buffer(), np.float64).reshape(len(i), -1) for z, i in ((q, q_ids), (x, ids)))
                query, vec, score = best(q_ids[:, 0], q, ids[:, 0], ids[:, 1], x, k)
                # one row a query: its best of this block
                starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
                offsets = pa.array(np.r_[starts, len(query)].astype(np.int32))
                found = pa.StructArray.from_arrays([pa.array(-score), pa.array(vec)], names=["far", "vec_id"])
                own = q_ids[query[starts]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[:, 0]), pa.array(own[:, 1]), pa.ListArray.from_arrays(offsets, found)], names=["query_uid", "query_id", "found"]
                )

    return search


def nearest(
    df: DataFrame, k: int = K, query_every: int = QUERY_EVERY, parts: int = PARTS, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every query,
    nearest first, ties to the smaller id. Queries are the rows whose id is
    divisible by ``query_every``; all rows but the query's own are candidates.

    Rows that :func:`vectors` leaves out take no part on either side. Rows that
    repeat an id are candidates of their own, for each other too, and queries of
    their own under the same ``query_id``. No vectors, no queries or no candidates
    give no rows; an empty table gives an empty result.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = materialise(vectors(df, id_col, vec_col))
    # by the values: the sample does not depend on how rows are numbered
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = grow(rows, {0: fit(_matrix(sample), parts, k)}, k)

    routed = materialise(rows.mapInArrow(_route(tree, query_every), _ROUTED))
    index = _blocks(routed.where("not query"), BLOCK_ROWS)
    asked = _blocks(routed.where("query"), QUERY_ROWS).withColumnsRenamed({"ids": "q_ids", "vs": "q_vs"})
    # both sides are blocks: a row here is a matrix product
    tiles = asked.join(index, "part").select("q_ids", "q_vs", "ids", "vs")
    tiles = tiles.repartition(F.xxhash64("q_ids", "ids"))
    found = tiles.mapInArrow(_search(k), "query_uid long, query_id long, found array<struct<far double, vec_id long>>")
    first = F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k)
    ranked = found.groupBy("query_uid", "query_id").agg(first.alias("found")).select("query_id", F.posexplode("found").alias("i", "hit"))
    return ranked.select("query_id", (F.col("i") + 1).alias("rank"), "hit.vec_id", (-F.col("hit.far")).alias("score"))
