"""Nearest neighbours: recall and exact scores against brute force."""

import numpy as np
import pandas as pd
import pytest

from basketry.llm import ann
from basketry.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, part string, v string, found string"


@pytest.fixture(scope="module")
def make(spark):
    def _make(rows):
        rows = [(None if i is None else int(i), None if v is None else [None if x is None else float(x) for x in v], "p", "v", "f") for i, v in rows]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return _make


def brute_force(df, k=20, query_every=20):
    """The exact answer for distinct ids, by plain sums over the table's rows."""
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in df.collect()]
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    out = []
    for i, v in rows:
        if i % query_every == 0:
            score = np.zeros(len(x))
            for d in range(x.shape[1]):
                score += v[d] * x[:, d]
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out += [(i, int(ids[j]), float(score[j])) for j in order]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def recall(got, want):
    pairs = got.merge(want, on=["query_id", "vec_id"])
    return len(pairs) / len(want)


def checked(df, **kw):
    got = ann.nearest(df, **kw).toPandas().sort_values(["query_id", "rank"])
    want = brute_force(df, **kw)
    both = got.merge(want, on=["query_id", "vec_id"], suffixes=("", "_true"))
    assert (both["score"] == both["score_true"]).all()
    for _, g in got.groupby("query_id"):
        assert list(g["rank"]) == list(range(1, len(g) + 1))
        assert list(zip(-g["score"], g["vec_id"])) == sorted(zip(-g["score"], g["vec_id"]))
    assert (got["query_id"] != got["vec_id"]).all()
    return got, want


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_on_the_table(spark, sf_dir):
    got, want = checked(table(spark, sf_dir, "embeddings"))
    assert len(got) == len(want) and recall(got, want) >= 0.9


def test_hot_vector_and_ties(make):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::3] = x[0]
    df = make(enumerate(x))
    got, want = checked(df)
    assert recall(got, want) >= 0.9
    hot = got[got["query_id"] == 60]  # ties: the smallest ids
    assert list(hot["vec_id"]) == [i for i in range(0, 66, 3) if i != 60][:20]


def test_blocks_do_not_change_the_result(make, monkeypatch):
    x = np.random.default_rng(1).standard_normal((600, 6))
    whole = ann.nearest(make(enumerate(x))).toPandas()
    monkeypatch.setattr(ann, "BLOCK_ROWS", 40)
    monkeypatch.setattr(ann, "QUERY_ROWS", 7)
    parts = ann.nearest(make(enumerate(x))).toPandas()
    order = ["query_id", "rank"]
    pd.testing.assert_frame_equal(whole.sort_values(order, ignore_index=True), parts.sort_values(order, ignore_index=True))


def test_rows_that_take_no_part(make):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, [0.5, 1]), (2, None), (3, []), (4, [0, 0]), (5, [nan, 1]), (6, [inf, 1]), (7, [None, 1]), (20, [2, 1]), (None, [9, 9]), (8, [1, 2, 3]), (1, [0.5, 1])]
    got = ann.nearest(make(rows)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (0, 1, 20, 2.0), (0, 2, 1, 0.5), (0, 3, 1, 0.5), (20, 1, 0, 2.0), (20, 2, 1, 2.0), (20, 3, 1, 2.0)
    ]


def test_rows_that_repeat_an_id(make):
    """Each is a candidate; a query's own row alone is left out."""
    got = ann.nearest(make([(0, [1, 0]), (1, [5, 0]), (1, [1, 1]), (2, [2, 0])])).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(1, 1, 5.0), (2, 2, 2.0), (3, 1, 1.0)]
    got = ann.nearest(make([(0, [1, 0]), (0, [3, 0])])).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 0, 3.0), (0, 1, 0, 3.0)]


def test_parts_grow_with_the_rows(spark, make, monkeypatch):
    """Clustered vectors, split over two levels: recall holds, a query meets a small share of the rows."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((64, 24)) * 3
    x = np.concatenate([c + 0.3 * rng.standard_normal((100, 24)) for c in centres])
    monkeypatch.setattr(ann, "SPLIT_ROWS", 300)
    rows = make(enumerate(x))
    got, want = checked(rows)
    assert recall(got, want) >= 0.9
    held = ann.vectors(rows, "vec_id", "embedding").checkpoint()
    tree = ann.grow(held, {0: ann.fit(x[:: len(x) // 4000 or 1], 16)}, 20)
    assert len(tree) > 1
    leaf = ann.descend(tree, x, False)[1]
    sizes = np.bincount(np.unique(leaf, return_inverse=True)[1])
    assert len(sizes) > 16 and sizes.max() < len(x) / 12
    visits = np.bincount(ann.descend(tree, x[::20], True)[0])
    assert visits.mean() * sizes.mean() < 0.5 * len(x)


def test_empty(make):
    assert ann.nearest(make([])).collect() == []
    assert ann.nearest(make([(0, [1, 1])])).collect() == []
    assert ann.nearest(make([(3, [1, 1]), (4, [1, 1])])).collect() == []


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((8, 16)) * 4
    x = np.concatenate([c + rng.standard_normal((64, 16)) for c in centres])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = ann.neighbours(x, 10)
    part = ann.balanced_parts(graph, 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.max() - sizes.min() <= 2
    assert (part[graph] == part[:, None]).mean() > 0.8
