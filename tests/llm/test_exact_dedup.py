"""Exact dedup against a plain dictionary of normalised texts."""

import hashlib
import re

import numpy as np
import pandas as pd

from basketry.llm import exact_dedup as op


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(norm(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, sha))
            first = first and i != keep
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in op.exact_dedup(df).collect()), key=str)


CASES = [
    (5, "a  b"), (2, "a\tb"), (9, "a b "), (3, None), (8, ""), (4, " "), (7, "x" * 100_000), (1, "x" * 100_000),
    (6, "é\u00a0b"), (10, "é\u00a0b"), (10, "é\u00a0b"), (11, "A B"), (None, "null id"), (None, "null id"), (None, "a b"),
]


def test_cases(make_docs):
    assert result(make_docs(CASES)) == brute(CASES)


def test_hot_group_and_partitions(make_docs):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(400)]
    assert result(make_docs(rows, 7)) == brute(rows) == result(make_docs(rows, 1))


def test_empty(make_docs):
    assert result(make_docs([])) == []


def test_fingerprint_collision_is_split_by_bytes(make_docs, monkeypatch):
    import pyspark.sql.functions as F

    monkeypatch.setattr(op.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, "c")]
    assert result(make_docs(rows)) == brute(rows)


def test_filter_merge_is_lossless():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    prints = rng.integers(-(2**63), 2**63 - 1, 200).repeat(rng.integers(1, 4, 200))
    parts = np.array_split(rng.permutation(prints), 5)
    runs = pd.concat([b.to_pandas() for p in parts for b in op._build_filter(4)(iter([pa.RecordBatch.from_arrays([pa.array(p)], names=["fp"])]))])
    got = pd.concat([op._merge_runs(4)((q,), g) for q, g in runs.groupby("quotient")])
    values, counts = np.unique(prints, return_counts=True)
    assert dict(zip(got["fp"], got["n"])) == dict(zip(values[counts > 1], counts[counts > 1]))


def test_drop_duplicates_keeps_columns_and_one_row(make_docs):
    docs = make_docs(CASES)
    got = op.drop_duplicates(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, norm(r.text)) for r in got.collect()), key=str)
    want = {}
    for i, text in CASES:
        want.setdefault(norm(text), []).append(i)
    first = lambda ids: min((i for i in ids if i is not None), default=None)
    assert kept == sorted(((first(ids), text) for text, ids in want.items()), key=str)


def test_drop_duplicates_unique_ids(make_docs):
    rows = [(i, f"t{i % 4}") for i in range(12)]
    assert sorted(r.doc_id for r in op.drop_duplicates(make_docs(rows)).collect()) == [0, 1, 2, 3]
