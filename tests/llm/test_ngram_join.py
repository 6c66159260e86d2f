"""N-gram join against all pairs of plain Python sets."""

import random
import re

import numpy as np
import pandas as pd
import pytest

from basketry.llm import ngram_join as op
from basketry.llm import shingles
from basketry.llm.components import components


def shingle_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        best.setdefault(find(i), []).append(doc_id)
    low = {r: min((x for x in ids if x is not None), default=None) for r, ids in best.items()}
    return sorted(((doc_id, len(sets[i]), low[find(i)]) for i, (doc_id, _) in enumerate(rows)), key=str)


def result(df):
    return sorted((tuple(r) for r in op.near_duplicates(df).drop("version").collect()), key=str)


def edited(words, rng, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return w


def corpus(seed):
    """Families of near copies around the threshold, shared passages, chains, short texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randrange(30, 160))]
        for _ in range(rng.randrange(2, 9)):
            texts.append(edited(base, rng, rng.randrange(0, 6)))
        chain = base
        for _ in range(4):
            chain = edited(chain, rng, 2)
            texts.append(chain)
    for _ in range(40):  # mostly the passage
        texts.append([rng.choice(vocab) for _ in range(rng.randrange(0, 25))] + passage)
    for _ in range(30):
        texts.append([rng.choice(vocab) for _ in range(rng.randrange(1, 30))])
    rows = [" ".join(t) for t in texts] + ["a b", "A  b", "a b c d", "", None, " ", "x " * 300, "x " * 400, texts and " ".join(texts[0])]
    rng.shuffle(rows)
    return [(1000 - 3 * i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs(make_docs, seed):
    rows = corpus(seed)
    assert result(make_docs(rows, 4)) == brute(rows)


def test_nulls_repeats_and_threshold(make_docs):
    w = [f"w{i}" for i in range(200)]
    # 7 + 1 shared of 8: sets of sizes whose overlap is exactly, or just below, three quarters
    exact = [(1, " ".join(w[:16])), (2, " ".join(w[:13])), (3, " ".join(w[100:115])), (4, " ".join(w[100:112]))]
    rows = exact + [(5, "p q r s t u"), (5, "p q r s t u"), (None, "p q r s t u"), (None, "lone words of a row with no id"), (6, None), (6, ""), (7, "K" * 3_000_000 + " b")]
    assert result(make_docs(rows)) == brute(rows)


def test_one_large_group(make_docs):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(edited(base, rng, rng.randrange(0, 4)))) for i in range(250)] + [(900 + i, " ".join(base)) for i in range(100)]
    assert result(make_docs(rows, 8)) == brute(rows)


def test_complete_round_finds_what_the_stars_miss(make_docs, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(op, "_most_met", lambda key, rows: pd.DataFrame({"a": np.array([], "int64"), "b": np.array([], "int64")}))
    assert result(make_docs(rows, 4)) == brute(rows)


@pytest.mark.parametrize("long_lists", [0, 2])
def test_split_lists_and_small_groups(make_docs, monkeypatch, long_lists):
    """Lists split from the first doubling on, texts in groups of a few: in the driver's own run of the steps."""
    import pyarrow as pa

    rows = corpus(4)
    monkeypatch.setattr(op, "LIST_ROWS_LOG2", long_lists)
    monkeypatch.setattr(op, "GROUP_BYTES", 2000)
    monkeypatch.setattr(op.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": staticmethod(lambda: 3)})))
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows]), pa.array(range(len(rows)), pa.int64())], names=["doc_id", "text", "version"])
    blocks = pd.concat([b.to_pandas() for b in op._deal(3)(iter([batch]))])
    answers = pd.concat([op._shared((k,), g) for k, g in blocks.groupby("block")])
    docs = pd.concat([op._rare_first((k,), g) for k, g in answers.groupby("base")])
    assert dict(zip(docs["doc_id"], docs["n"])) == {i: len(shingle_set(t)) for i, t in rows}

    able = docs[docs["tokens"].notna()]
    sets = {u: set(op._tokens(t)[0].tolist()) for u, t in zip(able["uid"], able["tokens"])}
    keep = [(n - (3 * n + 3) // 4 + 1 - (n - m)) * op._TOKEN for n, m in zip(able["n"], able["m"])]
    cut = pa.RecordBatch.from_arrays(
        [pa.array(able["uid"]), pa.array(able["uid"]), pa.array(able["n"]), pa.array(able["m"]), pa.array([t[: max(0, c)] for t, c in zip(able["tokens"], keep)], pa.binary())],
        names=["uid", "component", "n", "m", "tokens"],
    )
    dealt = pd.concat([b.to_pandas() for b in op._lists_for_pairs(3)(iter([cut]))])
    assert dealt["cell"].max() > 0
    pairs = pd.concat([op._across(k, g) for k, g in dealt.groupby(["block", "cell"])]).drop_duplicates()
    got = {(a, b) for a, b in zip(pairs["a"], pairs["b"])}
    size = dict(zip(able["uid"], able["n"]))
    links = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= op.least_overlap(size[a], size[b])}
    assert links and links <= got


def test_empty(make_docs):
    assert result(make_docs([])) == []
    assert result(make_docs([(2, None), (1, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_kept_documents(make_docs):
    rows = corpus(1)
    docs = make_docs(rows)
    got = op.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _, c in brute(rows) if i == c)


def test_kept_rows_of_repeated_and_missing_ids(make_docs):
    words = [f"w{i}" for i in range(40)]
    near = " ".join(words), " ".join([*words[:39], "x"])
    rows = [(1, near[0]), (5, near[1]), (5, "another text of the same id"), (None, near[1]), (None, "no id here"), (7, None)]
    got = op.drop_near_duplicates(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)


def test_hashes_follow_the_words():
    rng = random.Random(1)
    parts = ["Foo", "bär", "x", "\x0b", "the", "\n", " q", "A" * 30]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["", "  ", "a b", "A  b"]
    seen = {}
    for chunk in (16, 1 << 20):
        shingles._CHUNK, before = chunk, shingles._CHUNK
        hashes, owner = shingles.shingle_hashes([t.encode() for t in texts])
        shingles._CHUNK = before
        for i, t in enumerate(texts):
            assert len(set(hashes[owner == i].tolist())) == len(shingle_set(t))
            assert seen.setdefault(shingle_set(t), frozenset(hashes[owner == i].tolist())) == frozenset(hashes[owner == i].tolist())


@pytest.mark.parametrize("partitions", [1, 5])
def test_components(spark, partitions):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(partitions)).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_component_rounds_have_tasks_by_their_links(spark):
    """Few links over many shuffle partitions: a round has no task per partition."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long").repartition(5)
        found = components(links)
        assert found.rdd.getNumPartitions() <= 8
        assert {r.node: r.component for r in found.collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)


def test_stages_have_tasks_by_their_size(spark, make_docs):
    """Few documents over many shuffle partitions: the sets and the component rounds
    have no stage with a task per partition, and few stages of the whole join have."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def tasks(group, run):
        spark.sparkContext.setJobGroup(group, group)
        found = run()
        tracker = spark.sparkContext.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        return found, [i.numTasks for s in stages if (i := tracker.getStageInfo(s)) and i.numCompletedTasks]

    try:
        links = spark.createDataFrame([(i + i % 7, i + 1) for i in range(400)], "a long, b long").repartition(5)
        _, rounds = tasks("rounds", lambda: components(links).count())
        # a union of two frames has the tasks of both
        assert rounds and max(rounds) <= 16
        words = [f"w{i}" for i in range(60)]
        rows = [(g * 100 + i, " ".join([f"g{g}{w}" for w in words[: 55 + i]])) for g in range(6) for i in range(5)]
        assert op.shingle_sets(make_docs(rows)).rdd.getNumPartitions() <= op.MIN_TASKS
        found, all_ = tasks("whole", lambda: op.near_duplicates(make_docs(rows)).collect())
        assert {r.doc_id: r.component_id for r in found} == {i: c for i, _, c in brute(rows)}
        assert sum(n > 16 for n in all_) < 0.15 * len(all_)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
