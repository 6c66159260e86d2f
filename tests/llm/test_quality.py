"""Quality classifier: held-out accuracy, the exchange of pseudo-labels, edge cases."""

import pickle
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import quality
from basketry.llm.common import table


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, y int, use string")


def test_held_out_accuracy(spark):
    """Train on the labels of even ids, test on those of odd ids."""
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    got = quality.quality(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert len(bad) > 50
    assert good.keep.mean() > 0.98 and (~bad.keep).mean() > 0.9
    # calibrated: the mean score is near the share of good documents
    assert abs(got.score.mean() - got.quality.mean()) < 0.03


def test_views_teach_each_other():
    """With few labels, the other view's sure labels lift a view above its own start."""
    rng = np.random.default_rng(0)
    n, d = 3000, 60
    y = (rng.random(n) < 0.5).astype(float)
    a = rng.standard_normal((n, d)) + np.outer(2 * y - 1, np.r_[np.full(6, 0.5), np.zeros(d - 6)])
    b = np.eye(4)[np.where(y > 0.5, 0, 2) + (rng.random(n) < 0.5)]
    part = lambda s: {"text": a[s], "meta": b[s], "y": y[s]}
    with_pool = quality.CoTrained(part(slice(0, 12)), part(slice(12, 200)), part(slice(200, 1500)))
    without = quality.CoTrained(part(slice(0, 12)), part(slice(12, 200)), part(slice(0, 0)))
    accuracy = lambda m: (((a[1500:] @ m.weights["text"][:-1] + m.weights["text"][-1]) > 0) == (y[1500:] > 0.5)).mean()
    assert with_pool.exchanged > 0 and accuracy(with_pool) > accuracy(without)


def test_text_margin_equals_the_view():
    w = np.random.default_rng(1).standard_normal(quality.TEXT_BUCKETS + quality.REPETITIONS)
    for text in ("", None, "a", "ab", "Zürich 😀", "xyz" * 800_000):
        assert quality.text_margin(text, w) == pytest.approx(quality.text_view(text) @ w)


ROWS = [(i, f"plain words number {i} and more of them") for i in range(60)] + [(100 + i, "### $$$ %%% " * (1 + i % 5)) for i in range(60)]


def test_edge_rows(spark, make_docs):
    labels = labels_of(spark, [(i, 1, 0, 0, "") for i in range(0, 60, 2)] + [(100 + i, 0, 0, 0, "") for i in range(0, 60, 2)] + [(None, 0, 0, 0, ""), (3, None, 0, 0, ""), (9999, 1, 0, 0, ""), (4, 1, 0, 0, "")])
    docs = make_docs([*ROWS, (500, None, None), (501, "", None), (None, "plain words"), (1, ROWS[1][1])])
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(ROWS) + 4
    keep = {r.doc_id: r.keep for r in got}
    assert all(keep[i] for i, _ in ROWS[:60]) and not any(keep[i] for i, _ in ROWS[60:])
    assert all(0 <= x <= 1 for r in got for x in (r.p_text, r.p_meta, r.score))
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)


def test_nothing_to_learn_from(spark, make_docs):
    for rows in ([], [(1, 1, 0, 0, "")], [(None, 0, 0, 0, "")]):
        got = quality.quality(make_docs(ROWS), labels_of(spark, rows)).collect()
        assert all(r.keep and r.score == 1.0 for r in got) and len(got) == len(ROWS)
    assert quality.quality(make_docs([]), labels_of(spark, [(1, 1, 0, 0, "")])).collect() == []


def test_repeated_rows_of_a_document_count_once(spark, make_docs):
    """A hot id, with copies and with differing rows, takes no other document's place."""
    hot = [(100, f"### $$$ %%% {i % 5000}") for i in range(9000)]
    labels = labels_of(spark, [(i, 1, 0, 0, "") for i in range(60)] + [(100 + i, 0, 0, 0, "") for i in range(60)])
    docs = make_docs([*ROWS, *hot])
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(ROWS) + len(hot) and {r.keep for r in got if r.doc_id < 60} == {True} and {r.keep for r in got if r.doc_id >= 100} == {False}
    assert sorted(r.doc_id for r in quality._sampled(docs, quality._known(labels)).collect()) == sorted(i for i, _ in ROWS)


def test_every_unlabelled_document_can_teach(spark, make_docs):
    """Pseudo-labels come from all unlabelled documents (before: from 1000 of them)."""
    kinds = [(lambda i: f"plain words number {i} and more of them", "s0"), (lambda i: f"### $$$ %%% {i} " * 3, "s1")]
    docs = make_docs([(i, kinds[i % 2][0](i), kinds[i % 2][1]) for i in range(4000)])
    labels = labels_of(spark, [(i, 1 - i % 2, 0, 0, "") for i in range(300)])
    assert quality.train(docs, labels).exchanged > 1000


def test_text_margin_by_pairs():
    w = np.random.default_rng(2).standard_normal(quality.TEXT_BUCKETS + quality.REPETITIONS)
    for text in ("", "a", "ab", "abc", "Zürich 😀", "xyz" * 800_000):
        assert quality.text_margin(text, w, w[quality._EVERY_PAIR]) == pytest.approx(quality.text_margin(text, w))


def test_infinite_length_and_clashing_columns(spark):
    rows = [(i, t, "en", "s0", float(len(t)), "q", 1.0, "i") for i, t in ROWS]
    rows += [(800, "plain words", "en", "s0", float("inf"), "q", 2.0, "i"), (801, "plain words", None, "s0", float("nan"), "q", 2.0, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars double, q_text string, q_n_chars double, _inputs string")
    labels = labels_of(spark, [(i, 1, 0, 0, "") for i in range(0, 60, 2)] + [(100 + i, 0, 0, 0, "") for i in range(0, 60, 2)])
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and {r.q_text for r in kept.collect()} == {"q"}
    assert kept.count() == quality.quality(docs, labels).where("keep").count()
    assert len({str(quality.meta_buckets("s", "l", x)) for x in (None, 10.0, float("inf"))}) == 3


def test_exchange_equals_a_plain_loop(spark, make_docs, monkeypatch):
    """The same pseudo-labels per round as a loop over all documents in memory."""
    monkeypatch.setattr(quality, "EXCHANGE", 12)
    rng = np.random.default_rng(4)
    words = [[f"good{i}" for i in range(30)] + ["the", "of"], [f"#{i}" for i in range(30)] + ["the", "of"]]
    rows = [(i, " ".join(rng.choice(words[k], 25)), f"s{k + 2 * (rng.random() < 0.2)}") for i in range(500) for k in [int(rng.random() < 0.4)]]
    known = {i: int(t.startswith("good") or "good" in t) for i, t, _ in rows[:120]}
    recorded, real = [], quality._surest
    def surest(*a):  # noqa: E306
        out = real(*a)
        recorded.append({use: {(r.doc_id, r.y) for r in out.where(f"use = '{use}'").collect()} for use in quality.VIEWS})
        return out
    monkeypatch.setattr(quality, "_surest", surest)
    quality.train(make_docs(rows), labels_of(spark, [(i, y, 0, 0, "") for i, y in known.items()]), rounds=3)

    h = spark.range(500).selectExpr("id", "xxhash64(13, id) AS tie", "pmod(xxhash64(12, id), 3) = 0 AS held").collect()
    tie, held = {r.id: r.tie for r in h}, {r.id: r.held for r in h}
    view = {i: {"text": quality.text_view(t), "meta": quality.meta_view([(s, "en", float(len(t)))])[0]} for i, t, s in rows}
    stack = lambda ids, v: np.array([view[i][v] for i in ids]).reshape(len(ids), -1)
    start = sorted((known[i], i) for i in known if not held[i])
    taught, taken, want = {v: [] for v in quality.VIEWS}, set(), []
    for _ in range(3):
        margin = {}
        for v in quality.VIEWS:
            ids, y = [i for _, i in start] + [i for i, _ in taught[v]], [y for y, _ in start] + [y for _, y in taught[v]]
            w = quality.logistic(stack(ids, v), np.array(y, float), 1e-3)
            margin[v] = {i: float(view[i][v] @ w[:-1] + w[-1]) for i in view}
        picks = {}
        for teacher, learner in (("text", "meta"), ("meta", "text")):
            picks[learner] = set()
            for label, sign in ((1, 1), (0, -1)):
                free = [i for i in view if i not in known and i not in taken and sign * margin[teacher][i] >= np.log(0.95 / 0.05)]
                free.sort(key=lambda i: (-sign * round(margin[teacher][i], 5), tie[i], i))
                picks[learner] |= {(i, label) for i in free[:12]}
        if not any(picks.values()):
            break
        want.append(picks)
        for learner, found in picks.items():
            taught[learner] += sorted(found)
            taken |= {i for i, _ in found}
    assert len(want) >= 2 and recorded[: len(want)] == want


def test_views_are_packed_and_the_fit_fills_one_matrix():
    """A view has six bytes a place that is not zero (before: four a bucket), and the fit
    holds the learner's rows once (before: four times)."""
    texts = [f"plain words {i} and {'# ' * (i % 7)}" for i in range(1500)]
    rows = {"doc_id": list(range(1500)), "y": [i % 2 for i in range(1500)], "use": ["train", "train", "calibration", "text", "meta"] * 300}
    rows |= {"source": ["s"] * 1500, "lang": ["en"] * 1500, "n_chars": [float(len(t)) for t in texts], "text": texts}
    (batch,) = quality._views(iter([pa.RecordBatch.from_pydict(rows)]))
    assert max(len(x.as_buffer()) for x in batch["view"]) < 1000
    back = np.zeros((1500, quality.TEXT_BUCKETS + quality.REPETITIONS), np.float32)
    quality._unpacked(batch["view"], back)
    assert (back == np.array([quality.text_view(t) for t in texts], np.float32)).all()
    tracemalloc.start()
    model = pickle.loads(list(quality._trained(iter([batch])))[0]["model"][0].as_py())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    learned = [i for use in ("train", "text") for i in range(1500) if rows["use"][i] == use]
    assert peak < 3 * back[learned].nbytes
    assert (model.weights["text"] == quality.logistic(back[learned], np.array(rows["y"], float)[learned], 1e-3)).all()


def test_only_inputs_go_to_python(spark, make_docs):
    """The filter sends a text to Python once and gets a verdict back (before: all columns,
    the text twice, and all columns back)."""
    labels = labels_of(spark, [(i, 1, 0, 0, "") for i in range(60)] + [(100 + i, 0, 0, 0, "") for i in range(60)])
    kept = quality.good_documents(make_docs(ROWS), labels)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    assert {r.doc_id for r in kept.collect()} == set(range(60))
