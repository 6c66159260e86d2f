"""License scan against a plain search over the words."""

import re
import time

import duckdb

from basketry.llm import catalog, licenses

RUN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return RUN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w, hits = words(text), []
    for label, phrase in licenses.PHRASES:
        p = phrase.split()
        hits += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


GPL = dict(licenses.TEMPLATES)["gpl"]
MIT = dict(licenses.TEMPLATES)["mit-text"]
ROWS = [
    (1, "Licensed under the MIT License."), (2, "under the mit. LICENSE under the\nmit license!"), (3, "CC BY-NC 4.0 and cc by nc"),
    (4, "Apache License, Version 2.0 / apache license version 2"), (5, None), (6, ""), (7, "under the mit"), (8, "mit license under the"),
    (9, "é under the MIT license ü"), (10, GPL), (11, MIT.replace("free of charge", "for free, of any charge,")), (12, "x " * 40_000 + MIT + " y"),
    (13, " ".join(GPL.split()[:4])), (14, "\u0130 cc by nc"), (9, "é under the MIT license ü"), (None, "cc by nc"), (15, "under the mit license under the mit license"),
]


def test_base_matches_brute_force(make_docs):
    got = licenses.license_scan(make_docs(ROWS)).collect()
    key = lambda x: str(x)
    want = [(i, *base(t)) for i, t in ROWS]
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(want, key=key)


def test_similar_templates(make_docs):
    got = {r.doc_id: r for r in licenses.license_scan(make_docs(ROWS)).collect()}
    assert got[10].labels == "gpl" and got[10].score == 1.0
    assert got[11].labels == "mit-text" and 0.75 <= got[11].score < 1
    assert got[12].labels == "mit-text"
    assert got[13].labels == "" and got[13].score == 0
    assert got[4].labels.split(",")[0] == "apache-2"
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got.values())


def test_spans_merge_neighbouring_diagonals(make_docs):
    w = MIT.split()
    text = "a b c " + " ".join(w[:9] + ["inserted"] + w[9:])
    spans = licenses.spans(licenses.votes(make_docs([(1, text)]))).collect()
    assert [(s.label, s.first, s.last) for s in spans] == [("mit-text", 3, 3 + len(w))]


def test_no_python_in_the_plan_and_empty(make_docs):
    df = licenses.license_scan(make_docs([]))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(new[-1], row[j + 1], row[j] + (x == y)))
        row = new
    return row[-1]


def edited_rows():
    """Copies with one word replaced or removed anywhere or a shortened lead, and the label each must get."""
    rows, want = [], []
    for label, text in licenses.TEMPLATES:
        w = text.split()
        edits = [w[:i] + ["changed"] + w[i + 1 :] for i in range(len(w))] + [w[:i] + w[i + 1 :] for i in range(len(w))]
        edits += [w[n:] for n in range(1, len(w) // 4 + 1)]
        rows += [(len(rows) + i, f"x y {' '.join(e)} z") for i, e in enumerate(edits)]
        want += [label] * len(edits)
    named = [
        ("gpl", "Licensed under the GNU General Public License, version 3"), ("gpl", "This work is released under the GNU General Public License version 3"),
        ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 3.0 International License"),
        ("cc-by-sa", "licensed under a Creative Commons Attribution share alike 4.0 International License"), ("", "this work is licensed to the public"),
    ]
    rows += [(len(rows) + i, t) for i, (_, t) in enumerate(named)]
    rows += [(None, named[1][1]), rows[-1]]
    want += [label for label, _ in named] + ["gpl", ""]
    return rows, want


def test_edited_copies(make_docs):
    """One word replaced or removed anywhere, or a shortened lead: still a copy."""
    rows, want = edited_rows()
    text = dict(rows)
    got = licenses.license_scan(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        label = want[len(rows) - 2 if r.doc_id is None else r.doc_id]
        assert label in r.labels.split(","), text[r.doc_id]
        if label and 0 < r.score < 1:
            template = dict(licenses.TEMPLATES)[label].split()
            assert 0.75 <= r.score <= lcs(words(text[r.doc_id]), template) / len(template)


def test_edited_copies_against_the_sql(make_docs):
    rows = [(i, t) for i, t in edited_rows()[0] if i is not None]
    rows = list(dict(rows).items()) + [(900 + i, t) for i, t in ROWS if i is not None and i != 9]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "round(score, 9)"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalog._license_sql()}) ORDER BY doc_id").fetchall()
    got = licenses.license_scan(make_docs(rows)).selectExpr(*columns).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want
    assert sum(0.75 <= r[-1] < 1 for r in want) > 100


def test_many_weak_diagonals_take_time_as_the_text(make_docs):
    """Phrases of a template that stand alone, thousands of them in one text."""

    def seconds(n):
        docs = make_docs([(1, " ".join(f"in compliance with the license word{i}" for i in range(n)))], 1)
        started = time.perf_counter()
        (row,) = licenses.license_scan(docs).collect()
        assert row.labels == "" and row.n_words == 6 * n
        return time.perf_counter() - started

    seconds(10)
    short, long_ = seconds(1500), seconds(9000)
    assert long_ < 6 * short + 5 and long_ < 40


def test_texts_are_matched_once(spark):
    """A row is read for its k-grams, for its weak spans and for its number of words: once each."""
    reads = spark.sparkContext.accumulator(0)

    def read(row):
        reads.add(1)
        return row

    rows = [(i, text) for i, (_, text) in enumerate(ROWS)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(read), "doc_id long, text string")
    got = licenses.license_scan(docs).collect()
    assert sorted((r.doc_id, r.n_base) for r in got) == [(i, base(t)[1]) for i, t in rows]
    assert reads.value <= 3 * len(rows)
    # and split into words once for its k-grams
    assert licenses.votes(docs)._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
