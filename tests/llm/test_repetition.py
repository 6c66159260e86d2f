"""Repetition rules against a plain search over the words."""

import random
import re

import numpy as np
import pytest

from basketry.llm import repetition as rep

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """Counts by comparing windows of words, one by one."""
    text = text or ""
    words = WORD.findall(text)

    def inside(n):
        seen = {}
        for i in range(len(words) - n + 1):
            seen.setdefault(tuple(words[i : i + n]), []).append(i)
        return {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + n)}

    lines = [x for x in text.split("\n") if WORD.search(x)]
    chars = sum(map(len, words))
    out = {
        "n_words": len(words), "word_chars": chars, "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside(3)),
        "dup_line_chars": sum(len("".join(WORD.findall(x))) for x in lines if lines.count(x) > 1),
    }
    for n in rep.LIMITS:
        out[f"dup_chars_{n}"] = sum(len(words[j]) for j in inside(n))
    out["base_failed"] = len(words) < 50 or 100 * out["n_repeat_words"] > 50 * len(words)
    much = any(100 * out[f"dup_chars_{n}"] > limit * chars for n, limit in rep.LIMITS.items())
    out["kept"] = not (out["base_failed"] or much or 100 * out["dup_line_chars"] > rep.LINE_LIMIT * chars)
    return out


def texts():
    rng = random.Random(5)
    vocabulary = ["a", "bb", "é", "日本", "x#y", "$", "lorem", "ipsum dolor", " "]
    unique = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    out = [None, "", " \t\n\x0b\x0c\r", "one", "\n\n\n", "a a a a a a a", "x y z\nx y z\n x y z\nx y z\r\n"]
    out += [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 90))) for _ in range(60)]
    out += ["\n".join(" ".join(rng.choices(vocabulary, k=3)) for _ in range(40)) for _ in range(10)]
    out += [unique(60), unique(60) + "\n" + unique(8), "\n".join([unique(20)] * 2 + [unique(60)])]
    passage = unique(12)
    out += [f"{passage} {unique(90)} {passage}", f"{passage} {unique(20)} {passage} {unique(10)} {passage}"]
    return out


def test_equals_plain_search(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(texts())]
    got = {r.doc_id: r.asDict() for r in rep.repetition_rules(make_docs(rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i] == {"doc_id": i} | plain(t), repr(t)
    assert any(r["kept"] for r in got.values()) and any(not r["kept"] and not r["base_failed"] for r in got.values())


def test_very_long_text(spark, make_docs):
    rng = np.random.default_rng(1)
    text = " ".join(map(str, rng.integers(0, 10**12, 300_000)))
    got = rep.repetition_rules(make_docs([(1, text), (2, text + " " + text), (3, "word " * 200_000)])).orderBy("doc_id").collect()
    assert [r.n_words for r in got] == [300_000, 600_000, 200_000]
    assert [r.n_repeat_words for r in got] == [0, 600_000, 200_000]
    assert [r.kept for r in got] == [True, False, False]


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_colliding_hashes_are_told_apart(monkeypatch, bits):
    """With a hash of few bits every window collides with others, the result stays."""
    monkeypatch.setattr(rep, "scattered", lambda numbers: numbers.astype(np.uint64) & np.uint64((1 << bits) - 1))
    monkeypatch.setattr(rep, "_MULTIPLIER", np.uint64(1))
    for t in texts():
        found = rep.measure((t or "").encode(), tuple(rep.LIMITS))
        want = plain(t)
        assert found[4] == want["n_repeat_words"] and found[6:] == [want[f"dup_chars_{n}"] for n in rep.LIMITS]


def test_repeated_rows_null_ids_empty_table(spark, make_docs):
    rows = [(1, "a b c a b c"), (1, "a b c a b c"), (None, "a")]
    got = rep.repetition_rules(make_docs(rows)).collect()
    assert sorted((r.doc_id is None, r.n_repeat_words) for r in got) == [(False, 6), (False, 6), (True, 0)]
    assert rep.repetition_rules(make_docs([])).count() == 0
