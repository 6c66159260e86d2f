"""Repetition rules: how much of a text lies inside its repeated n-grams and lines.

Each text is judged on its own, inside the task that reads it: nothing is
shuffled. Its words become numbers, a rolling hash over them gives the hash of
every window of n words from that of n - 1, and windows with equal hashes are
compared word by word before they count as repeated. A window of n + 1 words can
only be repeated where one of n words is, so each length looks at what the
shorter one left. Overlapping windows cover a word once.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import ship_package

#: words in a window -> percent of the characters that repeated windows may cover;
#: twice the published limits, as the first occurrence is counted here
LIMITS = {5: 30, 6: 28, 7: 26, 8: 24, 9: 22, 10: 20}
#: percent of the characters that lines found twice or more may hold
LINE_LIMIT = 40
#: texts of fewer words, or with a larger percent of words in repeated windows of ``BASE_N`` words, fail
MIN_WORDS, MAX_REPEAT, BASE_N = 50, 50, 3
# fixed values
SYMBOLS = b"#*$%&|<>"
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_CONTINUATION = bytes(range(0x80, 0xC0))

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def code_points(raw: bytes) -> int:
    return len(raw.translate(None, _CONTINUATION))


def word_numbers(words: list[bytes]) -> np.ndarray:
    """The same number for the same word, different ones for different words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def scattered(numbers: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits, the letters of the rolling hash."""
    x = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def repeated_windows(numbers: np.ndarray, hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Those of ``starts`` whose window of ``n`` words occurs twice or more."""
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    if not len(same):
        return starts[:0]
    a, b = starts[order[same]], starts[order[same + 1]]
    equal = np.ones(len(a), bool)
    for j in range(n):
        equal &= numbers[a + j] == numbers[b + j]
    if not equal.all():  # different windows share a hash: group the windows themselves
        windows = np.lib.stride_tricks.sliding_window_view(numbers, n)[starts]
        _, which, times = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        return starts[times[which.ravel()] > 1]
    return np.unique(np.concatenate([a, b]))


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie inside a window of ``n`` words that starts at ``starts``."""
    change = np.zeros(size + 1, np.int64)
    change[starts] += 1
    change[starts + n] -= 1
    return np.cumsum(change[:-1]) > 0


def repeat_coverage(numbers: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """For each length the words inside windows of so many words found twice or more."""
    found = {n: np.zeros(len(numbers), bool) for n in lengths}
    letters = scattered(numbers)
    hashes = letters.copy()
    starts = np.arange(len(numbers))
    for n in range(1, max(lengths, default=0) + 1):
        if n > 1:
            starts = starts[starts + n <= len(numbers)]
            hashes = hashes[: len(numbers) - n + 1] * _MULTIPLIER + letters[n - 1 :]
        if n >= min(lengths):
            starts = repeated_windows(numbers, hashes[starts], starts, n)
            if not len(starts):
                break
            if n in found:
                found[n] = covered(starts, n, len(numbers))
    return found


def line_repeats(raw: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters in words
    of all lines with a word that occur twice or more."""
    times: dict[bytes, int] = {}
    for line in raw.split(b"\n"):
        times[line] = times.get(line, 0) + 1
    repeats = chars = 0
    for line, n in times.items():
        if n > 1 and (inside := line.translate(None, _SPACE)):
            repeats += n - 1
            chars += n * code_points(inside)
    return repeats, chars


def measure(raw: bytes, lengths: tuple[int, ...]) -> list[int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars``
    and the characters covered for each of ``lengths``."""
    words = raw.split()  # bytes split at exactly the six characters of _SPACE
    numbers = word_numbers(words)
    size = np.fromiter(map(len if raw.isascii() else code_points, words), np.int64, len(words))
    cover = repeat_coverage(numbers, tuple({BASE_N, *lengths}))
    dup_lines, line_chars = line_repeats(raw)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    base = [len(words), int(size.sum()), symbols, dup_lines, int(cover[BASE_N].sum()), line_chars]
    return base + [int(size[cover[n]].sum()) for n in lengths]


def _measure(lengths: tuple[int, ...], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t.as_buffer().to_pybytes() if t.is_valid else b"", lengths) for t in b.column(1)]
            found = np.array(rows, np.int64).reshape(len(rows), len(names))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in found.T)], names=["doc_id", *names])

    return run


def repetition_rules(docs: DataFrame, limits: Mapping[int, int] = LIMITS, line_limit: int = LINE_LIMIT) -> DataFrame:
    """One row per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, dup_line_chars`` and ``dup_chars_<n>`` for
    each length of ``limits``.

    A word is a run of anything but the six ASCII space characters. Characters
    are code points in words. A repeated window counts in full, its first
    occurrence included. ``kept`` is false if the base rules fail, if repeated
    lines hold more than ``line_limit`` percent of the characters, or if the
    repeated windows of some length cover more than its percent.

    A null or empty text has no words, all counts are 0 and it fails. Repeated
    rows are judged each on their own, null ids stay null, an empty table gives an
    empty result; of other columns none is read. A text is held in memory whole,
    with some 30 times its bytes at most; its cost grows as its length times the
    logarithm of it.
    """
    ship_package(docs.sparkSession)
    lengths = tuple(sorted(limits))
    dup = {n: f"dup_chars_{n}" for n in lengths}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *dup.values()]
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names)
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_measure(lengths, names), schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    bad = 100 * F.col("dup_line_chars") > line_limit * F.col("word_chars")
    for n, c in dup.items():
        bad |= 100 * F.col(c) > limits[n] * F.col("word_chars")
    found = found.withColumns({"base_failed": failed, "kept": ~failed & ~bad})
    return found.select("doc_id", *names[:5], "base_failed", "kept", "dup_line_chars", *dup.values())
