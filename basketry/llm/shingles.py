"""Hashes of words and word shingles, vectorised over whole batches of texts."""

from __future__ import annotations

import numpy as np

# words are runs of bytes other than ASCII white space
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# odd 64-bit constants for polynomial hashes modulo 2**64
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1342543DE82EF95)
_CHUNK = 1 << 20
_SPACES = b" "


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, _CHUNK)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _CHUNK)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in ``raw`` (bytes), A-Z lower-cased, and the
    position where each word starts.

    Polynomial prefix sums give every word's hash without a loop over words; a
    word longer than a chunk is hashed piece by piece.
    """
    found, starts_ = [], []
    at = 0
    while at < len(raw):
        part = raw[at : at + _CHUNK]
        last = at + len(part) >= len(raw)
        space = _IS_SPACE[part]
        if not last:  # end the chunk where a word ends
            ends = np.flatnonzero(space)
            if len(ends) == 0:
                word, end = _long_word(raw, at)
                found.append(np.array([word], np.uint64))
                starts_.append(np.array([at], np.int64))
                at = end
                continue
            part, space = part[: ends[-1] + 1], space[: ends[-1] + 1]
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if len(starts):
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum((_LOWER[part].astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
            found.append(mix((sums[ends] - sums[starts]) * _DOWN[starts]))
            starts_.append(starts + at)
        at += len(part)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(starts_)


def _long_word(raw: np.ndarray, at: int) -> tuple[int, int]:
    """Hash and end of the word that starts at ``at`` and fills at least a chunk."""
    total, power = 0, 1
    while at < len(raw):
        part = raw[at : at + _CHUNK]
        ends = np.flatnonzero(_IS_SPACE[part])
        part = part[: ends[0]] if len(ends) else part
        piece = int(np.sum((_LOWER[part].astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], dtype=np.uint64))
        total = (total + piece * power) % (1 << 64)
        power = power * pow(_BASE, len(part), 1 << 64) % (1 << 64)
        at += len(part)
        if len(ends):
            break
    return int(mix(np.array([total], np.uint64))[0]), at


def shingle_hashes(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles of the texts (with repeats), in text
    order, and the index of each one's text. A text with fewer words gives its
    whole word sequence as one shingle, a text without words none.
    """
    raw = np.frombuffer(_SPACES.join(texts), np.uint8)
    words, at = word_hashes(raw)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.empty(0, np.int64)
    doc = np.searchsorted(begins, at, side="right") - 1
    counts = np.bincount(doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)

    n = max(0, len(words) - width + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled = rolled * _STEP + words[k : k + n]
    whole = doc[:n] == doc[width - 1 :] if n else np.empty(0, bool)
    hashes, owner = mix(rolled[whole]), doc[:n][whole]

    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = []
        for i in short:
            h = 0
            for w in words[first[i] : first[i] + counts[i]]:
                h = (h * int(_STEP) + int(w)) % (1 << 64)
            # the length keeps a short sequence apart from a shingle
            extra.append((h + int(counts[i]) * _BASE) % (1 << 64))
        hashes = np.concatenate([hashes, mix(np.array(extra, np.uint64))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    return hashes, owner
