"""N-gram Jaccard join: documents linked by 5-word shingle sets with a Jaccard
similarity of at least 0.75, as classes (connected components) of documents.

The join is the rare-first prefix join, arranged so that neither texts nor full
shingle sets of documents without a partner ever meet:

1. *Document frequencies.* Each text becomes its set of shingle hashes. They are
   dealt out by hash as sorted, delta-coded blocks; each task counts in how many
   documents each shingle stands and answers every block with the shingles that
   stand in at least two. Texts are handled in groups of about 4 MB: a shingle
   of several documents of a group is dealt once, with its count, so a shingle
   that stands in every document is one entry a group. Documents with the same
   set in one partition are dealt once.
2. *Rare first.* Ordered by frequency, shingles of one document only come first.
   They cannot be shared, so a document with more than a quarter of them can link
   with nothing and is done. Of the others, equal sets become one node.
3. *Prefixes.* A node's first n - ceil(0.75 n) + 1 shingles are its prefix; of a
   linked pair the smaller node even shares one of its first n - ceil(6/7 n) + 1.
   Only the prefix's shared shingles are dealt out, to lists by shingle.
4. *Star rounds.* In each list, every node is paired with the most typical node of
   like size (fewest shingles of its own), and each node is verified against the
   one it met most often. This joins a group of many near copies with one pair a
   member instead of all its pairs. In the first round lists are cut down within
   each batch of nodes: members vote there, and only the typical node goes on.
   Later rounds do the same between components, with one node of each component
   from a batch, as long as a round finds links for more than ``ROUND_SHARE`` of
   the nodes.
5. *Complete round.* All pairs of nodes in *different* components that share a
   list, pass the length and positional filters, are verified once per pair, with
   a suffix filter (counts per hash range) before the sets are intersected. Links
   within a component would change nothing. A list that may be longer than
   ``2 ** LIST_ROWS_LOG2`` is split: its members are dealt to parts, and every two parts meet
   in a cell of their own, so no task holds the whole list.

Shingles are compared by 64-bit hashes inside a document and 48-bit hashes
between documents; the chance of a false match between two documents of a
thousand shingles is below 1e-8.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialise, ship_package, small, text_or_empty
from basketry.llm.components import components, link_tasks
from basketry.llm.shingles import mix, shingle_hashes

WIDTH = 5
# texts are hashed in groups of about so many bytes
GROUP_BYTES = 4 << 20
# bytes of text per block of hashes; the number of blocks follows the input
BLOCK_BYTES = 8 << 20
MIN_BLOCKS = 64
#: bytes of text a task takes, at least (and the fewest tasks): beyond the first pass the rows are
#: small, and with one task a shuffle partition the driver would keep the books of many tiny tasks
TASK_BYTES = 4 << 20
MIN_TASKS = 8
#: another star round follows one that found links for more than this share of the nodes
ROUND_SHARE = 0.05
#: lists of shingles that stand in more documents are split (log2)
LIST_ROWS_LOG2 = 15
_HASH_BITS = 48
_MANY = 0xFFFFFFFF
_NO_ID = np.iinfo(np.int64).max


def least_overlap(n_a, n_b):
    """Shingles that sets of these sizes must share: 100 i >= 75 (n_a + n_b - i)."""
    return (3 * (n_a + n_b) + 6) // 7


def _prefix(n):
    """Prefix length for partners of any size."""
    return n - (3 * n + 3) // 4 + 1


def _short_prefix(n):
    """Prefix length for partners at least as large."""
    return n - (6 * n + 6) // 7 + 1


def _pack(values: np.ndarray, width: int) -> bytes:
    """Unsigned integers below 256 ** width as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)), 6)


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, 6), dtype=np.uint64)


def _bounds(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys."""
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.empty(0, np.int64)
    return starts, np.r_[starts[1:], len(sorted_keys)].astype(np.int64) if len(starts) else starts


# -- 1. document frequencies

_BLOCK = "block int, base long, hashes binary, refs binary, counts binary, docs binary"


def _deal(bits: int):
    """Texts -> blocks of (hash, document) by hash range, and one row of document facts a group."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        seen: dict[tuple, int] = {}
        for b in batches:
            ids = b.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            versions = b.column(2).to_numpy(zero_copy_only=False)
            texts, size, at = [], 0, 0
            for i, text in enumerate(b.column(1)):
                texts.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                size += len(texts[-1])
                if size >= GROUP_BYTES or i == len(ids) - 1:
                    yield _group(texts, np.stack([ids[at : i + 1], versions[at : i + 1]]), base, bits, seen)
                    base += len(texts)
                    texts, size, at = [], 0, i + 1

    return deal


def _group(texts: list[bytes], ids: np.ndarray, base: int, bits: int, seen: dict) -> pa.RecordBatch:
    hashes, owner = shingle_hashes(texts, WIDTH)
    order = np.argsort(hashes, kind="stable")
    h, o = hashes[order], owner[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])] if len(h) else np.empty(0, bool)
    n = np.bincount(o[new], minlength=len(texts))
    # a set's identity: two sums over its shingles
    member = np.zeros(len(h), bool)
    member[order[new]] = True
    sums = np.zeros((2, len(texts)), np.uint64)
    starts, _ = _bounds(owner)
    for k in range(2) if len(starts) else ():
        values = np.where(member, mix(hashes + np.uint64(k + 1)), np.uint64(0))
        sums[k, owner[starts]] = np.add.reduceat(values, starts)
    first = np.array([seen.setdefault((a, c, m), base + i) for i, (a, c, m) in enumerate(zip(*sums.tolist(), n.tolist()))], np.int64)
    dealt = new & (first == base + np.arange(len(texts)))[o] if len(h) else new
    h, o = h[dealt] >> np.uint64(64 - _HASH_BITS), o[dealt].astype(np.uint64)
    new = np.r_[True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])] if len(h) else np.empty(0, bool)
    h, o = h[new], o[new]
    # one entry a shingle: with its document, or with the count of several
    starts, ends = _bounds(h)
    counts = (ends - starts).astype(np.uint64)
    many = np.repeat(counts > 1, ends - starts)
    once, refs = h[starts], np.where(counts > 1, np.uint64(_MANY), o[starts] if len(starts) else o)
    block = (once >> np.uint64(_HASH_BITS - bits)).astype(np.int64)
    rows = [
        (int(block[a]), base, _pack_sorted(once[a:e]), _pack(refs[a:e], 4), _pack(counts[a:e], 4), None)
        for a, e in zip(*_bounds(block))
    ]
    # the documents of shared shingles wait for the answers, with the group's facts
    facts = np.stack([*ids.astype(np.int64), n.astype(np.int64), *sums.view(np.int64), first])
    # a group's facts go through the grouping under a key of their own
    rows.append((-1 - zlib.crc32(base.to_bytes(8, "little")) % (1 << 31), base, _pack_sorted(h[many]), _pack(o[many], 4), None, facts.tobytes()))
    types = {"block": pa.int32(), "base": pa.int64(), "hashes": pa.binary(), "refs": pa.binary(), "counts": pa.binary(), "docs": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], names=list(types))


_SHARED = "base long, hashes binary, refs binary, counts binary, docs binary"


def _shared(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One block of hashes from all groups -> per group, those in two documents or more."""
    if key[0] < 0:  # facts pass through
        return rows[["base", "hashes", "refs", "counts", "docs"]]
    hashes = [_unpack_sorted(x) for x in rows["hashes"]]
    refs = np.concatenate([_unpack(x, 4) for x in rows["refs"]])
    counts = np.concatenate([_unpack(x, 4) for x in rows["counts"]])
    ends_of = np.cumsum([len(x) for x in hashes])
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    starts, ends = _bounds(hashes[order])
    total = np.empty(len(hashes), np.uint64)
    total[order] = np.repeat(np.add.reduceat(counts[order], starts), ends - starts)
    out = []
    for base, a, e in zip(rows["base"], np.r_[0, ends_of[:-1]], ends_of):
        take = np.flatnonzero(total[a:e] > 1) + a
        if len(take):
            out.append((base, _pack_sorted(hashes[take]), _pack(refs[take], 4), _pack(total[take], 5), None))
    return pd.DataFrame(out, columns=["base", "hashes", "refs", "counts", "docs"])


# -- 2. rare first

_DOCS = "uid long, doc_id long, version long, n int, fp1 long, fp2 long, m int, tokens binary"
# a token: six bytes of hash, one of the frequency's order (log2, rounded up)
_TOKEN = 7


def _rare_first(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A group's answers -> its documents; ``tokens`` (only of documents that can
    link) are the shared shingles, rarest first."""
    own = rows[rows["docs"].notna()].iloc[0]
    ids, version, n, fp1, fp2, first = np.frombuffer(own["docs"], np.int64).reshape(6, -1)
    answers = rows[rows["docs"].isna()]
    m = np.zeros(len(ids), np.int64)
    tokens: list = [None] * len(ids)
    if len(answers):
        hashes = np.concatenate([_unpack_sorted(x) for x in answers["hashes"]])
        refs = np.concatenate([_unpack(x, 4) for x in answers["refs"]])
        counts = np.concatenate([_unpack(x, 5) for x in answers["counts"]])
        # shingles of several documents of the group: the answer goes to each
        several = refs == _MANY
        order = np.argsort(hashes[several], kind="stable")
        answer, total = hashes[several][order], counts[several][order]
        waiting = _unpack_sorted(own["hashes"])
        hashes = np.concatenate([hashes[~several], waiting])
        refs = np.concatenate([refs[~several], _unpack(own["refs"], 4)]).astype(np.int64)
        counts = np.concatenate([counts[~several], total[np.searchsorted(answer, waiting)]])
        m = np.bincount(refs, minlength=len(ids))
        take = (4 * m >= 3 * n)[refs]
        hashes, refs, counts = hashes[take], refs[take], counts[take]
        order = np.lexsort((hashes, counts, refs))
        hashes, refs, counts = hashes[order], refs[order], counts[order]
        raw = np.empty((len(hashes), _TOKEN), np.uint8)
        raw[:, :6] = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        raw[:, 6] = np.ceil(np.log2(counts))
        for a, e in zip(*_bounds(refs)):
            tokens[int(refs[a])] = raw[a:e].tobytes()
    uid = key[0] + np.arange(len(ids))
    return pd.DataFrame({
        "uid": uid, "doc_id": pd.array([None if x == _NO_ID else x for x in ids.tolist()], "Int64"), "version": version, "n": n.astype(np.int32), "fp1": fp1, "fp2": fp2,
        "m": m.astype(np.int32), "tokens": [t if f == u and c else None for t, f, u, c in zip(tokens, first, uid, n)],
    })


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def text_tasks(total: int) -> int:
    """Most tasks of a stage over the sets of so many bytes of text."""
    return max(MIN_TASKS, -(-total // TASK_BYTES))


def shingle_sets(docs: DataFrame, total: int | None = None) -> DataFrame:
    """``uid, doc_id, version, n, fp1, fp2, m, tokens`` per document, written to
    the shared folder: a hash of the text, set size, set identity, how many
    shingles other documents share. ``total``: bytes of all texts, if known."""
    ship_package(docs.sparkSession)
    total = text_bytes(docs) if total is None else total
    tasks = text_tasks(total)
    bits = max(MIN_BLOCKS - 1, total // BLOCK_BYTES).bit_length()
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(text_or_empty()))
    dealt = rows.mapInArrow(_deal(bits), _BLOCK)
    shared = dealt.groupBy("block").applyInPandas(_shared, _SHARED).coalesce(tasks)
    return materialise(shared.groupBy("base").applyInPandas(_rare_first, _DOCS).coalesce(tasks))


# -- 3. prefixes


def _tokens(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and orders of frequency."""
    rows = np.frombuffer(raw, np.uint8).reshape(-1, _TOKEN)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :6] = rows[:, :6]
    return out.view("<u8").ravel(), rows[:, 6]


# ``at`` is the shingle's place in the whole set, rarest first; ``own`` counts
# shingles no one shares; ``scale`` is the order of the shingle's frequency
_ENTRY = np.dtype([("hash", "<u8"), ("uid", "<i8"), ("component", "<i8"), ("n", "<i4"), ("at", "<i4"), ("own", "<i4"), ("scale", "<i4")])
_LISTS = "block int, cell int, entries binary"


def _prefix_entries(batch: pa.RecordBatch) -> np.ndarray:
    parts = [np.empty(0, _ENTRY)]
    for uid, component, n, m, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
        hashes, scales = _tokens(raw)
        part = np.empty(len(hashes), _ENTRY)
        part["hash"], part["uid"], part["component"], part["n"], part["own"] = hashes, uid, component, n, n - m
        part["at"], part["scale"] = n - m + np.arange(len(hashes)), scales
        parts.append(part)
    return np.concatenate(parts)


def _dealt(entries: np.ndarray, cell: np.ndarray, bits: int) -> list[tuple]:
    """(block, cell, entries) rows of entries dealt by hash range."""
    order = np.lexsort((entries["hash"], cell))
    entries, cell = entries[order], cell[order]
    block = (entries["hash"] >> np.uint64(_HASH_BITS - bits)).astype(np.int64)
    return [(int(block[a]), int(cell[a]), entries[a:e].tobytes()) for a, e in zip(*_bounds(cell << np.int64(32) | block))]


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    block, cell, raw = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(cell, pa.int32()), pa.array(raw, pa.binary())], names=["block", "cell", "entries"])


def _lists_for_stars(bits: int, homes: int):
    """Nodes -> votes within the batch (block -1 - home), and the typical nodes' entries."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            typical, votes = _stars(_prefix_entries(b), homes)
            rows = [(-1 - home, 0, raw) for home, raw in votes]
            yield _as_batch(rows + _dealt(typical, np.zeros(len(typical), np.int64), bits))

    return deal


def _lists_for_components(bits: int):
    """Nodes -> per list, class of sizes and component the most typical node's entry."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = _prefix_entries(b)
            e, starts = _by_list(e, e["component"])
            yield _as_batch(_dealt(e[starts], np.zeros(len(starts), np.int64), bits))

    return deal


def _lists_for_pairs(bits: int):
    """Nodes -> entries; those of long lists to every cell their part meets others in."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = _prefix_entries(b)
            # a list of up to 2 ** scale members has that many parts over the bound
            parts = np.int64(1) << np.maximum(e["scale"].astype(np.int64) - LIST_ROWS_LOG2, 0)
            mine = (mix(e["uid"].astype(np.uint64)) >> np.uint64(8)).astype(np.int64) & (parts - 1)
            which = np.repeat(np.arange(len(e)), parts)
            other = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
            low, high = np.minimum(mine[which], other), np.maximum(mine[which], other)
            yield _as_batch(_dealt(e[which], high * (high + 1) // 2 + low, bits))

    return deal


def _prefixes(nodes: DataFrame) -> DataFrame:
    """``uid, component, n, m, tokens`` with the tokens cut to the prefix."""
    n = F.col("n")
    keep = n - F.floor((3 * n + 3) / 4) + 1 - (n - F.col("m"))
    cut = nodes.withColumn("keep", keep.cast("int")).where("keep > 0")
    return cut.select("uid", "component", "n", "m", F.substring("tokens", F.lit(1), F.col("keep") * _TOKEN).alias("tokens"))


def _entries(rows: pd.DataFrame) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, _ENTRY) for x in rows["entries"]])


# -- 4. star rounds


def _by_list(e: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries by list and class of sizes (and ``more``), the most typical first,
    and where each such group starts."""
    # sizes within a class differ by less than a third
    size = np.floor(np.log(e["n"]) / np.log(4 / 3)).astype(np.int64)
    keys = (*more, size, e["hash"])
    order = np.lexsort((e["uid"], e["own"] / e["n"], *keys))
    changed = np.zeros(max(len(e) - 1, 0), bool)
    for k in keys:
        changed |= k[order][1:] != k[order][:-1]
    return e[order], np.flatnonzero(np.r_[True, changed]) if len(e) else np.empty(0, np.int64)


def _stars(e: np.ndarray, homes: int) -> tuple[np.ndarray, list[tuple[int, bytes]]]:
    """In each list and class of sizes, every node votes for the most typical one
    if that is of another component: the typical nodes' entries, and (home, votes)
    with each vote's count."""
    e, starts = _by_list(e)
    runs = np.diff(np.r_[starts, len(e)])
    lead, side = np.repeat(e["uid"][starts], runs), np.repeat(e["component"][starts], runs)
    pairs = np.stack([e["uid"], lead])[:, e["component"] != side]
    if not pairs.size:
        return e[starts], []
    pairs, n = np.unique(pairs, axis=1, return_counts=True)
    home = (mix(pairs[0].astype(np.uint64)) % np.uint64(homes)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    table, home = np.vstack([pairs, n])[:, order], home[order]
    return e[starts], [(int(home[a]), np.ascontiguousarray(table[:, a:z]).tobytes()) for a, z in zip(*_bounds(home))]


def _votes(homes: int):
    def votes(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:  # votes of a batch pass through
            out = [(-1 - key[0], raw) for raw in rows["entries"]]
        else:
            out = _stars(_entries(rows), homes)[1]
        return pd.DataFrame(out, columns=["home", "votes"]).astype({"home": "int32"})

    return votes


def _most_met(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Per node, the typical node it met in most lists."""
    a, b, n = np.concatenate([np.frombuffer(x, np.int64).reshape(3, -1) for x in rows["votes"]], axis=1)
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    a, b, n = a[starts], b[starts], np.add.reduceat(n, starts)
    order = np.lexsort((b, -n, a))
    a, b = a[order], b[order]
    starts, _ = _bounds(a)
    return pd.DataFrame({"a": a[starts], "b": b[starts]})


# -- 5. complete round


def _across(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of different components in one list that pass the length and
    positional filters, once per block."""
    e = _entries(rows)
    e = e[np.argsort(e["hash"], kind="stable")]
    found = []
    for a, z in zip(*_bounds(e["hash"])):
        run = e[a:z]
        names, counts = np.unique(run["component"], return_counts=True)
        if len(names) < 2:
            continue
        # every such pair has a node outside the largest component
        outside = run[run["component"] != names[np.argmax(counts)]]
        step = max(1, (1 << 22) // len(run))
        for i in range(0, len(outside), step):
            x, y = outside[i : i + step, None], run[None, :]
            small_, large = np.minimum(x["n"], y["n"]), np.maximum(x["n"], y["n"])
            # the smaller node's place must lie in its short prefix
            at_small = np.where(x["n"] < y["n"], x["at"], np.where(x["n"] > y["n"], y["at"], np.minimum(x["at"], y["at"])))
            most = np.minimum(x["n"] - x["at"], y["n"] - y["at"])
            good = (x["component"] != y["component"]) & (4 * small_ >= 3 * large)
            good &= (at_small < _short_prefix(small_)) & (most >= least_overlap(x["n"], y["n"]))
            r, c = np.nonzero(good)
            if len(r):
                u, v = outside["uid"][i + r], run["uid"][c]
                found.append(np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1))
    if not found:
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    a, b = np.unique(np.concatenate(found, axis=1), axis=1)
    return pd.DataFrame({"a": a, "b": b})


_RANGES = 64


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both sets -> the linked ones."""
    for batch in batches:
        keep = []
        for n_a, n_b, raw_a, raw_b in zip(*(batch.column(i) for i in range(2, 6))):
            need = least_overlap(n_a.as_py(), n_b.as_py())
            a, b = _tokens(raw_a.as_buffer())[0], _tokens(raw_b.as_buffer())[0]
            # suffix filter: per hash range, no more can be shared than the smaller count
            shift = np.uint64(_HASH_BITS - 6)
            counts = [np.bincount((x >> shift).astype(np.int64), minlength=_RANGES) for x in (a, b)]
            most = int(np.minimum(*counts).sum())
            keep.append(most >= need and len(np.intersect1d(a, b, assume_unique=True)) >= need)
        if any(keep):
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def verified(pairs: DataFrame, nodes: DataFrame, tasks: int | None = None) -> DataFrame:
    """The pairs ``a, b`` that are links, written to the shared folder (by at most ``tasks`` tasks)."""
    side = lambda s: nodes.select(F.col("uid").alias(s), F.col("n").alias(f"n_{s}"), F.col("tokens").alias(f"tokens_{s}"))
    by = lambda df: df.coalesce(tasks) if tasks else df
    both = by(by(pairs.join(side("a"), "a")).join(side("b"), "b"))
    return materialise(both.select("a", "b", "n_a", "n_b", "tokens_a", "tokens_b").mapInArrow(_linked, "a long, b long"))


def near_duplicates(docs: DataFrame, total: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, version``.

    Words are runs of anything but ASCII white space in the text with A-Z
    lower-cased. A set with fewer than five words is the whole word sequence; a
    null, empty or blank text has none and links with nothing, not even its
    copies (``component_id`` is its own id). ``component_id`` is the smallest id
    reachable over links; null ids take part and never name a component unless
    all its ids are null. ``version`` is a hash of the text. Repeated rows are
    documents of their own that link with each other. An empty table gives an
    empty result; other columns are not read. A text of any length is shingled
    whole, in one task, with some 30 times its bytes in memory. ``total``: bytes
    of all texts, if known.
    """
    total = text_bytes(docs) if total is None else total
    tasks = text_tasks(total)
    sets = shingle_sets(docs, total)
    key = ["fp1", "fp2", "n"]
    classes = materialise(
        sets.where("n > 0").groupBy(*key).agg(F.min("uid").alias("node"), F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")).coalesce(tasks)
    )
    able = sets.where("tokens is not null")
    again = able.select("uid", *key).join(classes.where("copies > 1").select(*key, "node"), key).where("uid <> node").select("uid")
    again = materialise(again.coalesce(tasks))
    nodes = able.join(small(again), "uid", "left_anti").select("uid", "n", "m", "tokens")
    # lists are short: blocks by the number of nodes
    count = nodes.count()
    bits = max(MIN_BLOCKS - 1, count // 4000).bit_length()
    homes = max(MIN_BLOCKS, count // 50_000)

    def met(named: DataFrame, deal) -> DataFrame:
        lists = _prefixes(named).mapInArrow(deal, _LISTS)
        votes = lists.groupBy("block").applyInPandas(_votes(homes), "home int, votes binary").coalesce(tasks)
        return votes.groupBy("home").applyInPandas(_most_met, "a long, b long").coalesce(tasks)

    def named_by(joined: DataFrame) -> DataFrame:
        labels = small(joined.select(F.col("node").alias("uid"), F.col("component").alias("found")))
        return nodes.join(labels, "uid", "left").withColumn("component", F.coalesce("found", "uid")).drop("found").coalesce(tasks)

    links = verified(met(nodes.withColumn("component", F.col("uid")), _lists_for_stars(bits, homes)), nodes, tasks)
    found = links.count()
    links = links.coalesce(link_tasks(found))
    joined = materialise(components(links))
    while found > ROUND_SHARE * count:
        more = verified(met(named_by(joined), _lists_for_components(bits)), nodes, tasks)
        found = more.count()
        if found:
            links = links.unionByName(more.coalesce(link_tasks(found)))
            joined = materialise(components(links))
    named = named_by(joined)
    lists = _prefixes(named).mapInArrow(_lists_for_pairs(bits), _LISTS)
    across = lists.groupBy("block", "cell").applyInPandas(_across, "a long, b long").distinct()
    # pairs may be many more than the nodes: as many tasks as there are
    more = verified(across, nodes)
    if found := more.count():
        joined = materialise(components(links.unionByName(more.coalesce(link_tasks(found)))))

    rooted = classes.join(small(joined), classes["node"] == joined["node"], "left").select(
        *key, "id", F.coalesce("component", classes["node"]).alias("root")
    )
    rooted = materialise(rooted.coalesce(tasks))
    ids = materialise(rooted.groupBy("root").agg(F.min("id").alias("component_id")).coalesce(tasks))
    named = rooted.select(*key, "root").join(small(ids), "root").drop("root").coalesce(tasks)
    return sets.join(small(materialise(named)), key, "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "version"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The input rows with the smallest id of their component, all columns kept.

    Rows are found again by id and text. Rows that repeat the smallest id stay as
    they are (exact copies are another operator's work), as do rows of a
    component that has no ids.
    """
    total = text_bytes(docs)
    found = near_duplicates(docs, total).where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    found = found.select(F.col("doc_id").alias("n_id"), F.col("version").alias("n_version")).distinct()
    found = small(materialise(found.coalesce(text_tasks(total))))
    same = docs["doc_id"].eqNullSafe(found["n_id"]) & (F.xxhash64(text_or_empty()) == found["n_version"])
    return docs.join(found, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
