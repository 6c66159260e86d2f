"""Quality classifier by co-training.

Two logistic classifiers see different views of a document: its text (hashed
byte pairs, and how far words repeat) and its metadata (source, language, stated length). Each starts from
the labelled sample; over some rounds each labels the unlabelled documents it is
most sure of for the *other* one. Both are then calibrated on labelled documents
neither was trained on, and their log-odds are added.

Labelled documents are bounded samples, chosen by a hash of the id. Each round
scores every unlabelled document where it lies; only its id and margins are
shuffled, and the surest of a class are a distributed top-n. The final scores
are made row by row, without a shuffle.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialise, ship_package
from basketry.llm.shingles import word_hashes

#: bounds of the samples: labelled rows per class, labelled rows for calibration
CLASS_ROWS = 1200
CALIBRATION_ROWS = 1200
ROUNDS = 4
#: pseudo-labels: at least this sure, at most so many per class and round
SURE = 0.95
EXCHANGE = 100
#: documents with a smaller probability of good quality are rejected
THRESHOLD = 0.5

TEXT_BUCKETS = 4096
REPETITIONS = 3
META_BUCKETS = 128
_CHUNK = 1 << 20
_PAIR = np.uint32(0x9E3779B1)


def _pair_buckets(raw: np.ndarray) -> np.ndarray:
    pairs = (raw[:-1].astype(np.uint32) << np.uint32(8)) | raw[1:]
    return (pairs * _PAIR) >> np.uint32(32 - TEXT_BUCKETS.bit_length() + 1)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)


def _chunks(raw: np.ndarray) -> Iterator[np.ndarray]:
    for a in range(0, max(len(raw) - 1, 0), _CHUNK):
        yield raw[a : a + _CHUNK + 1]


def repetition(raw: np.ndarray) -> np.ndarray:
    """Shares, times 10: words equal to the one before; pairs and triples of words
    that stood earlier in the text. Zeros for texts of one word."""
    w, _ = word_hashes(raw)
    out = np.zeros(REPETITIONS)
    if len(w) > 1:
        out[0] = (w[1:] == w[:-1]).mean()
        grams = w
        for k in (1, 2):
            grams = grams[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[k:]
            if len(grams):
                out[k] = 1 - len(np.unique(grams)) / len(grams)
    return 10 * out


def text_view(text: str | None) -> np.ndarray:
    """Shares of the text's byte pairs per bucket, times 100 (zeros without pairs),
    then its repetition."""
    counts, raw = np.zeros(TEXT_BUCKETS), _bytes(text)
    for part in _chunks(raw):
        counts += np.bincount(_pair_buckets(part), minlength=TEXT_BUCKETS)
    return np.r_[100 * counts / max(counts.sum(), 1), repetition(raw)]


def _packed(view: np.ndarray) -> bytes:
    """A text view in single precision: the places that are not zero, then their values."""
    at = np.flatnonzero(view)
    return at.astype("<u2").tobytes() + view[at].astype("<f4").tobytes()


def _unpacked(packed: list[pa.BinaryScalar], out: np.ndarray) -> None:
    """Packed views into the rows of ``out`` (zeros)."""
    for row, raw in zip(out, packed):
        n = len(raw := raw.as_buffer()) // 6
        row[np.frombuffer(raw, "<u2", n)] = np.frombuffer(raw, "<f4", n, 2 * n)


_EVERY_PAIR = _pair_buckets(np.arange(1 << 16, dtype="<u2").view(np.uint8).reshape(-1, 2).reshape(-1))[::2]


def text_margin(text: str | None, weights: np.ndarray, by_pair: np.ndarray | None = None) -> float:
    """``text_view(text) @ weights`` without the view; ``by_pair`` is ``weights[_EVERY_PAIR]``,
    the weight of each byte pair read as a little-endian number."""
    total, raw = 0.0, _bytes(text)
    for part in _chunks(raw):
        if by_pair is None:
            total += weights[_pair_buckets(part)].sum()
        else:
            for odd in (0, 1):
                total += by_pair[part[odd : odd + (len(part) - odd) // 2 * 2].view("<u2")].sum()
    return 100 * total / max(len(raw) - 1, 1) + repetition(raw) @ weights[TEXT_BUCKETS:]


def meta_buckets(source: str | None, lang: str | None, n_chars: float | None) -> list[int]:
    """Buckets of the metadata: one each for source, language and order of length;
    null is a value of its own, as is an infinite length."""
    if n_chars is None or n_chars != n_chars:
        size = -1
    else:
        size = -2 if np.isinf(n_chars) else int(np.log2(max(float(n_chars), 0) + 1) * 2)
    return [zlib.crc32(x.encode("utf-8", "replace")) % META_BUCKETS for x in (f"s{source}", f"l{lang}", f"n{size}")]


def meta_view(rows: list[tuple]) -> np.ndarray:
    out = np.zeros((len(rows), META_BUCKETS))
    for i, row in enumerate(rows):
        for b in meta_buckets(*row):
            out[i, b] += 1
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, decay: float, steps: int = 300) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression, classes
    weighted alike, by accelerated gradient steps."""
    return _fitted(np.hstack([x, np.ones((len(x), 1), x.dtype)]), y, decay, steps)


def _fitted(x: np.ndarray, y: np.ndarray, decay: float, steps: int = 300) -> np.ndarray:
    """``logistic`` of rows whose last column is the intercept's ones."""
    weight = np.where(y > 0.5, 0.5 / max((y > 0.5).sum(), 1), 0.5 / max((y <= 0.5).sum(), 1))
    rate = 1 / (0.25 * float(weight @ np.einsum("ij,ij->i", x, x, dtype=float)) + decay)
    w = ahead = np.zeros(x.shape[1])
    for t in range(steps):
        off = weight * (_sigmoid(x @ ahead.astype(x.dtype)) - y)
        step = ahead - rate * (x.T @ off.astype(x.dtype) + decay * np.r_[ahead[:-1], 0])
        ahead = step + t / (t + 3) * (step - w)
        w = step
    return w


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make ``slope * margin + offset`` the log-odds (Newton
    steps, targets drawn in by one row per class). The slope is not negative."""
    good, bad = (y > 0.5).sum(), (y <= 0.5).sum()
    target = np.where(y > 0.5, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    w = np.array([0.0, np.log((good + 1) / (bad + 1))])
    for _ in range(50):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * w)
        w = w - np.clip(step, -2, 2)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (0.0, float(np.log((good + 1) / (bad + 1))))


VIEWS = ("text", "meta")


class CoTrained:
    """Both classifiers, their calibration and the share of good rows.

    ``taught`` has each learner's rows (``x``, with a last column of ones, and ``y``):
    those of ``train``, then the pseudo-labelled ones of earlier rounds. ``pool`` holds
    unlabelled rows to exchange from in memory (none in a Spark job, see ``train``).
    """

    def __init__(self, train: dict, calibration: dict, pool: dict, rounds: int = ROUNDS, taught: dict | None = None):
        views = VIEWS
        decay = {"text": 1e-3, "meta": 1e-3}
        x = {v: train[v] for v in views}
        y = {v: train["y"] for v in views}
        self.exchanged = 0
        for r in range(rounds + 1):
            if taught:
                self.weights = {v: _fitted(taught[v]["x"], taught[v]["y"], decay[v]) for v in views}
            else:
                self.weights = {v: logistic(x[v], y[v], decay[v]) for v in views}
            if taught or r == rounds or not len(pool["text"]):
                break
            margins = {v: pool[v] @ self.weights[v][:-1] + self.weights[v][-1] for v in views}
            taken = np.zeros(len(pool["text"]), bool)
            for teacher, learner in (views, views[::-1]):
                p = _sigmoid(margins[teacher])
                for label, sure in ((1.0, p), (0.0, 1 - p)):
                    rows = np.argsort(-sure, kind="stable")[:EXCHANGE]
                    rows = rows[sure[rows] >= SURE]
                    x[learner] = np.vstack([x[learner], pool[learner][rows]])
                    y[learner] = np.r_[y[learner], np.full(len(rows), label)]
                    taken[rows] = True
            self.exchanged += int(taken.sum())
            pool = {v: pool[v][~taken] for v in views}
        known = calibration if len(set(calibration["y"])) == 2 else train
        self.scale = {v: _calibrate(known[v] @ self.weights[v][:-1] + self.weights[v][-1], known["y"]) for v in views}
        good = known["y"].mean()
        self.prior = float(np.log(good / (1 - good)))

    def margins(self, batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        """Per view, of rows with the columns ``q_text, q_source, q_lang, q_n_chars``; without the intercept."""
        w_text, w_meta = self.weights["text"][:-1], self.weights["meta"][:-1]
        by_pair = w_text[_EVERY_PAIR]
        text = [text_margin(x.as_py(), w_text, by_pair) for x in batch.column("q_text")]
        meta = [w_meta[meta_buckets(*row)].sum() for row in zip(*(batch.column(f"q_{c}").to_pylist() for c in _INPUTS[1:]))]
        return {"text": np.array(text), "meta": np.array(meta)}

    def log_odds(self, view: str, margin: np.ndarray) -> np.ndarray:
        slope, offset = self.scale[view]
        return slope * (margin + self.weights[view][-1]) + offset

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Combined probability: the views' evidence beyond the prior, added."""
        return _sigmoid(text + meta - self.prior)


_INPUTS = ("text", "source", "lang", "n_chars")


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = set()
    for b in batches:
        # equal rows of one document need one view
        ids = b.column("doc_id").to_pylist()
        fresh = [i for i, d in enumerate(ids) if not (d in seen or seen.add(d))]
        b = b.take(pa.array(fresh, pa.int64()))
        raw = [_packed(text_view(t.as_py())) for t in b.column("text")]
        names = ["doc_id", "y", "use", "source", "lang", "n_chars"]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(raw, pa.binary())], names=[*names, "view"])


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, what the views need, and ``version``, a hash of it."""
    rows = docs.where("doc_id is not null").select("doc_id", "text", "source", "lang", F.col("n_chars").cast("double"))
    return rows.withColumn("version", F.xxhash64(*[F.col(c).isNull() for c in _INPUTS], *_INPUTS))


def _viewed(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """``doc_id, y, use, source, lang, n_chars, view`` of the ``picked`` documents (``doc_id, version, y, use``), one row each."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, y int, use string, source string, lang string, n_chars double, view binary"
    rows = _rows(docs).join(F.broadcast(picked), ["doc_id", "version"])
    return rows.select("doc_id", "y", "use", "source", "lang", "n_chars", "text").mapInArrow(_views, schema).dropDuplicates(["doc_id"])


def _known(labels: DataFrame) -> DataFrame:
    """``doc_id, y``: conflicting labels of a document count as bad."""
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("y"))


def _sampled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The bounded labelled samples (``use``: train, per class; calibration) with their
    views. A document on several rows counts once, by the row with the smallest hash."""
    ids = materialise(docs.select("doc_id").distinct().join(known, "doc_id"))
    order = [F.xxhash64(F.lit(11), "doc_id"), F.col("doc_id")]
    first = lambda df, n: df.orderBy(*order).limit(n)
    # a third of the labelled ids is for calibration, with the classes' true shares
    third = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(3)) == 0
    calibration = first(ids.where(third), CALIBRATION_ROWS).withColumn("use", F.lit("calibration"))
    parts = [first(ids.where(~third).where(f"y = {c}"), CLASS_ROWS).withColumn("use", F.lit("train")) for c in (0, 1)]
    picked = materialise(calibration.unionByName(parts[0]).unionByName(parts[1]))
    one = _rows(docs).join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y", "use").agg(F.min("version").alias("version"))
    return materialise(_viewed(docs, materialise(one)))


def _surest(docs: DataFrame, known: DataFrame, taken: DataFrame | None, model: CoTrained) -> DataFrame:
    """``doc_id, version, use, y``: of every unlabelled document that is not ``taken``
    yet, the surest per class and view; ``use`` is the view that learns from it."""

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                found = model.margins(b)
                found = [pa.array(found[v] + model.weights[v][-1], pa.float64()) for v in VIEWS]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("version"), *found], names=["doc_id", "version", *VIEWS])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, version long, text double, meta double"
    rows = _rows(docs).select("doc_id", "version", *_inputs()).mapInArrow(margins, schema)
    # one row per document before the shuffle, as in the samples
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("version", *VIEWS)).alias("row")).select("doc_id", "row.*")
    rows = rows.join(known, "doc_id", "left_anti")
    if taken is not None:
        rows = rows.join(F.broadcast(taken.select("doc_id")), "doc_id", "left_anti")
    rows = materialise(rows)
    sure, out = float(np.log(SURE / (1 - SURE))), []
    for teacher, learner in (VIEWS, VIEWS[::-1]):
        for label, margin in ((1, F.col(teacher)), (0, -F.col(teacher))):
            top = rows.where(margin >= sure).orderBy(margin.desc(), F.xxhash64(F.lit(13), "doc_id"), "doc_id").limit(EXCHANGE)
            out.append(top.select("doc_id", "version", F.lit(learner).alias("use"), F.lit(label).alias("y")))
    return materialise(out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3]))


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole sample with the pseudo-labelled rows -> the pickled classifiers, or nothing."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)

    def learned(view: str, *uses: str) -> dict[str, np.ndarray]:
        """One view of the rows of these uses, with a last column of ones, filled in place."""
        own = pa.concat_tables([rows.filter(pc.equal(rows["use"], use)) for use in uses])
        if view == "text":
            x = np.zeros((len(own), TEXT_BUCKETS + REPETITIONS + 1), np.float32)
            _unpacked(own["view"], x)
            x[:, -1] = 1
        else:
            x = meta_view(list(zip(*(own[c].to_pylist() for c in ("source", "lang", "n_chars")))))
            x = np.hstack([x, np.ones((len(x), 1))])
        return {"x": x, "y": own["y"].to_numpy().astype(float)}

    taught = {v: learned(v, "train", v) for v in VIEWS}
    y = rows.filter(pc.equal(rows["use"], "train"))["y"].to_numpy().astype(float)
    if len(set(y)) == 2:
        train = {v: taught[v]["x"][: len(y), :-1] for v in VIEWS} | {"y": y}
        held = {v: learned(v, "calibration") for v in VIEWS}
        calibration = {v: held[v]["x"][:, :-1] for v in VIEWS} | {"y": held["text"]["y"]}
        model = CoTrained(train, calibration, {"text": [], "meta": []}, 0, taught=taught)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> CoTrained | None:
    """The co-trained classifiers, each time fitted in one task over the bounded
    labelled sample and the pseudo-labels so far; None without labelled documents
    of both classes."""
    ship_package(docs.sparkSession)
    known = materialise(_known(labels))
    sample, taken, exchanged = _sampled(docs, known), None, 0
    for r in range(rounds + 1):
        # one order, so that sums do not depend on partitions
        found = sample.repartition(1).sortWithinPartitions("use", "y", "doc_id").mapInArrow(_trained, "model binary").collect()
        if not found:
            return None
        model = pickle.loads(found[0].model)
        model.exchanged = exchanged
        if r == rounds:
            break
        picked = _surest(docs, known, taken, model)
        new = picked.select("doc_id").distinct().count()
        if not new:
            break
        exchanged += new
        # a document that both views are sure of teaches both
        views = _viewed(docs, picked.select("doc_id", "version", F.lit(0).alias("y"), F.lit("").alias("use")).distinct())
        views = views.drop("y", "use").join(F.broadcast(picked.drop("version")), "doc_id").select(*sample.columns)
        sample = materialise(sample.unionByName(views))
        taken = picked if taken is None else taken.unionByName(picked)
    return model


def _scores(model: CoTrained, batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    margin = model.margins(batch)
    t, m = (model.log_odds(v, margin[v]) for v in VIEWS)
    return {"p_text": _sigmoid(t), "p_meta": _sigmoid(m), "score": model.score(t, m)}


def _inputs() -> list[Column]:
    kinds = {"n_chars": "double"}
    return [F.col(c).cast(kinds.get(c, "string")).alias(f"q_{c}") for c in _INPUTS]


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, p_text, p_meta, score, keep``.

    Null and empty texts have no byte pairs and are judged by the rest; null
    metadata is a value of its own. Conflicting labels of a document count as
    bad; labels without a document, null labels and null ids are left out of
    training. Without labels of both classes every document is kept with score 1.
    Repeated rows are scored alike. An empty table gives an empty result; other
    columns are not read. A text is read whole, in pieces of bounded size.
    """
    model = train(docs, labels)
    if model is None:
        rows = docs.select("doc_id", *[F.lit(1.0).alias(n) for n in ("p_text", "p_meta", "score")])
    else:
        names = ["doc_id", "p_text", "p_meta", "score"]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    found = _scores(model, b)
                    yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(found[n]) for n in names[1:])], names=names)

        schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, p_text double, p_meta double, score double"
        rows = docs.select("doc_id", *_inputs()).mapInArrow(score, schema)
    return rows.withColumn("keep", F.col("score") >= threshold)


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, columns unchanged, whatever other columns there
    are. Nulls, texts, repeated rows and labels as in :func:`quality`: without
    labels of both classes all are kept, an empty table gives an empty result."""
    model = train(docs, labels)
    if model is None:
        return docs

    @F.arrow_udf("boolean")
    def good(*inputs: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays(list(inputs), names=[f"q_{c}" for c in _INPUTS])
        return pa.array(_scores(model, batch)["score"] >= threshold, pa.bool_())

    # only the inputs go to Python, once, and only the verdicts come back
    return docs.where(good(*_inputs()))
