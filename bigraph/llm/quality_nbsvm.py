"""Quality classifier: naive-Bayes features under a linear hinge loss.

A document's features are indicators of hashed n-grams: words and word pairs,
byte triples, and runs of up to three word *shapes* (letter case, first and
last character class, repetition of the word before).  Each indicator is
scaled by its class log-count ratio; a linear support-vector machine on the
scaled, length-normalised indicators is trained by dual coordinate descent,
and a logistic fit on margins of rows it has not seen turns margins into
probabilities.

The classifier is fitted on a bounded sample of labelled rows (``per_class``
of each class, those with the least id hash); only the sample's features reach
the driver.  Scoring is one pass without a shuffle over all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import arrow_map, fold, give_back, least_hashed
from bigraph.llm.kernels import LOWER, SMALL_BYTES, U64, chunks, mix, prefix_hash, span_hash, text_arrays, word_spans

FOLDS, HELD_FOLD = 5, 0
PER_CLASS = 2500            # labelled rows of each class the classifier is fitted on
BITS = 18                   # hashed feature space
THRESHOLD = 0.3
SMOOTHING = 1.0             # of the log-count ratios
COST = 1.0                  # hinge-loss weight C
EPOCHS = 15
CALIBRATION_PART = 4        # one in so many sample rows is kept for the logistic fit

# Character classes for shapes: 0 lower, 1 upper, 2 digit, 3 sentence mark, 4 symbol, 5 beyond ASCII.
_CLASS = np.full(256, 4, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 5
_CLASS[list(b".,;:!?'\"()-")] = 3
_SALT = mix(np.arange(1, 9, dtype=U64) * U64(0x9E3779B97F4A7C15))


def _grams(data: np.ndarray, offsets: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(document, feature)`` occurrences of each n-gram family."""
    shift = U64(64 - bits)
    low = LOWER[data]
    starts, ends, doc = word_spans(low, offsets)
    families = []

    def add(salt, docs, hashes):
        families.append((docs, (mix(hashes ^ _SALT[salt]) >> shift).astype(np.int64)))

    if starts.size:
        h = span_hash(prefix_hash(low), starts, ends)
        add(0, doc, h)
        same = np.flatnonzero(doc[1:] == doc[:-1])
        add(1, doc[same], h[same] * U64(0x9FB21C651E98DF25) + h[same + 1])
        upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
        letters = np.concatenate(([0], np.cumsum((low >= 97) & (low <= 122))))
        n_up, n_let = upper[ends] - upper[starts], letters[ends] - letters[starts]
        repeats = np.zeros(doc.size, dtype=np.int64)
        repeats[same + 1] = h[same] == h[same + 1]
        size = np.minimum(np.log2(ends - starts + 1).astype(np.int64), 5)
        shape = ((((_CLASS[data[starts]] * 6 + _CLASS[data[ends - 1]]) * 2 + ((n_up > 1) & (n_up == n_let))) * 2
                  + repeats) * 6 + size).astype(U64)
        add(2, doc, shape)
        add(3, doc[same], shape[same] << U64(20) | shape[same + 1])
        triple = np.flatnonzero(doc[2:] == doc[:-2])
        add(4, doc[triple], (shape[triple] << U64(40)) | (shape[triple + 1] << U64(20)) | shape[triple + 2])
    if data.size >= 3:
        b = data.astype(U64)
        of = np.searchsorted(offsets, np.arange(data.size - 2), side="right") - 1
        inside = np.flatnonzero(np.arange(2, data.size) < offsets[of + 1])
        add(5, of[inside], (b[:-2] << U64(16) | b[1:-1] << U64(8) | b[2:])[inside])
    return families


def indicators(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each document: sorted ``(document, feature)``."""
    fams = _grams(data, offsets, bits)
    if not fams:
        z = np.zeros(0, dtype=np.int64)
        return z, z
    code = np.concatenate([d << bits | f for d, f in fams]).astype(np.uint64)
    code.sort()
    code = code[np.append(True, code[1:] != code[:-1])].astype(np.int64)
    return code >> bits, code & ((1 << bits) - 1)


@dataclass
class Model:
    weights: np.ndarray     # per feature, log-count ratio included
    bias: float
    slope: float
    shift: float
    bits: int = BITS

    def margins(self, docs: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
        count = np.bincount(docs, minlength=n)
        total = np.bincount(docs, self.weights[feats], minlength=n)
        return self.bias + total / np.sqrt(np.maximum(count, 1))

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -40, 40)))


def log_count_ratio(feats: list[np.ndarray], y: np.ndarray, bits: int, smoothing: float) -> np.ndarray:
    """log of (p / |p|) over (q / |q|): smoothed document counts of each
    feature by class."""
    size = 1 << bits
    p = np.bincount(np.concatenate([f for f, t in zip(feats, y) if t > 0]), minlength=size) + smoothing
    q = np.bincount(np.concatenate([f for f, t in zip(feats, y) if t < 0]), minlength=size) + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(feats: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int,
                            cost: np.ndarray, epochs: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """L2-regularised hinge loss over sparse rows: one dual variable at a
    time is set to its best value in ``[0, cost]``.  The bias is a feature of
    value 1 in every row."""
    w, b, alpha = np.zeros(size), 0.0, np.zeros(len(y))
    square = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            grad = y[i] * (w[feats[i]] @ values[i] + b) - 1.0
            new = min(max(alpha[i] - grad / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[feats[i]] += step * values[i]
                b += step
                alpha[i] = new
    return w, b


def logistic_fit(margins: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of P(y = 1 | margin) by Newton steps, with smoothed
    targets so that separable margins stay finite."""
    n1, n0 = weight[y > 0].sum(), weight[y < 0].sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.vstack([margins, np.ones(len(margins))])
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -40, 40)))
        grad = x @ (weight * (p - target)) + 1e-6 * theta
        hess = (x * (weight * p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def train(feats: list[np.ndarray], y: np.ndarray, population: tuple[int, int], bits: int = BITS,
          smoothing: float = SMOOTHING, cost: float = COST, epochs: int = EPOCHS) -> Model:
    """A model from sample rows (``y`` 1 or -1); ``population`` are the
    numbers of all labelled training rows of class 0 and 1, to which the
    probabilities are weighted."""
    size = 1 << bits
    n0, n1 = int((y < 0).sum()), int((y > 0).sum())
    if not n0 or not n1:    # nothing to tell apart: the share of the only class
        share = (population[1] + 1) / (sum(population) + 2)
        return Model(np.zeros(size), 0.0, 1.0, float(np.log(share / (1 - share))), bits)
    use = np.arange(len(y)) % CALIBRATION_PART != 0

    def fit(rows):
        f, t = [feats[i] for i in rows], y[rows]
        if (t > 0).all() or (t < 0).all():
            rows = np.arange(len(y))
            f, t = feats, y
        r = log_count_ratio(f, t, bits, smoothing)
        v = [r[x] / np.sqrt(max(len(x), 1)) for x in f]
        each = cost * np.where(t > 0, len(t) / (2 * (t > 0).sum()), len(t) / (2 * (t < 0).sum()))
        w, b = dual_coordinate_descent(f, v, t, size, each, epochs)
        return w * r, b

    w, b = fit(np.flatnonzero(use))
    part = Model(w, b, 1.0, 0.0, bits)
    rest = np.flatnonzero(~use)
    m = np.array([part.bias + part.weights[feats[i]].sum() / np.sqrt(max(len(feats[i]), 1)) for i in rest])
    weight = np.where(y[rest] > 0, population[1] / n1, population[0] / n0)
    slope, shift = logistic_fit(m, y[rest], weight)
    w, b = fit(np.arange(len(y)))
    return Model(w, b, slope, shift, bits)


def _features(bits: int):
    def run(batch: pa.RecordBatch):
        data, offsets = text_arrays(batch.column(1))
        for i, j, d, o in chunks(data, offsets, SMALL_BYTES):
            docs, feats = indicators(d, o, bits)
            cuts = np.searchsorted(docs, np.arange(j - i + 1))
            raw = [feats[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(raw, pa.binary())], names=["y", "feats"])
    return run


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        folds: int = FOLDS, held_fold: int = HELD_FOLD, per_class: int = PER_CLASS, bits: int = BITS,
        **settings) -> Model:
    """A model from ``docs`` and ``labels`` (``key, label`` 0 or 1) outside
    the held-out fold.  A document with several labels counts as the least;
    labels that are NULL or of documents not in ``docs`` are ignored."""
    known = (labels.where(F.col(label).isin(0, 1) & (fold(key, folds) != held_fold))
             .groupBy(F.col(key).alias("_id")).agg(F.min(label).alias("y")))
    # At most 2 * per_class ids by their hash: a broadcast of proven size.
    chosen = (least_hashed(known.select("y", F.col("_id").alias("id"), F.xxhash64("_id").alias("h")), per_class, "y")
              .withColumnRenamed("id", "_id"))
    rows = (docs.select(F.col(key).alias("_id"), F.col(text).alias("text"))
            .join(F.broadcast(chosen), "_id").select("_id", "y", "text"))
    # One row per id, should the table repeat it.
    rows = rows.groupBy("_id", "y").agg(F.min("text").alias("text")).select(
        (F.col("_id") * 2 + F.col("y")).alias("y"), "text")
    got = arrow_map(rows, _features(bits), "y bigint, feats binary").toArrow()
    code = got.column("y").to_numpy()
    order = np.argsort(code)
    raw = got.column("feats").to_pylist()
    feats = [np.frombuffer(raw[i], np.int32) for i in order]
    y = np.where(code[order] & 1, 1.0, -1.0)
    of = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    return train(feats, y, (of.get(0, 0), of.get(1, 0)), bits, **settings)


def _score(model: Model):
    def run(batch: pa.RecordBatch):
        data, offsets = text_arrays(batch.column(2))
        for i, j, d, o in chunks(data, offsets, SMALL_BYTES):
            m = model.margins(*indicators(d, o, model.bits), j - i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(model.scores(m))],
                names=["doc_id", "held_out", "score"])
    return run


def quality_scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", folds: int = FOLDS,
                   held_fold: int = HELD_FOLD, threshold: float = THRESHOLD) -> DataFrame:
    """Per row ``key, held_out, score, predicted`` from the whole text alone.

    Edge cases: a NULL or empty text scores what the bias gives it.  A NULL id
    is not learned from (``held_out`` true).  Repeated rows score each;
    without labels, or with labels of one class, the score is that class's
    smoothed share.  Other columns are ignored; an empty table gives no rows.
    """
    held = F.coalesce(fold(key, folds) == held_fold, F.lit(True))
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))
    out = rows.mapInArrow(_with_model(docs, model, _score), "doc_id bigint, held_out boolean, score double")
    return out.select(F.col("doc_id").alias(key), "held_out", "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def _with_model(docs: DataFrame, model: Model, step):
    shared = docs.sparkSession.sparkContext.broadcast(model)   # 2**bits weights

    def run(batches):
        one = step(shared.value)
        for b in batches:
            yield from one(b)
            del b
            give_back()
    return run


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns."""
    place = docs.columns.index(text)

    def step(model):
        def run(batch: pa.RecordBatch):
            data, offsets = text_arrays(batch.column(place))
            for i, j, d, o in chunks(data, offsets, SMALL_BYTES):
                m = model.margins(*indicators(d, o, model.bits), j - i)
                yield batch.slice(i, j - i).filter(pa.array(model.scores(m) >= threshold))
        return run

    return docs.mapInArrow(_with_model(docs, model, step), docs.schema)
