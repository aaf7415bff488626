"""Toxicity from the nearest labelled examples.

Documents are TF-IDF vectors over words and word beginnings (4 to 7 bytes, so
that an inflected or compounded form meets its stem).  The vocabulary holds
the terms whose presence goes with the label in the examples (likelihood-ratio
test, at most ``TERMS``; no stop words).  A document's nearest examples by cosine are found
exactly in an inverted index whose postings are cut into blocks of examples
with their largest weight: blocks are opened by falling upper bound until no
unopened one can hold a nearer example.  The neighbours vote with weights that
fall with their distance, and an isotonic fit of leave-one-out votes (weighted
back to the labelled rows' shares) turns votes into probabilities.  The
neighbours are returned as evidence.

How it runs.  The examples are a bounded sample: ``per_class`` labelled rows of
each class, those with the least id hash.  Their term counts are a table in
the shared folder; Spark counts the terms by class and hands the driver the
vocabulary and the examples' vectors over it, nothing else.  The index is
broadcast and scoring is one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import arrow_map, discard, fold, least_hashed, materialize
from bigraph.llm.kernels import LOWER, U64, chunks, mix, prefix_hash, span_hash, text_arrays

FOLDS, HELD_FOLD = 4, 2
PER_CLASS = 3000            # labelled rows of each class that serve as examples
TERMS = 4096                # of the vocabulary at most
LEAST_G = 20.0              # likelihood-ratio statistic that lets a term in
COMMON = 0.25               # share of the clean examples above which a term is a stop word
PREFIXES = (4, 5, 6, 7)     # bytes of a word's beginning that are terms
NEIGHBOURS = 9
BLOCK = 64                  # examples of a block
SOFTEN = 0.1                # a vote weighs 1 / (distance + SOFTEN)
THRESHOLD = 0.3

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and 64-bit hash of every word (run of ASCII letters, case
    folded, and bytes beyond ASCII) and of its proper beginnings.  The lowest
    bits of a hash tell the kind: 1 to 4 a beginning, the shortest first, 7 a
    word."""
    low = LOWER[data]
    letter = _LETTER[low]
    edge = np.zeros(low.size + 1, dtype=bool)
    edge[offsets] = True
    s = np.flatnonzero(letter & (edge[:-1] | ~np.concatenate(([False], letter[:-1]))))
    e = np.flatnonzero(letter & (edge[1:] | ~np.concatenate((letter[1:], [False])))) + 1
    if not s.size:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    doc = np.searchsorted(offsets, s, side="right") - 1
    p = prefix_hash(low)
    docs, hashes = [doc], [span_hash(p, s, e) | U64(7)]
    for i, size in enumerate(PREFIXES):
        longer = np.flatnonzero(e - s > size)
        docs.append(doc[longer])
        hashes.append(span_hash(p, s[longer], s[longer] + size) & ~U64(7) | U64(i + 1))
    return np.concatenate(docs), np.concatenate(hashes)


class Vocabulary:
    """Selected terms (sorted hashes) with their inverse document frequency."""

    def __init__(self, hashes: np.ndarray, df: np.ndarray, n: int):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.idf = np.log((1 + n) / (1 + df[order])) + 1
        self.maybe = np.zeros(1 << 16, dtype=bool)          # most terms are told apart by 16 bits
        self.maybe[(self.hashes >> U64(48)).astype(np.int64)] = True

    def vectors(self, doc: np.ndarray, hashes: np.ndarray, n_docs: int):
        """Unit TF-IDF vectors of ``n_docs`` documents: ``offsets, term, weight``."""
        size = len(self.hashes)
        if not size:
            return np.zeros(n_docs + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
        keep = np.flatnonzero(self.maybe[(hashes >> U64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[keep]), size - 1)
        known = self.hashes[at] == hashes[keep]
        cell, tf = np.unique(doc[keep][known] * size + at[known], return_counts=True)
        of, term = cell // size, cell % size
        w = (1 + np.log(tf)) * self.idf[term]
        norm = np.sqrt(np.bincount(of, w * w, n_docs))
        return np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n_docs)))), term, w / norm[of]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ``[starts, starts + sizes)`` laid end to end."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class BlockMaxIndex:
    """Postings (example, weight) by term, cut into blocks of ``BLOCK``
    examples; each piece keeps its largest weight."""

    def __init__(self, n_terms: int, offsets: np.ndarray, term: np.ndarray, weight: np.ndarray):
        self.n = len(offsets) - 1
        example = np.repeat(np.arange(self.n), np.diff(offsets))
        by = np.lexsort((example, term))
        self.example, self.weight, term = example[by], weight[by], term[by]
        block = self.example // BLOCK
        first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))) if term.size else by
        self.start, self.size = first, np.diff(np.append(first, term.size))
        self.block = block[first]
        self.most = np.maximum.reduceat(self.weight, first) if term.size else self.weight
        self.of_term = np.searchsorted(term[first], np.arange(n_terms + 1))
        self.opened = 0                                     # blocks, for reports and tests

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, without: int = -1):
        """The ``k`` examples with the largest positive cosine, ties to the
        smaller number: ``example, cosine``.  Exact: a block stays closed only
        if its bound is below the ``k``-th cosine found."""
        lo = self.of_term[term]
        pieces = self.of_term[term + 1] - lo
        piece = _ranges(lo, pieces)
        w, block = np.repeat(weight, pieces), self.block[piece]
        bound = np.bincount(block, w * self.most[piece], -(-self.n // BLOCK))
        waiting = np.flatnonzero(bound)
        waiting = waiting[np.argsort(-bound[waiting], kind="stable")]
        best_e, best_c, least, step = np.zeros(0, np.int64), np.zeros(0), 0.0, 4
        while waiting.size:
            chosen, waiting = waiting[:step], waiting[step:]
            self.opened += chosen.size
            now = np.zeros(bound.size, dtype=bool)
            now[chosen] = True
            mine = np.flatnonzero(now[block])
            p = piece[mine]
            at = _ranges(self.start[p], self.size[p])
            c = np.bincount(self.example[at], np.repeat(w[mine], self.size[p]) * self.weight[at], self.n)
            if without >= 0:
                c[without] = 0
            e = np.flatnonzero(c > least)
            best_e, best_c = np.concatenate((best_e, e)), np.concatenate((best_c, c[e]))
            if best_e.size > k:
                near = np.flatnonzero(best_c >= np.partition(best_c, -k)[-k])
                near = near[np.lexsort((best_e[near], -best_c[near]))[:k]]
                best_e, best_c = best_e[near], best_c[near]
            if best_e.size == k:
                least = best_c.min() - 1e-9
                waiting = waiting[bound[waiting] >= least]
            step *= 2
        order = np.lexsort((best_e, -best_c))
        return best_e[order], best_c[order]


def heaviest(offsets: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The term of the largest weight in each vector (-1: an empty one)."""
    out = np.full(len(offsets) - 1, -1)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        if a < b:
            out[i] = term[a + int(np.argmax(weight[a:b]))]
    return out


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of ``y`` on ``x``: the mean ``x`` and the smoothed
    ``y`` of each pooled run."""
    runs: list[list[float]] = []
    for i in np.argsort(x, kind="stable"):
        runs.append([x[i] * w[i], y[i] * w[i], w[i], x[i]])
        while len(runs) > 1 and (runs[-2][3] == runs[-1][3] or runs[-2][1] * runs[-1][2] >= runs[-1][1] * runs[-2][2]):
            last = runs.pop()
            runs[-1] = [runs[-1][0] + last[0], runs[-1][1] + last[1], runs[-1][2] + last[2], last[3]]
    r = np.array(runs)
    value = (r[:, 1] + 0.5) / (r[:, 2] + 1)
    return r[:, 0] / r[:, 2], np.maximum.accumulate(value)


@dataclass
class Model:
    vocabulary: Vocabulary
    index: BlockMaxIndex
    ids: np.ndarray             # of the examples
    toxic: np.ndarray
    neighbours: int
    knots: tuple[np.ndarray, np.ndarray]
    silent: float               # probability without any term of the vocabulary

    def vote(self, example: np.ndarray, cosine: np.ndarray) -> float:
        w = 1 / (np.maximum(0.0, 1 - cosine) + SOFTEN)
        return float((w * self.toxic[example]).sum() / w.sum())

    def judge(self, term: np.ndarray, weight: np.ndarray):
        """Probability, and the neighbours with their cosines."""
        if not term.size:
            return self.silent, term, weight
        e, c = self.index.nearest(term, weight, self.neighbours)
        return float(np.interp(self.vote(e, c), *self.knots)), e, c


def train(ids: np.ndarray, toxic: np.ndarray, vocabulary: Vocabulary, offsets: np.ndarray, term: np.ndarray,
          weight: np.ndarray, class_sizes: tuple[int, int], neighbours: int = NEIGHBOURS) -> Model:
    """Index and calibration from examples; ``class_sizes`` counts all
    labelled rows of class 0 and 1, of which the examples are a sample."""
    # Examples that share their heaviest term lie together, so blocks differ;
    # among these a hash of the id decides, also on ties between neighbours.
    order = np.lexsort((ids, mix(ids.astype(U64)), heaviest(offsets, term, weight)))
    sizes = np.diff(offsets)[order]
    at = _ranges(offsets[order], sizes)
    offsets, term, weight = np.concatenate(([0], np.cumsum(sizes))), term[at], weight[at]
    ids, toxic = ids[order], toxic[order]
    # The sample may hold the classes in other shares than the labels do.
    rate = [class_sizes[c] / max(1, int((toxic == c).sum())) for c in (0, 1)]
    w = np.where(toxic == 1, rate[1], rate[0])
    model = Model(vocabulary, BlockMaxIndex(len(vocabulary.hashes), offsets, term, weight), ids, toxic, neighbours,
                  (np.zeros(1), np.zeros(1)), 0.0)
    none = sizes == 0
    share = (w * toxic).sum() / max(1.0, w.sum())           # of toxic rows among the labelled
    model.silent = float(((w * toxic)[none].sum() + share) / (w[none].sum() + 1))
    votes, found = np.zeros(len(ids)), np.zeros(len(ids), dtype=bool)
    for i in np.flatnonzero(~none):
        a, b = offsets[i], offsets[i + 1]
        e, c = model.index.nearest(term[a:b], weight[a:b], neighbours, without=i)
        if e.size:
            votes[i], found[i] = model.vote(e, c), True
    if found.any():
        model.knots = isotonic(votes[found], toxic[found].astype(float), w[found])
    return model


_EXAMPLE = "id bigint, toxic int, terms binary, counts binary"


def _count_terms(batch: pa.RecordBatch):
    for i, j, d, o in chunks(*text_arrays(batch.column(2))):
        doc, h = terms(d, o)
        by = np.lexsort((h, doc))
        doc, h = doc[by], h[by]
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if h.size else by
        tf, doc, h = np.diff(np.append(first, h.size)).astype(np.uint32), doc[first], h[first]
        cut = np.searchsorted(doc, np.arange(j - i + 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
             pa.array([h[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
             pa.array([tf[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
            names=["id", "toxic", "terms", "counts"])


def _listed(batch: pa.RecordBatch):
    for toxic, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        h = np.frombuffer(raw, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(h.size, toxic, np.int32))], names=["term", "toxic"])


def _term_table(examples: DataFrame, sizes: tuple[int, int], most: int, least_g: float,
                common: float) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and document frequencies of the terms whose presence depends
    most on the label; ``2 * sum of O * ln(O / E)`` over the four cells."""
    n0, n1 = (F.lit(float(s)) for s in sizes)
    pos, df = F.col("pos").cast("double"), F.col("df").cast("double")
    n = n0 + n1

    def cell(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g = 2 * (cell(pos, df * n1 / n) + cell(df - pos, df * n0 / n)
             + cell(n1 - pos, (n - df) * n1 / n) + cell(n0 - df + pos, (n - df) * n0 / n))
    counted = (arrow_map(examples.select("toxic", "terms"), _listed, "term bigint, toxic int").groupBy("term")
               .agg(F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("df")).where((F.col("df") > 1) & (F.col("df") - F.col("pos") <= common * n0)))
    best = (counted.withColumn("g", g).where(F.col("g") >= least_g).orderBy(F.desc("g"), "term").limit(most)
            .select("term", "df").toPandas())
    return best["term"].to_numpy(np.int64).view(U64), best["df"].to_numpy(np.int64)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        folds: int = FOLDS, held_fold: int = HELD_FOLD, per_class: int = PER_CLASS, most_terms: int = TERMS,
        least_g: float = LEAST_G, common: float = COMMON, neighbours: int = NEIGHBOURS) -> Model:
    """A model from ``docs`` and ``labels`` (``key, label`` 0 or 1) outside
    the held-out fold.  A document with several labels counts as the greatest;
    labels that are NULL or of documents not in ``docs`` are ignored."""
    known = (labels.where(F.col(label).isin(0, 1) & (fold(key, folds) != held_fold))
             .groupBy(F.col(key).alias("_id")).agg(F.max(label).cast("int").alias("y")))
    chosen = (least_hashed(known.select("y", F.col("_id").alias("id"), F.xxhash64("_id").alias("h")), per_class, "y")
              .withColumnRenamed("id", "_id"))
    rows = (docs.select(F.col(key).alias("_id"), F.col(text).alias("text"))
            .join(F.broadcast(chosen), "_id")       # at most 2 * per_class ids
            .groupBy("_id", "y").agg(F.min("text").alias("text")))
    examples = materialize(arrow_map(rows.select(F.col("_id").cast("bigint"), "y", "text"), _count_terms, _EXAMPLE),
                           "examples")
    of = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    sampled = (of.get(0, 0), of.get(1, 0))
    all_of = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    hashes, df = np.zeros(0, U64), np.zeros(0, np.int64)
    if min(sampled):
        hashes, df = _term_table(examples, sampled, most_terms, least_g, common)
    def project(batch: pa.RecordBatch):
        """Examples with the selected terms only."""
        terms_, counts = [], []
        for h, tf in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            h, tf = np.frombuffer(h, U64), np.frombuffer(tf, np.uint32)
            mine = np.isin(h, hashes)
            terms_.append(h[mine].tobytes())
            counts.append(tf[mine].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms_, pa.binary()),
                                          pa.array(counts, pa.binary())], names=["id", "toxic", "terms", "counts"])

    got = arrow_map(examples, project, _EXAMPLE).toArrow().combine_chunks()
    discard(examples)
    ids, toxic = got.column("id").to_numpy(), got.column("toxic").to_numpy()
    h = [np.frombuffer(x, U64) for x in got.column("terms").to_pylist()]
    tf = [np.frombuffer(x, np.uint32) for x in got.column("counts").to_pylist()]
    doc = np.repeat(np.arange(len(ids)), [int(x.sum()) for x in tf])
    h = np.concatenate([np.repeat(a, b) for a, b in zip(h, tf)]) if h else np.zeros(0, U64)
    vocabulary = Vocabulary(hashes, df, sum(sampled))
    return train(ids, toxic, vocabulary, *vocabulary.vectors(doc, h, len(ids)), (all_of.get(0, 0), all_of.get(1, 0)),
                 neighbours)


SCORES = "doc_id bigint, held_out boolean, score double, evidence array<struct<doc_id bigint, toxic int, cosine double>>"
_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))


def _score(model: Model):
    def run(batch: pa.RecordBatch):
        for i, j, d, o in chunks(*text_arrays(batch.column(2))):
            offsets, term, weight = model.vocabulary.vectors(*terms(d, o), j - i)
            scores, sizes, examples, cosines = np.zeros(j - i), np.zeros(j - i, np.int32), [], []
            for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                scores[k], e, c = model.judge(term[a:b], weight[a:b])
                sizes[k] = len(e)
                examples.append(e)
                cosines.append(c)
            e = np.concatenate(examples).astype(np.int64)
            flat = pa.StructArray.from_arrays(
                [pa.array(model.ids[e], pa.int64()), pa.array(model.toxic[e], pa.int32()),
                 pa.array(np.minimum(np.concatenate(cosines), 1.0))], fields=list(_EVIDENCE.value_type))
            evidence = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(scores), evidence],
                names=["doc_id", "held_out", "score", "evidence"])
    return run


def toxicity_scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", folds: int = FOLDS,
                    held_fold: int = HELD_FOLD, threshold: float = THRESHOLD) -> DataFrame:
    """Per row ``key, held_out, score, predicted, evidence`` from the whole
    text alone; ``evidence`` lists the nearest examples, nearest first.

    Edge cases: a NULL or empty text, or one without a term of the vocabulary,
    scores the toxic share of such examples and has no evidence.  A NULL key
    is not learned from (``held_out`` true).  Repeated rows score each.  With
    labels of one class or none there is no vocabulary, and every text scores
    that share (0 without toxic labels).  Other columns are ignored; an empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)    # bounded by per_class and most_terms

    def run(batches):
        one = _score(shared.value)
        for b in batches:
            yield from one(b)

    held = F.coalesce(fold(key, folds) == held_fold, F.lit(True))
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, SCORES).select(
        F.col("doc_id").alias(key), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence")
