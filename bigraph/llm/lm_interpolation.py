"""N-gram language-model scores by deleted interpolation.

The probability of a token is a mixture of its maximum-likelihood estimates of
order 0 (uniform), 1, ..., ``order``; the weights depend on a bucket of the
context's frequency and are learned by expectation-maximisation on counts of
held-out training documents.

How it runs.  A pass over the texts writes *batches*: the distinct word hashes
of some thousand documents and their token sequences as indexes into them (a
table in the shared folder, so no text is read or moved again).  Each batch
asks for the counts of its distinct n-grams: one blob per count bucket, the
n-grams counted within the batch before they are shuffled, so the most frequent
word is one entry per batch.  A bucket adds the counts of all batches and
answers each one in the order it asked.  With its answers a batch can
score all its documents.  Counts cover all training documents and are never
gathered in one place: there are as many buckets as the tokens need, so a task
holds a bounded number of n-grams at any size.  The weights are learned from
tuning documents, whose own counts are left out of the estimates for that
purpose only; scores count them like all others.  The driver sees totals and a
histogram of at most ``CONTEXT_BUCKETS * (BINS + 1) ** order`` cells (order 3:
500,000, 8 MB) of tuning tokens by quantised estimates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import arrow_map, fold, materialize, shuffle_partitions
from bigraph.llm.kernels import LOWER, U64, chunks, mix, prefix_hash, span_hash, text_arrays, word_spans

FOLDS, HELD_FOLD = 7, 2
TUNE_PART = 16              # one in so many training documents is held out for the weights
ORDER = 3
BUCKET_NGRAMS = 1 << 22     # requests of a count bucket, about: bounds the memory of a task
BATCH_BYTES = 1 << 23       # text of a batch: bounds the memory of a task
CONTEXT_BUCKETS = 32        # by the bit length of the context's count
BINS = 24                   # of an estimate in the histogram, one per factor of two
EM_ROUNDS = 60
BEGIN, END = U64(0x2545F4914F6CDD1D), U64(0x9FB21C651E98DF25)
_FOLD = U64(0xE7037ED1A0B428DB)


def _squeeze(*columns: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() if len(c) else b""
                   for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unsqueeze(blob: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        dt = np.dtype(kind)
        flat = np.frombuffer(raw, np.uint8, n * dt.itemsize, at).reshape(dt.itemsize, n)
        out.append(np.ascontiguousarray(flat.T).view(dt).ravel())
        at += n * dt.itemsize
    return out


# Roles of a document: counted, held out for the weights, held out altogether.
BUILD, TUNE, HELD = 0, 1, 2
BATCH = "batch bigint, tune boolean, ids binary, roles binary, sizes binary, words binary, n_words bigint, tokens binary, n_tokens bigint"


def _batches(batches):
    """``doc_id, role, text`` rows to batch rows (tuning documents apart)."""
    from pyspark import TaskContext
    serial = TaskContext.get().partitionId() << 24
    for whole in batches:
        bounds = text_arrays(whole.column(2))
        for first, last, data, offsets in chunks(*bounds, BATCH_BYTES, 1 << 20):
            ids, role = whole.column(0).slice(first, last - first), whole.column(1).to_numpy()[first:last]
            hashes, sizes = [], np.zeros(last - first, dtype=np.int64)
            for i, j, d, o in chunks(data, offsets):
                low = LOWER[d]
                s, e, doc = word_spans(low, o)
                h = span_hash(prefix_hash(low), s, e) if s.size else np.zeros(0, U64)
                # An end token after each document's words.
                out = np.full(h.size + j - i, END, dtype=U64)
                out[np.arange(h.size) + doc] = h
                hashes.append(out)
                sizes[i:j] = np.bincount(doc, minlength=j - i) + 1
            h = np.concatenate(hashes)
            for tune in (False, True):
                docs = np.flatnonzero((role == TUNE) == tune)
                if not docs.size:
                    continue
                mine = h[np.repeat((role == TUNE) == tune, sizes)]
                words, tokens = np.unique(mine, return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "batch": pa.array([serial], pa.int64()), "tune": [tune],
                    "ids": [_ids(ids, docs)],
                    "roles": [role[docs].astype(np.int8).tobytes()], "sizes": [sizes[docs].tobytes()],
                    "words": [words.tobytes()], "n_words": pa.array([words.size], pa.int64()),
                    "tokens": [_squeeze(tokens.astype(np.uint32))], "n_tokens": pa.array([mine.size], pa.int64())})
                serial += 1


def _ids(ids: pa.Array, docs: np.ndarray) -> bytes:
    """Ids as int64 with a validity byte each."""
    part = ids.take(pa.array(docs))
    known = np.array(part.is_valid())
    return part.fill_null(0).to_numpy().tobytes() + known.astype(np.int8).tobytes()


class _Batch:
    """A batch row, unpacked: positions hold a begin mark before each
    document's tokens."""

    def __init__(self, row: dict):
        self.roles = np.frombuffer(row["roles"], np.int8)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        n = len(self.roles)
        self.ids = np.frombuffer(row["ids"], np.int64, n)
        self.known = np.frombuffer(row["ids"], np.int8, n, 8 * n).astype(bool)
        words = np.frombuffer(row["words"], U64)
        tokens, = _unsqueeze(row["tokens"], row["n_tokens"], "u4")
        self.doc = np.repeat(np.arange(n), self.sizes)          # of each token
        self.at = np.arange(tokens.size) + self.doc + 1         # its position
        self.place = self.at - (np.cumsum(self.sizes) - self.sizes + np.arange(n))[self.doc]  # 1 = first token
        self.hash = np.full(tokens.size + n, BEGIN, dtype=U64)
        self.hash[self.at] = words[tokens]

    def codes(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens that end an n-gram of ``order`` within begin mark and end,
        and the n-grams' codes (64 bits for words, else 48)."""
        has = np.flatnonzero(self.place >= order - 1)
        at = self.at[has]
        if order == 1:
            return has, self.hash[at]
        h = self.hash[at - order + 1]
        for k in range(order - 2, -1, -1):
            h = mix(h * _FOLD + self.hash[at - k])
        return has, h >> U64(16)


def _bucket(code: np.ndarray, order: int, buckets: int) -> np.ndarray:
    top = code >> U64(32 if order == 1 else 16)
    return ((top * U64(buckets)) >> U64(32)).astype(np.int64)


def _ask(order_max: int, buckets: int):
    """Batch rows to count requests: distinct n-grams in code order, with
    their counts in this batch's counted and tuning documents.  A batch whose
    texts are all empty asks for no n-grams beyond single tokens."""
    def run(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            b = _Batch(row)
            for order in range(1, order_max + 1):
                has, code = b.codes(order)
                if not has.size:
                    continue
                by = np.argsort(code, kind="stable")
                s = code[by]
                first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
                role = b.roles[b.doc[has[by]]]
                built = np.add.reduceat((role == BUILD).astype(np.int64), first)
                tuned = np.add.reduceat((role == TUNE).astype(np.int64), first)
                s = s[first]
                where = _bucket(s, order, buckets)
                cuts = np.append(np.flatnonzero(np.append(True, where[1:] != where[:-1])), where.size)
                blobs = []
                for x, y in zip(cuts[:-1], cuts[1:]):
                    code_bytes = s[x:y].view(np.uint8).reshape(-1, 8)[:, :8 if order == 1 else 6]
                    blobs.append(_squeeze(code_bytes, built[x:y].astype(np.uint32), tuned[x:y].astype(np.uint32)))
                m = len(blobs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where[cuts[:-1]] * 16 + order, pa.int64()), pa.array([row["batch"]] * m, pa.int64()),
                     pa.array([row["tune"]] * m, pa.bool_()), pa.array(np.diff(cuts), pa.int64()),
                     pa.array(blobs, pa.binary())], names=["slot", "batch", "tune", "n", "blob"])
    return run


_KIND = ("i8", "u4")        # counts of words, of longer n-grams
ANSWER = "slot bigint, batch bigint, tune boolean, n bigint, blob binary, built bigint, tuned bigint, distinct bigint"


def _answer(batches):
    """Requests sorted by slot (bucket and order) to answers, plus one row of
    totals per slot of words (batch -1)."""
    def settle(slot, rows):
        order = slot % 16
        got = [_unsqueeze(r[3], r[2], "u8" if order == 1 else "V6", "u4", "u4") for r in rows]
        if order > 1:
            for g in got:
                code = np.zeros((len(g[0]), 8), np.uint8)
                code[:, :6] = g[0].view(np.uint8).reshape(-1, 6)
                g[0] = code.view(U64).ravel()
        code = np.concatenate([g[0] for g in got])
        u, inv = np.unique(code, return_inverse=True)
        built, tuned = (np.bincount(inv, np.concatenate([g[k] for g in got]), len(u)).astype(np.int64) for k in (1, 2))
        both, kind = built + tuned, _KIND[order > 1]
        out, at = [], 0
        for r in rows:
            i = inv[at:at + r[2]]
            at += r[2]
            # Only tuning batches need to know the counts without them.
            mine = [x[i].astype(kind) for x in ((both, built) if r[1] else (both,))]
            out.append((slot, r[0], r[1], r[2], _squeeze(*mine), None, None, None))
        if order == 1:
            out.append((slot, -1, None, 0, None, int(built.sum()), int(tuned.sum()), int((both > 0).sum())))
        cols = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["slot", "batch", "tune", "n", "blob", "built", "tuned", "distinct"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    held, slot = [], None
    for batch in batches:
        slots = batch.column(0).to_pylist()
        for i, here in enumerate(slots):
            if held and here != slot:
                yield settle(slot, held)
                held = []
            slot = here
            held.append([batch.column(k)[i].as_py() for k in (1, 2, 3, 4)])
    if held:
        yield settle(slot, held)


class Totals:
    """Corpus totals: tokens and documents of the counted part and of all
    training documents, distinct training words."""

    def __init__(self, built: int, tuned: int, distinct: int, built_docs: int, tuned_docs: int):
        self.built, self.train, self.distinct = built, built + tuned, distinct
        self.built_docs, self.train_docs = built_docs, built_docs + tuned_docs


def _estimates(b: _Batch, answers: list, order_max: int, t: Totals, tuning: bool):
    """Per token: training count of the word, the estimates of order
    ``0..order_max`` and the bucket of the longest context's count.  While
    ``tuning`` the estimates leave the tuning documents out."""
    n = b.doc.size
    n_tokens, n_docs = (t.built, t.built_docs) if tuning else (t.train, t.train_docs)
    mine = {k: sorted((a["slot"], a["n"], a["tune"], a["blob"]) for a in answers if a["slot"] % 16 == k)
            for k in range(1, order_max + 1)}
    probs = np.zeros((order_max + 1, n))
    probs[0] = 1.0 / (t.distinct + 1)
    # Counts of the n-gram that ends at each position, begin marks included.
    ends = np.zeros(b.hash.size, dtype=np.int64)
    train = None
    for order in range(1, order_max + 1):
        has, code = b.codes(order)
        got = [_unsqueeze(blob, m, *[_KIND[order > 1]] * (2 if tune else 1)) for _, m, tune, blob in mine[order]]
        _, inv = np.unique(code, return_inverse=True)
        counts = [np.concatenate([g[k] for g in got]).astype(np.int64)[inv] if got else np.zeros(0, np.int64)
                  for k in ((0, -1) if tuning else (0, 0))]
        seen = counts[1]
        if order == 1:
            train = counts[0]
            probs[1] = seen / n_tokens if n_tokens else 0.0
            context = np.full(n, n_tokens)
        else:
            context = np.zeros(n, dtype=np.int64)
            context[has] = ends[b.at[has] - 1]
            with np.errstate(divide="ignore", invalid="ignore"):
                probs[order, has] = np.where(context[has] > 0, seen / context[has], 0.0)
        # What this order counts is the next order's context.
        ends = np.zeros(b.hash.size, dtype=np.int64)
        ends[b.at[has]] = seen
        if order == 1:
            ends[b.at[b.place == 1] - 1] = n_docs
    bucket = np.minimum(np.frexp(context.astype(float))[1], CONTEXT_BUCKETS - 1)
    return train, probs, bucket


def _meet(batches: DataFrame, answers: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(batch, answers)`` for every batch with all its answers: both are
    dealt by the batch's number and sorted, so a task holds one batch."""
    spark = batches.sparkSession
    null = lambda name, kind: F.lit(None).cast(kind).alias(name)
    answer = [("slot", "bigint"), ("n", "bigint"), ("blob", "binary")]
    batch = [c.split() for c in BATCH.split(", ") if not c.startswith(("batch ", "tune "))]
    rows = batches.select("batch", F.lit(0).alias("part"), "tune", *[null(*c) for c in answer], *[c for c, _ in batch])
    rows = rows.unionByName(answers.where(F.col("batch") >= 0).select(
        "batch", F.lit(1).alias("part"), "tune", *[c for c, _ in answer], *[null(*c) for c in batch]))
    parts = shuffle_partitions(spark)
    # Batches of a task are numbered in a row: deal them like cards.
    place = F.pmod(F.shiftrightunsigned("batch", 24) + (F.col("batch").bitwiseAND(F.lit((1 << 24) - 1))) * 7919, F.lit(parts))
    dealt = rows.repartitionById(parts, place.cast("int")).sortWithinPartitions("batch", "part")

    def run(found):
        head, held = None, []
        for b in found:
            names = b.schema.names
            for i in range(b.num_rows):
                row = {name: b.column(k)[i].as_py() for k, name in enumerate(names)}
                if row["part"] == 0:
                    if head is not None:
                        yield fn(_Batch(head), held)
                    head, held = row, []
                else:
                    held.append({k: row[k] for k in ("slot", "n", "tune", "blob")})
        if head is not None:
            yield fn(_Batch(head), held)

    return dealt.mapInArrow(run, schema)


def _histogram(order: int, totals: Totals):
    """Tuning tokens by bucket and quantised estimates (bin ``BINS``: zero)."""
    def one(b: _Batch, answers: list):
        _, probs, bucket = _estimates(b, answers, order, totals, tuning=True)
        cell = bucket.astype(np.int64)
        for k in range(1, order + 1):
            p = probs[k]
            bin_ = np.full(p.size, BINS)
            ok = p > 0
            bin_[ok] = np.minimum(np.rint(-np.log2(p[ok])), BINS - 1)
            cell = cell * (BINS + 1) + bin_
        u, n = np.unique(cell, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(n.astype(np.int64))], names=["cell", "n"])
    return one


def learn_weights(cells: np.ndarray, counts: np.ndarray, order: int, uniform: float,
                  rounds: int = EM_ROUNDS) -> np.ndarray:
    """Mixture weights (context buckets x orders) by expectation-maximisation
    over a histogram of held-out tokens; buckets without any take the weights
    of the nearest bucket below that has some (or a flat mixture)."""
    bins = [cells // (BINS + 1) ** (order - k) % (BINS + 1) for k in range(1, order + 1)]
    bucket = cells // (BINS + 1) ** order
    p = np.vstack([np.full(len(cells), uniform), *[np.where(b == BINS, 0.0, 2.0 ** -b) for b in bins]])
    weights = np.full((CONTEXT_BUCKETS, order + 1), 1.0 / (order + 1))
    seen = np.zeros(CONTEXT_BUCKETS, dtype=bool)
    seen[np.unique(bucket)] = True
    for _ in range(rounds if len(cells) else 0):
        share = weights[bucket].T * p
        share *= counts / share.sum(axis=0)
        for k in range(order + 1):
            weights[:, k] = np.where(seen, np.bincount(bucket, share[k], CONTEXT_BUCKETS), weights[:, k])
        # A little of every estimate stays, so no text has probability 0.
        weights[seen] += 1e-6
        weights /= weights.sum(axis=1, keepdims=True)
    last = None
    for i in range(CONTEXT_BUCKETS):
        last = weights[i].copy() if seen[i] else last
        if not seen[i] and last is not None:
            weights[i] = last
    return weights


def _score(order: int, totals: Totals, weights: np.ndarray):
    def one(b: _Batch, answers: list):
        train, probs, bucket = _estimates(b, answers, order, totals, tuning=False)
        starts = np.cumsum(b.sizes) - b.sizes
        mixed = (weights[bucket].T * probs).sum(axis=0)
        base = np.log10((train + 1) / (totals.train + (totals.distinct + 1)))
        return pa.RecordBatch.from_arrays(
            [pa.array(b.ids, mask=~b.known), pa.array(b.roles == HELD), pa.array(b.sizes),
             pa.array(np.add.reduceat((train > 0).astype(np.int64), starts)),
             pa.array(np.full(len(starts), totals.train)),
             pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(np.log10(mixed), starts))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return one


SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def interpolated_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER,
                        folds: int = FOLDS, held_fold: int = HELD_FOLD, tune_part: int = TUNE_PART) -> DataFrame:
    """Per row ``key, held_out, n_tokens, n_known, train_tokens, base_score,
    score``: the add-one unigram score and the model's log10 probability of
    the whole text, learned from the rows whose fold is not ``held_fold``.

    Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end
    token.  The mixture weights are learned from one training document in
    ``tune_part`` (by its fold hash) against counts without these; scores
    count all training documents.

    Edge cases: a NULL or wordless text is its end token.  A NULL id is not
    learned from (``held_out`` true).  Repeated rows count and score each.
    Without training text every word has count 0 and the uniform estimate is
    1; without tuning documents the mixture is flat.  Other columns are
    ignored; an empty table gives no rows.
    """
    return _scores(docs, key, text, order, folds, held_fold, tune_part).withColumnRenamed("doc_id", key)


def _scores(docs: DataFrame, key: str, text: str, order: int, folds: int, held_fold: int, tune_part: int,
            weights: np.ndarray | None = None) -> DataFrame:
    """The scores, with ``weights`` learned unless given."""
    spark = docs.sparkSession
    crc = F.crc32(F.col(key).cast("string"))
    role = (F.when(F.col(key).isNull() | (fold(key, folds) == held_fold), HELD)
            .when(F.floor(crc / folds) % tune_part == 0, TUNE).otherwise(BUILD).cast("int"))
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), role.alias("role"), F.col(text).alias("text"))
    batches = materialize(rows.mapInArrow(_batches, BATCH), "batches")
    tokens = batches.agg(F.sum("n_tokens")).first()[0] or 0
    parts = shuffle_partitions(spark)
    per_task = max(1, -(-tokens * order // (BUCKET_NGRAMS * parts)))
    buckets = parts * per_task          # as many for each task, in a row
    asked = arrow_map(batches, _ask(order, buckets), "slot bigint, batch bigint, tune boolean, n bigint, blob binary")
    answers = materialize(
        asked.repartitionById(parts, F.floor(F.col("slot") / (16 * per_task)).cast("int")).sortWithinPartitions("slot")
        .mapInArrow(_answer, ANSWER), "answers")

    t = answers.where(F.col("batch") < 0).agg(F.sum("built"), F.sum("tuned"), F.sum("distinct")).first()
    docs_of = {r["role"]: r["n"] for r in rows.groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = Totals(int(t[0] or 0), int(t[1] or 0), int(t[2] or 0), docs_of.get(BUILD, 0), docs_of.get(TUNE, 0))
    if weights is None:
        cells = (_meet(batches.where("tune"), answers.where("tune"), _histogram(order, totals), "cell bigint, n bigint")
                 .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
        weights = learn_weights(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(float), order,
                                1.0 / (totals.distinct + 1))
    return _meet(batches, answers, _score(order, totals, weights), SCORES)
