"""Language identification with a linear-chain conditional random field.

Words of a text are labelled with languages; a word's features are its affixes
(one to three bytes at either end), byte n-grams and the languages whose
lexicon lists it, and the transitions between labels are learned with them, so
code-switched text is labelled word by word.  Forward-backward gives every word
its label probabilities; a document's language is the one with the largest
share of them, and that share is the score.

The field is fitted on a bounded sample: for each language ``PER_LANG``
training documents (least id hash), one run of ``RUN`` words of each at a
hash-chosen place.  Runs of different languages are spliced into training
sequences, so that transitions are seen.  Labelling is one pass without a
shuffle; documents of a batch step together through forward and backward.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import arrow_map, fold, least_hashed
from bigraph.llm.kernels import LOWER, U64, chunks, mix, prefix_hash, span_hash, text_arrays

FOLDS, HELD_FOLD = 3, 1
PER_LANG = 300              # training documents per language
RUN = 60                    # words taken of each
LEXICON = 400               # most frequent sample words of each language
BITS = 16                   # hashed features
EPOCHS = 6
UNKNOWN = "und"
STEP_BYTES = 1 << 23        # text whose documents step together

# Words are runs of ASCII letters and bytes beyond ASCII.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and two-byte Latin capitals in lower case."""
    low = LOWER[data]
    if (data >= 128).any():
        at = np.flatnonzero(data[:-1] == 0xC3) + 1
        at = at[(data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97)]
        low[at] += 0x20
    return low


def letter_words(data: np.ndarray, offsets: np.ndarray):
    """Start, end and document of every run of letter bytes."""
    n = data.size
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    inside = _LETTER[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:n] | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_features(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int = BITS):
    """Hashed features of words: ``(feature, word)`` pairs sorted by word."""
    shift = U64(64 - bits)
    word = np.arange(len(starts))
    feats, of = [], []

    def add(kind, s, e, w):
        h = span_hash(prefix, s, e) + U64(kind * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        feats.append((mix(h) >> shift).astype(np.int32))
        of.append(w)

    add(0, starts, ends, word)
    for k in (1, 2, 3):
        add(k, starts, np.minimum(starts + k, ends), word)
        add(3 + k, np.maximum(ends - k, starts), ends, word)
    for k in (2, 3, 4):
        count = np.maximum(ends - starts - k + 1, 0)
        w = np.repeat(word, count)
        s = np.repeat(starts - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
        add(6 + k, s, s + k, w)
    feats, of = np.concatenate(feats), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return feats[order], of[order]


@dataclass
class Field:
    langs: list[str]
    weights: np.ndarray         # features x labels
    lexicon: np.ndarray         # sorted word hashes
    listed: np.ndarray          # lexicon x languages, which list the word
    lex_weights: np.ndarray     # languages x labels
    bias: np.ndarray
    transition: np.ndarray      # labels x labels, log potentials
    bits: int = BITS

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros((len(hashes), self.lex_weights.shape[0]))
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return self.listed[at] * (self.lexicon[at] == hashes)[:, None]

    def emissions(self, prefix, starts, ends, hashes) -> np.ndarray:
        """Label potentials (log) of words."""
        feats, of = word_features(prefix, starts, ends, self.bits)
        first = np.searchsorted(of, np.arange(len(starts)))
        count = np.diff(np.append(first, len(of)))
        out = np.add.reduceat(self.weights[feats], first, axis=0) / np.sqrt(count)[:, None]
        return out + self.lookup(hashes) @ self.lex_weights + self.bias


def forward_backward(emission: np.ndarray, sizes: np.ndarray, transition: np.ndarray):
    """Label probabilities of the words of several sequences (laid end to
    end, ``sizes`` words each), stepping all sequences together; also the
    expected transitions summed, and the log partition sum."""
    labels = emission.shape[1]
    order = np.argsort(-sizes, kind="stable")
    steps = int(sizes.max()) if len(sizes) else 0
    live = np.searchsorted(-sizes[order], -np.arange(steps), side="left")      # sequences longer than t
    begin = np.append(0, np.cumsum(live))
    rank = np.empty(len(sizes), dtype=np.int64)
    rank[order] = np.arange(len(sizes))
    seq = np.repeat(np.arange(len(sizes)), sizes)
    t = np.arange(len(seq)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = begin[t] + rank[seq]                   # time-major layout
    top = emission.max(axis=1)
    e = np.empty((len(seq), labels))
    e[place] = np.exp(emission - top[:, None])
    m = np.exp(transition)
    alpha, scale = np.empty_like(e), np.empty(len(seq))
    for i in range(steps):
        a = e[begin[i]:begin[i + 1]]
        if i:
            a = a * (alpha[begin[i - 1]:begin[i - 1] + live[i]] @ m)
        s = a.sum(axis=1)
        alpha[begin[i]:begin[i + 1]] = a / s[:, None]
        scale[begin[i]:begin[i + 1]] = s
    post = alpha.copy()
    pair = np.zeros((labels, labels))
    beta = np.ones((0, labels))
    for i in range(steps - 1, 0, -1):
        back = np.ones((live[i], labels))
        back[:len(beta)] = beta                    # those that go on beyond i
        s = slice(begin[i], begin[i + 1])
        right = e[s] * back / scale[s][:, None]
        left = alpha[begin[i - 1]:begin[i - 1] + live[i]]
        pair += m * (left.T @ right)
        beta = right @ m.T
        post[begin[i - 1]:begin[i - 1] + live[i]] = left * beta
    return post[place], pair, float(np.log(scale).sum() + top.sum())


def splice(labels: np.ndarray, runs: list[np.ndarray], rng) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training sequences: a whole run, or pieces of up to three runs one
    after another (code-switched)."""
    out = []
    for i in rng.permutation(len(runs)):
        pieces, tags = [], []
        k = int(rng.integers(1, 4)) if rng.random() < 0.5 else 1
        for j in [i, *rng.integers(0, len(runs), k - 1)]:
            run = runs[j]
            take = run if k == 1 else run[(s := int(rng.integers(0, max(1, len(run) // 2)))):s + int(rng.integers(3, 25))]
            pieces.append(take)
            tags.append(np.full(len(take), labels[j]))
        out.append((np.concatenate(pieces), np.concatenate(tags)))
    return out


def train(texts: list[bytes], tags: list[str], bits: int = BITS, lexicon: int = LEXICON, epochs: int = EPOCHS,
          rate: float = 0.3, seed: int = 5) -> Field:
    """Fit a field to runs of words (space-joined bytes) of known language by
    AdaGrad on the sequences' log-likelihood."""
    langs = sorted(set(tags))
    n = len(langs)
    rng = np.random.default_rng(seed)
    data = lowered(np.frombuffer(b"".join(texts), np.uint8))
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    starts, ends, doc = letter_words(data, offsets)
    field = Field(langs, np.zeros((1 << bits, n)), np.zeros(0, U64), np.zeros((0, n)), np.zeros((n, n)),
                  np.zeros(n), np.zeros((n, n)), bits)
    if not len(starts) or n < 2:
        return field
    y = np.array([langs.index(t) for t in tags])
    prefix = prefix_hash(data)
    hashes = span_hash(prefix, starts, ends)
    words, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    counts = np.zeros((len(words), n))
    np.add.at(counts, (inverse, y[doc]), 1)
    listed = np.zeros((len(words), n), dtype=bool)
    for k in range(n):
        best = np.argsort(-counts[:, k], kind="stable")[:lexicon]
        listed[best[counts[best, k] > 1], k] = True
    keep = listed.any(axis=1)
    field.lexicon, field.listed = words[keep], listed[keep].astype(float)
    feats, of = word_features(prefix, starts[first], ends[first], bits)
    at = np.append(np.searchsorted(of, np.arange(len(words))), len(of))
    norm = 1 / np.sqrt(np.diff(at))
    look = field.lookup(words)
    runs = [inverse[a:b] for a, b in zip(np.searchsorted(doc, np.arange(len(texts))),
                                          np.searchsorted(doc, np.arange(len(texts)), side="right"))]
    some = [i for i, r in enumerate(runs) if len(r)]
    runs, y = [runs[i] for i in some], y[some]
    params = [field.weights, field.lex_weights, field.bias, field.transition]
    sums = [np.full(p.shape, 1e-6) for p in params]
    for _ in range(epochs):
        seqs = splice(y, runs, rng)
        for i in range(0, len(seqs), 32):
            w = np.concatenate([s for s, _ in seqs[i:i + 32]])
            t = np.concatenate([g for _, g in seqs[i:i + 32]])
            sizes = np.array([len(s) for s, _ in seqs[i:i + 32]])
            u, inv = np.unique(w, return_inverse=True)
            span = np.repeat(at[u] - np.append(0, np.cumsum(at[u + 1] - at[u])[:-1]), at[u + 1] - at[u])
            f = feats[span + np.arange(len(span))]
            lead = np.append(0, np.cumsum(at[u + 1] - at[u])[:-1])
            emit = np.add.reduceat(field.weights[f], lead, axis=0) * norm[u][:, None] + look[u] @ field.lex_weights + field.bias
            post, pair, _ = forward_backward(emit[inv], sizes, field.transition)
            diff = -post
            diff[np.arange(len(t)), t] += 1
            by_word = np.zeros((len(u), n))
            np.add.at(by_word, inv, diff)
            inner = np.ones(len(t), dtype=bool)
            inner[np.cumsum(sizes) - 1] = False
            seen = np.zeros((n, n))
            np.add.at(seen, (t[:-1][inner[:-1]], t[1:][inner[:-1]]), 1)
            fu, finv = np.unique(f, return_inverse=True)
            g = np.zeros((len(fu), n))
            np.add.at(g, finv, np.repeat(by_word * norm[u][:, None], at[u + 1] - at[u], axis=0))
            sums[0][fu] += g * g
            field.weights[fu] += rate * g / np.sqrt(sums[0][fu])
            for k, grad in ((1, look[u].T @ by_word), (2, diff.sum(axis=0)), (3, seen - pair)):
                sums[k] += grad * grad
                params[k] += rate * grad / np.sqrt(sums[k])
    return field


def _runs(run: int):
    """``lang, id hash, text`` to one run of words each (space-joined)."""
    def step(batch: pa.RecordBatch):
        draw = batch.column(1).to_numpy()
        data, offsets = text_arrays(batch.column(2))
        out = []
        for i, j, d, o in chunks(data, offsets):
            starts, ends, doc = letter_words(d, o)
            cut = np.searchsorted(doc, np.arange(j - i + 1))
            raw = d.tobytes()
            for k in range(j - i):
                a, b = cut[k], cut[k + 1]
                at = a + int(draw[i + k] % max(1, b - a - run + 1))
                out.append(b" ".join(raw[starts[w]:ends[w]] for w in range(at, min(at + run, b))) + b"\n")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                         names=["lang", "draw", "run"])
    return step


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = FOLDS,
        held_fold: int = HELD_FOLD, per_lang: int = PER_LANG, run: int = RUN, **settings) -> Field:
    """A field from the rows with a language outside the held-out fold."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (fold(key, folds) != held_fold)).select(
        F.col(lang).alias("lang"), F.xxhash64(key).alias("h"), F.col(key).cast("bigint").alias("id"))
    chosen = least_hashed(known, per_lang, "lang")
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    # One row per id, should the table repeat it: the sample stays bounded.
    picked = (rows.join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text"))
              .select("lang", F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 40)).alias("draw"), "text"))
    got = arrow_map(picked, _runs(run), "lang string, draw bigint, run binary").toArrow()
    rows = sorted(zip(got.column("lang").to_pylist(), got.column("draw").to_pylist(), got.column("run").to_pylist()))
    return train([r for _, _, r in rows], [x for x, _, _ in rows], **settings)


def label_words(field: Field, data: np.ndarray, offsets: np.ndarray):
    """Words of documents and their label probabilities: ``starts, ends,
    document, probabilities``."""
    n = len(field.langs)
    parts = []
    for i, _, d, o in chunks(data, offsets):
        low = lowered(d)
        starts, ends, doc = letter_words(low, o)
        if not len(starts):
            continue
        prefix = prefix_hash(low)
        h = span_hash(prefix, starts, ends)
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        emit = field.emissions(prefix, starts[first], ends[first], h[first])[inverse]
        parts.append((starts + offsets[i], ends + offsets[i], doc + i, emit.astype(np.float32)))
    if not parts or not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, np.zeros((0, n))
    starts, ends, doc, emit = (np.concatenate(x) for x in zip(*parts))
    del parts
    docs, sizes = np.unique(doc, return_counts=True)
    post, _, _ = forward_backward(emit, sizes, field.transition)
    return starts, ends, doc, post


def _predict(field: Field):
    def run(batch: pa.RecordBatch):
        texts = batch.column(2)
        data, offsets = text_arrays(texts)
        n = len(field.langs)
        for i, j, d, o in chunks(data, offsets, STEP_BYTES, 1 << 20):
            starts, _, doc, post = label_words(field, d, o)
            share = np.stack([np.bincount(doc, post[:, k], j - i) for k in range(n)], axis=1) if n else np.zeros((j - i, 0))
            words = np.bincount(doc, minlength=j - i)
            # Runs of bytes beyond ASCII need not hold a letter.
            ascii_letter = np.bincount(doc, ((d[starts] < 128) if len(starts) else starts), j - i) > 0
            for k in np.flatnonzero((words > 0) & ~ascii_letter):
                if not any(c.isalpha() for c in texts[int(i + k)].as_py()):
                    words[k] = 0
            known = (words > 0) & (n > 0)
            best = share.argmax(axis=1) if n else np.zeros(j - i, int)
            score = np.where(known, (share.max(axis=1) if n else 0) / np.maximum(words, 1), 0.0)
            lang = [field.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(lang, pa.string()),
                 pa.array(np.clip(score, 0.0, 1.0))], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def languages(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text", folds: int = FOLDS,
              held_fold: int = HELD_FOLD) -> DataFrame:
    """Per row ``key, held_out, lang_pred, score`` from the whole text alone.

    Edge cases: a NULL text or one without a letter is ``und`` with score 0;
    so is any text when nothing could be learned.  A NULL id is held out.
    Repeated rows are labelled each; other columns are ignored; an empty table
    gives no rows.
    """
    held = F.coalesce(fold(key, folds) == held_fold, F.lit(True))
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(field)    # 2**bits x languages weights

    def run(batches):
        one = _predict(shared.value)
        for b in batches:
            yield from one(b)

    out = rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
    return out if key == "doc_id" else out.withColumnRenamed("doc_id", key)


def _spans(field: Field):
    def run(batch: pa.RecordBatch):
        data, offsets = text_arrays(batch.column(1))
        for i, j, d, o in chunks(data, offsets, STEP_BYTES, 1 << 20):
            starts, ends, doc, post = label_words(field, d, o)
            if not len(starts):
                continue
            tag = post.argmax(axis=1)
            first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
            last = np.append(first[1:], len(tag)) - 1
            at = o[doc[first]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc[first] + i)), pa.array(starts[first] - at), pa.array(ends[last] - at),
                 pa.array([field.langs[t] for t in tag[first]], pa.string())], names=["doc_id", "start", "end", "lang"])
    return run


def language_spans(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of words of one language: ``key, start, end`` (bytes), ``lang``."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    out = arrow_map(rows, _spans(field), "doc_id bigint, start bigint, end bigint, lang string")
    return out if key == "doc_id" else out.withColumnRenamed("doc_id", key)
