"""Importance resampling towards a target distribution by bit-sliced counts.

Documents and target texts are bags of hashed n-grams.  A bucket's *gain* is
the scaled log ratio of its smoothed shares in target and corpus; a document's
weight is the mean gain of its n-grams, and Gumbel noise from its id turns the
weights into a sample without replacement (the highest scores).

How it runs.  One pass over the texts writes each document's bucket counts as
*bit planes*: plane ``i`` has one bit per bucket, set where bit ``i`` of the
count is set.  The corpus totals are column sums of these planes, added up per
task before they are shuffled.  The gains are sliced the same way into
two's-complement planes.  The sum of gains over a document is then

    sum over i, j of  2**(i + j) * popcount(count plane i AND gain plane j)

(the top gain plane counting negative): whole-word operations, exact integers.
The texts are read once; the drawn ranks come from range partitions and prefix
sums, so the draw is never in one task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import arrow_map, discard, materialize, with_rank
from bigraph.llm.kernels import LOWER, chunks, text_arrays

BUCKETS = 10_000
MAX_RUN = 1                 # features: runs of 1 to so many consecutive words
SCALE = 1000                # of logarithms, which are floored to integers
SEED = "2024"
MIN_WORDS = 20              # shorter documents are not drawn
DRAW_PERCENT = 10
PLANE_DOCS = 256            # documents whose planes are built at once
_LONG = 48                  # bytes; longer features take the library's CRC

# Bytes that separate words (all other bytes belong to one).
_GAP = np.zeros(256, dtype=bool)
_GAP[0x00:0x30] = _GAP[0x3A:0x61] = _GAP[0x7B:0x80] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def span_crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every byte span, one byte position of all spans at a time."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    s, n = starts[order], size[order]
    out = np.full(s.size, 0xFFFFFFFF, dtype=np.uint32)
    long = int(np.count_nonzero(n > _LONG))
    for k in range(long):
        out[k] = zlib.crc32(data[s[k]:s[k] + n[k]]) ^ 0xFFFFFFFF
    for p in range(int(n[long]) if long < n.size else 0):
        m = int(np.searchsorted(-n, -p, side="left"))       # spans longer than p come first
        part = out[long:m]
        out[long:m] = _CRC[(part ^ data[s[long:m] + p]) & np.uint32(255)] ^ (part >> np.uint32(8))
    back = np.empty(out.size, dtype=np.uint32)
    back[order] = out ^ np.uint32(0xFFFFFFFF)
    return back


def features(data: np.ndarray, offsets: np.ndarray, max_run: int = MAX_RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and CRC-32 of every feature, and the words per document."""
    n_docs = len(offsets) - 1
    low = LOWER[data]
    word = ~_GAP[low]
    edge = np.zeros(data.size + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate(([False], word[:-1]))))
    ends = np.flatnonzero(word & (edge[1:] | ~np.concatenate((word[1:], [False])))) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    words = np.bincount(doc, minlength=n_docs)
    if max_run == 1:
        return doc, span_crc32(low, starts, ends), words
    # Words joined by one space each: a run is then one span of bytes.
    size = ends - starts
    at = np.concatenate(([0], np.cumsum(size + 1)))
    joined = np.full(int(at[-1]), 32, dtype=np.uint8)
    joined[np.repeat(at[:-1] - starts, size) + np.flatnonzero(word)] = low[word]
    docs, crcs = [], []
    for run in range(1, max_run + 1):
        m = max(0, starts.size - run + 1)
        same = np.flatnonzero(doc[:m] == doc[run - 1:run - 1 + m])
        docs.append(doc[same])
        crcs.append(span_crc32(joined, at[same], at[same + run] - 1))
    return np.concatenate(docs), np.concatenate(crcs), words


def plane_bytes(buckets: int) -> int:
    """Bytes of a plane: one bit per bucket, in whole 64-bit words."""
    return -(-buckets // 64) * 8


def count_planes(doc: np.ndarray, bucket: np.ndarray, n_docs: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bit planes of all documents, one below the other (those of a
    document by rising bit), and the number of planes per document."""
    width = plane_bytes(buckets)
    cell, count = np.unique(doc * buckets + bucket, return_counts=True)
    doc, bucket = cell // buckets, cell % buckets
    most = np.zeros(n_docs, dtype=np.int64)
    np.maximum.at(most, doc, count)
    depth = np.frexp(most.astype(float))[1].astype(np.int64)
    first = np.cumsum(depth) - depth
    planes = np.zeros(int(depth.sum()) * width, dtype=np.uint8)
    byte, bit = bucket >> 3, np.left_shift(1, bucket & 7)
    for i in range(int(depth.max()) if n_docs else 0):
        has = np.flatnonzero((count >> i) & 1)
        place = (first[doc[has]] + i) * width + byte[has]
        # Cells are sorted, so those of one byte lie together.
        run = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if has.size else has
        if has.size:
            planes[place[run]] = np.bitwise_or.reduceat(bit[has], run)
    return planes.reshape(-1, width), depth


PLANES = "row bigint, key bigint, n_features bigint, n_words bigint, planes binary"


def _to_planes(buckets: int, max_run: int):
    def run(batch: pa.RecordBatch):
        for i, j, d, o in chunks(*text_arrays(batch.column(2)), max_docs=PLANE_DOCS):
            doc, crc, words = features(d, o, max_run)
            planes, depth = count_planes(doc, crc.astype(np.int64) % buckets, j - i, buckets)
            raw, ends = planes.tobytes(), np.cumsum(depth) * planes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                 pa.array(np.bincount(doc, minlength=j - i).astype(np.int64)), pa.array(words.astype(np.int64)),
                 pa.array([raw[a:b] for a, b in zip(ends - depth * planes.shape[1], ends)], pa.binary())],
                names=["row", "key", "n_features", "n_words", "planes"])
    return run


def planes_of(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
              max_run: int = MAX_RUN) -> DataFrame:
    """Per row ``row, key, n_features, n_words, planes``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("key"),
                       F.col(text).alias("text"))
    return arrow_map(rows, _to_planes(buckets, max_run), PLANES)


def _stacked(column: pa.Array, width: int):
    """Slices of a batch's planes: ``first row, last row, planes, depth``."""
    raw, offsets = text_arrays(column)
    for i, j, d, _ in chunks(raw, offsets, 1 << 22, 1 << 14):
        yield i, j, np.ascontiguousarray(d).reshape(-1, width), np.diff(offsets[i:j + 1]) // width


def bucket_totals(planes: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket: column sums of the planes, one vector per task,
    added up by Spark.  The driver gets ``buckets`` numbers."""
    width = plane_bytes(buckets)

    def run(batches):
        total = np.zeros(width * 8, dtype=np.int64)
        for b in batches:
            for _, _, p, depth in _stacked(b.column(0), width):
                bit = np.arange(len(p)) - np.repeat(np.cumsum(depth) - depth, depth)
                for i in range(int(depth.max()) if len(p) else 0):
                    mine = p[bit == i]
                    for k in range(0, len(mine), 1024):
                        total += np.unpackbits(mine[k:k + 1024], axis=1, bitorder="little").sum(axis=0, dtype=np.int64) << i
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["bucket", "n"])

    sums = (planes.select("planes").mapInArrow(run, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(buckets, dtype=np.int64)
    out[sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * ln(...))`` of the smoothed shares' ratio, per bucket."""
    n, s, t = len(corpus), corpus.astype(float), target.astype(float)
    ratio = (t + 1) * (float(corpus.sum()) + n) / ((s + 1) * (float(target.sum()) + n))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def gain_planes(gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two's-complement planes of the gains and the (signed) value of each."""
    bits = max(int(np.abs(gains).max(initial=0)).bit_length(), 1) + 1
    padded = np.zeros(plane_bytes(len(gains)) * 8, dtype=np.int64)
    padded[:len(gains)] = gains
    planes = np.packbits((padded >> np.arange(bits)[:, None]) & 1, axis=1, bitorder="little")
    value = np.left_shift(np.int64(1), np.arange(bits))
    value[-1] *= -1
    return planes, value


def gain_sums(planes: np.ndarray, depth: np.ndarray, gains: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sum of gains of every document, from its stacked count planes."""
    words, slices = planes.view(np.uint64), gains[0].view(np.uint64)
    per_plane = np.zeros(len(words), dtype=np.int64)
    for k in range(0, len(words), 2048):            # slices that stay in the cache
        part = words[k:k + 2048]
        for g, value in zip(slices, gains[1]):
            per_plane[k:k + 2048] += np.bitwise_count(part & g).sum(axis=1, dtype=np.int64) * value
    first = np.cumsum(depth) - depth
    scaled = np.left_shift(per_plane, np.arange(len(words)) - np.repeat(first, depth))
    before = np.concatenate(([0], np.cumsum(scaled)))
    return before[first + depth] - before[first]


def _weigh(gains: tuple[np.ndarray, np.ndarray], width: int):
    def run(batch: pa.RecordBatch):
        n = batch.column(2).to_numpy()
        for i, j, p, depth in _stacked(batch.column(4), width):
            total = gain_sums(p, depth, gains)
            weight = np.where(n[i:j] > 0, total // np.maximum(n[i:j], 1), 0)
            yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(i, j - i) for k in range(4)], pa.array(weight)],
                                             names=["row", "key", "n_features", "n_words", "weight"])
    return run


def gumbel(key: str, seed: str = SEED, scale: int = SCALE) -> Column:
    """``floor(-scale * ln(-ln(u)))`` with ``u`` from the SHA-256 of ``seed:key``."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
              buckets: int = BUCKETS, max_run: int = MAX_RUN, min_words: int = MIN_WORDS,
              draw_percent: int = DRAW_PERCENT, seed: str = SEED) -> DataFrame:
    """Per row ``key, n_features, weight, score, rank``; ``rank`` numbers the
    drawn rows from the highest score (ties to the smaller key) and is NULL
    for all others.  Of the rows with at least ``min_words`` words
    ``draw_percent`` in a hundred are drawn, rounded down.

    Edge cases: a NULL or wordless text has weight 0 and is not drawn unless
    ``min_words`` is 0.  A NULL key takes its noise from the word ``null`` and
    comes after all others in ties.  Repeated rows count, score and rank each,
    in any order among equals.  Without target texts the gains follow the
    corpus alone.  Other columns are ignored; an empty table gives no rows.
    """
    width = plane_bytes(buckets)
    planes = materialize(planes_of(docs, key, text, buckets, max_run), "planes")
    wanted = planes_of(target.select(F.lit(0).alias("_key"), F.col(target_text).alias("_text")), "_key", "_text",
                       buckets, max_run)
    gains = bucket_gains(bucket_totals(planes, buckets), bucket_totals(wanted, buckets))
    weights = arrow_map(planes, _weigh(gain_planes(gains), width),
                        "row bigint, key bigint, n_features bigint, n_words bigint, weight bigint")
    scored = weights.select("row", "key", "n_features", "weight", (F.col("weight") + gumbel("key", seed)).alias("score"),
                            (F.col("n_words") >= min_words).alias("able"))
    # Rows that may be drawn come first; the row number keeps equal rows apart.
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("key"), F.asc("row")]
    ranked = with_rank(scored, order, "place")
    n = ranked.where("able").count()
    discard(planes)
    rank = F.when(F.col("able") & (F.col("place") < draw_percent * n // 100), F.col("place") + 1)
    return ranked.select(F.col("key").alias(key), "n_features", "weight", "score", rank.alias("rank"))
