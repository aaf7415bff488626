"""Quality rules by compression bands.

A text is compressed whole and in fixed chunks (zstandard).  Repetitive text
compresses too well, random characters hardly at all; how much is normal
depends on the length, so the limits do too.  Beside it stand the base counts:
words, symbols, repeated lines and words in repeated 5-word windows.

Limits are learned from the table: every text that passes the base adds its
ratio to the histogram of its length band (a quarter of a factor of two), its
chunks to those of their lengths, and a band's limits lie ``SPREAD`` (chunks:
``CHUNK_SPREAD``) times the distance of the quartiles below and above them.  Fixed
limits stand beside them as a prior that weighs as much as ``PRIOR`` texts and
fades with the square of their number, so a handful of texts decides little and
no size of table switches the rule.  Texts are
compressed in one pass, whose ratios are written; the driver sees one
histogram per band, whose size does not grow with the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import arrow_map, materialize
from bigraph.llm.kernels import (IS_SPACE, SHINGLE, U64, chunks, mix, prefix_hash, span_hash, text_arrays,
                                 window_hash, word_spans)

SYMBOLS = "#*$%&|<>"
LEVEL = 3
CHUNK = 2048                # bytes of a chunk; the last one may be shorter
BAD_CHUNKS = 0.2            # share of chunks outside their band that is still accepted
PER_OCTAVE = 4              # length bands to a factor of two
SPREAD, CHUNK_SPREAD = (2.5, 5.0), (3.0, 6.0)    # below and above: mixed languages reach far above
BINS = 1000                 # histogram bins to a ratio of 1
LEAST = 100                 # texts of a band; one with fewer joins the next shorter one
PRIOR = 40                  # texts that weigh as much as the fixed limits
#: (bytes up to, least ratio, greatest ratio), the prior of the learned limits:
#: under 128 bytes the frame outweighs the text.
BANDS = ((128, 0.0, 3.0), (512, 0.35, 0.98), (2048, 0.25, 0.80), (8192, 0.20, 0.68),
         (float("inf"), 0.15, 0.62))
CHUNK_BANDS = ((CHUNK // 2, 0.0, 3.0), (float("inf"), 0.15, 0.75))
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True


def _band(size: int, bands) -> tuple[float, float]:
    return next((lo, hi) for upto, lo, hi in bands if size < upto)


def learn_bands(length: np.ndarray, bins: np.ndarray, counts: np.ndarray, spread, prior,
                least: int = LEAST, weight: float = PRIOR):
    """``(bytes up to, least ratio, greatest ratio)`` per length band from a
    histogram of ratios by band, each limit averaged with that of ``prior`` at
    the band's length, which weighs as much as ``weight`` texts.  Bands with under
    ``least`` texts join the next shorter one."""
    groups, at = [], []
    for band in np.unique(length)[::-1]:
        at.append(band)
        if counts[np.isin(length, at)].sum() >= least:
            groups.append(at)
            at = []
    if at and groups:
        groups[-1] += at
    elif at:
        groups.append(at)
    if not groups:
        return prior
    out = []
    for group in groups[::-1]:
        mine = np.isin(length, group)
        order = np.argsort(bins[mine], kind="stable")
        value, total = bins[mine][order], np.cumsum(counts[mine][order])
        q1, q3 = (value[np.searchsorted(total, q * total[-1])] / BINS for q in (0.25, 0.75))
        apart = max(q3 - q1, 1 / BINS)
        by = np.argsort(length[mine], kind="stable")
        half = np.searchsorted(np.cumsum(counts[mine][by]), total[-1] / 2)
        lo, hi = _band(2.0 ** ((length[mine][by][half] + 0.5) / PER_OCTAVE), prior)
        share = total[-1] ** 2 / (total[-1] ** 2 + weight ** 2)
        out.append((2.0 ** ((max(group) + 1) / PER_OCTAVE), share * (q1 - spread[0] * apart) + (1 - share) * lo,
                    share * (q3 + spread[1] * apart) + (1 - share) * hi))
    return (*out[:-1], (float("inf"), *out[-1][1:]))


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``n_words, word_chars, n_symbols, n_repeat_words`` per document."""
    n_docs = len(offsets) - 1
    starts, ends, doc = word_spans(data, offsets)
    points = (data & 0xC0) != 0x80              # first bytes of characters
    out = {"n_words": np.bincount(doc, minlength=n_docs),
           "word_chars": _per_document(points & ~IS_SPACE[data], offsets),
           "n_symbols": _per_document(_IS_SYMBOL[data], offsets),
           "n_repeat_words": np.zeros(n_docs, dtype=np.int64)}
    h = window_hash(span_hash(prefix_hash(data), starts, ends)) if starts.size >= SHINGLE else np.zeros(0, U64)
    if h.size:
        d = doc[:h.size]
        at = np.flatnonzero(d == doc[SHINGLE - 1:])
        code = mix(h[at] + mix(d[at].astype(U64) + U64(1)))     # windows of different documents differ
        order = np.argsort(code, kind="stable")
        s = code[order]
        same = np.zeros(s.size + 1, dtype=bool)
        same[1:-1] = s[1:] == s[:-1]
        again = at[order[same[1:] | same[:-1]]]
        cover = np.zeros(doc.size + 1, dtype=np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + SHINGLE, -1)
        out["n_repeat_words"] = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n_docs)
    return out


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(b" \t\n\x0b\x0c\r"):
            seen.add(line)
    return n


def ratios(text: bytes, compressor, chunk: int = CHUNK) -> tuple[float, list[float]]:
    """Compressed over raw size of the text and of each of its chunks."""
    if not text:
        return 0.0, []
    parts = [text[i:i + chunk] for i in range(0, len(text), chunk)]
    return (len(compressor.compress(text)) / len(text), [len(compressor.compress(p)) / len(p) for p in parts])


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
            + ", base_failed boolean, size bigint, ratio double, parts array<double>")
SCHEMA = ("doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
          + ", base_failed boolean, kept boolean, ratio double, bad_chunks double, reason string")


def _measure(chunk, level):
    def run(batch: pa.RecordBatch):
        zstd = zstandard.ZstdCompressor(level=level)
        data, offsets = text_arrays(batch.column(1))
        for i, j, d, o in chunks(data, offsets):
            c = base_counts(d, o)
            raw = d.tobytes()
            dup, whole, parts = [], [], []
            for a, b in zip(o[:-1], o[1:]):
                text = raw[a:b]
                dup.append(repeated_lines(text))
                r, p = ratios(text, zstd, chunk)
                whole.append(r)
                parts.append(p)
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(c["n_words"]), pa.array(c["word_chars"]),
                 pa.array(c["n_symbols"]), pa.array(dup, pa.int64()), pa.array(c["n_repeat_words"]),
                 pa.array(failed), pa.array(np.diff(o).astype(np.int64)), pa.array(whole, pa.float64()),
                 pa.array(parts, pa.list_(pa.float64()))],
                names=["doc_id", *COUNTS, "base_failed", "size", "ratio", "parts"])
    return run


def _limits(measures: DataFrame, chunk: int):
    """The bands of whole texts and of chunks, of the texts that pass the base."""
    last = F.size("parts") - 1
    length = lambda c: F.floor(F.log2(c) * PER_OCTAVE).cast("int")
    good = measures.where(~F.col("base_failed"))
    of_text = good.select(F.lit(False).alias("part"), F.col("size").alias("bytes"), "ratio")
    of_part = (good.select("size", last.alias("last"), F.posexplode("parts").alias("at", "ratio"))
               .select(F.lit(True).alias("part"),
                       F.when(F.col("at") < F.col("last"), chunk)
                       .otherwise(F.col("size") - F.col("last") * chunk).alias("bytes"), "ratio"))
    rows = (of_text.unionByName(of_part)
            .groupBy("part", length(F.col("bytes")).alias("length"), F.round(F.col("ratio") * BINS).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")).toPandas())
    out = []
    for part, spread, prior in ((False, SPREAD, BANDS), (True, CHUNK_SPREAD, CHUNK_BANDS)):
        r = rows[rows["part"] == part]
        out.append(learn_bands(*(r[c].to_numpy(np.int64) for c in ("length", "bin", "n")), spread, prior))
    return out


def _rules(bands, chunk_bands, chunk, bad_chunks):
    def run(batch: pa.RecordBatch):
        size, whole, failed = (batch.column(k).to_numpy(zero_copy_only=False) for k in (7, 8, 6))
        full = _band(chunk, chunk_bands)
        bad, verdict = [], []
        for n, r, parts in zip(size.tolist(), whole.tolist(), batch.column(9).to_pylist()):
            share = 0.0
            if parts:
                sides = [full] * (len(parts) - 1) + [_band(n - (len(parts) - 1) * chunk, chunk_bands)]
                share = sum(not lo <= p <= hi for p, (lo, hi) in zip(parts, sides)) / len(parts)
            lo, hi = _band(n, bands)
            bad.append(share)
            verdict.append("repetitive" if r < lo else "incompressible" if r > hi
                           else "chunks" if share > bad_chunks else None)
        kept = ~failed & np.array([v is None for v in verdict], dtype=bool)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:7], pa.array(kept), pa.array(whole, pa.float64()), pa.array(bad, pa.float64()),
             pa.array(["base" if f else v for f, v in zip(failed, verdict)], pa.string())],
            names=["doc_id", *COUNTS, "base_failed", "kept", "ratio", "bad_chunks", "reason"])
    return run


def compression_verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text", bands=None,
                         chunk_bands=None, chunk: int = CHUNK, bad_chunks: float = BAD_CHUNKS,
                         level: int = LEVEL) -> DataFrame:
    """Per row the base counts, ``base_failed``, ``kept``, the whole ratio,
    the share of chunks outside their band and the reason of a rejection.
    ``bands`` and ``chunk_bands`` are learned from the rows unless given.

    Words are runs of ``[^\\x20\\x09-\\x0D]+``; ``n_repeat_words`` counts the
    words of 5-word windows found twice or more in the text.  ``base_failed``:
    under 10 words, or over 20 % of them in repeated windows.

    Edge cases: a NULL or wordless text has zero counts and fails the base.
    NULL ids and repeated rows are judged each by itself; an empty table gives
    no rows; other columns are ignored.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    measures = materialize(arrow_map(rows, _measure(chunk, level), MEASURES), "ratios")
    if bands is None or chunk_bands is None:
        learned = _limits(measures, chunk)
        bands, chunk_bands = bands or learned[0], chunk_bands or learned[1]
    out = arrow_map(measures, _rules(bands, chunk_bands, chunk, bad_chunks), SCHEMA)
    return out if key == "doc_id" else out.withColumnRenamed("doc_id", key)
