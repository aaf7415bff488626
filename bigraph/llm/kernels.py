"""Vectorised text kernels used inside Arrow tasks.

All of them work on the bytes of many documents laid end to end (one uint8
array and the document offsets), so no Python runs per word.  A *word* is a
maximal run of bytes outside ``\\x20 \\x09-\\x0D``; as those are single bytes in
UTF-8, this equals the regular expression ``[^\\x20\\x09-\\x0D]+``.

Hashes are 64-bit: a polynomial over the bytes modulo 2**64, finished by a
bijective mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
WORD = r"[^\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text handled at once: bounds the temporaries of a kernel.
CHUNK_BYTES = 1 << 20
CHUNK_DOCS = 1 << 14
#: The same for kernels with a dozen 64-bit numbers or more for each byte.
SMALL_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C55 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for ``i`` in ``[0, n)``."""
    if _powers[0].size < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, b in enumerate((_BASE, _BASE_INV)):
            step = np.full(size, b, dtype=U64)
            step[0] = 1
            _powers[k] = np.multiply.accumulate(step)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (three xor-shift-multiply rounds)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = column.type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        column = column.cast(pa.large_string()).cast(pa.large_binary())
    else:
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, max_bytes: int = CHUNK_BYTES,
           max_docs: int = CHUNK_DOCS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents ``(first, last, data, offsets)`` of bounded
    size (a longer document makes a run of its own)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), i + max_docs, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document index of every word."""
    n = data.size
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    inside = ~IS_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``P`` with ``P[e] - P[s]`` the polynomial of bytes ``s..e`` times
    ``base**s``."""
    up, _ = powers(data.size + 1)
    out = np.zeros(data.size + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:data.size], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, independent of where it lies."""
    _, down = powers(prefix.size)
    h = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


_FOLD = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                  0x1D8E4E27C47D124F], dtype=U64) | U64(1)
SHINGLE = 5


def window_hash(word_hash: np.ndarray) -> np.ndarray:
    """Hash of each run of five consecutive words (by index of its first)."""
    m = word_hash.size - SHINGLE + 1
    if m <= 0:
        return np.zeros(0, dtype=U64)
    h = np.zeros(m, dtype=U64)
    for k in range(SHINGLE):
        h += word_hash[k:k + m] * _FOLD[k]
    return mix(h)


#: Shingles keep 50 bits so that a local document index fits above them.
SHINGLE_BITS = 50


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 5-word shingles of each document as sorted 50-bit values laid
    end to end, and their number per document.

    Words are compared with A-Z lower-cased.  A document of one to four words
    has its whole sequence as its only shingle; one without words has none.
    At most ``CHUNK_DOCS`` documents per call.
    """
    n_docs = len(offsets) - 1
    low = LOWER[data]
    starts, ends, doc = word_spans(low, offsets)
    if starts.size == 0:
        return np.zeros(0, dtype=U64), np.zeros(n_docs, dtype=np.int64)
    wh = span_hash(prefix_hash(low), starts, ends)
    n_words = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(n_words)))
    h = window_hash(wh)
    whole = doc[:h.size] == doc[SHINGLE - 1:SHINGLE - 1 + h.size] if h.size else np.zeros(0, bool)
    keys, docs = [h[whole]], [doc[:h.size][whole]]
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if short.size:
        acc = n_words[short].astype(U64)
        for k in range(SHINGLE - 1):
            has = n_words[short] > k
            acc[has] = mix(acc[has] * _FOLD[4] + wh[first[short[has]] + k] * _FOLD[k])
        keys.append(acc)
        docs.append(short)
    key = np.concatenate(keys) >> U64(64 - SHINGLE_BITS)
    key |= np.concatenate(docs).astype(U64) << U64(SHINGLE_BITS)
    key.sort()
    distinct = np.ones(key.size, dtype=bool)
    distinct[1:] = key[1:] != key[:-1]
    key = key[distinct]
    counts = np.bincount((key >> U64(SHINGLE_BITS)).astype(np.int64), minlength=n_docs)
    return key & U64((1 << SHINGLE_BITS) - 1), counts


def pack(values: np.ndarray) -> list[bytes]:
    """Rows of a 2-D array as bytes."""
    values = np.ascontiguousarray(values)
    width = values.shape[1] * values.itemsize
    raw = values.tobytes()
    return [raw[i * width:(i + 1) * width] for i in range(values.shape[0])]


def split_bytes(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A flat array cut into ``counts`` long pieces, as bytes."""
    edges = np.concatenate(([0], np.cumsum(counts))) * values.itemsize
    raw = values.tobytes()
    return [raw[a:b] for a, b in zip(edges[:-1], edges[1:])]
