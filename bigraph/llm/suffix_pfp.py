"""Repeated-substring removal by prefix-free parsing.

Every byte covered by a ``length``-byte string that also starts earlier
(smaller document, or same document and earlier start) is removed.

1. *Parse.*  A trigger is a k-gram whose rolling hash is the least (leftmost
   on ties) in some ``length``-byte window, so where a window's trigger lies
   depends on the window's bytes alone and every window has one.  Triggers cut
   a text into phrases; consecutive phrases overlap in a trigger.  A *parse
   row* is a trigger with the run of windows it serves: at most one row for
   each two dozen bytes or so, in place of one for each byte.
2. *Dictionary.*  Rows meet by trigger hash.  A trigger seen once serves no
   repeated window.  Rows whose whole run (all bytes of all its windows) is
   the same are copies: all but the first are removed at once, without their
   bytes ever being compared or moved.
3. *Order.*  Only triggers with several different runs are left.  For these,
   the bytes after the trigger (the parse) and the reversed bytes before it
   (dictionary suffixes) are each put in suffix order with their longest
   common prefixes; the window that starts ``a`` bytes before a trigger falls
   in the class (parse suffixes equal to depth ``length - a``, dictionary
   suffixes equal to depth ``a``), and every window but the first of its class
   is removed.  Together these classes are the corpus's suffixes in order, to
   the depth that matters, with no sort of all its suffixes.

Copies in a batch are resolved before the shuffle, so a passage in a third of
all documents is one row per batch.  Triggers
with more than ``HOT_ROWS`` different runs are split by the hash of the 93
bytes that eight neighbouring windows share, and a task whose rows pass
``MAX_ROWS`` hands such triggers on at once; nothing is dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import KEY, arrow_map, discard, fresh, give_back, keyed, materialize, shuffle_partitions
from bigraph.llm.kernels import CHUNK_BYTES, U64, chunks, mix, powers, prefix_hash, span_hash, text_arrays

LENGTH = 100
GRAM = 32
BUCKETS_PER_PARTITION = 16
MAX_ROWS = 2_000_000        # parse rows held by a task before it hands on hot triggers
HOT_ROWS = 50_000           # different runs of one trigger from which it is split
CORE_STEP = 8               # windows that share a key after that
_POS_BITS = 28
_LOW40 = U64((1 << 40) - 1)
_LOW48 = U64((1 << 48) - 1)

ROW = [("k", "u8"), ("c", "u8"), ("key", "i8"), ("lo", "u4"), ("before", "u1"), ("width", "u1")]


def _squeeze(columns: list[np.ndarray], tail: bytes = b"") -> bytes:
    """Columns as one compressed blob; bytes of equal weight lie together."""
    n = len(columns[0])
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(n, -1).T.tobytes() for c in columns)
    return n.to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(raw + tail)


def _unsqueeze(blob: bytes, kinds: list[str]) -> tuple[list[np.ndarray], bytes]:
    n, raw, at, out = int.from_bytes(blob[:4], "little"), zstandard.ZstdDecompressor().decompress(blob[4:]), 0, []
    for kind in kinds:
        dt = np.dtype(kind)
        flat = np.frombuffer(raw, np.uint8, n * dt.itemsize, at).reshape(dt.itemsize, n)
        out.append(np.ascontiguousarray(flat.T).view(dt).ravel())
        at += n * dt.itemsize
    return out, raw[at:]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (block prefix and suffix
    minima)."""
    n = values.size
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=U64)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def parse(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Parse rows of a run of documents: document index, ``lo`` (start of the
    first window served, from the document's start), ``before`` (bytes from
    there to the trigger), ``width`` (windows served less one), ``k`` (hash of
    the trigger), ``c`` (hash of all bytes of the windows and the place of the
    trigger in them)."""
    n, span = data.size, length - gram + 1
    sizes = np.diff(offsets)
    docs = np.flatnonzero(sizes >= length)
    if docs.size == 0:
        z = np.zeros(0, dtype=np.int64)
        return {x: z for x in ("doc", "lo", "before", "width")} | {x: z.astype(U64) for x in "kc"}
    prefix = prefix_hash(data)
    _, down = powers(n + 1)
    grams = mix((prefix[gram:] - prefix[:-gram]) * down[:n - gram + 1])
    low = U64((1 << _POS_BITS) - 1)
    least = _sliding_least((grams & ~low) | np.arange(grams.size, dtype=U64), span)
    marks = np.zeros(n + 1, dtype=np.int8)
    np.add.at(marks, offsets[docs], 1)
    np.add.at(marks, offsets[docs + 1] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(marks[:least.size]))
    trigger = (least[starts] & low).astype(np.int64)
    new = np.ones(starts.size, dtype=bool)
    new[1:] = trigger[1:] != trigger[:-1]
    first = np.flatnonzero(new)
    lo, at = starts[first], trigger[first]
    hi = starts[np.append(first[1:], starts.size) - 1]
    before, width = at - lo, hi - lo
    doc = np.searchsorted(offsets, lo, side="right") - 1
    place = (before << 8 | width).astype(U64)
    c = mix(span_hash(prefix, lo, hi + length) + place * U64(0xD6E8FEB86659FD93))
    return {"doc": doc, "lo": lo - offsets[doc], "before": before, "width": width, "k": grams[at], "c": c}


def _segments(data: np.ndarray, offsets: np.ndarray, length: int, most: int = CHUNK_BYTES):
    """``(start, data, offsets)`` runs that :func:`parse` takes at once: a
    single longer document is cut into segments of ``most`` window starts,
    which overlap so that every window lies in one of them.  A run of windows
    that a cut parts is resolved like any other run."""
    if data.size <= most:
        yield 0, data, offsets
        return
    for a in range(0, data.size - length + 1, most):
        part = data[a:a + most + length - 1]
        yield a, part, np.array([0, part.size])


def _firsts(k, c, key, lo) -> tuple[np.ndarray, np.ndarray]:
    """Row order by (k, c, document, start) and which of them are the first
    of their (k, c)."""
    order = np.lexsort((lo, key, c, k))
    first = np.ones(order.size, dtype=bool)
    first[1:] = (k[order][1:] != k[order][:-1]) | (c[order][1:] != c[order][:-1])
    return order, first


def _per_document(key: np.ndarray, kind: int, record: np.ndarray) -> pa.RecordBatch:
    """``key, kind, blob`` rows: the records of each document as one blob."""
    order = np.argsort(key, kind="stable")
    key, record = key[order], np.ascontiguousarray(record[order])
    edges = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if key.size else np.zeros(0, np.int64)
    bounds = np.append(edges, key.size) * record.dtype.itemsize
    raw = record.tobytes()
    blobs = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(key[edges], pa.int64()), pa.array([kind] * len(edges), pa.int32()), pa.array(blobs, pa.binary())],
        names=["key", "kind", "blob"])


RANGE = np.dtype([("lo", "<u4"), ("hi", "<u4")])
EDGE = np.dtype([("k", "<u8"), ("lo", "<u4"), ("before", "u1"), ("width", "u1"), ("hot", "u1")])
FULL, PARSED, EDGES = 0, 1, 2
ROUTED = "key bigint, kind int, blob binary"


def _ranges(key, lo, width, length) -> pa.RecordBatch:
    r = np.empty(len(key), dtype=RANGE)
    r["lo"], r["hi"] = lo, lo + width + length
    return _per_document(key, FULL, r)


def _parse_batch(length: int, gram: int, buckets: int, most: int = CHUNK_BYTES):
    def run(batch: pa.RecordBatch):
        keys = batch.column(0).to_numpy()
        data, offsets = text_arrays(batch.column(1))
        found = []
        for i, _, d, o in chunks(data, offsets, most):
            for start, part, bounds in _segments(d, o, length, most):
                p = parse(part, bounds, length, gram)
                p["key"] = keys[i + p.pop("doc")]
                p["lo"] = p["lo"] + start
                found.append(p)
        if not found:
            return
        rows = {x: np.concatenate([p[x] for p in found]) for x in found[0]}
        order, first = _firsts(rows["k"], rows["c"], rows["key"], rows["lo"])
        again = order[~first]
        if again.size:
            yield _ranges(rows["key"][again], rows["lo"][again], rows["width"][again], length)
        order = order[first]
        bucket = ((rows["k"] >> U64(40)) % U64(buckets)).astype(np.int64)[order]
        by = np.lexsort((rows["lo"][order], rows["key"][order], bucket))
        order, bucket = order[by], bucket[by]
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if bucket.size else []
        blobs = []
        for a, b in zip(edges, np.append(edges[1:], bucket.size)):
            r = order[a:b]
            k = (rows["k"][r] & _LOW40).view(np.uint8).reshape(-1, 8)[:, :5]
            c = (rows["c"][r] & _LOW48).view(np.uint8).reshape(-1, 8)[:, :6]
            blobs.append(_squeeze([k, c, np.diff(rows["key"][r], prepend=0), rows["lo"][r].astype(np.uint32),
                                   rows["before"][r].astype(np.uint8), rows["width"][r].astype(np.uint8)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[edges], pa.int64()), pa.array([PARSED] * len(blobs), pa.int32()),
             pa.array(blobs, pa.binary())], names=["key", "kind", "blob"])
    return run


def _widen(raw: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :size] = raw
    return out.view(U64).ravel()


def _dictionary(length: int, max_rows: int, hot_rows: int):
    """Partition step: parse rows to removed ranges and edges."""
    names = [n for n, _ in ROW]

    def edge_rows(rows, hot):
        e = np.empty(len(rows["k"]), dtype=EDGE)
        for x in ("k", "lo", "before", "width"):
            e[x] = rows[x]
        e["hot"] = hot
        return _per_document(rows["key"], EDGES, e)

    def run(batches):
        held, n, limit, hot = [], 0, max_rows, np.zeros(0, dtype=U64)

        def settle(flush: bool):
            nonlocal held, n, hot
            if not held:
                return
            rows = {x: np.concatenate([h[x] for h in held]) for x in names}
            held, n = [], 0
            if hot.size:
                known = np.isin(rows["k"], hot)
                if known.any():
                    yield edge_rows({x: rows[x][known] for x in names}, 1)
                    rows = {x: rows[x][~known] for x in names}
            order, first = _firsts(rows["k"], rows["c"], rows["key"], rows["lo"])
            again = order[~first]
            if again.size:
                yield _ranges(rows["key"][again], rows["lo"][again], rows["width"][again], length)
            rows = {x: rows[x][order[first]] for x in names}
            k, counts = np.unique(rows["k"], return_counts=True)
            if flush:
                several = np.repeat(counts > 1, counts)
                if several.any():
                    yield edge_rows({x: rows[x][several] for x in names}, np.repeat(counts > hot_rows, counts)[several])
                return
            large = np.repeat(counts > hot_rows, counts)
            if large.any() and len(large) > max_rows // 2:
                yield edge_rows({x: rows[x][large] for x in names}, 1)
                hot = np.union1d(hot, k[counts > hot_rows])
                rows = {x: rows[x][~large] for x in names}
            held, n = [rows], len(rows["k"])

        for batch in batches:
            kind = batch.column(1).to_numpy()
            done = np.flatnonzero(kind == FULL)
            if done.size:
                yield batch.take(pa.array(done))
            for i in np.flatnonzero(kind == PARSED):
                cols, _ = _unsqueeze(batch.column(2)[int(i)].as_py(), ["V5", "V6", "i8", "u4", "u1", "u1"])
                k = _widen(cols[0].view(np.uint8).reshape(-1, 5), 5)
                c = _widen(cols[1].view(np.uint8).reshape(-1, 6), 6)
                bucket = U64(batch.column(0)[int(i)].as_py())
                held.append(dict(zip(names, [k | bucket << U64(40), c, np.cumsum(cols[2]),
                                             cols[3].astype(np.int64), cols[4].astype(np.int64),
                                             cols[5].astype(np.int64)])))
                n += len(k)
                if n > limit:
                    yield from settle(False)
                    limit = max(max_rows, 2 * n)    # what stays is different runs: look again after as many more
        yield from settle(True)
        give_back()
    return run


def _contexts(length: int, buckets: int):
    """Documents with edges to ``bucket`` blobs of their windows' bytes, and
    every affected document with its text and removed ranges."""
    def run(batch: pa.RecordBatch):
        keys = batch.column(0).to_numpy()
        data, offsets = text_arrays(batch.column(1))
        recs, starts, row_key = [], [], []
        ranges = []
        for i in range(batch.num_rows):
            full = batch.column(2)[i].as_py()
            ranges.append(b"".join(full))
            e = np.frombuffer(b"".join(batch.column(3)[i].as_py()), dtype=EDGE)
            if e.size:
                recs.append(e)
                starts.append(np.full(e.size, offsets[i]))
                row_key.append(np.full(e.size, keys[i]))
        text = batch.column(1).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([FULL] * batch.num_rows, pa.int32()), text, pa.array(ranges, pa.binary())],
            names=["key", "kind", "blob", "ranges"])
        if not recs:
            return
        e, start, key = np.concatenate(recs), np.concatenate(starts), np.concatenate(row_key)
        k, lo = e["k"].astype(U64), e["lo"].astype(np.int64)
        before, width = e["before"].astype(np.int64), e["width"].astype(np.int64)
        if e["hot"].any():
            k, lo, before, width, start, key = _split_hot(e["hot"] == 1, k, lo, before, width, start, key, data, length)
        bucket = (mix(k) % U64(buckets)).astype(np.int64)
        order = np.lexsort((lo, key, bucket))
        k, lo, before, width, start, key, bucket = (x[order] for x in (k, lo, before, width, start, key, bucket))
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        blobs = []
        for a, b in zip(edges, np.append(edges[1:], bucket.size)):
            s = slice(a, b)
            sizes = width[s] + length
            where = np.repeat(start[s] + lo[s] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
            blobs.append(_squeeze([k[s], np.diff(key[s], prepend=0), lo[s].astype(np.uint32),
                                   before[s].astype(np.uint8), width[s].astype(np.uint8)], data[where].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[edges], pa.int64()), pa.array([PARSED] * len(blobs), pa.int32()),
             pa.array(blobs, pa.binary()), pa.array([None] * len(blobs), pa.binary())],
            names=["key", "kind", "blob", "ranges"])
    return run


def _split_hot(hot, k, lo, before, width, start, key, data, length):
    """Rows of hot triggers cut into runs of ``CORE_STEP`` windows, keyed by
    the bytes those windows share."""
    up, _ = powers(length)
    parts = [(k[~hot], lo[~hot], before[~hot], width[~hot], start[~hot], key[~hot])]
    k, lo, before, width, start, key = (x[hot] for x in (k, lo, before, width, start, key))
    # Cuts are by the distance to the trigger, so equal windows fall in the same run.
    top, least = before // CORE_STEP, (before - width) // CORE_STEP
    for step in range(int(least.min()), int(top.max()) + 1):
        has = np.flatnonzero((least <= step) & (step <= top))
        if not has.size:
            continue
        far = np.minimum(before[has], step * CORE_STEP + CORE_STEP - 1)
        near = np.maximum(before[has] - width[has], step * CORE_STEP)
        at = start[has] + lo[has] + before[has]
        # The core must be the same for every run of this step, also a shorter one.
        size = length - CORE_STEP + 1
        core = np.empty(has.size, dtype=U64)
        for i in range(0, has.size, 1 << 14):
            shared = data[at[i:i + (1 << 14), None] - step * CORE_STEP + np.arange(size)]
            core[i:i + (1 << 14)] = mix((shared.astype(U64) * up[:size]).sum(axis=1) + U64(step))
        parts.append((core, lo[has] + before[has] - far, far, far - near, start[has], key[has]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def order_classes(left: np.ndarray, right: np.ndarray, group: np.ndarray):
    """Suffix order of dictionary and parse: for the rows of padded byte
    matrices, ``(rank, lcp)`` of the bytes after the trigger within ``group``
    and of the reversed bytes before it."""
    out = []
    for matrix, first in ((right, group), (left, None)):
        width = -(-matrix.shape[1] // 8) * 8
        padded = np.zeros((len(matrix), width), dtype=np.uint8)
        padded[:, :matrix.shape[1]] = matrix
        words = padded.view(">u8").astype(U64)
        keys = [words[:, i] for i in range(words.shape[1] - 1, -1, -1)]
        order = np.lexsort(keys if first is None else [*keys, first])
        s = padded[order]
        differ = s[1:] != s[:-1]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        if first is not None:
            lcp[first[order][1:] != first[order][:-1]] = 0
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        out.append((rank, np.append(0, lcp)))
    return out


def repeated_windows(k, key, lo, before, width, spans: np.ndarray, length: int):
    """Windows (``key``, start) that repeat an earlier one among parse rows
    given with the bytes they serve (laid end to end)."""
    sizes = width + length
    ends = np.cumsum(sizes)
    at = ends - sizes + before
    most = int(before.max()) if len(before) else 0
    padded = np.concatenate((np.zeros(most, np.uint8), spans, np.zeros(length, np.uint8)))
    # Bytes past a row's own span never decide: a window of distance ``a`` is
    # compared to depth ``length - a`` after and ``a`` before its trigger.
    right = padded[most + at[:, None] + np.arange(length)]
    left = padded[most + at[:, None] - 1 - np.arange(max(most, 1))]
    _, group = np.unique(k, return_inverse=True)
    (rank_r, lcp_r), (rank_l, lcp_l) = order_classes(left, right, group)
    out_key, out_lo = [], []
    for a in range(most + 1):
        rows = np.flatnonzero((before >= a) & (before - width <= a))
        if rows.size < 2:
            continue
        # Depth 0 still needs the group: a group boundary has LCP 0.
        r = np.cumsum(lcp_r < max(length - a, 1))[rank_r[rows]]
        c = r << 32 | np.cumsum(lcp_l < a)[rank_l[rows]] if a else r
        start = lo[rows] + before[rows] - a
        order = np.lexsort((start, key[rows], c))
        again = order[1:][c[order][1:] == c[order][:-1]]
        out_key.append(key[rows][again])
        out_lo.append(start[again])
    if not out_key:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_key), np.concatenate(out_lo)


def _resolve(length: int):
    """Partition step over blobs sorted by bucket: one bucket at a time."""
    def flush(held):
        cols = [np.concatenate(x) for x in zip(*(h[0] for h in held))]
        spans = np.frombuffer(b"".join(h[1] for h in held), np.uint8)
        key, lo = repeated_windows(*cols, spans, length)
        if key.size:
            yield _ranges(key, lo, np.zeros(len(lo), np.int64), length)
        del cols, spans
        give_back()

    def run(batches):
        held, bucket = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                here = batch.column(0)[i].as_py()
                if held and here != bucket:
                    yield from flush(held)
                    held = []
                bucket = here
                cols, tail = _unsqueeze(batch.column(1)[i].as_py(), ["u8", "i8", "u4", "u1", "u1"])
                held.append(([cols[0], np.cumsum(cols[1]), *(c.astype(np.int64) for c in cols[2:])], tail))
        if held:
            yield from flush(held)
    return run


def _cut(batch: pa.RecordBatch):
    """``key, kept, n_bytes, n_removed, n_spans`` of affected documents."""
    kept, size, removed, spans = [], [], [], []
    for i in range(batch.num_rows):
        text = batch.column(1)[i].as_py()
        r = np.frombuffer(batch.column(2)[i].as_py() + b"".join(batch.column(3)[i].as_py() or []), dtype=RANGE)
        cover = np.zeros(len(text) + 1, dtype=np.int64)
        np.add.at(cover, r["lo"].astype(np.int64), 1)
        np.add.at(cover, r["hi"].astype(np.int64), -1)
        gone = np.cumsum(cover[:-1]) > 0
        kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
        size.append(len(text))
        removed.append(int(gone.sum()))
        spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(kept, pa.binary()), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
         pa.array(spans, pa.int64())], names=["_key", "kept", "n_bytes", "n_removed", "n_spans"])


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, max_rows: int = MAX_ROWS,
                   hot_rows: int = HOT_ROWS, segment: int = CHUNK_BYTES) -> DataFrame:
    """``_key, kept BINARY, n_bytes, n_removed, n_spans`` of the documents that
    lose bytes or may lose some; all others lose none.  ``rows`` is ``_key,
    text`` with unique keys in document order.  Documents of more than
    ``segment`` bytes are parsed piece by piece."""
    spark = rows.sparkSession
    parts = shuffle_partitions(spark)
    buckets = parts * BUCKETS_PER_PARTITION
    parsed = arrow_map(rows, _parse_batch(length, gram, buckets, segment), ROUTED)
    known = materialize(parsed.repartition(parts, "key")
                        .mapInArrow(_dictionary(length, max_rows, hot_rows), ROUTED), "dictionary")
    blobs_of = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("blob")))
    by_doc = known.groupBy(F.col("key").alias("_key")).agg(blobs_of(FULL).alias("full"), blobs_of(EDGES).alias("edges"))
    touched = rows.join(by_doc.hint("shuffle_hash"), "_key").select("_key", "text", "full", "edges")
    split = materialize(arrow_map(touched, _contexts(length, buckets), ROUTED + ", ranges binary"), "contexts")
    discard(known)
    late = (split.where(F.col("kind") == PARSED).select("key", "blob")
            .repartition(parts, "key").sortWithinPartitions("key")
            .mapInArrow(_resolve(length), ROUTED)
            .groupBy(F.col("key").alias("_key")).agg(F.collect_list("blob").alias("more")))
    affected = (split.where(F.col("kind") == FULL).select(F.col("key").alias("_key"), "blob", "ranges")
                .join(late, "_key", "left"))
    return arrow_map(affected, _cut, "_key bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, own: str = KEY,
                   **settings) -> tuple[DataFrame, DataFrame]:
    """``(table, cuts)``: ``docs`` with a unique column ``own``, and what
    :func:`repeated_spans` finds for them (a table in the shared folder).

    Edge cases: a NULL text is empty; texts under ``length`` bytes lose
    nothing.  NULL or repeated ids: every row is its own document, ordered by
    id (NULL last), then by text.  Documents may lose all their bytes; matches
    never cross documents.  Empty tables give no rows.  Cuts are by bytes and
    may part a character.
    """
    table, _ = keyed(docs, key, text, own)
    rows = table.select(F.col(own).alias("_key"), F.col(text).alias("text"))
    return table, materialize(repeated_spans(rows, length, **settings), "cuts")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                    **settings) -> DataFrame:
    """``docs`` (all columns, whatever their names) with the remaining text; a
    character that a cut has parted goes with it, a NULL text stays NULL."""
    own, rest = fresh(KEY, docs.columns), fresh("__llm_kept", docs.columns)
    table, cuts = remove_repeats(docs, key, text, length, own, **settings)
    cut = cuts.where(F.col("n_removed") > 0).select(F.col("_key").alias(own), F.col("kept").alias(rest))
    names, place = docs.columns, docs.columns.index(text)

    def decode(batch: pa.RecordBatch):
        kept = batch.column(batch.num_columns - 1)
        texts = [k.decode("utf-8", "ignore") if k is not None else t
                 for k, t in zip(kept.to_pylist(), batch.column(place).to_pylist())]
        columns = list(batch.columns[:-1])
        columns[place] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = table.join(cut, own, "left").select(*docs.columns, rest)
    return arrow_map(joined, decode, docs.schema)


def removal_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   **settings) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` for every row; only
    affected documents' texts are shuffled for it."""
    table, cuts = remove_repeats(docs.select(key, text), key, text, length, KEY, **settings)
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = table.select(KEY, F.col(key).cast("bigint").alias(key), F.octet_length(whole).cast("bigint").alias("n_bytes"),
                        F.sha2(whole, 256).alias("sha"))
    cut = cuts.select(F.col("_key").alias(KEY), "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha"))
    zero = F.lit(0).cast("bigint")
    return base.join(cut, KEY, "left").select(
        key, "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("cut_sha", "sha").alias("kept_sha256"))
