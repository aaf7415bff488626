"""Fill-in-the-middle transformation by secondary-sort assembly.

A document is cut into units (``[A-Za-z]+|[^A-Za-z]``), two units drawn from
its id split it into prefix, middle and suffix, and the parts are put in
another order behind marks.

How it runs.  One pass over the texts emits *pieces*: chunks of whole units,
and the marks, keyed by the row and their place in the output.  The pieces are
hash-partitioned on the row and sorted inside their partitions by (row, place),
so a task streams the output of its documents one piece after the other into
an incremental digest and never holds a whole text.  The same task parses the
output stream it sees, mark by mark, into pieces of the restored text; these
are sorted again inside the partition by (row, part, place) - no second
shuffle - and streamed into the digest of the restoration.

A row's key is its place in the input (partition and number), so copies of a
document, however many, spread over all partitions.  The input has to be a
stored table, or deterministic in its order, as a lost task reads it again.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import arrow_map, shuffle_partitions
from bigraph.llm.kernels import chunks, text_arrays

# Fixed values of the format: the marks before the parts, and their order.
MARK = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDER = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
RESTORED = {b"P": 0, b"M": 1, b"S": 2}     # place of a part in the text

SEED = "1"
SPLIT_PERCENT = 90          # of the documents are split at all
SPM_PERCENT = 20            # of these start with the suffix
PIECE_UNITS = 1024          # units of a piece
FLUSH_BYTES = 1 << 22       # of pieces in a batch that leaves a task

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_FIND = re.compile(rb"<([PSM])>")


def draws(key: str, seed: str = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the hexadecimal SHA-256 of ``seed:key``."""
    h = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where a unit starts: at each code point but inside a run
    of letters of one document."""
    letter = _LETTER[data]
    inside = np.zeros(data.size, dtype=bool)
    inside[1:] = letter[1:] & letter[:-1]
    inside[offsets[:-1][offsets[:-1] < data.size]] = False
    return np.flatnonzero(~inside & ((data & 0xC0) != 0x80))


PIECE = ("row bigint, place bigint, piece binary, key bigint, n bigint, form string, prefix_chars bigint, "
         "middle_chars bigint")
_PIECE_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
_PIECE_NAMES = ["row", "place", "piece", "key", "n", "form", "prefix_chars", "middle_chars"]


def _cut(split_percent: int, spm_percent: int, piece_units: int):
    """``row, key, h1..h4, text`` to pieces in output order; place 0 is an
    empty piece that carries what is known of the document."""
    def run(batch: pa.RecordBatch):
        keys = batch.column(1).to_pylist()
        rows = batch.column(0).to_pylist()
        h = [batch.column(k).to_numpy() for k in range(2, 6)]
        for i, j, d, o in chunks(*text_arrays(batch.column(6))):
            u = unit_starts(d, o)
            first = np.searchsorted(u, o)                   # unit number of each document's start
            n = np.diff(first)
            a, b = h[0][i:j] % (n + 1), h[1][i:j] % (n + 1)
            a, b = np.minimum(a, b), np.maximum(a, b)
            marked = np.zeros(j - i, dtype=bool)
            if d.size > 2:
                at = np.flatnonzero((d[:-2] == 60) & (d[2:] == 62) & np.isin(d[1:-1], (80, 83, 77)))
                doc = np.searchsorted(o, at, side="right") - 1
                marked[doc[at + 2 < o[doc + 1]]] = True
            plain = marked | (np.diff(o) == 0) | (h[2][i:j] % 100 >= split_percent)
            spm = h[3][i:j] % 100 < spm_percent
            ends = np.append(u, d.size)
            points = np.concatenate(([0], np.cumsum((d & 0xC0) != 0x80)))
            raw = d.tobytes()
            out, held = [], 0
            for k in range(j - i):
                f, g = int(first[k]), int(first[k + 1])
                x, y = f + int(a[k]), f + int(b[k])
                form = "plain" if plain[k] else "spm" if spm[k] else "psm"
                start = int(o[k])
                cut = [start if x == f else int(ends[x]) if x < g else int(o[k + 1]),
                       start if y == f else int(ends[y]) if y < g else int(o[k + 1])]
                chars = ((None, None) if form == "plain" else
                         (int(points[cut[0]] - points[start]), int(points[cut[1]] - points[cut[0]])))
                row = rows[i + k]
                out.append((row, 0, b"", keys[i + k], int(n[k]), form, *chars))
                parts = {"prefix": (f, x), "middle": (x, y), "suffix": (y, g), "whole": (f, g)}
                place = 1
                for part in ORDER.get(form, ("whole",)):
                    if part in MARK:
                        out.append((row, place, MARK[part], *[None] * 5))
                        place += 1
                    lo, hi = parts[part]
                    for s in range(lo, hi, piece_units):
                        e = min(s + piece_units, hi)
                        piece = raw[ends[s]:ends[e] if e < g else o[k + 1]]
                        out.append((row, place, piece, *[None] * 5))
                        held += len(piece)
                        place += 1
                if held > FLUSH_BYTES or len(out) > 1 << 14:
                    yield _rows(out, _PIECE_TYPES, _PIECE_NAMES)
                    out, held = [], 0
            if out:
                yield _rows(out, _PIECE_TYPES, _PIECE_NAMES)
    return run


def _rows(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def output_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED,
                  split_percent: int = SPLIT_PERCENT, spm_percent: int = SPM_PERCENT,
                  piece_units: int = PIECE_UNITS) -> DataFrame:
    """The pieces of all outputs, each row's together in one partition and in
    order: ``row, place, piece`` and, at place 0 (an empty piece), ``key, n,
    form, prefix_chars, middle_chars``.

    Edge cases: a NULL or empty text has no units and is ``plain`` with an
    empty output; a NULL key draws as the word ``null``; rows with the same
    key draw alike and are each transformed; other columns are ignored; an
    empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("key"),
                       *[h.alias(f"h{i}") for i, h in enumerate(draws(key, seed))], F.col(text).alias("text"))
    pieces = arrow_map(rows, _cut(split_percent, spm_percent, piece_units), PIECE)
    return pieces.repartition(shuffle_partitions(docs.sparkSession), "row").sortWithinPartitions("row", "place")


class Restorer:
    """Parses an output stream into parts of the restored text.  Marks may be
    cut anywhere by the ends of pieces."""

    def __init__(self, form: str):
        self.plain, self.part, self.tail = form == "plain", 0, b""

    def feed(self, data: bytes):
        """``(part, bytes)`` of what is known to be text so far."""
        if self.plain:
            return [(0, data)] if data else []
        data, out, at = self.tail + data, [], 0
        for m in _FIND.finditer(data):
            if m.start() > at:
                out.append((self.part, data[at:m.start()]))
            self.part, at = RESTORED[m[1]], m.end()
        keep = 0
        for k in (2, 1):
            if len(data) - at >= k and data[-k:] in (b"<", b"<P", b"<S", b"<M"):
                keep = k
                break
        if len(data) - keep > at:
            out.append((self.part, data[at:len(data) - keep]))
        self.tail = data[len(data) - keep:]
        return out

    def end(self):
        return [(self.part, self.tail)] if self.tail else []


RESTORE = PIECE.replace("row bigint, ", "row bigint, part int, ") + ", output_sha256 string"
_RESTORE_TYPES = [pa.int64(), pa.int32(), *_PIECE_TYPES[1:], pa.string()]
_RESTORE_NAMES = ["row", "part", *_PIECE_NAMES[1:], "output_sha256"]


def _streamed(batches):
    """``(row, place, piece, header)`` of sorted pieces, one at a time."""
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        yield from zip(cols[0], cols[1], cols[2], zip(*cols[3:]))


def _digest_output(batches):
    """Ordered pieces to the pieces of the restored text (part, place), and a
    header per row (part -1) with the digest of its output."""
    out, held, row = [], 0, None

    def finish():
        for part, piece in restorer.end():
            out.append((row, part, place + 1, piece, *[None] * 6))
        out.append((row, -1, 0, b"", *head, sha.hexdigest()))

    for r, p, piece, header in _streamed(batches):
        if r != row:
            if row is not None:
                finish()
            row, head, sha, restorer, place = r, header, hashlib.sha256(), Restorer(header[2]), 0
        sha.update(piece)
        for part, text in restorer.feed(piece):
            place += 1
            out.append((row, part, place, text, *[None] * 6))
            held += len(text)
        if held > FLUSH_BYTES or len(out) > 1 << 14:
            yield _rows(out, _RESTORE_TYPES, _RESTORE_NAMES)
            out, held = [], 0
    if row is not None:
        finish()
        yield _rows(out, _RESTORE_TYPES, _RESTORE_NAMES)


DIGEST = ("key bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, "
          "restored_sha256 string")


def _digest_restored(batches):
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = [c.split()[0] for c in DIGEST.split(", ")]
    out, row = [], None
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        for r, part, piece, header in zip(cols[0], cols[1], cols[3], zip(*cols[4:])):
            if part < 0:
                if row is not None:
                    out.append((*head, sha.hexdigest()))
                row, head, sha = r, header, hashlib.sha256()
            else:
                sha.update(piece)
        if len(out) > 1 << 12:
            yield _rows(out, types, names)
            out = []
    if row is not None:
        out.append((*head, sha.hexdigest()))
    if out:
        yield _rows(out, types, names)


def digests(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of :func:`output_pieces`: ``key, n, form, prefix_chars,
    middle_chars, output_sha256, restored_sha256``, the last of the text that
    is rebuilt from the output and its form alone."""
    restored = pieces.mapInArrow(_digest_output, RESTORE).sortWithinPartitions("row", "part", "place")
    return restored.mapInArrow(_digest_restored, DIGEST).withColumnRenamed("key", key)


def outputs(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of :func:`output_pieces`: ``key, n, form, prefix_chars,
    middle_chars, output`` with the whole transformed text."""
    def run(batches):
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_binary()]
        names = ["key", "n", "form", "prefix_chars", "middle_chars", "output"]
        out, held, row, whole = [], 0, None, []

        def batch():
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            arrays[-1] = arrays[-1].cast(pa.large_string()).cast(pa.string())
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for r, _, piece, header in _streamed(batches):
            if r != row:
                if row is not None:
                    out.append((*head, b"".join(whole)))
                row, head, whole = r, header, []
                if held > FLUSH_BYTES:
                    yield batch()
                    out, held = [], 0
            whole.append(piece)
            held += len(piece)
        if row is not None:
            out.append((*head, b"".join(whole)))
            yield batch()

    schema = "key bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return pieces.mapInArrow(run, schema).withColumnRenamed("key", key)
