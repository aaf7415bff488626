"""Packing by concatenate and cut.

Pass one tokenises every text once and writes the ids with the task's number
and the running token offset within the task (a table in the shared folder).
The totals per task (one row each) give, by prefix sums, the global offset of
every task's first token.  Pass two is a scan of that table: a document's ids
are cut at the multiples of the window, which is the whole layout; no shuffle,
no sort.  Every sequence but the last is full.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import arrow_map, give_back, materialize, partition_offsets
from bigraph.llm.kernels import chunks, text_arrays

WINDOW = 2048
END_ID = 1
CACHE_UNITS = 600_000       # encoded units kept by a worker (about 130 MB)
BATCH_BYTES = 1 << 22       # text encoded at once
# Two white-space characters in a row, or one that is neither space nor line feed.
_RUN = r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]{2}|[\t\x{0b}-\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class Encoder:
    """Token ids of texts, as unsigned 32- or 16-bit little-endian numbers.

    The byte-level vocabulary never joins across a space that is followed by
    a visible character, so a text whose white space stands alone can be
    encoded unit by unit (a space and the run after it; a line feed).  The
    units of a batch are the entries of one Arrow array over the texts' bytes;
    only its distinct ones are looked up, in a table kept between batches, and
    the ids of all are gathered at once.  Any other text is encoded whole.
    All ids come from the tokenizer.
    """

    def __init__(self, path: str, cache_units: int = CACHE_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.units, self.limit = {}, cache_units        # unit (bytes, with the space before it) to the bytes of its ids
        # Tokens that begin with a space (byte-level vocabularies write it so).
        self.lead = np.zeros(self.tok.get_vocab_size(), dtype=bool)
        self.lead[[i for token, i in self.tok.get_vocab().items() if token.startswith("\u0120")]] = True
        feed = self.numbers(b"\n")
        self.feed = int(feed[0]) if feed.size == 1 else None
        # The shortcut holds for byte-level vocabularies without a normaliser
        # whose white space splits as above; check it, else encode whole.
        self.split = True
        probes = ["a b", "a b c. d, e,. x", "It's 3 o'clock,\nnot 12 é!\nx", "x. 中文 ***y|\n", " a", "a ", "\na", "a\n", "don't 's", ""]
        ids, sizes = self.encode_all(pa.array(probes))
        self.split = (ids.tobytes() == b"".join(map(self.ids, probes))
                      and [n * self.kind.itemsize for n in sizes] == [len(self.ids(t)) for t in probes])

    def look_up(self, distinct: list[bytes]) -> list[bytes]:
        """Ids of distinct units.  Those not known yet are encoded in two
        texts, cut apart where a token begins with a space and at line feeds."""
        known, new, parts, marked = self.units, {}, {}, []
        for u in distinct:
            if u not in known:
                if u.endswith((b".", b",")) and u[-2:-1].isalpha():     # letters and marks never join
                    stem = u[:-1]
                    marked.append((u, stem))
                    if stem not in known:
                        parts[stem] = None
                else:
                    parts[u] = None
        spaced = [p for p in parts if p[:1] == b" " and len(p) > 1]
        if spaced:
            ids = self.numbers(b"".join(spaced))
            new.update(self.pieces(spaced, ids, np.flatnonzero(self.lead[ids]), 0))
        plain = [p for p in parts if p[:1] not in (b" ", b"\n")]
        if plain and self.feed is not None:
            ids = self.numbers(b"\n" + b"\n".join(plain))
            new.update(self.pieces(plain, ids, np.flatnonzero(ids == self.feed), 1))
        if len(new) < len(parts):
            new.update({p: self.ids(p.decode()) for p in parts if p not in new})
        mark = {m: self.ids(m.decode()) for m in (b".", b",")} if marked else {}
        new.update([(u, (new[p] if p in new else known[p]) + mark[u[-1:]]) for u, p in marked])
        if len(known) < self.limit:
            known.update(new)
        return [new[u] if u in new else known[u] for u in distinct]

    def pieces(self, units: list[bytes], ids: np.ndarray, starts: np.ndarray, skip: int) -> dict[bytes, bytes]:
        """The ids of each unit, the first ``skip`` left out; none if the
        tokens do not start where the units do."""
        if len(starts) != len(units) or starts[0] != 0:
            return {}
        w, raw = self.kind.itemsize, ids.tobytes()
        ends = np.append(starts[1:], ids.size) * w
        return {u: raw[x:y] for u, x, y in zip(units, ((starts + skip) * w).tolist(), ends.tolist())}

    def numbers(self, text: bytes) -> np.ndarray:
        return np.array(self.tok.encode(text.decode(), add_special_tokens=False).ids, dtype=self.kind)

    def ids(self, text: str) -> bytes:
        return self.numbers(text.encode()).tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and their number per text (NULL is
        an empty text)."""
        whole = np.ones(len(texts), dtype=bool)
        if self.split:
            whole = np.array(pc.fill_null(pc.match_substring_regex(texts, _RUN), False))
        data, offsets = text_arrays(texts)
        # Units tile the bytes: one starts at every space and line feed, after
        # every line feed, and with every text.  A text to be encoded whole is
        # one unit.
        start = np.zeros(data.size + 1, dtype=bool)
        gap = (data == 32) | (data == 10)
        start[:-1] |= gap
        start[1:] |= data == 10
        if whole.any():
            start[:-1] &= ~np.repeat(whole, np.diff(offsets))
        start[offsets] = True
        at = np.flatnonzero(start[:-1])
        bounds = np.append(at, data.size)
        values = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()),
                                                                    pa.py_buffer(data)])
        coded = values.dictionary_encode()
        code, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        unit = np.searchsorted(at, offsets)                 # the first of each text
        odd = np.unique(code[unit[:-1][whole & (np.diff(offsets) > 0)]])
        if odd.size:
            usual = np.ones(len(distinct), dtype=bool)
            usual[odd] = False
            ids = np.empty(len(distinct), dtype=object)
            ids[usual] = self.look_up([distinct[k] for k in np.flatnonzero(usual)])
            ids[odd] = [self.ids(distinct[k].decode()) for k in odd]
        else:
            ids = self.look_up(distinct)
        flat = np.frombuffer(b"".join(ids), self.kind)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        first = np.cumsum(size) - size
        n = size[code]
        gather = np.repeat(first[code] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return flat[gather], np.diff(np.append(0, np.cumsum(n))[unit])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _tokenize(path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext
        enc, pid, offset = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1)
            for i, j, _, _ in chunks(*text_arrays(texts), BATCH_BYTES):
                ids, n = enc.encode_all(texts.slice(i, j - i))
                # The end id after each document's own.
                full = np.full(ids.size + j - i, end_id, dtype=enc.kind)
                n += 1
                ends = np.cumsum(n)
                mine = np.ones(full.size, dtype=bool)
                mine[ends - 1] = False
                full[mine] = ids
                blobs = pa.Array.from_buffers(
                    pa.large_binary(), j - i,
                    [None, pa.py_buffer(np.append(0, ends * enc.kind.itemsize).tobytes()), pa.py_buffer(full.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([pid] * (j - i), pa.int32()), pa.array(offset + ends - n),
                     pa.array(n), blobs.cast(pa.binary()), pa.array([enc.kind.itemsize] * (j - i), pa.int32())],
                    names=["doc_id", "_pid", "_local", "n", "ids", "width"])
                offset += int(n.sum())
            del batch, texts
            give_back()
    return run


PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")


def _cut(window: int):
    def run(batch: pa.RecordBatch):
        if not batch.num_rows:
            return
        at, n = batch.column(2).to_numpy(), batch.column(1).to_numpy()
        first, last = at // window, (at + n - 1) // window
        pieces = last - first + 1
        row = np.repeat(np.arange(len(n)), pieces)
        seq = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        lo = np.maximum(seq * window, at[row]) - at[row]
        hi = np.minimum((seq + 1) * window, at[row] + n[row]) - at[row]
        width = batch.column(4).to_numpy()
        blobs = batch.column(3).to_pylist()
        for i in range(0, len(row), 1 << 12):
            s = slice(i, i + (1 << 12))
            ids = [np.frombuffer(blobs[r], "<u2" if width[r] == 2 else "<u4")[a:b].astype("<u4").tobytes()
                   for r, a, b in zip(row[s], lo[s], hi[s])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row[s])), pa.array(lo[s]), pa.array(hi[s] - lo[s]),
                 pa.array(ids, pa.binary()), pa.array(n[row[s]]), pa.array(seq[s]),
                 pa.array(at[row[s]] + lo[s] - seq[s] * window)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Pieces of documents laid into sequences of ``window`` tokens: ``key,
    start, length, ids`` (BINARY, little-endian unsigned 32-bit), ``doc_tokens,
    sequence_id, offset, padded_length``.

    A document's ids are those of its text followed by ``end_id``; it is cut
    wherever a sequence ends.  ``padded_length`` is ``window`` but for a last
    sequence whose length is a power of two, which is not padded.
    ``tokenizer`` is the path of a tokenizers file that every executor has.

    Edge cases: a NULL or empty text is its end id.  Rows with NULL or
    repeated ids are packed each by itself.  The order of the documents is
    that of the table's partitions.  An empty table gives no rows; other
    columns are ignored.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    done = materialize(rows.mapInArrow(_tokenize(tokenizer, end_id), (
        "doc_id bigint, _pid int, _local bigint, n bigint, ids binary, width int")), "tokens")
    totals = done.groupBy("_pid").agg(F.sum("n").alias("total"))
    placed = done.join(F.broadcast(partition_offsets(totals)), "_pid").select(
        "doc_id", "n", (F.col("_local") + F.col("base")).alias("at"), "ids", "width")
    pieces = arrow_map(placed, _cut(window), PIECES)
    total = int(totals.agg(F.sum("total")).first()[0] or 0)
    rest = total % window
    power = rest > 0 and rest & (rest - 1) == 0
    padded = F.when((F.col("sequence_id") == total // window) & F.lit(power), rest).otherwise(window)
    out = pieces.withColumn("padded_length", padded.cast("bigint"))
    return out if key == "doc_id" else out.withColumnRenamed("doc_id", key)


def sequences(pieces: DataFrame, pad_id: int = 0) -> DataFrame:
    """``sequence_id, ids ARRAY<BIGINT>``: the pieces of each sequence in
    order, padded to their ``padded_length``."""
    def join(_, table):
        order = np.argsort(table.column("offset").to_numpy())
        blobs = table.column("ids").to_pylist()
        ids = np.frombuffer(b"".join(blobs[i] for i in order), "<u4").astype(np.int64)
        size = int(table.column("padded_length")[0].as_py())
        full = np.concatenate((ids, np.full(size - len(ids), pad_id, dtype=np.int64)))
        return pa.table({"sequence_id": table.column("sequence_id")[:1], "ids": [full.tolist()]})
    return (pieces.select("sequence_id", "offset", "ids", "padded_length").groupBy("sequence_id")
            .applyInArrow(join, "sequence_id bigint, ids array<bigint>"))
