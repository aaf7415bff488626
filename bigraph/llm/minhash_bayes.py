"""MinHash near-duplicates with sequential Bayesian verification.

Documents with one shingle set are a class, held by the smallest document.
Class signatures (120 min-hashes) are cut into 24 bands of 5.  Candidates of a
band bucket are compared by signature in batches: after each batch a pair is
dropped when the posterior probability that its similarity reaches the
threshold (uniform prior, so a Beta posterior) is under ``miss``.  Survivors
are verified exactly on their full shingle sets.  Components are the union of
the verified links.

A bucket's pairs are never listed.  First every member meets the smallest and
the largest member of its bucket (linear).  After the components of those
links are known, only members outside their bucket's largest component still
need partners: they are compared and verified, block by block inside tasks,
with the members of other components, and only links that join two components
leave the task.  No link that could join two components is skipped.

A pair of similarity 0.85 shares no band with probability 8e-7, and each of
the six signature tests drops it with probability of at most 3e-5 (the bound
``miss`` holds for the posterior, a pair right at the threshold is dropped up to
2.7 times as often); pairs of greater similarity are dropped far more rarely.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import KEY, arrow_map, discard, fresh, give_back, keyed, materialize
from bigraph.llm.components import components
from bigraph.llm.kernels import SHINGLE_BITS, SMALL_BYTES, U64, chunks, mix, pack, shingle_sets, split_bytes, text_arrays

BANDS = 24
ROWS = 5
HASHES = BANDS * ROWS
BATCH = 20                  # signature entries per sequential test
MISS = 1e-5                 # posterior probability under which a pair is dropped
THRESHOLD = (85, 100)       # similarity as a fraction
BLOCK = 512                 # bucket members and seekers that a task compares
LARGE_BLOCK = 1 << 20       # bytes of a block's full sets after which a worker returns what it has freed

_SEEDS = mix(np.arange(1, HASHES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_BAND_SEEDS = mix(np.arange(1001, 1001 + ROWS, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def least_matches(threshold: float, miss: float, hashes: int = HASHES, batch: int = BATCH) -> np.ndarray:
    """For ``n = batch, 2*batch, ...``: the fewest equal entries of ``n`` with
    which a pair stays.  With a uniform prior the posterior after ``m`` of
    ``n`` is Beta(m+1, n-m+1), and P(s >= t) is the chance that a
    Binomial(n+1, t) is at most ``m``."""
    out = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, 0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
        out.append(m)
    return np.array(out)


def minhash(values: np.ndarray, counts: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """Signatures (``uint32``) of sets laid end to end; all sets non-empty."""
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    sig = np.empty((len(counts), hashes), dtype=np.uint32)
    for k in range(hashes):
        sig[:, k] = np.minimum.reduceat(values * _SEEDS[k], starts) >> U64(32)
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (``int64``, documents x bands)."""
    s = sig.reshape(len(sig), -1, ROWS).astype(U64)
    h = np.zeros(s.shape[:2], dtype=U64)
    for k in range(ROWS):
        h += mix(s[:, :, k] + U64(k + 1)) * _BAND_SEEDS[k]
    h += np.arange(s.shape[1], dtype=U64) * U64(0xD1B54A32D192ED03)
    return mix(h).view(np.int64)


def _signatures(batch: pa.RecordBatch):
    data, offsets = text_arrays(batch.column(1))
    keys = batch.column(0)
    for i, j, d, o in chunks(data, offsets, SMALL_BYTES):
        values, counts = shingle_sets(d, o)
        full = counts > 0
        marks = [np.zeros(j - i, dtype=np.int64) for _ in range(2)]
        sig = np.full(j - i, None, dtype=object)
        if full.any():
            starts = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
            for k, m in enumerate(marks):
                m[full] = np.add.reduceat(mix(values + U64(k * 0x5851F42D4C957F2D + 1)), starts).view(np.int64)
            sig[full] = pack(minhash(values, counts[full]))
        yield pa.RecordBatch.from_arrays(
            [keys.slice(i, j - i), pa.array(counts), pa.array(marks[0]), pa.array(marks[1]),
             pa.array(list(sig), pa.binary())], names=["key", "n", "h1", "h2", "sig"])


def _bands(batch: pa.RecordBatch):
    if batch.num_rows:
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(batch.num_rows, -1)
        keys = band_keys(sig)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))],
            names=["bucket", "key"])


def _sequential(least: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of two signature arrays survive every batch test."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), dtype=np.int64)
    for t, need in enumerate(least):
        s = slice(t * BATCH, (t + 1) * BATCH)
        equal[alive] += (left[alive, s] == right[alive, s]).sum(axis=1)
        alive = alive[equal[alive] >= need]
    out = np.zeros(len(left), dtype=bool)
    out[alive] = True
    return out


def _sets(batch: pa.RecordBatch):
    data, offsets = text_arrays(batch.column(1))
    for i, j, d, o in chunks(data, offsets, SMALL_BYTES):
        values, counts = shingle_sets(d, o)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(i, j - i), pa.array(split_bytes(values, counts), pa.binary())],
            names=["key", "members"])


def _exact(num: int, den: int):
    def run(batch: pa.RecordBatch):
        left, lo = text_arrays(batch.column(2))
        right, ro = text_arrays(batch.column(3))
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        keep = np.zeros(len(a), dtype=bool)
        i = 0
        size = (lo + ro) // 8
        while i < len(a):
            j = max(i + 1, min(i + (1 << 13), int(np.searchsorted(size, size[i] + (1 << 18), side="right")) - 1))
            parts = []
            for raw, off in ((left, lo), (right, ro)):
                v = np.frombuffer(raw[off[i]:off[j]].tobytes(), dtype=U64)
                row = np.repeat(np.arange(j - i, dtype=U64), np.diff(off[i:j + 1]) // 8)
                parts.append(v | row << U64(SHINGLE_BITS))
            both = np.concatenate(parts)
            both.sort()
            common = both[1:][both[1:] == both[:-1]] >> U64(SHINGLE_BITS)
            inter = np.bincount(common.astype(np.int64), minlength=j - i)
            union = np.diff(size[i:j + 1]) - inter
            keep[i:j] = (den * inter >= num * union) & (union > 0)
            i = j
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])
    return run


def verify(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, threshold: tuple[int, int],
           miss: float) -> DataFrame:
    """The pairs ``a, b`` that pass the signature tests and whose full sets
    reach the threshold."""
    least = least_matches(threshold[0] / threshold[1], miss)

    def sieve(batch: pa.RecordBatch):
        if batch.num_rows:
            s = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                 for k in (2, 3)]
            ok = _sequential(least, *s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column(k).to_numpy()[ok]) for k in (0, 1)], names=["a", "b"])

    sa = signatures.select(F.col("key").alias("a"), F.col("sig").alias("sa"))
    sb = signatures.select(F.col("key").alias("b"), F.col("sig").alias("sb"))
    joined = pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb")
    pairs = materialize(arrow_map(joined, sieve, "a bigint, b bigint"), "survivors", most=pairs.count())
    left = sets.select(F.col("key").alias("a"), F.col("members").alias("ma"))
    right = sets.select(F.col("key").alias("b"), F.col("members").alias("mb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb")
    return materialize(arrow_map(joined, _exact(*threshold), "a bigint, b bigint"), "verified", most=pairs.count())


def _first_shared(bands: np.ndarray, m: np.ndarray, s: int, bucket: int) -> np.ndarray:
    """Of members ``m``, those whose first band shared with ``s`` is this
    bucket's, so that a pair is looked at once."""
    shared = bands[m] == bands[s]
    return m[bands[m, shared.argmax(axis=1)] == bucket] if m.size else m


def _promising(least: np.ndarray):
    """Members of a block that pass the signature tests with some member of
    another component (rows ``bucket, sb, mb, key, comp, role, sig``): the
    only ones whose full sets are fetched."""
    def run(_, frame):
        role, comp = frame.column("role").to_numpy(), frame.column("comp").to_numpy()
        sig = np.frombuffer(b"".join(frame.column("sig").to_pylist()), np.uint32).reshape(len(comp), -1)
        bands, bucket = band_keys(sig), frame.column("bucket")[0].as_py()
        members, keep = np.flatnonzero(role == 1), np.zeros(len(comp), dtype=bool)
        for s in np.flatnonzero(role == 0):
            m = members[comp[members] != comp[s]]
            m = m[_sequential(least, np.broadcast_to(sig[s], (len(m), sig.shape[1])), sig[m])]
            m = _first_shared(bands, m, s, bucket)
            keep[m] = True
            keep[s] |= m.size > 0
        return frame.filter(pa.array(keep)).drop(["sig"])
    return run


def _across(least: np.ndarray, num: int, den: int):
    """Verified links between members of a block that lie in different
    components, as many as join them; rows ``bucket, sb, mb, key, comp, role,
    sig, members``.  A pair is looked at in the first band that it shares."""
    def run(_, frame):
        role = frame.column("role").to_numpy()
        key, comp = frame.column("key").to_numpy(), frame.column("comp").to_numpy()
        sig = np.frombuffer(b"".join(frame.column("sig").to_pylist()), np.uint32).reshape(len(key), -1)
        raw, off = text_arrays(frame.column("members"))
        values, off = np.frombuffer(raw.tobytes(), U64), off // 8
        size = np.diff(off)
        bands = band_keys(sig)
        bucket = frame.column("bucket")[0].as_py()
        seekers, members = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        _, group = np.unique(comp, return_inverse=True)
        root = np.arange(group.max() + 1)
        out = []
        for s in seekers:
            m = members[root[group[members]] != root[group[s]]]
            m = m[_sequential(least, np.broadcast_to(sig[s], (len(m), sig.shape[1])), sig[m])]
            m = _first_shared(bands, m, s, bucket)
            if not m.size:
                continue
            mine = values[off[s]:off[s + 1]]
            at = np.repeat(off[m] - np.append(0, np.cumsum(size[m])[:-1]), size[m]) + np.arange(size[m].sum())
            theirs = values[at]
            place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            hit = np.concatenate(([0], np.cumsum(mine[place] == theirs)))
            ends = np.cumsum(size[m])
            inter = hit[ends] - hit[ends - size[m]]
            for t in m[den * inter >= num * (size[s] + size[m] - inter)]:
                here, there = root[group[s]], root[group[t]]
                if here != there:
                    root[root == there] = here
                    out.append((min(key[s], key[t]), max(key[s], key[t])))
        if values.nbytes > LARGE_BLOCK:
            give_back()
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})
    return run


_BLOCK_KEY = ["bucket", "sb", "mb"]


def _blocks(multi: DataFrame, comps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of the buckets that hold several components, dealt to blocks:
    ``bucket, sb, mb, key, comp, role``.

    Members (role 1) stand in one row group per seeker block; seekers (role 0)
    are those outside the bucket's largest component and stand in one per
    member block, so each seeker meets each member in one group of at most
    about two ``BLOCK`` rows."""
    here = (multi.join(comps.withColumnRenamed("node", "key"), "key", "left")
            .select("bucket", "key", F.coalesce("component", "key").alias("comp")))
    here = materialize(here, "members")
    # Buckets of two or three members are done: each pair has met.
    counts = here.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = (counts.groupBy("bucket")
             .agg(F.max_by("comp", "n").alias("major"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("comps"))
             .where((F.col("comps") > 1) & (F.col("size") > 3))
             .select("bucket", "major", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    n_seek = (counts.join(mixed, "bucket").where(F.col("comp") != F.col("major"))
              .groupBy("bucket").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("seek_blocks")))
    held = here.join(mixed, "bucket").join(n_seek, "bucket")
    dealt = lambda c: F.pmod(F.xxhash64("key"), F.col(c).cast("bigint")).cast("int")
    all_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    as_member = (held.withColumn("mb", dealt("blocks")).withColumn("sb", all_of("seek_blocks"))
                 .select(*_BLOCK_KEY, "key", "comp", F.lit(1).alias("role")))
    as_seeker = (held.where(F.col("comp") != F.col("major")).withColumn("sb", dealt("seek_blocks"))
                 .withColumn("mb", all_of("blocks")).select(*_BLOCK_KEY, "key", "comp", F.lit(0).alias("role")))
    return as_member.unionByName(as_seeker), here


def _leftovers(multi: DataFrame, comps: DataFrame, signatures: DataFrame, sets: DataFrame, threshold, miss):
    """Verified links that join components which share a bucket.

    Signatures travel to the blocks first; full sets only for members that
    have passed the signature tests there.  The blocks are dealt explicitly:
    rows that lie by ``bucket`` already would count as grouped, and all blocks
    of a hot bucket would run in one task."""
    rows, here = _blocks(multi, comps)
    least = least_matches(threshold[0] / threshold[1], miss)
    kind = "bucket bigint, sb int, mb int, key bigint, comp bigint, role int"
    passed = materialize(rows.join(signatures, "key").select(*_BLOCK_KEY, "key", "comp", "role", "sig")
                         .repartition(*_BLOCK_KEY).groupBy(*_BLOCK_KEY).applyInArrow(_promising(least), kind), "passed")
    full = passed.join(signatures, "key").join(sets, "key").select(*_BLOCK_KEY, "key", "comp", "role", "sig", "members")
    found = (full.repartition(*_BLOCK_KEY).groupBy(*_BLOCK_KEY)
             .applyInArrow(_across(least, *threshold), "a bigint, b bigint").distinct())
    found = materialize(found, "across")
    discard(passed)
    return found, here


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    threshold: tuple[int, int] = THRESHOLD, miss: float = MISS) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row.

    Words: A-Z lower-cased runs of ``[^\\x20\\x09-\\x0D]+`` of the whole text;
    set: distinct 5-word shingles (one to four words: the sequence).  Rows
    are linked when their sets' similarity is at least ``threshold``.

    Edge cases: a NULL or wordless text has an empty set and is linked with
    nothing.  NULL or repeated ids: every row is its own document (ordered by
    id, NULL last, then text); ``component_id`` is the smallest id of the
    component (NULL if only NULL ids are in it), and of rows that tie only
    the first of the component is ``kept``.  Empty tables give no rows.
    Other columns are ignored.
    """
    docs = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    table, plain = keyed(docs, "_id", "_text")
    out = _components(table, "_text", KEY, threshold, miss)
    kept = (F.col("key") == F.col("comp")).alias("kept")
    if plain:
        return out.select(F.col("key").alias(key), "n_shingles", F.col("comp").alias("component_id"), kept)
    a = table.select(F.col(KEY).alias("key"), F.col("_id").cast("bigint").alias("own"))
    b = table.select(F.col(KEY).alias("comp"), F.col("_id").cast("bigint").alias("first"))
    return (out.join(a, "key").join(b, "comp")
            .select(F.col("own").alias(key), "n_shingles", F.col("first").alias("component_id"), kept))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: tuple[int, int] = THRESHOLD,
               miss: float = MISS) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) that are the
    first of their component; the ids that go travel alone."""
    own = fresh(KEY, docs.columns)
    table, _ = keyed(docs, key, text, own)
    gone = (_components(table, text, own, threshold, miss).where(F.col("key") != F.col("comp"))
            .select(F.col("key").alias(own)))
    return table.join(gone, own, "left_anti").select(*docs.columns)


def _components(table: DataFrame, text: str, key: str, threshold: tuple[int, int], miss: float) -> DataFrame:
    """``key, n_shingles, comp`` of rows with a unique ``key``."""
    rows = table.select(F.col(key).alias("key"), F.col(text).alias("text"))
    sig = materialize(arrow_map(rows, _signatures, "key bigint, n bigint, h1 bigint, h2 bigint, sig binary"), "sig")
    full = sig.where(F.col("n") > 0)
    classes = full.groupBy("h1", "h2").agg(F.min("key").alias("rep"))
    reps = materialize(full.join(classes, (full["key"] == classes["rep"])).select("key", "sig"), "reps")

    buckets = arrow_map(reps, _bands, "bucket bigint, key bigint")
    ends = (buckets.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("first"), F.max("key").alias("last"))
            .where(F.col("size") > 1))
    met = materialize(buckets.join(ends, "bucket"), "buckets")
    pairs = (met.select("key", F.explode(F.array("first", "last")).alias("other"))
             .where(F.col("key") != F.col("other"))
             .select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct())
    pairs = materialize(pairs, "pairs")
    # Full sets of the documents that share a bucket with another: the only texts that are shuffled.
    texts = rows.join(met.select("key").distinct().hint("shuffle_hash"), "key", "left_semi").select("key", "text")
    sets = materialize(arrow_map(texts, _sets, "key bigint, members binary"), "sets")
    links = verify(pairs, reps, sets, threshold, miss)
    comps = components(links, most=links.count())
    more, members = _leftovers(met.select("bucket", "key"), comps, reps, sets, threshold, miss)
    if not more.isEmpty():
        comps = components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    discard(met, members, reps, pairs, sets)

    of_class = classes.join(comps, F.col("rep") == F.col("node"), "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("comp"))
    return (sig.select("key", "n", "h1", "h2").join(of_class, ["h1", "h2"], "left")
            .select("key", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("key")).alias("comp")))
