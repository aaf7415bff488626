"""Embedding near-duplicates over hierarchical navigable small-world graphs.

Equal vectors are a class, held by the smallest id.  A class belongs to the cell
of its nearest pivot; pivots are a hashed sample of the classes, about one for
``CELL_ROWS``, so dense places get more cells.  Each cell is a shard with a
graph, built in one task; a cell over the bounds of a shard is dealt into
several by a hash.  A vector queries the graph of its own shard and, of the
cells whose pivot is nearly as near as its own, those that do not send their
vectors to it: every two cells meet in one direction only.  Found neighbours are
verified by cosine in double precision.

How much less near a pivot may be (the margin) is measured: a hashed sample of
queries is compared with all vectors, and the margin is ``ROUTE_WIDER`` times
the least that leaves out no more than ``ROUTE_LOSS`` of a query's links, on
average.  With few linked queries in the sample it is also three standard
deviations of the difference of two pivots' cosines between a vector and a link
at the threshold in a random direction, at least.  Where links lie so far apart
that a vector would visit most cells, fewer and larger cells are taken.

A query whose whole beam lies above the threshold is repeated with a beam twice
as wide.  Then an audit compares some queries with brute force over the shard;
while its recall is under the goal the beam is doubled for all queries, and a
beam of ``MAX_BEAM`` gives way to brute force in blocks.  Tasks return link
counts per vector and the links that join components inside the task, never all
pairs of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bigraph.llm.common import KEY, arrow_map, discard, keyed, materialize
from bigraph.llm.components import components

THRESHOLD = 0.95
SHARD_ROWS = 50_000         # classes of a shard at most
SHARD_BYTES = 1 << 26       # of the vectors of a shard (with SHARD_ROWS it bounds a task's memory)
MIN_SHARDS = 4
CELL_ROWS = 2048            # classes of a cell, about
VISIT_ROWS = 4 * CELL_ROWS  # vectors of other shards that query a shard in one task, about
PIVOT_BYTES = 1 << 25       # of all pivots, and of all queries of the margin's sample
ROUTE_LOSS = 0.001          # share of a query's links outside the cells it meets, on average
ROUTE_WIDER = 1.5           # for links that the sample has not seen
BINS = 512                  # steps of the margin in a cosine of 1
MAX_TASKS = 1 << 14
LINKS = 16                  # neighbours per node above the ground layer, twice as many on it
BUILD_BEAM = 64
BEAM = 64
MAX_BEAM = 1024
EXPAND = 4                  # beam nodes expanded per step
QUERY_BLOCK = 512
AUDIT = 96                  # audited queries with a link per shard pair
DRAWS = 4096                # queries drawn at most to find these
RECALL_GOAL = 0.995
_SLACK = 1e-4               # single-precision search keeps what may reach the threshold


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (rows are finite and not zero)."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


class Graph:
    """A layered proximity graph over unit vectors, built in growing batches."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 1):
        self.x = np.ascontiguousarray(vectors, dtype=np.float32)
        n = len(self.x)
        draw = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(links)).astype(int), 6)
        self.order = np.lexsort((np.arange(n), -level))     # higher layers first
        self.sizes = [int((level >= k).sum()) for k in range(level.max() + 1)] if n else []
        self.layers: list[np.ndarray] = [None] * len(self.sizes)
        for k in range(len(self.sizes) - 1, -1, -1):
            self.layers[k] = self._build(k, 2 * links if k == 0 else links, beam)

    def _build(self, k: int, width: int, beam: int) -> np.ndarray:
        nodes = self.order[:self.sizes[k]]
        near = np.full((len(self.x), width), -1, dtype=np.int32)
        done = min(len(nodes), 512)
        self._connect(near, nodes[:done], self._brute(nodes[:done], nodes[:done], beam))
        while done < len(nodes):
            batch = nodes[done:done + min(done, 2048)]
            found = []
            for i in range(0, len(batch), QUERY_BLOCK):
                q = batch[i:i + QUERY_BLOCK]
                start = self._descend(self.x[q], k)
                found.append(self._search(self.x[q], start, beam, near)[0])
            inside = self._brute(batch, batch, beam // 2)
            self._connect(near, batch, np.concatenate([np.concatenate(found), inside], axis=1))
            done += len(batch)
        return near

    def _brute(self, rows: np.ndarray, among: np.ndarray, count: int) -> np.ndarray:
        out = np.full((len(rows), min(count, max(len(among) - 1, 1))), -1, dtype=np.int32)
        for i in range(0, len(rows), QUERY_BLOCK):
            s = self.x[rows[i:i + QUERY_BLOCK]] @ self.x[among].T
            s[rows[i:i + QUERY_BLOCK, None] == among] = -2
            top = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
            out[i:i + QUERY_BLOCK] = np.where(np.take_along_axis(s, top, 1) > -2, among[top], -1)
        return out

    def _select(self, rows: np.ndarray, cands: np.ndarray, width: int) -> np.ndarray:
        """Up to ``width`` neighbours: nearest first, passing over candidates
        that lie nearer to a chosen one than to the node, then filling up."""
        out = np.full((len(rows), width), -1, dtype=np.int32)
        for i in range(0, len(rows), 256):
            r, c = rows[i:i + 256], cands[i:i + 256]
            ok = (c >= 0) & (c != r[:, None])
            s = np.where(ok, np.einsum("qd,qcd->qc", self.x[r], self.x[np.maximum(c, 0)]), -2)
            order = np.argsort(-s, axis=1, kind="stable")[:, :3 * width]
            c, s = np.take_along_axis(c, order, 1), np.take_along_axis(s, order, 1)
            same = np.sort(c, axis=1)
            v = self.x[np.maximum(c, 0)]
            between = np.einsum("qad,qbd->qab", v, v)
            free = s > -2
            if (same[:, 1:] == same[:, :-1]).any():
                twin = np.tril(c[:, :, None] == c[:, None, :], -1).any(axis=2)
                free &= ~twin
            chosen = np.zeros_like(free)
            taken = np.zeros(len(r), dtype=int)
            for j in range(c.shape[1]):
                shaded = (chosen & (between[:, j, :] > s[:, j, None])).any(axis=1)
                pick = free[:, j] & ~shaded & (taken < width)
                chosen[:, j] = pick
                taken += pick
            rank = np.where(chosen, 0, np.where(free, 1, 2)) * (c.shape[1] + 1) + np.arange(c.shape[1])
            best = np.argsort(rank, axis=1, kind="stable")[:, :width]
            got = np.where(np.take_along_axis(free, best, 1), np.take_along_axis(c, best, 1), -1)
            out[i:i + 256, :got.shape[1]] = got
        return out

    def _connect(self, near: np.ndarray, rows: np.ndarray, cands: np.ndarray) -> None:
        width = near.shape[1]
        near[rows] = self._select(rows, cands, width)
        # Reverse links: a node keeps the best of its own and the new ones.
        src = np.repeat(rows, width)
        dst = near[rows].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
        most = min(int(count.max()) if len(count) else 0, 4 * width)
        if not most:
            return
        for i in range(0, len(nodes), 4096):
            s = slice(i, i + 4096)
            at = first[s, None] + np.arange(most)
            new = np.where(np.arange(most) < count[s, None], src[np.minimum(at, len(src) - 1)], -1)
            near[nodes[s]] = self._select(nodes[s], np.concatenate([near[nodes[s]], new], axis=1), width)

    def _descend(self, q: np.ndarray, k: int) -> np.ndarray:
        """Entry nodes for layer ``k``: one-beam searches from the top."""
        start = np.full((len(q), 1), self.order[0], dtype=np.int32)
        for layer in range(len(self.sizes) - 1, k, -1):
            start = self._search(q, start, 4, self.layers[layer])[0]
        return start

    def _search(self, q: np.ndarray, start: np.ndarray, beam: int, near: np.ndarray):
        """Best ``beam`` nodes of each query: ``(ids, similarities)``, -1
        where there are fewer.  All queries step together."""
        n = len(q)
        seen = np.zeros((n, len(self.x)), dtype=bool)
        ids = np.full((n, beam), -1, dtype=np.int32)
        sims = np.full((n, beam), -2, dtype=np.float32)
        open_ = np.zeros((n, beam), dtype=bool)
        width = min(start.shape[1], beam)
        start = start[:, :width]
        ok = start >= 0
        ids[:, :width] = start
        sims[:, :width] = np.where(ok, np.einsum("qd,qcd->qc", q, self.x[np.maximum(start, 0)]), -2)
        open_[:, :width] = ok
        rows = np.repeat(np.arange(n), width)[ok.ravel()]
        seen[rows, start[ok]] = True
        live = np.arange(n)
        while live.size:
            score = np.where(open_[live], sims[live], -3)
            take = min(EXPAND, beam)
            best = np.argpartition(-score, take - 1, axis=1)[:, :take]
            here = np.take_along_axis(score, best, 1) > -3
            alive = here.any(axis=1)
            live, best, here = live[alive], best[alive], here[alive]
            if not live.size:
                break
            at = np.where(here, ids[live[:, None], best], -1)
            open_[live[:, None], best] = False
            new = np.where(at[:, :, None] >= 0, near[np.maximum(at, 0)], -1).reshape(len(live), -1)
            fresh = (new >= 0) & ~seen[live[:, None], np.maximum(new, 0)]
            seen[np.repeat(live, fresh.sum(axis=1)), new[fresh]] = True
            # A node reached twice in one step counts once.
            order = np.argsort(new, axis=1, kind="stable")
            s = np.take_along_axis(new, order, 1)
            twin = np.zeros_like(fresh)
            np.put_along_axis(twin, order[:, 1:], s[:, 1:] == s[:, :-1], 1)
            fresh &= ~twin
            some = fresh.any(axis=1)
            live, new, fresh = live[some], new[some], fresh[some]
            if not live.size:
                live = np.flatnonzero(open_.any(axis=1))
                continue
            r, c = np.nonzero(fresh)
            got = np.full(new.shape, -2, dtype=np.float32)
            got[r, c] = np.einsum("id,id->i", q[live[r]], self.x[new[r, c]])
            all_s = np.concatenate([sims[live], got], axis=1)
            all_i = np.concatenate([ids[live], new], axis=1)
            all_o = np.concatenate([open_[live], fresh], axis=1)
            top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sims[live] = np.take_along_axis(all_s, top, 1)
            ids[live] = np.where(sims[live] > -2, np.take_along_axis(all_i, top, 1), -1)
            open_[live] = np.take_along_axis(all_o, top, 1) & (sims[live] > -2)
            live = np.flatnonzero(open_.any(axis=1))
        return ids, sims

    def query(self, q: np.ndarray, beam: int):
        q = np.ascontiguousarray(q, dtype=np.float32)
        return self._search(q, self._descend(q, 0), beam, self.layers[0])

    def dump(self) -> list[bytes]:
        return [self.order.astype(np.int32).tobytes(), np.array(self.sizes, np.int32).tobytes(),
                b"".join(x.tobytes() for x in self.layers)]

    @classmethod
    def load(cls, vectors: np.ndarray, order: bytes, sizes: bytes, layers: bytes, links: int = LINKS) -> Graph:
        g = cls.__new__(cls)
        g.x = np.ascontiguousarray(vectors, dtype=np.float32)
        g.order, g.sizes = np.frombuffer(order, np.int32), np.frombuffer(sizes, np.int32).tolist()
        flat, g.layers, at = np.frombuffer(layers, np.int32), [], 0
        for k in range(len(g.sizes)):
            w = 2 * links if k == 0 else links
            g.layers.append(flat[at:at + len(g.x) * w].reshape(-1, w))
            at += len(g.x) * w
        return g


def neighbours(graph: Graph, exact: np.ndarray, q: np.ndarray, threshold: float, beam: int):
    """``(query, node)`` links of a block of queries at a beam; a query whose
    beam is full of links is repeated with twice the beam."""
    rows = np.arange(len(q))
    out_q, out_n = [], []
    while rows.size:
        wide = min(beam, len(graph.x))
        again = []
        step = max(16, QUERY_BLOCK * BEAM // max(wide, BEAM))
        for i in range(0, len(rows), step):
            r = rows[i:i + step]
            if wide >= MAX_BEAM or wide == len(graph.x):
                a, b = np.nonzero(q[r] @ exact.T >= threshold - 1e-9)
            else:
                ids, sims = graph.query(q[r], wide)
                full = (sims >= threshold - _SLACK).all(axis=1)
                again.append(r[full])
                a, b = np.nonzero((sims >= threshold - _SLACK) & (ids >= 0) & ~full[:, None])
                b = ids[a, b]
            ok = np.einsum("id,id->i", q[r[a]], exact[b]) >= threshold
            out_q.append(r[a[ok]])
            out_n.append(b[ok])
        rows = np.concatenate(again) if again else np.zeros(0, int)
        beam *= 2
    return np.concatenate(out_q), np.concatenate(out_n)


def drawn_links(exact: np.ndarray, q: np.ndarray, threshold: float, audit: int, same: bool, seed: int = 7):
    """Queries drawn uniformly, in blocks, until ``audit`` of them have a true
    link (found by all cosines; a vector's link with itself is none) or
    ``DRAWS`` have been looked at: ``query, its links``."""
    order, out = np.random.default_rng(seed).permutation(len(q))[:DRAWS], []
    step = max(1, min(256, (1 << 24) // max(1, len(exact))))
    for i in range(0, len(order), step):
        rows = order[i:i + step]
        a, b = np.nonzero(q[rows] @ exact.T >= threshold)
        if same:
            a, b = a[rows[a] != b], b[rows[a] != b]
        for k in np.unique(a):
            out.append((int(rows[k]), b[a == k]))
        if len(out) >= audit:
            break
    return out


def audited_beam(graph: Graph, exact: np.ndarray, q: np.ndarray, threshold: float, beam: int, goal: float,
                 audit: int, same: bool = False) -> tuple[int, float]:
    """The beam at which the audited queries' mean recall reaches the goal,
    and that recall.

    Each query counts alike, so a hot group's many links do not hide the few
    of others.  A beam that would not do at ``MAX_BEAM`` becomes ``MAX_BEAM``,
    where queries are answered by all cosines.  ``same``: ``q`` is ``exact``.
    """
    drawn = drawn_links(exact, q, threshold, audit, same)
    if not drawn:
        return beam, 1.0
    pick = np.array([k for k, _ in drawn])
    while True:
        a, b = neighbours(graph, exact, q[pick], threshold, beam)
        found: list[set] = [set() for _ in drawn]
        for i, n in zip(a.tolist(), b.tolist()):
            found[i].add(n)
        recall = float(np.mean([len(found[i].intersection(links.tolist())) / len(links) for i, (_, links) in enumerate(drawn)]))
        if recall >= goal or beam >= min(MAX_BEAM, len(graph.x)):
            return beam, recall
        beam *= 2


SHARD = "dim int, cell int, sub int, ids binary, mult binary, raw binary, order binary, sizes binary, layers binary"
VISITORS = "dim int, cell int, sub int, block int, q_ids binary, q_mult binary, q_raw binary"


def _group(table):
    """``ids, mult, raw`` of a group's rows, by id."""
    ids, mult = table.column("rep").to_numpy(), table.column("mult").to_numpy()
    raw = np.frombuffer(b"".join(table.column("raw").to_pylist()), np.float64).reshape(len(ids), -1)
    order = np.argsort(ids)
    return ids[order], mult[order], raw[order]


def _build(table):
    ids, mult, raw = _group(table)
    a, b, c = Graph(unit(raw)).dump()
    return pa.table({name: table.column(name)[:1] for name in ("dim", "cell", "sub")}
                    | {"ids": [ids.tobytes()], "mult": [mult.tobytes()], "raw": [raw.tobytes()],
                       "order": [a], "sizes": [b], "layers": [c]})


def _pack(table):
    ids, mult, raw = _group(table)
    return pa.table({name: table.column(name)[:1] for name in ("dim", "cell", "sub", "block")}
                    | {"q_ids": [ids.tobytes()], "q_mult": [mult.tobytes()], "q_raw": [raw.tobytes()]})


def visits(cell: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the vectors of ``cell`` query ``other``: of two cells, one does."""
    return (cell != other) & (((cell + other) % 2 == 0) == (cell < other))


def _by_dim(batch: pa.RecordBatch, step: int):
    """``rows, dim, vectors`` of at most ``step`` rows of a batch."""
    raw = batch.column("raw").to_pylist()
    sizes = np.array([len(x) // 8 for x in raw])
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        for i in range(0, len(at), step):
            rows = at[i:i + step]
            yield rows, dim, unit(np.frombuffer(b"".join(raw[r] for r in rows), np.float64).reshape(-1, dim))


def _assign(pivots, routes: dict):
    """Adds ``dim, cell, visits`` to the classes; a dimension without pivots is one cell."""
    def run(batch: pa.RecordBatch):
        dims, cells = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
        met: list = [[]] * batch.num_rows
        for rows, dim, x in _by_dim(batch, 256):
            dims[rows] = dim
            if dim not in routes:
                continue
            count, margin = routes[dim]
            s = x.astype(np.float32) @ pivots.value[dim][:count].T
            cell = s.argmax(axis=1)
            cells[rows] = cell
            near = s >= s.max(axis=1, keepdims=True) - margin
            near &= visits(cell[:, None], np.arange(s.shape[1]))
            for i, r in enumerate(rows):
                met[r] = np.flatnonzero(near[i]).tolist()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(dims), pa.array(cells), pa.array(met, pa.list_(pa.int32()))],
            names=[*batch.schema.names, "dim", "cell", "visits"])
    return run


def _gaps(pivots, counts: dict, drawn, threshold: float):
    """``dim, count, query, bin, n``: links of the drawn queries, by the margin
    in ``1 / BINS`` that it takes for the two cells to meet, for each number of
    pivots in ``counts[dim]``."""
    def run(batch: pa.RecordBatch):
        own = batch.column("rep").to_numpy()
        out, of_query = [], {}
        for rows, dim, exact in _by_dim(batch, 1024):
            if dim not in drawn.value:
                continue
            p, (ids, q) = pivots.value[dim], drawn.value[dim]
            x, q32 = exact.astype(np.float32), q.astype(np.float32)
            a, b = np.nonzero(x @ q32.T >= threshold - _SLACK)
            ok = (own[rows[a]] != ids[b]) & (np.einsum("id,id->i", exact[a], q[b]) >= threshold)
            a, b = a[ok], b[ok]
            if dim not in of_query:
                of_query[dim] = {}
            for count in counts[dim]:
                if count not in of_query[dim]:
                    of_query[dim][count] = _places(q32, p[:count])
                q_cell, q_top = of_query[dim][count]
                cell, top = _places(x, p[:count])
                away = np.where(visits(cell[a], q_cell[b]), top[a] - np.einsum("id,id->i", x[a], p[q_cell[b]]),
                                q_top[b] - np.einsum("id,id->i", q32[b], p[cell[a]]))
                step = np.where(cell[a] == q_cell[b], 0, np.ceil(away * BINS)).astype(np.int64)
                pair, n = np.unique(np.stack([ids[b], step]), axis=1, return_counts=True)
                out.append((np.full(len(n), dim), np.full(len(n), count), *pair, n))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols],
                                         names=["dim", "count", "query", "bin", "n"])
    return run


def _places(x: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector, and its cosine."""
    cell, top = np.zeros(len(x), np.int64), np.zeros(len(x), np.float32)
    for i in range(0, len(x), 256):
        s = x[i:i + 256] @ p.T
        cell[i:i + 256], top[i:i + 256] = s.argmax(axis=1), s.max(axis=1)
    return cell, top


def _mean_visits(x: np.ndarray, p: np.ndarray, margin: float) -> float:
    met = 0
    for i in range(0, len(x), 256):
        s = x[i:i + 256].astype(np.float32) @ p.T
        top = s.max(axis=1, keepdims=True)
        met += int(((s >= top - margin) & visits(s.argmax(axis=1)[:, None], np.arange(len(p)))).sum())
    return met / max(1, len(x))


def _low(h: str, share: Column) -> Column:
    """Rows whose hash lies in the lowest ``share`` of the range."""
    return F.expr(h).cast("double") / 2.0**64 + 0.5 <= share


def _cells(classes: DataFrame, sizes: list, cell_rows: int, shard_bytes: int, min_shards: int):
    """The pivots of each dimension that has more than one cell, broadcast."""
    spark = classes.sparkSession
    total, plan = sum(r["n"] * r["dim"] for r in sizes), []
    for r in sizes:
        n, dim = r["n"], r["dim"]
        cells = max(-(-n // cell_rows), -(-8 * n * dim // shard_bytes), min(min_shards, n // 256))
        cells = min(cells, int(PIVOT_BYTES * (n * dim / total) / (4 * dim)))
        if cells > 1:
            plan.append((dim, cells, (4 * cells + 16) / n))
    pivots: dict = {}
    if plan:
        # Of the hashes' low end, the lowest: what meets in a task follows the cells.
        low = (classes.withColumn("dim", (F.octet_length("raw") / 8).cast("int"))
               .join(F.broadcast(spark.createDataFrame(plan, "dim int, cells int, share double")), "dim")
               .withColumn("h", F.expr("xxhash64(rep, 3)")).where(_low("h", F.col("share"))))
        least = Window.partitionBy("dim").orderBy("h", "rep")
        rows = (low.withColumn("r", F.row_number().over(least)).where(F.col("r") <= F.col("cells"))
                .select("dim", "r", "raw").collect())
        for r in sorted(rows, key=lambda r: (r["dim"], r["r"])):
            pivots.setdefault(r["dim"], []).append(np.frombuffer(r["raw"], np.float64))
    return spark.sparkContext.broadcast({d: unit(np.stack(v)).astype(np.float32) for d, v in pivots.items()})


def _routes(classes: DataFrame, sizes: list, pivots, threshold: float, shard_rows: int, min_shards: int) -> dict:
    """``dim: (pivots to use, margin)`` of each dimension with pivots.

    A prefix of the pivots is a sample of the classes as well.  Among the whole
    and its quarters the one with the least work is taken: a query of a graph
    takes about the cube root of its size, its share of the build twice that."""
    spark = classes.sparkSession
    sizes = [r for r in sizes if r["dim"] in pivots.value]
    if not sizes:
        return {}
    counts: dict = {}
    for r in sizes:
        count, least = len(pivots.value[r["dim"]]), max(min_shards, -(-r["n"] // shard_rows))
        counts[r["dim"]] = [count]
        while count // 4 >= least:
            count //= 4
            counts[r["dim"]].append(count)
    n, total = sum(r["n"] for r in sizes), sum(8 * r["n"] * r["dim"] for r in sizes)
    share = min(DRAWS, PIVOT_BYTES * n // total) / n
    mine = classes.withColumn("dim", (F.octet_length("raw") / 8).cast("int")).where(F.col("dim").isin(list(counts)))
    drawn: dict = {}
    for r in mine.where(_low("xxhash64(rep, 7)", F.lit(share))).select("dim", "rep", "raw").collect():
        drawn.setdefault(r["dim"], []).append((r["rep"], np.frombuffer(r["raw"], np.float64)))
    queries = spark.sparkContext.broadcast(
        {d: (np.array([k for k, _ in v], np.int64), unit(np.stack([x for _, x in v]))) for d, v in drawn.items()})
    links = (arrow_map(classes.select("rep", "raw"), _gaps(pivots, counts, queries, threshold),
                       "dim bigint, count bigint, query bigint, bin bigint, n bigint")
             .groupBy("dim", "count", "query", "bin").agg(F.sum("n").alias("n")))
    links = links.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("dim", "count", "query")))
    found: dict = {}
    for r in links.groupBy("dim", "count", "bin").agg(F.sum("share").alias("share")).orderBy("dim", "count", "bin").collect():
        found.setdefault((r["dim"], r["count"]), []).append((r["bin"], r["share"]))
    out = {}
    for r in sizes:
        dim, best = r["dim"], None
        for count in counts[dim]:
            steps, shares = np.array(found.get((dim, count), [(0, 0.0)])).T
            linked = shares.sum()
            reached = np.cumsum(shares) >= (1 - ROUTE_LOSS) * linked - 1e-9
            # Half a step more, as cosines of single precision differ in their last digits.
            margin = float((steps[np.argmax(reached)] + 0.5) / BINS) * ROUTE_WIDER
            if share < 1 and linked < AUDIT:
                margin = max(margin, 3 * float(np.sqrt(2 * max(0.0, 1 - threshold * threshold) / dim)))
            met = _mean_visits(queries.value[dim][1], pivots.value[dim][:count], margin) if dim in drawn else 0.0
            work = (3 + met) * (r["n"] / count) ** (1 / 3)
            if best is None or work < best[0]:
                best = work, count, margin
        out[dim] = best[1:]
    return out


def _match(threshold: float, goal: float, audit: int, beam: int):
    """A shard pair to link counts (``node, n``) and joining links (``node,
    other``)."""
    def one(row):
        dim = row["dim"]
        ids, mult = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["mult"], np.int64)
        exact = unit(np.frombuffer(row["raw"], np.float64).reshape(-1, dim))
        graph = Graph.load(exact, row["order"], row["sizes"], row["layers"])
        same = row["q_ids"] is None
        q_ids, q_mult, q = ids, mult, exact
        if not same:
            q_ids, q_mult = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_mult"], np.int64)
            q = unit(np.frombuffer(row["q_raw"], np.float64).reshape(-1, dim))
        wide, recall = audited_beam(graph, exact, q, threshold, beam, goal, audit, same)
        count, q_count = np.zeros(len(ids), np.int64), np.zeros(len(q_ids), np.int64)
        root = np.arange(len(ids) + (0 if same else len(q_ids)))
        shift = 0 if same else len(ids)
        links = []

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i in range(0, len(q), QUERY_BLOCK):
            a, b = neighbours(graph, exact, q[i:i + QUERY_BLOCK], threshold, wide)
            a = a + i
            if same:
                a, b = a[a != b], b[a != b]
            np.add.at(q_count, a, mult[b])
            if not same:
                np.add.at(count, b, q_mult[a])
            for x, y in zip(a.tolist(), b.tolist()):
                rx, ry = top(x + shift), top(y)
                if rx != ry:
                    root[max(rx, ry)] = min(rx, ry)
                    links.append((q_ids[x], ids[y]))
        node, n = (q_ids, q_count) if same else (np.concatenate([ids, q_ids]), np.concatenate([count, q_count]))
        node, n = node[n > 0], n[n > 0]
        k = len(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([node, np.array([x for x, _ in links], np.int64)])),
             pa.array(np.concatenate([n, np.zeros(k, np.int64)])),
             pa.array([None] * len(node) + [int(y) for _, y in links], pa.int64()),
             pa.array([wide] * (len(node) + k), pa.int32()), pa.array([recall] * (len(node) + k), pa.float64())],
            names=["node", "n", "other", "beam", "recall"])

    def run(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            yield one({name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)})
    return run


def _valid(batch: pa.RecordBatch):
    """``key, raw`` of vectors that can link: present, finite, not zero."""
    keys, raw = [], []
    column = batch.column(1)
    flat = column.flatten()
    sizes = column.value_lengths().fill_null(0).to_numpy()
    bad = np.array(flat.is_null()) if flat.null_count else None
    values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    ids = batch.column(0).to_numpy()
    fine = np.isfinite(values)
    if bad is not None:
        fine &= ~bad
    for i, (a, b) in enumerate(zip(ends - sizes, ends)):
        if b > a and fine[a:b].all() and values[a:b].any():
            keys.append(ids[i])
            raw.append(values[a:b].tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(raw, pa.binary())], names=["key", "raw"])


def _tasks(dealt: DataFrame, shard_rows: int, shard_bytes: int) -> tuple[DataFrame, int]:
    """``dim, cell, subs, blocks, first`` of every cell: its shards, the
    blocks of their visitors and the number of its first pair; and the number
    of tasks.  One row for about ``CELL_ROWS`` classes is on the driver."""
    members = dealt.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"))
    guests = (dealt.select("dim", F.explode("visits").alias("cell")).groupBy("dim", "cell")
              .agg(F.count(F.lit(1)).alias("guests")))
    rows, first = [], 0
    for r in members.join(guests, ["dim", "cell"], "left").orderBy("dim", "cell").collect():
        width = 8 * r["dim"]
        subs = max(-(-r["n"] // shard_rows), -(-r["n"] * width // shard_bytes))
        guests_n = (r["guests"] or 0) + (r["n"] if subs > 1 else 0)
        blocks = max(1, -(-guests_n // min(VISIT_ROWS, shard_rows)), -(-guests_n * width // shard_bytes))
        rows.append((r["dim"], r["cell"], subs, blocks, first))
        first += subs * (1 + blocks)
    table = dealt.sparkSession.createDataFrame(rows, "dim int, cell int, subs int, blocks int, first bigint")
    return F.broadcast(table), max(1, min(first, MAX_TASKS))


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                 shard_rows: int = SHARD_ROWS, shard_bytes: int = SHARD_BYTES, min_shards: int = MIN_SHARDS, goal: float = RECALL_GOAL,
                 audit: int = AUDIT, beam: int = BEAM) -> DataFrame:
    """Per row ``key, n_links, component_id, kept``: vectors linked with
    cosine at least ``threshold``, the smallest id of the component.

    Edge cases: a vector that is NULL, empty, zero, or holds NULL or
    non-finite components links with nothing; vectors of different lengths do
    not link.  Copies link with each other.  NULL or repeated ids: every row
    is its own vector (ordered by id, NULL last, then components), and of rows
    that tie only the first of the component is ``kept``.  Empty tables give
    no rows.  Other columns are ignored.
    """
    table, plain = keyed(vectors.select(F.col(key).alias("_id"), F.col(vector).alias("_vector")), "_id", "_vector")
    rows = table.select(F.col(KEY).alias("key"), F.col("_vector").alias("v"))
    valid = materialize(arrow_map(rows, _valid, "key bigint, raw binary").withColumn("same", F.md5("raw")), "valid")
    classes = materialize(valid.groupBy("same").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("mult"),
                                                    F.any_value("raw").alias("raw")), "classes")
    sizes = (classes.groupBy((F.octet_length("raw") / 8).cast("int").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy("dim").collect())
    pivots = _cells(classes, sizes, min(CELL_ROWS, shard_rows), shard_bytes, min_shards)
    routes = _routes(classes, sizes, pivots, threshold, shard_rows, min_shards)
    dealt = materialize(arrow_map(classes, _assign(pivots, routes), "same string, rep bigint, mult bigint, raw binary, "
                                  "dim int, cell int, visits array<int>"), "cells")
    discard(classes)
    tasks, parts = _tasks(dealt, shard_rows, shard_bytes)
    own = dealt.join(tasks, ["dim", "cell"]).withColumn("sub", F.pmod(F.xxhash64("rep"), "subs").cast("int"))
    graphs = materialize(own.groupBy("dim", "cell", "sub").applyInArrow(_build, SHARD), "graphs")
    # A vector meets all shards of a cell that it visits, and the later ones of its own cell.
    columns = ["dim", "rep", "mult", "raw", "cell", "sub", "blocks"]
    away = (dealt.select("dim", "rep", "mult", "raw", F.explode("visits").alias("cell")).join(tasks, ["dim", "cell"])
            .withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).select(*columns))
    home = (own.where(F.col("sub") < F.col("subs") - 1)
            .withColumn("sub", F.explode(F.sequence(F.col("sub") + 1, F.col("subs") - 1))).select(*columns))
    visitors = (away.union(home).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(5)), "blocks").cast("int"))
                .groupBy("dim", "cell", "sub", "block").applyInArrow(_pack, VISITORS))
    alone = graphs.select("*", *(F.lit(None).cast(t).alias(c) for c, t in
                                 (("block", "int"), ("q_ids", "binary"), ("q_mult", "binary"), ("q_raw", "binary"))))
    pairs = (graphs.join(visitors.hint("shuffle_hash"), ["dim", "cell", "sub"]).unionByName(alone).join(tasks, ["dim", "cell"])
             # One task for each pair, by its number: hashes would collide.
             .withColumn("pair", F.expr("first + sub * (1L + blocks) + coalesce(block + 1, 0)"))
             .repartitionById(parts, F.pmod("pair", F.lit(parts)).cast("int"))
             .drop("pair", "first", "subs", "blocks", "block"))
    found = materialize(arrow_map(pairs, _match(threshold, goal, audit, beam),
                                  "node bigint, n bigint, other bigint, beam int, recall double"), "found")
    counts = found.where(F.col("other").isNull()).groupBy("node").agg(F.sum("n").alias("n"))
    comps = components(found.where(F.col("other").isNotNull()).select(F.col("node").alias("a"), F.col("other").alias("b")))
    discard(graphs)
    zero = F.lit(0).cast("bigint")
    of_class = (dealt.select("same", "rep", "mult")
                .join(counts, F.col("rep") == counts["node"], "left").drop("node")
                .join(comps, F.col("rep") == comps["node"], "left")
                .select("same", (F.coalesce("n", zero) + F.col("mult") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("comp")))
    mine = valid.select("key", "same").join(of_class, "same").select("key", "n_links", "comp")
    out = (table.select(F.col(KEY).alias("key")).join(mine, "key", "left")
           .select("key", F.coalesce("n_links", zero).alias("n_links"), F.coalesce("comp", "key").alias("comp")))
    kept = (F.col("key") == F.col("comp")).alias("kept")
    if plain:
        return out.select(F.col("key").alias(key), "n_links", F.col("comp").alias("component_id"), kept)
    a = table.select(F.col(KEY).alias("key"), F.col("_id").cast("bigint").alias("own"))
    b = table.select(F.col(KEY).alias("comp"), F.col("_id").cast("bigint").alias("first"))
    return (out.join(a, "key").join(b, "comp")
            .select(F.col("own").alias(key), "n_links", F.col("first").alias("component_id"), kept))
