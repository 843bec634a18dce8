"""Embedding near-duplicates by hierarchical navigable small-world graphs, one for each shard.

Vectors are spread over shards by a hash; each shard's graph is built in one task, by batches: a batch searches the graph as
it stands and is linked to what it finds and to its own members.  Every vector then queries every shard.  A search keeps a
beam of the best nodes; a query whose beam holds nothing below the threshold is searched again with a beam twice as wide.
Queries that no beam settles are compared with all vectors of the shard, and so are audited queries: as many of each block as
it takes to see enough that have links, which where links are rare is all of them, and all where the recall falls short.  Cosines are verified in double precision.  A task reports for each query how many links it has and, for the components, a spanning forest of the
links it saw, never the pairs.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, stored

#: Beams up to this width; beyond it a query is compared with the whole shard.
WIDEST = 256
#: Bytes of vectors that meet a graph in one task.
LOT = 16 << 20


def _unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, np.float64) for r in rows]) if len(rows) else np.zeros((0, 1))
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Graph:
    """Layers of neighbour lists (-1 where empty) over unit vectors; the top layer's nodes are the entries."""

    def __init__(self, x: np.ndarray, degree: int = 16, beam: int = 48):
        self.x = x.astype(np.float32)
        self.degree, self.beam = degree, beam
        n = len(x)
        # every node is on layer 0, one in ``degree`` of a layer on the next
        order = np.random.default_rng(n).permutation(n)
        self.layers: list[tuple[np.ndarray, np.ndarray]] = []  # nodes of the layer, their neighbours by place in it
        sizes = [n]
        while sizes[-1] > 4 * degree:
            sizes.append(sizes[-1] // degree)
        self.order = order
        for size in reversed(sizes):  # from the top; a layer holds the first nodes of the order
            self._build(size, 2 * degree if size == n else degree)

    def _build(self, size: int, width: int) -> None:
        nodes = self.x[self.order[:size]]
        links = np.full((size, width), -1, np.int32)
        self.layers.append((nodes, links))
        done = 0
        while done < size:
            more = min(size - done, max(4 * self.degree, min(done, 1024)))
            new = np.arange(done, done + more)
            found = [nodes[new] @ nodes[new].T]
            ids = [np.broadcast_to(new, (more, more))]
            np.fill_diagonal(found[0], -np.inf)
            if done:
                start = self._descend(nodes[new], len(self.layers) - 1)
                start = np.where(start < done, start, 0)  # entries that are in this layer already
                near, score = self._search(len(self.layers) - 1, nodes[new], start, self.beam, done)
                found.append(np.where(near >= 0, score, -np.inf))
                ids.append(near)
            score, ids = np.concatenate(found, axis=1), np.concatenate(ids, axis=1)
            take = min(score.shape[1], 3 * width)
            best = np.argpartition(-score, take - 1, axis=1)[:, :take]
            score, ids = np.take_along_axis(score, best, 1), np.take_along_axis(ids, best, 1)
            self._link(nodes, links, new, ids, score, width)
            done += more

    def _link(self, nodes, links, new, ids, score, width) -> None:
        chosen = self._diverse(nodes, ids, score, width // 2)
        source = np.repeat(new, chosen.shape[1])
        target = chosen.reshape(-1)
        ok = target >= 0
        source, target = source[ok], target[ok]
        # both directions; a full list is chosen again from its old and new neighbours
        a, b = np.concatenate([source, target]), np.concatenate([target, source])
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        ends = np.append(first[1:], len(a))
        many = ends - first
        old = links[a[first]]
        wide = np.full((len(first), width + int(many.max(initial=0))), -1, np.int64)
        wide[:, :width] = old
        wide[np.repeat(np.arange(len(first)), many), width + np.arange(len(a)) - np.repeat(first, many)] = b
        for lo in range(0, len(first), 256):
            rows = wide[lo : lo + 256]
            rows = np.sort(rows, axis=1)[:, ::-1]
            rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = -1  # a neighbour once
            own = a[first[lo : lo + 256]]
            close = np.einsum("ijk,ik->ij", nodes[rows], nodes[own])
            close[rows < 0] = -np.inf
            links[own] = self._diverse(nodes, rows, close, width)

    def _diverse(self, nodes, ids, score, width) -> np.ndarray:
        """Up to ``width`` ids a row: the closest first, those closer to a chosen one than to the row's node only as a fill."""
        count = min(ids.shape[1], 4 * width)
        rank = np.argsort(-score, axis=1, kind="stable")[:, :count]
        ids, score = np.take_along_axis(ids, rank, 1), np.take_along_axis(score, rank, 1)
        out = np.full((len(ids), width), -1, np.int32)
        for lo in range(0, len(ids), 256):
            i, s = ids[lo : lo + 256], score[lo : lo + 256]
            v = nodes[np.maximum(i, 0)]
            apart = v @ v.transpose(0, 2, 1)
            taken = np.zeros(i.shape, bool)
            number = np.zeros(len(i), np.int64)
            for c in range(count):
                covered = (taken[:, :c] & (apart[:, c, :c] > s[:, c : c + 1])).any(axis=1)
                good = ~covered & (s[:, c] > -np.inf) & (number < width)
                taken[:, c] = good
                number += good
            key = np.where(s == -np.inf, 2, np.where(taken, 0, 1))
            first = np.argsort(key, axis=1, kind="stable")[:, :width]
            picked = np.where(np.take_along_axis(s, first, 1) == -np.inf, -1, np.take_along_axis(i, first, 1))
            out[lo : lo + 256, : picked.shape[1]] = picked
        return out

    def _descend(self, q: np.ndarray, layer: int) -> np.ndarray:
        """The best node found on the layers above ``layer``, as a place that holds on ``layer`` too."""
        at = np.zeros((len(q), 1), np.int64)
        for k in range(layer):
            at, _ = self._search(k, q, at, 4, len(self.layers[k][0]))
            at = at[:, :1]
        return at

    def _search(self, layer: int, q: np.ndarray, start: np.ndarray, beam: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam of each query, best first: places and cosines. All queries take a step at a time."""
        nodes, links = self.layers[layer]
        rows = len(q)
        ids = np.full((rows, beam), -1, np.int64)
        score = np.full((rows, beam), -np.inf, np.float32)
        opened = np.ones((rows, beam), bool)
        ids[:, : start.shape[1]] = start[:, :beam]
        score[:, : start.shape[1]] = np.where(start >= 0, np.einsum("ijk,ik->ij", nodes[start], q), -np.inf)[:, :beam]
        opened[:, : start.shape[1]] = False
        seen = np.zeros((rows, (limit >> 3) + 1), np.uint8)
        live = np.arange(rows)
        np.bitwise_or.at(seen, (live[:, None], start >> 3), (1 << (start & 7)).astype(np.uint8))
        while len(live):
            waiting = np.where(opened[live] | (ids[live] < 0), -np.inf, score[live])
            step = np.argsort(-waiting, axis=1, kind="stable")[:, :2]  # two nodes of the beam at a time
            ready = np.take_along_axis(waiting, step, 1) > -np.inf
            go = ready[:, 0]
            live, step, ready = live[go], step[go], ready[go]
            if not len(live):
                break
            opened[live[:, None], step] |= ready
            here = np.where(ready, ids[live[:, None], step], -1)
            near = np.where(here[:, :, None] >= 0, links[here], -1).reshape(len(live), -1).astype(np.int64)
            near[near >= limit] = -1
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            bit = (1 << (near & 7)).astype(np.uint8)
            known = (seen[live[:, None], near >> 3] & bit) > 0
            near[known] = -1
            fresh_r, fresh_c = np.nonzero(near >= 0)
            node = near[fresh_r, fresh_c]
            np.bitwise_or.at(seen, (live[fresh_r], node >> 3), bit[fresh_r, fresh_c])
            value = np.full(near.shape, -np.inf, np.float32)
            value[fresh_r, fresh_c] = np.einsum("ij,ij->i", nodes[node], q[live[fresh_r]])
            all_s = np.concatenate([score[live], value], axis=1)
            all_i = np.concatenate([ids[live], near], axis=1)
            all_o = np.concatenate([opened[live], np.zeros(near.shape, bool)], axis=1)
            best = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            score[live] = np.take_along_axis(all_s, best, 1)
            ids[live] = np.take_along_axis(all_i, best, 1)
            opened[live] = np.take_along_axis(all_o, best, 1)
        rank = np.argsort(-score, axis=1, kind="stable")
        ids, score = np.take_along_axis(ids, rank, 1), np.take_along_axis(score, rank, 1)
        return np.where(score > -np.inf, ids, -1), score

    def met(self, q: np.ndarray, least: float, beam: int) -> tuple[list[np.ndarray], np.ndarray]:
        """For each query the nodes of cosine ``least`` or more that its search met, and the queries that no beam settled.

        Beams widen until one holds a node below ``least``. A query is left over where its beam stays unfilled (it was caught
        on an island of the graph) or holds nothing else at ``WIDEST``, where a wider one costs more than all the vectors.
        """
        q = q.astype(np.float32)
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
        left, n, rest = np.arange(len(q)), len(self.x), [np.zeros(0, np.int64)]
        base = len(self.layers) - 1
        while len(left) and beam < min(n, 2 * WIDEST):
            again = []
            size = max(16, min(1 << 18 >> beam.bit_length(), (1 << 24) // (64 * self.x.shape[1])))
            for lo in range(0, len(left), size):
                rows = left[lo : lo + size]
                ids, score = self._search(base, q[rows], self._descend(q[rows], base), beam, n)
                good = (score >= least - 1e-5) & (ids >= 0)
                for r, i, g in zip(rows, ids, good, strict=True):
                    out[r] = self.order[i[g]]
                unfilled = (ids < 0).any(axis=1)
                rest.append(rows[unfilled])
                again.append(rows[good.all(axis=1) & ~unfilled])
            left, beam = np.concatenate([*again, np.zeros(0, np.int64)]).astype(np.int64), 2 * beam
        return out, np.sort(np.concatenate([*rest, left]))

    def near(self, q: np.ndarray, least: float, beam: int) -> list[np.ndarray]:
        """As ``met``, and queries left over are compared with every node."""
        out, rest = self.met(q, least, beam)
        step = max(1, (1 << 22) // max(1, len(self.x)))
        for lo in range(0, len(rest), step):
            close = q[rest[lo : lo + step]].astype(np.float32) @ self.x.T >= least - 1e-5
            for r, c in zip(rest[lo : lo + step], close, strict=True):
                out[r] = np.flatnonzero(c)
        return out

    def dump(self, vectors: bool = True) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{"x": self.x} if vectors else {}, order=self.order, **{f"links{i}": links for i, (_, links) in enumerate(self.layers)})
        return out.getvalue()

    @staticmethod
    def load(data: bytes, vectors: np.ndarray | None = None) -> Graph:
        """``vectors``: those that the graph was built on, where they were not dumped."""
        got, g = np.load(io.BytesIO(data)), Graph.__new__(Graph)
        g.x, g.order = got["x"] if vectors is None else vectors.astype(np.float32), got["order"]
        g.layers = []
        while f"links{len(g.layers)}" in got:
            links = got[f"links{len(g.layers)}"]
            g.layers.append((g.x[g.order[: len(links)]], links))
        return g


class _Forest:
    """A spanning forest of the links between queries and the nodes ``ids`` of a shard, a query at a time."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.up = ids, np.arange(len(ids))
        self.a: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.b: list[np.ndarray] = [np.zeros(0, np.int64)]

    def add(self, own: int, nodes: np.ndarray) -> None:
        root = self.up[nodes]
        while ((above := self.up[root]) != root).any():
            root = above
        self.up[nodes] = root
        tops, first = (root[:1], np.zeros(1, np.int64)) if (root == root[0]).all() else np.unique(root, return_index=True)
        self.up[tops] = tops[0]
        other = self.ids[nodes[first]]
        other = other[other != own]
        self.a.append(np.full(len(other), own, np.int64))
        self.b.append(other)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(self.a), np.concatenate(self.b)


def links(vectors: DataFrame, least: float = 0.9, shards: int = 12, per_shard: int = 100_000, block: int = 4096, beam: int = 32, recall: float = 0.995, audit: int = 400) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    There are ``shards`` graphs, more where one would exceed ``per_shard`` vectors. Random queries of each
    block are compared with the whole shard until ``audit`` of them have links there, but fewer than ``beam``; a block without
    so many is thereby compared in full. Where the graph meets less than ``recall`` of a query's links, on average over these
    queries or over those with more links, the rest of the block is compared too. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing; so do vectors of different lengths with each
    other, and rows with a null vec_id (their component_id is null). A repeated vec_id counts once (its smallest vector).
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.coalesce((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    usable = given.where(F.col("vec_id").isNotNull() & fine).groupBy("vec_id").agg(F.min("v").alias("v"))
    largest = F.array_max(F.transform("v", F.abs))  # so that no square overflows
    usable = stored(usable.select("vec_id", F.transform("v", lambda x: x / largest).alias("v"), F.size("v").alias("dim")))
    n = usable.count()
    shards = max(shards, -(-n // per_shard))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")

    def build(key, rows):
        rows = rows.sort_values("vec_id")
        exact = _unit(rows.v)
        return pd.DataFrame({"shard": [key[0]], "dim": [key[1]], "ids": [rows.vec_id.to_numpy().tobytes()], "exact": [exact.tobytes()], "graph": [Graph(exact).dump(vectors=False)]})

    graphs = stored(usable.withColumn("shard", shard).groupBy("shard", "dim").applyInPandas(build, "shard int, dim int, ids binary, exact binary, graph binary"))
    parts = max(1, -(-n // block))
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int")
    # a graph is sent once for some blocks, LOT bytes of vectors at most or one block
    lot = F.greatest(F.lit(1), F.floor(F.lit(LOT) / (8 * block * F.col("dim")))).cast("int")
    asked = usable.withColumn("part", part).withColumn("lot", F.floor(F.col("part") / lot).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    sent = graphs.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor(F.lit(parts - 1) / lot).cast("int"))))

    def search(key, rows, graph):
        none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        if not len(rows) or not len(graph):
            return none
        ids = np.frombuffer(graph.ids[0], np.int64)
        exact = np.frombuffer(graph.exact[0]).reshape(len(ids), -1)
        net = Graph.load(graph.graph[0], exact)
        return pd.concat([search_block(some, net, ids, exact) for _, some in rows.groupby("part")])

    def search_block(rows, net, ids, exact):
        rows = rows.sort_values("vec_id")
        mine, q = rows.vec_id.to_numpy(), _unit(rows.v)
        forest, count = _Forest(ids), np.zeros(len(q), np.int64)

        def add(r, nodes):
            count[r] = (ids[nodes] != mine[r]).sum()
            if count[r]:
                forest.add(mine[r], nodes)

        def compare(part):
            step = max(1, (1 << 22) // len(ids))
            for lo in range(0, len(part), step):
                close = q[part[lo : lo + step]] @ exact.T >= least
                for i in np.flatnonzero(close.any(axis=1)):
                    add(part[lo + i], np.flatnonzero(close[i]))

        # audit until enough queries with few links are seen; where links are rare that is the whole block
        order, done, sparse = np.random.default_rng(len(q)).permutation(len(q)), 0, 0
        while done < len(q) and (done < audit or sparse < audit):
            more = order[done : done + max(256, done)]
            compare(more)
            done += len(more)
            sparse += ((count[more] > 0) & (count[more] < beam)).sum()
        test, rest = order[:done], order[done:]
        if len(rest):
            found, open_ = net.met(q, least, beam)
            found = [f[exact[f] @ v >= least] for f, v in zip(found, q, strict=True)]
            met = np.array([(ids[f] != mine[r]).sum() for r, f in enumerate(found)])
            sure = np.setdiff1d(test[count[test] > 0], open_)
            few = sure[count[sure] < beam]
            short = any((met[some] / count[some]).mean() < recall for some in (few, sure[count[sure] >= beam]) if len(some))
            if not short and len(few):
                for r in np.setdiff1d(rest, open_):
                    add(r, found[r])
                rest = np.intersect1d(rest, open_)
            compare(rest)
        a, b = forest.edges()
        linked = np.flatnonzero(count)
        return pd.DataFrame({"a": np.concatenate([mine[linked], a]), "b": np.concatenate([mine[linked], b]), "n": np.concatenate([count[linked], np.zeros(len(a), np.int64)])})

    keys = ["shard", "dim", "lot"]
    seen = stored(asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(search, "a long, b long, n long"))
    counts = seen.where("a = b").groupBy(F.col("a").alias("vec_id")).agg(F.sum("n").alias("n_links"))
    roots = components(seen.where("a <> b")).withColumnRenamed("node", "vec_id")
    out = given.select("vec_id").join(counts, "vec_id", "left").join(roots, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
