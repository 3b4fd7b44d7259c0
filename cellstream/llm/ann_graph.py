"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard.

Rows are dealt to shards of bounded size by a hash. A shard's graph grows by batches: a greedy beam
search from the shard's medoid proposes neighbours of each new row; of these, the nearest is kept
and all are dropped that are nearer to it, by a relaxation factor, than to the new row, again and
again, so that kept edges point in diverse directions; edges back are added and pruned likewise.
Graphs are written once; queries then pass by every shard in batches and beam-search it, and the best
of a query's shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import finite_vector, stored


def _beam(x: np.ndarray, edges: np.ndarray, starts: np.ndarray, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of q the ids and squared distances of the `width` best nodes found, all rows in step; -1 and inf where there are none."""
    n = len(q)
    ids = np.full((n, width), -1)
    far = np.full((n, width), np.inf, np.float32)
    done = np.ones((n, width), bool)
    s = starts[:width]
    ids[:, : len(s)] = s
    far[:, : len(s)] = ((q[:, None, :] - x[s][None]) ** 2).sum(2)
    done[:, : len(s)] = False
    seen = np.zeros((n, len(x)), bool)
    seen[:, s] = True
    live = np.arange(n)
    while len(live):
        pick = np.where(done[live], np.inf, far[live]).argmin(1)
        open_ = ~done[live, pick]
        live, pick = live[open_], pick[open_]
        if not len(live):
            break
        done[live, pick] = True
        near = edges[ids[live, pick]]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        r, c = np.nonzero(fresh)
        seen[live[r], near[r, c]] = True
        d = np.full(near.shape, np.inf, np.float32)
        diff = x[near[r, c]] - q[live[r]]
        d[r, c] = np.einsum("ij,ij->i", diff, diff)
        all_far = np.concatenate((far[live], d), 1)
        best = np.argpartition(all_far, width - 1, 1)[:, :width]
        far[live] = np.take_along_axis(all_far, best, 1)
        ids[live] = np.take_along_axis(np.concatenate((ids[live], np.where(fresh, near, -1)), 1), best, 1)
        done[live] = np.take_along_axis(np.concatenate((done[live], ~fresh), 1), best, 1) | np.isinf(far[live])
    order = np.argsort(far, 1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)


def _pruned(x: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Robust pruning of each node's candidates (-1: none) to at most `degree` edges."""
    c = np.where(candidates == own[:, None], -1, candidates)
    c = np.sort(c, 1)
    c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
    v = x[c]
    d = ((v - x[own][:, None, :]) ** 2).sum(2)
    d[c < 0] = np.inf
    out = np.full((len(own), degree), -1)
    rows = np.arange(len(own))
    for k in range(degree):
        best = d.argmin(1)
        there = np.isfinite(d[rows, best])
        if not there.any():
            break
        out[there, k] = c[rows[there], best[there]]
        diff = v - v[rows, best][:, None, :]
        between = np.einsum("ijk,ijk->ij", diff, diff)
        d[(relax * relax * between <= d) | ~there[:, None]] = np.inf
        d[rows, best] = np.inf
    return out


def _grown(x: np.ndarray, degree: int, width: int, relax: float) -> tuple[np.ndarray, int]:
    """Edges (n x 2 * degree, -1: none) over the rows of x, distinct ones, and the medoid."""
    n = len(x)
    medoid = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n, 2 * degree), -1)
    order = np.random.RandomState(n).permutation(n)
    order = np.concatenate(([medoid], order[order != medoid]))
    at, starts = 1, np.array([medoid])
    while at < n:
        new = order[at : at + min(512, max(8, at // 4))]
        found, _ = _beam(x, edges, starts, x[new], width)
        if at < 4 * len(new) + width:  # the first batches also see each other
            found = np.concatenate((found, np.repeat(new[None], len(new), 0)), 1)
        edges[new, :degree] = _pruned(x, new, found, degree, relax)
        u, k = np.nonzero(edges[new] >= 0)
        to, back = edges[new][u, k], new[u]
        apart = ~(edges[to] == back[:, None]).any(1)  # no edge twice
        to, back = to[apart], back[apart]
        if not len(to):
            at += len(new)
            continue
        by = np.argsort(to, kind="stable")
        to, back = to[by], back[by]
        nodes, first, n_back = np.unique(to, return_index=True, return_counts=True)
        used = (edges[nodes] >= 0).sum(1)
        fits = used + n_back <= 2 * degree
        slot = np.arange(len(to)) - np.repeat(first, n_back)
        ok = np.repeat(fits, n_back)
        edges[nodes] = np.take_along_axis(edges[nodes], np.argsort(edges[nodes] < 0, 1, kind="stable"), 1)
        edges[to[ok], (slot + np.repeat(used, n_back))[ok]] = back[ok]
        for group in np.array_split(np.flatnonzero(~fits), max(1, (~fits).sum() // 256)):
            if len(group):
                wide = np.full((len(group), n_back[group].max()), -1)
                for i, g in enumerate(group):
                    wide[i, : n_back[g]] = back[first[g] : first[g] + n_back[g]]
                many = np.concatenate((edges[nodes[group]], wide), 1)
                edges[nodes[group], :degree] = _pruned(x, nodes[group], many, degree, relax)
                edges[nodes[group], degree:] = -1
        at += len(new)
    return edges, medoid


def _linked_up(x: np.ndarray, edges: np.ndarray, medoid: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges, and starts from which every node is reached: the medoid, and a node of every part that it doesn't reach."""
    starts, reached = [medoid], np.zeros(len(x), bool)
    while True:
        front = np.array(starts[-1:])
        reached[front] = True
        while len(front):
            near = edges[front].ravel()
            near = np.unique(near[near >= 0])
            front = near[~reached[near]]
            reached[front] = True
        if reached.all():
            return edges, np.array(starts)
        starts.append(int(np.flatnonzero(~reached)[0]))


def _built(p: pd.DataFrame, degree: int, width: int, relax: float) -> pd.DataFrame:
    out = []
    for d, g in p.groupby(p["embedding"].str.len()):
        x, node = np.unique(np.stack(g["embedding"].to_numpy()), axis=0, return_inverse=True)
        x = x.astype(np.float32)
        edges, medoid = _grown(x, degree, width, relax)
        edges, starts = _linked_up(x, edges, medoid)
        start = np.zeros(len(x), bool)
        start[starts] = True
        first = np.zeros(len(x), bool)
        for vec_id, e, k in zip(g["vec_id"], g["embedding"], node.ravel()):
            own = [] if first[k] else edges[k][edges[k] >= 0].tolist()
            out.append((p["shard"].iloc[0], int(d), int(k), vec_id, e, own, bool(start[k])))
            first[k] = True
    return pd.DataFrame(out, columns=["shard", "d", "node", "vec_id", "embedding", "edges", "start"])


class Shard:
    """The graph of one shard and one length of vectors."""

    def __init__(self, g: pd.DataFrame):
        n, d = int(g["node"].max()) + 1, int(g["d"].iloc[0])
        self.vectors, self.edges = np.zeros((n, d)), np.full((n, max(1, int(g["edges"].str.len().max()))), -1)
        self.members: list[list[int]] = [[] for _ in range(n)]
        for node, vec_id, e, to in zip(g["node"].astype(int), g["vec_id"].astype(int), g["embedding"], g["edges"]):
            self.vectors[node] = e
            self.members[node].append(vec_id)
            if len(to):
                self.edges[node, : len(to)] = to
        for m in self.members:
            m.sort()
        self.starts = np.unique(g.loc[g["start"].astype(bool), "node"].to_numpy(np.int64))
        self.x = self.vectors.astype(np.float32)  # for the beam; scores come from the vectors as they are

    def answers(self, q: pd.DataFrame, k: int, width: int) -> list[tuple[int, int, float]]:
        out = []
        y = np.stack(q["embedding"].to_numpy())
        wide = max(width, 2 * k + 2, len(self.starts) + k + 1)
        for i in range(0, len(y), 512):
            ids, _ = _beam(self.x, self.edges, self.starts, y[i : i + 512].astype(np.float32), wide)
            for query, e, near in zip(q["vec_id"].iloc[i : i + 512].tolist(), y[i : i + 512], ids):
                near = near[near >= 0]
                score = np.sqrt(((self.vectors[near] - e) ** 2).sum(1))
                best = sorted((s, v) for s, node in zip(score.tolist(), near.tolist()) for v in self.members[node][: k + 1] if v != query)[:k]
                out.extend((query, v, s) for s, v in best)
        return out


def _searched(parts: Iterator[pd.DataFrame], k: int, width: int) -> Iterator[pd.DataFrame]:
    """Answers from a stream of rows in order of shard, in each those of the index before those that ask: a shard is loaded once, and queries pass by in batches."""
    now, rows, loaded = None, [], None
    for part in parts:
        for (shard, asks), g in part.groupby(["shard", "asks"]):
            if shard != now:
                now, rows, loaded = shard, [], None
            if not asks:
                rows.append(g)
                continue
            if loaded is None:
                loaded = {d: Shard(own) for d, own in pd.concat(rows).groupby("d")} if rows else {}
                rows = []
            found = [x for d, own in g.groupby("d") if d in loaded for x in loaded[d].answers(own, k, width)]
            if found:
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, shard: int = 8192, degree: int = 32, build_width: int = 64, width: int = 128, relax: float = 1.2) -> DataFrame:
    """The k nearest found of each query: query_id, rank (from 1), vec_id, score.

    vectors and queries: vec_id, embedding. score is the Euclidean distance of the original vectors in
    double precision, ties go to the smaller vec_id; a row of the query's own vec_id is no candidate.
    All rows are indexed, in shards of about `shard`; degree, build_width, relax: edges a node keeps,
    the beam that proposes them, and how much nearer a kept edge must be to drop another; width: the
    beam of a query in each shard. The index is shuffled once, and each query once for each shard; a task holds one shard
    and a batch of queries.

    Vectors that are null, zero or hold null or non-finite components, and null ids, take no part;
    vectors of different lengths aren't compared. Equal vectors are one node, so any number of copies
    is found. A query gets all candidates if there are fewer than k. Repeated query rows are one
    query. Other columns don't matter; empty tables give no rows.
    """
    ids = lambda t: t.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(finite_vector("embedding") & F.col("vec_id").isNotNull())
    v, q = ids(vectors), ids(queries).dropDuplicates(["vec_id"])
    shards = max(1, -(-v.count() // shard))
    dealt = v.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int"))
    row = "shard int, d int, node int, vec_id long, embedding array<double>, edges array<int>, start boolean"
    graph = stored(dealt.groupBy("shard").applyInPandas(lambda p: _built(p, degree, build_width, relax), row), "graph").withColumn("asks", F.lit(False))
    asked = q.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.size("embedding").alias("d"), F.lit(0).alias("node"), "vec_id", "embedding",
        F.expr("cast(array() as array<int>)").alias("edges"), F.lit(False).alias("start"), F.lit(True).alias("asks"),
    )
    rows = graph.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "asks")
    found = rows.mapInPandas(lambda parts: _searched(parts, k, width), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
