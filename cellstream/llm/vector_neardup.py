"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors whose cosine is at least t are at a squared distance of 2 - 2t at most. A rotation
spreads a vector's length over all coordinates, which are split into blocks; of that squared
distance each block gets the share of its dimensions, and a pair within the whole budget is within
the budget of one block at least. So each block is range-joined by itself: vectors lie in the cell
of the block's first coordinate and look into the cells that its budget can reach. The union of
what the blocks find holds every pair; a pair counts in the first block that finds it, once its
cosine is confirmed in double precision.

Cells are cut into tiles of bounded size, so a label or a crowd of near copies of any size is
spread over tasks; a tile returns link counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import finite_vector, stored
from .components import components

_rotations: dict[int, np.ndarray] = {}
#: For rounding; it only lets more candidates through.
SLACK = 1e-6


def rotation(d: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    if d not in _rotations:
        q, r = np.linalg.qr(np.random.RandomState(7_919).standard_normal((d, d)))
        _rotations[d] = q * np.sign(np.diag(r))
    return _rotations[d]


def rotated(x: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows of x, rotated. One column after another: a row's result doesn't depend on the other rows."""
    length = np.zeros(len(x))
    for k in range(x.shape[1]):
        length += x[:, k] ** 2
    unit, r = x / np.sqrt(length)[:, None], rotation(x.shape[1])
    out = np.zeros_like(unit)
    for k in range(x.shape[1]):
        out += unit[:, k : k + 1] * r[k]
    return out


def blocks(d: int, size: int, threshold: float) -> list[tuple[int, int, float]]:
    """(first dimension, end, squared-distance budget) of each block."""
    n = max(1, round(d / size))
    ends = [d * i // n for i in range(n + 1)]
    return [(a, b, (2 - 2 * threshold) * (b - a) / d + SLACK) for a, b in zip(ends, ends[1:])]


def _cells(classes: DataFrame, size: int, threshold: float, kind: str) -> DataFrame:
    """A row for each vector and block in its own cell (home), and in each cell it looks into."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for d, p in part.groupby(part["embedding"].str.len()):
                x = rotated(np.stack(p["embedding"].to_numpy()).astype(np.float64))
                for b, (first, _, budget) in enumerate(blocks(int(d), size, threshold)):
                    reach = np.sqrt(budget)
                    width = 2 * reach
                    low, high = (np.floor((x[:, first] + s * reach) / width).astype(int) for s in (-1, 1))
                    home = np.floor(x[:, first] / width).astype(int)
                    for cell, looks, at in ((home, False, slice(None)), (low, True, slice(None)), (high, True, high > low)):
                        yield pd.DataFrame({"label": p["label"][at], "d": d, "block": b, "cell": cell[at], "looks": looks, "cid": p["cid"][at], "copies": p["copies"][at], "embedding": p["embedding"][at]})

    return classes.mapInPandas(run, f"label string, d int, block int, cell int, looks boolean, cid long, copies long, embedding {kind}")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and edges a-b: the smallest node of each node's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _tile_links(p: pd.DataFrame, size: int, threshold: float) -> pd.DataFrame:
    none = pd.DataFrame({"cid": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
    home, look = p[~p["looks"]], p[p["looks"]]
    if not len(home) or not len(look):
        return none
    bounds = blocks(int(p["d"].iloc[0]), size, threshold)
    at = int(p["block"].iloc[0])
    first, end, budget = bounds[at]
    x, y = (np.stack(q["embedding"].to_numpy()).astype(np.float64) for q in (look, home))
    rx, ry = rotated(x), rotated(y)
    cx, cy = look["cid"].to_numpy(np.int64), home["cid"].to_numpy(np.int64)
    lx, ly = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    sq = lambda z: (z * z).sum(1)
    found = []
    for i in range(0, len(x), 512):
        part = rx[i : i + 512, first:end]
        near = sq(part)[:, None] + sq(ry[:, first:end]) - 2 * part @ ry[:, first:end].T <= budget + SLACK
        near &= cx[i : i + 512, None] > cy  # each pair from one side
        u, v = np.nonzero(near)
        u += i
        for j in range(0, len(u), 65_536):
            a, b = u[j : j + 65_536], v[j : j + 65_536]
            linked = (x[a] * y[b]).sum(1) / (lx[a] * ly[b]) >= threshold
            a, b = a[linked], b[linked]
            own = np.full(len(a), -1)
            for k, (s, e, most) in enumerate(bounds[: at + 1]):
                far = np.zeros(len(a))
                for c in range(s, e):  # in this order in every tile: all blocks agree on the first
                    far += (rx[a, c] - ry[b, c]) ** 2
                own = np.where((own < 0) & (far <= most), k, own)
            found.append((a[own == at], b[own == at]))
    if not (found and sum(len(a) for a, _ in found)):
        return none
    a, b = (np.concatenate(z) for z in zip(*found))
    ids, inverse = np.unique(np.concatenate((cx[a], cy[b])), return_inverse=True)
    ia, ib = inverse[: len(a)], inverse[len(a) :]
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, ia, home["copies"].to_numpy(np.int64)[b])
    np.add.at(links, ib, look["copies"].to_numpy(np.int64)[a])
    return pd.DataFrame({"cid": ids, "links": links, "root": ids[_forest(ia, ib, len(ids))]})


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.93, block: int = 16, tile: int = 2048) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    vectors: vec_id, embedding, label. Rows of equal label (not null) are linked if their cosine in
    double precision is at least the threshold; n_links counts the rows linked directly,
    component_id is the smallest vec_id reachable. block: dimensions of a block, about; tile: rows
    of a side of a tile, about.

    Vectors that are null, zero or hold null or non-finite components, and rows with a null label or
    vec_id, link with nothing. Vectors of different lengths don't link. Exact copies under one label
    are one vector with a count from the start. Repeated rows get a row each and count as links of each
    other. Other columns don't matter; an empty table gives no rows.
    """
    given = vectors.schema["embedding"].dataType.simpleString()
    kind = "array<float>" if given == "array<float>" else "array<double>"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast(kind).alias("embedding"))
    v = v.withColumn("ok", finite_vector("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    hashed = v.withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.lit(1), F.reverse("embedding")))
    good = hashed.where("ok")
    key = ["label", "h1", "h2"]
    classes = stored(good.groupBy(*key).agg(F.min("vec_id").alias("cid"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")), "vectors")
    cells = stored(_cells(classes.select("cid", "label", "copies", "embedding"), block, threshold, kind), "cells")
    at = ["label", "d", "block", "cell"]
    sides = cells.groupBy(*at).agg(*[F.ceil(F.count_if(F.col("looks") == x) / tile).cast("int").alias(n) for x, n in ((False, "homes"), (True, "looks_n"))]).where("homes > 0 and looks_n > 0")
    dealt = cells.join(sides, at)
    own = lambda n: F.pmod(F.xxhash64("cid"), F.greatest(F.col(n), F.lit(1))).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    tiled = dealt.withColumn("i", F.explode(F.when(F.col("looks"), every("homes")).otherwise(F.array(own("homes"))))).withColumn("j", F.explode(F.when(F.col("looks"), F.array(own("looks_n"))).otherwise(every("looks_n"))))
    found = tiled.groupBy(*at, "i", "j").applyInPandas(lambda p: _tile_links(p, block, threshold), "cid long, links long, root long")
    found = stored(found, "tiles")
    parts = components(found.where("cid <> root").select(F.col("cid").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    of_class = classes.drop("embedding").join(links, "cid", "left").join(parts.withColumnRenamed("node", "cid"), "cid", "left")
    of_class = of_class.select(*key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component_id"))
    linked = good.select("vec_id", *key).join(of_class, key).select("vec_id", "n_links", "component_id")
    alone = v.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
