"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample; every vector goes to the posting list of its
nearest centroid and, near a boundary, to further lists whose centroid is at most
``replicate`` times as far. A query walks an in-memory graph over the centroids (each
linked to its nearest ones) and searches the lists whose centroid is within a ratio of
the nearest one's distance; the ratio is the smallest with which queries of the sample
find ``recall`` of their true neighbours. Lists are balanced: one of more than
``list_rows`` vectors is cut into chunks that are searched apart, so a vector that
fills a third of the table costs no single task more. Centroids (at most ``lists``,
checked) are what is broadcast; candidates are compared by exact cosines.

Cases: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components take no part, nor do null ids; rows that repeat a vec_id count once
(the first by value); fewer candidates than ``k`` give fewer rows; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from staylens.llm.common import stored

OUT_SCHEMA = "query_id long, vec_id long, score double"


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query, each computed by itself (equal rows, equal bits)."""
    return (vectors * query).sum(axis=1) / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


class Centroids:
    """Centroids with a graph of nearest ones."""

    def __init__(self, points: np.ndarray, degree: int = 16):
        self.points = points
        near = np.argsort(-(points @ points.T), axis=1, kind="stable")[:, :degree + 1]
        links = [set(row.tolist()) - {i} for i, row in enumerate(near)]
        for i, row in enumerate(near):
            for j in row.tolist():
                if j != i:
                    links[j].add(i)
        # a chain through all keeps the graph connected
        for i in range(len(points) - 1):
            links[i].add(i + 1)
            links[i + 1].add(i)
        self.links = [np.array(sorted(s), np.int64) for s in links]

    def nearest(self, q: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first walk: centroids found, nearest first, and their distances."""
        dist = lambda ids: 1.0 - self.points[ids] @ q
        starts = np.unique(np.linspace(0, len(self.points) - 1, min(8, len(self.points))).astype(np.int64))
        seen = set(starts.tolist())
        d = dist(starts)
        todo = list(zip(d.tolist(), starts.tolist()))
        heapq.heapify(todo)
        best = sorted((-x, i) for x, i in zip(d.tolist(), starts.tolist()))
        heapq.heapify(best)
        while todo:
            x, i = heapq.heappop(todo)
            if len(best) >= breadth and x > -best[0][0]:
                break
            new = [j for j in self.links[i].tolist() if j not in seen]
            if not new:
                continue
            seen.update(new)
            for y, j in zip(dist(np.array(new)).tolist(), new):
                if len(best) < breadth or y < -best[0][0]:
                    heapq.heappush(todo, (y, j))
                    heapq.heappush(best, (-y, j))
                    if len(best) > breadth:
                        heapq.heappop(best)
        got = sorted((-x, i) for x, i in best)
        return np.array([i for _, i in got]), np.array([x for x, _ in got])


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of unit vectors; an empty cluster takes a vector of the largest one."""
    rng = np.random.default_rng(7)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = np.concatenate([(x[i:i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(c))
        for j in np.flatnonzero(n == 0):
            sums[j] = x[rng.integers(len(x))]
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), c)
    return c


def _lists(x: np.ndarray, c: np.ndarray, replicate: float, copies: int):
    """Lists of each unit vector: (row, list) pairs."""
    d = 1.0 - x @ c.T
    m = min(copies, c.shape[0])
    near = np.argpartition(d, m - 1, axis=1)[:, :m]
    dn = np.take_along_axis(d, near, axis=1)
    keep = dn <= dn.min(axis=1, keepdims=True) * replicate + 1e-9
    row, col = np.nonzero(keep)
    return row, near[row, col]


def fit_ratio(x: np.ndarray, cents: Centroids, replicate: float, copies: int, k: int, recall: float, breadth: int) -> float:
    """Smallest ratio with which sample queries find ``recall`` of their true neighbours in the sample."""
    rows, lists = _lists(x, cents.points, replicate, copies)
    member = [set() for _ in cents.points]
    for r, j in zip(rows.tolist(), lists.tolist()):
        member[j].add(r)
    needed = []
    for q in range(0, len(x), max(1, len(x) // 200)):
        s = x @ x[q]
        s[q] = -2
        true = np.argsort(-s, kind="stable")[:k]
        found, dist = cents.nearest(x[q], breadth)
        for t in true.tolist():
            at = next((i for i, j in enumerate(found.tolist()) if t in member[j]), None)
            needed.append(np.inf if at is None else dist[at] / max(dist[0], 1e-9))
    needed = np.sort(needed)
    return float(min(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))], 1e9)) if len(needed) else 1e9


def valid(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v): rows that take part, one per id, all of the commonest length (a bounded count by length)."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")) \
        .where(F.col("vec_id").isNotNull() & v.isNotNull()).where(~bad & F.exists(v, lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).first()
    rows = rows.where(F.size("v") == (size.n if size else 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def search(table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", query_mod: int = 50, k: int = 5,
           sample_rows: int = 20_000, lists: int = 4096, mean_list: int = 512, list_rows: int = 4000, replicate: float = 1.3,
           copies: int = 8, recall: float = 0.95, breadth: int = 256) -> DataFrame:
    """The ``k`` nearest of each row whose id is divisible by ``query_mod``: query_id, rank, vec_id, score."""
    rows = stored(valid(table, vec_id, vector), "ann-vectors")
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toPandas()
    if not len(sample):
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    x = unit(np.stack(sample["v"].to_numpy()).astype(np.float64))
    want = int(max(1, min(lists, len(x) // 64 + 1, n // mean_list + 1)))
    cents = Centroids(kmeans(np.unique(x, axis=0), want))
    ratio = fit_ratio(x, cents, replicate, copies, k, recall, min(breadth, want))

    def post(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                r, lst = _lists(unit(np.stack(frame["v"].to_numpy())), cents.points, replicate, copies)
                yield pd.DataFrame({"list": lst, "vec_id": frame["vec_id"].to_numpy()[r], "v": frame["v"].to_numpy()[r]})

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for q, v in zip(frame["vec_id"], frame["v"]):
                found, dist = cents.nearest(unit(v[None, :])[0], min(breadth, want))
                # lists beyond the ratio are pruned, but never the two nearest
                use = found[(dist <= max(dist[0], 1e-9) * ratio + 1e-9) | (np.arange(len(dist)) < 2)]
                yield pd.DataFrame({"list": use, "query_id": q, "q": [v] * len(use)})

    posted = rows.mapInPandas(post, "list long, vec_id long, v array<double>")
    probes = rows.where(F.col("vec_id") % query_mod == 0).mapInPandas(probe, "list long, query_id long, q array<double>")
    sizes = stored(posted.groupBy("list").agg(F.ceil(F.count("*") / list_rows).cast("int").alias("chunks")), "ann-lists")
    chunked = posted.join(F.broadcast(sizes), "list").withColumn(  # at most ``lists`` rows
        "chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")).drop("chunks")
    asked = probes.join(F.broadcast(sizes), "list").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")

    def compare(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, v = left["vec_id"].to_numpy(), np.stack(left["v"].to_numpy())
        rough = unit(v) @ unit(np.stack(right["q"].to_numpy())).T
        out = []
        for j, (q, qv) in enumerate(zip(right["query_id"], right["q"])):
            s = rough[:, j].copy()
            s[ids == q] = -np.inf
            m = min(k, len(s))
            near = np.flatnonzero((s >= np.partition(s, len(s) - m)[len(s) - m] - 1e-9) & np.isfinite(s))
            exact = cosines(v[near], qv)
            order = np.lexsort((ids[near], -exact))[:k]
            out.append(pd.DataFrame({"query_id": q, "vec_id": ids[near][order], "score": exact[order]}))
        return pd.concat(out)

    near = chunked.groupBy("list", "chunk").cogroup(asked.groupBy("list", "chunk")).applyInPandas(compare, OUT_SCHEMA)
    once = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
