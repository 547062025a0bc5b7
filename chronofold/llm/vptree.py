"""Nearest neighbours by cosine with one vantage-point tree per shard.

On vectors of length 1 the Euclidean distance orders like the cosine and obeys the triangle inequality. Vectors are
dealt into shards of about ``SHARD`` by a hash of their id; each shard's tree splits at the median distance from the
vantage point that spreads distances most, down to leaves of ``LEAF``; rows of like distance are split by number. Queries go through a tree in blocks of ``QUERIES``, each visiting the nearer
side first; the other side is left out for the queries whose best distance so far, times ``factor``, does not reach
the border. Factor 1 is exact, a smaller one leaves out more. Rounding may order vectors of like distance otherwise
than their scores do, so a shard's candidates are all vectors within the rounding of its k-th distance, however many
copies there are. Their scores are computed on the original vectors in double precision, the k best by score and then
by the smaller vec_id are a shard's, and the shards' best are merged.

Vectors that are null, empty, zero, or hold a null or a non-finite component take no part, neither as queries nor as
candidates; nor do vectors of another length than the query's. Rows that repeat a vec_id stand for themselves as candidates under their id, but never for a
query of the same id; a repeated query id is answered once, for its smallest vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.storage import saved

SHARD, LEAF, QUERIES, NEAREST, EVERY = 8192, 64, 4096, 5, 50
#: Vantage points that a node tries, and rows to which it measures them.
TRIED, SEEN = 8, 128
#: 1 is exact. The small tables search exactly; on them recall is 1.
FACTOR = 1.0


class VantagePointTree:
    """A tree over the rows of ``vectors``, which have length 1."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.vectors, self.ids, self.leaf = vectors, ids, leaf
        #: A cosine is off by (dimensions + 4) last bits at most; a distance by the root of twice that, and up to three of them meet.
        self.rounding = 5 * math.sqrt((vectors.shape[1] + 4) * np.finfo(np.float64).eps)
        self.nodes: list[tuple] = []
        self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray) -> None:
        """Nodes (point, border, number of the inner node, of the outer one) and leaves (rows,); the root is number 0.

        Rows that all lie at the border are split by their number: no more than half of a node's rows go to either side,
        so a tree over any vectors is log2(rows) deep. Inside lie distances up to the border, outside those from it on.
        """
        self.nodes.append((rows,))
        open_nodes = [0]
        while open_nodes:
            at = open_nodes.pop()
            rows = self.nodes[at][0]
            if len(rows) <= self.leaf:
                continue
            point = self._vantage_point(rows)
            away = _distance(self.vectors[rows] @ point)
            order, half = np.argsort(away, kind="stable"), len(rows) // 2
            inside, outside = len(self.nodes), len(self.nodes) + 1
            self.nodes[at] = (point, float(away[order[half]]), inside, outside)
            self.nodes += [(rows[np.sort(order[:half])],), (rows[np.sort(order[half:])],)]
            open_nodes += [inside, outside]

    def _vantage_point(self, rows: np.ndarray) -> np.ndarray:
        """Of a few rows the one whose distances to a few others spread most."""
        tried, seen = (self.vectors[rows[np.linspace(0, len(rows) - 1, min(n, len(rows))).astype(int)]] for n in (TRIED, SEEN))
        return tried[_distance(tried @ seen.T).std(axis=1).argmax()]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and distances of the k nearest of each query, without those of its own id; -1 where there are fewer."""
        return self._search(queries, own, k, factor)[:2]

    def candidates(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row), in the order of the queries, of all rows that may be among the k nearest, whatever rounding did to the distances."""
        _, away, near = self._search(queries, own, k, factor)
        at, rows, d = (np.concatenate(x) for x in zip(*near, strict=True)) if near else (np.zeros(0, dtype=np.int64),) * 3
        some = np.flatnonzero(d <= away[at, -1] + self.rounding)
        some = some[np.argsort(at[some], kind="stable")]
        return at[some], rows[some]

    def _search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
        found = np.full((len(queries), k), -1, dtype=np.int64)
        away = np.full((len(queries), k), np.inf)
        near: list[tuple] = []
        self._visit(0, np.arange(len(queries)), queries, own, found, away, near, factor)
        return found, away, near

    def _visit(self, node: int, active: np.ndarray, queries: np.ndarray, own: np.ndarray, found: np.ndarray, away: np.ndarray, near: list[tuple], factor: float) -> None:
        if not len(active):
            return
        if len(self.nodes[node]) == 1:
            rows = self.nodes[node][0]
            d = _distance(queries[active] @ self.vectors[rows].T)
            d[own[active][:, None] == self.ids[rows][None, :]] = np.inf
            everything = np.concatenate([away[active], d], axis=1)
            names = np.concatenate([found[active], np.broadcast_to(rows, d.shape)], axis=1)
            ids = np.where(names >= 0, self.ids[names], np.iinfo(np.int64).max)
            best = np.lexsort((ids, everything), axis=1)[:, : found.shape[1]]
            away[active] = np.take_along_axis(everything, best, axis=1)
            found[active] = np.where(np.isfinite(away[active]), np.take_along_axis(names, best, axis=1), -1)
            i, j = np.nonzero(np.isfinite(d) & (d <= away[active, -1:] + self.rounding))
            near.append((active[i], rows[j], d[i, j]))
            return
        point, border, inside, outside = self.nodes[node]
        d = _distance(queries[active] @ point)
        within = d < border
        self._visit(inside, active[within], queries, own, found, away, near, factor)
        self._visit(outside, active[~within], queries, own, found, away, near, factor)
        # ties on the border are visited
        reach = np.abs(d - border) <= away[active, -1] * factor + self.rounding
        self._visit(outside, active[within & reach], queries, own, found, away, near, factor)
        self._visit(inside, active[~within & reach], queries, own, found, away, near, factor)


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0.0))


def _usable(vectors: DataFrame) -> DataFrame:
    finite = "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    some = f"vec_id is not null and embedding is not null and size(embedding) > 0 and {finite} and exists(embedding, x -> x <> 0)"
    return vectors.where(F.expr(some)).select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(np.float64)


def _scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows times a power of two where their greatest component is far from 1."""
    exponent = np.frexp(np.abs(matrix).max(axis=1, keepdims=True))[1]
    return np.ldexp(matrix, np.where(np.abs(exponent) > 100, -exponent, 0))


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = _scaled(matrix)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _scores(queries: np.ndarray, vectors: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The cosine of each pair; a row's sum does not hang on its place, so equal vectors have equal scores.

    Vectors whose squares might overflow or vanish are scaled first, by a power of two, so that no cosine changes by it.
    """

    def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * b).sum(axis=1)

    out, some = np.empty(len(at)), max(1, (1 << 21) // vectors.shape[1])
    queries, vectors = _scaled(queries), _scaled(vectors)
    one, other = np.sqrt(dot(queries, queries)), np.sqrt(dot(vectors, vectors))
    for k in range(0, len(at), some):
        i, j = at[k : k + some], rows[k : k + some]
        out[k : k + some] = dot(queries[i], vectors[j]) / (one[i] * other[j])
    return out


def nearest(vectors: DataFrame, every: int = EVERY, k: int = NEAREST, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors of each vector whose id ``every`` divides.

    The tables of shards and of query blocks meet in a join on their numbers: a block is read by each shard's task of
    its own, so a task holds one shard and one block however many there are.
    """
    usable = saved(_usable(vectors).withColumn("dim", F.size("vector")))
    shards = max(1, math.ceil(usable.count() / SHARD))
    dealt = usable.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"))
    queries = usable.where(F.col("vec_id") % every == 0).groupBy("vec_id", "dim").agg(F.min("vector").alias("vector"))
    one = Window.partitionBy("vec_id").orderBy("vector")
    queries = saved(queries.withColumn("__n", F.row_number().over(one)).where("__n = 1").drop("__n"))
    blocks = max(1, math.ceil(queries.count() / QUERIES))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    to_all = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        asked, held = asked.sort_values("vec_id"), held.sort_values("vec_id")
        own, ids, theirs, originals = asked["vec_id"].to_numpy(), held["vec_id"].to_numpy(), _matrix(asked["vector"]), _matrix(held["vector"])
        at, rows = VantagePointTree(_unit(originals), ids).candidates(_unit(theirs), own, k, factor)
        score = _scores(theirs, originals, at, rows)
        order = np.lexsort((ids[rows], -score, at))
        best = order[np.arange(len(at)) - np.searchsorted(at, at) < k]  # ``at`` is in rising order, before and after
        return pd.DataFrame({"query_id": own[at[best]], "vec_id": ids[rows[best]], "score": score[best]})

    keys = ["shard", "block", "dim"]
    found = asked.groupBy(*keys).cogroup(to_all.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
