"""Exact top-k by integer inner product with the threshold algorithm over sorted per-dimension lists.

A component x counts as floor(256 * x). Vectors are dealt into shards of about ``SHARD`` by a hash. A shard keeps, for
each dimension, its rows in falling and in rising order of that component (ties by vec_id). A query reads the lists of
its non-zero dimensions in step, from the top where its own component is positive and from the bottom where it is
negative; each row met is scored whole by direct access. No row still unmet can score more than the sum, over the
lists, of the query's component times the last component read. The query stops as soon as that bound is strictly
below its k-th score (at equal scores a smaller vec_id could still come). Steps start at ``STEP`` positions and double.

A query first searches the shard of its own row. The k-th score found there is a floor for all other shards: where
their bound falls below it, they stop too, often before the first row.

Null vectors and those that hold a null or a component x for which 256 * x is not finite take no part, nor do rows of
null vec_id, nor vectors of another length than the query's (the empty vector meets empty ones, with score 0). Rows
that repeat a vec_id are candidates each, but never for a query of that id; a repeated query id is asked once, with
its smallest vector. Scores beyond 64 bits count as the largest or smallest long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.storage import saved
from chronofold.llm.streams import ASKED, HELD, answered

SHARD, STEP, NEAREST, EVERY = 8192, 32, 5, 50
_EXACT, _LONG = 2**53, 2**63


class SortedLists:
    """One shard: whole-number vectors (as doubles) with their ids, and every dimension's two orders."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        if not self.vectors.shape[1]:
            self.vectors = np.zeros((len(ids), 1))  # one list that names all rows
        falling, rising = (np.argsort(sign * self.vectors, axis=0, kind="stable").T for sign in (-1, 1))
        self.orders = np.stack([falling, rising]).astype(np.int32)
        self.largest = np.abs(self.vectors).max(initial=0.0)
        #: Rows scored so far, for measuring how much the bound saves.
        self.accesses = 0

    def top(self, query: np.ndarray, own: int, k: int, floor: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, vec_id), best first. With a floor, rows that score less may be left out."""
        query = query if len(query) else np.zeros(1)
        dims = np.flatnonzero(query)
        dims = dims if len(dims) else np.zeros(1, dtype=np.int64)
        weights, ways = query[dims], (query[dims] < 0).astype(np.int64)
        narrow = self.largest * np.abs(query).sum() < _EXACT
        best, met, depth, step = [], self.ids == own, 0, STEP
        if floor is not None and self._bound(dims, weights, ways, 0, narrow) < floor:
            return best
        while depth < len(self.ids):
            upto = min(len(self.ids), depth + step)
            fresh = np.zeros(len(self.ids), dtype=bool)
            fresh[self.orders[ways, dims, depth:upto].ravel()] = True
            rows = np.flatnonzero(fresh & ~met)
            met[rows] = True
            self.accesses += len(rows)
            best = self._merged(best, rows, self._scores(rows, query, narrow), k, narrow)
            bound = self._bound(dims, weights, ways, upto - 1, narrow)
            if (len(best) >= k and bound < best[-1][0]) or (floor is not None and bound < floor):
                break
            depth, step = upto, 2 * step
        return best

    def _bound(self, dims: np.ndarray, weights: np.ndarray, ways: np.ndarray, depth: int, narrow: bool) -> int:
        last = self.vectors[self.orders[ways, dims, depth], dims]
        return int(last @ weights) if narrow else _product(last, weights)

    def _scores(self, rows: np.ndarray, query: np.ndarray, narrow: bool) -> np.ndarray | list[int]:
        """Sums of whole numbers below 2^53 are exact in doubles; larger ones are summed as Python's integers."""
        if narrow:
            return (self.vectors[rows] @ query).astype(np.int64)
        return [_product(self.vectors[r], query) for r in rows]

    def _merged(self, best: list, rows: np.ndarray, scores, k: int, narrow: bool) -> list[tuple[int, int]]:
        if narrow and len(rows) > k:
            first = np.lexsort((self.ids[rows], -scores))[:k]
            rows, scores = rows[first], scores[first]
        found = best + [(int(s), int(self.ids[r])) for s, r in zip(scores, rows, strict=True)]
        return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def _product(a: np.ndarray, b: np.ndarray) -> int:
    return min(max(sum(int(x) * int(y) for x, y in zip(a, b, strict=True)), -_LONG), _LONG - 1)


def _whole_numbers(vectors: pa.ChunkedArray) -> np.ndarray:
    some = vectors.combine_chunks()
    flat = some.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(256.0 * flat.reshape(len(some), -1 if len(flat) else 0))


def _usable(vectors: DataFrame) -> DataFrame:
    finite = "forall(embedding, x -> x is not null and not isnan(x) and abs(256 * double(x)) < double('Infinity'))"
    return vectors.where(F.expr(f"vec_id is not null and embedding is not null and {finite}")).select("vec_id", "embedding")


def _search(asked: DataFrame, held: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the best of each shard for the queries sent to it."""

    def build(rows: pa.Table) -> SortedLists:
        return SortedLists(_whole_numbers(rows["embedding"]), rows["vec_id"].to_numpy())

    def answer(lists: SortedLists, rows: pa.Table) -> dict:
        found = []
        for query, own, floor in zip(_whole_numbers(rows["embedding"]), rows["vec_id"].to_pylist(), rows["floor"].to_pylist(), strict=True):
            found += [(own, vec_id, score) for score, vec_id in lists.top(query, own, k, floor)]
        return {name: pa.array([f[i] for f in found], pa.int64()) for i, name in enumerate(("query_id", "vec_id", "score"))}

    columns = ["shard", "dim", "vec_id", "embedding"]
    rows = held.select(*columns, F.lit(None).cast("long").alias("floor"), F.lit(HELD).alias("kind"))
    rows = rows.unionByName(asked.select(*columns, "floor", F.lit(ASKED).alias("kind")))
    return answered(rows, ["shard", "dim"], build, answer, "query_id long, vec_id long, score long")


def _own_shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int")


def top_products(vectors: DataFrame, every: int = EVERY, k: int = NEAREST, shard_rows: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each vector whose id ``every`` divides."""
    shards = max(1, math.ceil(vectors.count() / shard_rows))
    # more than k equal rows of one id never matter
    copies = _usable(vectors).groupBy("vec_id", "embedding").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies"))
    held = copies.select("vec_id", "embedding", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    held = saved(held.select("vec_id", "embedding", F.size("embedding").alias("dim"), _own_shard(shards).alias("shard")))
    asked = held.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = asked.select("vec_id", "embedding", F.size("embedding").alias("dim"), _own_shard(shards).alias("home"))

    at_home = saved(_search(asked.select("*", F.col("home").alias("shard"), F.lit(None).cast("long").alias("floor")), held, k))
    floors = at_home.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("found")).where(F.col("found") >= k)
    away = asked.join(floors.select(F.col("query_id").alias("vec_id"), "floor"), "vec_id", "left")
    away = away.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    found = at_home.unionByName(_search(away, held, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
