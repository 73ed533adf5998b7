"""Approximate nearest neighbours by stable projections and a chi-square test.

Vectors are projected to a few dimensions by normal random numbers: the squared projected distance over the squared true
distance then follows a chi-square law. Each block of vectors is indexed by a kd-tree over the projections. A query takes
leaves in the order of their projected distance and verifies what they hold, until whatever lies beyond the next leaf
would be closer than the k-th neighbour found, by more than the approximation ratio, with a probability below
1 - CONFIDENCE. The queries of a block take their leaves in rounds, and a leaf's vectors meet all queries of a round that
take it in one matrix product.

Largest inner product becomes smallest distance by one more coordinate, root(M^2 - |x|^2), with M the block's largest
norm, and 0 for a query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm.common import cut

PROJECTED = 8
CONFIDENCE = 0.97
#: A neighbour counts as found if one no more than so many times as far is. README has the recall measured with it.
RATIO = 1.9
LEAF = 32
#: Different vectors in a block at most, and in one that is made only to use another core; queries that meet a block in one task.
BLOCK_VECTORS = 16_384
LEAST_VECTORS = 2_048
CHUNK_QUERIES = 4_096
#: Queries of a task that take their leaves together.
ROUND_QUERIES = 512
#: Stands for no neighbour yet.
NOBODY = np.iinfo(np.int64).max
SEED = 20_240_131


def chi_square_bound(dimensions: int, confidence: float) -> float:
    """Where the chi-square law of an even number of dimensions reaches a probability."""

    def reached(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, dimensions // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if reached(middle) < confidence else (low, middle)
    return high


@dataclass
class ProjectedTree:
    """A kd-tree over projected vectors, as boxes of its leaves."""

    vectors: np.ndarray
    order: np.ndarray  # rows leaf by leaf
    begin: np.ndarray  # of each leaf in order, one more at the end
    low: np.ndarray
    high: np.ndarray
    normals: np.ndarray
    reach: float  # the largest norm

    @staticmethod
    def build(vectors: np.ndarray) -> "ProjectedTree":
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        reach = float(norms.max())
        normals = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, PROJECTED))
        last = np.sqrt(np.maximum(reach * reach - norms * norms, 0))
        points = vectors @ normals[:-1] + last[:, None] * normals[-1]
        leaves, todo = [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            axis = int(np.ptp(points[rows], axis=0).argmax())
            half = np.argpartition(points[rows, axis], len(rows) // 2)
            todo += [rows[half[: len(rows) // 2]], rows[half[len(rows) // 2 :]]]
        begin = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
        low, high = (np.array([f(points[x], axis=0) for x in leaves]) for f in (np.min, np.max))
        return ProjectedTree(vectors, np.concatenate(leaves), begin, low, high, normals, reach)

    def away(self, points: np.ndarray) -> np.ndarray:
        """Squared projected distance of each point to each leaf's box."""
        total = np.zeros((len(points), len(self.low)))
        for low, high, own in zip(self.low.T, self.high.T, points.T[:, :, None]):
            gap = np.maximum(np.maximum(low - own, own - high), 0)
            total += gap * gap
        return total

    def search(self, queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int, bound: float) -> "Found":
        """The k best different ids for each query, its own not among them; row i has the ids[at[i]:at[i + 1]]."""
        away = self.away(queries @ self.normals[:-1])
        order = np.argsort(away, axis=1, kind="stable")
        most = (queries * queries).sum(axis=1) + self.reach * self.reach
        found = Found.nothing(len(queries), k)
        active, taken, step = np.arange(len(queries)), 0, max(1, 2 * k // LEAF)
        while len(active) and taken < order.shape[1]:
            leaves = order[active, taken : taken + step]
            taken += leaves.shape[1]
            flat, who = leaves.ravel(), np.repeat(active, leaves.shape[1])
            by_leaf = np.argsort(flat, kind="stable")
            flat, who = flat[by_leaf], who[by_leaf]
            first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
            good: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in zip(first, np.append(first[1:], len(flat))):
                own = self.order[self.begin[flat[a]] : self.begin[flat[a] + 1]]
                asking = who[a:b]
                found.verified[asking] += len(own)
                products = queries[asking] @ self.vectors[own].T
                query, row = np.nonzero(products >= found.scores[asking, -1:])
                good.append((asking[query], own[row], products[query, row]))
            found.take(*map(np.concatenate, zip(*good)), query_ids, ids, at)
            if taken < order.shape[1]:
                worst = found.scores[active, -1]
                ahead = away[active, order[active, taken]]
                active = active[(worst == -np.inf) | (ahead < bound * np.maximum(most[active] - 2 * worst, 0))]
            step *= 2
        return found


@dataclass
class Found:
    """The best so far of each query, best first: ids, the rows that have them, and scores; rows verified."""

    ids: np.ndarray
    rows: np.ndarray
    scores: np.ndarray
    verified: np.ndarray

    @staticmethod
    def nothing(n: int, k: int) -> "Found":
        return Found(np.full((n, k), NOBODY), np.zeros((n, k), np.int64), np.full((n, k), -np.inf), np.zeros(n, np.int64))

    def take(self, who: np.ndarray, rows: np.ndarray, scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        """Take what a round has found for its queries; an id counts once, with its best row, and ties go to the smaller id."""
        sizes = at[rows + 1] - at[rows]
        new = np.repeat(at[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        own_ids, who, rows, scores = ids[new], np.repeat(who, sizes), np.repeat(rows, sizes), np.repeat(scores, sizes)
        touched = np.unique(who)
        k = self.ids.shape[1]
        held = np.repeat(touched, k)
        who = np.concatenate([held, who])
        own_ids = np.concatenate([self.ids[touched].ravel(), own_ids])
        rows = np.concatenate([self.rows[touched].ravel(), rows])
        scores = np.concatenate([self.scores[touched].ravel(), scores])
        use = (scores > -np.inf) & (own_ids != query_ids[who])
        who, own_ids, rows, scores = who[use], own_ids[use], rows[use], scores[use]
        # The best of an id first, then one of each id by score.
        order = np.lexsort((-scores, own_ids, who))
        who, own_ids, rows, scores = who[order], own_ids[order], rows[order], scores[order]
        once = np.append(True, (who[1:] != who[:-1]) | (own_ids[1:] != own_ids[:-1]))[: len(who)]
        who, own_ids, rows, scores = who[once], own_ids[once], rows[once], scores[once]
        order = np.lexsort((own_ids, -scores, who))
        who, own_ids, rows, scores = who[order], own_ids[order], rows[order], scores[order]
        begin = np.searchsorted(who, who)
        place = np.arange(len(who)) - begin
        best = place < k
        self.ids[touched], self.scores[touched] = NOBODY, -np.inf
        self.ids[who[best], place[best]] = own_ids[best]
        self.rows[who[best], place[best]] = rows[best]
        self.scores[who[best], place[best]] = scores[best]


def usable(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, vector as doubles) of rows with an id and a finite vector other than zero."""
    rows = df.select(df[f"`{id}`"].cast("long").alias("vec_id"), df[f"`{vector}`"].cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0))


def nearest(df: DataFrame, is_query, k: int = 20, id: str = "vec_id", vector: str = "embedding", ratio: float = RATIO) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query(id column) holds for, its k nearest other rows.

    Nearness is the largest inner product; ties go to the smaller id. Rows without id, and vectors that are null, empty,
    zero or not finite, take no part; a query meets only vectors of its own length; rows that share a query's id count as
    the query itself, and each of its vectors asks. An id with several vectors counts once, with the best. Equal vectors are
    searched once and then stand for all their ids, of which no more than the k + 1 smallest can be among the nearest.
    Every query meets every block of vectors: rows of a query set against all rows.
    """
    rows = cut(usable(df, id, vector).distinct().withColumn("block_hash", F.xxhash64("vector")))
    place = F.row_number().over(Window.partitionBy("block_hash", "vector").orderBy("vec_id"))
    first = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    different = cut(first.groupBy("block_hash", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    n_different, n_queries = different.count(), rows.filter(is_query(F.col("vec_id"))).count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(1, -(-n_different // BLOCK_VECTORS), min(cores, n_different // LEAST_VECTORS))
    n_chunks = max(1, -(-n_queries // CHUNK_QUERIES))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = F.pmod("block_hash", F.lit(n_blocks)).cast("int")
    chunk = F.pmod(F.xxhash64("vec_id"), F.lit(n_chunks)).cast("int")
    length = F.size("vector").alias("length")
    indexed = different.select(block.alias("block"), each(n_chunks).alias("chunk"), length, "ids", "vector")
    asked = rows.filter(is_query(F.col("vec_id"))).select(each(n_blocks).alias("block"), chunk.alias("chunk"), length, "vec_id", "vector")
    bound = chi_square_bound(PROJECTED, CONFIDENCE) / ratio**2

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        lists = column.combine_chunks()
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if vectors.num_rows and queries.num_rows:
            tree, lists = ProjectedTree.build(matrix(vectors["vector"])), vectors["ids"].combine_chunks()
            ids, at = lists.flatten().to_numpy(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
            asking, query_ids = matrix(queries["vector"]), queries["vec_id"].to_numpy()
            for a in range(0, len(asking), ROUND_QUERIES):
                some, own = asking[a : a + ROUND_QUERIES], query_ids[a : a + ROUND_QUERIES]
                found = tree.search(some, own, ids, at, k, bound)
                who, place = np.nonzero(found.scores > -np.inf)
                # Summed in one order, whatever products a leaf was part of.
                exact = (tree.vectors[found.rows[who, place]] * some[who]).sum(axis=1)
                for column, part in zip(out, (own[who], found.ids[who, place], exact)):
                    column.append(part)
        columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
        kinds = (np.int64, np.int64, np.float64)
        return pa.table({n: c.astype(t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, kinds)})

    keys = ["block", "chunk", "length"]
    found = indexed.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
