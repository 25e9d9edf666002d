"""Approximate nearest neighbours from low-dimensional stable projections.

Inner-product search becomes Euclidean by one more coordinate: x gets sqrt(L - |x|^2), L the
largest squared length, and a query gets 0; then the nearest is the one of largest inner product.
Gaussian (2-stable) projections to ``DIMS`` dimensions keep distances in this sense: the squared
projected distance over the squared true one follows a chi-square law of ``DIMS``
degrees.  A kd-tree over the projections deals the vectors to cells, and each cell
has a kd-tree of its own; a query takes projected neighbours box by box, nearest box
first, verifies them by the exact inner product, and stops when the chi-square
test holds: a vector as near as the current ``k``-th would have shown up by now with
probability ``SURE``.

Work is dealt by (cell, part of the cell, block of queries): a query first visits its own
cell, and then the other cells that its test doesn't exclude.  A cell with very many
vectors is split in parts by id.  Of equal vectors only the k + 1 of smallest id are
indexed, which is exact, as no other can be among k neighbours.

The upper kd-tree is fitted on at most ``FIT_ROWS`` vectors, those of the smallest id
hashes; all vectors are indexed.

Nulls and ties: vectors that are null, empty, zero, hold null or non-finite components, or
have another length than most, and null ids, take no part.  Equal scores go to the smaller id.
Repeated rows with the same id and vector count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetscope.llm.common import materialize

DIMS = 12            # projected dimensions (even)
SURE = 0.98          # probability of the stopping test
FIT_ROWS = 8192      # vectors that the upper tree is fitted on
CELL_ROWS = 4096     # vectors of a cell, on average
MOST_CELLS = 1024    # cells: bounds the boxes that a task receives
PART_ROWS = 8192     # vectors of a part of a cell, on average
QUERY_ROWS = 2048    # queries of a block, on average
LEAF = 128           # vectors of a leaf of a cell's tree


def chi2_cdf(x: float, m: int) -> float:
    """Chi-square distribution function for even m."""
    term, total = 1.0, 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi2_quantile(p: float, m: int) -> float:
    lo, hi = 0.0, 10.0 * m + 100
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, m) < p else (lo, mid)
    return hi


def kd_split(points: np.ndarray, leaves: int) -> list[tuple[np.ndarray, list[tuple[int, float, bool]]]]:
    """Halve by the median of the widest dimension; each leaf's rows and its cuts (dim, value, above)."""
    todo, done = [(np.arange(len(points)), [], leaves)], []
    while todo:
        rows, cuts, n = todo.pop()
        if n <= 1 or len(rows) < 2:
            done.append((rows, cuts))
            continue
        sub = points[rows]
        dim = int(np.argmax(sub.max(0) - sub.min(0)))
        value = float(np.median(sub[:, dim]))
        above = sub[:, dim] > value
        if above.all() or not above.any():
            done.append((rows, cuts))
            continue
        todo.append((rows[above], [*cuts, (dim, value, True)], n // 2))
        todo.append((rows[~above], [*cuts, (dim, value, False)], n - n // 2))
    return done


class Cells:
    """The upper tree's cells as boxes of projected space."""

    def __init__(self, sample: np.ndarray, cells: int, dims: int = DIMS):
        leaves = kd_split(sample, cells) if len(sample) else [(None, [])]
        self.lo, self.hi = np.full((len(leaves), dims), -np.inf), np.full((len(leaves), dims), np.inf)
        for i, (_, cuts) in enumerate(leaves):
            for dim, value, above in cuts:
                if above:
                    self.lo[i, dim] = max(self.lo[i, dim], value)
                else:
                    self.hi[i, dim] = min(self.hi[i, dim], value)

    def of(self, p: np.ndarray) -> np.ndarray:
        """The cell of each point: lower side open, upper side closed."""
        out = np.zeros(len(p), np.int64)
        for i in range(len(self.lo)):
            out[((p > self.lo[i]) & (p <= self.hi[i])).all(1)] = i
        return out


def box_distance(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distances (points x boxes)."""
    out = np.zeros((len(p), len(lo)))
    for d in range(p.shape[1]):
        gap = np.maximum(np.maximum(lo[None, :, d] - p[:, d, None], p[:, d, None] - hi[None, :, d]), 0.0)
        out += gap * gap
    return out


class Projection:
    """Maps vectors of ``width`` components, and a norm bound, to ``DIMS`` dimensions."""

    def __init__(self, width: int, norm2: float, dims: int = DIMS, seed: int = 11):
        self.norm2, self.matrix = norm2, np.random.default_rng(seed).standard_normal((width + 1, dims))

    def rows(self, x: np.ndarray) -> np.ndarray:
        last = np.sqrt(np.maximum(self.norm2 - (x * x).sum(1), 0.0))
        return x @ self.matrix[:-1] + last[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.matrix[:-1]


def search(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, floor: np.ndarray,
           proj: Projection, k: int, sure: float = SURE) -> tuple[np.ndarray, np.ndarray]:
    """k best (ids, scores) of x for each query; -1 and -inf fill up.

    floor: a score that k vectors elsewhere are known to reach (-inf: none).
    """
    limit = chi2_quantile(sure, proj.matrix.shape[1])
    px, pq = proj.rows(x), proj.queries(q)
    leaves = [rows for rows, _ in kd_split(px, max(1, len(x) // LEAF))]
    lo = np.array([px[r].min(0) for r in leaves])
    hi = np.array([px[r].max(0) for r in leaves])
    near = box_distance(pq, lo, hi)
    turn = np.argsort(near, axis=1, kind="stable")
    near = np.take_along_axis(near, turn, 1)
    q2 = (q * q).sum(1)
    best = np.full((len(q), k), -np.inf)
    best_id = np.full((len(q), k), -1, np.int64)
    on = np.arange(len(q))
    for r in range(len(leaves)):
        kth = np.maximum(best[on, -1], floor[on])
        reach = limit * np.maximum(q2[on] + proj.norm2 - 2 * kth, 0.0)  # inf while fewer than k are known
        on, reach = on[near[on, r] <= reach], reach[near[on, r] <= reach]
        if not len(on):
            break
        here = turn[on, r]
        for leaf in np.unique(here):
            mine = here == leaf
            who, rows = on[mine], leaves[leaf]
            score = q[who] @ x[rows].T
            away = ((pq[who] ** 2).sum(1)[:, None] + (px[rows] ** 2).sum(1)[None] - 2 * pq[who] @ px[rows].T) > reach[mine][:, None] + 1e-9
            score[away | (ids[rows][None] == own[who][:, None])] = -np.inf
            all_s = np.concatenate((best[who], score), 1)
            all_i = np.concatenate((best_id[who], np.broadcast_to(ids[rows], score.shape)), 1)
            order = np.lexsort((all_i, -all_s), axis=1)[:, :k]
            best[who] = np.take_along_axis(all_s, order, 1)
            best_id[who] = np.where(np.isneginf(best[who]), -1, np.take_along_axis(all_i, order, 1))
    return best_id, best


def _matrix(col) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in col]) if len(col) else np.zeros((0, 1))


def _visit(proj: Projection, k: int, sure: float):
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, scores = search(_matrix(left["v"]), left["vec_id"].to_numpy(), _matrix(right["v"]),
                             right["query_id"].to_numpy(), right["floor"].to_numpy(float), proj, k, sure)
        q = np.repeat(right["query_id"].to_numpy(), k)
        ok = ids.ravel() >= 0
        ok |= ~np.isneginf(scores.ravel())
        return pd.DataFrame({"query_id": q[ok], "vec_id": ids.ravel()[ok], "score": scores.ravel()[ok]})
    return run


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, all of one length."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v")).where(
        "vec_id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND abs(x) < double('inf')) AND exists(v, x -> x != 0)")
    width = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").select("n").first()
    return v.where(F.size("v") == (width["n"] if width else 0)).distinct()


def _top(rows: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row (vec_id, embedding).

    A query's own id is no candidate.
    """
    spark = vectors.sparkSession
    out = "query_id long, vec_id long, score double"
    x = materialize(valid(vectors), "ann-vectors")
    fit = x.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("v").collect()
    if not fit:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    n, norm2 = x.agg(F.count("*"), F.max(norm)).first()
    proj = Projection(len(fit[0]["v"]), float(norm2))
    cells = Cells(proj.rows(_matrix([r["v"] for r in fit])), min(MOST_CELLS, max(1, n // CELL_ROWS)))

    same = W.partitionBy(F.xxhash64("v"), F.xxhash64(F.lit(1), F.col("v"))).orderBy("vec_id")
    index = x.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1).drop("r")

    def in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = cells.of(proj.rows(_matrix(b.column(1).to_pylist())))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], ["vec_id", "v", "cell"])

    index = materialize(index.mapInArrow(in_cells, "vec_id long, v array<double>, cell long"), "ann-index")
    size = index.groupBy("cell").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    q = valid(queries).select(F.col("vec_id").alias("query_id"), "v")

    def route(first: bool):
        """The cells a query visits: its own, or all others that its test leaves open."""
        limit = chi2_quantile(sure, DIMS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                v = _matrix(b.column(1).to_pylist())
                near = box_distance(proj.queries(v), cells.lo, cells.hi)
                home = near.argmin(1)
                if first:
                    pick = [[int(c)] for c in home]
                else:
                    kth = b.column(2).to_numpy(zero_copy_only=False)
                    reach = limit * np.maximum((v * v).sum(1) + proj.norm2 - 2 * kth, 0.0)
                    go = near <= reach[:, None]
                    go[np.arange(len(v)), home] = False
                    pick = [np.flatnonzero(g).tolist() for g in go]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pick, pa.list_(pa.int64()))], [*b.schema.names, "cells"])
        return run

    def visit(asked: DataFrame) -> DataFrame:
        """asked: query_id, v, floor, cells."""
        asked = asked.withColumn("cell", F.explode("cells")).drop("cells")
        blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
        each = size.join(blocks, "cell")  # a row for each cell, MOST_CELLS at most
        upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
        slot = lambda i, c: F.pmod(F.xxhash64(i), F.col(c)).cast("int")
        left = (index.join(F.broadcast(each), "cell").withColumn("part", slot("vec_id", "parts"))
                .withColumn("block", F.explode(upto("blocks"))).select("cell", "part", "block", "vec_id", "v"))
        right = (asked.join(F.broadcast(each), "cell").withColumn("block", slot("query_id", "blocks"))
                 .withColumn("part", F.explode(upto("parts"))).select("cell", "part", "block", "query_id", "v", "floor"))
        keys = ("cell", "part", "block")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_visit(proj, k, sure), out)

    floor = F.lit(float("-inf"))
    home = q.mapInArrow(route(True), "query_id long, v array<double>, cells array<long>").withColumn("floor", floor)
    one = materialize(_top(visit(home), k), "ann-home")
    kth = one.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    rest = (q.join(kth, "query_id", "left").select("query_id", "v", F.coalesce("floor", floor).alias("floor"))
            .mapInArrow(route(False), "query_id long, v array<double>, floor double, cells array<long>"))
    both = one.select("query_id", "vec_id", "score").union(visit(rest))
    return _top(both.distinct(), k).select("query_id", "rank", "vec_id", "score")
