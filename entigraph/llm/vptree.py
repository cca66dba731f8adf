"""Nearest neighbours by vantage-point trees, one per shard.

Inner products become distances by one more component: with M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and
q' = (q, 0) have |x' - q'|^2 = M^2 + |q|^2 - 2 <x, q>. A tree node splits its points at the median distance from a
vantage point. The side away from a query is visited if the distance to the boundary is at most `factor` times the
distance of the k-th neighbour so far: with factor 1 the triangle inequality makes that exact, below 1 more is
pruned. A shard's rows go to one task, which builds its tree once; then the queries of its dimension stream by in
batches, so that a task holds one shard and one batch. Each shard gives its k best, and the best of those win.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch
from .vectors import distinct, matrices, matrix, prepared

LEAF, PAIRS = 256, 1 << 16


class VantagePointTree:
    """Over the rows of x (doubles); `extra` is the added component of each row."""

    def __init__(self, x: np.ndarray, largest: float):
        self.x = x
        self.extra = np.sqrt(np.maximum(0.0, largest**2 - (x * x).sum(1)))
        self.inner = self.outer = None
        self.root = self._build(np.arange(len(x)), np.random.default_rng(7))

    def _build(self, rows: np.ndarray, rng):
        if len(rows) <= LEAF:
            return rows
        at = rows[rng.integers(len(rows))]
        d = np.sqrt(((self.x[rows] - self.x[at]) ** 2).sum(1) + (self.extra[rows] - self.extra[at]) ** 2)
        half = float(np.median(d))
        inside = d <= half
        if inside.all():  # all as far as the farthest: nothing to split by
            return rows
        return at, half, self._build(rows[inside], rng), self._build(rows[~inside], rng)

    def search(self, queries: np.ndarray, k: int, factor: float, largest: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, rows and inner products of the k best of each query found, best first, ties to the smaller row.

        Fast products choose what may be among the k best; exact_products decide.
        """
        n = len(queries)
        size = np.sqrt((queries * queries).sum(1))
        norm = size**2 + largest**2
        slack = 1e-9 * (largest * size + 1e-300)  # more than the fast products are wrong by
        row, best = np.full((n, k), len(self.x)), np.full((n, k), -np.inf)  # best first; where there are fewer, no row

        def radius(q: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0.0, norm[q] - 2 * best[q, -1])) + 1e-7 * np.sqrt(norm[q])

        def leaf(rows: np.ndarray, q: np.ndarray) -> None:
            rough = queries[q] @ self.x[rows].T
            floor = best[q, -1] - slack[q]
            if len(rows) > k:  # the k-th best of this leaf is a bound, too
                floor = np.maximum(floor, np.partition(rough, len(rows) - k, axis=1)[:, len(rows) - k] - 2 * slack[q])
            of, at = np.nonzero(rough >= floor[:, None])
            some = np.unique(of)
            if not len(some):
                return
            exact = np.concatenate([exact_products(queries[q[of[i : i + PAIRS]]], self.x[rows[at[i : i + PAIRS]]]) for i in range(0, len(of), PAIRS)])
            of = np.concatenate([np.searchsorted(some, of), np.repeat(np.arange(len(some)), k)])
            all_rows, products = np.concatenate([rows[at], row[q[some]].ravel()]), np.concatenate([exact, best[q[some]].ravel()])
            order = np.lexsort((all_rows, -products, of))
            ends = np.searchsorted(of[order], np.arange(len(some)))
            first = order[ends[:, None] + np.arange(k)]  # each query has k old ones at least
            row[q[some]], best[q[some]] = all_rows[first], products[first]

        def visit(node, q: np.ndarray) -> None:
            if not len(q):
                return
            if isinstance(node, np.ndarray):
                leaf(node, q)
                return
            at, half, inner, outer = node
            d = np.sqrt(np.maximum(0.0, norm[q] - 2 * (queries[q] @ self.x[at])))
            inside = d <= half
            visit(inner, q[inside])
            visit(outer, q[~inside])
            far = q[inside]
            visit(outer, far[half - d[inside] <= factor * radius(far)])
            far = q[~inside]
            visit(inner, far[d[~inside] - half <= factor * radius(far)])

        visit(self.root, np.arange(n))
        of, col = np.nonzero(row < len(self.x))
        return of, row[of, col], best[of, col]


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added in one fixed order, so that equal vectors get equal scores."""
    return (q * x).sum(-1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 0.4, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = 16384) -> DataFrame:
    """The `k` rows of `vectors` with the largest inner product found for each row of `queries`.

    Columns: query_id, rank (from 1), vec_id, score; nearest first, ties to the smaller id; fewer rows if there are
    fewer candidates. A query's own id is no candidate, nor is a vector of another dimension. Vectors that are null,
    empty, zero or hold null or non-finite components take no part, nor do null ids. Every other row is indexed. Of
    equal vectors one is indexed, and stands for its k + 1 smallest ids: no other copy can be among the k nearest.
    An id with several vectors is met by each of them as a candidate and, as a query, asks with the one of most
    components, of these the one with the greatest bytes. `factor` 1 is exact. No tables, no rows.
    """
    spark = vectors.sparkSession
    with scratch(spark) as tmp:
        rows = tmp.save(prepared(vectors, id_col, vec_col).filter("v is not null and id is not null"), "rows")
        own = distinct(rows, tmp, "own")
        held = own.select("dim", "v").mapInArrow(_norms, "dim int, n long, m double").groupBy("dim").agg(F.sum("n").alias("n"), (F.max("m") * (1 + 1e-9)).alias("largest"))
        held = tmp.save(held.withColumn("shards", F.ceil(F.col("n") / shard_rows).cast("int")), "held")  # one row per dimension: read anew, Spark knows its size
        asked = prepared(queries, id_col, vec_col).filter("v is not null and id is not null").groupBy("id").agg(F.max(F.struct("dim", "v")).alias("q")).select("id", "q.dim", "q.v")
        index = own.join(held, "dim").select("dim", F.pmod(F.xxhash64("fp"), "shards").cast("int").alias("shard"), "largest", F.lit(False).alias("query"), "id", "v")
        ask = asked.join(held, "dim").select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "largest", F.lit(True).alias("query"), "id", "v")

        def searched(batches):
            key = tree = None
            ids: list[int] = []
            raw: list[bytes] = []
            for batch in batches:  # by shard, and in each the index first
                dims, shards, tops, asks, names, vs = (batch.column(i).to_pylist() for i in range(6))
                at = 0
                while at < len(dims):
                    if (dims[at], shards[at]) != key:
                        key, tree, ids, raw = (dims[at], shards[at]), None, [], []
                    end = at
                    while end < len(dims) and (dims[end], shards[end], asks[end]) == (*key, asks[at]):
                        end += 1
                    if not asks[at]:
                        ids += names[at:end]
                        raw += vs[at:end]
                    elif raw or tree:
                        if tree is None:
                            order = np.argsort(np.array(ids, np.int64), kind="stable")  # so rows are in the order of ids
                            found_ids, tree = np.array(ids, np.int64)[order], VantagePointTree(matrix(raw)[order], tops[at])
                            ids, raw = [], []
                        of, hit, score = tree.search(matrix(vs[at:end]), min(k + 1, len(tree.x)), factor, tops[at])
                        asked_ids = np.array(names[at:end], np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(asked_ids[of]), pa.array(found_ids[hit]), pa.array(score)], ["query_id", "id", "score"])
                    at = end

        dealt = index.union(ask).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "query")
        found = dealt.select("dim", "shard", "largest", "query", "id", "v").mapInArrow(searched, "query_id long, id long, score double")
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        found = tmp.save(found.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= k + 1).drop("r"), "found")
        # the k + 1 smallest ids of each vector that was found
        hits = found.select("id").distinct().join(own.select("id", F.col("fp").alias("f")), "id").select(F.col("id").alias("rep"), "f")
        same = rows.select("id", "fp").distinct().join(hits, F.col("fp") == F.col("f"))
        by = Window.partitionBy("rep").orderBy("id")
        same = same.select("rep", "id").withColumn("r", F.row_number().over(by)).filter(F.col("r") <= k + 1)
        same = same.groupBy("rep").agg(F.collect_list("id").alias("ids"))
        found = found.join(same, found["id"] == same["rep"]).select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id")
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        out = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        return out.checkpoint()


def _norms(batches):
    for batch in batches:
        found = [(dim, len(a), float(np.sqrt((a * a).sum(1)).max())) for dim, _, a in matrices(batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.float64()))], ["dim", "n", "m"])
