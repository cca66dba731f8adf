"""Near-duplicate vectors by an exact metric range join.

A cosine of c between unit vectors is a distance of sqrt(2 - 2c), so linked pairs are those within a radius. Every
vector has its home in the cell of its nearest pivot, and is copied to each cell of a smaller number in which a vector
within the radius could be at home: by the triangle inequality that takes a pivot no farther than the own one plus
twice the radius, and a boundary (the bisector of both pivots) no farther than the radius. So the smaller of two homes
finds the link between them, once, and no cell needs another. Cells are joined block by block, home vectors with each other once and with guests from other
cells; a block gives counts and a spanning forest, never pairs. Vectors of different dimensions share no cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch
from .components import components
from .linear import sampled
from .vectors import distinct, matrices, matrix, prepared

BLOCK, TILE = 16384, 2048  # rows of a task's sides, and of the matrices it holds at a time
ROW_S, PAIR_S = 2e-5, 6e-9  # seconds to move a row and to compare two
MOST_DIMS = 16  # dimensions with pivots, the commonest; any other one is a single cell
SLACK = 1e-6


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    """n unit vectors of the sample, each the farthest from those before."""
    if not len(sample):
        return sample
    chosen, near = [0], 1 - sample @ sample[0]
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, 1 - sample @ sample[chosen[-1]])
    return sample[chosen]


def unit(a: np.ndarray) -> np.ndarray:
    a = a / np.abs(a).max(axis=1, keepdims=True) if len(a) else a
    return a / np.linalg.norm(a, axis=1, keepdims=True) if len(a) else a


def packed(a: np.ndarray) -> list[bytes]:
    """Rows as bytes: of single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        short = a.astype(np.float32)
    same = (short.astype(np.float64) == a).all(axis=1)
    return [short[i].tobytes() if same[i] else a[i].tobytes() for i in range(len(a))]


def unpacked(raw, dim: int) -> np.ndarray:
    raw = list(raw)
    if all(len(r) == 4 * dim for r in raw):
        return np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), dim).astype(np.float64)
    return np.array([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64) for r in raw], np.float64).reshape(len(raw), dim)


def linked(a: np.ndarray, b: np.ndarray, ua: np.ndarray, ub: np.ndarray, least: float) -> np.ndarray | None:
    """Which rows of a and b have a cosine of at least `least`, None if no two: single precision (ua, ub: unit rows) far from it, double near it."""
    rough = ua @ ub.T
    if rough.max() < least - 1e-4:
        return None
    out = rough >= least
    for i, j in zip(*np.nonzero(np.abs(rough - least) < 1e-4), strict=True):
        out[i, j] = np.dot(a[i], b[j]) / (np.sqrt(np.dot(a[i], a[i])) * np.sqrt(np.dot(b[j], b[j]))) >= least
    return out


def forest(adjacent: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges (node, smallest node of its component) of the two-sided graph."""
    rows, cols = np.flatnonzero(adjacent.any(1)), np.flatnonzero(adjacent.any(0))
    adjacent, a, b = adjacent[np.ix_(rows, cols)], left[rows].copy(), right[cols].copy()
    top = np.iinfo(np.int64).max
    while len(rows):
        new_a = np.minimum(a, np.where(adjacent, b[None, :], top).min(1))
        new_b = np.minimum(b, np.where(adjacent, new_a[:, None], top).min(0))
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    return [(int(i), int(r)) for own, labels in ((left[rows], a), (right[cols], b)) for i, r in zip(own, labels, strict=True) if i != r]


def reach(u: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each unit vector's nearest pivot, and with it the smaller cells in which a vector within the radius could be at home."""
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
    d2 = np.maximum(0, 2 - 2 * u @ pivots.T)
    d, home, at = np.sqrt(d2), d2.argmin(axis=1), np.arange(len(u))
    mine = d[at, home][:, None]
    gap = (d2 - mine**2) / np.maximum(2 * apart[home], 1e-12)
    into = (d <= mine + 2 * radius) & ((gap <= radius) | (apart[home] < 1e-9)) & (np.arange(len(pivots)) < home[:, None])
    into[at, home] = True
    return home, into


def cheapest(pivots: np.ndarray, sample: np.ndarray, n: int, radius: float) -> np.ndarray:
    """The first 2, 4, 8, ... or all of the pivots: as many as promise the least work for n vectors like the sample.

    There are at least so many that a cell of average size is one block. More cells only pay where they keep vectors
    apart: where most vectors would be copied into most cells, fewer cells shuffle less. The sample is bounded; a wrong
    guess costs time, never links.
    """
    fewest, best, least_cost = min(len(pivots), max(2, -(-n // BLOCK))), pivots, np.inf
    for k in sorted({fewest, len(pivots), *(2**i for i in range(len(pivots).bit_length()) if fewest <= 2**i <= len(pivots))}):
        home, into = reach(sample, pivots[:k], radius)
        own = np.bincount(home, minlength=k) * (n / len(sample))
        guests = into.sum(axis=0) * (n / len(sample)) - own
        rows = (own * (np.ceil(own / BLOCK) + np.ceil(guests / BLOCK)) + guests * np.ceil(own / BLOCK)).sum()
        cost = rows * ROW_S + (own * (own / 2 + guests)).sum() * PAIR_S
        if cost < least_cost:
            best, least_cost = pivots[:k], cost
    return best


def near_duplicate_vectors(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding", cell_rows: int = 4096, sample: int = 4000) -> DataFrame:
    """(id_col, n_links, component_id, kept), one row per row of `vectors`.

    Vectors with a cosine (double precision) of at least `least` are linked; n_links counts the other rows linked
    directly, component_id is the smallest id reachable, kept marks that one. Vectors of different dimensions are
    not linked. Vectors that are null, empty, zero or hold null or non-finite components link with nothing; a null
    id gives a null component and is kept. Pivots (one for `cell_rows` vectors, a fourth of the sample at most) come
    from the rows of the least id hashes, `sample` rows in proportion to the dimensions; they steer the cost alone. Rows that share an id and a vector count as copies.
    """
    spark = vectors.sparkSession
    radius = float(np.sqrt(max(0.0, 2 - 2 * least))) + SLACK
    with scratch(spark) as tmp:
        rows = tmp.save(prepared(vectors, id_col, vec_col), "rows")
        own = distinct(rows, tmp, "own")
        dims = own.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(MOST_DIMS).collect()
        total, found_pivots = sum(r["count"] for r in dims), {}
        for dim, n in dims:
            if found_pivots and n <= cell_rows:
                break
            most = max(8, sample * n // total)
            few = unit(matrix(r["v"] for r in sampled(own.filter(F.col("dim") == dim).select("id", "v"), "id", most).collect()))  # `sample` rows and a few at most
            pivots = farthest_first(few, max(2, min(most // 4, -(-n // cell_rows))))
            found_pivots[dim] = cheapest(pivots, few, n, radius)
        shared = spark.sparkContext.broadcast(found_pivots)

        def cells(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                for dim, at, a in matrices(batch.column(2).to_pylist()):
                    if dim in shared.value:
                        home, into = reach(unit(a), shared.value[dim], radius)
                    else:
                        home, into = np.zeros(len(a), np.int64), np.ones((len(a), 1), bool)
                    row, cell = np.nonzero(into)
                    take = pa.array(at[row])
                    dims = pa.array(np.full(len(row), dim, np.int32))
                    yield pa.RecordBatch.from_arrays([dims, pa.array(cell.astype(np.int32)), pa.array(home[row] == cell), *(batch.column(i).take(take) for i in range(2)), pa.array(packed(a), pa.binary()).take(pa.array(row))], ["dim", "cell", "home", "id", "copies", "v"])

        dealt = tmp.save(own.select("id", "copies", "v").mapInArrow(cells, "dim int, cell int, home boolean, id long, copies long, v binary"), "cells")
        blocks = lambda test: F.ceil(F.count_if(test) / BLOCK).cast("int")
        sizes = tmp.save(dealt.groupBy("dim", "cell").agg(blocks(F.col("home")).alias("homes"), blocks(~F.col("home")).alias("guests")), "sizes")  # one row per pivot and dimension
        dealt = dealt.join(sizes, ["dim", "cell"]).filter("homes > 0").withColumn("part", F.pmod(F.xxhash64("id"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests"))).cast("int"))
        every = lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.col(c), F.lit(1))), lambda x: x - 1)
        place = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
        among = F.transform(every("homes"), lambda x: place(0, F.least(x, F.col("part")), F.greatest(x, F.col("part"))))
        hosts = F.when(F.col("guests") > 0, F.transform(every("guests"), lambda x: place(1, F.col("part"), x))).otherwise(F.array().cast("array<struct<kind:int,i:int,j:int>>"))
        visits = F.transform(every("homes"), lambda x: place(1, x, F.col("part")))
        dealt = dealt.select("dim", "cell", "home", "part", "id", "copies", "v", F.explode(F.when(F.col("home"), F.concat(among, hosts)).otherwise(visits)).alias("p"))

        def joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            dim, _, kind, i, j = key
            ids, copies, a = rows["id"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64), unpacked(rows["v"], dim)
            u, part, home = unit(a).astype(np.float32), rows["part"].to_numpy(), rows["home"].to_numpy(bool)
            left = np.flatnonzero(home & (part == i))
            right = left if kind == 0 and i == j else np.flatnonzero(part == j) if kind == 0 else np.flatnonzero(~home)
            links, tree = np.zeros(len(ids), np.int64), []
            for x in range(0, len(left), TILE):
                for y in range(x if right is left else 0, len(right), TILE):
                    l, r = left[x : x + TILE], right[y : y + TILE]  # noqa: E741
                    near = linked(a[l], a[r], u[l], u[r], least)
                    if near is None:
                        continue
                    same = right is left and x == y
                    if same:
                        np.fill_diagonal(near, False)
                    links[l] += near @ copies[r]
                    if not same:
                        links[r] += near.T @ copies[l]
                    tree += forest(near, ids[l], ids[r])
            some = np.flatnonzero(links)
            return pd.DataFrame({"id": [*ids[some], *(e[0] for e in tree)], "links": [*links[some], *[0] * len(tree)], "root": [*ids[some], *(e[1] for e in tree)]})

        found = tmp.save(dealt.groupBy("dim", "cell", "p.kind", "p.i", "p.j").applyInPandas(joined, "id long, links long, root long"), "found")
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        group = components(found.filter("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v")), tmp)
        label = own.select("id", "copies", F.col("fp").alias("f")).join(links, "id", "left").join(group, "id", "left")
        label = label.select("f", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
        out = rows.select("id", "fp").join(label, (F.col("fp") == F.col("f")) & F.col("id").isNotNull(), "left")
        component = F.coalesce("component", "id")
        out = out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
        return out.checkpoint()
