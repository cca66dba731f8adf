"""Merkle manifest of a dataset: a tree of three children a node over every source's rows, and one over the sources.

Nodes of a tree are numbered. Every aligned block of 3^7 of them is traversed by itself: for each height there is a stack
that computes, ahead of time, the nodes of the run that comes next beside the path (treehash), and each leaf moves the
stacks on by as much work as a leaf costs on average, the lowest unfinished one first. So the authentication path of a
leaf is at hand when its turn comes, and the working state is a few nodes a height. Blocks give one node each, these
form the nodes of the next round, and so on; what lies above a block is the same for all of its leaves and is appended
to their paths by a join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, kept_table, scratch

ARITY = 3
#: Heights of a block: 2,187 leaves.
HEIGHTS = 7
STEPS = T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())]))
STEP = STEPS.simpleString()


def digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def heights(n: int) -> int:
    """Rounds of threes until one node is left."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


class Treehash:
    """Computes the nodes of one height over leaves [at, end), leaf by leaf, with a stack of unfinished nodes."""

    def __init__(self, leaves: Sequence[str], height: int, at: int, end: int):
        self.leaves, self.height, self.at, self.end = leaves, height, at, min(end, len(leaves))
        self.stack: list[tuple[int, str]] = []
        self.nodes: list[str] = []

    def lowest(self) -> int:
        """Height of the node that the stack has on top; a finished one comes last."""
        return 99 if self.at >= self.end else self.stack[-1][0] if self.stack else self.height

    def step(self) -> None:
        """Takes one leaf, and joins what has become a full run."""
        level, node = 0, self.leaves[self.at]
        self.at += 1
        last = self.at == self.end
        while level < self.height:
            run = [node]
            while self.stack and self.stack[-1][0] == level:
                run.append(self.stack.pop()[1])
            if len(run) < ARITY and not last:
                break
            level, node = level + 1, digest(run[::-1])
        if level < self.height:
            self.stack.extend((level, x) for x in run[::-1])
        else:
            self.nodes.append(node)
        if last and self.stack:  # cannot be: the last leaf closes every run
            raise AssertionError("unfinished nodes")

    def finish(self) -> list[str]:
        while self.at < self.end:
            self.step()
        return self.nodes


def paths(leaves: Sequence[str], high: int) -> Iterator[list[tuple[str, str]]]:
    """For each leaf of a block of `high` heights: the siblings before and after it, joined, from the bottom up."""
    size = [ARITY**h for h in range(high + 2)]
    runs = [Treehash(leaves, h, 0, size[h + 1]).finish() for h in range(high)]
    ahead = [Treehash(leaves, h, size[h + 1], 2 * size[h + 1]) for h in range(high)]
    for i in range(len(leaves)):
        out = []
        for h, run in enumerate(runs):
            k = i // size[h] % ARITY
            out.append(("".join(run[:k]), "".join(run[k + 1 :])))
        yield out
        for _ in range(high):
            now = min(ahead, key=Treehash.lowest)
            if now.at >= now.end:
                break
            now.step()
        for h in range(high):
            if (i + 1) % size[h + 1]:
                break
            runs[h] = ahead[h].finish()
            ahead[h] = Treehash(leaves, h, i + 1 + size[h + 1], i + 1 + 2 * size[h + 1])


def folded(leaf: Column | str, proof: Column | str) -> Column:
    """The root that a leaf and its path give, computed anew."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(proof, start, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def leaf_digest(*values: Column) -> Column:
    """H of values, each as its length in bytes, a colon and itself, or a dash if null."""
    field = lambda v: F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.concat(*[field(v.cast("string")) for v in values]), 256)


def numbered(rows: DataFrame, tree: str, order: list[str], tmp: Scratch, name: str) -> DataFrame:
    """`rows` with idx (from 0, in order within their tree, nulls first) and n, the tree's size.

    Rows are dealt by ranges of (tree, order), so that a large tree is spread over many tasks; a row's place in its range
    and the sizes of the ranges before it give its number.
    """
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    placed = tmp.save(placed.withColumn("part", F.shiftright("place", 33)), f"{name}-placed")
    sizes = placed.groupBy(F.col(tree).alias("t"), F.col("part").alias("p")).agg(F.min("place").alias("first"), F.count("*").alias("k"))
    by_part = Window.partitionBy("t").orderBy("p")
    sizes = sizes.withColumn("offset", F.sum("k").over(by_part) - F.col("k")).withColumn("n", F.sum("k").over(Window.partitionBy("t")))
    out = placed.join(sizes, (F.col("part") == F.col("p")) & F.col(tree).eqNullSafe(F.col("t")))
    return out.withColumn("idx", F.col("place") - F.col("first") + F.col("offset")).drop("place", "part", "t", "p", "first", "k", "offset")


def traversed(nodes: DataFrame, tree: str, node: str, high: int) -> DataFrame:
    """`nodes` (tree, idx, n, node) with `path` within their block of 3^high and, at the block's first node, `top`: its root."""
    size = ARITY**high
    names = nodes.columns
    at = {c: i for i, c in enumerate(names)}
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.concat_batches(rows) if len(rows) > 1 else rows[0]
        leaves, n = batch.column(at[node]).to_pylist(), batch.column(at["n"])[0].as_py()
        own = min(high, heights(n))
        found = [[{"before": b, "after": a} for b, a in p] for p in paths(leaves, own)]
        top = [Treehash(leaves, own, 0, size).finish()[0], *[None] * (len(leaves) - 1)]
        columns = [batch.column(at[c]) for c in names]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, kind), pa.array(top, pa.string())], [*names, "path", "top"])

    def walk(batches):
        held: list[pa.RecordBatch] = []
        have = 0
        for batch in batches:
            idx, many = batch.column(at["idx"]).to_pylist(), batch.column(at["n"]).to_pylist()
            start = 0
            for i, (k, n) in enumerate(zip(idx, many, strict=True)):
                have += 1
                if have == size or k == n - 1:
                    held.append(batch.slice(start, i + 1 - start))
                    yield block(held)
                    held, have, start = [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))

    own = nodes.withColumn("block", F.expr(f"idx div {size}"))
    dealt = own.repartition(F.col(tree), F.col("block")).sortWithinPartitions(F.col(tree).asc_nulls_first(), "idx").drop("block")
    schema = T.StructType([*nodes.schema.fields, T.StructField("path", STEPS), T.StructField("top", T.StringType())])
    return dealt.mapInArrow(walk, schema)


def appended(nodes: DataFrame, tree: str, above: DataFrame, high: int) -> DataFrame:
    """`nodes` with their paths continued by what lies above their blocks."""
    at = F.col(tree).eqNullSafe(F.col("__t")) & (F.expr(f"idx div {ARITY**high}") == F.col("b"))
    return nodes.join(above.withColumnRenamed("t", "__t"), at).withColumn("path", F.concat("path", "above")).drop("__t", "b", "above")


def forest(nodes: DataFrame, tree: str, node: str, tmp: Scratch, name: str, high: int) -> tuple[DataFrame, DataFrame]:
    """`nodes` (tree, idx, n, node, others) with `path` within their block, and (t, b, above, tree_root): what lies above
    block b of tree t."""
    size = ARITY**high
    levels, now = [], nodes
    while True:
        done = tmp.save(traversed(now, tree, node, high), f"{name}-{len(levels)}")
        levels.append(done.drop("top"))
        tops = done.filter("top is not null").select(F.col(tree), F.expr(f"idx div {size}").alias("idx"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias(node))
        now = tmp.save(tops, f"{name}-tops-{len(levels)}")
        if now.filter("n > 1").isEmpty():
            break
    above = now.select(F.col(tree).alias("t"), F.col("idx").alias("b"), F.array().cast(STEP).alias("above"), F.col(node).alias("tree_root"))
    for done in reversed(levels[1:]):
        above = appended(done, tree, above, high).select(F.col(tree).alias("t"), F.col("idx").alias("b"), F.col("path").alias("above"), "tree_root")
    return levels[0], above


def manifest(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "source", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), carried: dict[str, Column] | None = None, high: int = HEIGHTS) -> DataFrame:
    """(id, leaf, proof, subroot, root) for every row: its digest, the siblings before and after it at each level up to
    the root, its source's root and the dataset's.

    Leaves ascend by id within a source (nulls first; rows of one id by their digest), sources by their UTF-8 bytes (null
    first). `folded(leaf, proof)` gives the root for a true row alone. `carried` are columns over `docs` that come along
    under their names; blocks have `high` heights. Fields may be null or empty; repeated rows are leaves of their own; an empty table has no rows and
    no root; columns beside `fields` do not matter, whatever their names. Texts are read once and never shuffled.
    """
    if docs.isEmpty():
        kinds = docs.select(F.col(id_col).alias("id"), *[c.alias(k) for k, c in (carried or {}).items()])
        return kinds.selectExpr(f"id as `{id_col}`", *[f"`{k}`" for k in carried or {}], "'' as leaf", f"cast(array() as {STEP}) as proof", "'' as subroot", "'' as root").filter("false")
    with scratch(docs.sparkSession) as tmp:
        rows = docs.select(F.col(id_col).alias("__id"), F.col(tree_col).alias("__tree"), leaf_digest(*[F.col(c) for c in fields]).alias("leaf"), *[c.alias(f"__c_{k}") for k, c in (carried or {}).items()])
        leaves, above = forest(numbered(rows, "__tree", ["__id", "leaf"], tmp, "leaves"), "__tree", "leaf", tmp, "tree", high)
        roots = tmp.save(above.groupBy(F.col("t").alias("__tree")).agg(F.first("tree_root").alias("node")).withColumn("all", F.lit(0)), "subroots")
        tops, last = forest(numbered(roots, "all", ["__tree"], tmp, "roots"), "all", "node", tmp, "top", high)
        roots = appended(tops, "all", last, high).select(F.col("__tree").alias("of"), F.col("node").alias("subroot"), F.col("path").alias("rest"), F.col("tree_root").alias("root"))
        above = above.join(roots, F.col("t").eqNullSafe(F.col("of"))).select("t", "b", F.concat("above", "rest").alias("above"), "subroot", "root")
        leaves, above = kept_table(leaves), kept_table(above)  # a leaf's whole path is put together when the rows are read
    out = leaves.join(above, F.col("__tree").eqNullSafe(F.col("t")) & (F.expr(f"idx div {ARITY**high}") == F.col("b")))
    return out.select(F.col("__id").alias(id_col), *[F.col(f"__c_{k}").alias(k) for k in carried or {}], "leaf", F.concat("path", "above").alias("proof"), "subroot", "root")
