"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _measure(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return r["n"], r["x"]


def components(edges: DataFrame, tmp: Scratch, name: str = "cc", most: int = 60) -> DataFrame:
    """(id, component) for every node of `edges` (u, v: long; any order, loops and repeats allowed); component is
    the smallest id reachable. Steps are joins on nodes, written to the scratch folder; nothing is collected."""
    low, high = F.least("u", "v"), F.greatest("u", "v")
    now = tmp.save(edges.filter("u <> v").select(low.alias("u"), high.alias("v")).distinct(), f"{name}-0")
    have = _measure(now)
    for step in range(1, most + 1 if have[0] else 1):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct()
        least = large.groupBy(F.col("v").alias("a")).agg(F.min("u").alias("m"))
        joined = large.select(F.col("v").alias("a"), F.col("u").alias("b")).join(least, "a")
        small = joined.select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("a").alias("v")), F.struct(F.col("m").alias("u"), F.col("b").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        now = tmp.save(small, f"{name}-{step}")
        was, have = have, _measure(now)
        tmp.drop(f"{name}-{step - 1}")
        if was == have:
            break
    else:
        if have[0]:
            raise RuntimeError("components did not settle")
    return now.select(F.col("v").alias("id"), F.col("u").alias("component")).union(now.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct())
