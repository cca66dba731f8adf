"""Ordered operators: dedupe by first, last or longest, fill-down, ordered argmax, tree walks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in this order, by an aggregate that combines before the shuffle."""
    rows = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    out = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min_by(rows, rank).alias("__r"))
    return out.select("__r.*")


def keep_first(df: DataFrame, keys: list[str], idx: str) -> DataFrame:
    return first_by(df, keys, F.col(idx))


def keep_last(df: DataFrame, keys: list[str], idx: str) -> DataFrame:
    return first_by(df, keys, -F.col(idx))


def keep_longest(df: DataFrame, keys: list[str], value: str, idx: str) -> DataFrame:
    """The row with the longest value; of equals the first."""
    return first_by(df, keys, -F.length(value), F.col(idx))


def fill_down(df: DataFrame, group: list[str], idx: str, value: str, out: str) -> DataFrame:
    """The last value that was neither null nor empty, up to each row."""
    w = Window.partitionBy(*group).orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(F.when(F.col(value) != "", F.col(value)), ignorenulls=True).over(w))


def missing_from(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of left whose keys occur nowhere in right."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows under the union of the columns; missing text is the empty string."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.na.fill("", [f.name for f in out.schema.fields if f.dataType.simpleString() == "string"])
