"""JSON as VARIANT: one parse, then native reads of whatever shapes a payload has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def inside(v: Column, key: str) -> Column:
    """The value under a key, as variant; null if there is none or `v` is no object."""
    return F.try_variant_get(v, f"$.{key}", "variant")


def told(v: Column) -> Column:
    """`v`, or null if it is JSON's null, false, zero or empty."""
    shown = F.try_variant_get(v, "$", "string")
    blank = (shown == "") | (F.schema_of_variant(v) != "STRING") & shown.isin("0", "0.0", "false", "[]", "{}")
    return F.when(shown.isNotNull() & ~blank, v)


def first_told(v: Column, *keys: str) -> Column:
    """The first of the keys' values that tells something, as variant."""
    return F.coalesce(*[told(inside(v, k)) for k in keys])


def words(v: Column) -> Column:
    """A value as text; null stays null."""
    return F.try_variant_get(v, "$", "string")


def elements(v: Column) -> Column:
    """The elements of an array; none for anything else."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))
