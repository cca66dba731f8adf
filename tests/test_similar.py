"""Similar names against all pairs."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from entigraph.functions.similarity import token_set_ratio
from entigraph.operators import similar
from entigraph.operators.similar import name_form, similar_forms

WORDS = ["education", "grants", "to", "states", "for", "health", "services", "the", "aid", "rural", "energy", "program", "of", "research", "a", "housing", "ñandú", "x1"]


def misspelt(rng, name):
    s = list(name)
    for _ in range(rng.choice([0, 1, 1, 2, 3])):
        k = rng.randrange(len(s) + 1)
        s[k : k + rng.choice([0, 1])] = rng.choice(["", "e", "s", " "])
    return "".join(s)


def names(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        name = " ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 2, 3, 5, 8])))
        out += [name, misspelt(rng, name)] if rng.random() < 0.5 else [name]
        if rng.random() < 0.3:
            out.append(" ".join(rng.sample(name.split(), len(name.split()))) + rng.choice(["", " pilot", "s"]))
    return [(rng.choice("ABC"), x) for x in out] + [("A", ""), ("A", " \t"), ("A", None), ("B", "a"), ("B", "b"), ("B", "ab"), ("B", "\x1ca\x1d b"), (None, "aid")]


@pytest.mark.parametrize(("threshold", "seed"), [(88, 1), (92, 2), (75, 3), (88, 4), (100, 5)])
def test_same_pairs_as_brute_force(spark, threshold, seed):
    rows = names(seed, 60)
    got = similar_forms(spark.createDataFrame(rows, "g string, name string").select("g", name_form("name").alias("form")), threshold).collect()
    forms = sorted({(g, " ".join(sorted(set((n or "").split())))) for g, n in rows if g})
    want = {(g, a, b, token_set_ratio(a, b)) for g, a in forms for h, b in forms if g == h and a and a < b and token_set_ratio(a, b) >= threshold}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert want


@pytest.mark.parametrize(("threshold", "seed", "paired"), [(88, 1, 0), (92, 2, 0), (75, 3, 0), (100, 5, 0), (88, 6, 30)])
def test_same_pairs_by_postings(spark, monkeypatch, threshold, seed, paired):
    monkeypatch.setattr(similar, "PAIRED", paired)
    test_same_pairs_as_brute_force(spark, threshold, seed)


def test_two_forms_are_measured_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def counting(a: pd.Series, b: pd.Series) -> pd.Series:
        seen.add(len(a))
        return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype=float)

    monkeypatch.setattr(similar, "token_set", counting)
    rows = [(f"g{i}", f"aid to states{end}") for i in range(40) for end in ("", "s", " x", " y")]
    got = similar_forms(spark.createDataFrame(rows, "g string, name string").select("g", name_form("name").alias("form")), 88)
    assert got.groupBy("g").count().select("count").distinct().count() == 1 and got.select("g").distinct().count() == 40
    assert 0 < seen.value <= 12  # of six pairs, each told and filtered


def test_low_thresholds_are_refused(spark):
    with pytest.raises(ValueError, match="75"):
        similar_forms(spark.createDataFrame([], "g string, form string"), 60)
