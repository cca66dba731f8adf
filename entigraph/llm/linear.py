"""Hashed word features and linear scorers fitted with numpy.

A model is fitted in two steps. The first runs on the executors: the feature ids of a bounded sample are written to the
shared folder, and for each feature the rows that have it and the sum of their targets are counted. Only features that
pass the tests of `chosen_features` go on, and only their ids reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch, small_batches
from .pieces import Recent

BITS = 20
SIZE = 1 << BITS
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5)


def feature(name: str) -> int:
    return xxhash.xxh32_intdigest(name) & (SIZE - 1)


def _ids(word: str) -> tuple[int, ...]:
    """Feature ids of a word and of its first letters."""
    return tuple(map(feature, (word, *("^" + word[:n] for n in STEMS))))


WORD_IDS = Recent(_ids, 50_000)


def word_features(text: str | None) -> set[int]:
    """Ids of all words of the whole text, lowered, and of their first letters."""
    return set().union(*map(WORD_IDS.__getitem__, set(WORD.findall((text or "").lower()))))


def sampled(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` rows, those with the least hashes of `key`: the same rows in each run, spread over all ids."""
    return rows.orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key)).limit(most)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def chosen_features(rows: DataFrame, least: int, least_z: float, always: Iterable[int] = ()) -> tuple[np.ndarray, float, int]:
    """(sorted ids of the features that get a weight, mean target, rows) of a sample (ids: array<int>, y: double).

    A feature counts if `least` rows have it and the mean target of these differs from that of all rows by `least_z`
    standard deviations or more: rare words are too many to learn by chance. Features of `always` count if any row
    has them. There are at most SIZE features.
    """
    whole = rows.agg(F.count("*").alias("n"), F.avg("y").alias("mean")).first()
    n, mean = whole["n"], float(whole["mean"] or 0.0)
    seen = rows.select("y", F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("seen"), F.sum("y").alias("hits"))
    apart = F.abs(F.col("hits") - F.lit(mean) * F.col("seen")) >= F.lit(least_z) * F.sqrt(F.lit(mean * (1 - mean)) * F.col("seen") + F.lit(1e-12))
    test = (F.col("seen") >= least) & apart
    if always := sorted(set(always)):
        test |= F.col("id").isin(always)
    found = seen.filter(test).select("id").toPandas()["id"].to_numpy(np.int64)
    return np.sort(found), mean, n


def chosen_ids(rows: DataFrame, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all rows one after the other, their counts by row, targets), of the features `names` alone."""
    shared = rows.sparkSession.sparkContext.broadcast(names.astype(np.int32))

    def kept(batches):
        for batch in batches:
            lists = batch.column(0)
            flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
            use = np.isin(flat, shared.value)
            ends = np.cumsum(np.concatenate([[0], use]))[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[use], pa.int32())), batch.column(1)], ["ids", "y"])

    t = rows.mapInArrow(kept, "ids array<int>, y double").toArrow()
    shared.destroy()
    lists = t.column("ids").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int32()))
    return lists.flatten().to_numpy(), lists.value_lengths().to_numpy(), t.column("y").to_numpy()


Pairs = list[tuple[np.ndarray, np.ndarray]]


def descended(ids: np.ndarray, counts: np.ndarray, target: np.ndarray, names: np.ndarray, mean: float, l2: float = 2e-4, steps: int = 250, pairs: Pairs = (), pull: float = 1.0) -> np.ndarray:
    """Weights of a logistic model for the features `names`, and a bias behind them, by Adam over all rows.

    `target` may be posterior probabilities. `pairs` has two feature lists for a row and its counterfactual; the mean
    squared difference of their scores, times `pull`, is added to the loss. Features that are not in `names` weigh nothing.
    """
    n, k = len(counts), len(names)
    row = np.repeat(np.arange(n, dtype=np.int32), counts)
    col = np.searchsorted(names, ids).astype(np.int32)
    diff: Pairs = []
    for a, b in pairs:
        a, b = (np.searchsorted(names, x[np.isin(x, names)]) for x in (a, b))
        if len(a) + len(b):
            diff.append((np.concatenate([a, b]), np.concatenate([np.ones(len(a)), -np.ones(len(b))])))
    at = np.concatenate([d[0] for d in diff]) if diff else np.zeros(0, np.int64)
    sign = np.concatenate([d[1] for d in diff]) if diff else np.zeros(0)
    of = np.repeat(np.arange(len(diff)), [len(d[0]) for d in diff])
    w, bias = np.zeros(k), float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, steps + 1 if n else 1):
        z = np.bincount(row, w[col], minlength=n) + bias
        err = (sigmoid(z) - target) / n
        g = np.append(np.bincount(col, err[row], minlength=k) + l2 * w, err.sum())
        if diff:
            move = np.bincount(of, sign * w[at], minlength=len(diff))
            g[:k] += 2 * pull / len(diff) * np.bincount(at, sign * move[of], minlength=k)
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w -= step[:k]
        bias -= step[k]
    return np.append(w, bias)


def fit(rows: DataFrame, features: Callable[[str | None], tuple[Iterable[int], float]] | None = None, least: int = 3, least_z: float = 6.0, always: Iterable[int] = (), pairs: Callable[[np.ndarray, np.ndarray], Pairs] | None = None, **options) -> np.ndarray:
    """Weights (SIZE of them and the bias) learned from a bounded sample: `rows` has a text and, without `features`, a target.

    features(text) gives feature ids and a target. pairs(ids, counts) makes the counterfactual pairs of `descended`
    from the ids of the rows. What reaches the driver is bounded by the sample's rows and their features that count.
    """
    spark = rows.sparkSession

    def found(batches):
        for batch in batches:
            told = [(word_features(t), y) for t, y in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True)] if features is None else list(map(features, batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([sorted(ids) for ids, _ in told], pa.list_(pa.int32())), pa.array([float(y) for _, y in told], pa.float64())], ["ids", "y"])

    with scratch(spark) as tmp:
        sample = tmp.save(rows.mapInArrow(found, "ids array<int>, y double"), "sample")
        names, mean, _ = chosen_features(sample, least, least_z, always)
        ids, counts, target = chosen_ids(sample, names)
    w = descended(ids, counts, target, names, mean, pairs=pairs(ids, counts) if pairs else (), **options)
    out = np.zeros(SIZE + 1, np.float32)
    out[names], out[SIZE] = w[:-1], w[-1]
    return out


class Scorer:
    """Scores texts; remembers for each word which of its features weigh anything."""

    def __init__(self, weights: np.ndarray):
        self.w = weights
        self.words = Recent(lambda word: tuple(i for i in WORD_IDS[word] if weights[i]), 100_000)

    def __call__(self, lowered: str, more: Iterable[int] = ()) -> float:
        """The sum of the weights of all features of a lowered text, of those in `more`, and of the bias."""
        ids = set(more).union(*map(self.words.__getitem__, set(WORD.findall(lowered))))
        return float(self.w[np.fromiter(ids, np.int64, len(ids))].sum(dtype=np.float64)) + float(self.w[-1])


def scored(docs: DataFrame, weights: np.ndarray, text_col: str, columns: dict[str, T.DataType], row: Callable[[Scorer, str], tuple]) -> DataFrame:
    """`docs` with `columns`, whose values row(scorer, text) gives for each whole text; columns of these names are replaced.

    The weights are broadcast; they have a fixed size.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(*columns)
    names, at = docs.columns, docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kinds = [pa.bool_() if isinstance(k, T.BooleanType) else pa.float64() for k in columns.values()]

    def score(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            told = [row(scorer, t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([x[i] for x in told], kind) for i, kind in enumerate(kinds))], [*names, *columns])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in columns.items())]))
