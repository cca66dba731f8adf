"""Text quality from weak labels.

Overlapping heuristic labellers vote good (1), bad (0) or abstain (-1) on every document. The counts of all vote
patterns, a bounded number, reach the driver, where expectation-maximisation estimates each labeller's accuracy on
good and on bad documents and the share of good ones. The posterior labels of a bounded sample train a hashed
linear scorer, which scores all documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import linear
from .common import small_batches
from .pieces import Recent

#: Frequent words of four languages (fixed values).
STOP_WORDS = frozenset("the of and to in that is it for was a der die und den von zu das mit auf le la les et des de un une est que el los y en se del las por".split())
SYMBOLS = re.compile(r"[#$%&*@|<>{}\\^~=]")
ENDINGS = (".", "!", "?", ":", '"', "…", "。")


ASCII_UPPER = bytes(range(65, 91))
ASCII_LETTERS = ASCII_UPPER + bytes(range(97, 123))
OTHERS = re.compile(r"[^\x00-\x7f]+")


def letters_and_capitals(text: str) -> tuple[int, int]:
    raw = text.encode("utf-8", "replace")
    others = "" if len(raw) == len(text) else "".join(OTHERS.findall(text))
    return len(raw) - len(raw.translate(None, ASCII_LETTERS)) + sum(map(str.isalpha, others)), len(raw) - len(raw.translate(None, ASCII_UPPER)) + sum(map(str.isupper, others))


def votes(text: str | None, lowered: str | None = None) -> tuple[int, ...]:
    """The labellers' votes: 1 good, 0 bad, -1 none. Each looks at the whole text."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return (0, 0, -1, -1, 0, -1, -1, 0)
    lower = set((text.lower() if lowered is None else lowered).split())
    lines = [x for x in text.split("\n") if x.strip()]
    letters, upper = letters_and_capitals(text)
    odd = sum(1 for w in words if SYMBOLS.search(w) or w.endswith("!!")) / n if "!!" in text or SYMBOLS.search(text) else 0.0
    stops = len(STOP_WORDS.intersection(w.strip(".,;:!?") for w in lower))
    distinct = len(lower) / n
    mean = sum(map(len, words)) / n
    ended = sum(x.rstrip().endswith(ENDINGS) for x in lines) / max(1, len(lines))
    repeated = 1 - len(set(lines)) / max(1, len(lines))
    bars = text.count("|")
    vote = lambda good, bad: 1 if good else 0 if bad else -1
    return (
        vote(n >= 40, n < 8),
        vote(odd < 0.03, odd > 0.1),
        vote(letters and upper < 0.2 * letters, upper > 0.5 * max(1, letters)),
        vote(3 <= mean <= 9, mean < 2 or mean > 14),
        vote(stops >= 3, stops == 0 and n >= 8),
        vote(distinct > 0.35 or (n > 400 and distinct > 0.15), distinct < 0.12),
        vote(repeated < 0.1, repeated > 0.4),
        vote(ended > 0.6 and bars < 0.02 * n, ended < 0.15 or bars > 0.08 * n),
    )


LABELLERS = 8


def code(v: tuple[int, ...]) -> int:
    out = 0
    for x in v:
        out = out * 3 + x + 1
    return out


def decode(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes // 3**i % 3 - 1 for i in range(LABELLERS - 1, -1, -1)], 1) if len(codes) else np.zeros((0, LABELLERS), np.int64)


def em(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good for each pattern, rates, share of good). rates[c, l, v + 1]: how often labeller l votes v on class c."""
    if not len(counts):
        return np.zeros(0), np.full((2, LABELLERS, 3), 1 / 3), 0.5
    cast = patterns >= 0
    post = (0.5 + (patterns == 1).sum(1)) / (1.0 + cast.sum(1))
    post = np.clip(post, 0.02, 0.98)
    rates, share = np.zeros((2, LABELLERS, 3)), 0.5
    for _ in range(steps):
        share = float((post * counts).sum() / counts.sum())
        share = min(max(share, 0.01), 0.99)
        for c, p in ((1, post), (0, 1 - post)):
            for v in (-1, 0, 1):
                rates[c, :, v + 1] = ((patterns == v) * (p * counts)[:, None]).sum(0) + 0.5
        rates /= rates.sum(2, keepdims=True)
        log = [np.log(rates[c][np.arange(LABELLERS), patterns + 1]).sum(1) for c in (0, 1)]
        new = linear.sigmoid(np.log(share) + log[1] - np.log(1 - share) - log[0])
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return post, rates, share


SHAPES = Recent(lambda shape: tuple(linear.feature(f"shape {s}") for s in [*(f"vote {i} {v}" for i, v in enumerate(shape[0])), f"words {shape[1]}"]), 100_000)


def shapes(text: str, cast: tuple[int, ...]) -> tuple[int, ...]:
    """Features of the votes and of the number of words."""
    return SHAPES[cast, len(text.split()).bit_length()]


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 10_000, least_score: float = 0.5) -> DataFrame:
    """`docs` with posterior (of the votes), score (of the linear scorer, 0 to 1) and kept (score >= `least_score`).

    Vote patterns are counted over all documents; the scorer is fitted on the `most` documents with the least id hashes
    (of several rows with one id on the one with the least text; rows with a null id are counted and scored, but never
    fitted on). Null texts count as empty and get bad votes. Repeated rows get equal values. Columns of the three names
    are replaced. An empty table stays empty.
    """
    spark = docs.sparkSession
    small_batches(spark)

    def coded(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([code(votes(t)) for t in batch.column(0).to_pylist()], pa.int32())], ["code"])

    found = docs.select(F.col(text_col)).mapInArrow(coded, "code int").groupBy("code").agg(F.count("*").alias("n")).toPandas()  # 3 ** LABELLERS rows at most
    codes, n = found["code"].to_numpy(np.int64), found["n"].to_numpy(float)
    post, _, _ = em(decode(codes), n)
    table = np.full(3**LABELLERS, 0.5)
    table[codes] = post
    posteriors = spark.sparkContext.broadcast(table)

    def learned(text: str | None) -> tuple[set[int], float]:
        text = text or ""
        cast = votes(text)
        return linear.word_features(text).union(shapes(text, cast)), posteriors.value[code(cast)]

    def told(scorer: linear.Scorer, text: str) -> tuple[float, float, bool]:
        lowered = text.lower()
        cast = votes(text, lowered)
        score = float(linear.sigmoid(scorer(lowered, shapes(text, cast))))
        return float(posteriors.value[code(cast)]), score, score >= least_score

    ids = docs.select(F.col(text_col).alias("t"), F.col(id_col).cast("string").alias("id"))
    chosen = linear.sampled(ids.select("id").filter("id is not null").distinct(), "id", most)
    sample = ids.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("t").alias("t"))  # `most` rows, and their ids as text
    weights = linear.fit(sample.select("t"), learned, steps=100)
    return linear.scored(docs, weights, text_col, {"posterior": T.DoubleType(), "score": T.DoubleType(), "kept": T.BooleanType()}, told)
