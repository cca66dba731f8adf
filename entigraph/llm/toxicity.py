"""Toxicity scores by a counterfactually regularised linear classifier.

Words and their first letters are hashed features of a logistic model. For each labelled text with terms that
name groups of people, a counterfactual is made in which every such term is replaced by another of its set; the
squared difference of the two scores is part of the loss. So a group that toxic texts name more often than others
does not by that alone make a text toxic.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import linear

#: Terms that name groups, by set; within a set they stand for each other.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african"),
    ("gay", "lesbian", "bisexual", "straight", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("frauen", "männer"),
    ("muslime", "juden", "christen"),
    ("femmes", "hommes"),
    ("musulmans", "juifs", "chrétiens"),
    ("mujeres", "hombres"),
    ("musulmanes", "judíos", "cristianos"),
)
Terms = tuple[tuple[str, ...], ...]


def successors(terms: Terms) -> dict[str, str]:
    """What each term is replaced by: the next one of its set."""
    return {w: group[(i + 1) % len(group)] for group in terms for i, w in enumerate(group)}


def counterfactuals(ids: np.ndarray, counts: np.ndarray, terms: Terms = IDENTITY_TERMS) -> linear.Pairs:
    """For each row with identity terms, the features of these terms and those of what replaces them."""
    own = {w: linear.WORD_IDS[w] for group in terms for w in group}
    swaps = {own[w][0]: (own[w], own[to]) for w, to in successors(terms).items()}
    hit = np.flatnonzero(np.isin(ids, np.array(list(swaps), np.int64)))
    row = np.repeat(np.arange(len(counts)), counts)[hit]
    out = []
    for part in np.split(hit, np.flatnonzero(np.diff(row)) + 1) if len(hit) else []:
        found = [swaps[int(ids[j])] for j in part]
        out.append((np.array([i for a, _ in found for i in a]), np.array([i for _, b in found for i in b])))
    return out


def held_out(id_col: str):
    """Whether a document is never learned from: crc32 of its id as text leaves 2 modulo 4 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = 20_000, terms: Terms = IDENTITY_TERMS, pull: float = 4.0, **options) -> np.ndarray:
    """Weights learned from at most `most` labelled documents (those of the least id hashes) that are not held out.

    Null labels and ids are left out; of several labels of a document the largest counts, of several rows with one id
    the one with the least text. Without any labelled row the model scores everything alike. Inputs are the words of
    the whole texts alone. `terms` are the identity terms, to be given for a corpus that names other groups; they
    get weights however rare or telling they are, and `pull` weighs the mean squared change of a labelled
    text's score when its terms are swapped (0: no counterfactuals).
    """
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(~held_out(id_col))
    marked = linear.sampled(marked.groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("y")), "__id", most)
    rows = docs.select(F.col(text_col).alias("t"), F.col(id_col).cast("long").alias("__id")).join(F.broadcast(marked), "__id")  # `most` rows of 12 bytes
    rows = rows.groupBy("__id").agg(F.min("t").alias("t"), F.max("y").alias("y")).select("t", "y")
    always = {linear.WORD_IDS[w][0] for group in terms for w in group}
    return linear.fit(rows, always=always, pairs=lambda ids, counts: counterfactuals(ids, counts, terms), pull=pull, **options)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """`docs` with `score` from 0 to 1 (a column of this name is replaced); null and empty texts get the bias alone.

    Each row is scored by itself: repeated rows and null ids get the score of their text.
    """
    return linear.scored(docs, weights, text_col, {"score": T.DoubleType()}, lambda scorer, text: (float(linear.sigmoid(scorer(text.lower()))),))
