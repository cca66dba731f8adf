"""Corpus preparation: stages over documents, each written and read again. Counted as part of entigraph.llm.

A stage's decisions hold for whole rows: rows with a null id pass every stage but the texts' own (a toxic one goes),
rows that share an id are one document to line, near-copy and substring dedup, repeated rows fare alike, and an empty
table gives an empty one. Null and empty texts are never toxic by more than the bias of the model, share no lines, have no
copies and lose nothing. Columns of documents come back as they were, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entigraph.llm import lines, neardup, packing, substrings, toxicity
from entigraph.llm.common import remove, shared_dir, table
from entigraph.llm.queries import tokenizer_file


def set_aside(docs: DataFrame, *made: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with columns renamed that have a name an operator makes, and what selects the columns of `docs` again."""
    held = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in made}
    return docs.withColumnsRenamed(held), lambda out: out.select(*[F.col(held.get(c, c)).alias(c) for c in docs.columns])


def counted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """n_chars, if there is such a column, counts the code points of the new text."""
    kinds = dict(like.dtypes)
    return docs.withColumn("n_chars", F.length("text").cast(kinds["n_chars"])) if "n_chars" in kinds else docs


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of 0.3 or more; learned from the rows that op3's contract allows.

    Rows are scored one by one, so null ids and repeated rows make no difference; a null or empty text has the score of
    the model's bias.
    """
    rows, back = set_aside(docs, "score")
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return back(toxicity.score(rows, weights).filter("score < 0.3"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines of 40 characters or more that five documents share, but for the last one's. No document goes.

    Rows with a null id or text stay as they are; rows that share an id count as one document.
    """
    rows, back = set_aside(docs, "n_lines", "n_dropped")
    return back(counted(lines.drop_repeated_lines(rows), docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies (five words a shingle, similarity 0.8).

    Rows with a null id, and texts without words, stay. Rows that share an id share a group: they stay or go together.
    """
    gone = neardup.near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs["doc_id"].cast("long") == F.col("__gone"), "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 20 words or more that start earlier in the corpus; documents without such keep their text.

    Of texts that lose words the rest is joined by single spaces. Rows with a null id keep theirs.
    """
    rows, back = set_aside(docs, "n_words", "n_removed")
    out = substrings.drop_repeats(rows.withColumn("__was", F.col("text")))
    return back(counted(out.withColumn("text", F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("__was"))), docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, null and empty ones too, with their places in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_filter),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packed),
]

#: SQL can express neither a trained classifier nor a tokenizer; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written as Parquet in the shared folder and read again.

    A stage's table is deleted when the next one is written. The last one stays: the result reads it.
    """
    root = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path := f"{root}/{k}")
        docs = spark.read.schema(out.schema).parquet(path)
        if k:
            remove(spark, f"{root}/{k - 1}")
    return docs
