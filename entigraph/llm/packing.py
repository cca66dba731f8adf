"""Packing of documents into sequences of a fixed number of tokens.

The lengths of all pieces are counted into a histogram (at most `capacity` numbers). Patterns of two or three
lengths that fill a sequence are enumerated over the lengths that occur, their repeat counts are fitted to the
histogram by non-negative least squares and rounded down, and what is left is packed best fit, longest first, in
terms of counts: bins of equal free space are one group, so that a step costs as much for a billion pieces as
for one. Then each piece finds its place from its length and its rank among the pieces of that length alone.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_dir, small_batches
from .pieces import Recent

END_ID = 1


#: Words of these characters alone are lowered and split here; all others go through the whole tokenizer.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: The split pattern of the tokenizer for such words (fixed values).
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """Characters up to U+00FF as the letters that byte-level BPE writes for their UTF-8 bytes: printable bytes
    stand for themselves, the others follow from U+0100 on in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}


class WordTokenizer:
    """Ids of a text by a lower-casing byte-level BPE tokenizer whose words never cross white space: words and their
    parts are encoded once and remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.parts = Recent(self._part, 250_000)
        self.words = Recent(self._word, 250_000)

    def encode(self, text: str | None) -> bytes:
        """All ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.words.__getitem__, (text or "").encode().split()))  # at space and \t to \r

    def _word(self, raw: bytes) -> bytes:
        word = raw.decode()
        if PLAIN.fullmatch(word) and "<|" not in word:
            word = word.lower()
            return self.parts[word] if word.isalpha() else b"".join(map(self.parts.__getitem__, SPLIT.findall(word)))
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize(part if part.isascii() else part.translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_pieces(docs: DataFrame, path: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and task and rank (its place among the task's pieces of its length).

    A document's ids are its tokens and END_ID; longer ones are cut every `capacity` ids. With `with_ids` the
    column ids holds the ids as little-endian unsigned 32-bit integers.
    """
    small_batches(docs.sparkSession)
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches):
        t, task, seen = tokenizer(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            doc, piece, start, length, crc, rank, kept = [], [], [], [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = t.encode(text) + end
                for p, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    n = len(part) // 4
                    doc.append(i)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    rank.append(seen[n])
                    seen[n] += 1
                    if with_ids:
                        kept.append(part)
            cols = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(doc), pa.int32()), pa.array(rank, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
            if with_ids:
                cols, names = [*cols, pa.array(kept, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, schema)


def patterns(lengths: np.ndarray, capacity: int, most: int = 6000) -> list[tuple[int, ...]]:
    """Pairs and triples of occurring lengths that fill a sequence, longest first; `most` of them at most, evenly spread."""
    have = set(lengths.tolist())
    pairs = [(a, capacity - a) for a in range(capacity - 1, capacity // 2 - 1, -1) if a in have and capacity - a in have]
    long = [a for a in range(capacity - 2, capacity // 3 - 1, -1) if a in have]
    triples = [(a, b, capacity - a - b) for a in long for b in range(min(a, capacity - a - 1), (capacity - a + 1) // 2 - 1, -97) if b in have and capacity - a - b in have]
    step = max(1, -(-len(triples) // max(1, most - len(pairs))))
    return pairs + triples[::step]


def fitted(counts: np.ndarray, found: list[tuple[int, ...]], steps: int = 200) -> np.ndarray:
    """Repeat counts (real, at least 0) of the patterns, nearest to the histogram in least squares, by projected gradients."""
    if not found:
        return np.zeros(0)
    row = np.repeat(np.arange(len(found)), [len(p) for p in found])
    col = np.array([a for p in found for a in p])
    x, target = np.zeros(len(found)), counts.astype(float)
    use = np.bincount(col, minlength=len(counts))
    rate = 1.0 / max(1.0, 3.0 * use.max())  # no larger than the inverse of the largest curvature
    rate = np.maximum(rate, 1.0 / (3.0 * np.array([use[list(p)].max() for p in found])))  # each by its own columns
    y, t = x, 1.0
    for _ in range(steps):
        gap = target - np.bincount(col, y[row], minlength=len(counts))
        new = np.maximum(0.0, y + rate * np.bincount(row, gap[col], minlength=len(found)))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


class Plan:
    """Where the pieces go. A row (length, first, bins, each, sequence, offset): the pieces of this length with ranks from
    `first` on fill `bins` sequences from `sequence` on, `each` of them to a sequence, side by side from `offset` on."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.rows, self.sequences = capacity, [], 0
        self.left = np.zeros(capacity + 1, np.int64)
        for n, c in histogram.items():
            self.left[n] = c
        self.used = np.zeros(capacity + 1, np.int64)
        full = int(self.left[capacity])
        self._put(capacity, self._open(full), full, 1, 0)
        found = patterns(np.flatnonzero(self.left), capacity)
        for p, want in zip(found, np.floor(fitted(self.left, found) + 1e-9).astype(np.int64), strict=True):
            sizes, each = np.unique(p, return_counts=True)
            n = int(min(want, *(self.left[sizes] // each)))
            if n > 0:
                at, first = 0, self._open(n)
                for size, k in zip(sizes.tolist()[::-1], each.tolist()[::-1], strict=True):
                    self._put(size, first, n, k, at)
                    at += size * k
        self._best_fit()

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _put(self, size: int, first: int, bins: int, each: int, at: int) -> None:
        if bins:
            self.rows.append((size, int(self.used[size]), bins, each, first, at))
            self.used[size] += bins * each
            self.left[size] -= bins * each

    def _best_fit(self) -> None:
        groups: list[tuple[int, int, int]] = []  # (free, first sequence, sequences), ascending
        for size in range(self.capacity, 0, -1):
            while (n := int(self.left[size])) > 0:
                at = bisect_left(groups, (size,))
                if at == len(groups):
                    each = self.capacity // size
                    bins, rest = divmod(n, each)
                    if not bins:
                        bins, each = 1, rest
                    groups.append((self.capacity, self._open(bins), bins))
                    at = len(groups) - 1
                free, first, have = groups.pop(at)
                each = free // size
                bins = min(have, n // each)
                if not bins:
                    bins, each = 1, n
                self._put(size, first, bins, each, self.capacity - free)
                if free - size * each:
                    insort(groups, (free - size * each, first, bins))
                if have > bins:
                    insort(groups, (free, first + bins, have - bins))

    def table(self) -> np.ndarray:
        return np.array(sorted(self.rows), np.int64).reshape(-1, 6)


def place(plan: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces, by their length and their rank among all pieces of that length."""
    key = lambda n, r: n.astype(np.int64) * (1 << 48) + r
    row = plan[np.searchsorted(key(plan[:, 0], plan[:, 1]), key(length, rank), side="right") - 1]
    inner = rank - row[:, 1]
    return row[:, 4] + inner // row[:, 3], row[:, 5] + inner % row[:, 3] * row[:, 0]


def pack(docs: DataFrame, path: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs all documents into sequences of at most `capacity` ids; one row per piece.

    Columns: doc_id, piece (from 0), start (ids of the document before it), length, ids_crc32, sequence_id, offset.
    A null text counts as empty (END_ID alone); rows with a null or repeated id are packed like any other. An empty
    table gives no rows. The histogram and the plan that reach the driver have sizes that depend on `capacity`
    alone; ranks come from counts by task and length, so no length is gathered in one task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared_dir(spark)
    pieces = token_pieces(docs, path, capacity, id_col, text_col).checkpoint()
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n")).checkpoint()
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    plan = spark.sparkContext.broadcast(Plan(total, capacity).table())
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(starts, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("rank")).alias("rank"))

    def placed(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            sequence, offset = place(plan.value, length, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(docs: DataFrame, path: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array of int), doc_ids (array of long, by offset). Needs unique ids."""
    placed = pack(docs, path, capacity, id_col, text_col).select("doc_id", "piece", "sequence_id", "offset")
    parts = token_pieces(docs, path, capacity, id_col, text_col, with_ids=True).select("doc_id", "piece", "ids").join(placed, ["doc_id", "piece"])

    def joined(batches):
        for batch in batches:
            ids = [np.frombuffer(b"".join(x["ids"] for x in sorted(row, key=lambda x: x["offset"])), "<u4") for row in batch.column(1).to_pylist()]
            docs_ = [[x["doc_id"] for x in sorted(row, key=lambda x: x["offset"])] for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(docs_, pa.list_(pa.int64()))], ["sequence_id", "ids", "doc_ids"])

    return parts.groupBy("sequence_id").agg(F.collect_list(F.struct("offset", "doc_id", "ids")).alias("parts")).mapInArrow(joined, "sequence_id long, ids array<int>, doc_ids array<long>")
