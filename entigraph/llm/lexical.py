"""Ranked lexical search: compressed postings in shards of documents, merged document by document.

Every task turns its documents into shards of their own, so that indexing moves nothing: a term's postings (gaps of the
documents' places in the order of their ids, and counts) are one row of variable-length integers. A search brings the
rows of its terms together by shard and merges, for each item, the cursors of its terms by a heap: the least document
is taken from all lists that stand on it, scored and offered to a bounded heap of results, keyed by score and id. Lists
whose best scores together cannot reach the heap's least result leave the merge and are only looked up for documents
that the others find, which loses none. A window over what the shards' tasks have found gives each item's ranks.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_table, scratch, small_batches

#: Terms are stretches of ASCII letters and digits and of all other characters; only A-Z are lower-cased.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Tokens of a shard, items of a block of queries, and bytes of a table of terms that may be broadcast.
SHARD_TOKENS, BLOCK_ITEMS, BROADCAST_BYTES = 2_000_000, 1024, 8 << 20
INDEX = "shard long, term string, df long, documents long, tokens long, data binary"


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLDED).split() if text else []


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers in as many groups of 7 bits as each needs: the bytes, and each one's size."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 10):
        sizes += values >> np.uint64(7 * k) > 0
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        at = np.flatnonzero(sizes > k)
        more = np.where(sizes[at] > k + 1, 128, 0)
        out[starts[at] + k] = (values[at] >> np.uint64(7 * k) & np.uint64(127)).astype(np.int64) | more
    return out, sizes


def from_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(raw < 128)[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, np.diff([*starts, len(raw)]))
    return np.add.reduceat((raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64), starts).astype(np.int64)


class Codes(dict):
    """term -> its number, by first appearance."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


class ShardBuilder:
    """Gathers documents (id, terms) up to a bound on their terms and gives the rows of their shard."""

    def __init__(self):
        self.codes = Codes()
        self.ids: list[int | None] = []
        self.parts: list[np.ndarray] = []
        self.tokens = 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        self.ids.append(doc_id)
        self.parts.append(np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words)))
        self.tokens += len(words)

    def rows(self, shard: int) -> pa.RecordBatch:
        """Row of no term: the ids' gaps after the first, and the documents' lengths. Documents of a null id count, but have no postings."""
        lengths = np.array([len(p) for p in self.parts], np.int64)
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        named = sum(i is not None for i in self.ids)
        key = np.concatenate(self.parts).astype(np.int64) * len(order) + np.repeat(place, lengths)
        key, tf = np.unique(key, return_counts=True)
        code, doc = np.divmod(key, len(order))
        n_terms = len(self.codes)
        df = np.bincount(code, minlength=n_terms)
        own = doc < named
        code, doc, tf = code[own], doc[own], tf[own]
        fresh = np.diff(code, prepend=-1) != 0
        gaps = np.where(fresh, doc, np.diff(doc, prepend=0))
        data, sizes = varints(np.stack([gaps, tf], 1).ravel())
        per_term = np.bincount(np.repeat(code, 2), weights=sizes, minlength=n_terms).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(per_term)]).astype(np.int32)
        ids = np.array([self.ids[i] for i in order[:named]], np.int64)
        header = (ids[:1].tobytes() + varints(np.concatenate([np.diff(ids).view(np.uint64), lengths[order[:named]].astype(np.uint64)]))[0].tobytes()) if named else b""
        lists = pa.Array.from_buffers(pa.binary(), n_terms, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        blank = [None] * n_terms
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n_terms + 1, shard)), pa.array([None, *[t.decode() for t in self.codes]], pa.string()), pa.array(np.concatenate([[0], df])),
                pa.array([len(order), *blank], pa.int64()), pa.array([self.tokens, *blank], pa.int64()), pa.concat_arrays([pa.array([header], pa.binary()), lists]),
            ],
            names=["shard", "term", "df", "documents", "tokens", "data"],
        )


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Shards of the documents: (shard, term, df, documents, tokens, data), see ShardBuilder.rows.

    Texts without terms, null ones too, are left out. Rows are documents of their own, even if they share an id; those
    without an id count and are never found. A shard holds `shard_tokens` terms at most, or one document.
    """
    small_batches(docs.sparkSession)

    def shards(batches):
        base, done, now = TaskContext.get().partitionId() << 24, 0, ShardBuilder()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not (words := terms(text)):
                    continue
                if now.ids and now.tokens + len(words) > shard_tokens:
                    yield now.rows(base + done)
                    done, now = done + 1, ShardBuilder()
                now.add(doc_id, words)
        if now.ids:
            yield now.rows(base + done)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(shards, INDEX)


class Postings:
    """A term's list in a shard, with what each posting adds to a score."""

    def __init__(self, data: bytes, weight: int, norms: np.ndarray, k: int):
        values = from_varints(data).reshape(-1, 2)
        places, tf = np.cumsum(values[:, 0]), values[:, 1]
        adds = weight * (1_000_000_000 * tf // (1000 * tf + 20 * norms[places]))
        self.places, self.adds = places.tolist(), adds.tolist()
        self.best = int(adds.max())
        self.sure = int(np.partition(adds, len(adds) - k)[len(adds) - k]) if len(adds) >= k else 0  # k documents score as much

    def at(self, place: int) -> int:
        i = bisect_left(self.places, place)
        return self.adds[i] if i < len(self.places) and self.places[i] == place else 0


def merge_documents(lists: list[Postings], ids: list[int], k: int, found: list[tuple[int, int]]) -> None:
    """Offers the documents that any list holds to `found`, a heap of at most k (score, -id), by merging all lists."""
    lists = sorted(lists, key=lambda x: x.best)
    bits = len(lists).bit_length()
    mask = (1 << bits) - 1
    floor = max(x.sure for x in lists)
    least = max(floor, found[0][0] if len(found) == k else 1)
    aside, rest = 0, 0  # lists[:aside] together give `rest` at most, which is below `least`
    while aside < len(lists) and rest + lists[aside].best < least:
        rest += lists[aside].best
        aside += 1
    at = [0] * len(lists)
    heads = [x.places[0] << bits | j for j, x in enumerate(lists) if j >= aside]
    heapq.heapify(heads)
    while heads:
        place, score = heads[0] >> bits, 0
        while heads and heads[0] >> bits == place:
            j = heads[0] & mask
            own, i = lists[j], at[j]
            score += own.adds[i]
            at[j] = i = i + 1
            if i < len(own.places):
                heapq.heapreplace(heads, own.places[i] << bits | j)
            else:
                heapq.heappop(heads)
        could = score + rest
        for j in range(aside - 1, -1, -1):
            if could < least:
                break
            could -= lists[j].best
            if add := lists[j].at(place):
                score += add
                could += add
        if could < least or score <= 0:
            continue
        entry = (score, -ids[place])
        if len(found) < k:
            heapq.heappush(found, entry)
        elif entry > found[0]:
            heapq.heapreplace(found, entry)
        if len(found) == k and found[0][0] > least:
            least, was = found[0][0], aside
            while aside < len(lists) and rest + lists[aside].best < least:
                rest += lists[aside].best
                aside += 1
            if aside > was:
                heads = [h for h in heads if h & mask >= aside]
                heapq.heapify(heads)


def query_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term), once each."""

    def split(batches):
        for batch in batches:
            pairs = [(i, t.decode()) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for t in dict.fromkeys(terms(text))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.string())], ["item", "term"])

    return items.select(F.col(item_col).cast("long"), F.col(text_col)).mapInArrow(split, "item long, term string").distinct()


def if_small(df: DataFrame, size: int) -> DataFrame:
    """A side of a join: broadcast if its size was found to be within the bound, else as Spark decides."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def search(index: DataFrame, items: DataFrame, k: int = 50, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's k best documents with a score above 0; ties by ascending doc_id.

    `index` is a written table of build_index. Rows that share an item id, null too, are one item of all their terms; items
    without terms, or whose terms no document holds, have no rows. An index of no shards gives none.
    """
    spark = index.sparkSession
    with scratch(spark) as tmp:
        asked = tmp.save(query_terms(items, item_col, text_col), "asked")
        size, n_items = asked.agg(F.sum(F.octet_length("term") + 24), F.count_distinct(F.coalesce("item", F.lit(-1)))).first()
        total = index.filter("term is null").agg(F.sum("documents").alias("n"), F.sum("tokens").alias("l")).first()
        blocks = max(1, -(-(n_items or 0) // BLOCK_ITEMS))
        n, length = total["n"] or 0, total["l"] or 1
        df = index.filter("term is not null").select("term", "df").join(if_small(asked.select("term").distinct(), size or 0), "term").groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.floor(1000 * F.log((2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long")
        by_term = asked.groupBy("term", F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("item")).alias("items"))
        wanted = tmp.save(by_term.join(df, "term").select("term", "block", "items", weight.alias("weight")), "wanted")
        lists = index.filter("term is not null").select("shard", "term", "data").join(if_small(wanted, size or 0), "term")
        heads = index.filter("term is null").select("shard", F.lit(None).cast("string").alias("term"), "data", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
        heads = heads.select("shard", "term", "data", "block", F.lit(None).cast("array<struct<item:bigint>>").alias("items"), F.lit(None).cast("long").alias("weight"))
        rows = lists.select("shard", "term", "data", "block", "items", "weight").union(heads)
        dealt = rows.repartition("block", "shard").sortWithinPartitions("block", "shard", F.col("term").asc_nulls_first())

        def merged(batches):
            now, found, lists, norms, ids = (None, None), {}, {}, np.zeros(0, np.int64), []

            def evaluate() -> None:
                for item, own in lists.items():
                    merge_documents(own, ids, k, found.setdefault(item, []))
                lists.clear()

            def results() -> Iterator[pa.RecordBatch]:
                flat = [(item, -doc, score) for item, heap in found.items() for score, doc in heap]
                found.clear()
                if flat:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in flat], pa.int64()) for c in range(3)], ["item", "doc", "score"])

            for batch in batches:
                for r in batch.to_pylist():
                    if (r["block"], r["shard"]) != now:
                        evaluate()
                        if r["block"] != now[0]:
                            yield from results()
                        now = (r["block"], r["shard"])
                    if r["term"] is None:
                        raw = from_varints(r["data"][8:])
                        n_docs = (len(raw) + 1) // 2 if r["data"] else 0
                        ids = (np.frombuffer(r["data"][:8], np.int64) + np.concatenate([[0], np.cumsum(raw[: n_docs - 1])]).astype(np.int64)).tolist() if n_docs else []
                        norms = np.array([50 + 50 * size * n // length for size in raw[max(n_docs - 1, 0) :].tolist()], np.int64)
                    elif r["data"]:
                        own = Postings(r["data"], r["weight"], norms, k)
                        for item in r["items"]:
                            lists.setdefault(item["item"], []).append(own)
            evaluate()
            yield from results()

        best = dealt.mapInArrow(merged, "item long, doc long, score long")
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc"))
        top = best.withColumn("rank", place).filter(F.col("rank") <= k)
        return kept_table(top.select(F.col("item").alias(item_col), "rank", F.col("doc").alias("doc_id"), "score"))


def ranked(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """search() over an index that is built for it."""
    with scratch(docs.sparkSession) as tmp:
        return search(tmp.save(build_index(docs), "index"), items, k)
