"""Substring dedup by suffix automata.

A passage of `width` words or more that occurs twice shares, in each of its windows, the same least hashed gram
(its anchor), so only the surroundings of anchors that occur twice are looked at. These are grouped by anchor into
reference shards; each shard's suffix automaton is built as its surroundings stream by in the order of (document,
place), and gives their matching statistics against all that came before: where the longest match is at least
`width` words long, the state tells where its last `width` words began first. Equal surroundings are combined
before they are sent, and anchors met more than `hot` times send single windows, dealt by the window's own hash,
so no shard grows with a passage's frequency. Repeats are told by the words themselves; only documents that are copies of
an earlier one as a whole are known by their SHA-256 and go without an automaton.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, gram_hashes, scratch, small_batches, word_hashes

GRAM = 8
ROWS, TOGETHER = 20_000, 100_000  # of a batch; words looked at together


def _running(x: np.ndarray, n: int, least: bool) -> np.ndarray:
    """Least (or greatest) of each n values in a row, by ever wider strides."""
    take = np.minimum if least else np.maximum
    have = 1
    while have < n:
        step = min(have, n - have)
        x = take(x[: len(x) - step], x[step:])
        have += step
    return x


def anchors(h: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places, and hashes there, of the grams that are the least of some window of `width` words of one document.

    `h` has the word hashes of several documents, one after the other, `doc` tells which.
    """
    gram = min(GRAM, width)
    span = width - gram + 1
    if len(h) < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    g = gram_hashes(h, gram)
    least = _running(g, span, True)
    least[doc[: len(least)] != doc[width - 1 :]] = 0  # windows of two documents
    edge = np.zeros(span - 1, np.uint64)
    at = np.flatnonzero((_running(np.concatenate([edge, least, edge]), span, False) == g) & (g > 0))
    return at, g[at]


class SuffixAutomaton:
    """Suffix automaton of several word sequences; each state knows where its strings ended first."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.end = [-1], [0], [(-1, -1)]
        self.last = 0

    def _state(self, size: int, moves: dict[int, int], link: int, end: tuple[int, int]) -> int:
        self.next.append(moves)
        self.size.append(size)
        self.link.append(link)
        self.end.append(end)
        return len(self.size) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for those strings of q that are one longer than p's."""
        twin = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q], self.end[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        self.link[q] = twin
        return twin

    def begin(self) -> None:
        self.last = 0

    def extend(self, c: int, end: tuple[int, int]) -> None:
        p = self.last
        q = self.next[p].get(c)
        if q is not None:
            self.last = q if self.size[q] == self.size[p] + 1 else self._split(p, c, q)
            return
        new = self.last = self._state(self.size[p] + 1, {}, 0, end)
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, c, q)

    def first_ends(self, words: list[int], width: int) -> list[tuple[int, int] | None]:
        """For each place, where the last `width` words ended first, or None if they never occurred."""
        follow, link, size = self.next, self.link, self.size
        state = matched = 0
        out: list[tuple[int, int] | None] = []
        for c in words:
            while state and c not in follow[state]:
                state = link[state]
                matched = size[state]
            if c in follow[state]:
                state = follow[state][c]
                matched += 1
            if matched >= width:
                while size[link[state]] >= width:
                    state = link[state]
                    matched = size[state]
                out.append(self.end[state])
            else:
                out.append(None)
        return out


def unseen(rows: list[tuple[int, int, list[bytes]]], width: int) -> list[int]:
    """For sequences (document, start, words) in this order, the windows of each (as bits from its start) that began nowhere earlier."""
    automaton, last = SuffixAutomaton(), len(rows) - 1
    out = []
    for at, (doc, start, words) in enumerate(rows):
        mask = (1 << (len(words) - width + 1)) - 1
        if at:
            for i, e in enumerate(automaton.first_ends(words, width)[width - 1 :]):
                if e is not None and e < (doc, start + i + width - 1):
                    mask ^= 1 << i
        out.append(mask)
        if mask and at < last:  # else all its windows are in the automaton, or nobody asks it any more
            automaton.begin()
            for i, c in enumerate(words):
                automaton.extend(c, (doc, start + i))
    return out


def repeated_spans(texts: DataFrame, width: int = 20, hot: int = 5000) -> DataFrame:
    """(id, spans): for documents (id: long, each one once; t: binary) with repeats, the word ranges [a, b) to remove, in order."""
    spark = texts.sparkSession
    gram = min(GRAM, width)
    before = width - gram

    def find(batches):
        for batch in batches:
            texts, ids = batch.column(1).to_pylist(), batch.column(0).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(texts):
                words: list[bytes] = []
                sizes: list[int] = []
                while at + len(sizes) < len(texts) and len(words) < TOGETHER:
                    own = (texts[at + len(sizes)] or b"").split()
                    sizes.append(len(own))
                    words += own
                size = np.array(sizes, np.int64)
                doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
                place, h = anchors(word_hashes(words), doc, width)
                of = doc[place]
                start = np.cumsum(size) - size
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[at : at + len(size)][of], pa.int64()), pa.array((place - start[of]).astype(np.int32)), pa.array(size[of].astype(np.int32))], ["h", "id", "at", "total"])
                at += len(size)

    def surroundings(batches):
        for batch in batches:
            keys, seqs, ids, starts, wides = [], [], [], [], []
            for i, t, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = t.split()
                n, sent = len(words), set()
                wide = None
                for x in places:  # by place
                    p = x["at"]
                    if x["often"]:
                        if wide is None:
                            wide = gram_hashes(word_hashes(words), width).view(np.int64)
                        units = [(int(wide[s]), s, s + width) for s in range(max(0, p - before), min(p, n - width) + 1)]
                    else:
                        units = [(x["h"], max(0, p - before), min(n, p + width))]
                    for key, a, b in units:
                        seq = b" ".join(words[a:b])
                        if (key, seq) not in sent:  # later ones of a document repeat its first
                            sent.add((key, seq))
                            keys.append(key)
                            seqs.append(seq)
                            ids.append(i)
                            starts.append(a)
                            wides.append(x["often"])
                if len(keys) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(seqs, pa.binary()), pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(wides, pa.bool_())], ["key", "seq", "id", "start", "often"])
                    keys, seqs, ids, starts, wides = [], [], [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(seqs, pa.binary()), pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(wides, pa.bool_())], ["key", "seq", "id", "start", "often"])

    def matched(batches):
        run: list[tuple[int, int, list[bytes]]] = []
        out: list[tuple] = []
        last = often = None

        def end_run():
            """The surroundings of a key meet in one automaton: equal windows have equal keys."""
            run.sort(key=lambda r: r[:2])
            for (i, start, words), mask in zip(run, unseen(run, width), strict=True):
                out.append((i, start, len(words), mask.to_bytes(-(-(len(words) - width + 1) // 8), "little"), last, often))
            run.clear()

        def flush():
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.bool_()]
            batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["id", "start", "size", "mask", "key", "often"])
            out.clear()
            return batch

        for batch in batches:  # ordered by key and kind
            for key, seq, i, start, kind in zip(*(batch.column(j).to_pylist() for j in range(5)), strict=True):
                if (key, kind) != (last, often):
                    end_run()
                    if len(out) >= ROWS:
                        yield flush()
                    last, often = key, kind
                run.append((i, start, seq.split()))
        end_run()
        if out:
            yield flush()

    def ranges(batches):
        for batch in batches:
            out = []
            for places, total, masks in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                first = {(None if m["often"] else m["key"], m["start"], m["size"]): m["mask"] for m in masks or []}
                gone: list[tuple[int, int]] = []
                for x in places:
                    p = x["at"]
                    lo, hi = max(0, p - before), min(p, total - width)
                    units = [(s, width) for s in range(lo, hi + 1)] if x["often"] else [(lo, min(total, p + width) - lo)]
                    for a, size in units:
                        mask = int.from_bytes(first.get((None if x["often"] else x["h"], a, size), b""), "little")  # none: another document or place has it first
                        if not mask:
                            gone.append((a, a + size))
                        elif mask + 1 != 1 << (size - width + 1):
                            gone += [(a + j, a + j + width) for j in range(size - width + 1) if not mask >> j & 1]
                spans: list[list[int]] = []
                for a, b in sorted(gone):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                out.append([{"a": a, "b": b} for a, b in spans])
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["id", "spans"])

    with scratch(spark) as tmp:
        sums = tmp.save(texts.select("id", F.sha2("t", 256).alias("sum")), "sums")
        own = sums.groupBy("sum").agg(F.min("id").alias("own"), F.count("*").alias("n")).filter("n > 1").drop("n")
        own = tmp.save(own, "own")  # read anew, as `often` below: a frequent key's rows can be split in the join
        copies = tmp.save(sums.join(own, "sum").filter("id <> own").select("id"), "copies")
        tmp.drop("sums")
        tmp.drop("own")
        found = tmp.save(texts.mapInArrow(find, "h long, id long, at int, total int"), "anchors")
        often = tmp.save(found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h", (F.col("n") > hot).alias("often")), "often")
        places = found.join(often, "h").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", "h", "often"))).alias("places"), F.max("total").alias("total"))
        copied = copies.withColumn("copied", F.lit(True))
        places = tmp.save(places.join(copied, "id", "left").filter("copied is null").drop("copied"), "places")
        whole = found.select("id", "total").groupBy("id").agg(F.max("total").alias("total")).join(copies, "id")
        whole = tmp.save(whole.select("id", F.array(F.struct(F.lit(0).alias("a"), F.col("total").alias("b"))).alias("spans")), "whole")
        tmp.drop("anchors")
        tmp.drop("often")
        near = texts.join(places.select("id", "places"), "id").select("id", "t", "places").mapInArrow(surroundings, "key long, seq binary, id long, start int, often boolean")
        distinct = near.groupBy("key", "seq", "often").agg(F.min("id").alias("id"), F.min_by("start", "id").alias("start"))
        dealt = distinct.repartition("key").sortWithinPartitions("key", "often")
        masks = tmp.save(dealt.select("key", "seq", "id", "start", "often").mapInArrow(matched, "id long, start int, size int, mask binary, key long, often boolean"), "masks")
        masks = masks.groupBy("id").agg(F.collect_list(F.struct("start", "size", "mask", "key", "often")).alias("masks"))
        spans = places.join(masks, "id", "left").select("id", "places", "total", "masks").mapInArrow(ranges, "id long, spans array<struct<a:int,b:int>>")
        return spans.filter("size(spans) > 0").union(whole).checkpoint()


def documents(docs: DataFrame, id_col: str, text_col: str, tmp: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """(id, t) of the documents, each once, and (id, sum, doc) of those that share an id with another text.

    Where no id is repeated the ids number the documents. Of texts that share one, that with the least digest keeps the
    id; the others get numbers behind all ids, in the order of ids and digests.
    """
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    twins = texts.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")
    twins = tmp.save(twins, "twins")
    if twins.isEmpty():
        return texts, None
    largest = texts.agg(F.max("id")).first()[0]
    if largest >= 1 << 62:
        raise ValueError("ids from 2 ** 62 on must not be repeated")
    several = tmp.save(texts.join(twins, "id").select("id", F.sha2(F.coalesce("t", F.lit(b"")), 256).alias("sum")).distinct(), "several")
    first = several.groupBy("id").agg(F.min("sum").alias("sum"))
    extra = several.join(first, ["id", "sum"], "left_anti").orderBy("id", "sum").withColumn("doc", F.lit(largest + 1) + F.monotonically_increasing_id())
    extra = tmp.save(extra, "extra")
    same = texts.join(twins, "id").withColumn("sum", F.sha2(F.coalesce("t", F.lit(b"")), 256)).join(extra, ["id", "sum"], "left")
    same = same.select(F.coalesce("doc", "id").alias("id"), "t").groupBy("id").agg(F.min("t").alias("t"))
    return tmp.save(texts.join(twins, "id", "left_anti").union(same), "documents"), extra


def drop_repeats(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text", hot: int = 5000) -> DataFrame:
    """`docs` without words that repeat earlier passages, with n_words and n_removed; kept words are joined by one space.

    A word goes if a window of `width` (1 or more) consecutive words covers it whose words also start earlier: in a
    document of a smaller id or before in the same one. Words are separated by space and \\t to \\r and compared
    unchanged. Documents that lose nothing keep their text only in this sense: their words joined by one space. A null
    text has no words and becomes empty. Rows with a null id are compared with nothing. Rows that share an id and a text
    are one document and fare alike. Of different texts with one id that with the least SHA-256 is the document of this
    id; the others count as documents behind all others. Columns named n_words and n_removed are replaced. An empty
    table gives an empty table.
    """
    if width < 1:
        raise ValueError("width has to be positive")
    small_batches(docs.sparkSession)
    with scratch(docs.sparkSession) as tmp:
        texts, extra = documents(docs, id_col, text_col, tmp)
        spans = repeated_spans(texts, width, hot)
        extra = extra if extra is None else extra.checkpoint()
    clean = docs.drop("n_words", "n_removed")
    names, at = clean.columns, clean.columns.index(text_col)
    keyed = clean.withColumn("__doc", F.col(id_col).cast("long"))
    if extra is not None:
        keyed = keyed.withColumn("__sum", F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
        keyed = keyed.join(extra.select(F.col("id").alias("__id"), F.col("sum").alias("__s"), F.col("doc").alias("__other")), (F.col("__doc") == F.col("__id")) & (F.col("__sum") == F.col("__s")), "left")
        keyed = keyed.withColumn("__doc", F.coalesce("__other", "__doc"))
    joined = keyed.join(spans.select(F.col("id").alias("__id_of_spans"), F.col("spans").alias("__spans")), F.col("__doc") == F.col("__id_of_spans"), "left").select(*names, "__spans")

    def kept(batches):
        for batch in batches:
            texts, n_words, n_removed = [], [], []
            for t, s in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                words = (t or "").encode().split()
                n_words.append(len(words))
                for x in reversed(s or []):
                    del words[x["a"] : x["b"]]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words).decode())
            cols = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], [*names, "n_words", "n_removed"])

    return joined.mapInArrow(kept, T.StructType([*clean.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]))
