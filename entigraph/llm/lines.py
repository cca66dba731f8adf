"""Line dedup by two Bloom filters.

A pass over the texts turns line keys into hashes and sets these in bit maps, segment by segment: keys met once and
keys met again. The maps of all tasks are joined (a bit that two of them have in their once-maps goes to the joint
twice-map), which gives a superset of the keys that occur in two documents. Only lines whose keys pass the twice-map,
the suspected repeats, are shuffled; they are counted exactly by their text, and the document that keeps them is
chosen. The maps get 4 to 8 bits for each key that the corpus could hold, up to `most_bits`; where that is too few, more
lines are shuffled for confirmation, and the result stays the same.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch, small_batches

SPACE = b" \t\n\x0b\x0c\r"
SEGMENT, CHUNK, FEWEST_BITS = 1 << 18, 1 << 21, 1 << 20
MAPS = "segment long, part long, once binary, twice binary"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()  # bytes.lower() changes A-Z alone


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode()) >= least)


def _keys(text: bytes | None, least: int) -> set[bytes]:
    return {k for x in (text or b"").split(b"\n") if long_enough(k := line_key(x), least)}


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (h % np.uint64(bits)).astype(np.int64), ((h >> np.uint64(32)) * np.uint64(0x9E3779B1) % np.uint64(bits)).astype(np.int64)


class TwiceFilter:
    """Answers whether a hash may have been seen twice; never no for one that has."""

    def __init__(self, packed: bytes, bits: int):
        self.map, self.bits = np.frombuffer(packed, np.uint8), bits

    def __call__(self, h: np.ndarray) -> np.ndarray:
        a, b = _places(h, self.bits)
        get = lambda p: (self.map[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1
        return (get(a) & get(b)).astype(bool)


def bits_for(texts: DataFrame, least: int, most_bits: int) -> int:
    """4 to 8 bits for each line of `least` characters that the texts (column t, binary) could have at most, as a power of two.

    Lines are longer, and some are short or repeated, so that a key gets about 16."""
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    return min(most_bits, max(FEWEST_BITS, 1 << (4 * size // least).bit_length()))


def _packed(bits: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), np.uint8)


def _batch(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["segment", "part", "once", "twice"])


def joined_maps(maps: DataFrame, *by: str) -> DataFrame:
    """One pair of maps for each value of `by`; the maps stream by, so that two pairs are held at a time."""

    def join(batches):
        key = once = twice = None
        for batch in batches:
            for segment, part, o, t in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                own = (segment, part) if "part" in by else (segment, 0)
                o, t = _unpacked(o), _unpacked(t)
                if own == key:
                    twice = twice | t | (once & o)
                    once = once | o
                    continue
                if key:
                    yield _batch([(*key, zlib.compress(once.tobytes(), 1), zlib.compress(twice.tobytes(), 1))])
                key, once, twice = own, o, t
        if key:
            yield _batch([(*key, zlib.compress(once.tobytes(), 1), zlib.compress(twice.tobytes(), 1))])

    return maps.repartition(*by).sortWithinPartitions(*by).mapInArrow(join, MAPS)


def twice_seen(texts: DataFrame, least: int, bits: int) -> bytes:
    """The packed twice-map (bits / 8 bytes) of the line keys of `texts` (column t, binary)."""

    def maps(batches):
        import pyspark

        part = pyspark.TaskContext.get().partitionId() % 64
        found: list[int] = []

        def flush():
            h, n = np.unique(np.array(found, np.uint64), return_counts=True)
            found.clear()
            every, again = (np.sort(np.concatenate(_places(x, bits))) for x in (h, h[n > 1]))
            for s in np.unique(every // SEGMENT).tolist():
                marks = []
                for at in (every, again):
                    own = np.zeros(SEGMENT, bool)
                    own[at[np.searchsorted(at, s * SEGMENT) : np.searchsorted(at, (s + 1) * SEGMENT)] - s * SEGMENT] = True
                    marks.append(_packed(own))
                yield _batch([(s, part, *marks)])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                found.extend(map(xxhash.xxh3_64_intdigest, _keys(t, least)))
                if len(found) >= CHUNK:
                    yield from flush()
        if found:
            yield from flush()

    joint = joined_maps(joined_maps(texts.mapInArrow(maps, MAPS), "segment", "part"), "segment")
    out = np.zeros(bits // 8, np.uint8)
    for r in joint.select("segment", "twice").collect():  # bits / SEGMENT rows
        at = r["segment"] * (SEGMENT // 8)
        out[at : at + SEGMENT // 8] = _unpacked(r["twice"])
    return out.tobytes()


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, most_bits: int = 1 << 30) -> DataFrame:
    """`docs` with the lines dropped that at least `min_docs` documents share, but for the largest id's.

    A line's key is the line without white space (space, \\t to \\r) at its ends and with A-Z lowered. Keys of at
    least `min_chars` code points found in `min_docs` documents or more lose all their lines except those in the
    largest id that holds them. The columns n_lines (before dropping; an empty or null text has one empty line)
    and n_dropped are added; columns of these names in `docs` are replaced. Rows with a null id are counted
    nowhere and stay as they are; a null text stays null. Rows that share an id count as one document.
    An empty table gives an empty table. The driver holds a map of `most_bits` / 8 bytes at most (128 MB); it limits no
    result.
    """
    spark = docs.sparkSession
    bare = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    with scratch(spark) as tmp:
        bits = bits_for(bare, min_chars, most_bits)
        twice = spark.sparkContext.broadcast(twice_seen(bare.select("t"), min_chars, bits))

        def suspects(batches):
            seen = TwiceFilter(twice.value, bits)
            for batch in batches:
                ids, keys = [], []
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    found = list(_keys(t, min_chars))
                    if found:
                        h = np.array([xxhash.xxh3_64_intdigest(k) for k in found], np.uint64)
                        again = np.flatnonzero(seen(h)).tolist()
                        ids += [i] * len(again)
                        keys += [found[j] for j in again]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["id", "key"])

        found = tmp.save(bare.mapInArrow(suspects, "id long, key binary"), "suspects")
        twice.destroy()
        # a key's ids are counted in 32 parts, so that no task has all documents of a frequent line
        parts = found.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(32)).alias("part")).agg(F.count_distinct("id").alias("n"), F.max("id").alias("keep"))
        exact = parts.groupBy("key").agg(F.sum("n").alias("n"), F.max("keep").alias("keep")).filter(F.col("n") >= min_docs).drop("n")
        exact = tmp.save(exact, "exact")  # read anew, so that a frequent key's rows can be split in the join
        drops = found.join(exact, "key").filter("id <> keep").groupBy("id").agg(F.collect_set("key").alias("__drops")).checkpoint()
    clean = docs.drop("n_lines", "n_dropped")
    joined = clean.join(drops.withColumnRenamed("id", "__id"), clean[id_col].cast("long") == F.col("__id"), "left").drop("__id")
    names, at = clean.columns, clean.columns.index(text_col)

    def rebuilt(batches):
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for t, d in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                lines = (t or "").split("\n")
                n_lines.append(len(lines))
                if d:
                    gone = set(d)
                    keys = [line_key(x.encode()) for x in lines]
                    lines = [x for x, k in zip(lines, keys, strict=True) if k not in gone]
                    t = "\n".join(lines)
                n_dropped.append(n_lines[-1] - len(lines))
                texts.append(t)
            cols = [pa.array(texts, batch.schema.field(at).type) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

    small_batches(spark)
    schema = T.StructType([*clean.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(rebuilt, schema)

