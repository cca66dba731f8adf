"""Near-duplicate documents by a signature-coordinate inverted join.

Every document has a MinHash signature of K coordinates over its set of word shingles. Two documents with a
similarity of 0.8 agree in 0.8 * K coordinates on average; pairs that agree in T or more are candidates (a linked
pair falls below T with a probability under 4 in a million). Documents are posted under each coordinate-value
pair. Values held by one document only are skipped, and of the rest only a prefix is posted: with the values in
one global order, rarest first, two documents that agree in T of K places share one of their first K - T + 1.

Documents with equal shingle sets are one node. In each posting list all members are first compared with the
smallest one, the hub; after the components of the links found so far, only members of different components are
compared, those outside the list's largest component with the rest, block by block, and lists that lie in one component are
skipped. So a list of near copies costs about as many comparisons as it has members. Lists with one hub are one, so that a
pair is met once. Pairs that met are counted in all K coordinates; the candidates, those with T or more,
are confirmed on the full shingle sets if they agree in WIDE_T of WIDE further coordinates, counted on one byte each (a
linked pair falls below that with a probability under 6 in a million), and if their exact similarities to the hub,
where known, leave room for a link: 1 - similarity is a metric.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, gram_hashes, mixed, scratch, word_hashes
from .components import components

K, T = 48, 25
_RANDOM = mixed(np.arange(1, 2 * K + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FACTOR, SHIFT = (_RANDOM[:K] | np.uint64(1))[:, None], _RANDOM[K:][:, None]
PLACE = (np.arange(K, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[:, None]
WIDE, WIDE_T = 512, 368
BLOCK, BLOCK_BYTES = 256, 16 << 20  # of a side of a block: members, bytes of their texts
_WIDE = (mixed(np.arange(1, 2 * WIDE + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype(np.uint32)
WIDE_FACTOR, WIDE_SHIFT = (_WIDE[:WIDE] | np.uint32(1))[:, None], _WIDE[WIDE:][:, None]
LONGS = [f"s{i}" for i in range(WIDE // 8)]


def shingle_set(text: str | bytes | None, words: int) -> np.ndarray:
    """Sorted distinct hashes (64 bits) of the word shingles; A-Z are lowered, words end at space and \\t to \\r.
    With fewer words the whole sequence is one shingle; without words there is none."""
    raw = text.encode() if isinstance(text, str) else text or b""
    h = word_hashes(raw.lower().split())
    return np.unique(gram_hashes(h, min(words, len(h)))) if len(h) else h


def signature(shingles: np.ndarray) -> np.ndarray:
    """K 64-bit values, each mixed with its place."""
    least = np.full((K, 1), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, ((shingles[None, at : at + 4096] ^ SHIFT) * FACTOR).min(axis=1, keepdims=True))
    return mixed(least ^ PLACE)[:, 0]


def wide_signature(shingles: np.ndarray) -> np.ndarray:
    """WIDE coordinates of one byte each."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full((WIDE, 1), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), 2048):
        least = np.minimum(least, ((short[None, at : at + 2048] ^ WIDE_SHIFT) * WIDE_FACTOR).min(axis=1, keepdims=True))
    return (mixed(least[:, 0].astype(np.uint64)) & np.uint64(255)).astype(np.uint8)


def _signatures(words: int):
    def found(batches):
        for batch in batches:
            ids, n, fp, keys, longs = [], [], [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = shingle_set(t, words)
                ids.append(i)
                n.append(len(s))
                fp.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                k = signature(s) if len(s) else None
                keys.append(None if k is None else k.view(np.int64))
                longs.append(wide_signature(s).view(np.int64) if len(s) else np.zeros(WIDE // 8, np.int64))
            longs = np.array(longs, np.int64).reshape(-1, WIDE // 8)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(keys, pa.list_(pa.int64())), *(pa.array(longs[:, j]) for j in range(WIDE // 8))], ["id", "n", "fp", "keys", *LONGS])

    return found


SIGNATURE_SCHEMA = "id long, n long, fp binary, keys array<long>, " + ", ".join(f"{s} long" for s in LONGS)


def _agreeing(a: str, b: str):
    """Number of coordinates in which two rows agree, from their packed bytes, as a SQL expression."""
    parts = []
    for s in LONGS:
        x = f"({a}.{s} ^ {b}.{s})"
        x = f"(({x} | shiftrightunsigned({x}, 4)) & 1085102592571150095L)"  # 0x0f in each byte
        x = f"(({x} | shiftrightunsigned({x}, 2)) & 217020518514230019L)"  # 0x03
        x = f"(({x} | shiftrightunsigned({x}, 1)) & 72340172838076673L)"  # 0x01
        parts.append(f"bit_count({x})")
    return F.expr(f"{WIDE} - ({' + '.join(parts)})")


def _plausible(a: str, b: str, percent: int):
    """Sizes that allow the similarity, and enough agreeing coordinates: WIDE_T of the wide ones and T of those posted."""
    sizes = 100 * F.least(f"{a}.n", f"{b}.n") >= percent * F.greatest(f"{a}.n", f"{b}.n")
    same = F.size(F.array_intersect(f"{a}.keys", f"{b}.keys"))  # values are mixed with their places
    return sizes & (_agreeing(a, b) >= WIDE_T) & (same >= T)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int, tmp: Scratch, name: str) -> DataFrame:
    """(u, v, similarity, linked) of `pairs` (u, v) from their full shingle sets; linked: 100 * intersection >= percent * union."""
    wanted = pairs.select(F.col("u").alias("id")).union(pairs.select(F.col("v").alias("id"))).distinct()
    own = tmp.save(texts.join(wanted, "id").dropDuplicates(["id"]), f"{name}-texts")
    rows = pairs.join(own.select(F.col("id").alias("u"), F.col("t").alias("tu")), "u").join(own.select(F.col("id").alias("v"), F.col("t").alias("tv")), "v")

    def check(batches):
        kept: dict[int, np.ndarray] = {}

        def shingles(i, t):
            if i not in kept:
                if len(kept) >= 64:
                    kept.clear()
                kept[i] = shingle_set(t, words)
            return kept[i]

        for batch in batches:
            u, v, tu, tv = (batch.column(i).to_pylist() for i in range(4))
            linked, similar = [], []
            for i in range(len(u)):
                a, b = shingles(u[i], tu[i]), shingles(v[i], tv[i])
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
                similar.append(both / max(1, len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(similar, pa.float64()), pa.array(linked, pa.bool_())], ["u", "v", "similarity", "linked"])

    return tmp.save(rows.select("u", "v", "tu", "tv").mapInArrow(check, "u long, v long, similarity double, linked boolean"), name)


def _blocks(rows: DataFrame, tmp: Scratch, name: str) -> DataFrame:
    """(hub, i, j, left, ...): members outside their list's largest component beside all members, in blocks of both."""
    blocks = lambda test: F.ceil(F.greatest(F.count_if(test) / BLOCK, F.sum(F.when(test, F.col("bytes"))) / BLOCK_BYTES)).cast("int")
    sizes = tmp.save(rows.groupBy("hub").agg(blocks(F.col("outside")).alias("lefts"), blocks(F.lit(True)).alias("rights")).filter("lefts > 0"), name)
    own, rows = [c for c in rows.columns if c not in ("hub", "bytes")], rows.join(sizes, "hub")
    place = lambda many: F.pmod(F.xxhash64("id"), many).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    left = rows.filter("outside").select("hub", place(F.col("lefts")).alias("i"), every("rights").alias("j"), F.lit(True).alias("left"), *own)
    right = rows.select("hub", every("lefts").alias("i"), place(F.col("rights")).alias("j"), F.lit(False).alias("left"), *own)
    return left.union(right)


class _Block:
    """The two sides of a block, and which pairs of them may be linked: in different components, with enough agreeing coordinates."""

    def __init__(self, rows: pd.DataFrame, percent: int):
        rows = rows.sort_values("id")
        self.ids, self.n, self.near = rows["id"].to_numpy(), rows["n"].to_numpy(), rows["similarity"].to_numpy().astype(float)  # nan: not known
        self.outside, left = rows["outside"].to_numpy(bool), rows["left"].to_numpy(bool)
        self.keys = np.stack(rows["keys"].to_numpy())
        self.wide = np.stack(rows["wide"].to_numpy()).astype(np.int64).view(np.uint8) if "wide" in rows else None
        self.left, self.right, self.percent = np.flatnonzero(left), np.flatnonzero(~left), percent
        self.group = np.unique(rows["comp"].to_numpy(), return_inverse=True)[1]
        self.t = rows["t"].to_numpy() if "t" in rows else None

    def candidates(self, k: int) -> np.ndarray:
        """The right side's rows that may be linked with row k; with wide signatures, those with the most agreeing coordinates first."""
        at, n = self.right, self.n
        fit = 100 * np.minimum(n[k], n[at]) >= self.percent * np.maximum(n[k], n[at])
        met = self.outside[at] & (self.ids[at] < self.ids[k])  # with the sides exchanged
        apart = np.abs(self.near[at] - self.near[k]) > 1 - self.percent / 100 + 1e-9
        at = at[fit & ~met & ~apart & (self.group[at] != self.group[k])]
        at = at[(self.keys[at] == self.keys[k]).sum(1) >= T]
        if self.wide is None:
            return at
        agree = (self.wide[at] == self.wide[k]).sum(1)
        return at[np.argsort(-agree, kind="stable")[: int((agree >= WIDE_T).sum())]]


def between_components(members: DataFrame, star: DataFrame, sides: DataFrame, texts: DataFrame, words: int, percent: int, tmp: Scratch) -> DataFrame:
    """Links (u, v) between members (hub, id, comp) of one list that lie in different components; enough to join all that have any.

    Members outside the list's largest component are compared with all others, in blocks: first by their posted coordinates,
    which tells who has a candidate at all; then those with their wide signatures and texts. A block gives a spanning forest of the links it finds, never pairs.
    """
    several = members.groupBy("hub", "comp").agg(F.count("*").alias("k")).groupBy("hub").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count("*").alias("comps"))
    several = tmp.save(several.filter("comps > 1").drop("comps"), "several")
    rows = members.join(several, "hub").join(star.select(F.col("u").alias("hub"), F.col("v").alias("id"), "similarity"), ["hub", "id"], "left")
    rows = rows.join(sides.select("id", "n", "keys"), "id").withColumn("outside", F.col("comp") != F.col("main")).drop("main")
    rows = tmp.save(rows, "members")

    def promising(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, some = _Block(rows, percent), set()
        for k in block.left:
            found = block.candidates(k)
            if len(found):
                some.update(block.ids[found].tolist(), [int(block.ids[k])])
        return pd.DataFrame({"hub": np.full(len(some), key[0]), "id": np.array(sorted(some), np.int64)})

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between the components of a block; those that are joined already are not compared any more."""
        block, sets, out = _Block(rows, percent), {}, []

        def shingles(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = shingle_set(bytes(block.t[k]), words)
            return sets[k]

        ids, n, group = block.ids, block.n, block.group
        for k in block.left:
            for x in block.candidates(k):
                if group[x] != group[k]:
                    both = len(np.intersect1d(shingles(k), shingles(x), assume_unique=True))
                    if 100 * both >= percent * (n[k] + n[x] - both):
                        out.append((min(ids[k], ids[x]), max(ids[k], ids[x])))
                        group[group == group[x]] = group[k]
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    some = _blocks(rows.withColumn("bytes", F.lit(500)), tmp, "sizes").groupBy("hub", "i", "j").applyInPandas(promising, "hub long, id long")
    some = tmp.save(some.distinct(), "promising")
    rows = rows.join(some, ["hub", "id"]).join(sides.select("id", F.array(*LONGS).alias("wide")), "id").join(texts, "id").withColumn("bytes", F.octet_length("t"))
    return _blocks(tmp.save(rows, "with-texts"), tmp, "sizes-2").groupBy("hub", "i", "j").applyInPandas(compared, "u long, v long").distinct()


def numbered(signed: DataFrame, texts: DataFrame, words: int, tmp: Scratch) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """`signed` and `texts` with a number for each shingle set of an id in place of the id, and (own, id) of the ids renumbered.

    Where no id is repeated, ids are such numbers. Of the sets that share one, that with the least fp keeps the id; the
    others get numbers behind all ids.
    """
    signed = signed.withColumn("own", F.col("id"))
    twins = signed.filter("id is not null").groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")
    twins = tmp.save(twins, "twins")
    if twins.isEmpty():
        return signed, texts, None
    largest = signed.agg(F.max("id")).first()[0]
    if largest >= 1 << 62:
        raise ValueError("ids from 2 ** 62 on must not be repeated")
    sets = tmp.save(signed.filter("fp is not null").join(twins, "id").select("id", "fp").distinct(), "sets")
    first = sets.groupBy("id").agg(F.min("fp").alias("fp"))
    extra = sets.join(first, ["id", "fp"], "left_anti").orderBy("id", "fp").withColumn("number", F.lit(largest + 1) + F.monotonically_increasing_id())
    extra = tmp.save(extra, "extra")

    def printed(batches):
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary())], ["id", "t", "fp"])

    given = lambda df: df.join(extra, ["id", "fp"], "left").withColumn("id", F.coalesce("number", "id"))
    same = given(texts.join(twins, "id").mapInArrow(printed, "id long, t binary, fp binary").filter("fp is not null")).groupBy("id").agg(F.min("t").alias("t"))
    texts = tmp.save(texts.join(twins, "id", "left_anti").union(same), "numbered-texts")
    return tmp.save(given(signed).drop("number"), "numbered"), texts, twins


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept), one row per row of `docs`.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets; component_id is the
    smallest id reachable, kept marks that one. Texts that are null, empty or without words have no shingles and
    are linked with nothing; so are rows with a null id (component_id null, kept true). Texts with
    shingles that share an id share a component. An empty table gives an empty result; other columns of `docs` are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    with scratch(spark) as tmp:
        signed = tmp.save(texts.mapInArrow(_signatures(words), SIGNATURE_SCHEMA), "signatures")
        signed, texts, twins = numbered(signed, texts, words, tmp)
        # tables of one row per key are read anew, so that a frequent key's rows can be split in the joins with them
        first = tmp.save(signed.filter("fp is not null and id is not null").groupBy("fp").agg(F.min("id").alias("rep")).withColumnRenamed("fp", "f"), "first")
        nodes = signed.join(first, (F.col("id") == F.col("rep")) & (F.col("fp") == F.col("f"))).drop("f", "rep", "own").dropDuplicates(["id"])
        nodes = tmp.save(nodes, "nodes")
        posted = nodes.select("id", F.explode("keys").alias("key"))
        shared = tmp.save(posted.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "shared")
        lists = posted.join(shared, "key").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("c", "key"))).alias("held"))
        # values held once come first in the global order; of the first K - T + 1 places those with others' values remain
        prefix = lists.select("id", F.expr(f"slice(held, 1, greatest(0, {K - T + 1} - ({K} - size(held))))").alias("held"))
        prefix = prefix.select("id", F.explode("held.key").alias("key"))
        lists = tmp.save(prefix, "lists")
        tmp.drop("shared")
        hubs = tmp.save(lists.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("c")).filter("c > 1"), "hubs")
        near = tmp.save(lists.join(hubs, "key").filter("id <> hub").groupBy("hub", "id").agg(F.max("c").alias("c")), "near")
        sides = nodes.select("id", "n", "keys", *LONGS)
        star = near.select(F.col("hub").alias("u"), F.col("id").alias("v"))
        star = star.join(sides.alias("a"), F.col("u") == F.col("a.id")).join(sides.alias("b"), F.col("v") == F.col("b.id")).filter(_plausible("a", "b", percent)).select("u", "v")
        star = confirmed(tmp.save(star, "star"), texts, words, percent, tmp, "links")
        links = star.filter("linked").select("u", "v")
        if twins is not None:  # the sets that share an id are linked
            held = signed.filter("fp is not null").join(twins.withColumnRenamed("id", "own"), "own").select("own", F.col("fp").alias("f")).distinct().join(first, "f")
            held = tmp.save(held.select("own", "rep"), "held")
            links = links.union(held.join(held.groupBy("own").agg(F.min("rep").alias("u")), "own").select("u", "rep"))
        found = tmp.save(components(links, tmp, "first-links"), "found")
        # lists of two were compared above
        rest = near.filter("c > 2").drop("c").join(found.withColumnRenamed("component", "comp"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        more = tmp.save(between_components(tmp.save(rest, "rest"), star, sides, texts, words, percent, tmp), "more")
        if not more.isEmpty():
            found = components(more.union(found.select(F.col("component").alias("u"), F.col("id").alias("v"))), tmp, "second")
        label = nodes.select(F.col("fp").alias("f"), "id").join(found, "id", "left").select("f", F.coalesce("component", "id").alias("component"))
        out = signed.select("own", "n", "fp").join(tmp.save(label, "label"), F.col("fp") == F.col("f"), "left")
        component = F.when(F.col("own").isNotNull(), F.coalesce("component", "own"))
        out = out.select(F.col("own").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("own") == component, F.lit(True)).alias("kept"))
        return out.checkpoint()
