"""Byte-level BPE by ranks, as relations: each partition asks DuckDB, whose recursive query contracts all words at once.

A word is a set of rows (word, position, token), at first one for each byte. In a round every row meets its right
neighbour's token in the table of merges, and each word contracts its leftmost pair of least rank; words without such
a pair are done. Of a rank that can only make pairs of higher rank ("calm"), all places that don't overlap are taken in
one round, which gives what one at a time would give. Decoding joins ids with the vocabulary and puts a text's bytes
together by an aggregate ordered by position.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property, lru_cache

import ahocorasick
import duckdb
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches

#: Rows that a query starts from, and rows that all its rounds may make together (some 24 bytes each).
START_ROWS, ROUND_ROWS = 600_000, 8_000_000
#: Words that a worker remembers, and bytes from which a word isn't remembered and is cut where no token can cross.
KNOWN, LONG = 600_000, 64

MERGE = """
WITH RECURSIVE t(w, step, i, id) AS (SELECT w, 0, i, id FROM start UNION ALL SELECT * FROM (
  WITH p AS (SELECT *, lead(w) OVER o AS nw, lead(id) OVER o AS nx, lead(i) OVER o AS ni FROM t WHERE step < $rounds WINDOW o AS (ORDER BY i)),
  m AS (SELECT p.w, i, ni, merges.id AS rank, calm FROM p JOIN merges ON l = p.id AND r = nx AND nw = p.w),
  b AS (SELECT w, min(rank::BIGINT << 32 | i) AS first FROM m GROUP BY w),
  h AS (SELECT i, ni, rank, first, calm, (lag(ni) OVER (ORDER BY i) IS DISTINCT FROM i)::INT AS apart FROM m JOIN b ON m.w = b.w AND rank = first >> 32),
  k AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY i) AS nth FROM (SELECT *, sum(apart) OVER (ORDER BY i) AS run FROM h)),
  x AS (SELECT i, ni, rank FROM k WHERE i = first & 4294967295 OR calm AND nth % 2 = 1)
  SELECT p.w, step + 1, p.i, coalesce(x.rank, p.id) FROM p JOIN b ON p.w = b.w LEFT JOIN x ON x.i = p.i LEFT JOIN x AS before ON before.ni = p.i WHERE before.i IS NULL))
SELECT w, i, id, step FROM t JOIN (SELECT w, max(step) AS step FROM t GROUP BY w) USING (w, step) ORDER BY i
"""
DECODE = "SELECT d, unhex(string_agg(hex, '' ORDER BY i)) AS part FROM ids JOIN vocab USING (id) GROUP BY d ORDER BY d"


@lru_cache(maxsize=1)
def newer() -> dict[int, str]:
    """Letters and numbers that the library's pattern engine, of an older Unicode version, doesn't know yet, and what stands in for them."""
    out: list[str] = []
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind in (r"\p{L}", r"\p{N}"):
        library = tiktoken.Encoding("bytes", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        here = regex.findall(kind, every)
        known = set(bytes(library.encode_ordinary("".join(here))).decode())
        out += [c for c in here if c not in known]
    return str.maketrans(dict.fromkeys(out, "\uffff"))


@lru_cache(maxsize=1)
def newer_set() -> frozenset[str]:
    return frozenset(map(chr, newer()))


def split_again(text: str, words: regex.Pattern) -> list[str]:
    """The matches if newer characters count as unassigned ones."""
    return [text[m.start() : m.end()] for m in words.finditer(text.translate(newer()))]


class RankModel:
    """A rank file (tokens in base64 with their ranks, which are the ids) as tables of a DuckDB connection."""

    def __init__(self, raw: bytes):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every byte has to be a token")
        splits = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        left, right, made = np.array(splits, np.int32).reshape(-1, 3).T
        least = np.full(max(self.ranks.values()) + 1, 2**31 - 1, np.int32)  # of the ranks of the pairs that a token is in
        np.minimum.at(least, left, made)
        np.minimum.at(least, right, made)
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
        self._put("merges", {"l": left, "r": right, "id": made, "calm": least[made] > made})
        self._put("vocab", {"id": np.array(list(self.ranks.values()), np.int32), "hex": [t.hex() for t in self.ranks]})
        self.known: dict[str, bytes] = {}

    def _put(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _ask(self, sql: str, name: str, columns: dict, **values) -> dict:
        self.db.register(name, pa.table(columns))
        out = self.db.execute(sql, values or None).fetchnumpy()
        self.db.unregister(name)
        return out

    @cached_property
    def matcher(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for token in self.ranks:
            if len(token) > 1:
                found.add_word(token.decode("latin-1"), len(token))
        found.make_automaton()
        return found

    def sections(self, word: bytes) -> list[bytes]:
        """A long word cut at all places that no token could cross: merging never does either."""
        turns = np.zeros(len(word) + 1, np.int64)
        for end, size in self.matcher.iter(word.decode("latin-1")):
            turns[end - size + 2] += 1
            turns[end + 1] -= 1
        cuts = [0, *(np.flatnonzero(np.cumsum(turns[:-1])[1:] == 0) + 1), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def merged(self, words: Sequence[bytes]) -> list[np.ndarray]:
        """Ids of each word (none empty). Queries go on from one another's rows until no word contracts."""
        sizes = np.array([len(x) for x in words], np.int64)
        w = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        rows = {"w": w, "i": np.arange(len(w), dtype=np.int32), "id": self.bytes[np.frombuffer(b"".join(words), np.uint8)]}
        while True:
            rounds = max(1, ROUND_ROWS // max(len(rows["w"]), 1))
            rows = self._ask(MERGE, "start", rows, rounds=rounds)
            if rows.pop("step").max() < rounds:
                break
        starts = np.searchsorted(rows["w"], np.arange(len(words) + 1))
        ids = rows["id"].astype("<u4")
        return [ids[a:b] for a, b in zip(starts, starts[1:], strict=False)]

    def _parts(self, words: Iterable[bytes]) -> Iterator[list[bytes]]:
        part, size = [], 0
        for x in words:
            if part and size + len(x) > START_ROWS:
                yield part
                part, size = [], 0
            part.append(x)
            size += len(x)
        if part:
            yield part

    def word_ids(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words, as little-endian 32-bit integers. A word that is a token is not merged."""
        out: dict[str, bytes] = {}
        cut: dict[str, list[bytes]] = {}
        for word in words:
            raw = word.encode()
            if (rank := self.ranks.get(raw)) is not None:
                out[word] = rank.to_bytes(4, "little")
            else:
                cut[word] = [raw] if len(raw) < LONG else self.sections(raw)
        todo = (s for own in cut.values() for s in own)
        found = (ids.tobytes() for part in self._parts(todo) for ids in self.merged(part))
        for word, own in cut.items():
            out[word] = b"".join(next(found) for _ in own)
        return out

    def encode(self, texts: Sequence[str], words: regex.Pattern) -> list[bytes]:
        if len(self.known) > KNOWN:
            self.known.clear()
        known = self.known
        split = [words.findall(t) for t in texts]
        new = {x for own in split for x in own if x not in known}
        if odd := {x for x in new if not newer_set().isdisjoint(x)}:
            split = [own if odd.isdisjoint(own) else split_again(t, words) for t, own in zip(texts, split, strict=True)]
            new = {x for own in split for x in own if x not in known}
        known.update(self.word_ids(new))
        out = [b"".join(map(known.__getitem__, own)) for own in split]
        for x in new:
            if len(x) >= LONG or odd and not newer_set().isdisjoint(x):  # the latter have to be seen each time
                del known[x]
        return out

    def decode(self, ids: Sequence[bytes]) -> list[bytes]:
        """Texts of ids; ids that are no tokens give nothing. A text of very many ids is put together from parts."""
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        d = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) // 4 for x in ids])
        out = [b""] * len(ids)
        for at in range(0, len(flat), START_ROWS):
            cut = slice(at, at + START_ROWS)
            got = self._ask(DECODE, "ids", {"d": d[cut], "i": np.arange(len(d[cut]), dtype=np.int32), "id": flat[cut]})
            for k, part in zip(got["d"].tolist(), got["part"], strict=True):
                out[k] += bytes(part)
        return out


@lru_cache(maxsize=2)
def model(path: str) -> RankModel:
    with open(path, "rb") as f:
        return RankModel(f.read())


def encode_ranked(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """`docs` with `ids` (binary: little-endian unsigned 32-bit ids) and `decoded` (binary: the bytes that these give).

    `path` is a rank file that every executor can open; each match of `pattern` is encoded by itself, and text between
    matches is left out. Columns of these two names in `docs` are replaced. A null or empty text has no ids. Rows are
    independent, so repeated ones fare alike; memory is bounded by an Arrow batch, the rows of a query and the
    remembered words.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("ids", "decoded")
    names, at = docs.columns, docs.columns.index(text_col)

    def encoded(batches):
        m, words = model(path), regex.compile(pattern)
        for batch in batches:
            ids = m.encode([t or "" for t in batch.column(at).to_pylist()], words)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), pa.array(m.decode(ids), pa.binary())], [*names, "ids", "decoded"])

    return docs.mapInArrow(encoded, T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]))


def decode_ranked(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """`rows` with `decoded` (binary) from any binary column of ids; null gives null."""
    small_batches(rows.sparkSession)
    rows = rows.drop("decoded")
    names, at = rows.columns, rows.columns.index(ids_col)

    def decoded(batches):
        for batch in batches:
            ids = batch.column(at).to_pylist()
            out = [None if i is None else t for i, t in zip(ids, model(path).decode([i or b"" for i in ids]), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*names, "decoded"])

    return rows.mapInArrow(decoded, T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))
