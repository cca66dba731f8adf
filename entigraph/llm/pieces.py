"""SentencePiece BPE encoding by backtracking, and decoding.

Merging by score has a local test: a sequence of tokens is what merging gives if every token merges back to
itself and every two neighbours do so side by side. So a text is covered from the left with the longest
vocabulary match at each place (all matches come from one Aho-Corasick pass); a token that is not compatible
with the one before it gives way to the next shorter match, and where none is left the last token is taken
back and its end is marked in a bit field of failed places. Compatibility is found by merging the two tokens'
text again, and remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format
LEAST = float("-inf")
#: Longer chunks aren't remembered.
LONG = 48


class Recent(dict):
    """Remembers what `find` gives for the last `bound` to 2 * `bound` keys at least, and no more."""

    def __init__(self, find, bound: int):
        super().__init__()
        self.find, self.bound, self.old = find, bound, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.find(key)
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else 4 if kind == 5 else 8
        yield tag >> 3, raw[at : at + size]
        at += size


class PieceModel:
    """A BPE model of the sentencepiece format with byte fallback and without a normalisation table."""

    def __init__(self, raw: bytes):
        self.pieces: list[str] = []
        self.types: list[int] = []
        scores: list[float] = []
        norm = {3: 1, 4: 1, 5: 1}  # dummy prefix, removal of extra white space, white space as the space mark
        trainer: dict = {}
        for number, value in _fields(raw):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f.get(1, b"").decode())
                scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                self.types.append(f.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                norm |= dict(_fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
            raise ValueError("only BPE models with byte fallback are supported")
        if norm.get(2) or norm[4] or not norm[5]:
            raise ValueError("only models with identity normalisation are supported")
        self.prefix = SPACE if norm[3] else ""
        self.bos, self.eos = (self.pieces.index(p) for p in ("<s>", "</s>"))
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.types[i] == NORMAL}
        self.score = {p: scores[i] for p, i in self.ids.items()}
        self.surfaces = [bytes([self.byte_of[i]]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN) else p.replace(SPACE, " ").encode() for i, (p, k) in enumerate(zip(self.pieces, self.types, strict=True))]
        if USER in self.types:
            raise ValueError("models with pieces defined by a user are not supported")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces with a space mark after other characters are not supported")
        self.own_line = not any("\n" in p for p in self.ids)
        self.chunk = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n+|[^{SPACE}\n]+" if self.own_line else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.matcher = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if self.merged(p) == [p]:
                self.matcher.add_word(p, (len(p), i))
        self.matcher.make_automaton()
        self.fits = Recent(lambda pair: self.compatible(*pair), 400_000)
        self.known = Recent(self.chunk_ids, 250_000)

    def merged(self, text: str) -> list[str]:
        """Merging by the definition: the best scored neighbours first, the leftmost of equals."""
        parts = list(text)
        scores = [self.score.get(a + b, LEAST) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > LEAST:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = self.score.get(parts[i - 1] + parts[i], LEAST)
            if i < len(scores):
                scores[i] = self.score.get(parts[i] + parts[i + 1], LEAST)
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether the tokens a and b stay as they are side by side; characters without a piece (below 0) always do."""
        if a < 0 or b < 0:
            return True
        left, right = self.pieces[a], self.pieces[b]
        return self.merged(left + right) == [left, right]

    def backtracked(self, text: str) -> list[int]:
        """Ids of `text`, which has space marks for spaces; -1 - code point for characters without a piece."""
        n, fits = len(text), self.fits
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.matcher.iter(text):
            starts[end - match[0] + 1].append(match)  # by size, as ends ascend
        for at, found in enumerate(starts):
            if not found or found[0][0] > 1:
                found.insert(0, (1, -1 - ord(text[at])))
        failed = bytearray(n // 8 + 1)
        tokens: list[int] = []
        taken: list[tuple[int, int]] = []
        at, pick = 0, len(starts[0]) - 1
        while at < n:
            found = starts[at]
            while pick >= 0:
                size, i = found[pick]
                end = at + size
                if not failed[end >> 3] >> (end & 7) & 1 and (not tokens or fits[tokens[-1], i]):
                    break
                pick -= 1
            if pick >= 0:
                tokens.append(i)
                taken.append((at, pick))
                at = end
                pick = len(starts[at]) - 1 if at < n else -1
            else:
                if not tokens:
                    raise ValueError("no valid sequence of tokens")
                failed[at >> 3] |= 1 << (at & 7)
                tokens.pop()
                at, pick = taken.pop()
                pick -= 1
        return tokens

    def chunk_ids(self, text: str) -> tuple[bytes, bytes]:
        """Ids (little-endian, 32 bits each) and decoded bytes of one chunk."""
        ids: list[int] = []
        for i in self.backtracked(text):
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(self.bytes[b] for b in chr(-1 - i).encode())
        return struct.pack(f"<{len(ids)}I", *ids), self.surface(ids)

    def surface(self, ids) -> bytes:
        return b"".join(map(self.surfaces.__getitem__, ids))

    def encode(self, text: str) -> tuple[bytes, str]:
        """All ids with begin and end as little-endian 32-bit integers, and their decoded text."""
        if not text:
            return np.array([self.bos, self.eos], "<u4").tobytes(), ""
        known = self.known
        parts = [known[c] if len(c) <= LONG else self.chunk_ids(c) for c in self.chunk.findall(self.prefix + text.replace(" ", SPACE))]
        ids = b"".join([struct.pack("<I", self.bos), *[p[0] for p in parts], struct.pack("<I", self.eos)])
        out = b"".join([p[1] for p in parts])
        return ids, out[1 if self.prefix and out[:1] == b" " else 0 :].decode("utf-8", "replace")

    def decode(self, ids) -> str:
        """The text of any ids, control tokens left out; bytes that are no UTF-8 become U+FFFD."""
        out = self.surface(int(i) for i in ids)
        return out[1 if self.prefix and out[:1] == b" " else 0 :].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel(f.read())


def encode_pieces(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """`docs` with `ids` (binary: little-endian unsigned 32-bit ids with begin and end) and `decoded` (their text).

    `path` is a model file that every executor can open. Columns of these two names in `docs` are replaced. A null
    or empty text has the begin and the end id alone and decodes to the empty text. Memory is bounded by an Arrow
    batch and by the fixed sizes of the chunk and pair tables. Rows are independent; any may be repeated.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("ids", "decoded")
    names, at = docs.columns, docs.columns.index(text_col)

    def encoded(batches):
        m = model(path)
        for batch in batches:
            pairs = [m.encode(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.string())], [*names, "ids", "decoded"])

    return docs.mapInArrow(encoded, T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]))
