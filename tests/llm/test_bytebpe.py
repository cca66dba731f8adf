import base64
import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from entigraph.llm import bytebpe, queries

PATH = queries.tokenizer_file("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
WORDS = regex.compile(public_tokenizers.PATTERN)


def same(texts):
    got = bytebpe.model(PATH).encode(texts, WORDS)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == LIBRARY.encode_ordinary_batch(texts)
    assert bytebpe.model(PATH).decode(got) == [t.encode() for t in texts]


def test_random_texts_like_the_library():
    rng = random.Random(7)
    pieces = ["the", "ción", "中文字", "\U0001f600", "\n\n", "  ", "\t", "'s", "'LL", "x1", "１２", "é", "é", "\x00", "\xa0", "　", "ﬁ", "İ", "<|endoftext|>", "http://a.b/c?d=e&f", "....", "QqZz"]
    same(["".join(rng.choice(pieces) if rng.random() < 0.5 else chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xD7FF), rng.randrange(0x10000, 0x20000)])) for _ in range(rng.randrange(60))) for _ in range(3000)])


def test_every_character_splits_like_the_library():
    same([f"a{chr(c)}1 {chr(c)}{chr(c)} b" for c in range(0x3400) if not 0xD800 <= c < 0xE000])
    same([f"a{chr(c)}1 {chr(c)}" for c in [*range(0xA000, 0xD800, 9), *range(0xE000, 0x20000, 3), *range(0x3D000, 0x3D010)]])
    same([f"a{chr(c)}1 {chr(c)}" for c in (0x558, 0x3D000)])  # seen before


def test_long_words_like_the_library():
    rng = random.Random(3)
    same(["a" * 5001, "ab" * 3000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4000)), "".join(rng.choice("etaoinshr") for _ in range(3000)), "é" * 999, "中国" * 500, " " * 3000, "=" * 777, ""])


@pytest.mark.parametrize("rounds", [1, 10_000])
def test_rounds_in_several_queries(monkeypatch, rounds):
    monkeypatch.setattr(bytebpe, "ROUND_ROWS", rounds)
    monkeypatch.setattr(bytebpe, "START_ROWS", 40)
    same(["unbelievably internationalisation of counterrevolutionaries", "x" * 100, "yes"])


def test_ranks_that_merge_out_of_order():
    """A pair made by a merge may have a lower rank than the merge had."""
    tokens = [*(bytes([b]) for b in range(256)), b"bca", b"ab", b"abc", b"bc", b"abab", b"cab", b"aa", b"aaa"]
    m = bytebpe.RankModel(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(tokens)))
    library = tiktoken.Encoding("x", pat_str=r"(?s:.+)", mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 150))) for _ in range(800)]
    got = m.encode(texts, regex.compile("(?s:.+)"))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode_ordinary(t) for t in texts]


def test_rows_nulls_and_clashing_columns(spark):
    rows = [(1, "one\ntwo", "mine", "x"), (1, "one\ntwo", "mine", "x"), (None, None, "mine", "x"), (2, "", "mine", None), (3, "wörd " * 30_000, "mine", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string").withColumnRenamed("decoded", "w")
    out = bytebpe.encode_ranked(df, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "w", "ids", "decoded"]
    for r in out.collect():
        assert bytes(r.decoded) == (r.text or "").encode() and np.frombuffer(bytes(r.ids), "<u4").tolist() == LIBRARY.encode_ordinary(r.text or "")
    again = bytebpe.decode_ranked(out.drop("decoded"), PATH).collect()
    assert [bytes(r.decoded) for r in again] == [(r.text or "").encode() for r in again]
    assert bytebpe.encode_ranked(df.filter("false"), PATH, public_tokenizers.PATTERN).count() == 0


def test_query_like_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op12_byte_bpe(spark, sf).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(texts[r.doc_id].encode()).hexdigest())
