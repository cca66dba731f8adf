import math
import random
import re

import numpy as np
import pytest

from entigraph.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k):
    held = [(i, split(t)) for i, t in docs if split(t)]
    n, length = len(held), sum(len(ws) for _, ws in held)
    df = {}
    for _, ws in held:
        for t in set(ws):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(split(text))
    out = []
    for item, own in asked.items():
        scores = []
        for i, ws in held:
            m = 50 + (50 * len(ws) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * ws.count(t) // (1000 * ws.count(t) + 20 * m)) for t in own if t in ws)
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ñandú", "naïve", "X9", "ÀB"]
    text = lambda m: " ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=m))
    docs = [(i * 7 - 50, text(rng.randint(0, 60))) for i in range(n)]
    docs += [(docs[3][0], docs[3][1]), (docs[4][0], "w1 w2 w3"), (None, text(30)), (10**17, None), (-(2**62), "w5, w6"), (2**62, "W5; w6"), (900001, ""), (900002, " \n.,"), (900003, "w50 " * 3000)]
    rng.shuffle(docs)
    items = [(i, text(rng.randint(1, 12))) for i in range(8)] + [(3, "w9 w59"), (None, "w7 Ñandú"), (100, None), (101, ""), (102, "nowhere"), (103, "ñandú À"), (-1, "w0")]
    return docs, items


@pytest.mark.parametrize(("k", "shard", "blocks"), [(50, 2_000_000, 1024), (5, 300, 2), (3, 1, 1), (1000, 900, 1024)])
def test_search_like_brute_force(spark, monkeypatch, k, shard, blocks):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", blocks)
    docs, items = corpus(k, 150)
    table = spark.createDataFrame([(i, t, "a", "b") for i, t in docs], "doc_id long, text string, term string, shard string").repartition(3)
    with lexical.scratch(spark) as tmp:
        index = tmp.save(lexical.build_index(table, shard_tokens=shard), "index")
        rows = lexical.search(index, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int"), k)
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, brute_force(docs, items, k)))


def test_larger_than_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BROADCAST_BYTES", 0)
    docs, items = corpus(9, 60)
    rows = lexical.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, brute_force(docs, items, 4)))


def test_empty_tables(spark):
    none, docs = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items, no_items = spark.createDataFrame([(1, "a")], "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert lexical.ranked(none, items).count() == 0 and lexical.ranked(docs, no_items).count() == 0
    assert [tuple(r)[:3] for r in lexical.ranked(docs, items).collect()] == [(1, 1, 1)]


def test_varints():
    rng = random.Random(1)
    values = np.array([rng.randrange(2 ** rng.randrange(1, 64)) for _ in range(500)] + [0, 127, 128, 2**63 - 1], np.uint64)
    data, sizes = lexical.varints(values)
    assert len(data) == sizes.sum() and (lexical.from_varints(data.tobytes()).view(np.uint64) == values).all()
    assert len(lexical.from_varints(b"")) == 0
