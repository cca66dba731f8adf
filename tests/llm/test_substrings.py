import hashlib
import random

import pytest

from entigraph.llm import substrings

SCHEMA = "doc_id long, text string, n_words string"


def brute(rows, width):
    """What each (id, text) loses, in the order given."""
    seen, out = set(), []
    for _, t in rows:
        words, gone = (t or "").split(), set()
        for s in range(len(words) - width + 1):
            window = tuple(words[s : s + width])
            if window in seen:
                gone.update(range(s, s + width))
            seen.add(window)
        out.append(" ".join(w for j, w in enumerate(words) if j not in gone))
    return out


@pytest.mark.parametrize("width", [1, 5, 8, 71, 90])
def test_every_width(spark, width):
    rng = random.Random(width)
    passage = [f"w{rng.randrange(60)}" for _ in range(120)]
    rows = [(i, " ".join([f"a{i}_{j}" for j in range(rng.randrange(12))] + passage[rng.randrange(30) :] + [f"z{rng.randrange(9)}" for _ in range(40)])) for i in range(12)]
    out = {r.doc_id: r.text for r in substrings.drop_repeats(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), width=width).collect()}
    assert [out[i] for i in range(12)] == brute(rows, width)


def test_texts_that_share_an_id_lose_their_own_words(spark):
    passage, others = " ".join(f"p{i}" for i in range(30)), " ".join(f"q{i}" for i in range(40))
    rows = [(1, passage), (2, f"z {passage} tail"), (2, others), (2, others), (3, others), (None, passage), (None, passage), (4, None), (4, "")]
    out = [(r.doc_id, r.text, r.n_removed) for r in substrings.drop_repeats(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    first = min((f"z {passage} tail", others), key=digest)
    # the other text of document 2 stands behind document 3
    behind = first != others
    want = [(1, passage, 0), (2, "z tail", 30), *[(2, "" if behind else others, 40 if behind else 0)] * 2, (3, others if behind else "", 0 if behind else 40), (None, passage, 0), (None, passage, 0), (4, "", 0), (4, "", 0)]
    assert sorted(out, key=str) == sorted(want, key=str)


def test_a_frequent_row_is_one_document(spark):
    text = " ".join(f"p{i}" for i in range(50))
    rows = [(7, text)] * 500 + [(8, text + " end"), (9, "x " * 5000)]
    out = substrings.drop_repeats(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    assert len(out) == 502 and {(r.doc_id, r.n_removed) for r in out} == {(7, 0), (8, 50), (9, 4999)}
