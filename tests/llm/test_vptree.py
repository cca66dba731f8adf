import numpy as np

from entigraph.llm import vptree


def frame(spark, a, ids=None):
    return spark.createDataFrame([(int(i), None if v is None else [float(x) for x in v]) for i, v in zip(range(len(a)) if ids is None else ids, a, strict=True)], "vec_id long, embedding array<double>")


def found(rows):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in rows.collect()}


def test_ties_go_to_the_smaller_ids(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(-1, 2, (700, 6)).astype(float)  # few products, so that most are equal
    out = found(vptree.nearest(frame(spark, a), frame(spark, a[::50], range(0, 700, 50)), k=7, factor=1.0, shard_rows=300))
    usable = np.flatnonzero(a.any(1))
    for q in range(0, 700, 50):
        want = sorted((-float(a[q] @ a[i]), int(i)) for i in usable if i != q)[:7] if a[q].any() else []
        assert [out.get((q, r)) for r in range(1, 8)] == [(i, -s) for s, i in want] + [None] * (7 - len(want))


def test_recall_at_the_factor_in_use(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(6000, 32))
    out = found(vptree.nearest(frame(spark, a), frame(spark, a[::100], range(0, 6000, 100)), k=20, shard_rows=3000))
    s = a[::100] @ a.T
    s[np.arange(60), np.arange(0, 6000, 100)] = -np.inf
    want = [set(np.argsort(-x)[:20].tolist()) for x in s]
    hits = sum(out[q * 100, r][0] in want[q] for q in range(60) for r in range(1, 21))
    assert hits >= 0.95 * 60 * 20


def test_copies_and_repeated_ids(spark):
    one, two = [1.0, 0.0], [0.0, 1.0]
    rows = frame(spark, [one] * 40 + [two, one, None, [0.0, 0.0], [float("nan"), 1.0]], [*range(40), 50, 50, 60, 61, 62])
    out = found(vptree.nearest(rows, rows.filter("vec_id in (0, 50, 60)"), k=3, factor=1.0))
    assert out == {(0, 1): (1, 1.0), (0, 2): (2, 1.0), (0, 3): (3, 1.0), (50, 1): (0, 1.0), (50, 2): (1, 1.0), (50, 3): (2, 1.0)}
