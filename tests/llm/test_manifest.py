import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from entigraph.llm import manifest

FIELDS = "doc_id long, source string, lang string, n_chars int, text string, leaf string, idx string, __tree string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree(leaves):
    """The root, and for each leaf the siblings before and after it, by the definition."""
    level, at, out = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for path, k in zip(out, at, strict=True):
            first = k - k % 3
            path.append(("".join(level[first:k]), "".join(level[k + 1 : first + 3])))
        level, at = [h(*level[i : i + 3]) for i in range(0, len(level), 3)], [k // 3 for k in at]
    return level[0], out


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs, found = [], {}
    for s in order:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        found[s] = (own, *tree([leaf(r) for r in own]))
        subs.append(found[s][1])
    root, above = tree(subs)
    return [(r[0], leaf(r), p + a, found[s][1], root) for s, a in zip(order, above, strict=True) for r, p in zip(found[s][0], found[s][2], strict=True)]


def rows_of(seed, n, sources):
    rng = random.Random(seed)
    out = [(i * 3, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 5]), rng.choice(["a\nb", "", None, "ñ\n\n" * 9]), "l", "i", "t") for i in range(n)]
    return [*out, out[0], out[0], (None, None, None, None, None, "", "", ""), (None, "src1", None, None, "x", "", "", ""), (0, "src1", "en", 1, "two of one id", "", "", "")]


@pytest.mark.parametrize(("n", "sources", "high"), [(120, ["src1", "src0", "", "ß", None], 2), (90, ["src1"], 1), (40, [f"s{i}" for i in range(30)], 7)])
def test_manifest_like_brute_force(spark, n, sources, high):
    rows = rows_of(n, n, sources)
    out = manifest.manifest(spark.createDataFrame(rows, FIELDS), high=high).collect()
    got = [(r.doc_id, r.leaf, [tuple(s) for s in r.proof], r.subroot, r.root) for r in out]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(rows)))


def test_tampered_rows_do_not_verify(spark):
    rows = rows_of(5, 50, ["a", "b"])
    df = spark.createDataFrame(rows, FIELDS)
    other = manifest.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], F.replace("text", F.lit("\n"), F.lit("")))
    out = manifest.manifest(df, carried={"other": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, other), "t": F.col("text")})
    for r in out.withColumn("root_found", manifest.folded(F.coalesce("other", "leaf"), "proof")).collect():
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (r.t or "")
        assert (r.root_found == r.root) != changed


def test_empty_and_lone_rows(spark):
    none = manifest.manifest(spark.createDataFrame([], FIELDS))
    assert none.columns == ["doc_id", "leaf", "proof", "subroot", "root"] and none.count() == 0
    (r,) = manifest.manifest(spark.createDataFrame([(7, None, None, None, "x" * 100_000, "", "", "")], FIELDS)).collect()
    assert r.leaf == r.subroot == r.root and r.proof == []


def test_stacks_are_done_in_time_and_stay_small():
    leaves = [h(str(i)) for i in range(3**6)]
    late = []
    real = manifest.Treehash.finish

    def finish(self):
        late.append(self.end - self.at if self.nodes or self.stack else 0)
        return real(self)

    manifest.Treehash.finish = finish
    try:
        held = [sum(len(b) for b in p) for p in manifest.paths(leaves, 6)]
    finally:
        manifest.Treehash.finish = real
    assert not any(late) and max(held) <= 6 * 12
