"""Constrained unions against a replay of their definition, pair by pair."""

import random

import pytest

from entigraph.operators import graph


def replay(records, pairs):
    group, codes = {i: {i} for i, _, _ in records}, {i: {(c, p)} if c else set() for i, c, p in records}
    of, out, seen = {i: i for i, _, _ in records}, [], set()
    for k, a, b in sorted(pairs):
        if (a, b) in seen or of[a] == of[b]:
            seen.add((a, b))
            continue
        seen.add((a, b))
        x, y = of[a], of[b]
        apart = [(p, q) for p in codes[x] for q in codes[y] if p[0] != q[0]]
        if apart:
            out.append((a, b, "distinct_opm_subagency_codes", "manual_review" if any(p[1] and p[1] == q[1] for p, q in apart) else "deterministic_separate"))
            continue
        for i in group[y]:
            of[i] = x
        group[x] |= group.pop(y)
        codes[x] |= codes.pop(y)
        out.append((a, b, f"deterministic_alias_key:{k}", "auto_merge"))
    return sorted((i, min(group[of[i]])) for i in of), sorted(out)


def unions(spark, records, pairs):
    roots, decided = graph.constrained_union(spark.createDataFrame(records, "id long, code string, parent string"), spark.createDataFrame(pairs, "key string, left long, right long"))
    return sorted(map(tuple, roots.collect())), sorted(map(tuple, decided.collect()))


@pytest.mark.parametrize(("seed", "n", "links", "codes"), [(1, 60, 90, 4), (2, 80, 70, 12), (3, 40, 160, 2), (4, 70, 110, 30), (5, 50, 60, 0), (6, 90, 200, 3)])
def test_random_graphs_like_the_replay(spark, seed, n, links, codes):
    rng = random.Random(seed)
    records = [(i, f"c{rng.randrange(codes)}" if codes and rng.random() < 0.4 else "", rng.choice(["", "p", "q", "r"])) for i in range(n)]
    pairs = []
    for _ in range(links):
        a, b = sorted(rng.sample(range(n), 2))
        pairs += [(f"k{rng.randrange(25):02}", a, b) for _ in range(rng.choice([1, 1, 2]))]
    assert unions(spark, records, pairs) == replay(records, pairs)


def test_chains_whose_keys_ascend_and_hubs(spark):
    n = 40
    records = [(i, "x" if i == 0 else "y" if i == n - 1 else "", "p") for i in range(n)] + [(100 + i, "z" if i % 7 == 0 else "", "p" if i % 2 else "") for i in range(30)] + [(500, "lone", "")]
    pairs = [(f"a{i:03}", i, i + 1) for i in range(n - 1)] + [(f"b{i % 3}", 100, 100 + i) for i in range(1, 30)] + [("c", 5, 105)]
    assert unions(spark, records, pairs) == replay(records, pairs)


def test_parents_that_come_later_do_not_count(spark):
    """1-2 is refused before the record that names the other side's parent joins 1, and 2-5 after it has."""
    records = [(1, "a", "p"), (2, "b", "q"), (3, "a", "q"), (5, "", "")]
    pairs = [("k1", 1, 2), ("k2", 1, 3), ("k3", 1, 5), ("k4", 2, 5)]
    assert unions(spark, records, pairs) == replay(records, pairs)
    assert {d[3] for d in unions(spark, records, pairs)[1]} == {"auto_merge", "manual_review", "deterministic_separate"}


def test_no_pairs(spark):
    assert unions(spark, [(1, "a", ""), (2, "", "")], []) == ([(1, 1), (2, 2)], [])
