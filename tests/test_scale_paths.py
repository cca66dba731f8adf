"""The same results where rows are dealt over many partitions and Spark plans anew at run time."""

import random

import pytest

from entigraph.functions.similarity import token_set_ratio
from entigraph.operators import graph
from entigraph.operators import organizations as O
from entigraph.operators.similar import name_form, similar_forms
from tests.test_graph import replay, unions
from tests.test_organizations import opm, records


@pytest.fixture
def wide(spark):
    session = spark.newSession()
    for key, value in {
        "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }.items():
        session.conf.set(key, value)
    return session


def test_unions_of_a_hub(wide):
    rng = random.Random(8)
    records = [(i, f"c{rng.randrange(3)}" if i % 5 == 0 else "", rng.choice(["", "p", "q"])) for i in range(150)]
    pairs = [(f"k{rng.randrange(9)}", 0, i) for i in range(1, 100)] + [(f"k{rng.randrange(30):02}", *sorted(rng.sample(range(150), 2))) for _ in range(120)]
    assert unions(wide, records, pairs) == replay(records, pairs)


def test_one_large_group_of_names(wide):
    rng = random.Random(9)
    names = [" ".join(rng.choice(["health", "aid", "rural", "energy", "research", "state", "grants"]) for _ in range(rng.randrange(1, 5))) + rng.choice(["", "s", " i", " ii"]) for _ in range(150)]
    rows = [("hot" if i % 6 else "cold", n) for i, n in enumerate(names)]
    forms = sorted({(g, " ".join(sorted(set(n.split())))) for g, n in rows})
    want = {(g, a, b) for g, a in forms for h, b in forms if g == h and a < b and token_set_ratio(a, b) >= 88}
    out = similar_forms(wide.createDataFrame(rows, "g string, name string").select("g", name_form("name").alias("form")), 88)
    assert {(r.g, r.a, r.b) for r in out.collect()} == want


def test_components_of_a_long_chain(wide):
    order = random.Random(2).sample(range(300), 300)
    edges = wide.createDataFrame(list(zip(order, order[1:])), "a long, b long")  # noqa: B905
    assert {r.root for r in graph.connected_components(wide.range(300), edges).collect()} == {0}


def test_parents_that_many_records_name(wide):
    rows = [{"source": "USA.gov", "source_name": "Department of Many"}] + [{"source": "X", "source_record_id": str(i), "source_name": f"Office {i % 40} of Things", "parent_source_name": "Department of Many"} for i in range(120)]
    out = O.resolve(records(wide, *rows))
    assert out["organization_relationships"].select("parent_org_id").distinct().count() == 1
    assert out["organization_relationships"].count() == out["organizations"].count() - 1 > 30


def test_ordered_tables(wide):
    names = ["beta Board", "Alpha Council", "alpha Agency", "Gamma Office (GO)", "Delta, Bureau of"]
    out = O.resolve(records(wide, *[{"source": "USA.gov", "source_record_id": str(i), "source_name": n} for i, n in enumerate(names)]))
    got = [(r.canonical_name.lower(), r.external_id) for r in out["organizations"].collect()]
    assert got == sorted(got) and len(got) == 5
    aliases = [(r.organization_id, r.alias.lower(), r.alias_type) for r in out["organization_aliases"].collect()]
    assert aliases == sorted(aliases) and ("GO" in {r.alias for r in out["organization_aliases"].collect()})


def test_same_names_get_their_codes_and_overrides_their_last_name(wide):
    """Collisions are told apart by the subagency's code; of two overrides of one pair the last one's name counts; a pair that is kept apart is no candidate."""
    same = [opm("subagency", "AA", "A1", "A101", "Office of Audit", "Alpha"), opm("subagency", "BB", "B1", "B101", "Office of Audit", "Beta")]
    out = O.resolve(records(wide, *same))["organizations"].collect()
    assert len({r.external_id for r in out}) == 2 and {r.canonical_name for r in out} == {"Office of Audit"}
    two = [{"source": "USA.gov", "source_name": "Old Grain Board"}, {"source": "Federal Register", "source_name": "New Seed Agency"}]
    asked = wide.createDataFrame([(0, "Old Grain Board", "New Seed Agency", "merge", "First Name"), (1, "Old Grain Board", "New Seed Agency", "merge", "Last Name"), (2, "Nobody", "Old Grain Board", "merge", "x")], "o_idx int, left_name string, right_name string, decision string, preferred_name string")
    (row,) = O.resolve(records(wide, *two), asked)["organizations"].collect()
    assert (row.canonical_name, row.source_record_count, row.resolution_status) == ("Last Name", 2, "Reviewed merge")
