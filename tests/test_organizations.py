import pytest

from entigraph.operators import organizations as O

FIELDS = ["source", "source_record_id", "source_name", "source_url", "website", "description", "parent_source_name", "source_level", "branch"]
OPM = "OPM Federal Workforce Data"


def records(spark, *rows):
    extra = ["opm_department_code", "opm_agency_code", "opm_subagency_code", "source_as_of"]
    cols = ["rec_idx", *FIELDS, *extra]
    data = [(i, *(str({"source": "A", "source_record_id": str(i)} .get(c, "") if c not in r else r[c]) for c in cols[1:])) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "rec_idx long, " + ", ".join(f"{c} string" for c in cols[1:]))


def resolved(spark, *rows, overrides=None):
    if overrides:
        overrides = spark.createDataFrame([(i, *o) for i, o in enumerate(overrides)], "o_idx int, left_name string, right_name string, decision string, preferred_name string")
    return O.resolve(records(spark, *rows), overrides)


def opm(level, dept, agency="", sub="", name="", parent=""):
    code = {"department": dept, "agency": agency, "subagency": sub}[level]
    return {"source": OPM, "source_record_id": f"{level}:{code}", "source_name": name, "source_level": level, "parent_source_name": parent, "opm_department_code": dept, "opm_agency_code": agency, "opm_subagency_code": sub}


@pytest.mark.parametrize(
    ("left", "right"),
    [
        ("Federal Trade Commission", "Federal Trade Commission"),
        ("Administration for Children and Families (ACF)", "Administration for Children and Families"),
        ("Access Board", "U.S. Access Board"),
        ("Economic Analysis, Bureau of", "Bureau of Economic Analysis"),
        ("Agriculture Department (USDA)", "Department of Agriculture"),
        ("Refugee Resettlement Office", "Office of Refugee Resettlement"),
    ],
)
def test_equal_names_merge(spark, left, right):
    out = resolved(spark, {"source": "USA.gov", "source_name": left}, {"source": "Federal Register", "source_name": right})
    rows = out["organizations"].collect()
    assert len(rows) == 1 and rows[0].source_record_count == 2
    assert out["organization_sources"].count() == 2
    assert out["organization_name_review"].count() == 0


def test_parent_edge_and_acronym_alias(spark):
    out = resolved(
        spark,
        {"source": "USA.gov", "source_name": "Department of Health and Human Services (HHS)"},
        {"source": "X", "source_name": "Department of Health and Human Services"},
        {"source": "X", "source_name": "Administration for Children and Families (ACF)", "parent_source_name": "Department of Health and Human Services"},
    )
    assert out["organizations"].count() == 2
    assert out["organization_relationships"].count() == 1
    kinds = {(r.alias, r.alias_type) for r in out["organization_aliases"].collect()}
    assert ("ACF", "source_acronym") in kinds and ("HHS", "source_acronym") in kinds
    status = {r.found_in_usagov for r in out["organization_status"].collect()}
    assert status == {True, False}


def test_structural_unit_is_one_organization(spark):
    out = resolved(spark, opm("department", "FM", name="Federal Mediation and Conciliation Service"), opm("agency", "FM", "FM", name="Fed Mediation & Conc Serv", parent="Federal Mediation and Conciliation Service"), opm("subagency", "FM", "FM", "FM00", "Federal Mediation"))
    assert out["organizations"].count() == 1
    assert out["organization_relationships"].count() == 0
    assert out["organization_review_queue"].count() == 0


def test_codes_keep_subagencies_apart(spark):
    apart = resolved(spark, opm("subagency", "AA", "A1", "A101", "Office of Audit", "Alpha"), opm("subagency", "BB", "B1", "B101", "Office of Audit", "Beta"))
    assert apart["organizations"].select("external_id").distinct().count() == 2
    assert [r.decision for r in apart["organization_candidates"].collect()] == ["deterministic_separate"]
    assert apart["organization_review_queue"].count() == 0
    asked = resolved(spark, opm("subagency", "AA", "A1", "A101", "Office of Audit", "Alpha"), opm("subagency", "AA", "A1", "A102", "Office of Audit", "Alpha"))
    assert [r.reasons for r in asked["organization_review_queue"].collect()] == ["distinct_opm_subagency_codes"]
    assert {r.resolution_status for r in asked["organizations"].collect()} == {"Needs review"}


def test_bridge_by_a_directory_name_keeps_codes_apart(spark):
    out = resolved(spark, opm("subagency", "AA", "A1", "A101", "Office of Audit"), opm("subagency", "BB", "B1", "B101", "Audit Office"), {"source": "USA.gov", "source_name": "Office of Audit"})
    assert out["organizations"].count() == 2


def test_overrides(spark):
    old, new = {"source": "USA.gov", "source_name": "Bureau of Old Things"}, {"source": "Federal Register", "source_name": "Agency for New Matters"}
    out = resolved(spark, old, new, overrides=[("Bureau of Old Things", "Agency for New Matters", "historical_alias", "Agency for New Matters")])
    (row,) = out["organizations"].collect()
    assert (row.canonical_name, row.resolution_status, row.canonical_name_authority_tier) == ("Agency for New Matters", "Reviewed merge", "human_review")
    assert out["organization_review_queue"].count() == 0
    near = [{"source": "USA.gov", "source_name": "Maritime Safety Service North"}, {"source": "X", "source_name": "Maritime Safety Service South"}]
    assert resolved(spark, *near)["organization_review_queue"].count() == 1
    kept = resolved(spark, *near, overrides=[("Maritime Safety Service North", "Maritime Safety Service South", "keep_separate", "")])
    assert {r.resolution_status for r in kept["organizations"].collect()} == {"Reviewed separate"}
    assert kept["organization_review_queue"].count() == 0


def test_manual_name_wins_and_disagreement_is_asked(spark):
    merge = [("Alpha Board", "Board of Beta", "merge", "")]
    both = [{"source": "USA.gov", "source_name": "Alpha Board"}, {"source": OPM, "source_name": "Board of Beta", "source_level": "agency"}]
    out = resolved(spark, *both, overrides=merge)
    (row,) = out["organizations"].collect()
    assert (row.canonical_name, row.canonical_name_status) == ("Board of Beta", "Fallback provisional - naming review")
    assert out["organization_name_review"].count() == 1
    manual = {"source": "U.S. Government Manual", "source_name": "Alpha Board", "source_as_of": "2026"}
    (row,) = resolved(spark, *both, manual, overrides=[("Alpha Board", "Board of Beta", "merge", "Other")])["organizations"].collect()
    assert (row.canonical_name, row.canonical_name_authority_tier) == ("Alpha Board", "govinfo_govman")


def test_domain_or_acronym_alone_is_no_candidate(spark):
    out = resolved(
        spark,
        {"source": "A", "source_name": "Administration for Children and Families", "website": "https://acf.example.gov"},
        {"source": "B", "source_name": "Office of Child Care", "website": "https://www.acf.example.gov/occ"},
        {"source": "A", "source_name": "Central Command (CENTCOM)"},
        {"source": "B", "source_name": "Commodity Credit Corporation"},
    )
    assert out["organization_review_queue"].count() == 0 and out["organizations"].count() == 4
