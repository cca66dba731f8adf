from pyspark.sql import functions as F

from entigraph.operators import programs


def test_programs_flow(spark):
    records = spark.createDataFrame(
        [
            (0, "sam_assistance", "10.1", "Rural Aid", "", "Farm Agency", "Agriculture Department", "Helps farms.", "active"),
            (1, "performance_fpi_archive", "x", "Rural Aid", "", "Farm Agency", "", "", "historical"),
            (2, "supplemental", "row:2", "Lost Program", "Audit Office", "", "Beta", "", ""),
            (3, "supplemental", "row:3", "Unknown Program", "Nowhere Office", "", "", "", ""),
        ],
        "rec_idx long, source_key string, source_record_id string, source_name string, office_source_name string, agency_source_name string, department_source_name string, agency_stated_purpose string, source_status string",
    )
    authorities = spark.createDataFrame([(0, "sam_assistance", "10.1", "7", "1926", "It is the purpose to help.")], "auth_idx long, source_key string, program_source_record_id string, usc_title string, usc_section string, statutory_purpose_text string")
    functions = spark.createDataFrame([("sam_assistance", "10.1", "A1", "Farms")], "source_key string, program_source_record_id string, function_code string, function_name string")
    orgs = spark.createDataFrame([("ORG-F", "Farm Agency"), ("ORG-A", "Audit Office"), ("ORG-B", "Audit Office"), ("ORG-C", "Idle Board")], "external_id string, canonical_name string")
    aliases = spark.createDataFrame([("ORG-F", "Farm Service")], "organization_id string, alias string")
    sources = spark.createDataFrame([("ORG-A", "Audit Office", "Alpha"), ("ORG-B", "Audit Office", "Beta")], "canonical_external_id string, source_name string, parent_source_name string")
    out = {k: v.collect() for k, v in programs.resolve(records, authorities, functions, orgs, aliases, sources).items()}
    by_name = {r.canonical_name: r for r in out["programs"]}
    aid = by_name["Rural Aid"]
    assert (aid.source_count, aid.canonical_purpose_type, aid.primary_organization_id) == (2, "statutory", "ORG-F")
    assert by_name["Lost Program"].primary_organization_id == "ORG-B"
    assert [r.issue for r in out["organization_mapping_review_queue"]] == ["no_exact_organization_match"]
    assert [r.canonical_name for r in out["programs_without_organizations"]] == ["Unknown Program"]
    assert {r.organization_id for r in out["organizations_without_programs"]} == {"ORG-A", "ORG-C"}
    assert {r.program_id for r in out["program_authorities"]} == {r.program_id for r in out["program_functions"]} == {aid.program_id}


def test_a_name_of_many_organizations_is_looked_up_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(programs, "reliable", lambda df, keep=programs.reliable: written.append(keep(df)) or written[-1])
    names = [("Shared Office", ""), ("Shared Office", "Parent 7"), ("Lone Office", "Parent 7"), ("", ""), ("Nowhere", "")]
    rows = [(i, "supplemental", str(i), f"P {i}", *names[i % 5], "") for i in range(100)]
    records = spark.createDataFrame(rows, "rec_idx long, source_key string, source_record_id string, source_name string, agency_source_name string, department_source_name string, office_source_name string")
    sources = spark.createDataFrame([(f"O{i:02}", "Shared Office", f"Parent {i}") for i in range(30)] + [("L", "Lone Office", "Parent 7")], "canonical_external_id string, source_name string, parent_source_name string")
    orgs, aliases = sources.select(F.col("canonical_external_id").alias("external_id"), F.col("source_name").alias("canonical_name")), spark.createDataFrame([], "organization_id string, alias string")
    out, review = programs.map_organizations(records, programs.organization_index(orgs, aliases, sources))
    method = "exact_agency_name_or_alias"
    want = {0: ("", ""), 1: ("O07", "agency_name_or_alias_with_parent"), 2: ("L", method), 3: ("", ""), 4: ("", "")}
    assert {r.rec_idx: (r.organization_id, r.organization_mapping_method) for r in out.collect()} == {i: want[i % 5] for i in range(100)}
    several, every = "ambiguous_exact_organization_match", "|".join(f"O{i:02}" for i in range(30))
    told = {r.program_source_key.split("::")[1]: (r.issue, r.organization_source_name, r.organization_source_level, r.candidate_organization_ids) for r in review.collect()}
    none = "no_exact_organization_match"
    assert told == {str(i): {0: (several, "Shared Office", "agency", every), 3: (none, "", "", ""), 4: (none, "Nowhere", "", "")}[i % 5] for i in range(100) if i % 5 in (0, 3, 4)}
    held = sum(df.agg(F.coalesce(F.sum(sum((F.size(c) for c, kind in df.dtypes if kind.startswith("array")), F.lit(0))), F.lit(0))).first()[0] for df in written)
    assert held < 100  # arrays of organizations that tables hold: none for each record
