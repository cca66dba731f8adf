import json

import pytest

from entigraph import cli, config, sinks
from entigraph.registry import SourceRegistry, default_sources
from entigraph.sources import directories as D
from entigraph.sources import web


def test_agency_index(spark):
    page = '<main><h2>A</h2><h3><a href="/x">Access Board</a></h3><p>Does <b>good</b><a href="https://www.usa.gov/a">no</a></p><p><a href="https://b.gov">site</a></p><h3>Lone</h3></main>'
    pages = spark.createDataFrame([(0, "u0", page), (1, "u1", "<h3>access  board!</h3><p>again</p><h4>Other</h4><p>text</p>"), (2, "u2", None)], "page_no long, url string, html string")
    rows = {r.source_name: r for r in D.agency_index(pages).collect()}
    assert set(rows) == {"Access Board", "Other"}
    assert (rows["Access Board"].source_url, rows["Access Board"].website) == ("https://www.usa.gov/x", "https://b.gov")
    assert (rows["Other"].source_record_id, rows["Other"].description) == ("u1#other", "text")


def test_agency_list(spark):
    payload = json.dumps({"results": [{"id": 1, "name": "A", "child_agencies": [{"slug": "b", "raw_name": "B"}]}, {"name": "C"}]})
    rows = D.agency_list(spark.createDataFrame([(payload,), (None,)], "payload string")).orderBy("rec_idx").collect()
    assert [(r.source_record_id, r.source_name, r.parent_source_name, r.source_level) for r in rows] == [("1", "A", "", "agency"), ("b", "B", "A", "subagency"), ("C", "C", "", "agency")]


def test_agency_list_of_any_depth(spark):
    deep = {"name": "L0", "slug": "l0", "children": []}
    node = deep
    for i in range(1, 40):
        node["children"] = [{"raw_name": f"L{i}", "id": 0, "slug": f"l{i}", "url": f"u{i}", "child_agencies": []}, {"name": f"X{i}", "id": f"x{i}"}]
        node = node["children"][0]
    payloads = [(json.dumps([deep, {"name": "last", "children": None, "child_agencies": [{"name": "leaf"}]}]),), ("{}",), ("no json",), ("[3, null, []]",)]
    rows = D.agency_list(spark.createDataFrame(payloads, "payload string").coalesce(1)).filter("source_name <> ''").orderBy("rec_idx").collect()
    assert [r.source_name for r in rows] == [*[f"L{i}" for i in range(40)], *[f"X{i}" for i in range(39, 0, -1)], "last", "leaf"]
    assert [r.parent_source_name for r in rows][1:4] == ["L0", "L1", "L2"] and rows[-1].parent_source_name == "last"
    assert (rows[5].source_record_id, rows[5].source_url, rows[40].source_record_id) == ("l5", "u5", "x39")


def test_manual(spark):
    df = spark.createDataFrame([('<a href="/app/details/P.1/P.1-7">x</a> P.1-9', "P.1"), ("P.1-2 and P.1-1, P.1-2", "P.1"), (None, "P.1")], "html string, package string")
    assert [r[0] for r in df.select(D.granules_from_page("html", "package")).collect()] == [["P.1-7"], ["P.1-1", "P.1-2"], []]
    assert df.select(D.granules_from_xml("html", "package")).collect()[1][0] == ["P.1-1", "P.1-2"]
    api = spark.createDataFrame([('{"count": 2, "data": {"items": [{"granule_id": "g"}, 3, {"id": 4}]}}',), ("[]",)], "payload string")
    assert sorted(r.granule_id for r in D.granules_from_api(api).collect()) == ["4", "g"]
    html = "<div>Section</div><div>Executive / Boards / X</div><div>Government Organization</div><div>{}</div>"
    pages = spark.createDataFrame([("P", "P-1", "2025", html.format("NIST")), ("P", "P-2", "2025", html.format("Offices / Boards")), ("P", "P-3", "2025", "")], "package_id string, granule_id string, publication_date string, html string")
    details = D.manual_details(pages)
    assert [(r.branch, r.section_category, r.record_kind, r.is_entity_candidate) for r in details.collect()] == [("Executive", "Boards / X", "organization", True), ("Executive", "Boards / X", "grouping_heading", False), ("", "", "organization", False)]
    assert [r.source_name for r in D.manual_records(details).collect()] == ["NIST"]


def test_inventory_and_statutory(spark):
    rows = D.inventory(spark.createDataFrame([("D", "A"), ("D", "A"), ("D", "D"), ("E", None)], "Department string, Agency string")).collect()
    assert sorted(r.source_record_id for r in rows) == ["agency:D:A", "department:D", "department:E"]
    base = spark.createDataFrame([("s", "1", "N", "u")], "source string, source_record_id string, source_name string, source_url string")
    more = spark.createDataFrame([("s", "1", "M", "u"), ("s", "2", "M", "u")], base.schema)
    assert sorted(r.source_name for r in D.append_statutory(base, more).collect()) == ["M", "N"]
    with pytest.raises(Exception, match="blank source_name"):
        D.append_statutory(base, spark.createDataFrame([("s", "3", " ", "u")], base.schema)).collect()


def test_registry():
    known = SourceRegistry()
    known.register("b", "k", len)
    known.register("a", "k", len)
    assert known.names() == ["a", "b"] and known.get("a") is len
    with pytest.raises(ValueError):
        known.register("a", "k", len)
    with pytest.raises(KeyError):
        known.get("c")
    assert "usagov" in default_sources().names()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], 'x "y"\nz'), (2, [], None)], "i int, l array<string>, t string")
    assert sinks.write_csv(df, f"file://{tmp_path}/t.csv", 1) == 2
    assert sinks.write_csv(df.orderBy("i").repartition(3), f"file://{tmp_path}/t3.csv") == 2 and sinks.write_csv(df.filter("false"), f"file://{tmp_path}/none.csv") == 0
    back = spark.read.csv(f"file://{tmp_path}/t.csv", header=True, multiLine=True, escape='"').orderBy("i").collect()
    assert (back[0].l, back[0].t) == ("a|b", 'x "y"\nz')
    posts = sinks.post_table(spark.createDataFrame([("Access Board", "access board")], "canonical_name string, normalized_name string"))
    assert posts.columns[:2] == ["post_title", "post_slug"] and posts.first().post_slug == "access-board"


def test_a_failed_body_leaves_no_file(tmp_path):
    save = web.Folder(f"file://{tmp_path}/s")
    assert save("a", b"x") == f"file://{tmp_path}/s/a"
    with pytest.raises(TypeError):
        save("b", 3)
    assert [f.name for f in (tmp_path / "s").iterdir()] == ["a"]


def test_commands(tmp_path, capsys):
    assert cli.main(["--out", str(tmp_path), "doctor"]) == 0
    (tmp_path / "s.json").write_text('{"sources": {"opm_fwd": {"enabled": false}}, "resolution": {"review_threshold": 70}}')
    assert cli.main(["--config", str(tmp_path / "s.json"), "sources"]) == 0
    out = capsys.readouterr().out
    assert "opm_fwd: disabled (workforce_organization_hierarchy)" in out and "usagov: enabled (organization_directory)" in out
    settings = config.load(tmp_path / "s.json")
    assert settings["resolution"] == {"review_threshold": 70} and config.load()["sources"]["opm_fwd"]["enabled"]
    (tmp_path / "pyproject.toml").touch()
    (deep := tmp_path / "a/b").mkdir(parents=True)
    assert config.project(deep) == config.project(tmp_path) == tmp_path.resolve()
    with pytest.raises(FileNotFoundError):
        config.load(tmp_path / "none.json")
    with pytest.raises(SystemExit):
        cli.main([])


def test_command_flows(spark, tmp_path):
    """Organizations, then programs on top of the written registry."""
    out = f"file://{tmp_path}/out"
    (tmp_path / "s.csv").write_text(
        "source,source_record_id,source_name,source_url,website,description,parent_source_name,source_level,branch\n"
        "USA.gov Agency Index,1,Agriculture Department (USDA),u,https://usda.gov,,,organization,\nFederal Register Agencies API,2,Department of Agriculture,u,,,,agency,\n"
        "Federal Register Agencies API,3,Farm Service Agency,u,,,Department of Agriculture,subagency,\n"
    )
    (tmp_path / "l.csv").write_text('Program Title,Program Number,Federal Agency (030),Authorization (040),Objectives (050)\nFarm Aid,10.1,"FARM SERVICE AGENCY, AGRICULTURE, DEPARTMENT OF",7 U.S.C. 1926,Helps farms\n')
    assert cli.main(["--out", out, "organizations", "--source-csv", f"file://{tmp_path}/s.csv"]) == 0
    assert cli.main(["--out", out, "programs", "--sam-csv", f"file://{tmp_path}/l.csv", "--skip-treasury", "--skip-performance", "--skip-uscode"]) == 0
    summary = json.loads("\n".join(r.value for r in spark.read.text(f"{out}/program_pipeline_summary.json").collect()))
    assert (summary["canonical_programs"], summary["program_authorities"], summary["organizations_without_programs"]) == (1, 1, 1)
    organizations = spark.read.csv(f"{out}/organizations.csv", header=True)
    assert sorted(r.canonical_name for r in organizations.collect()) == ["Department of Agriculture", "Farm Service Agency"]
