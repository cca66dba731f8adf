import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from entigraph.sources import programs as S
from entigraph.sources.parsers import section_pieces, section_texts, sheet_rows


def test_agency_labels(spark):
    cases = {
        "AGRICULTURAL RESEARCH SERVICE, AGRICULTURE, DEPARTMENT OF": ("Department of Agriculture", "Agricultural Research Service"),
        "BUREAU OF LAND MANAGEMENT, INTERIOR, DEPARTMENT OF THE": ("Department of the INTERIOR", "Bureau Of Land Management"),  # one word of up to eight capitals counts as an acronym
        "NATIONAL SCIENCE FOUNDATION, NATIONAL SCIENCE FOUNDATION": ("", "National Science Foundation"),
        "U.S. AGENCY FOR GLOBAL MEDIA, BBG, U.S. AGENCY FOR GLOBAL MEDIA, BBG": ("", "U.S. Agency For Global Media"),
        "Dept Of The Army, Dept Of Defense": ("Department of Defense", "Department of the Army"),
        "Washington Headquarters Services (Whs), Dept Of Defense": ("Department of Defense", "Washington Headquarters Services"),
        "THE EXPORT-IMPORT BANK (EXIM)": ("", "Export-Import Bank"),
        "BARRY GOLDWATER SCHOLARSHIP AND EXCELLENCE IN EDUCATION FUND": ("", "Barry Goldwater Scholarship and Excellence in Education Foundation"),
        "NASA": ("", "NASA"),
        " , ": ("", ""),
        None: ("", ""),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i long, v string")
    found = df.select("i", S.agency_parts("v").alias("p")).orderBy("i").collect()
    assert [tuple(r.p) for r in found] == list(cases.values())


def test_listings_from_json(spark):
    listing = {
        "assistanceListingId": "10.1", "title": " Farm Aid ", "status": "Active", "federalOrganization": {"department": "AGRICULTURE", "departmentCode": "012"},
        "overview": {"objective": "Help.", "functionalCodes": [{"code": "A1", "name": "Farms"}]},
        "authorizations": {"list": [{"USC": {"title": "7", "section": "1926"}, "publicLaw": {"congressCode": 92, "number": "1"}}, {"act": {"description": "Aid Act"}}]},
    }
    pages = spark.createDataFrame([(json.dumps({"assistanceListingsData": [{"title": "no id"}, listing]}), "http://x"), ("{}", "http://x")], "payload string, source_url string")
    programs, authorities, functions = (x.collect() for x in S.listings_from_json(pages))
    assert [(p.source_record_id, p.source_name, p.source_url, p.department_source_code) for p in programs] == [("10.1", "Farm Aid", "http://x", "012")]
    assert programs[0].function_raw == '[{"code": "A1", "name": "Farms"}]' and programs[0].mission_category_raw == ""
    assert sorted((a.authority_sequence, a.authority_citation) for a in authorities) == [(1, "7 U.S.C. 1926; Pub. L. 92-1"), (2, "Aid Act")]
    assert [(f.source_key, f.function_code) for f in functions] == [("sam_functional_index", "A1")]


def test_listings_from_table(spark, tmp_path):
    text = 'Program Title,Program Number,Popular Name (020),Federal Agency (030),Authorization (040),Objectives (050),Functional Index,URL\n"Aid, ""big""\nplan",10.2,,"FARM SERVICE AGENCY, AGRICULTURE, DEPARTMENT OF","7 U.S.C. 1926, 42 USC §§ 9a",Help,A; B|C,\n,10.3,,,,,,\n'
    (tmp_path / "l.csv").write_text(text)
    programs, authorities, functions = (x.collect() for x in S.listings_from_table(S.read_table(spark, f"file://{tmp_path}/l.csv"), "http://d"))
    (p,) = programs
    assert (p.rec_idx, p.source_name, p.department_source_name, p.agency_source_name, p.source_url) == (2, 'Aid, "big"\nplan', "Department of Agriculture", "Farm Service Agency", "http://d")
    assert sorted((a.authority_sequence, a.usc_title, a.usc_section, a.authority_citation) for a in authorities) == [(1, "7", "1926", "7 U.S.C. 1926"), (2, "42", "9a", "42 USC §§ 9a")]
    assert sorted(f.function_name for f in functions) == ["A", "B", "C"]
    with pytest.raises(ValueError):
        S.listings_from_table(spark.createDataFrame([(2, "x")], "rec_idx long, other string"))


def test_archives_and_supplements(spark):
    t = spark.createDataFrame([(2, "P1", "", "d"), (3, "", "c", ""), (4, "P2", "c2", None)], "rec_idx long, `Program Name` string, Code string, Description string")
    assert [(r.source_record_id, r.source_status) for r in S.archive_from_table(t).collect()] == [("row:2", "historical"), ("c2", "historical")]
    assert [(r.source, r.source_record_id) for r in S.supplement_from_table(t.drop("Code"), "s.csv").collect()] == [("s.csv", "row:2"), ("s.csv", "row:4")]
    html = "<table><tr><th>Program<br>Name<th>Purpose</tr><tr><td>A</td><td>to</td></tr><tr><td></td></tr></table><table><tr><th>Other</th></tr><tr><td>x</td></tr></table>"
    rows = S.archive_from_pages(spark.createDataFrame([("http://p", html, "Agency")], "url string, html string, agency string"), agency="agency").collect()
    assert [(r.source_record_id, r.source_name, r.source_description, r.agency_source_name) for r in rows] == [("table:1:row:2", "A", "to", "Agency")]


def workbook(rows) -> bytes:
    cell = lambda v: f"<c t='inlineStr'><is><t>{v}</t></is></c>" if isinstance(v, str) else f"<c><v>{v}</v></c>"
    m, out = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook xmlns='{m}' xmlns:r='http://schemas.openxmlformats.org/officeDocument/2006/relationships'><sheets><sheet name='T1' r:id='r1'/></sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<x><Relationship Id='r1' Target='worksheets/sheet1.xml'/></x>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet xmlns='{m}'><sheetData>" + "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in rows) + "</sheetData></worksheet>")
    return out.getvalue()


def test_tax_expenditures(spark):
    raw = workbook([["Tax Expenditures"], ["National Defense:"], [1, "Exclusion of benefits", 5], ["Energy"], [2, "Credit for wells", 7], ["1. Exclusion of benefits and allowances"]])
    rows = S.tax_expenditures(spark.createDataFrame([(2026, "u", bytearray(raw))], "fiscal_year int, source_url string, content binary")).collect()
    assert [(r.source_record_id, r.source_name, r.function_raw) for r in rows] == [("FY2026:1", "Exclusion of benefits and allowances", "Energy"), ("FY2026:2", "Credit for wells", "Energy")]


def test_workbook_is_read_row_by_row():
    rows = sheet_rows(workbook([[str(i), i] for i in range(5000)]))
    assert next(rows) == (0, "T1", 1, ["0", "0"]) and sum(1 for _ in rows) == 4999
    assert list(sheet_rows(None)) == []


def test_provisions(spark):
    cases = [
        (["12", " Exclusion  of pay "], ("12", "Exclusion of pay", "")), (["a", "b", "c", "Deduction", "7"], ("", "", "")), (["x", "7", "Deduction for it"], ("7", "Deduction for it", "")),
        (["13) Credit for x"], ("13", "Credit for x", "")), (["Energy:"], ("", "", "Energy")), (["Fiscal Year 2026"], ("", "", "")), (["5", "Total:", "1,234"], ("", "", "")), ([], ("", "", "")),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, cells array<string>")
    assert [tuple(r.p) for r in df.select("i", S.provision(F.col("cells")).alias("p")).orderBy("i").collect()] == [w for _, w in cases]


def test_sections_within_sections(spark):
    xml = "<t><!-- <section> --><x:section id='a>b'><num>1</num><heading>A &amp; <b>B</b></heading>one <quoted><section><num>Sec. 2.</num>in<p>ner</p></section></quoted> two</x:section>tail<section><num>&#167; 3</num></section></t>"
    out = section_texts(section_pieces(spark.createDataFrame([("7", xml), ("8", None), ("9", "<t/>")], "t string, xml string"))).orderBy("position").collect()
    assert [(r.t, r.section, r.heading, r.text) for r in out] == [("7", "2", "", "Sec. 2. in ner"), ("7", "1", "A & B", "1 A & B one two"), ("7", "3", "", "§ 3")]


def test_statute_enrichment(spark):
    xml = "<usc xmlns='n'><section><num>§ 1234</num><heading>Aid</heading><p>Some fact. It is the purpose of this to help; No more.</p></section><section><num>§ 9.</num></section></usc>"
    auth = spark.createDataFrame([(0, "7", "Sec. 1234"), (1, "7", "77"), (2, "", "")], "auth_idx long, usc_title string, usc_section string")
    out = S.enrich_authorities(auth, spark.createDataFrame([("7", xml)], "usc_title string, xml string")).orderBy("auth_idx").collect()
    assert [r.statutory_lookup_status for r in out] == ["matched", "not_matched", "no_exact_usc_citation"]
    assert (out[0].statutory_purpose_text, out[0].statutory_purpose_method) == ("It is the purpose of this to help;", "statutory_signal_text")
    one = lambda v: tuple(spark.range(1).select(S.purpose_candidate(F.lit(v)).alias("p")).first().p)
    assert one(" ") == ("", "not_found") and one("Nothing here.") == ("", "section_found_no_purpose_signal")
