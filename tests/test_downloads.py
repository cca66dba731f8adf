import io
import json
import zipfile
from urllib.error import HTTPError

import pandas as pd
import pytest

from entigraph import cli
from entigraph.sources import downloads as L
from entigraph.sources import programs as S
from entigraph.sources.paged import Paging, pages


@pytest.fixture
def web(tmp_path):
    def make(pages):
        log = str(tmp_path / "log")

        def fetch(url, max_bytes=0):
            with open(log, "a") as f:
                f.write(url + "\n")
            if isinstance(found := pages[url], int):
                raise HTTPError(url, found, f"HTTP {found}", {}, None)
            return found if isinstance(found, bytes) else found.encode(), "text/html", url

        def calls():
            with open(log) as f:
                return f.read().split()

        return fetch, calls

    return make


def test_agency_index(spark, web, tmp_path):
    fetch, _ = web({"u": "<h3>Access Board</h3><p>x</p>", "u/a": "<h3>Access  board</h3><p>again</p><h3>Bureau</h3><p>’</p>", "u/b": "<p>none</p>", "u/c": 404})
    records, bad = L.agency_index(spark, "u", "abc", f"file://{tmp_path}", fetch)
    assert [(r.source_name, r.description) for r in records.orderBy("rec_idx").collect()] == [("Access Board", "x"), ("Bureau", "’")]
    assert {r.url: r.reason[:12] for r in bad.collect()} == {"u/b": "no records p", "u/c": "HTTPError:HT"}


PACKAGE, XML = "GOV-1", "https://x.gov/GOV-1.xml"
API = "https://api.gov/packages/GOV-1/granules?offset={}&pageSize=2&api_key=K"
DETAIL = "https://www.govinfo.gov/app/details/GOV-1/GOV-1-{}"


def details(*numbers):
    return {DETAIL.format(i): f"<p>Government Organization</p><b>Government Organization</b><p>{'Bureaus' if i == 3 else f'Board {i}'}</p><p>Section</p><p>Executive / Boards</p>" for i in numbers}


def manual(spark, tmp_path, fetch):
    return L.manual(spark, PACKAGE, XML, "2025-12-31", f"file://{tmp_path}", fetch, "https://api.gov", "K", 2, 3)


def listed(*numbers, **more):
    return json.dumps({"granules": [{"granuleId": f"GOV-1-{i}"} for i in numbers], **more})


def test_manual_by_its_list(spark, web, tmp_path):
    fetch, calls = web({XML: "<x/>", API.format(0): listed(5, 1, count="4"), API.format(2): listed(3, 4, count=4), **details(1, 3, 4, 5), DETAIL.format(4): 500})
    records, audit, bad, found = manual(spark, tmp_path, fetch)
    assert [(r.source_name, r.branch, r.govinfo_granule_id, r.source_as_of, len(r.govinfo_package_xml_sha256)) for r in records.orderBy("rec_idx").collect()] == [("Board 5", "Executive", "GOV-1-5", "2025-12-31", 64), ("Board 1", "Executive", "GOV-1-1", "2025-12-31", 64)]
    assert sorted((r.granule_id, r.record_kind) for r in audit.collect()) == [("GOV-1-1", "organization"), ("GOV-1-3", "grouping_heading"), ("GOV-1-5", "organization")]
    assert [r.url for r in bad.collect()] == [DETAIL.format(4)] and (found["method"], found["granule_count"]) == ("govinfo_api", 4)


def test_manual_without_a_total(spark, web, tmp_path):
    fetch, calls = web({API.format(0): listed(1, 2), API.format(2): listed(3, 1), API.format(4): listed()})
    ids = L.listed_granules(spark, PACKAGE, "https://api.gov/", "K", f"file://{tmp_path}", fetch, 2)
    assert [r.granule_id for r in ids.orderBy("at").collect()] == ["GOV-1-1", "GOV-1-2", "GOV-1-3"] and len(calls()) == 3
    fetch, _ = web({API.format(0): listed(1, count=10_001)})
    with pytest.raises(L.DownloadError, match="10000"):
        L.listed_granules(spark, PACKAGE, "https://api.gov", "K", f"file://{tmp_path}", fetch, 2)


def test_manual_falls_back(spark, web, tmp_path):
    fetch, _ = web({XML: "<x id='GOV-1-2'>GOV-1-1</x>", API.format(0): 429, **details(1, 2)})
    records, _, _, found = manual(spark, tmp_path, fetch)
    assert records.count() == 2 and found["method"] == "package_xml_regex" and "refused the key" in found["api_error"]
    fetch, _ = web({XML: "<x/>", API.format(0): listed(), "https://www.govinfo.gov/app/details/GOV-1/context": '<a href="/app/details/GOV-1/GOV-1-7">x</a>', **details(7)})
    assert manual(spark, tmp_path, fetch)[3]["method"] == "context_html_fallback"
    fetch, _ = web({XML: "<x/>", API.format(0): listed(), "https://www.govinfo.gov/app/details/GOV-1/context": ""})
    with pytest.raises(L.DownloadError, match="no granules"):
        manual(spark, tmp_path, fetch)


def test_pages_by_item_by_number_and_onward(spark, web, tmp_path):
    body = lambda n, **more: json.dumps({"data": {"items": list(range(n))}, **more})
    read = lambda paging, fetch, **o: sorted((r.at, r.url) for r in pages(spark, paging, fetch, **o).collect())
    fetch, _ = web({"u0": body(2, count=5), "u2": body(2), "u4": body(1)})
    by_item = Paging("u{}", size=2, totals=("count",))
    assert read(by_item, fetch) == [(0, "u0"), (2, "u2"), (4, "u4")] and pages(spark, by_item, fetch).rdd.getNumPartitions() == 3
    fetch, _ = web({"p1": body(3, totalPages=3), "p2": body(3), "p3": body(0)})
    assert read(Paging("p{}", 1, False, 3, ("totalPages",)), fetch) == [(1, "p1"), (2, "p2"), (3, "p3")]
    assert read(Paging("p{}", 1, False, 3, ("totalPages",), pages=2), fetch) == [(1, "p1"), (2, "p2")]
    fetch, _ = web({"u0": "[1, 2]", "u2": "[3, 4]", "u4": "[5]"})
    assert read(Paging("u{}", size=2), fetch) == [(0, "u0"), (2, "u2"), (4, "u4")] and read(Paging("u{}", size=3), fetch) == [(0, "u0")]
    with pytest.raises(Exception, match="more than 3"):
        read(Paging("u{}", size=2, most=3), fetch)


def test_pages_are_tried_again(spark, tmp_path):
    mark = str(tmp_path / "tried")

    def fetch(url, max_bytes=0):
        with open(mark, "a") as f:
            f.write(url + "\n")
        with open(mark) as f:
            tries = f.read().split().count(url)
        if url == "u1" and tries < 3 or url == "u0" and tries < 2:
            raise OSError("busy")
        if url == "u2":
            raise HTTPError(url, 403, "no", {}, None)
        return b'{"count": 2, "items": [1]}', "", url

    assert pages(spark, Paging("u{}", size=1, totals=("count",)), fetch, wait=0.0).count() == 2
    with pytest.raises(Exception, match="403"):
        pages(spark, Paging("u{}", first=2, size=1), fetch, wait=0.0).count()
    with open(mark) as f:
        assert f.read().split().count("u2") == 1


def test_newest_workforce_table(spark, web, tmp_path):
    raw = io.BytesIO()
    pd.DataFrame([{"Department": "D", "Agency": "A", "Agency Subelement": "AA01-Sub", "Agency Subelement Code": "AA01"}]).to_parquet(raw)
    files = json.dumps([{"dataCapturedThrough": "2026-01", "year": 2026, "month": "January", "version": 1}, {"dataCapturedThrough": "2026-02", "year": 2026, "month": "feb", "version": 3}])
    fetch, _ = web({"f?current=true": files, "d/2026/02/3/download": raw.getvalue()})
    out = L.workforce(spark, "f", "d/", f"file://{tmp_path}", fetch).collect()
    assert [(r.source_record_id, r.source_name, r.data_as_of, r.source_url) for r in out] == [("agency:a", "A", "2026-02", "d/2026/02/3/download"), ("department:d", "D", "2026-02", "d/2026/02/3/download"), ("subagency:AA01", "Sub", "2026-02", "d/2026/02/3/download")]


LIST = "p?api_key=k&status=ALL&pageSize=1&pageNumber={}"


def page(i, total):
    return json.dumps({"totalPages": total, "assistanceListingsData": [{"assistanceListingId": f"10.{i}", "title": f"T{i}"}]})


def test_listings(spark, web, tmp_path):
    bulk = "Program Title,Program Number,Federal Agency (030),Authorization (040),Objectives (050)\nFarm \x93Aid\x94,10.1,X,7 U.S.C. 1926,Helps\n".encode("cp1252", "replace").replace(b"\xc2", b"")
    bulk = bulk.replace("\x93".encode("cp1252", "replace"), b"\x93").replace("\x94".encode("cp1252", "replace"), b"\x94")
    fetch, _ = web({"b": bulk, **{LIST.format(i): page(i, 3) for i in (1, 2, 3)}})
    read = lambda **o: L.listings(spark, "p", f"file://{tmp_path}", fetch, **{"bulk_url": "b", "key": "k", "page_size": 1, **o})
    assert [r.source_record_id for r in read()[0].collect()] == ["10.1"]
    assert [r.source_record_id for r in read(max_pages=2)[0].orderBy("rec_idx").collect()] == ["10.1", "10.2"]
    out = read(bulk_url="missing")[0].orderBy("rec_idx").collect()
    assert [r.source_record_id for r in out] == ["10.1", "10.2", "10.3"] and not any("api_key" in r.source_url for r in out)
    with pytest.raises(L.DownloadError, match="needs a key"):
        read(bulk_url="missing", key="")
    assert S.decoded(b"\x93a\x94") == "“a”" and S.decoded("﻿“".encode()) == "“"


def test_archive(spark, web, tmp_path):
    table = "<table><tr><th>Program Name</th><th>Program Code</th></tr><tr><td>{}</td><td>{}</td></tr></table>"
    main = "https://archive.performance.gov/programs.html"
    links = "<a href='/x/agency1.html'>Agency One Programs</a><a href='/y.html'>About</a><a href='https://other.gov/program'>Program</a><a href='/program-gone'>gone</a><a href='/x/agency1.html'>again</a>"
    fetch, calls = web({main: links + table.format("Main", "1"), "https://archive.performance.gov/x/agency1.html": table.format("One", "2"), "https://archive.performance.gov/program-gone": 404, "csv": "Program Name,Agency\nP,A\n"})
    out = L.archive(spark, main, f"file://{tmp_path}", fetch).collect()
    assert sorted((r.source_record_id, r.source_name, r.agency_source_name) for r in out) == [("1", "Main", ""), ("2", "One", "Agency One Programs")]
    assert sorted(calls()) == sorted([main, "https://archive.performance.gov/x/agency1.html", "https://archive.performance.gov/program-gone"])
    assert [r.source_name for r in L.archive(spark, main, f"file://{tmp_path}/2", fetch, "csv").collect()] == ["P"]


def test_statute_titles(spark, web, tmp_path):
    statute = "<t><section><num>§ {}.</num><heading>H</heading><content>The purpose of this is good.</content></section></t>"
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("usc42.xml", statute.format(1))
    home = "<div><table><tr><td>Title 7</td><td><a href='x/t7.pdf'>PDF</a><a href='x/t7.zip'>XML</a></td></tr></table><p><a href='y/xml_usc42@1.zip'>All of it</a></p></div>"
    fetch, calls = web({"http://c/d.html": home, "http://c/x/t7.zip": statute.format(1926), "http://c/y/xml_usc42@1.zip": z.getvalue()})
    cited = spark.createDataFrame([("7", "1926", 0), ("42", "1", 1), ("99", "3", 2), ("x", "1", 3), ("", "", 4)], "usc_title string, usc_section string, auth_idx long")
    read = lambda: S.enrich_authorities(cited, L.statute_titles(spark, cited, "http://c/d.html", f"file://{tmp_path}", fetch)).orderBy("auth_idx").collect()
    status = ["matched", "matched", "not_matched", "not_matched", "no_exact_usc_citation"]
    assert [r.statutory_lookup_status for r in read()] == status and len(calls()) == 3
    assert [r.statutory_lookup_status for r in read()] == status and len(calls()) == 4  # the folder has both titles; the third is looked for again


def test_commands_download(spark, web, tmp_path):
    """All commands on top of each other, on a web that is a table."""
    (tmp_path / "s.json").write_text(json.dumps({"sources": {
        "usagov": {"base_url": "u", "letters": ""}, "federal_register": {"endpoint": "fr"}, "govinfo_govman": {"enabled": False}, "opm_fwd": {"enabled": False},
        "sam_assistance": {"bulk_url": "bulk"}, "treasury_tax_expenditures": {"enabled": False}, "performance_fpi_archive": {"enabled": False}, "uscode": {"download_page": "http://c/d.html"},
    }}))
    statute = "<t><section><num>1926</num><content>The purpose of this is good.</content></section></t>"
    fetch, _ = web({
        "u": "<h3>Agriculture Department (USDA)</h3><p>x <a href='https://usda.gov'>site</a></p>", "fr": json.dumps([{"id": 1, "name": "Department of Agriculture", "children": [{"id": 2, "name": "Farm Service Agency"}]}]),
        "bulk": 'Program Title,Program Number,Federal Agency (030),Authorization (040),Objectives (050)\nFarm Aid,10.1,"FARM SERVICE AGENCY, AGRICULTURE, DEPARTMENT OF",7 U.S.C. 1926,Helps farms\n',
        "http://c/d.html": "<li>Title 7 <a href='7.xml'>XML</a></li>", "http://c/7.xml": statute, "https://usda.gov/robots.txt": 404,
        "https://usda.gov": "<a href='/apr-2024.pdf'>Annual Performance Report</a>", "https://usda.gov/apr-2024.pdf": b"%PDF-1",
    })
    main = lambda *a: cli.main(["--config", str(tmp_path / "s.json"), "--out", f"file://{tmp_path}/out", "--raw", f"file://{tmp_path}/raw", *a], fetch)
    table = lambda n: spark.read.csv(f"file://{tmp_path}/out/{n}.csv", header=True, multiLine=True, escape='"').collect()
    assert main("organizations") == main("programs") == main("reports", "--download-reports") == 0
    assert sorted(r.canonical_name for r in table("organizations")) == ["Department of Agriculture", "Farm Service Agency"]
    assert [r.statutory_purpose_text for r in table("program_authorities")] == ["1926 The purpose of this is good."]
    (report,) = table("agency_report_sources")
    assert report.download_status == "downloaded" and open(report.snapshot_path.removeprefix("file://"), "rb").read() == b"%PDF-1"
