import os

import duckdb
import pytest

from entigraph.functions.similarity import lcs_length, ratio, token_set_ratio
from entigraph.plans.flows import QUERIES, SQL  # those of plans.queries, too
from entigraph.sources import parsers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        p = f"{SF}/{f}" + ("/*" if os.path.isdir(f"{SF}/{f}") else "")
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    out = QUERIES[name](spark, SF)
    cols = sorted(out.columns)
    rows = sorted(map(repr, (tuple(r[c] for c in cols) for r in out.collect())))
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert rows == sorted(map(repr, (tuple(r[names.index(c)] for c in cols) for r in found.fetchall())))


def test_sites_numbered_like_years(spark, tmp_path):
    pages = spark.createDataFrame([(k, "<p>Hello</p>") for k in (4, 0, 1904, 2003, 2004, 2024, 20240, 123456789012345679)], "page_id long, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    for name in ("site_reports", "site_crawl"):
        found = c.execute(SQL[name])
        rows = QUERIES[name](spark, str(tmp_path)).select(*[d[0] for d in found.description]).collect()
        assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, found.fetchall())) and rows


def test_similarities():
    assert lcs_length("kitten", "sitting") == 4
    assert ratio("kitten", "sitting") == pytest.approx(800 / 13)
    assert token_set_ratio("a b c", "c b") == 100.0
    assert token_set_ratio("", "x") == 0.0
    assert 0 < token_set_ratio("national park service", "national forest service") < 100


def test_parsers():
    assert parsers.page_links('<a href="/x">A <b>b</b>\n c</a><a>no</a>') == [("/x", "A b c")]
    assert parsers.page_cells("<table><tr><th>A<th>B</tr><tr><td>1</td><td> 2 </td></tr></table>")[-1] == (1, 2, 2, "2")


def test_organizations_hold_every_source(spark):
    rows = {r.canonical_name: r for r in QUERIES["organizations"](spark, SF).collect()}
    parts = {r.p_name: r.n for r in spark.read.parquet(f"{SF}/part.parquet").groupBy("p_name").count().withColumnRenamed("count", "n").collect()}
    found = {r.canonical_name: r.source_record_count for r in rows.values() if r.sources == "Parts"}
    assert found == parts and max(parts.values()) > 1
    assert {r.sources for r in rows.values()} == {"USA.gov", "Federal Register", "Current Federal", "Parts"}
