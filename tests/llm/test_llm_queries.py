"""Registered queries of the text operators against their SQL, and over many partitions with adaptive plans."""

import os

import duckdb
import pytest

from entigraph.llm import lexical, manifest, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{SF}/{f}{'/*' if os.path.isdir(f'{SF}/{f}') else ''}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    out = queries.QUERIES[name](spark, SF)
    cols = sorted(out.columns)
    found = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in out.collect()))) == sorted(map(repr, (tuple(r[names.index(c)] for c in cols) for r in found.fetchall())))


@pytest.fixture
def wide(spark):
    session = spark.newSession()
    for key, value in {"shuffle.partitions": "9", "adaptive.enabled": "true", "adaptive.coalescePartitions.enabled": "false", "autoBroadcastJoinThreshold": "-1", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "adaptive.skewJoin.skewedPartitionFactor": "1.1", "files.maxPartitionBytes": "64k"}.items():
        session.conf.set(f"spark.sql.{key}", value)
    return session


def test_one_source_over_many_partitions(spark, wide):
    docs = wide.read.parquet(f"{SF}/documents.parquet").repartition(7).selectExpr("doc_id", "if(doc_id % 9 = 0, source, 'hot') as source", "lang", "n_chars", "text")
    plain = {r.doc_id: r for r in manifest.manifest(spark.createDataFrame(docs.collect(), docs.schema)).collect()}
    rows = manifest.manifest(docs, high=2).collect()
    assert len(rows) == len(plain) and all(r == plain[r.doc_id] for r in rows)


def test_searches_over_many_shards(spark, wide, monkeypatch):
    want = sorted(map(tuple, queries.op11_ranked_search(spark, SF).collect()))
    monkeypatch.setattr(lexical, "BROADCAST_BYTES", 0)
    docs, items = wide.read.parquet(f"{SF}/documents.parquet").repartition(7), wide.read.parquet(f"{SF}/benchmark.parquet")
    with lexical.scratch(wide) as tmp:
        index = tmp.save(lexical.build_index(docs, shard_tokens=5000), "index")
        assert index.filter("term is null").count() > 9
        assert sorted(map(tuple, lexical.search(index, items).collect())) == want
