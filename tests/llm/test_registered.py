"""Every registered query: oracle or shape, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from stockroom.llm import queries

SF0001 = "/root/testdata/sf0.001"
TABLES = ["documents", "conversations", "labels", "embeddings", "benchmark"]


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    frame, rel = queries.QUERIES[name](spark, SF0001), con.execute(queries.ORACLES[name])
    columns = sorted(d[0] for d in rel.description)
    assert sorted(frame.columns) == columns
    at = [[d[0] for d in rel.description].index(c) for c in columns]

    def norm(row):
        return tuple(round(v, 9) if isinstance(v, float) else v for v in row)

    assert sorted((norm(r) for r in frame.select(columns).collect()), key=repr) == sorted((norm(r[i] for i in at) for r in rel.fetchall()), key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF0001).cache()
        assert kept.columns == columns
        now = {r["doc_id"] for r in kept.collect()}
        assert now and now <= ids
        docs, ids = kept, now
    rows = corpus_pipeline.run(spark, SF0001).collect()
    assert {r["doc_id"] for r in rows} == ids
    assert len(rows) == docs.count() and all(r["piece_ids"] for r in rows if r["text"])
