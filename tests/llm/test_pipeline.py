"""The pipeline end to end on the smallest table, and the registered queries."""

import duckdb

import corpus_pipeline
from strata.llm.registry import QUERIES
from strata.plans.registry import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents").cache()
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and left <= ids and len(left) > 0.8 * len(ids), name
        ids = left
    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == ids
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(pieces)


def test_oracles(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "embeddings"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, reg in QUERIES.items():
        if reg.oracle:
            got = reg.build(spark, SF).toPandas()
            want = db.execute(reg.oracle).df()
            columns = sorted(got.columns)
            assert columns == sorted(want.columns), name
            rows = [sorted(map(str, t[columns].astype(object).where(t[columns].notna(), None).itertuples(index=False, name=None)))
                    for t in (got, want)]
            assert rows[0] == rows[1], name


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
