"""The pipeline's stages keep the contract of their columns and take effect."""

import corpus_pipeline
from wikiloom.llm.queries import oracle_sql, queries


def test_names():
    names = list(queries())
    assert [n.split("_")[0] for n in names[:10]] == [f"op{i}" for i in range(1, 11)] and "pipeline" in names
    assert set(oracle_sql()) <= set(names)


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids, n = None, docs.count()
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, docs, sf)
        if name != "shard":
            assert out.columns == docs.columns
        got = [r.doc_id for r in out.select("doc_id").collect()]
        assert ids is None or set(got) <= set(ids)
        ids = got
        docs = out if name != "shard" else docs
    assert 0 < len(set(ids)) < n
