"""The pipeline's stages on empty tables, equal rows without ids, nulls everywhere and columns whose names clash."""

from collections import Counter

import corpus_pipeline
from wikiloom.llm.mixing import mix_to_targets

EXTRA = "row string, _key long, _hash long, _source string, n int, _copies int, _row long, shard int"
SCHEMA = f"doc_id long, text string, lang string, source string, {EXTRA}"


def rows_of(*docs):
    return [(*d, "r", 1, 2, "s", 3, 4, 5, 6) for d in docs]


def test_mix_deals_equal_rows(spark):
    words = lambda n, w: " ".join([w] * n)
    docs = [(None, words(10, "same"), "en", "s0")] * 6 + [(i, words(3 + i % 5, f"w{i}"), "en", f"s{i % 3}") for i in range(60)] + [(7, words(9, "x"), "en", "s1"), (7, words(9, "x"), "en", "s2")]
    df = spark.createDataFrame(rows_of(*docs), SCHEMA).repartition(4)
    want = {r.source: r.taken for r in mix_to_targets(df).groupBy("source").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "taken").collect()}
    target = {r.source: r.target for r in mix_to_targets(df).select("source", "target").distinct().collect()}
    out = corpus_pipeline.mix(spark, df, "")
    assert out.columns == df.columns
    got = out.collect()
    assert Counter(r.source for r in got for _ in r.text.split()) == want
    assert all(abs(want[s] - target[s]) <= 1.5 for s in want)
    assert max(Counter((r.doc_id, r.text, r.source) for r in got if r.doc_id is not None).values()) <= 3
    assert Counter(map(tuple, corpus_pipeline.mix(spark, df, "").collect())) == Counter(map(tuple, got))


def test_stages_on_edges(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, None), (2, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    long = " ".join(f"word{i % 977}" for i in range(60000))
    docs = rows_of((None, None, None, None), (None, None, None, None), (1, "", "en", None), (2, " \n\t", None, "s"), (3, long, "en", "s"), (3, long, "en", "s"), (4, "one two three four five six seven eight nine ten", "en", "t"), (None, "one two three four five six seven eight nine ten", "en", "t"))
    df = spark.createDataFrame(docs, SCHEMA)
    got = corpus_pipeline.near_dedup(spark, df, sf)
    assert got.columns == df.columns
    assert Counter((r.doc_id, (r.text or "")[:9]) for r in got.collect()) == Counter([(None, ""), (1, ""), (2, " \n\t"), (3, "word0 wor"), (4, "one two t")])
    got = corpus_pipeline.decontaminate(spark, df, sf)
    assert got.columns == df.columns and Counter(r.doc_id for r in got.collect()) == Counter({None: 2, 1: 1, 2: 1, 3: 2})
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, sf)
        assert out.count() == 0 and (name == "shard" or out.columns == empty.columns)
