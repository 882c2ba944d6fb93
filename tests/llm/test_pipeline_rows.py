"""The pipeline's filters on documents that share an id or have none."""

import random
from collections import Counter

import corpus_pipeline


def test_shared_and_null_ids(spark, tmp_path):
    rng = random.Random(6)
    text = lambda n: " ".join("w%d" % rng.randrange(5000) for _ in range(n))
    a, b, c, d, leak = text(80), text(80), text(80), text(80), text(30)
    near = "changed " + a.split(" ", 1)[1]
    rows = [(5, a), (4, near), (None, a), (None, b), (None, b), (None, c), (9, c), (7, d), (7, text(60)), (7, d), (8, None), (None, None)]
    docs = spark.createDataFrame([(*r, i % 2) for i, r in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(4, near), (None, b), (9, c), (7, d), (7, rows[8][1]), (8, None), (None, None)])

    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"{a} {leak}"), (1, b), (None, f"{c} {leak}"), (None, d)]
    got = corpus_pipeline.decontaminate(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    assert Counter(map(tuple, got.collect())) == Counter([rows[1], rows[3]])
