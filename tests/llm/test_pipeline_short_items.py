"""Decontamination by benchmark items that are shorter than a window."""

import corpus_pipeline


def test_short_items_need_a_share(spark, tmp_path):
    item = "one two three four five six seven eight nine ten"
    spark.createDataFrame([(1, "Paris"), (2, "blue whale"), (3, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "we went to Paris in spring and saw a lot of it"), (2, "the blue whale is large, and Paris is far from it"), (3, "blue whale, Paris"), (4, "it is said that two three four five six seven eight nine are numbers " + "word " * 80), (5, "nothing of it"), (6, None), (7, "two three four five six seven eight")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 5, 6, 7]
