"""The mix reads texts a second time only for equal rows that it takes unlike often."""

from collections import Counter

import corpus_pipeline


def test_odd_rows_alone_are_read_again(spark, monkeypatch):
    names, stage = [], corpus_pipeline.stage
    monkeypatch.setattr(corpus_pipeline, "stage", lambda df, name, *more: names.append(name) or stage(df, name, *more))
    unlike = [(i, " ".join([f"w{i}"] * (3 + i % 5)), "en", f"s{i % 3}") for i in range(60)]
    equal = [(None, " ".join(["same"] * 10), "en", "s0")] * 7
    for rows, staged in ((unlike, ["plan"]), (unlike + equal, ["plan", "odd"])):
        names.clear()
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
        got = corpus_pipeline.mix(spark, docs, "").collect()
        assert names == staged
        took = Counter()
        for r in got:
            took[r.source] += len(r.text.split())
        want = corpus_pipeline.mix_to_targets(docs).groupBy("source").sum("taken").collect()
        assert took == Counter({r[0]: r[1] for r in want})
