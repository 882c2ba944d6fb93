"""Line dedup of rows that share an id or have none: each is a document of its own."""

from collections import Counter

from wikiloom.llm.line_dedup import line_dedup


def test_shared_and_null_ids(spark):
    rows = [(None, "a\nb\nc"), (None, "x\ny\na\nb"), (None, "u1\nu2\nu3\nu4"), (None, "same\nplace"), (None, "same\nplace"), (7, "p\nq\nr"), (7, "s\nt\np\nq"), (8, "a\nb\nk"), (9, "v\nw"), (9, "v\nw")]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    kept = Counter((r.doc_id, r.kept_text) for r in got)
    assert len(got) == len(rows) and sum(r.n_removed for r in got) == 2 + 2 + 2 + 2 + 2
    # Unique lines stay whatever stands at their place in rows of the same id; one copy of each run stays.
    assert kept[(None, "u1\nu2\nu3\nu4")] == 1 and kept[(8, "k")] == 1
    for run in ("a\nb", "same\nplace", "p\nq", "v\nw"):
        assert sum(n for (_, t), n in kept.items() if run in t) == 1
    assert Counter(line for r in got for line in r.kept_text.split("\n") if line) == Counter({line for _, t in rows for line in t.split("\n")})
