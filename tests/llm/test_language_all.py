"""The language model knows every labelled language, and its texts to the end."""

import random
import string

from pyspark.sql import functions as F

from wikiloom.llm.language import fit, identify


def test_more_languages_than_64(spark):
    rng = random.Random(5)
    words = {f"l{i:02}": ["".join(rng.choice(string.ascii_lowercase) for _ in range(6)) for _ in range(12)] for i in range(70)}
    text = lambda x: " ".join(rng.choice(words[x]) for _ in range(60))
    rows = [(100 * i + j, text(x), x) for i, x in enumerate(words) for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, table = fit(df, "doc_id", "text", "lang")
    assert langs == sorted(words) and table.shape[0] == 70
    got = {r.row.doc_id: r for r in identify(df, langs, table, ["doc_id"]).collect()}
    assert all(got[d].lang == x and got[d].accepted for d, _, x in rows)


def test_whole_texts_are_fitted(spark):
    head, tail = "abc def ghi " * 600, "wxyz vwxy uvwx " * 600
    df = spark.createDataFrame([(1, head + tail, "aa"), (2, head + "klmn opqr " * 600, "bb"), (3, "wxyz vwxy uvwx " * 20, None)], "doc_id long, text string, lang string")
    langs, table = fit(df, "doc_id", "text", "lang")
    got = {r.row.doc_id: r for r in identify(df, langs, table, ["doc_id"], declared=F.lit(None)).collect()}
    assert got[3].lang == "aa" and got[3].accepted
