"""Line dedup against its definition by longest common prefixes, and against its SQL, for several depths."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest

from wikiloom.llm import common
from wikiloom.llm.line_dedup import line_dedup
from wikiloom.llm.queries import line_dedup_sql


def make_rows() -> list[tuple]:
    rng = random.Random(4)
    lines = ["", "a", "b", "c d", "e f g", "one two three four five six seven", "x y z w v"]
    out = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 12)))) for i in range(25)]
    long = [f"line {i} " + "word " * (i % 4) for i in range(40)]
    out += [(30, "\n".join(long)), (31, "\n".join(["start", *long[3:30], "end"])), (32, "\n".join(long[10:14])), (33, None), (34, ""), (35, "alone in here")]
    return out + [(36, "\n".join(long)), (37, "p1\np2\np3\np4\np5\np6"), (38, "p2\np3\np4\np5\np6\np7"), (39, "q\nq\nq\nq\nq\nq\nq\nq\nq")]


ROWS = make_rows()


def brute(rows, m, w):
    """Each suffix's longest prefix that also stands earlier: it goes if it has m lines, and its first line if that has w words."""
    docs = [(d, [] if t is None else t.split("\n")) for d, t in sorted(rows)]
    places = [(x, i) for x, (_, ls) in enumerate(docs) for i in range(len(ls))]
    out = {}
    for x, (d, ls) in enumerate(docs):
        gone = set()
        for i in range(len(ls)):
            longest = 0
            for y, j in places:
                if (y, j) >= (x, i):
                    break
                n, other = 0, docs[y][1]
                while i + n < len(ls) and j + n < len(other) and ls[i + n] == other[j + n]:
                    n += 1
                longest = max(longest, n)
            if longest >= m:
                gone |= set(range(i, i + longest))
            elif longest and len(ls[i].split()) >= w:
                gone.add(i)
        kept = None if dict(rows)[d] is None else hashlib.sha256("\n".join(s for i, s in enumerate(ls) if i not in gone).encode()).hexdigest()
        out[d] = (len(ls), len(gone), sum(i - 1 not in gone for i in gone), kept)
    return out


@pytest.mark.parametrize(("m", "w"), [(2, 7), (3, 6), (5, 12), (2, 1000), (1, 5)])
def test_runs(spark, monkeypatch, m, w):
    monkeypatch.setattr(common, "HOT_KEYS", 20)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, None if r.kept_text is None else hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in line_dedup(docs, m, w).collect()}
    want = brute(ROWS, m, w)
    assert got == want
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", ROWS)
    assert {r[0]: r[1:] for r in con.execute(line_dedup_sql(m, w)).fetchall()} == want


def test_edges(spark):
    schema = "doc_id long, text string, pos int, p int, r long, depth int, later int"
    rows = [(None, "again and again", 1, 2, 3, 4, 5)] * 3 + [(1, "w " * 60, 1, 2, 3, 4, 5), (2, "w " * 60, 1, 2, 3, 4, 5), (3, "long\n" * 30000, 1, 2, 3, 4, 5)]
    got = line_dedup(spark.createDataFrame(rows, schema)).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == Counter({(None, 0): 3, (1, 0): 1, (2, 1): 1, (3, 29999): 1})
    assert line_dedup(spark.createDataFrame([], schema)).count() == 0
