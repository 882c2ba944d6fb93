"""Each stage of the pipeline, and op3's posteriors, against brute force on a fixture with planted copies, leaks, short items and null ids."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wikiloom.llm.language import BUCKETS, _buckets, fit, identify

ITEM = "kelp lamp mint nose oval pear quiz rose sand tulip urn vase".split()
BENCH = [(1, " ".join(ITEM)), (2, "kelp"), (3, "lamp mint"), (4, None)]


def make_rows() -> list[tuple]:
    rng = random.Random(8)
    vocab = {x: ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(400)] for x, letters in (("en", "abcdefghijkl"), ("de", "mnopqrstuvwx"))}
    text = lambda x, n: " ".join(rng.choice(vocab[x]) for _ in range(n))
    out = [(i, text(x, rng.randint(40, 120)), x, f"s{i % 3}.example.{x}") for i in range(60) for x in [("en", "de")[i % 2]]]
    ws = text("en", 100).split()
    out += [(100 + i, " ".join([*ws[: 20 * i], f"abc{'abcd'[i]}", *ws[20 * i + 1 :]]), "en", "s1.example.en") for i in range(4)]
    out += [(110, out[3][1], "de", "s0.example.de"), (None, out[4][1], "en", "s0.example.en"), (None, out[6][1] + " abc", "en", None), (3, text("de", 70), "de", "s1.example.de")]
    copy = text("de", 50)
    out += [(None, copy, "de", None), (None, copy, "de", None), (None, text("en", 50), None, "s2.example.en")]
    for i, part in enumerate((ITEM[:8], ITEM[2:11], ITEM[:7], ["kelp"], ["lamp", "mint"])):
        out.append((120 + i, " ".join([text("en", 60), *part, text("en", 40)]), "en", "s2.example.en"))
    out += [(None, " ".join([text("en", 60), *ITEM]), "en", "s2.example.en"), (130, "kelp kelp " + text("en", 2), "en", "s2.example.en"), (140, None, "en", None), (141, "", None, None), (142, "12 34", "de", "s0.example.de"), (143, "zyzy yzzy " * 30, None, None), (144, out[0][1], "de", "s1.example.de")]
    return [(*r, len(r[1] or "")) for r in out]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(make_rows(), "doc_id long, text string, lang string, source string, n_chars int").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def posteriors(rows, langs, table):
    """(best language, its probability, accepted) of each (text, declared, host)."""
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    k, ll, fits = len(langs), [], []
    for text, _, _ in rows:
        g = _buckets((text or "").encode())
        mean = table[:, g].astype(np.float64).sum(axis=1) / max(1, len(g))
        ll.append(mean * min(len(g), 60))
        fits.append(len(g) > 0 and mean.max() > -np.log(BUCKETS))
    sums = defaultdict(lambda: np.zeros(k))
    total = np.ones(k)
    for (_, said, host), x, ok in zip(rows, ll, fits):
        if ok:
            total += soft(x)
            for key in [("said", said)] * (said is not None) + ([(n, ".".join(host.split(".")[-n:])) for n in (1, 2)] + [("host", host)] if host is not None else []):
                sums[key] += soft(x)
    out = []
    for (text, said, host), x, ok in zip(rows, ll, fits):
        prior = total / total.sum()
        if host is not None and ("host", host) in sums:
            for key in ((1, host.split(".")[-1]), (2, ".".join(host.split(".")[-2:])), ("host", host)):
                prior = (sums[key] + 20 * prior) / (sums[key].sum() + 20)
            x = x + np.log((sums[(1, host.split(".")[-1])] + 1) / (total + 1))
        if said is not None and ("said", said) in sums:
            x = x + np.log((sums[("said", said)] + 1) / (total + k))
        p = soft(x + np.log(prior))
        some = len(_buckets((text or "").encode())) > 0
        out.append((langs[int(p.argmax())] if some else None, float(p.max()) if some else 0.0, bool(ok and p.max() >= 0.5)))
    return out


def test_posteriors(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    langs, table = fit(docs, "doc_id", "text", "lang")
    got = identify(docs, langs, table, docs.columns, declared=F.col("lang"), host=F.col("source")).collect()
    want = posteriors([(r.row.text, r.row.lang, r.row.source) for r in got], langs, table)
    assert len(got) == len(make_rows()) and len({r.accepted for r in got}) == 2
    for r, (lang, p, ok) in zip(got, want):
        assert (r.lang, r.accepted) == (lang, ok) and r.probability == pytest.approx(p, abs=1e-6)


def deduped(rows):
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    sets = [{tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if (ws := (t or "").lower().split()) else set() for _, t in rows]
    up = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                up = [up[j] if u == up[i] else u for u in up] if up[j] < up[i] else [up[i] if u == up[j] else u for u in up]
    return Counter(rows[i] for i in set(up))


def leaks(text):
    ws, full, hit = re.findall(r"[a-z0-9]+", (text or "").lower()), False, set()
    for _, t in BENCH:
        item = (t or "").split()
        k = min(8, len(item))
        for i in range(len(ws) - k + 1 if k else 0):
            if any(ws[i : i + k] == item[j : j + k] for j in range(len(item) - k + 1)):
                full |= k == 8
                hit |= set(range(i, i + k))
    return full or bool(hit) and len(hit) >= 0.5 * len(ws)


def test_stages(spark, sf):
    key = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    langs, table = fit(docs, "doc_id", "text", "lang")
    ok = posteriors([(r.text, r.lang, r.source) for r in rows], langs, table)
    kept = corpus_pipeline.language_id(spark, docs, sf).cache()
    assert key(kept) == Counter((r.doc_id, r.text) for r, x in zip(rows, ok) if x[2])
    before, kept = key(kept), corpus_pipeline.near_dedup(spark, kept, sf).cache()
    assert key(kept) == deduped(before) and sum(before.values()) - kept.count() >= 8
    before, kept = key(kept), corpus_pipeline.decontaminate(spark, kept, sf).cache()
    assert key(kept) == Counter({r: n for r, n in before.items() if not leaks(r[1])}) and sum(before.values()) - kept.count() == 4
    before, mixed = kept.collect(), corpus_pipeline.mix(spark, kept, sf).cache()
    assert set(key(mixed)) <= set(key(kept)) and max(key(mixed).values()) <= 3
    size = lambda rs: sum((Counter({r.source: len(r.text.split())}) for r in rs), Counter())
    by, took = size(before), size(mixed.collect())
    names = sorted((s for s in by if s is not None)) + [None] * (None in by)
    weight, open_, left, target = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, list(names), float(sum(by.values())), {}
    while over := [s for s in open_ if left * weight[s] > 3 * by[s] * sum(weight[x] for x in open_)]:
        target |= {s: 3.0 * by[s] for s in over}
        left, open_ = left - sum(target[s] for s in over), [s for s in open_ if s not in over]
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    assert all(-0.5 <= target[s] - took[s] < min(len(r.text.split()) for r in before if r.source == s) + 0.5 for s in names)
    out = corpus_pipeline.shard(spark, mixed, sf).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in mixed.collect())
    n = Counter(r.shard for r in out)
    assert max(n.values()) - min(n.get(i, 0) for i in range(8)) <= 1
