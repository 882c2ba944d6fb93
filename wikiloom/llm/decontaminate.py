"""Benchmark decontamination: a positional inverted index of the training text, searched from the rarest test terms."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Bytes of text in one segment of the index (a longer text has a segment of its own), of items whose terms are indexed in one
#: pass over the text, and of items whose windows a task searches for at a time (a longer item goes alone).
SEGMENT_BYTES, INDEX_BYTES, SEARCH_BYTES = 4 << 20, 32 << 20, 2 << 20
#: Byte classes of the word pattern: A-Z in lower case, what is no word byte as a space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


def item_windows(items: list[tuple], n: int, vocab: dict[bytes, int]) -> dict[tuple[int, ...], list]:
    """The distinct windows (term ids) of items, with the ids of their items."""
    found: dict[tuple[int, ...], set] = {}
    for item, text in items:
        ids = [vocab[w] for w in words(text)]
        k = min(n, len(ids))
        for i in range(len(ids) - k + 1 if k else 0):
            found.setdefault(tuple(ids[i : i + k]), set()).add(item)
    return {w: sorted(x, key=str) for w, x in found.items()}


def by_rarest(windows: dict[tuple[int, ...], list], df: dict[int, int]) -> dict[int, list[tuple]]:
    """Windows under their rarest term, each with its offsets from the rarest term on: ordered once, not in every segment."""
    out: dict[int, list] = {}
    for w, ids in windows.items():
        order = sorted(range(len(w)), key=lambda i: (df.get(w[i], 0), w[i], i))
        if df.get(w[order[0]]):
            out.setdefault(w[order[0]], []).append((w, order, ids))
    return out


def _index(vocab: dict[bytes, int], gap: int):
    """Batches of (row, doc_id, text) to index rows: kind 0 for a document (its place in the segment), kind 1 for a term's postings."""

    def flush(docs: list, texts: list) -> pa.RecordBatch:
        segment = docs[0][0]
        cols: dict[str, list] = {k: [] for k in ("segment", "kind", "row", "doc_id", "n", "term", "postings")}

        def add(kind, row, doc_id, n, term, postings):
            for k, v in zip(cols, (segment, kind, row, doc_id, n, term, postings)):
                cols[k].append(v)

        ids, at, base = [], [], 0
        for (row, doc_id), ws in zip(docs, texts):
            got = np.fromiter(map(vocab.get, ws, [-1] * len(ws)), np.int32, len(ws))
            has = np.flatnonzero(got >= 0)
            ids.append(got[has])
            at.append(has.astype(np.int64) + base)
            add(0, row, doc_id, len(ws), None, None)
            base += len(ws) + gap
        ids, at = np.concatenate(ids), np.concatenate(at)
        order = np.argsort(ids, kind="stable")
        ids, at = ids[order], at[order].astype("<i4")
        cuts = np.flatnonzero(np.diff(ids, prepend=-1, append=-1)) if len(ids) else np.array([0])
        for a, b in zip(cuts[:-1], cuts[1:]):
            add(1, None, None, int(b - a), int(ids[a]), at[a:b].tobytes())
        types = (pa.int64(), pa.int8(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), types)], names=list(cols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, texts, held = [], [], 0
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i) for i in range(3))):
                text = text.as_py()
                docs.append((row.as_py(), doc_id.as_py()))
                texts.append(words(text))
                held += len(text or b"")
                if held >= SEGMENT_BYTES:
                    yield flush(docs, texts)
                    docs, texts, held = [], [], 0
        if docs:
            yield flush(docs, texts)

    return run


#: Ids go as strings: pandas would make floats of a long column with nulls.
_INDEX_SCHEMA = "segment long, kind byte, row long, doc_id string, n long, term int, postings binary"


def build_index(rows: DataFrame, vocab: dict[bytes, int], n: int) -> DataFrame:
    """The stored index of (row, doc_id, text): segments of a few MB of text; per segment its documents, and a positional postings list for each test term."""
    return stage(rows.mapInArrow(_index(vocab, n), _INDEX_SCHEMA), "postings")


def exact_hits(lists: dict[int, np.ndarray], window: tuple[int, ...], order: list[int]) -> np.ndarray:
    """Starts of the exact phrase: the postings of its terms, shifted by their offsets, intersected in ``order``, from the rarest term on."""
    if any(window[i] not in lists for i in order):
        return np.empty(0, np.int64)
    starts = lists[window[order[0]]] - order[0]
    for i in order[1:]:
        if not len(starts):
            break
        have = lists[window[i]]
        at = np.minimum(np.searchsorted(have, starts + i), len(have) - 1)
        starts = starts[have[at] == starts + i]
    return starts


def near_hits(lists: dict[int, np.ndarray], window: tuple[int, ...], order: list[int], terms: int, slop: int) -> np.ndarray:
    """Positions of the window's rarest term that have its next rarest distinct terms within ``slop`` words."""
    order = list(dict.fromkeys(window[i] for i in order))[:terms]
    if any(t not in lists for t in order):
        return np.empty(0, np.int64)
    at = lists[order[0]]
    for t in order[1:]:
        have = lists[t]
        i = np.searchsorted(have, at)
        away = np.minimum(np.abs(have[np.minimum(i, len(have) - 1)] - at), np.abs(have[np.maximum(i - 1, 0)] - at))
        at = at[away <= slop]
    return at


def _search(rarest: dict[int, list[tuple]], gap: int, near: tuple[int, int] | None):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        docs = pdf[pdf["kind"] == 0].sort_values("row")
        base = np.concatenate([[0], np.cumsum(docs["n"].to_numpy() + gap)])
        lists = {int(t): np.frombuffer(p, "<i4").astype(np.int64) for t, p in zip(pdf["term"][pdf["kind"] == 1], pdf["postings"][pdf["kind"] == 1])}
        hit, close = np.zeros(base[-1] + 1, np.int32), {}
        items: dict[int, set] = {}
        full: dict[int, set] = {}
        # Only windows whose rarest term the segment has.
        for term in lists:
            for w, order, ids in rarest.get(term, ()):
                starts, k = exact_hits(lists, w, order), len(w)
                if len(starts):
                    np.add.at(hit, starts, 1)
                    np.add.at(hit, starts + k, -1)
                    for d in set(np.searchsorted(base, starts, "right") - 1):
                        items.setdefault(int(d), set()).update(ids)
                        if k == gap:
                            full.setdefault(int(d), set()).update(ids)
                if near:
                    for d in set(np.searchsorted(base, near_hits(lists, w, order, *near), "right") - 1):
                        close.setdefault(int(d), set()).update(ids)
        cover = np.cumsum(hit[:-1]) > 0
        edge = np.flatnonzero(np.diff(cover.astype(np.int8), prepend=0, append=0))
        of = np.searchsorted(base, edge[::2], "right") - 1
        spans: dict[int, list] = {}
        for d, a, b in zip(of.tolist(), (edge[::2] - base[of]).tolist(), (edge[1::2] - base[of]).tolist()):
            spans.setdefault(d, []).append([a, b])
        return pd.DataFrame({"row": docs["row"].to_numpy(), "doc_id": pd.Series([None if pd.isna(x) else int(x) for x in docs["doc_id"]], dtype=object), "n_words": docs["n"].to_numpy(), "spans": [spans.get(i, []) for i in range(len(docs))], "items": [sorted(map(str, items.get(i, ()))) for i in range(len(docs))], "near_items": [sorted(map(str, close.get(i, ()))) for i in range(len(docs))], "n_full": [len(full.get(i, ())) for i in range(len(docs))]})

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 8, near: tuple[int, int] | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_words, spans, items, near_items, n_full.

    Words are lower-cased runs of digits, letters and bytes over 0x7F. A window is n consecutive words of an item, or the
    whole item if it has fewer (but some). spans: the runs [from, to) of words inside exact occurrences of windows; items: the
    ids of the items that these windows come from, sorted as strings; n_full: how many of these items have a window of all n
    words there. With ``near`` = (terms,
    slop), near_items has the items of windows whose rarest ``terms`` terms stand within ``slop`` words of the rarest.

    Null and empty texts have no words; null item texts have no windows; null and repeated ids are ordinary rows; empty
    tables give no rows or no hits; other columns are ignored. The index is split by text, never by term, so frequent
    terms and long lists are spread. Up to INDEX_BYTES of benchmark text the corpus is read once, whatever the number of items;
    a larger benchmark goes in blocks of that size over a staged copy of the rows, and each index is searched for
    SEARCH_BYTES of items at a time: what the driver and a task hold of it is bounded.
    """
    items = benchmark.select(F.col(item_col).alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("t"))
    blocks = max(1, -(-(items.agg(F.sum(F.length("t"))).first()[0] or 0) // INDEX_BYTES))
    parts = items.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").cast("string").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"))
    if blocks > 1:
        rows = stage(rows, "texts")
    search = lambda index, rarest: index.groupBy("segment").applyInPandas(_search(rarest, n, near), "row long, doc_id long, n_words long, spans array<array<long>>, items array<string>, near_items array<string>, n_full long")
    found = []
    for b in range(blocks):
        read = [(r.i, bytes(r.t)) for r in parts.where(F.col("b") == b).select("i", "t").toLocalIterator()]
        vocab: dict[bytes, int] = {}
        for _, text in read:
            for w in words(text):
                vocab.setdefault(w, len(vocab))
        index = build_index(rows, vocab, n)
        df = {r.term: r.n for r in index.where("kind = 1").groupBy("term").agg(F.sum("n").alias("n")).collect()}
        batch, held = [], 0
        for i, item in enumerate(read):
            batch.append(item)
            held += len(item[1])
            if held >= SEARCH_BYTES or i + 1 == len(read):
                rarest = by_rarest(item_windows(batch, n, vocab), df)
                found.append(search(index, rarest))
                batch, held = [], 0
    if not found:
        return search(index, {})
    if len(found) == 1:
        return found[0]
    found = reduce(DataFrame.unionByName, found)
    # An item stands in one batch, unless its id is repeated.
    every = lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return found.groupBy("row", "doc_id", "n_words").agg(every("spans"), every("items"), every("near_items"), F.sum("n_full").alias("n_full"))


def digest(found: DataFrame, *more: str) -> DataFrame:
    """The contract's columns: words hit, items found, their digest, and the verdict; then the columns ``more``."""
    ids = F.array_join("items", ",")
    # Spans come sorted; those of different blocks of items may overlap.
    start = lambda s, at: F.greatest(F.get(s, F.lit(0)), at)
    step = lambda acc, s: F.struct((acc.n + F.greatest(F.get(s, F.lit(1)) - start(s, acc.at), F.lit(0))).alias("n"), F.greatest(acc.at, F.get(s, F.lit(1))).alias("at"))
    n_hit = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("at")), step, lambda acc: acc.n)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.size("items") >= 2).alias("contaminated"), *more)

