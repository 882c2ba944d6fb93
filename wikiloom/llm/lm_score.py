"""Stupid-backoff language-model scores: n-gram counts partitioned by hash, joined to the exploded n-grams, summed per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import reads_alike, stage, unstage

#: Bytes of text in one block of documents (a longer text is a block), rows of n-grams that one partition of the count table
#: is sized for, and bytes of text that one task scores.
BLOCK_BYTES, PART_ROWS, TASK_BYTES = 12 << 20, 4 << 20, 16 << 20
#: Rows of one Arrow batch of n-grams.
BATCH = 1 << 17
#: Tokens that are scored at a time (a longer text goes alone).
CHUNK = 1 << 18
BACKOFF = 0.4
_C = np.uint64(0x9E3779B97F4A7C15)


def _grams(texts: list[bytes], order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Document number of each token, and for each length up to ``order`` the hash of the n-gram that ends there (0: the text starts later)."""
    hashes = []
    for t in texts:
        ws = t.lower().split()
        hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws)))
    of = np.repeat(np.arange(len(hashes), dtype=np.int32), [len(h) for h in hashes])
    one = np.concatenate([np.empty(0, np.uint64), *hashes])
    del hashes
    one[one == 0] = 1
    out = [one]
    for k in range(2, order + 1):
        g = np.zeros(len(of), np.uint64)
        if len(of) >= k:
            x = out[-1][:-1] * _C + (one[1:] ^ (one[1:] >> np.uint64(31))) + np.uint64(k)
            x = (x ^ (x >> np.uint64(32))) * _C
            x ^= x >> np.uint64(29)
            inside = np.concatenate([of[k - 1 :] == of[: len(of) - k + 1]])
            g[k - 1 :] = np.where(inside, np.where(x[k - 2 :] == 0, np.uint64(1), x[k - 2 :]), np.uint64(0))
        out.append(g)
    return of, out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[bytes]]]:
    """(block number, rows of the first columns, texts): the same blocks whenever the same partitions are read."""
    part, number, rows, texts, held = TaskContext.get().partitionId(), 0, [], [], 0
    for b in batches:
        for r, t in zip(zip(*(c.to_pylist() for c in b.columns[:-1])), b.column(b.num_columns - 1)):
            rows.append(r)
            texts.append(t.as_py())
            held += len(texts[-1]) + 64
            if held >= BLOCK_BYTES:
                yield (part << 32) + number, rows, texts
                number, rows, texts, held = number + 1, [], [], 0
    if rows:
        yield (part << 32) + number, rows, texts


def _explode(order: int):
    """Texts to (gram, block, n): each block's distinct n-grams with their counts there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, texts in _blocks(batches):
            for g in _grams(texts, order)[1]:
                grams, n = np.unique(g[g != 0], return_counts=True)
                for lo in range(0, len(grams), BATCH):
                    part = grams[lo : lo + BATCH].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), block, np.int64)), pa.array(n[lo : lo + BATCH].astype(np.int32))], names=["gram", "block", "n"])

    return run


def _tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, rows, texts in _blocks(batches):
        for lo in range(0, len(rows), 500):
            part = rows[lo : lo + 500]
            packed = [zstandard.compress(t) for t in texts[lo : lo + 500]]
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int64()), pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), pa.array(packed, pa.binary())], names=["block", "row", "doc_id", "text"])


def block_totals(g: np.ndarray, grams: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a block and their counts in all documents: ``grams`` (sorted) have ``totals``, the rest stand in this block only."""
    every, n = np.unique(g[g != 0], return_counts=True)
    if len(grams) and len(every):
        i = np.minimum(np.searchsorted(grams, every), len(grams) - 1)
        n = np.where(grams[i] == every, totals[i], n)
    return every, n


def others(g: np.ndarray, of: np.ndarray, every: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Count of each token's n-gram in the other documents, for whole documents of a block."""
    at = np.argsort(g, kind="stable")
    x, d = g[at], of[at]
    own = np.concatenate([[True], (x[1:] != x[:-1]) | (d[1:] != d[:-1])])
    starts = np.flatnonzero(own)
    mine = np.diff(np.append(starts, len(g)))
    i = np.minimum(np.searchsorted(every, x[starts]), max(0, len(every) - 1))
    left = np.where(x[starts] == 0, 0, (total[i] if len(every) else 0) - mine)
    out = np.empty(len(g), np.int64)
    out[at] = left[np.cumsum(own) - 1]
    return out


def _score(tokens: int, order: int):
    def run(key: tuple, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values("row")
        of, levels = _grams(list(map(zstandard.decompress, docs["text"])), order)
        grams, totals = answers["gram"].to_numpy(np.int64).view(np.uint64), answers["total"].to_numpy(np.int64)
        at = np.argsort(grams)
        grams, totals = grams[at], totals[at]
        tables = [block_totals(g, grams, totals) for g in levels]
        words = np.bincount(of, minlength=len(docs))
        ends = np.concatenate([[0], np.cumsum(words)])
        score, backed = np.zeros(len(docs)), np.zeros(len(docs))
        first = 0
        while first < len(docs):
            # Some documents of the block at a time.
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK, "right")) - 1)
            a, b = ends[first], ends[last]
            if a < b:
                here = of[a:b]
                counts = [others(g[a:b], here, *t) for g, t in zip(levels, tables)]
                p = np.maximum(counts[0], 1 / 2) / np.maximum(1, tokens - words)[here]
                steps = np.zeros(b - a)
                for k in range(1, order):
                    context = np.concatenate([[0], counts[k - 1][:-1]])
                    there, has = levels[k][a:b] != 0, counts[k] > 0
                    p = np.where(has, counts[k] / np.maximum(context, 1), np.where(there, BACKOFF * p, p))
                    steps = np.where(has, 0, steps + there)
                score[first:last] = np.bincount(here - first, np.log(p), last - first)
                backed[first:last] = np.bincount(here - first, steps, last - first)
            first = last
        return pd.DataFrame({"doc_id": docs["doc_id"].array, "n_words": words, "n_backoff": backed.astype(np.int64), "log_score": score, "mean_log_score": score / np.maximum(1, words)})

    return run


def lm_scores(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_backoff, log_score, mean_log_score.

    Words are what ASCII white space separates, A-Z lower-cased. The model is the n-gram counts, up to ``order`` words, of all
    other documents: S(w | v) = c(v w) / c(v) if c(v w) > 0, else BACKOFF * S(w | v without its first word), and
    S(w) = c(w) / N at last; a word's context never reaches beyond its text; a word that no other document has counts
    1/2. log_score is the sum of the words' natural logs, n_backoff the number of steps back.

    Blocks of documents are exploded to rows (gram, block, n), one for each of a block's distinct n-grams, so that a frequent
    one has a row for each block at most. Dealt by the hash of the gram, its rows are summed to its count and joined to it in
    one pass (a window over the gram); where other blocks have the gram too the count goes back, as a row, to the block,
    which joins it to its documents' n-grams and sums per document. Rows grow in proportion to the tokens. What a task
    holds is bounded by BLOCK_BYTES and the longest text. If ``docs`` is more than a scan of files, it is staged
    first, so that blocks are the same in both readings.

    Null and empty texts have no words and score 0; ids may be null or repeated, each row is a document; an empty table
    gives no rows; other columns are ignored.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("text")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text)
    if not reads_alike(rows):
        rows = stage(rows, "texts")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    size, words = rows.agg(F.sum(F.length("text") + 64), F.sum(F.regexp_count(F.col("text").cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")))).first()
    parts = max(8, int((words or 0) * order // PART_ROWS))
    exploded = rows.mapInArrow(_explode(order), "gram long, block long, n int").repartition(parts, "gram")
    counted = exploded.withColumn("total", F.sum("n").over(Window.partitionBy("gram")))
    answers = stage(counted.where("total > n").select("block", "gram", "total"), "answers", codec="zstd")
    # The n-grams' shuffle is not needed any more.
    del exploded, counted
    unstage()
    tasks = max(8, int((size or 0) // TASK_BYTES))
    tagged = rows.mapInArrow(_tag, "block long, row long, doc_id long, text binary").repartition(tasks, "block")
    return tagged.groupBy("block").cogroup(answers.repartition(tasks, "block").groupBy("block")).applyInPandas(_score(int(words or 0), order), "doc_id long, n_words long, n_backoff long, log_score double, mean_log_score double")
