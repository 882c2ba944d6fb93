"""Mixing sources to target weights: exact length counts, then a bounded-knapsack fit of each source's remaining budget."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fan_out, numbered, ranked, stage

#: Words that the greedy pass leaves for the dynamic programme, which fits up to four times as many word by word; documents
#: longer than that are taken greedily or fitted in larger units, whichever comes nearer.
DP_WORDS = 16384


def _subset(left: dict[int, int], goal: int, unit: int = 1) -> dict[int, int]:
    """Bounded subset sum over bit sets: the documents whose lengths, rounded up to units, come nearest ``goal`` from below."""
    goal, items, took = goal // unit, [], {}
    for n in sorted(left, reverse=True):
        u = -(-n // unit)
        c, step = min(left[n], goal // u), 1
        while c > 0:
            items.append((n, u, min(step, c)))
            c -= step
            step *= 2
    mask, sets = (1 << (goal + 1)) - 1, [1]
    for _, u, k in items:
        sets.append((sets[-1] | sets[-1] << (u * k)) & mask)
        if sets[-1] >> goal & 1:
            break
    at = sets[-1].bit_length() - 1
    for i in range(len(sets) - 1, 0, -1):
        if not sets[i - 1] >> at & 1:
            n, u, k = items[i - 1]
            took[n] = took.get(n, 0) + k
            at -= u * k
    return took


def _fill(left: dict[int, int], rest: int, dp_words: int, long_first: bool) -> dict[int, int]:
    """Documents of ``left`` that fill ``rest``: with ``long_first``, first a fit in units of those too long for the fit by words."""
    cap, took = 4 * dp_words, {}

    def take(n: int, k: int) -> int:
        took[n] = took.get(n, 0) + k
        return n * k

    if long_first:
        for n, k in _subset({n: c for n, c in left.items() if n > cap}, rest, -(-rest // cap)).items():
            rest -= take(n, k)
    # What leaves room for the fit by words, then, as long as that cannot reach the rest, what fits at all.
    for stop, room in ((dp_words, dp_words // 2), (cap, 0)):
        for n in sorted(left, reverse=True):
            if rest <= stop:
                break
            rest -= take(n, min(left[n] - took.get(n, 0), max(0, rest - room) // n))
    for n, k in _subset({n: c - took.get(n, 0) for n, c in left.items()}, min(rest, cap)).items():
        take(n, k)
    return took


def fit(lengths: dict[int, int], budget: int, dp_words: int = DP_WORDS) -> dict[int, int]:
    """How many documents of each length to take so that their sum comes as near ``budget`` from below as can be found.

    First the same share of every length, then the longest that fit until ``dp_words`` remain, then bounded subset sum
    over bit sets. Where documents are longer than the subset sum reaches, a fit of these in larger units is tried as
    well. ``lengths`` maps a length (over 0) to its number of documents.
    """
    total = sum(n * c for n, c in lengths.items())
    budget = min(budget, total)
    if budget <= 0:
        return {}
    took = {n: c * budget // total for n, c in lengths.items()}
    rest = budget - sum(n * c for n, c in took.items())
    left = {n: lengths[n] - took[n] for n in lengths}
    long = rest > 4 * dp_words and any(c and 4 * dp_words < n <= rest for n, c in left.items())
    more = max((_fill(left, rest, dp_words, first) for first in ((False, True) if long else (False,))), key=lambda t: sum(n * k for n, k in t.items()))
    return {n: k + more.get(n, 0) for n, k in took.items()}


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    whole = min(int(target // size), 3) if size else 0
    counts = {int(n): int(c) for n, c in zip(pdf["size"], pdf["n"]) if n}
    budget = round(target - whole * size)
    took = fit(counts, budget)
    # A long document may leave a gap that only further copies of shorter ones can fill.
    gap = budget - sum(n * c for n, c in took.items())
    if gap > 0:
        more = fit({n: c * (3 - whole) - took.get(n, 0) for n, c in counts.items() if n <= gap and c * (3 - whole) > took.get(n, 0)}, gap)
        took = {n: took.get(n, 0) + more.get(n, 0) for n in took | more}
    extra = [took.get(int(n), 0) for n in pdf["size"]]
    return pd.DataFrame({"_si": pdf["_si"], "size": pdf["size"], "_whole": [whole + e // c for e, c in zip(extra, pdf["n"])], "_pick": [e % c for e, c in zip(extra, pdf["n"])]})


def targets(by_source: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Adds _si (rank of the source by code point, null last) and target to (source, source_size).

    Targets share the sum of all sizes by weight and stop at ``cap`` times the source's size; the excess goes to the
    others by weight until none is above. Each round closes the sources that the level of the open ones would lift over
    their cap and raises the level; only sums come to the driver, and the level never falls, so rounds end.
    """
    t = numbered(by_source, [F.col("source").isNull(), F.col("source")], "_si", "mix")
    t = t.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("_si", F.lit(len(weights))) + 1).cast("int")))
    t = t.withColumn("_cap", F.lit(float(cap)) * F.col("source_size"))
    level, closed = 0.0, -1
    while True:
        shut = F.col("_cap") <= F.col("_w") * F.lit(level)
        total, capped, open_, n = t.agg(F.sum("source_size"), F.sum(F.when(shut, F.col("_cap"))), F.sum(F.when(~shut, F.col("_w"))), F.count_if(shut)).first()
        if not open_ or n == closed:
            return t.withColumn("target", F.least(F.col("_cap"), F.col("_w") * F.lit(level))).drop("_w", "_cap")
        level, closed = (total - (capped or 0.0)) / open_, n


def row_hash(doc_id: Column, text: Column, seed: int = 17) -> Column:
    """Seeded hash that orders rows and names them: rows of equal id and text share it."""
    return F.xxhash64(F.lit(seed), doc_id, text)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def mix_to_targets(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken, row_hash.

    size: words ``[^\\x20\\x09-\\x0D]+`` of the text (null text: 0). A source whose target is q times its size and a rest
    takes every document q times and, for the rest, documents chosen by length count (see ``fit``) in seeded hash order; what
    whole documents leave open is filled with further copies, three at most of each document.
    Rows of equal id and text are interchangeable; null ids and null sources are ordinary values; texts without words
    take nothing; an empty table gives no rows; other columns are ignored. Reruns give the same rows.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[source_col].cast("string").alias("source"), n_words(docs[text_col]).alias("size"), row_hash(docs[id_col], docs[text_col], seed).alias("_h"))
    rows = stage(rows, "mix")
    lengths = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    by_source = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    plan = stage(targets(by_source, weights, cap), "mix")
    lengths = lengths.withColumnRenamed("source", "_s").join(plan, F.col("_s").eqNullSafe(F.col("source"))).select("_si", "size", "n", "source_size", "target")
    picks = lengths.groupBy("_si").applyInPandas(_fit_source, "_si int, size long, _whole int, _pick long")
    plan = plan.join(picks, "_si").select("source", "size", "source_size", "target", "_whole", "_pick")
    plan = stage(plan.select(F.col("source").alias("_s"), F.col("size").alias("_n"), "source_size", "target", "_whole", "_pick"), "mix")
    # The null source needs a value to be a join key; the flag keeps it apart from a source named "".
    rows = rows.withColumn("_null", F.col("source").isNull()).withColumn("_key", F.coalesce("source", F.lit("")))
    plan = plan.withColumn("_null", F.col("_s").isNull()).withColumn("_key", F.coalesce("_s", F.lit(""))).withColumnRenamed("_n", "size").drop("_s")
    # Pieces by the hash's leading bits: ranks go by hash over all of them.
    bits = (fan_out(rows.count()) - 1).bit_length()
    piece = F.shiftright("_h", 64 - bits) + (1 << (bits - 1))
    at = ranked(rows, ["_key", "_null", "size"], [F.col("_h"), F.col("doc_id")], piece, "_rank", 1 << bits)
    out = at.join(plan, ["_key", "_null", "size"]).withColumn("copies", F.when(F.col("size") == 0, 0).otherwise(F.col("_whole") + (F.col("_rank") < F.col("_pick")).cast("int")))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), F.col("_h").alias("row_hash"))


def cuts(mixed: DataFrame) -> DataFrame:
    """What a mix takes, by source and size, from ``mix_to_targets``' rows: (source, size, low, high, cut, odd, odd_rows, odd_more).

    Rows with a hash up to ``cut`` are taken ``high`` times, the others ``low`` times; of the ``odd_rows`` rows whose hash is
    ``odd``, ``odd_more`` are taken once more. One row for each length of a source, however many documents there are.
    """
    by_hash = mixed.groupBy("source", "size", "row_hash").agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("n"))
    by_hash = by_hash.withColumn("each", F.floor(F.col("c") / F.col("n"))).withColumn("more", F.col("c") % F.col("n"))
    every = by_hash.groupBy("source", "size").agg(F.min("each").alias("low"), F.max(F.struct("each", "row_hash")).alias("top"), F.max(F.when(F.col("more") > 0, F.struct("row_hash", "n", "more"))).alias("odd"))
    cut = F.when(F.col("top.each") > F.col("low"), F.col("top.row_hash"))
    return every.select("source", "size", "low", F.col("top.each").alias("high"), cut.alias("cut"), F.col("odd.row_hash").alias("odd"), F.col("odd.n").alias("odd_rows"), F.col("odd.more").alias("odd_more"))
