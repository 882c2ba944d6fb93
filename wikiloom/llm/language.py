"""Language ID: text likelihoods fused with declared language, address suffix and smoothed host priors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import join_counted, stage

#: The classifier is fitted on the whole texts of at most this many labelled rows of each language.
FIT_ROWS = 400
BUCKETS = 1 << 14
#: Trigrams of a text are dependent; its evidence counts as that of so many independent ones at most.
EVIDENCE = 60.0
#: Pseudo-counts with which a host leans on its domain, a domain on its suffix, a suffix on all.
LEAN = 20.0


def _buckets(text: bytes) -> np.ndarray:
    """Hash buckets of the byte trigrams of the lower-cased text, white space as one space, digits and punctuation left out."""
    text = b" " + b" ".join(text.lower().translate(None, b"0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").split()) + b" "
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3 or len(text) == 2:
        return np.empty(0, np.uint32)
    return ((b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)) >> np.uint32(18)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to the trigram counts of each language."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            counts.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
            counts[lang.as_py()] += np.bincount(_buckets(text.as_py()), minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c.astype("<i8").tobytes() for c in counts.values()], pa.binary())], names=["lang", "counts"])


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[list[str], np.ndarray]:
    """All labelled languages and their log probabilities of trigram buckets, from a sample of at most FIT_ROWS whole texts of each in hash order.

    Texts are counted where they are; the driver gets one row of counts for each language.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"), F.xxhash64(id_col).alias("h")).where("lang is not null and length(text) > 0")
    sample = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= FIT_ROWS)
    found: dict[str, np.ndarray] = {}
    for r in sample.select("lang", "text").mapInArrow(_count, "lang string, counts binary").toLocalIterator():
        found[r.lang] = found.get(r.lang, 0) + np.frombuffer(bytes(r.counts), "<i8")
    langs = sorted(found)
    table = np.empty((len(langs), BUCKETS), np.float32)
    for i, x in enumerate(langs):
        table[i] = np.log((found[x] + 0.5) / (found[x] + 0.5).sum())
    return langs, table


def _score(table: np.ndarray, prepare):
    background = -np.log(BUCKETS)
    table = np.ascontiguousarray(table.T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                n, ll, fits = [], [], []
                for t in batch.column(batch.num_columns - 1):
                    g = _buckets(prepare(t.as_py()))
                    n.append(len(g))
                    mean = sum((table[g[i : i + 65536]].sum(axis=0, dtype=np.float64) for i in range(0, len(g), 65536)), np.zeros(table.shape[1])) / max(1, len(g))
                    fits.append(bool(len(g) and len(mean) and mean.max() > background))
                    ll.append((mean * min(len(g), EVIDENCE)).tolist())
                cols = [batch.column(i) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(fits, pa.bool_()), pa.array(ll, pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "n_grams", "fits", "ll"])

    return run


def identify(rows: DataFrame, langs: list[str], table: np.ndarray, keep: list[str], text_col: str = "text", declared: Column | None = None, host: Column | None = None, prepare=lambda t: t or b"") -> DataFrame:
    """(row, n_grams, declared, lang, probability, accepted) of each row; row is a struct of its ``keep`` columns.

    posterior(l) ~ text(l) * P(declared | l) * P(suffix | l) * prior(l | host). The tables of declared languages and
    suffixes by language, and the host priors (host leaning on its domain, the domain on the suffix, that on all) are
    sums of the texts' own posteriors over all rows, made by grouped aggregation; a row's own share is not taken out.
    Accepted: some language explains the trigrams better than chance would, and its probability is 0.5 or more.

    Null, empty and letterless texts have no evidence: lang is null and they are not accepted. Null declared languages
    and hosts add nothing; ids and repeated rows pass through; an empty table gives no rows; a model without languages
    accepts nothing. A text can be given any language that ``fit`` saw a labelled row of. As the ``keep`` columns stay in a struct, their names may be any.
    """
    none = F.lit(None).cast("string")
    src = rows.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), (none if declared is None else declared).cast("string").alias("_declared"), (none if host is None else host).cast("string").alias("_host"), F.col(text_col).cast("string").cast("binary").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    scored = stage(src.mapInArrow(_score(table, prepare), fields + ", n_grams long, fits boolean, ll array<double>"), "language")
    if not langs:
        return scored.select("row", "n_grams", F.col("_declared").alias("declared"), none.alias("lang"), F.lit(0.0).alias("probability"), F.lit(False).alias("accepted"))
    k = len(langs)

    def normal(x: Column) -> Column:
        e = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
        return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))

    scored = scored.withColumn("_domain", F.regexp_extract("_host", r"([^.]*\.?[^.]*)$", 1)).withColumn("_suffix", F.regexp_extract("_host", r"([^.]*)$", 1))
    soft = scored.where("fits").withColumn("_p", normal(F.col("ll")))
    sums = [F.sum(F.get("_p", F.lit(i))).alias(f"p{i}") for i in range(k)]
    vector = F.array(*[F.col(f"p{i}") for i in range(k)])

    def table_of(cols: list[str], name: str) -> DataFrame:
        return soft.where(" and ".join(f"{c} is not null" for c in cols)).groupBy(*cols).agg(*sums, F.count(F.lit(1)).alias("_rows")).select(*cols, "_rows", vector.alias(name))

    whole = soft.agg(*sums).first()
    total = [float(x or 0) + 1.0 for x in whole]
    all_prior = F.array(*[F.lit(x / sum(total)) for x in total])
    count = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b)
    lean = lambda c, up: F.when(c.isNull(), up).otherwise(F.zip_with(c, up, lambda x, u: (x + LEAN * u) / (count(c) + LEAN)))
    # The tables by host, domain, suffix and declared language are joined as tables: they may grow with the web. Texts of hot hosts
    # and languages stay where they are.
    tables = stage(table_of(["_host", "_domain", "_suffix"], "_hc"), "language")
    domains = tables.groupBy("_domain").agg(*[F.sum(F.get("_hc", F.lit(i))).alias(f"p{i}") for i in range(k)]).select("_domain", vector.alias("_dc"))
    suffixes = tables.groupBy("_suffix").agg(*[F.sum(F.get("_hc", F.lit(i))).alias(f"p{i}") for i in range(k)]).select("_suffix", vector.alias("_sc"))
    priors = tables.join(domains, "_domain").join(suffixes, "_suffix")
    priors = priors.withColumn("_prior", lean(F.col("_hc"), lean(F.col("_dc"), lean(F.col("_sc"), all_prior))))
    # P(suffix | l): of the rows of language l, the share under this suffix, with one pseudo-count.
    priors = priors.select("_host", "_rows", "_prior", F.zip_with("_sc", F.array(*[F.lit(x) for x in total]), lambda s, t: (s + 1.0) / (t + 1.0)).alias("_psuffix"))
    said = table_of(["_declared"], "_dl").select("_declared", "_rows", F.zip_with("_dl", F.array(*[F.lit(x) for x in total]), lambda s, t: (s + 1.0) / (t + float(k))).alias("_pdeclared"))
    priors, said, total_rows = stage(priors, "language"), stage(said, "language"), scored.count()
    out = join_counted(scored, priors, ["_host"], "_rows", total_rows, "left", priors.count()).drop("_rows")
    out = join_counted(out, said, ["_declared"], "_rows", total_rows, "left", said.count())
    flat = F.array(*[F.lit(1.0)] * k)
    parts = [F.col("ll"), *[F.transform(c, lambda v: F.log(v)) for c in (F.coalesce("_prior", all_prior), F.coalesce("_psuffix", flat), F.coalesce("_pdeclared", flat))]]
    fused = parts[0]
    for p in parts[1:]:
        fused = F.zip_with(fused, p, lambda x, y: x + y)
    out = out.withColumn("_post", normal(fused)).withColumn("_best", F.array_max("_post"))
    lang = F.when(F.col("n_grams") > 0, F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("_post", F.col("_best")).cast("int")))
    return out.select("row", "n_grams", F.col("_declared").alias("declared"), lang.alias("lang"), F.when(F.col("n_grams") > 0, F.col("_best")).otherwise(0.0).alias("probability"), (F.col("fits") & (F.col("_best") >= 0.5)).alias("accepted"))
