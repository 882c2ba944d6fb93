"""The opN_ queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .decontaminate import digest, find_contamination
from .extract import extract_main_text, main_text
from .language import fit, identify
from .line_dedup import line_dedup
from .lm_score import lm_scores
from .minhash import near_duplicates
from .mixing import mix_to_targets
from .sharding import shard_documents
from .substrings import remove_repeats


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"), n_shards=8)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def _page_text(page: bytes | None) -> bytes:
    return main_text((page or b"").decode("utf-8", "replace")).encode()


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (declared: lang; host: source, which has no suffix) and all pages (declared: the html element's lang; host: the url's)."""
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    langs, table = fit(docs, "doc_id", "text", "lang")
    a = identify(docs, langs, table, ["doc_id"], declared=F.col("lang"), host=F.col("source"))
    # Possessive, first of its kind: read once, whatever the page.
    attributes = F.regexp_extract("html", r"(?i)<html(?=[\s>])([^>]*+)", 1)
    declared = F.nullif(F.regexp_extract(attributes, r"(?i)(?:^|\s)lang\s*+=\s*+[\"']?([a-z]++)", 1), F.lit(""))
    pages = pages.withColumn("_url", F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    b = identify(pages, langs, table, ["page_id"], text_col="html", declared=F.lower(declared), host=F.nullif(F.lower("_url"), F.lit("")), prepare=_page_text)
    found = ["n_grams", "declared", "lang", "probability", "accepted"]
    return a.select("row.doc_id", F.lit(None).cast("long").alias("page_id"), *found).unionByName(b.select(F.lit(None).cast("long").alias("doc_id"), "row.page_id", *found))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), length=200).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=8))


def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_to_targets(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_table(spark, sf_dir, "documents"), min_lines=2, min_words=50)
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def line_dedup_sql(min_lines: int = 2, min_words: int = 50) -> str:
    """The same rule for unique ids that are not null: a run's key is its text."""
    ahead = "".join(f" || chr(10) || lead(line, {k}) OVER w" for k in range(1, min_lines))
    return rf"""
WITH l AS (SELECT doc_id, text, CASE WHEN text = '' THEN [''] ELSE string_split(text, chr(10)) END AS lines FROM documents),
each AS (SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM l),
k AS (SELECT doc_id, pos, 0 AS kind, {min_lines} AS depth, line{ahead} AS run FROM each WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
  UNION ALL SELECT doc_id, pos, 1 AS kind, 1 AS depth, line AS run FROM each WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= {min_words}),
m AS (SELECT doc_id, pos, depth, row_number() OVER (PARTITION BY kind, run ORDER BY doc_id, pos) > 1 AS later FROM k WHERE run IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + depth)) AS pos FROM m WHERE later),
runs AS (SELECT doc_id, count(*) AS n, count(*) FILTER (before IS NULL OR before < pos - 1) AS r
  FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM gone) GROUP BY doc_id),
kept AS (SELECT e.doc_id, string_agg(line, chr(10) ORDER BY e.pos) AS text FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos GROUP BY e.doc_id)
SELECT l.doc_id, coalesce(len(lines), 0) AS n_lines, coalesce(runs.n, 0) AS n_removed, coalesce(runs.r, 0) AS n_runs,
  CASE WHEN l.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM l LEFT JOIN runs ON l.doc_id = runs.doc_id LEFT JOIN kept ON l.doc_id = kept.doc_id
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OPERATORS = (op1_sharding, op2_minhash, op3_language, op4_substrings, op5_decontamination, op6_extraction, op7_mixing, op8_line_dedup, op9_neighbours, op10_lm_score, pipeline)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op8_line_dedup": line_dedup_sql()}
