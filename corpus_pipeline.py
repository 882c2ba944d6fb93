"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes the documents that the stage before it kept, and its decisions take effect: all but the last return the
columns of ``documents``. A document is what has one doc_id and text: near-dedup and decontamination go by a hash of both, so
different texts under one id, or under none, are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.llm.common import ranked, stage
from wikiloom.llm.decontaminate import digest, find_contamination
from wikiloom.llm.language import fit, identify
from wikiloom.llm.minhash import near_duplicates
from wikiloom.llm.mixing import cuts, mix_to_targets, n_words, row_hash
from wikiloom.llm.sharding import shard_documents

#: Benchmark items of which a document must hold a full window to be dropped; where it holds only whole items that are
#: shorter than a window, the least share of its words inside them.
LEAK_ITEMS, SHORT_SHARE = 1, 0.5


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(row, _key, doc_id, text): each row as a struct, whatever its columns are called, with the key that names it."""
    return docs.select(F.struct(*docs.columns).alias("row"), row_hash(docs["doc_id"], docs["text"]).alias("_key"), docs["doc_id"], docs["text"])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text some language explains; declared language: lang, host: source."""
    langs, table = fit(docs, "doc_id", "text", "lang")
    found = identify(docs, langs, table, docs.columns, declared=F.col("lang"), host=F.col("source"))
    return found.where("accepted").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id, null ids last.

    Of rows with equal id and text, that with the least hash of all columns stays.
    """
    keyed = keyed_rows(docs)
    found = near_duplicates(keyed, id_col="_key").select(F.col("doc_id").alias("_key"), "component_id")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("_key").alias("stays"))).alias("best")
    stays = keyed.select("_key", "doc_id").distinct().join(found.distinct(), "_key").groupBy("component_id").agg(best).select(F.col("best.stays").alias("_key"))
    # Repeated rows meet with map-side minima; the join keeps that partitioning.
    once = keyed.groupBy("_key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return once.join(stays, "_key", "left_semi").select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window of eight words, and not made up by half or more of shorter benchmark items."""
    keyed = keyed_rows(docs)
    found = find_contamination(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="_key")
    short = (F.col("n_items") >= 1) & (F.col("n_hit") >= SHORT_SHARE * F.col("n_words"))
    # Written down, its size is known: Spark broadcasts it only if that is small.
    leaks = stage(digest(found, "n_full").where((F.col("n_full") >= LEAK_ITEMS) | short).select(F.col("doc_id").alias("leak")).distinct(), "leaks")
    return keyed.join(leaks, keyed["_key"] == leaks["leak"], "left_anti").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    What the mix takes is told by source, length and hash (``cuts``), so no text is shuffled as long as that table is small.
    Rows equal in id, text and source have one hash: where the mix takes some of them once more than others, those are
    dealt out, first come first served.
    """
    plan = stage(cuts(mix_to_targets(docs)), "plan")
    same = F.coalesce(plan["source"], F.lit("")) == F.col("_source")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), row_hash(docs["doc_id"], docs["text"]).alias("_hash"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("_source"), docs["source"].isNull().alias("_none"), n_words(docs["text"]).alias("_size"))
    rows = keyed.join(plan, same & (plan["source"].isNull() == F.col("_none")) & (plan["size"] == F.col("_size")))
    odd = F.coalesce(F.col("_hash") == F.col("odd"), F.lit(False))
    each = F.when(F.coalesce(F.col("_hash") <= F.col("cut"), F.lit(False)), F.col("high")).otherwise(F.col("low")).cast("int")
    every = rows.where(~odd).select("row", each.alias("n"))
    # Where ids and texts are unlike, as after near-dedup, no row is odd and the texts are not read for that.
    if plan.where("odd is not null").limit(1).count():
        dealt = stage(rows.where(odd).select("row", "_source", "_none", "_size", "_hash", "low", "odd_more", F.monotonically_increasing_id().alias("_at")), "odd")
        dealt = ranked(dealt, ["_source", "_none", "_size", "_hash"], [F.col("_at")], F.col("_at"), "_rank")
        every = every.unionByName(dealt.select("row", (F.col("low") + (F.col("_rank") < F.col("odd_more")).cast("int")).cast("int").alias("n")))
    every = every.where("n > 0")
    return every.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row."""
    return shard_documents(docs, n_shards=8)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: The stages hash, fit and search in ways that SQL cannot express; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
