"""Statistics over page records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anchors(pages: DataFrame) -> DataFrame:
    """(target_id, source_id, loc, anchor) of each resolved link to another page; anchors on one line, trimmed."""
    x = pages.select(F.col("id").alias("source_id"), F.explode("wiki_links").alias("l")).where("l.target_id is not null and l.target_id <> source_id")
    return x.select(F.col("l.target_id").alias("target_id"), "source_id", F.col("l.loc").alias("loc"), F.regexp_replace(F.replace("l.anchor", F.lit("\n"), F.lit(" ")), r"^\s+|\s+$", "").alias("anchor"))


def external_anchors(pages: DataFrame) -> DataFrame:
    x = pages.select(F.col("id").alias("source_id"), F.explode("external_links").alias("l")).where("l.anchor is not null")
    return x.select("source_id", "l.url", "l.anchor")


def category_sizes(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("categories").alias("category_id")).groupBy("category_id").agg(F.count(F.lit(1)).alias("n_pages"))


def inlinks(pages: DataFrame) -> DataFrame:
    """Distinct pages that link to each page."""
    out = F.array_distinct(F.filter(F.transform("wiki_links", lambda l: l["target_id"]), lambda t: t.isNotNull() & (t != F.col("id"))))
    return pages.select(F.explode(out).alias("target_id")).groupBy("target_id").agg(F.count(F.lit(1)).alias("n_inlinks"))


def category_tree(pages: DataFrame) -> DataFrame:
    """(parent_id, children): category pages by category, children in the order of their pages in the dump."""
    x = pages.where("is_category").select(F.struct("part", "pos", "id").alias("child"), F.explode("categories").alias("parent_id"))
    return x.groupBy("parent_id").agg(F.transform(F.sort_array(F.collect_list("child")), lambda c: c["id"]).alias("children"))


def template_usage(pages: DataFrame, templates: DataFrame, param: str) -> DataFrame:
    """(template_id, title, n): inclusions that carry a parameter (any case), counted once for each such parameter, fewest first."""
    x = pages.select(F.explode("templates").alias("t")).select("t.template_id", F.explode("t.params"))
    n = x.where(F.lower("key") == param.lower()).groupBy("template_id").agg(F.count(F.lit(1)).alias("n"))
    return n.join(templates.select(F.col("id").alias("template_id"), "title"), "template_id", "left").select("template_id", "title", "n").orderBy("n", "template_id")
