"""What a dump's reading leaves out, and why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import SiteConfig
from .prescan import known_names, ns_ok, titled


def rejects(raw: DataFrame, header: list[str], cfg: SiteConfig) -> DataFrame:
    """(page_id, code, detail): pages that the lookup tables leave out, with the first reason that holds.

    duplicate_id: a page of the same part has the id already; empty_title; other_namespace (detail: the namespace);
    empty_redirect: a redirect to an empty title; duplicate_title: an earlier page, not a redirect, has the title
    (detail). No text is shuffled.
    """
    known = known_names([*header, cfg.category_ns, cfg.template_ns, cfg.image_ns], cfg)
    pages = titled(raw, known, cfg, drop_empty=False).select("part", "pos", "id", "ns", "full", "redirect")
    pages = pages.withColumn("_again", F.row_number().over(Window.partitionBy("part", "id").orderBy("pos")) > 1)
    code = F.when(F.col("_again"), "duplicate_id").when(F.coalesce(F.length("full"), F.lit(0)) == 0, "empty_title").when(~ns_ok(F.col("ns"), cfg.prescan_ns), "other_namespace")
    code = code.when(F.trim("redirect") == "", "empty_redirect")
    pages = pages.withColumn("code", code)
    holder = F.col("code").isNull() & F.col("redirect").isNull()
    before = Window.partitionBy("full").orderBy("part", "pos").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.max(holder).over(before), F.lit(False))
    pages = pages.withColumn("code", F.coalesce("code", F.when(taken, "duplicate_title")))
    return pages.where("code is not null").select(F.col("id").alias("page_id"), "code", F.when(F.col("code") == "other_namespace", F.col("ns")).otherwise(F.coalesce("full", F.lit(""))).alias("detail"))
