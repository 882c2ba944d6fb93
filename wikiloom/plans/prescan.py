"""The lookup tables of a dump: titles, redirects, templates, and the one table that links and inclusions resolve by."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import SiteConfig
from ..functions import text as T
from ..sources.dump import first_of_id
from ..sources.staging import stage


@dataclass(frozen=True)
class Lookups:
    """title2id (title, id), redirects (from_title, to_title), templates (id, title, body), totals (pages, chars), known namespace names."""

    title2id: DataFrame
    redirects: DataFrame
    templates: DataFrame
    totals: DataFrame
    known: tuple[str, ...]

    def resolved(self) -> DataFrame:
        """(title, id, body): titles and, one hop on, redirects; a redirect to a redirect resolves to nothing; redirects win over pages; body is set for templates."""
        r, t = self.redirects, self.title2id
        hop = r.join(r.select(F.col("from_title").alias("to_title")), "to_title", "left_anti").join(t.withColumnRenamed("title", "to_title"), "to_title").select(F.col("from_title").alias("title"), "id")
        own = t.join(r.select(F.col("from_title").alias("title")), "title", "left_anti")
        return own.unionByName(hop).join(self.templates.select("id", "body"), "id", "left").select("title", "id", "body")

    def save(self, path: str) -> None:
        for name in ("title2id", "redirects", "templates", "totals"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        spark = self.title2id.sparkSession
        spark.createDataFrame([(k,) for k in self.known], "name string").write.mode("overwrite").parquet(f"{path}/namespaces")


def load(spark: SparkSession, path: str) -> Lookups:
    known = tuple(sorted(r.name for r in spark.read.parquet(f"{path}/namespaces").collect()))
    return Lookups(*(spark.read.parquet(f"{path}/{n}") for n in ("title2id", "redirects", "templates", "totals")), known)


def known_names(header: list[str], cfg: SiteConfig) -> tuple[str, ...]:
    """Namespace names of the dump's header (a few dozen) and the interwiki prefixes, normalised."""
    return tuple(sorted({n[:1].upper() + n[1:].lower() for n in header if n} | set(cfg.interwiki_ns)))


def titled(raw: DataFrame, known: tuple[str, ...], cfg: SiteConfig, drop_empty: bool = True) -> DataFrame:
    """raw with ns, name (title without namespace), full title and redirect link; pages without title dropped."""
    split = T.split_title(F.col("title"), list(known), cfg)
    out = raw.withColumn("_t", split).withColumn("ns", F.col("_t.ns")).withColumn("name", F.col("_t.title"))
    out = out.withColumn("full", T.let(F.col("_t"), T.full_title)).drop("_t")
    out = out.where(F.length("full") > 0) if drop_empty else out
    return out.withColumn("redirect", T.redirect_target(F.col("text"), cfg))


def ns_ok(ns, wanted: tuple[str, ...]):
    """Main, or one of the wanted; what is no namespace of the dump never gets this far as one."""
    return (ns == "") | ns.isin(*wanted)


def prescan(raw: DataFrame, header: list[str], cfg: SiteConfig) -> Lookups:
    known = known_names([*header, cfg.category_ns, cfg.template_ns, cfg.image_ns], cfg)
    totals = raw.agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"))
    # Dumps are parsed once, and of their text no more than redirects and template bodies is shuffled or kept.
    slim = titled(raw, known, cfg, drop_empty=False)
    body = F.when((F.col("ns") == cfg.template_ns) & F.col("redirect").isNull(), T.template_body(F.col("text")))
    slim = first_of_id(slim.select("part", "pos", "id", "ns", "full", "redirect", body.alias("body")))
    pages = stage(slim.where((F.length("full") > 0) & ns_ok(F.col("ns"), cfg.prescan_ns)), "prescan")
    # Input order decides between equal titles: the first page, the last redirect.
    nth = lambda order: F.row_number().over(Window.partitionBy("full").orderBy(*order))
    plain = pages.where("redirect is null").withColumn("_n", nth([F.col("part"), F.col("pos")])).where("_n = 1")
    title2id = plain.select(F.col("full").alias("title"), "id")
    moved = pages.where("redirect is not null").withColumn("to_title", T.normalize_title(F.col("redirect"), list(known), cfg)).where("to_title <> ''")
    # A redirect after a page of the same title is dropped with it.
    moved = moved.join(plain.select("full", F.struct("part", "pos").alias("_first")), "full", "left").where(F.col("_first").isNull() | (F.struct("part", "pos") < F.col("_first")))
    redirects = moved.withColumn("_n", nth([F.desc("part"), F.desc("pos")])).where("_n = 1").select(F.col("full").alias("from_title"), "to_title")
    templates = plain.where(F.col("ns") == cfg.template_ns).select("id", F.col("full").alias("title"), "body")
    return Lookups(title2id, redirects, templates, totals, known)


def redirect_report(lookups: Lookups) -> DataFrame:
    """(from_id, from_title, to_id, to_title, to_template): ids are null where unknown."""
    t = lookups.title2id
    out = lookups.redirects.join(t.select(F.col("title").alias("from_title"), F.col("id").alias("from_id")), "from_title", "left").join(t.select(F.col("title").alias("to_title"), F.col("id").alias("to_id")), "to_title", "left")
    is_template = lookups.templates.select(F.col("id").alias("to_id"), F.lit(True).alias("to_template"))
    return out.join(is_template, "to_id", "left").select("from_id", "from_title", "to_id", "to_title", F.coalesce("to_template", F.lit(False)).alias("to_template"))
