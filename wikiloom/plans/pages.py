"""Raw pages to page records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SiteConfig
from ..functions import text as T
from ..operators.page import transform_page
from ..sources.staging import stage
from .prescan import Lookups, ns_ok, titled

LINK = "STRUCT<anchor: STRING, loc: INT, target_id: BIGINT, target_ns: STRING, target_title: STRING>"
PARSED = (
    f"text STRING, categories ARRAY<BIGINT>, related ARRAY<BIGINT>, wiki_links ARRAY<{LINK}>, interwiki ARRAY<STRUCT<ns: STRING, title: STRING>>, "
    f"external_links ARRAY<STRUCT<url: STRING, anchor: STRING>>, bare_urls ARRAY<STRING>, disambig_links ARRAY<ARRAY<{LINK}>>, templates ARRAY<STRUCT<template_id: BIGINT, params: MAP<STRING, STRING>>>"
)
#: Bytes of the lookup table up to which every task gets all of it; beyond, pages ask for the titles they need.
BROADCAST_BYTES = 64 << 20


def _parse(known: tuple[str, ...], language: dict[str, str], cfg: SiteConfig, urls: bool, shared):
    """Batches of (id, ns, name, is_disambig, source, answers) to parsed records, or to the titles still to be looked up."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = frozenset(known)
        for pdf in batches:
            if not len(pdf):
                continue
            out = []
            for row in pdf.itertuples(index=False):
                asked: dict[str, None] = {}
                answers = shared.value if shared is not None else {a["title"]: (a["id"], a["body"]) for a in row.answers}

                def look(title: str):
                    if title in answers:
                        return answers[title]
                    if shared is None:
                        asked[title] = None
                    return (None, None)

                def resolve(title: str):
                    i, body = look(title)
                    return None if body is not None or i is None else int(i)

                def template(title: str):
                    i, body = look(title)
                    return None if body is None else (int(i), body)

                record = transform_page(row.id, row.name, row.ns, row.source, row.is_disambig, names, resolve, template, language, cfg, urls)
                out.append({"asked": list(asked), **record})
            done = pd.DataFrame(out)
            yield pd.concat([pdf.drop(columns=["source", "answers"]).reset_index(drop=True), done], axis=1)

    return run


def transform(raw: DataFrame, lookups: Lookups, cfg: SiteConfig, urls: bool = True, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The page records of a dump (see ``PARSED`` for the parsed fields).

    Redirects, other namespaces and empty titles go before any text is parsed. Links depend on what resolves, so parsing
    needs the lookup table: if it is small it is broadcast; else every page first asks for the titles it meets, a join
    answers, and pages whose answers brought new titles ask again. Nothing is collected but that table when small.
    """
    spark = raw.sparkSession
    pages = titled(raw, lookups.known, cfg).where(ns_ok(F.col("ns"), cfg.transform_ns) & F.col("redirect").isNull())
    source = T.strip_comments(F.col("text"))
    base = pages.select(
        "part", "pos", "id", "ns", "name", "full", "timestamp", F.length("text").alias("org_length"), source.alias("source"),
        T.is_stub(source).alias("is_stub"), T.is_disambig(source, F.col("full"), cfg).alias("is_disambig"),
    )
    lookup = lookups.resolved()
    language = T.language_names(spark)
    fields = "part STRING, pos BIGINT, id BIGINT, ns STRING, name STRING, full STRING, timestamp STRING, org_length INT, is_stub BOOLEAN, is_disambig BOOLEAN"
    schema = f"{fields}, asked ARRAY<STRING>, disambig_links ARRAY<ARRAY<{LINK}>>, templates ARRAY<STRUCT<template_id: BIGINT, params: MAP<STRING, STRING>>>, external_links ARRAY<STRUCT<url: STRING, anchor: STRING>>, bare_urls ARRAY<STRING>, wiki_links ARRAY<{LINK}>, interwiki ARRAY<STRUCT<ns: STRING, title: STRING>>, related ARRAY<BIGINT>, categories ARRAY<BIGINT>, text STRING"
    answer = "ARRAY<STRUCT<title: STRING, id: BIGINT, body: STRING>>"
    lookup = stage(lookup)
    size = lookup.agg(F.sum(F.octet_length("title") + F.coalesce(F.octet_length("body"), F.lit(0)) + 100)).first()[0] or 0
    if size <= broadcast_bytes:
        shared = spark.sparkContext.broadcast({r.title: (r.id, r.body) for r in lookup.toLocalIterator()})
        done = base.withColumn("answers", F.array().cast(answer)).mapInPandas(_parse(lookups.known, language, cfg, urls, shared), schema)
    else:
        todo = stage(base.withColumn("page_key", F.monotonically_increasing_id()).withColumn("answers", F.array().cast(answer)))
        done = None
        keyed = f"{schema}, page_key BIGINT".replace("is_disambig BOOLEAN,", "is_disambig BOOLEAN, page_key BIGINT,").removesuffix(", page_key BIGINT")
        # A page that asks again asks for titles that were not answered before, so this ends.
        while True:
            tried = stage(todo.select("part", "pos", "id", "ns", "name", "full", "timestamp", "org_length", "source", "is_stub", "is_disambig", "page_key", "answers").mapInPandas(_parse(lookups.known, language, cfg, urls, None), keyed))
            ready = tried.where(F.size("asked") == 0).drop("page_key")
            done = ready if done is None else done.unionByName(ready)
            asked = tried.where(F.size("asked") > 0).select("page_key", F.explode("asked").alias("title"))
            if asked.isEmpty():
                break
            got = asked.join(lookup, "title", "left").groupBy("page_key").agg(F.collect_list(F.struct("title", "id", "body")).alias("new"))
            todo = stage(todo.join(got, "page_key").withColumn("answers", F.concat("answers", "new")).drop("new"))
    return done.select(
        "id", F.col("full").alias("title"), "ns", "timestamp", "org_length", F.length("text").alias("new_length"), "is_stub", "is_disambig", (F.col("ns") == cfg.category_ns).alias("is_category"),
        (F.col("ns") == cfg.image_ns).alias("is_image"), "text", "categories", "related", "wiki_links", "interwiki", "external_links", "bare_urls", "disambig_links", "templates", "part", "pos",
    )
