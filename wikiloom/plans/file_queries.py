"""Queries that go through files (dumps that are read, documents that are written and read again), and markup that others leave out.

Their dumps and documents are made from the driver's tables in the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import sinks
from ..sources.dump import from_columns, read_dump, read_namespaces
from ..sources.staging import folder
from . import stats, tools
from .pages import transform
from .prescan import load, prescan
from .queries import EN, HEADER, _list, _parts, _redirects, _run, _t, _world, query


def _place(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def _write_document(rows: DataFrame, path: str, codec: str, head: str, tail: str) -> None:
    """One XML document: the rows' elements (n, value) between its frame, in one file, as dumps are."""
    frame = rows.sparkSession.createDataFrame([(0, 0, head), (2, 0, tail)], "k int, n long, value string")
    every = frame.unionByName(rows.select(F.lit(1).alias("k"), F.col("n").cast("long").alias("n"), "value"))
    every.repartition(1).sortWithinPartitions("k", "n").select("value").write.option("compression", codec).text(path)


def _write_part(pages: DataFrame, path: str, codec: str) -> None:
    """Pages (id, title, text) as a part of a dump."""
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    text = F.concat(F.lit('<text xml:space="preserve">'), T.xml_escape(F.col("text")), F.lit("</text>"))
    rows = F.concat(F.lit("<page>"), tag("title", T.xml_escape(F.col("title"))), tag("id", F.col("id").cast("string")), tag("revision", F.concat(tag("timestamp", F.lit("2024-01-02T03:04:05Z")), text)), F.lit("</page>"))
    _write_document(pages.select(F.col("id").alias("n"), rows.alias("value")), path, codec, "<mediawiki>", "</mediawiki>")


@query("SELECT c_custkey AS id, c_name || ' & co' AS title, 'He said:  \"' || c_mktsegment || ' < 7\"' || chr(10) || chr(10) || ' end & <ref>x</ref> ' AS text, '2024-01-02T03:04:05Z' AS timestamp, 'enwiki' AS dump, '20240101' AS date, c_custkey % 3 AS part FROM customer")
def dump_scan(spark, sf):
    """A dump in three parts, plain, .gz and .bz2, read by the name of its first part."""
    root = f"{_place(spark, 'dump')}/enwiki-20240101-pages-articles.xml"
    c = _t(spark, sf, "customer").selectExpr("c_custkey as id", "concat(c_name, ' & co') as title", "concat('He said:  \"', c_mktsegment, ' < 7\"\\n\\n end & <ref>x</ref> ') as text")
    for i, codec in enumerate(("none", "gzip", "bzip2")):
        _write_part(c.where(F.col("id") % 3 == i), f"{root}.{i:04}", codec)
    x = read_dump(spark, f"{root}.0000")
    return x.select("id", "title", "text", "timestamp", "dump", "date", F.regexp_extract("part", r"\.xml\.([0-9]{4})", 1).cast("long").alias("part"))


@query("SELECT n_nationkey AS key, n_name AS name FROM nation UNION ALL SELECT -1, ''")
def dump_namespaces(spark, sf):
    """S4."""
    path = _place(spark, "header")
    n = _t(spark, sf, "nation").selectExpr("n_nationkey as n", "concat('<namespace key=\"', n_nationkey, '\">', n_name, '</namespace>') as value")
    n = n.unionByName(spark.range(1).selectExpr("-1 as n", "'<namespace key=\"-1\" />' as value"))
    _write_document(n, path, "none", "<mediawiki><siteinfo><namespaces>", "</namespaces></siteinfo></mediawiki>")
    return read_namespaces(spark, path)


@query("SELECT c_custkey + 30000000 AS id, (c_custkey + 100000) || '|-' AS targets FROM customer")
def saved_lookups(spark, sf):
    """Lookup tables written, read again and resolved by."""
    raw, path = _redirects(spark, sf), _place(spark, "lookups")
    prescan(raw, HEADER, EN).save(path)
    pages = transform(raw, load(spark, path), EN)
    return pages.where("id >= 30000000").select("id", _list(F.transform("wiki_links", lambda l: l["target_id"])).alias("targets"))


_LEGACY = "_id BIGINT, _orglength INT, _newlength INT, _stub INT, _categories INT, _outlinks INT, _urls INT, title STRING, categories STRING, links STRING, urls STRING, text STRING"


def _xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """The elements of a written document's parts."""
    parts = spark.read.option("lineSep", f"</{tag}>\n").text(path)
    return parts.select(F.from_xml(F.concat("value", F.lit(f"</{tag}>")), schema, {"ignoreSurroundingSpaces": "false"}).alias("x")).select("x.*")


def _firm(spark, sf) -> DataFrame:
    """Suppliers with a category, a link, a URL of two spellings and markup to escape; nations as targets."""
    s = _t(spark, sf, "supplier").selectExpr("s_suppkey + 1000L as id", "concat(s_name, ' & sons') as title", "concat('[[Category:Firms]]A \"firm\" & co in [[Nation ', s_nationkey, ']]. [http://www.example.com/?a=1&b=', s_suppkey, ' site][http://www.example.com/?a=1&b=', s_suppkey, ' again]') as text")
    n = _t(spark, sf, "nation").selectExpr("n_nationkey + 1L as id", "concat('Nation ', n_nationkey) as title", "'' as text")
    return from_columns(s.unionByName(n).unionByName(spark.range(1).selectExpr("999L as id", "'Category:Firms' as title", "'' as text")))


@query("SELECT s_suppkey + 1000 AS id, length('[[Category:Firms]]A \"firm\" & co in [[Nation ' || s_nationkey || ']]. [http://www.example.com/?a=1&b=' || s_suppkey || ' site][http://www.example.com/?a=1&b=' || s_suppkey || ' again]') AS org_length, length(' &quot;firm&quot; &amp; co in <a id=\"' || (s_nationkey + 1) || '\">Nation ' || s_nationkey || '</a>. siteagain') AS new_length, false AS stub, 1 AS n_categories, 1 AS n_links, 1 AS n_urls, s_name || ' & sons' AS title, '999' AS categories, CAST(s_nationkey + 1 AS VARCHAR) AS links, 'http://www.example.com/?a=1&b=' || s_suppkey AS urls FROM supplier")
def legacy_document(spark, sf):
    """The whole record of the compressed legacy document, read back; letters glued to a category link go with it."""
    pages, look = _run(spark, _firm(spark, sf))
    path = _place(spark, "legacy")
    sinks.write_legacy(pages, look, path, compress=True)
    x = _xml(spark, f"{path}/hgw.xml", "page", _LEGACY).where("_id >= 1000")
    return x.selectExpr("_id as id", "_orglength as org_length", "_newlength as new_length", "_stub = 1 as stub", "_categories as n_categories", "_outlinks as n_links", "_urls as n_urls", "title", "categories", "links", "trim('\n', urls) as urls")


_COMPOSITE = (
    "_id BIGINT, _timestamp STRING, _orglength INT, _newlength INT, _stub INT, _disambig INT, _category INT, _image INT, title STRING, categories STRING, links STRING, related STRING, external STRUCT<link: ARRAY<STRUCT<_VALUE: STRING, _url: STRING>>>, "
    "interwiki STRUCT<link: ARRAY<STRUCT<_VALUE: STRING, _namespace: STRING, _title: STRING, _loc: INT>>>, templates STRUCT<template: ARRAY<STRUCT<_id: BIGINT, incl: ARRAY<STRUCT<param: ARRAY<STRUCT<_VALUE: STRING, _name: STRING>>>>>>>"
)


@query("SELECT n_nationkey + 1000 AS id, replace(n_name, '_', ' ') || ' <&>' AS title, 0 AS stub, 0 AS disambig, 0 AS category, 0 AS image, '999' AS categories, '1' AS links, '1' AS related, 'http://a.example/?b&c=' || n_nationkey || ' x \"y\"' AS external, 'Memoryalpha:' || replace(n_name, '_', ' ') || '=there' AS interwiki, '2:k=' || n_name || ',l=<' AS templates FROM nation")
def composite_document(spark, sf):
    """K2: the whole record of the composite document, read back."""
    n = _t(spark, sf, "nation")
    text = "concat('See also [[World]]\\n[[Category:Top]]{{Box|k=', n_name, '|l=<}}[http://a.example/?b&c=', n_nationkey, ' x \"y\"] [[memoryalpha:', n_name, '|there]]')"
    rows = spark.createDataFrame([(1, "World", ""), (2, "Template:Box", "box"), (999, "Category:Top", "")], "id long, title string, text string")
    pages, look = _run(spark, from_columns(n.selectExpr("n_nationkey + 1000L as id", "concat(n_name, ' <&>') as title", f"{text} as text").unionByName(rows)))
    path = _place(spark, "composite")
    sinks.write_composite(pages, look, path)
    x = _xml(spark, f"{path}/gum.xml", "page", _COMPOSITE).where("_id >= 1000")
    join = lambda c, f: F.array_join(F.transform(c, f), ",")
    templates = join("templates.template", lambda t: F.concat(t["_id"].cast("string"), F.lit(":"), join(F.flatten(F.transform(t["incl"], lambda i: i["param"])), lambda p: F.concat(p["_name"], F.lit("="), p["_VALUE"]))))
    return x.select(
        F.col("_id").alias("id"), "title", *[F.col(f"_{c}").alias(c) for c in ("stub", "disambig", "category", "image")], "categories", "links", "related",
        join("external.link", lambda l: F.concat(l["_url"], F.lit(" "), l["_VALUE"])).alias("external"), join("interwiki.link", lambda l: F.concat(l["_namespace"], F.lit(":"), l["_title"], F.lit("="), l["_VALUE"])).alias("interwiki"), templates.alias("templates"),
    )


@query("SELECT template_id, CAST(template_id AS VARCHAR) AS bucket, line, count(*) AS n FROM (SELECT 1 AS template_id, unnest(['Page ' || (p_partkey + 500000), 'brand = ' || p_brand, 'size = ' || p_size, CASE WHEN p_partkey % 2 = 0 THEN 'note = even' END, 'End']) AS line FROM part UNION ALL SELECT 2, unnest(['Page ' || (p_partkey + 500000), '1 = ' || p_type, 'End']) FROM part) WHERE line IS NOT NULL GROUP BY ALL")
def template_log_files(spark, sf):
    """The inclusion log as written, a folder for each template."""
    pages, look = _run(spark, _parts(spark, sf))
    path = _place(spark, "log")
    sinks.write_legacy(pages, look, path)
    x = spark.read.text(f"{path}/templates")
    return x.groupBy(F.col("template_id").cast("int").alias("template_id"), F.col("bucket").cast("string").alias("bucket"), F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'unknown' AS from_id, 'Alias of ' || replace(c_name, '#', ' ') AS from_title, CAST(c_custkey + 100000 AS VARCHAR) AS to_id, replace(c_name, '#', ' ') AS to_title FROM customer UNION ALL SELECT 'unknown', 'Far ' || replace(c_name, '#', ' '), 'unknown', 'Alias of ' || replace(c_name, '#', ' ') FROM customer WHERE c_custkey % 2 = 0")
def redirect_document(spark, sf):
    """K7: the redirects' document, read back."""
    look = prescan(_redirects(spark, sf), HEADER, EN)
    path = _place(spark, "redirects")
    sinks.redirect_xml(look).write.text(path)
    end = "STRUCT<id: STRING, title: STRING>"
    x = _xml(spark, path, "redirect", f"`from` {end}, `to` {end}")
    return x.select(F.col("from.id").alias("from_id"), F.col("from.title").alias("from_title"), F.col("to.id").alias("to_id"), F.col("to.title").alias("to_title"))


def _marked(spark, sf, text: str) -> DataFrame:
    c = _t(spark, sf, "customer").selectExpr("c_custkey + 100000L as id", "replace(c_name, '#', ' ') as title", f"{text} as text")
    rows = spark.createDataFrame([(1, "Target", ""), (2, "Template:Box", "[{{{1}}}]")], "id long, title string, text string")
    return _run(spark, from_columns(c.unionByName(rows)))[0].where("id >= 100000")


@query("SELECT c_custkey + 100000 AS id, c_mktsegment || ' ' || c_custkey || ' kept<' AS text FROM customer")
def metadata_blocks(spark, sf):
    """P5: elements of metadata classes go, in any case and with attributes before the class; with tags inside they are no more than tags."""
    x = _marked(spark, sf, "concat(c_mktsegment, '<span class=\"geo\">1; 2</span>', c_custkey, '<DIV id=\"a\" class=\"x metadata\">gone</DIV>kept&lt;')")
    return x.select("id", F.regexp_replace(F.replace("text", F.lit(" "), F.lit(" ")), "kept $", "kept<").alias("text"))


@query("SELECT c_custkey + 100000 AS id, 'a ' || c_mktsegment || ' b c' AS text FROM customer")
def include_only_blocks(spark, sf):
    """Include-only and timeline blocks of a page that is no template."""
    return _marked(spark, sf, "concat('a<includeonly>x', c_custkey, '</includeonly>', c_mktsegment, '<timeline>t\\nu</timeline>b<onlyinclude>y</onlyinclude>c')").select("id", "text")


@query("SELECT c_custkey + 100000 AS id, 'a ' || c_mktsegment || ' b}} c' AS text FROM customer")
def leftover_templates(spark, sf):
    """P10: what is left of templates goes from the inside out; closing braces alone stay."""
    return _marked(spark, sf, "concat('a{{unknown {{inner ', c_custkey, '}} x}}', c_mktsegment, '{{{arg}}}b}} c')").select("id", "text")


@query("SELECT c_custkey + 100000 AS id, c_mktsegment || chr(10) || chr(10) || 'b' || chr(10) || 'c' || chr(10) || chr(10) || 'd' AS text FROM customer")
def newline_runs(spark, sf):
    """White space that holds two line ends or more becomes an empty line; one line end stays."""
    return _marked(spark, sf, "concat(c_mktsegment, ' \\n \\t\\n\\n  b\\nc\\n\\nd')").select("id", "text")


@query("SELECT c_custkey + 100000 AS id, ' <a id=\"1\">Target</a>    [x] ' AS text, '1' AS targets FROM customer")
def nowiki_blocks(spark, sf):
    """What nowiki masks is not expanded; it is a template left over, then, and links in it stay links."""
    x = _marked(spark, sf, "concat('<nowiki>[[Target]] {{Box|', c_custkey, '}}</nowiki> {{Box|x}} ')")
    return x.select("id", "text", _list(F.transform("wiki_links", lambda l: l["target_id"])).alias("targets"))


@query("SELECT c_custkey + 100000 AS id, 'ab ' || 'xk' || c_custkey || 'y -  - n' || c_custkey || 's -' AS text, 'xk' || c_custkey || 'y|Nope:x' || c_custkey || '|n' || c_custkey || 's' AS anchors FROM customer")
def link_variants(spark, sf):
    """Empty links, links in links, unresolved titles with a colon; glued letters belong to the anchor."""
    x = _marked(spark, sf, "concat('a[[]]b x[[k', c_custkey, ']]y - [[Nope:x', c_custkey, ']] - [[Nowhere|n', c_custkey, ']]s -')")
    return x.select("id", "text", _list(F.transform("wiki_links", lambda l: l["anchor"])).alias("anchors"))


@query("SELECT c_custkey + 100000 AS id, 'Target' || c_custkey || '|Berlin' || c_custkey AS anchors FROM customer")
def pipe_trick(spark, sf):
    """An empty label is the title without prefix and parenthesis."""
    x = _marked(spark, sf, "concat('[[Help:Target', c_custkey, ' (page)|]] [[Berlin', c_custkey, ' (city)|]]')")
    return x.select("id", _list(F.transform("wiki_links", lambda l: l["anchor"])).alias("anchors"))


@query("SELECT c_custkey + 100000 AS id, '/' || n || '/' || n || '/' || replace(n, ' ', '%20') || '/' || replace(n, ' ', '%20') || '/Deutsch/second' AS text FROM (SELECT c_custkey, replace(c_name, '#', ' ') AS n FROM customer)")
def magic_words(spark, sf):
    """Magic words, #language, and a name that is no function."""
    return _marked(spark, sf, "'{{NAMESPACE}}/{{PAGENAME}}/{{FULLPAGENAME}}/{{PAGENAMEE}}/{{FULLPAGENAMEE}}/{{#language:de}}/{{nosuch:x|second}}'").select("id", "text")


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN o.c_custkey IS NULL THEN 'new' WHEN n.c_custkey IS NULL THEN 'unmodified' ELSE 'updated' END AS status FROM (SELECT * FROM customer WHERE c_custkey % 3 <> 0) o FULL JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) n ON o.c_custkey = n.c_custkey WHERE o.c_custkey IS NOT NULL OR n.c_custkey IS NOT NULL) GROUP BY status")
def riffle_counts(spark, sf):
    """T3's summary."""
    c = _t(spark, sf, "customer")
    old = c.where("c_custkey % 3 <> 0").selectExpr("c_custkey as id", "c_name as title")
    return tools.merge_counts(tools.merge_pages(old, c.where("c_custkey % 2 = 0").selectExpr("c_custkey as id", "concat('new ', c_name) as title")))


@query("SELECT 900 AS parent_id, string_agg(CAST(r_regionkey + 1 AS VARCHAR), '|' ORDER BY r_regionkey DESC) AS children FROM region")
def category_arrival(spark, sf):
    """A5: children in the order of their pages in the dump."""
    raw = _world(spark, sf).withColumn("pos", -F.col("id"))
    return stats.category_tree(_run(spark, raw)[0]).select("parent_id", _list("children").alias("children"))
