"""Writing page records: legacy and composite XML, TSV tables, redirects, templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import dedup_drop, link_ids, xml_escape
from ..plans.prescan import Lookups, redirect_report
from ..plans.stats import anchors, external_anchors


def _ids(x: Column) -> Column:
    return F.array_join(x.cast("array<string>"), " ")


def _flag(x: Column) -> Column:
    return x.cast("int").cast("string")


def _attrs(**values) -> Column:
    return F.concat(*[F.concat(F.lit(f' {k}="'), v.cast("string"), F.lit('"')) for k, v in values.items()])


def _content(x: Column) -> Column:
    """Element content of the composite format, where quotes need no escape."""
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _value(x: Column) -> Column:
    """Attribute value of the composite format."""
    return F.replace(F.replace(_content(x), F.lit('"'), F.lit("&quot;")), F.lit("\n"), F.lit("&#10;"))


def _element(name: str, x: Column, attrs: Column | None = None) -> Column:
    return F.concat(F.lit(f"<{name}"), F.lit("") if attrs is None else attrs, F.lit(">"), x, F.lit(f"</{name}>"))


def _lines(x: Column) -> Column:
    """The items, each on a line of its own, with line ends around them; nothing if there are none."""
    return F.when(F.size(x) > 0, F.concat(F.lit("\n"), F.array_join(x, "\n"), F.lit("\n"))).otherwise("")


def legacy_xml(pages: DataFrame) -> DataFrame:
    """(value): one element for each page."""
    out = dedup_drop(link_ids(F.col("wiki_links")), F.col("id"))
    urls = F.array_distinct(F.transform("external_links", lambda l: l["url"]))
    head = _attrs(id=F.col("id"), orglength=F.col("org_length"), newlength=F.col("new_length"), stub=_flag(F.col("is_stub")), categories=F.size("categories"), outlinks=F.size(out), urls=F.size(urls))
    parts = [
        F.concat(F.lit("<page"), head, F.lit(">")),
        _element("title", xml_escape(F.col("title"))),
        _element("categories", _ids(F.col("categories"))),
        _element("links", _ids(out)),
        _element("urls", F.coalesce(F.nullif(_lines(F.transform(urls, xml_escape)), F.lit("")), F.lit("\n"))),
        _element("text", F.concat(F.lit("\n"), F.col("text"), F.lit("\n"))),
        F.lit("</page>"),
    ]
    return pages.select(F.concat_ws("\n", *parts).alias("value"))


def composite_xml(pages: DataFrame) -> DataFrame:
    """(value): one element for each page; inclusions of one template stand together, in order of its first."""
    out = dedup_drop(link_ids(F.col("wiki_links")), F.col("id"))
    head = _attrs(id=F.col("id"), timestamp=F.col("timestamp"), orglength=F.col("org_length"), newlength=F.col("new_length"), stub=_flag(F.col("is_stub")), disambig=_flag(F.col("is_disambig")), category=_flag(F.col("is_category")), image=_flag(F.col("is_image")))
    shown = lambda a: a.isNotNull() & ~a.isin("", "0")
    external = lambda l: F.when(shown(l["anchor"]), _element("link", _content(l["anchor"]), _attrs(url=_value(l["url"])))).otherwise(F.concat(F.lit("<link"), _attrs(url=_value(l["url"])), F.lit(" />")))
    foreign = lambda l: _element("link", _content(l["anchor"]), _attrs(namespace=_value(l["target_ns"]), title=_value(l["target_title"]), loc=l["loc"]))
    param = lambda e: _element("param", _content(e["value"]), _attrs(name=_value(e["key"])))
    incl = lambda t: _element("incl", _lines(F.transform(F.filter(F.map_entries(t["params"]), lambda e: ~e["key"].startswith("=")), param)))
    used = lambda i: _element("template", _lines(F.transform(F.filter("templates", lambda t: t["template_id"] == i), incl)), _attrs(id=i))
    parts = [
        F.concat(F.lit("<page"), head, F.lit(">")),
        _element("title", _content(F.col("title"))),
        _element("categories", _ids(F.col("categories"))),
        _element("links", _ids(out)),
        _element("related", _ids(F.col("related"))),
        _element("external", _lines(F.transform("external_links", external))),
        _element("interwiki", _lines(F.transform(F.filter("wiki_links", lambda l: l["target_ns"].isNotNull()), foreign))),
        F.concat(_element("templates", _lines(F.transform(F.array_distinct(F.transform("templates", lambda t: t["template_id"])), used))), _element("text", F.col("text"))),
        F.lit("</page>"),
    ]
    return pages.select(F.concat_ws("\n", *parts).alias("value"))


def related_rows(pages: DataFrame) -> DataFrame:
    return pages.where(F.size("related") > 0).select(F.col("id").alias("page_id"), _ids(F.col("related")).alias("related"))


def disambig_rows(pages: DataFrame) -> DataFrame:
    """(page_id, line, entries): a row for each bullet; entries are (target or undef, anchor) in turn, joined by tabs."""
    x = pages.select(F.col("id").alias("page_id"), F.posexplode("disambig_links").alias("line", "links"))
    pair = F.flatten(F.transform("links", lambda l: F.array(F.coalesce(l["target_id"].cast("string"), F.lit("undef")), F.replace(l["anchor"], F.lit("\t"), F.lit(" ")))))
    return x.select("page_id", "line", F.array_join(pair, "\t").alias("entries"))


def template_log(pages: DataFrame) -> DataFrame:
    """(template_id, bucket, value): the block of each inclusion; bucket is the first digit of the id."""
    x = pages.select("id", F.explode("templates").alias("t"))
    kept = F.filter(F.map_entries("t.params"), lambda e: ~e["key"].startswith("="))
    lines = F.array_join(F.transform(kept, lambda e: F.concat(e["key"], F.lit(" = "), F.replace(e["value"], F.lit("\n"), F.lit(" ")))), "\n")
    return x.select("t.template_id", F.substring(F.col("t.template_id").cast("string"), 1, 1).alias("bucket"), F.concat(F.lit("Page "), F.col("id").cast("string"), F.when(lines != "", F.concat(F.lit("\n"), lines)).otherwise(""), F.lit("\nEnd")).alias("value"))


def redirect_xml(lookups: Lookups, composite: bool = False) -> DataFrame:
    """(value): redirects; those to or from a template are left out (composite output has them with the templates)."""
    templates = lookups.templates.select(F.col("id").alias("from_id"))
    r = redirect_report(lookups).where("not to_template").join(templates, "from_id", "left_anti")
    name, escape = ("name", _content) if composite else ("title", xml_escape)

    def end(which: str) -> Column:
        known = _element("id", F.coalesce(F.col(f"{which}_id").cast("string"), F.lit("unknown")))
        return _element(which, _lines(F.array(known, _element(name, escape(F.col(f"{which}_title"))))))

    return r.select(_element("redirect", _lines(F.array(end("from"), end("to")))).alias("value"))


def template_index(lookups: Lookups) -> DataFrame:
    """(id, title, names): every template, with the titles of redirects to it."""
    r = redirect_report(lookups).where("to_template").groupBy(F.col("to_id").alias("id")).agg(F.sort_array(F.collect_list("from_title")).alias("names"))
    return lookups.templates.select("id", "title").join(r, "id", "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))


def template_names_xml(lookups: Lookups) -> DataFrame:
    """(value): an element for every title of a template, its own and those of redirects to it."""
    x = template_index(lookups).select("id", F.explode(F.concat(F.array("title"), F.col("names"))).alias("name"))
    return x.select(_element("template", _lines(F.array(_element("name", _content(F.col("name"))), _element("id", F.col("id").cast("string"))))).alias("value"))


def _tsv(df: DataFrame, path: str, codec: str) -> None:
    df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.mode("overwrite").option("compression", codec).text(path)


def _xml(df: DataFrame, path: str, codec: str, head: str, tail: str) -> None:
    """Elements as text, and beside them what makes them a document: ``cat _header part-* _trailer`` (Spark skips names with _)."""
    df.write.mode("overwrite").option("compression", codec).text(path)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for name, text in (("_header", head), ("_trailer", tail)):
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        out = at.getFileSystem(conf).create(at, True)
        out.write(bytearray(text.encode()))
        out.close()


# The frames of the output documents.
DECLARATION = '<?xml version="1.0" encoding="utf-8"?>\n'


def write_legacy(pages: DataFrame, lookups: Lookups, path: str, compress: bool = False, header: str = "<mediawiki>\n") -> None:
    """``header``: the dump's own (``read_header``) or just the root's start."""
    codec = "gzip" if compress else "none"
    _xml(legacy_xml(pages), f"{path}/hgw.xml", codec, header, "</mediawiki>\n")
    _tsv(anchors(pages), f"{path}/anchor_text", codec)
    _tsv(external_anchors(pages), f"{path}/external_anchors", codec)
    _tsv(related_rows(pages), f"{path}/related_links", "none")
    _tsv(disambig_rows(pages).select("page_id", F.nullif("entries", F.lit(""))), f"{path}/disambig", "none")
    _tsv(lookups.templates.select("id", "title"), f"{path}/templates_index", "none")
    template_log(pages).select("bucket", "template_id", "value").write.mode("overwrite").partitionBy("bucket", "template_id").text(f"{path}/templates")
    _xml(redirect_xml(lookups), f"{path}/redir.xml", "none", f"{DECLARATION}<redirects>\n", "</redirects>\n")


def write_composite(pages: DataFrame, lookups: Lookups, path: str, compress: bool = False) -> None:
    codec = "gzip" if compress else "none"
    _xml(composite_xml(pages), f"{path}/gum.xml", codec, f"{DECLARATION}\n<gum>\n", "</gum>\n")
    _tsv(anchors(pages), f"{path}/anchor_text", codec)
    _tsv(disambig_rows(pages).select("page_id", F.nullif("entries", F.lit(""))), f"{path}/disambig", "none")
    _xml(redirect_xml(lookups, True), f"{path}/redir.xml", "none", f"{DECLARATION}\n<redirects>\n", "</redirects>\n")
    _xml(template_names_xml(lookups), f"{path}/tmpl.xml", "none", f"{DECLARATION}\n<templates>\n", "</templates>\n")
