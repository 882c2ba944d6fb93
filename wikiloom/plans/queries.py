"""The engine's operators over the driver's tables, each with the SQL that gives the same rows.

Wiki markup is made from the star schema, so that SQL can compute the answer from the columns without parsing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SITES
from ..functions import text as T
from ..sources import sinks
from ..sources.dump import from_columns
from . import stats, tools
from .diagnostics import rejects
from .pages import transform
from .prescan import Lookups, prescan, redirect_report

EN = SITES["enwiki"]
HEADER = ["", "Talk", "User", "User talk", "Template", "Category", "File", "Help"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _list(c: Column | str) -> Column:
    """A list as text, nulls as -, so that results compare the same whatever a client makes of lists."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("-"))), "|")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _world(spark: SparkSession, sf: str, extra: DataFrame | None = None) -> DataFrame:
    """Raw pages: regions as categories (1..), nations (1000..) in them, customers (100000..) that link to their nation."""
    region, nation, customer = (_t(spark, sf, n) for n in ("region", "nation", "customer"))
    r = region.selectExpr("r_regionkey + 1L as id", "concat('Category:', r_name) as title", "'The [[:Category:All|all]]. [[Category:World]]' as text")
    root = spark.range(1).selectExpr("900L as id", "'Category:World' as title", "'Top.' as text")
    n = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr("n_nationkey + 1000L as id", "n_name as title", "concat('A nation. [[category:', r_name, '|', n_name, ']]') as text")
    c = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("c_custkey + 100000L as id", "replace(c_name, '#', ' ') as title", "concat('Lives in [[', n_name, '|the land]] and [[', n_name, ']]. <!-- [[hidden]] --> [[No such page]]', if(c_custkey % 3 = 0, '{{geo-stub}}', '')) as text")
    out = r.unionByName(root).unionByName(n).unionByName(c)
    return from_columns(out if extra is None else out.unionByName(extra))


def _run(spark: SparkSession, raw: DataFrame) -> tuple[DataFrame, Lookups]:
    lookups = prescan(raw, HEADER, EN)
    return transform(raw, lookups, EN), lookups


@query("SELECT n_nationkey + 1000 AS target_id, c_custkey + 100000 AS source_id, 9 AS loc, 'the land' AS anchor FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT n_nationkey + 1000, c_custkey + 100000, 9 + length(n_name) + 18, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def anchor_text(spark, sf):
    """K3, J3, L1-L8."""
    return stats.anchors(_run(spark, _world(spark, sf))[0])


@query("SELECT n_nationkey + 1000 AS target_id, count(*) AS n_inlinks FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def inlink_counts(spark, sf):
    """A4: two links of a page count once."""
    return stats.inlinks(_run(spark, _world(spark, sf))[0])


@query("SELECT n_nationkey + 1000 AS id, CAST(r_regionkey + 1 AS VARCHAR) AS categories FROM nation JOIN region ON n_regionkey = r_regionkey")
def page_categories(spark, sf):
    """L6."""
    return _run(spark, _world(spark, sf))[0].where("id between 1000 and 99999").select("id", _list("categories").alias("categories"))


@query("SELECT r_regionkey + 1 AS category_id, count(*) AS n_pages FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1 UNION ALL SELECT 900, count(*) FROM region")
def category_sizes(spark, sf):
    """A3."""
    return stats.category_sizes(_run(spark, _world(spark, sf))[0])


@query("SELECT 900 AS parent_id, string_agg(CAST(r_regionkey + 1 AS VARCHAR), '|' ORDER BY r_regionkey) AS children FROM region")
def category_hierarchy(spark, sf):
    """A5."""
    return stats.category_tree(_run(spark, _world(spark, sf))[0]).select("parent_id", _list("children").alias("children"))


@query("SELECT c_custkey + 100000 AS id, replace(c_name, '#', ' ') AS title, c_custkey % 3 = 0 AS is_stub, false AS is_category, length('Lives in [[' || n_name || '|the land]] and [[' || n_name || ']]. <!-- [[hidden]] --> [[No such page]]' || CASE WHEN c_custkey % 3 = 0 THEN '{{geo-stub}}' ELSE '' END) AS org_length, 'Lives in <a id=\"' || (n_nationkey + 1000) || '\">the land</a> and <a id=\"' || (n_nationkey + 1000) || '\">' || n_name || '</a>.  No such page' || CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE '' END AS text FROM customer JOIN nation ON c_nationkey = n_nationkey")
def page_records(spark, sf):
    """S1, F2-F4, F7, P1, P10, P16."""
    return _run(spark, _world(spark, sf))[0].where("id >= 100000").select("id", "title", "is_stub", "is_category", "org_length", "text")


def _redirects(spark, sf) -> DataFrame:
    c = _t(spark, sf, "customer").withColumn("c_name", F.replace("c_name", F.lit("#"), F.lit(" ")))
    one = c.selectExpr("c_custkey + 10000000L as id", "concat('alias of ', c_name) as title", "concat('#REDIRECT [[', c_name, '#top]]') as text")
    two = c.where("c_custkey % 2 = 0").selectExpr("c_custkey + 20000000L as id", "concat('far ', c_name) as title", "concat(' #redirects to [[alias of ', c_name, ']]') as text")
    link = c.selectExpr("c_custkey + 30000000L as id", "concat('About ', c_name) as title", "concat('[[alias of ', c_name, '|near]] [[far ', c_name, '|far]]') as text")
    return _world(spark, sf, one.unionByName(two).unionByName(link))


@query("SELECT c_custkey + 30000000 AS id, (c_custkey + 100000) || '|-' AS targets FROM customer")
def redirect_resolution(spark, sf):
    """One hop resolves, two do not, as redirects and as missing pages."""
    pages = _run(spark, _redirects(spark, sf))[0]
    return pages.where("id >= 30000000").select("id", _list(F.transform("wiki_links", lambda l: l["target_id"])).alias("targets"))


@query("SELECT 'unknown' AS from_id, 'Alias of ' || replace(c_name, '#', ' ') AS from_title, CAST(c_custkey + 100000 AS VARCHAR) AS to_id, replace(c_name, '#', ' ') AS to_title, false AS to_template FROM customer UNION ALL SELECT 'unknown', 'Far ' || replace(c_name, '#', ' '), 'unknown', 'Alias of ' || replace(c_name, '#', ' '), false FROM customer WHERE c_custkey % 2 = 0")
def redirect_table(spark, sf):
    """J6, K7, K8."""
    x = redirect_report(prescan(_redirects(spark, sf), HEADER, EN))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c)
    return x.select(name("from_id"), "from_title", name("to_id"), "to_title", "to_template")


@query("SELECT (SELECT count(*) FROM region) + 1 + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) AS pages, CAST((SELECT sum(length('The [[:Category:All|all]]. [[Category:World]]')) FROM region) + 4 + (SELECT sum(length('A nation. [[category:' || r_name || '|' || n_name || ']]')) FROM nation JOIN region ON n_regionkey = r_regionkey) + (SELECT sum(length('Lives in [[' || n_name || '|the land]] and [[' || n_name || ']]. <!-- [[hidden]] --> [[No such page]]' || CASE WHEN c_custkey % 3 = 0 THEN '{{geo-stub}}' ELSE '' END)) FROM customer JOIN nation ON c_nationkey = n_nationkey) AS BIGINT) AS chars")
def dump_totals(spark, sf):
    """A6."""
    return prescan(_world(spark, sf), HEADER, EN).totals


@query("SELECT (SELECT count(*) FROM customer) * 2 + (SELECT count(*) FROM nation) + (SELECT count(*) FROM region) + 1 AS n_titles, (SELECT count(*) FROM customer) + (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS n_redirects, 0 AS n_templates")
def lookup_counts(spark, sf):
    """A7, J2."""
    look = prescan(_redirects(spark, sf), HEADER, EN)
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return one(look.title2id, "n_titles").crossJoin(one(look.redirects, "n_redirects")).crossJoin(one(look.templates, "n_templates"))


def _parts(spark, sf) -> DataFrame:
    """Part pages that use templates; ids 500000.. ; templates 1..3, one with a redirect."""
    p = _t(spark, sf, "part")
    body = (
        "concat('{{part box|brand=', p_brand, '|size=', p_size, if(p_partkey % 2 = 0, '|note=even', ''), '}}/{{pb|', p_type, '}}/{{#if:', if(p_partkey % 3 = 0, 'x', ''), '|yes|no}}/{{#ifeq:', p_size, '|7|seven|other}}/"
        "{{#switch:', p_partkey % 4, '|0=zero|1|2=few|#default=many}}/{{padleft:', p_size, '|5|x}}/{{padright:', p_size, '|4}}/{{lc:', p_brand, '}}/{{ucfirst:', p_name, '}}/{{PAGENAME}}/{{nothing here}}/{{int:Lang}}/{{urlencode:a b&c}}')"
    )
    pages = p.selectExpr("p_partkey + 500000L as id", "concat('Part ', p_partkey) as title", f"{body} as text")
    made = [(1, "Template:Part box", "<noinclude>doc</noinclude>{{{brand}}}-{{{size|0}}}-{{{note|none}}}-{{{missing}}}"), (2, "Template:Pbox", "<includeonly>[{{{1}}}]</includeonly>"), (3, "Template:Pb", "#REDIRECT [[Template:Pbox]]"), (4, "Links", "[[Template:Pbox|x]] [[Part 1]]")]
    rows = spark.createDataFrame(made, "id long, title string, text string")
    return from_columns(pages.unionByName(rows))


@query("SELECT p_partkey + 500000 AS id, p_brand || '-' || p_size || '-' || CASE WHEN p_partkey % 2 = 0 THEN 'even' ELSE 'none' END || '-/[' || p_type || ']/' || CASE WHEN p_partkey % 3 = 0 THEN 'yes' ELSE 'no' END || '/' || CASE WHEN p_size = 7 THEN 'seven' ELSE 'other' END || '/' || CASE p_partkey % 4 WHEN 0 THEN 'zero' WHEN 1 THEN 'few' WHEN 2 THEN 'few' ELSE 'many' END || '/' || lpad(CAST(p_size AS VARCHAR), 5, 'x') || '/' || rpad(CAST(p_size AS VARCHAR), 4, '0') || '/' || lower(p_brand) || '/' || upper(left(p_name, 1)) || substr(p_name, 2) || '/Part ' || p_partkey || '/ /en/a%20b%26c' AS text FROM part")
def template_expansion(spark, sf):
    """Parameters, defaults, redirected templates, parser functions, magic words."""
    return _run(spark, _parts(spark, sf))[0].where("id >= 500000").select("id", "text")


@query("SELECT CAST(4 AS BIGINT) AS id, '-|500001' AS targets")
def template_exclusion(spark, sf):
    """Links to templates do not resolve."""
    return _run(spark, _parts(spark, sf))[0].where("id = 4").select("id", _list(F.transform("wiki_links", lambda l: l["target_id"])).alias("targets"))


@query("SELECT 1 AS template_id, 'Template:Part box' AS title, count(*) AS n FROM part WHERE p_partkey % 2 = 0")
def template_usage(spark, sf):
    """A8, T4."""
    pages, look = _run(spark, _parts(spark, sf))
    return stats.template_usage(pages, look.templates, "NOTE")


@query("SELECT p_partkey + 500000 AS id, 1 AS template_id, p_brand AS brand, CAST(p_size AS VARCHAR) AS size FROM part UNION ALL SELECT p_partkey + 500000, 2, '-', '-' FROM part")
def template_includes(spark, sf):
    """K10's rows: the inclusion log."""
    x = _run(spark, _parts(spark, sf))[0].select("id", F.explode("templates").alias("t"))
    return x.select("id", "t.template_id", F.coalesce(F.try_element_at("t.params", F.lit("brand")), F.lit("-")).alias("brand"), F.coalesce(F.try_element_at("t.params", F.lit("size")), F.lit("-")).alias("size"))


@query("SELECT 1 AS id, 'Template:Part box' AS title, '' AS names UNION ALL SELECT 2, 'Template:Pbox', 'Template:Pb'")
def template_index(spark, sf):
    """K9."""
    return sinks.template_index(prescan(_parts(spark, sf), HEADER, EN)).select("id", "title", _list("names").alias("names"))


@query("SELECT o_orderkey AS id, strftime(o_orderdate, '[[%B %d]], [[%Y]]') AS text FROM orders")
def date_links(spark, sf):
    """L9 as a column."""
    o = _t(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("id"), T.normalize_date(F.date_format("o_orderdate", "yyyy-MM-dd"), EN).alias("text"))


@query("SELECT o_orderkey AS id, strftime(o_orderdate, '%B %d|%Y') AS anchors FROM orders")
def date_link_records(spark, sf):
    """L3: date links in pages."""
    o = _t(spark, sf, "orders").selectExpr("o_orderkey as id", "concat('Order ', o_orderkey) as title", "concat('On [[', date_format(o_orderdate, 'yyyy-MM-dd'), ']].') as text")
    return _run(spark, from_columns(o))[0].select("id", _list(F.transform("wiki_links", lambda l: l["anchor"])).alias("anchors"))


def _suppliers(spark, sf) -> DataFrame:
    s = _t(spark, sf, "supplier")
    text = "concat('[http://www.example.com/s', s_suppkey, ' ', s_name, '] and http://example.org/', s_suppkey, ' and [gopher://g.example] xhttp://no ', '[foo://bar baz]')"
    return from_columns(s.selectExpr("s_suppkey as id", "s_name as title", f"{text} as text"))


@query("SELECT s_suppkey AS source_id, 'http://www.example.com/s' || s_suppkey AS url, s_name AS anchor FROM supplier")
def external_anchors(spark, sf):
    """U2, K4."""
    return stats.external_anchors(_run(spark, _suppliers(spark, sf))[0])


@query("SELECT s_suppkey AS id, 'http://www.example.com/s' || s_suppkey || '|gopher://g.example|http://example.org/' || s_suppkey AS urls, 'http://example.org/' || s_suppkey AS bare_urls FROM supplier")
def external_urls(spark, sf):
    """U1-U3."""
    return _run(spark, _suppliers(spark, sf))[0].select("id", _list(F.transform("external_links", lambda l: l["url"])).alias("urls"), _list("bare_urls").alias("bare_urls"))


def _related(spark, sf) -> DataFrame:
    s = _t(spark, sf, "supplier").selectExpr("s_suppkey as k", "replace(s_name, '#', ' ') as name", "s_nationkey as n")
    text = "concat('See also [[', name, ']] and [[supplier of ', k, ']]\\nText (see [[Nation ', n, ']]) more.\\n== See also ==\\n* [[Nation ', n, ']]\\n* [[Nowhere]]\\n== Next ==\\n[[', name, ']]')"
    pages = s.selectExpr("k + 1000L as id", "concat('supplier of ', k) as title", f"{text} as text").unionByName(s.selectExpr("k + 5000000L as id", "name as title", "'' as text"))
    nations = _t(spark, sf, "nation").selectExpr("n_nationkey + 1L as id", "concat('Nation ', n_nationkey) as title", "'N' as text")
    return from_columns(pages.unionByName(nations))


@query("SELECT s_suppkey + 1000 AS id, (s_suppkey + 5000000) || '|' || (s_nationkey + 1) AS related FROM supplier")
def related_articles(spark, sf):
    """R1-R4, A1, J7, K5."""
    return _run(spark, _related(spark, sf))[0].where("size(related) > 0").select("id", _list("related").alias("related"))


@query("SELECT n_nationkey + 1000 AS page_id, CAST(line AS INTEGER) AS line, CASE line WHEN 0 THEN (n_nationkey + 1) || chr(9) || n_name || chr(9) || 'undef' || chr(9) || 'x y' ELSE '' END AS entries FROM nation, (SELECT unnest([0, 1]) AS line)")
def disambiguation(spark, sf):
    """D1, D2, K6."""
    n = _t(spark, sf, "nation")
    pages = n.selectExpr("n_nationkey + 1000L as id", "concat(n_name, ' (disambiguation)') as title", "concat('May be:\\n* [[', n_name, ']] or [[Nobody|x\\ty]]\\n# no link\\nnot [[', n_name, ']]') as text")
    raw = from_columns(pages.unionByName(n.selectExpr("n_nationkey + 1L as id", "n_name as title", "'{{other}}' as text")))
    return sinks.disambig_rows(_run(spark, raw)[0])


@query("SELECT r_regionkey AS id, 'Memoryalpha' AS ns, upper(left(r_name, 1)) || substr(r_name, 2) AS title, 'In <w namespace=\"Memoryalpha\" title=\"' || r_name || '\">there</w>.' AS text FROM region")
def interwiki_links(spark, sf):
    """L10, P16."""
    r = _t(spark, sf, "region").selectExpr("r_regionkey + 0L as id", "concat('About ', r_name) as title", "concat('In [[memoryalpha:', r_name, '|there]].') as text")
    x = _run(spark, from_columns(r))[0]
    return x.select(F.col("id").cast("int").alias("id"), F.col("interwiki")[0]["ns"].alias("ns"), F.col("interwiki")[0]["title"].alias("title"), "text")


@query("SELECT p_partkey AS id, p_name || ' long caption|' || p_type AS anchors FROM part")
def galleries_and_captions(spark, sf):
    """Image lines become links, the longest free field is the caption."""
    p = _t(spark, sf, "part").selectExpr("p_partkey as id", "concat('Part ', p_partkey) as title", "concat('<gallery>\\nImage:P', p_partkey, '.png|thumb|250px|short|', p_name, ' long caption\\n</gallery><imagemap>\\nFile:M.png|', p_type, '\\n# remark\\n</imagemap>') as text")
    return _run(spark, from_columns(p))[0].select("id", _list(F.transform("wiki_links", lambda l: l["anchor"])).alias("anchors"))


@query("SELECT c_custkey AS id, c_name || chr(10) || 'kept  ' || c_mktsegment || ' ' || chr(10) || '<h1> Head </h1>' AS text FROM customer")
def tables_math_nowiki(spark, sf):
    """P5-P13, P17 in pages."""
    c = _t(spark, sf, "customer").selectExpr("c_custkey as id", "c_name as title", "concat(c_name, '{| x {| y |} z |}kept <math>a<b</math>', \"'''\", c_mktsegment, \"'''\", '&nbsp;\\n== Head ==') as text")
    return _run(spark, from_columns(c))[0].select("id", "text")


# Column operators over the driver's texts and pages.


@query(r"SELECT page_id, regexp_replace(html, '<!--(?s:.*?)-->', '', 'g') AS text FROM pages")
def strip_comments(spark, sf):
    """P1."""
    return _t(spark, sf, "pages").select("page_id", T.strip_comments(F.col("html")).alias("text"))


@query("SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), chr(34), '&quot;'), chr(39), '&apos;'), '<', '&lt;'), '>', '&gt;') AS text FROM pages")
def xml_escape(spark, sf):
    """P15."""
    return _t(spark, sf, "pages").select("page_id", T.xml_escape(F.col("html")).alias("text"))


@query(r"SELECT page_id, regexp_replace(html, '</?[A-Za-z][^<>]*>', ' ', 'g') AS text FROM pages")
def strip_tags(spark, sf):
    """P11."""
    return _t(spark, sf, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


@query(r"SELECT page_id, regexp_replace(html, '<br ?/?>', chr(10) || chr(10), 'g') AS text FROM pages")
def break_lines(spark, sf):
    """P7."""
    return _t(spark, sf, "pages").select("page_id", T.break_lines(F.col("html")).alias("text"))


@query(r"SELECT page_id, regexp_replace(html, '&#?[0-9A-Za-z_]+;', ' ', 'g') AS text FROM pages")
def strip_entities(spark, sf):
    """P14."""
    return _t(spark, sf, "pages").select("page_id", T.strip_entities(F.col("html")).alias("text"))


@query("SELECT doc_id, upper(left(text, 1)) || substr(text, 2) AS first_upper, length(text) AS n, contains(lower(text), 'stub}}') AS is_stub, lpad(CAST(doc_id AS VARCHAR), 12, 'ab') AS padded, 'x' || lang AS marked FROM documents")
def scalar_functions(spark, sf):
    """F7, ucfirst, padding, lengths."""
    d = _t(spark, sf, "documents")
    return d.select("doc_id", T.ucfirst(F.col("text")).alias("first_upper"), F.length("text").cast("long").alias("n"), T.is_stub(F.col("text")).alias("is_stub"), T.pad_to(F.col("doc_id").cast("string"), F.lit("12"), F.lit("ab")).alias("padded"), F.concat(F.lit("x"), "lang").alias("marked"))


@query("SELECT c_custkey, 'Template:' || c_name AS as_template, 'Category:' || c_name AS as_category, 'File:' || c_name AS as_image, c_name AS as_page FROM customer")
def title_normalisation(spark, sf):
    """§1.4: blanks, underscores, case of prefixes, aliases."""
    c = _t(spark, sf, "customer")
    norm = lambda s, ns=None: T.normalize_title(F.expr(s), HEADER, EN, ns)
    return c.select("c_custkey", norm("concat('_', c_name, ' ')", "Template").alias("as_template"), norm("concat(' cATEGORY: ', c_name)").alias("as_category"), norm("concat('image:', c_name)").alias("as_image"), norm("concat(':', c_name)").alias("as_page"))


@query("SELECT coalesce(n.c_custkey, o.c_custkey) AS id, CASE WHEN n.c_custkey IS NOT NULL THEN 'new ' || n.c_name ELSE o.c_name END AS title, CASE WHEN o.c_custkey IS NULL THEN 'new' WHEN n.c_custkey IS NULL THEN 'unmodified' ELSE 'updated' END AS status FROM (SELECT * FROM customer WHERE c_custkey % 3 <> 0) o FULL JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) n ON o.c_custkey = n.c_custkey WHERE o.c_custkey IS NOT NULL OR n.c_custkey IS NOT NULL")
def riffle(spark, sf):
    """T3; the slices are the operator's two inputs."""
    c = _t(spark, sf, "customer")
    old = c.where("c_custkey % 3 <> 0").selectExpr("c_custkey as id", "c_name as title")
    return tools.merge_pages(old, c.where("c_custkey % 2 = 0").selectExpr("c_custkey as id", "concat('new ', c_name) as title"))


_TEMPLATE_PAGES = "(VALUES (1, 'Template:Part box'), (2, 'Template:Pbox'), (3, 'Template:Pb'))"
_DRAW = "((id % 2147483648) * 2654435761 + 12345) % 4294967296 // 65536"


@query(f"SELECT p_partkey + 500000 AS id, 'Part ' || p_partkey AS title FROM (SELECT p_partkey, p_partkey + 500000 AS id FROM part) WHERE {_DRAW} % 50 = 1 UNION ALL SELECT * FROM {_TEMPLATE_PAGES} t(id, title)")
def sample(spark, sf):
    """T1."""
    return tools.sample_pages(_parts(spark, sf), one_in=50, cap=None).select("id", "title")


@query(f"SELECT id, CAST({_DRAW} % 4 AS INTEGER) AS split FROM (SELECT p_partkey + 500000 AS id FROM part UNION ALL SELECT unnest([1, 2, 3, 4]))")
def split(spark, sf):
    """T2."""
    return tools.split_pages(_parts(spark, sf), 4).select("id", "split")


@query("SELECT p_partkey AS id, p_brand || '|' || p_type AS kept FROM part")
def list_operators(spark, sf):
    """A1, A2, J7 on lists."""
    x = F.array("p_brand", F.lit("own"), "p_type", "p_brand", F.lit("gone"))
    return _t(spark, sf, "part").select(F.col("p_partkey").alias("id"), _list(T.array_minus(T.dedup_drop(x, F.lit("own")), F.array(F.lit("gone")))).alias("kept"))


@query("SELECT c_custkey AS id, 1 AS n_pages FROM customer")
def legacy_pages(spark, sf):
    """K1: every page is one well-formed element."""
    c = _t(spark, sf, "customer").selectExpr("c_custkey as id", "c_name as title", "'<b>x</b> & y' as text")
    x = sinks.legacy_xml(_run(spark, from_columns(c))[0])
    return x.select(F.xpath_int("value", F.lit("/page/@id")).cast("long").alias("id"), F.xpath_int("value", F.lit("count(/page)")).alias("n_pages"))


@query("SELECT n_nationkey AS id, 'Category:' || replace(n_name, '_', ' ') AS title, 1 AS n_cats FROM nation")
def composite_pages(spark, sf):
    """K2."""
    n = _t(spark, sf, "nation").selectExpr("n_nationkey as id", "concat('Category:', n_name) as title", "concat('[[Category:Top]] [http://a.example?b&c x]') as text")
    raw = from_columns(n.unionByName(spark.range(1).selectExpr("100000L as id", "'Category:Top' as title", "'' as text")))
    x = sinks.composite_xml(_run(spark, raw)[0].where("id < 100000"))
    return x.select(F.xpath_int("value", F.lit("/page/@id")).alias("id"), F.xpath_string("value", F.lit("/page/title")).alias("title"), F.xpath_int("value", F.lit("/page/@category")).alias("n_cats"))


@query("SELECT o_orderkey AS page_id, 'duplicate_title' AS code, 'C' || o_custkey AS detail FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n > 1")
def rejected_pages(spark, sf):
    """K14, F4 to F6."""
    o = _t(spark, sf, "orders").selectExpr("o_orderkey as id", "concat('C', o_custkey) as title", "'' as text")
    return rejects(from_columns(o), HEADER, EN)
