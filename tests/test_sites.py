"""Every site configuration on its own wordings, and the column and page forms of the text operators side by side."""

import pytest
from pyspark.sql import functions as F

from wikiloom.config import SITES
from wikiloom.functions import text as T
from wikiloom.operators.clean import clean_text
from wikiloom.operators.links import extract_links, normalize_date
from wikiloom.operators.page import related_pieces
from wikiloom.plans.pages import transform
from wikiloom.plans.prescan import prescan
from wikiloom.sources.dump import from_columns

#: site: (redirect word, disambiguation title, disambiguation template, a month, heading of related articles)
WORDS = {
    "enwiki": ("REDIRECT", "X (disambiguation)", "hndis", "March", "See also"),
    "slwiki": ("PREUSMERITEV", "X (razločitev)", "razločitev", "Marec", "Glej tudi"),
    "etwiki": ("SUUNA", "X (razdvojba)", "disambig", "Marec", "Glej tudi"),
    "ltwiki": ("PERADRESAVIMAS", "X (razdvojba)", "disambig", "Marec", "Glej tudi"),
    "lvwiki": ("REDIRECT", "X (razdvojba)", "disambig", "Marec", "Glej tudi"),
    "hrwiki": ("PREUSMJERI", "X (razdvojba)", "disambig", "Marec", "Glej tudi"),
    "ruwiki": ("REDIRECT", "X (значения)", "неоднозначность", "Март", "See also"),
    "wikinvest": ("REDIRECT", "X (disambiguation)", "disambig", "March", "See also"),
}


@pytest.mark.parametrize("site", sorted(SITES))
def test_site(spark, site):
    cfg = SITES[site]
    word, title, template, month, heading = WORDS[site]
    rows = [
        (1, "Target", "text"),
        (2, f"{cfg.category_ns}:Top", ""),
        (3, "Old", f"#{word} [[Target#part]]"),
        (4, title, "* [[Target]]"),
        (5, "Page", f"[[old|x]] [[{cfg.category_ns}:Top]] on [[2001-03-05]] {{{{box}}}}\n== {heading} ==\n* [[Target]]"),
        (6, f"{cfg.template_ns}:Box", "B"),
        (7, "Other", f"{{{{{template}}}}}"),
    ]
    raw = from_columns(spark.createDataFrame(rows, "id long, title string, text string"))
    look = prescan(raw, [cfg.category_ns, cfg.template_ns, cfg.image_ns], cfg)
    got = {r.id: r for r in transform(raw, look, cfg).collect()}
    assert sorted(got) == [1, 2, 4, 5, 7]
    page = got[5]
    assert page.categories == [2] and page.related == [1] and [l.target_id for l in page.wiki_links if l.target_id] == [1, 1]
    assert f"{month} 05, 2001 B" in page.text
    assert got[4].is_disambig and got[7].is_disambig and not page.is_disambig
    assert got[4].disambig_links[0][0].target_id == 1 and got[2].is_category
    assert normalize_date("2001-03-05", cfg) == f"[[{month} 05]], [[2001]]"
    assert related_pieces(rows[4][2], cfg)[-1] == "* [[Target]]"


TEXTS = ["plain", "", "a<b>c</b> <<i>x> < 3 &amp; &é; &#12; &x y;", "'''''five''''' '''b''' ''i'' 'q'", "= one =\n== two == \n===three=== \nx == no", "a \n \t\n\n b\nc\n\n\n", "x<br>y<br />z", "<table a=1>\n<td></TABLE>{| a {| b |} |}c", "<math>x<y</math>t", "x<timeline>a</timeline><includeonly>b</includeonly>", "tab\tcr\r\n\r\nend"]


def test_column_and_page_forms_agree(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    c = T.strip_math(T.strip_tables(T.break_lines(T.strip_blocks(F.col("t")))))
    c = T.strip_entities(T.collapse_newlines(T.strip_emphasis(T.strip_tags(c))))
    got = {r.i: r for r in df.select("i", c.alias("plain"), T.headings(T.xml_escape(c)).alias("encoded")).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i].plain == clean_text(t), t
        assert got[i].encoded == clean_text(t, encode=True), t


def test_links_in_links():
    known = frozenset(("File",))
    text, links = extract_links("a [[b [[c]] d]] e[[]]f [[0]]g", known, {"C": 7}.get, str, SITES["enwiki"])
    assert [x["anchor"] for x in links] == ["c"] and "ef g" in text
