"""Main text extraction: the fused ratios against a plain version, pages whose names say nothing, broken markup, edges of the table."""

import re
import time
from collections import defaultdict

import pytest

from wikiloom.llm import extract
from wikiloom.llm.extract import Page, extract_main_text, main_text, path_scores, select

PROSE = "The river rose in the night, and by morning the lower fields were under water. Nobody had seen it so high, they said."
PLAIN = f"<html><body><div><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></div><div><h2>Floods</h2><p>{PROSE}</p><p>{PROSE}</p><ul><li>Tar</li><li>Oil</li></ul></div><div>Buy boots today.</div></body></html>"


def plain_scores(page: Page) -> dict[int, float]:
    groups = defaultdict(list)
    for e, text, inside in page.blocks:
        groups[page.path[e]].append((len(text), len(re.findall(r"[.,;:!?]", text)), inside))
    out = {}
    for p, rows in groups.items():
        around = [r for q, rs in groups.items() if page.up[q] == page.up[p] for r in rs]
        mean = lambda i: (sum(r[i] for r in rows) + sum(r[i] for r in around) / len(around)) / (len(rows) + 1)
        chars = sum(r[0] for r in rows)
        out[p] = mean(0) * (1 + mean(1)) * max(extract.LINKED, 1 - sum(r[2] for r in rows) / chars) * (1 + chars) ** 0.5
    return out


def test_scores_are_the_plain_ratios():
    page = Page(PLAIN)
    got, want = path_scores(page), plain_scores(page)
    assert {p for p, s in enumerate(got) if s} == set(want)
    for p, s in want.items():
        assert got[p] == pytest.approx(s)


def test_ratios_choose_without_any_names():
    assert select(Page(PLAIN)) == ["Floods", PROSE, PROSE, "Tar", "Oil"]
    assert select(Page(PLAIN)) == select(Page(PLAIN, names=False))
    assert len(Page(PLAIN).blocks) == 8


def test_names_help():
    page = f"<body><nav>Home</nav><div class=ad>{PROSE}</div><article><h1>Hi</h1><p>Short one.</p><div class='share'>Tell all.</div></article><div id=comments><p>{PROSE}</p></div><footer>(c)</footer></body>"
    assert main_text(page) == "Hi Short one."
    assert main_text(f"<body><div class=ad>{PROSE}</div></body>") == ""


@pytest.mark.parametrize("piece", ["<a", '<a "', "<div>x", '<a="', "<a\"<b\" x\"", "</script", "<!", "<span class=ad>", "<li>", "<i class='", "<p>&amp"])
def test_broken_pages_take_linear_time(piece):
    began = time.process_time()
    main_text(piece * (1_000_000 // len(piece)))
    assert time.process_time() - began < 10


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("just words", "just words"),
        ("<p>a < b &amp;&lt; c\n\n d</p>", "a < b &< c d"),
        ("<article><p>one<br>two<p>three</article>", "one two three"),
        ("<article><p>a<!-- <p>no</p> -->b</p><!-- open", "ab"),
        ("<article><script>if (a<b) {}</script><p>x</p><style>p{}", "x"),
        ("<article><p>x</p><a href='", "x"),
        ("<article><p>x</p><![CDATA[1 < 2]]></article>", "x 1 < 2"),
        ('<article><p title="a>b">x</p></article>', "x"),
        ("<div hidden>no</div><p>yes</p>", "yes"),
        ("<article><p>x</></p></ 1></article>", "x"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_table_edges(spark):
    rows = [(1, "u", "<p>Hello <b>you</b>, all.</p>", 7), (1, None, None, 7), (None, "u", "", 7), (2, "v", "<article><p>" + "Long text, here. " * 60000 + "</p></article>", 7), (1, "u", "<p>Hello <b>you</b>, all.</p>", 7)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got.collect())
    long = ("Long text, here. " * 60000).strip()
    assert out == [(0, "u", "", 0), (1, "", "", 0), (1, "u", "Hello you, all.", 15), (1, "u", "Hello you, all.", 15), (2, "v", long, len(long))]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
