"""One page through the pipeline. Plain strings, no Spark."""

from __future__ import annotations

import re
from collections.abc import Callable

from ..config import METADATA_CLASSES, SiteConfig
from .clean import clean_text
from .expand import Page, include
from .links import extract_links, extract_urls, gallery_to_links, imagemap_to_links

_BULLET = re.compile(r"\s*(?:\*\*|##|:#|:\*|#|\*)(.*)\Z", re.S)
_HEADING = re.compile(r"\s*==")
_META = re.compile(rf'<(div|span)\s[^>]*?class="[^">]*?(?:{METADATA_CLASSES})[^">]*"[^>]*>[^<]*</\1>', re.I | re.S)


def related_pieces(text: str, cfg: SiteConfig) -> list[str]:
    """Pieces of text whose links are related articles: standalone lines, inline remarks, the section."""
    lines = text.split("\n")
    out = []
    for line in lines:
        if m := re.match(rf".{{0,5}}?(?:{cfg.related_standalone})(.*)", line, re.I):
            out.append(m[1])
    for line in lines:
        out += re.findall(rf"\(\s*(?:{cfg.related_inline})(.*?)\)", line, re.I)
    inside = False
    for line in lines:
        if _HEADING.match(line):
            if inside:
                break
            inside = bool(re.match(rf"\s*==+\s*(?:{cfg.related_section})", line, re.I))
        elif inside:
            out.append(line)
    return out


def transform_page(page_id: int, title: str, ns: str, text: str, disambig: bool, known: frozenset[str], resolve: Callable[[str], int | None], template: Callable[[str], tuple[int, str] | None], language: dict[str, str], cfg: SiteConfig, urls: bool = True) -> dict:
    """Fields of the page record that need parsing. ``text`` has its comments removed; title is without namespace."""
    clean = lambda s: clean_text(s)
    links_of = lambda s: extract_links(s, known, resolve, clean, cfg)[1]
    out: dict = {"disambig_links": []}
    if disambig:
        out["disambig_links"] = [links_of(m[1]) for line in text.split("\n") if (m := _BULLET.match(line))]
    page = Page(title, ns, known, template, language)
    text = include(text, page, cfg)
    out["templates"] = [{"template_id": i, "params": p} for i, p in page.log]
    related = [x["target_id"] for piece in related_pieces(text, cfg) for x in links_of(piece) if x["target_id"] is not None]
    text = _META.sub(" ", imagemap_to_links(gallery_to_links(text, cfg), cfg))
    out["external_links"], out["bare_urls"] = [], []
    if urls:
        text, out["external_links"], out["bare_urls"] = extract_urls(text)
    interwiki: list[dict] = []
    categories: list[int] = []
    text, out["wiki_links"] = extract_links(text, known, resolve, clean, cfg, interwiki, categories)
    out["interwiki"] = interwiki
    own = lambda ids: list(dict.fromkeys(i for i in ids if i != page_id))
    out["related"] = [i for i in own(related) if i not in set(categories)]
    out["categories"] = own(categories)
    out["text"] = clean_text(text, interwiki, encode=True)
    return out
