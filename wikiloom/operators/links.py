"""Internal links, dates, captions and external links on plain strings."""

from __future__ import annotations

import re
from collections.abc import Callable

from ..config import IMAGE_OPTIONS, IMAGE_PARAMETERS, MONTH_DAYS, PROTOCOLS, SiteConfig
from .titles import full_title, split_title

#: A resolved link stands in the text as BEGIN id MIDDLE anchor END; the marks are as long as those whose offsets are the contract.
BEGIN, MIDDLE, END = "\ue000" * 8, "\ue001" * 2, "\ue002" * 8
# The prefix is tried once a word, at its start: long words cost no more than their length.
_LINK = re.compile(r"((?:(?<!\w)\w++)?)\[\[([^\[]*?)\]\](\w*)", re.S)
_SECTION = re.compile(r"\s*#")
_SKIP = re.compile(rf"\s*(?:{IMAGE_OPTIONS})\s*\Z|\s*(?:{IMAGE_PARAMETERS})=", re.I)
_URL = r"[a-z]+:(?:[\w!#$&'()*+,\-./:;=?@_~]|%[0-9a-fA-F]{2})+"
_BRACKETED = re.compile(rf"\[({_URL})([^\]\n]*)\]")
_BARE = re.compile(_URL)


def caption(fields: list[str]) -> str:
    return max((f for f in fields if not _SKIP.match(f)), key=len, default="")


def normalize_date(link: str, cfg: SiteConfig) -> str | None:
    link = link.strip()
    if m := re.fullmatch(r"([0-9]{1,2})\s+([A-Za-z]+)", link):
        name = m[2].capitalize()
        if name in cfg.months and 1 <= int(m[1]) <= MONTH_DAYS[cfg.months.index(name)]:
            return f"[[{name} {m[1]}]]"
    elif m := re.fullmatch(r"(?:([0-9]{3,4})-)?([0-9]{1,2})-([0-9]{1,2})", link):
        month, day = int(m[2]), int(m[3])
        if 1 <= month <= 12 and 1 <= day <= MONTH_DAYS[month - 1]:
            return f"[[{cfg.months[month - 1]} {m[3]}]]" + (f", [[{m[1]}]]" if m[1] else "")
    return None


def extract_links(text: str, known: frozenset[str], resolve: Callable[[str], int | None], clean: Callable[[str], str], cfg: SiteConfig, interwiki: list | None = None, categories: list | None = None) -> tuple[str, list[dict]]:
    """The text with its links replaced (marks around what resolves), and a record of every visible link.

    Passes over innermost links until nothing changes; loc is the offset in the text at the start of the pass.
    """
    links: list[dict] = []

    def one(m: re.Match) -> str:
        prefix, link, suffix = m.groups()
        if link in ("", "0"):
            return prefix + suffix
        if date := normalize_date(link, cfg):
            return prefix + date + suffix
        first, *fields = link.split("|")
        if BEGIN in first:
            return link
        target, section = first, False
        if s := _SECTION.search(first):
            target, section = first[: s.start()], True
        plain = not target.lstrip(" _\t\n").startswith(":")
        ns, title = split_title(target, known, cfg)
        full = full_title(ns, title)
        if title in ("", "0"):
            return ""
        if ns == cfg.category_ns:
            if plain:
                found = resolve(full)
                if found is not None and categories is not None:
                    categories.append(found)
                return ""
            return prefix + (fields[-1] if fields else link.lstrip(" ").removeprefix(":")) + suffix
        alone = not fields
        if ns and ns == cfg.image_ns:
            anchor = caption(fields)
            before, after = prefix, suffix
        else:
            if alone:
                anchor = link
            elif fields[-1] == "" and not section:
                anchor = re.sub(r"\s*\([^()]*\)\s*\Z", "", re.sub(r"\A\s*[^:]*:\s*", "", first))
            else:
                anchor = fields[-1]
            anchor, before, after = prefix + anchor + suffix, "", ""
        record = {"anchor": clean(anchor), "loc": m.start(), "target_id": None, "target_ns": None, "target_title": None}
        links.append(record)
        found = resolve(full)
        if found is not None:
            record["target_id"] = found
            return f"{before}{BEGIN}{found}{MIDDLE}{anchor}{END}{after}"
        if ns in cfg.interwiki_ns:
            record["target_ns"], record["target_title"] = ns, title
            if interwiki is None:
                return before + after
            interwiki.append({"ns": ns, "title": title})
            return f"{before}{BEGIN}!{len(interwiki) - 1}{MIDDLE}{anchor}{END}{after}"
        return before + ("" if alone and ":" in anchor else anchor) + after

    while "[[" in text:
        new = _LINK.sub(one, text)
        if new == text:
            break
        text = new
    return text, links


def extract_urls(text: str) -> tuple[str, list[dict], list[str]]:
    """The text without URLs, the external links (bracketed first) and the distinct bare URLs."""
    out: list[dict] = []

    def bracketed(m: re.Match) -> str:
        if m[1].split(":", 1)[0] not in PROTOCOLS:
            return m[0]
        anchor = m[2].strip()
        out.append({"url": m[1], "anchor": anchor or None})
        return anchor

    def bare(m: re.Match) -> str:
        if m[0].split(":", 1)[0] not in PROTOCOLS:
            return m[0]
        out.append({"url": m[0], "anchor": None})
        return ""

    text = _BRACKETED.sub(bracketed, text)
    n = len(out)
    text = _BARE.sub(bare, text)
    return text, out, list(dict.fromkeys(x["url"] for x in out[n:]))


def _images_to_links(block: str, cfg: SiteConfig) -> str:
    """Lines that name an image, in links. White space before a line goes, blank lines too; blanks at its end belong to the link."""
    for a, b in cfg.aliases:
        block = re.sub(rf"(?im)^\s*{re.escape(a)}:", lambda m: f"{b}:", block)
    return re.sub(rf"(?im)^\s*({re.escape(cfg.image_ns)}:.*)\s*$", lambda m: f"[[{m[1]}]]", block)


def gallery_to_links(text: str, cfg: SiteConfig) -> str:
    while (new := re.sub(r"<gallery>(.*?)</gallery>", lambda m: _images_to_links(m[1], cfg), text, flags=re.S)) != text:
        text = new
    return text


def imagemap_to_links(text: str, cfg: SiteConfig) -> str:
    """Image maps as links: the image, then of each line the link at its end; comment lines go."""

    def block(m: re.Match) -> str:
        lines = re.sub(r"(?m)^\s*#.*$", "", _images_to_links(m[1], cfg))
        return re.sub(r"(?m)^.*(\[\[.*\]\])\s*$", r"\1", lines)

    while (new := re.sub(r"<imagemap>([^<]*)</imagemap>", block, text)) != text:
        text = new
    return text
