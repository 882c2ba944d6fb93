"""Clean text from wiki markup, and the marks of links to tags. Plain strings, no Spark."""

from __future__ import annotations

import re

from .links import BEGIN, END, MIDDLE

_MARK = re.compile(rf"{BEGIN}([^{MIDDLE[0]}{BEGIN[0]}]*){MIDDLE}((?:(?!==)[^{BEGIN[0]}{END[0]}])*){END}")
_LEFT = re.compile(rf"{BEGIN}[^{MIDDLE[0]}]*{MIDDLE}|{END}")
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_TABLE = re.compile(r"\{\|(?:(?!\{\|).)*?\|\}(?!\})", re.S)


def _fix(pattern: re.Pattern, to: str, text: str) -> str:
    while (new := pattern.sub(to, text)) != text:
        text = new
    return text


def strip_templates(text: str) -> str:
    """Innermost {{...}} to blanks until none is left, by scanning; closing braces without a start stay."""
    while True:
        out, pos = [], 0
        while (end := text.find("}}", pos)) >= 0:
            start = text.rfind("{{", pos, end)
            out.append(text[pos : end + 2] if start < 0 else text[pos:start] + " ")
            pos = end + 2
        new = "".join(out) + text[pos:]
        if new == text:
            return text
        text = new


def xml_escape(s: str) -> str:
    for a, b in (("&", "&amp;"), ('"', "&quot;"), ("'", "&apos;"), ("<", "&lt;"), (">", "&gt;")):
        s = s.replace(a, b)
    return s


def clean_text(text: str, interwiki: list[dict] | None = None, encode: bool = False) -> str:
    """Blocks, tables, math, leftover templates, tags, emphasis and entities removed; with ``encode`` also XML-safe, with link tags."""
    text = re.sub(r"<(includeonly|onlyinclude|timeline)>.*?</\1>", " ", text, flags=re.S)
    text = re.sub(r"<br ?/?>", "\n\n", text)
    text = re.sub(r"<table\b[^>]*>.*?</table>", "\n", text, flags=re.S | re.I)
    for _ in range(5):
        text = _TABLE.sub("\n", text)
    text = re.sub(r"<math[^>]*>.*?</math>", " ", text, flags=re.S | re.I)
    text = strip_templates(text)
    text = _fix(_TAG, " ", text)
    for n in (5, 3, 2):
        q = "'" * n
        text = re.sub(rf"{q}([^\n]*?){q}", r"\1", text)
    text = re.sub(r"[ \t\f\v\r]*\n[ \t\f\v\r]*\n\s*", "\n\n", text)
    text = re.sub(r"&#?\w+;", " ", text)
    if not encode:
        return _LEFT.sub("", text)
    text = xml_escape(text)

    def tag(m: re.Match) -> str:
        if m[1].startswith("!"):
            x = (interwiki or [])[int(m[1][1:])]
            return f'<w namespace="{xml_escape(x["ns"])}" title="{xml_escape(x["title"])}">{m[2]}</w>'
        return f'<a id="{m[1]}">{m[2]}</a>'

    while (new := _MARK.sub(tag, text)) != text:
        text = new
    text = _LEFT.sub("", text)
    for n, name in ((5, "h4"), (4, "h3"), (3, "h2"), (2, "h1")):
        q = "=" * n
        text = re.sub(rf"(?m)^{q}([^\n]*?){q}(?=[^\S\n]*$)", rf"<{name}>\1</{name}>", text)
    return text
