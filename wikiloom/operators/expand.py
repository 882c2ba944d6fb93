"""The template language: parser functions, magic words and recursive inclusion. Plain strings, no Spark."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from ..config import SiteConfig
from .scan import bind_params, mask, split_fields, split_templates, substitute, unmask
from .titles import normalize_title

#: name -> function(expand, arguments, page, cfg) -> text, or None for "no such function".
PARSER_FUNCTIONS: dict[str, Callable] = {}
_CALL = re.compile(r"(#?[a-z]+):(.*)\Z", re.S)


def parser_function(*names: str):
    """Registers a parser function under its names."""

    def add(f: Callable) -> Callable:
        PARSER_FUNCTIONS.update(dict.fromkeys(names, f))
        return f

    return add


@dataclass
class Page:
    """What expansion needs of a page, and what it leaves: (template id, parameters) of each inclusion."""

    title: str
    ns: str
    known: frozenset[str]
    template: Callable[[str], tuple[int, str] | None]
    language: dict[str, str] = field(default_factory=dict)
    log: list[tuple[int, dict[str, str]]] = field(default_factory=list)

    @property
    def full(self) -> str:
        return f"{self.ns}:{self.title}" if self.ns else self.title


def percent_encode(s: str) -> str:
    return "".join(c if c.isascii() and c.isalnum() else f"%{ord(c):02X}" for c in s)


def pad(s: str, fields: list[str], left: bool) -> str:
    digits = re.match(r"\s*([0-9]+)", fields[1]) if len(fields) > 1 else None
    room = min(int(digits[1][:9]) if digits else 0, 500) - len(s)
    fill = fields[2] if len(fields) > 2 and fields[2] not in ("", "0") else "0"
    if room <= 0:
        return s
    more = (fill * room)[:room]
    return more + s if left else s + more


def _get(args: list[str], i: int) -> str:
    return args[i] if i < len(args) else ""


@parser_function("#if")
def _if(expand, args, page, cfg):
    return _get(args, 1) if args[0] else _get(args, 2)


@parser_function("#ifeq")
def _ifeq(expand, args, page, cfg):
    return _get(args, 2) if args[0] == expand(_get(args, 1)) else _get(args, 3)


@parser_function("#switch")
def _switch(expand, args, page, cfg):
    cases = args[1:]
    if not cases or not cases[-1]:
        return None
    found, default = False, ""
    for case in cases:
        label, eq, value = case.partition("=")
        label = expand(label.strip())
        found = found or label == args[0]
        if eq:
            if found:
                return value.strip()
            if label == "#default":
                default = value.strip()
    last = cases[-1]
    if "=" not in last:
        return last
    return default if default not in ("", "0") else ""


@parser_function("#language")
def _language(expand, args, page, cfg):
    return page.language.get(args[0].lower(), args[0])


@parser_function("urlencode")
def _urlencode(expand, args, page, cfg):
    return percent_encode(args[0])


@parser_function("lc")
def _lc(expand, args, page, cfg):
    return args[0].lower()


@parser_function("ucfirst")
def _ucfirst(expand, args, page, cfg):
    return args[0][:1].upper() + args[0][1:]


@parser_function("int")
def _int(expand, args, page, cfg):
    return cfg.int_lang if args[0] == "Lang" else args[0]


@parser_function("padleft")
def _padleft(expand, args, page, cfg):
    return pad(args[0], [args[0], *map(expand, args[1:])], True)


@parser_function("padright")
def _padright(expand, args, page, cfg):
    return pad(args[0], [args[0], *map(expand, args[1:])], False)


def magic_word(name: str, page: Page) -> str | None:
    if name in ("pagename", "Pagename", "PAGENAME"):
        return page.title
    return {"NAMESPACE": page.ns, "FULLPAGENAME": page.full, "PAGENAMEE": percent_encode(page.title), "FULLPAGENAMEE": percent_encode(page.full), "SERVER": "http://www.example.com"}.get(name)


def _instantiate(call: str, page: Page, cfg: SiteConfig, level: int) -> str:
    if len(call) > cfg.longest_invocation:
        return ""
    fields = split_fields(call)
    if not fields:
        return " "
    expand = lambda s: include(s, page, cfg, level + 1) if "{" in s else s
    name = expand(fields[0])
    text = magic_word(name, page)
    if text is None and (m := _CALL.match(name)):
        f = PARSER_FUNCTIONS.get(m[1])
        # A name that is no function gives its second field as it stands; so do templates with a prefix in lower case.
        text = f(expand, [m[2].strip(), *fields[1:]], page, cfg) if f else _get(fields, 1)
    if text is None:
        title = normalize_title(name, page.known, cfg, cfg.template_ns)
        params = bind_params([expand(x) for x in fields[1:]])
        override = dict(cfg.override_templates).get(title)
        if override is not None:
            text = override
        else:
            found = page.template(title)
            if found is None:
                return " "
            page.log.append((found[0], params))
            text = substitute(found[1], params, cfg.parameter_passes)
    return expand(text)


def include(text: str, page: Page, cfg: SiteConfig, level: int = 0) -> str:
    """``text`` with its templates, parser functions and magic words expanded."""
    if level > cfg.template_levels or "{{" not in text:
        return text
    text, kept = mask(text)
    parts = split_templates(text)
    for i in range(1, len(parts), 2):
        call = re.sub(r"\{\{\{[^{}]*\}\}\}", "", parts[i]) if level == 0 else parts[i]
        parts[i] = _instantiate(call, page, cfg, level)
    return unmask("".join(parts), kept)

