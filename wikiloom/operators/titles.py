"""Title normalisation on plain strings; the same rules as ``functions.text.split_title``."""

from __future__ import annotations

import re

from ..config import SiteConfig

_BLANK = " \f\n\r\t_"
_RUN = re.compile(r"[ \f\n\r\t_]+")
_PREFIXED = re.compile(r"([^:]*):\s*(\S.*)\Z", re.S)


def ucfirst(s: str) -> str:
    return s[:1].upper() + s[1:]


def split_title(s: str, known: frozenset[str], cfg: SiteConfig, default_ns: str | None = None) -> tuple[str, str]:
    s = _RUN.sub(" ", s.strip(_BLANK)).replace("\u200e", "").replace("\u200f", "")
    if not default_ns and s.startswith(":"):
        s = s[1:].lstrip(" ")
    if m := _PREFIXED.match(s):
        ns = ucfirst(m[1].lower())
        ns = dict(cfg.aliases).get(ns, ns)
        if not ns or ns in known:
            return ns, ucfirst(m[2])
    return default_ns or "", ucfirst(s)


def full_title(ns: str, title: str) -> str:
    return f"{ns}:{title}" if ns not in ("", "0") else title


def normalize_title(s: str, known: frozenset[str], cfg: SiteConfig, default_ns: str | None = None) -> str:
    return full_title(*split_title(s, known, cfg, default_ns))
