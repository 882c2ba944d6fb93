"""Scanners of the template language: invocations, fields, parameters and protected blocks. Plain strings, no Spark."""

from __future__ import annotations

import re

_BRACE = re.compile(r"[{}]")
_FIELD = re.compile(r"[{}\[\]|]")
OPEN, SHUT = "\ue010", "\ue011"
_MASKED = re.compile(f"{OPEN}([0-9]+){SHUT}")


def split_templates(text: str) -> list[str]:
    """Text and invocations in turn, invocations at odd places. An invocation that is never closed is text to the end."""
    out, at = [], 0
    while (start := text.find("{{", at)) >= 0:
        depth, end = 0, -1
        pos = start + 2
        while m := _BRACE.search(text, pos):
            pos = m.end()
            if m[0] == "{":
                depth += 1
            elif depth:
                depth -= 1
            elif text.startswith("}", pos):
                end = m.start()
                break
        if end < 0:
            break
        out += [text[at:start], text[start + 2 : end]]
        at = end + 2
    out.append(text[at:])
    return out


def split_fields(text: str) -> list[str]:
    """Fields of an invocation: cut at | outside braces and brackets, trimmed."""
    if not text:
        return []
    out, at, depth = [], 0, {"{": 0, "[": 0}
    for m in _FIELD.finditer(text):
        c = m[0]
        if c == "|":
            if not depth["{"] and not depth["["]:
                out.append(text[at : m.start()].strip(" \t\n\r\f\v"))
                at = m.end()
        elif c in depth:
            depth[c] += 1
        else:
            key = "{" if c == "}" else "["
            depth[key] = max(0, depth[key] - 1)
    return [*out, text[at:].strip(" \t\n\r\f\v")]


def bind_params(fields: list[str]) -> dict[str, str]:
    """Names to values; fields without a name count from 1; the last of a name stays."""
    out, number = {}, 0
    for field in fields:
        name, eq, value = field.partition("=")
        name = name.rstrip()
        if eq and "|" not in name:
            out[name] = value.lstrip()
        else:
            number += 1
            out[str(number)] = field
    return out


def _reference(text: str) -> tuple[int, int] | None:
    """The innermost {{{ ... }}} with balanced braces inside: start of the opening and end of the closing."""
    end = text.find("}}}")
    while end >= 0:
        depth, i = 0, end - 1
        while i >= 2:
            if text[i] == "}":
                depth += 1
            elif text[i] == "{":
                if depth:
                    depth -= 1
                elif text[i - 2 : i + 1] == "{{{":
                    return i - 2, end + 3
                else:
                    break
            i -= 1
        end = text.find("}}}", end + 1)
    return None


def substitute(text: str, params: dict[str, str], passes: int = 10) -> str:
    """Parameter references replaced, innermost first: the value, else the default, else nothing."""
    for _ in range(passes):
        out, rest, changed = [], text, False
        while found := _reference(rest):
            a, b = found
            name, bar, default = rest[a + 3 : b - 3].partition("|")
            out.append(rest[:a] + params.get(name, default if bar else ""))
            rest, changed = rest[b:], True
        text = "".join(out) + rest
        if not changed or "{{{" not in text:
            break
    return text


def mask(text: str, tags: tuple[str, ...] = ("pre", "nowiki")) -> tuple[str, list[str]]:
    """Protected blocks put aside, each behind a numbered token."""
    kept: list[str] = []

    def put(m: re.Match) -> str:
        kept.append(m[0])
        return f"{OPEN}{len(kept) - 1}{SHUT}"

    for tag in tags:
        text = re.sub(rf"<{tag}(?:\s[^>/]*)?>.*?</{tag}\s*>", put, text, flags=re.I | re.S)
    return text, kept


def unmask(text: str, kept: list[str]) -> str:
    while kept and OPEN in text and _MASKED.search(text):
        text = _MASKED.sub(lambda m: kept[int(m[1])], text)
    return text
