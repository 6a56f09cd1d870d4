"""Text of a raw model answer, and its words.

An answer is JSON or a Python dict literal holding ``text``, possibly inside other words or a code fence, or plain text.
``result_text`` gives the text and how it was stored, so that operators can leave out objects that were cut off.
"""

from __future__ import annotations

import re

NONE, PLAIN, OBJECT, CUT = "none", "plain", "object", "cut"

_KEY = re.compile(r"""(?<=[,{\s])(?:"text"|'text')\s*:\s*""")
_KEY_AT_START = re.compile(r"""\{\s*+(?:"text"|'text')\s*:\s*""")
_LITERAL = {q: re.compile(rf"{q}([^{q}\\]*(?:\\.[^{q}\\]*)*)({q}|\\?\Z)", re.S) for q in "\"'"}
_NEXT = re.compile(r"""\s*(?=["'])""")
_NULL = re.compile(r"null\b|None\b")
_EMPTY = re.compile(r"\s*(?:```\w*\s*)?\{\s*\}\s*(?:```\s*)?\Z")
_ESCAPE = re.compile(r"\\(?:u([dD][89abAB][0-9a-fA-F]{2})\\u([dD][c-fC-F][0-9a-fA-F]{2})|u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|U([0-9a-fA-F]{8})|\n|u[0-9a-fA-F]{0,3}\Z|(.))", re.S)
_SIMPLE = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "a": "\a", "v": "\v"}
WORD = re.compile(r"[^\W_]+")


def _unescape(m: re.Match) -> str:
    high, low, u, x, wide, one = m.groups()
    if high:
        return chr(0x10000 + ((int(high, 16) - 0xD800) << 10) + int(low, 16) - 0xDC00)
    for code in (u, x, wide):
        if code:
            n = int(code, 16)
            return "�" if 0xD800 <= n < 0xE000 or n > 0x10FFFF else chr(n)
    return "" if one is None else _SIMPLE.get(one, one)


def _key(raw: str) -> re.Match | None:
    """The first key ``text`` with an open brace before it and no other brace between."""
    brace = seen = -1
    for m in _KEY.finditer(raw):
        at = max(raw.rfind("{", seen + 1, m.start()), raw.rfind("}", seen + 1, m.start()))
        brace, seen = at if at >= 0 else brace, m.start() - 1
        if brace >= 0 and raw[brace] == "{":
            return m
    return None


def result_text(raw: str | None) -> tuple[str | None, str]:
    """(text, kind) of a raw answer; kind is one of NONE, PLAIN, OBJECT, CUT. Null, ``{}`` and a null value have no text."""
    if raw is None:
        return None, NONE
    m = _KEY_AT_START.search(raw) or _key(raw)
    if not m:
        return (None, NONE) if _EMPTY.match(raw) else (raw, PLAIN)
    at, parts = m.end(), []
    if at >= len(raw):
        return "", CUT
    if raw[at] not in _LITERAL:
        return (None, NONE) if _NULL.match(raw, at) else (raw, PLAIN)
    kind = CUT
    while True:
        lit = _LITERAL[raw[at]].match(raw, at)
        body = lit.group(1)
        parts.append(_ESCAPE.sub(_unescape, body) if "\\" in body else body)
        if lit.group(2) not in ("'", '"'):
            break
        follow = _NEXT.match(raw, lit.end())
        if not follow:
            kind = OBJECT if "}" in raw[lit.end() :] else CUT
            break
        at = follow.end()
    return (parts[0] if len(parts) == 1 else " ".join(parts)), kind


def words(text: str) -> list[str]:
    """Longest runs of letters and digits, lower-cased."""
    return WORD.findall(text.lower())
